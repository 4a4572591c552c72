"""Alignment of two tokenizers' tokens, as Arrow tables inside of tasks.

A slice of documents is encoded by both tokenizers. The lists of ids are flattened, with the index of each token's
document; lengths in bytes by a look-up and sums by document give the ends of all tokens. A hash join of both token tables
on (document, end) finds where tokens of both end, which cuts them into groups. Tokens whose bytes overlap are linked.

Links are counted by pair of ids within the document and then, as partial counts of a slice, over documents; Spark merges
the partial counts. The documents' own counts are held against the corpus in a second pass: the most frequent pairs, a
bounded table, are looked up in the tasks, all other pairs, each of them rare, are joined by Spark.

Memory of a task follows the bytes of a slice. A longer document is a slice of its own and is encoded in parts, cut before
single spaces, where no token of either tokenizer goes across.
"""

import base64
import hashlib
import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlake.llm.batches import slices
from visitlake.llm.bpe import LATER, byte_letters
from visitlake.session import staged

PART_CHARS = 1 << 16
# Longer parts, which have no space to cut at, are left to the tokenizer's own library.
RANKED_CHARS = 1 << 20
# A pair of ids as one number.
B_BITS = 15
# So many pairs at most are looked up in the tasks: 12 bytes each.
FREQUENT_PAIRS = 1 << 20
PARTIAL_PAIRS = 400_000

# The pattern of the byte-level vocabulary's word pieces, the sign for a space and byte pieces of the other.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPACE_SIGN = "▁"
BYTE_PIECE = re.compile("<0x([0-9A-F]{2})>")

# A single space between other characters.
_CUT = re.compile(r"(?<=\S) (?=\S)")


class ByteLevel:
    """Ids of a byte-level BPE in the tokenizers library's file; special strings in texts are plain text."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.library.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        byte_of = {letter: byte for byte, letter in enumerate(byte_letters())}
        special = {token["id"]: token["content"] for token in spec["added_tokens"]}
        ranks = {bytes(byte_of[letter] for letter in token): number for token, number in spec["model"]["vocab"].items()
                 if number not in special}
        self.bytes = [b""] * (max([*ranks.values(), *special]) + 1)
        for token, number in ranks.items():
            self.bytes[number] = token
        for number, content in special.items():
            self.bytes[number] = content.encode()
        # The same merges in the same order, by a faster library. Character classes may differ by Unicode version above LATER.
        self.ranked = tiktoken.Encoding("byte level", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        found = []
        for part in parts_of(" " + text):
            if len(part) <= RANKED_CHARS and max(part) < LATER:
                found += self.ranked.encode_ordinary(part)
            else:
                found += self.library.encode(part, add_special_tokens=False).ids
        return found


class Pieces:
    """Ids of a sentencepiece model, which writes a space before the text."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(number) for number in range(self.model.get_piece_size())]
        self.bytes = [bytes.fromhex(found[1]) if (found := BYTE_PIECE.fullmatch(name)) else name.replace(SPACE_SIGN, " ").encode()
                      for name in names]

    def encode(self, text: str) -> list[int]:
        found = []
        for number, part in enumerate(parts_of(text)):
            # A later part begins with the space that the model writes.
            found += self.model.encode(part[1:] if number else part, num_threads=1)
        return found


def parts_of(text: str) -> list[str]:
    """The text in parts of about ``PART_CHARS``, each but the first with a space at its start."""
    parts, start = [], 0
    while len(text) - start > PART_CHARS and (cut := _CUT.search(text, start + PART_CHARS)):
        parts.append(text[start:cut.start()])
        start = cut.start()
    return [*parts, text[start:]]


@lru_cache(maxsize=2)
def tokenizers_of(path_a: str, path_b: str) -> tuple:
    """Both tokenizers and the bytes of their tokens, once for each Python worker."""
    a, b = ByteLevel(path_a), Pieces(path_b)
    if len(b.bytes) > 1 << B_BITS:
        raise ValueError(f"the second vocabulary has more than {1 << B_BITS} ids")
    return a, b, pa.array(a.bytes, pa.binary()), pa.array(b.bytes, pa.binary())


# One slice

def aligned(texts: list[str | None], path_a: str, path_b: str) -> dict:
    """Arrays by document: ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``groups`` (text), and ``pairs``, ``times`` (lists).

    Texts that are missing, empty or not given back by the tokens' bytes have no tokens.
    """
    a, b, bytes_a, bytes_b = tokenizers_of(path_a, path_b)
    whole = [text or "" for text in texts]
    lists = [pa.array([one.encode(text) if text else [] for text in whole], pa.list_(pa.int32())) for one in (a, b)]
    expected = pa.array([(" " + text).encode() if text else b"" for text in whole], pa.binary())
    same = np.ones(len(texts), bool)
    for ids, of_token in zip(lists, (bytes_a, bytes_b)):
        joined = pc.binary_join(pa.ListArray.from_arrays(ids.offsets, pc.take(of_token, ids.flatten())), b"")
        same &= pc.equal(joined, expected).to_numpy(zero_copy_only=False)
    if not same.all():
        lists = [pa.array([ids if kept else [] for ids, kept in zip(one.to_pylist(), same.tolist())], one.type) for one in lists]
    tables = [_token_table(ids, of_token) for ids, of_token in zip(lists, (bytes_a, bytes_b))]
    common = tables[0].join(tables[1], keys=["doc", "end"], join_type="inner", left_suffix="_a", right_suffix="_b").sort_by("place_a")
    groups, group_docs = _groups(tables, common, len(texts))
    links, link_docs = _links(tables)
    # The number of times of each pair in each document.
    counted = pa.table({"doc": link_docs, "pair": links}).group_by(["doc", "pair"]).aggregate([([], "count_all")]).sort_by(
        [("doc", "ascending"), ("pair", "ascending")])
    bounds = _bounds(counted.column("doc").to_numpy(), len(texts))
    lengths = [np.diff(ids.offsets.to_numpy()) for ids in lists]
    return {
        "n_a": lengths[0], "n_b": lengths[1], "n_groups": np.bincount(group_docs, minlength=len(texts)),
        "n_links": np.bincount(link_docs, minlength=len(texts)), "groups": groups,
        "pairs": pa.ListArray.from_arrays(bounds, _one_chunk(counted.column("pair")).cast(pa.int32())),
        "times": pa.ListArray.from_arrays(bounds, _one_chunk(counted.column("count_all")).cast(pa.int32()))}


def _one_chunk(column) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _bounds(docs: np.ndarray, count: int) -> pa.Array:
    return pa.array(np.searchsorted(docs, np.arange(count + 1)).astype(np.int32))


def _token_table(ids: pa.ListArray, bytes_of: pa.Array) -> pa.Table:
    """Every token with its document, its place among all tokens, and the end of its bytes in the document."""
    flat, docs = pc.list_flatten(ids), pc.list_parent_indices(ids)
    sums = pc.cumulative_sum(pc.cast(pc.binary_length(pc.take(bytes_of, flat)), pa.int64()))
    # Sums run over the slice; those before a document are taken off.
    before = np.concatenate([[0], sums.to_numpy()])[ids.offsets.to_numpy()[:-1]]
    ends = pc.subtract(sums, pc.take(pa.array(before, pa.int64()), docs))
    return pa.table({"doc": pc.cast(docs, pa.int64()), "end": ends, "place": pa.array(np.arange(len(flat)), pa.int64()), "id": flat})


def _groups(tables: list[pa.Table], common: pa.Table, count: int) -> tuple[pa.Array, np.ndarray]:
    """Texts of the groups by document, and the document of each group. Groups end where both tokens end."""
    docs = common.column("doc").to_numpy()
    texts = []
    for name, table in zip(("place_a", "place_b"), tables):
        ends = np.concatenate([[0], common.column(name).to_numpy() + 1]).astype(np.int32)
        ids = pc.cast(_one_chunk(table.column("id")), pa.string())
        texts.append(pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), ids), ","))
    both = pc.binary_join_element_wise(*texts, "|")
    return pc.binary_join(pa.ListArray.from_arrays(_bounds(docs, count), both), ";"), docs


def _links(tables: list[pa.Table]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of ids, as one number, of all tokens whose bytes overlap, and their documents."""
    (docs_a, ends_a, ids_a), (docs_b, ends_b, ids_b) = (
        [table.column(name).to_numpy() for name in ("doc", "end", "id")] for table in tables)
    if not len(docs_a):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # Ends of all documents one after the other: both tokenizers give the same bytes of each.
    total = np.zeros(max(docs_a[-1], docs_b[-1]) + 2, np.int64)
    total[docs_a + 1] = np.maximum.reduceat(ends_a, np.flatnonzero(np.r_[True, np.diff(docs_a) != 0]))[
        np.cumsum(np.r_[False, np.diff(docs_a) != 0])]
    base = np.cumsum(total)
    ends_a, ends_b = ends_a + base[docs_a], ends_b + base[docs_b]
    starts_a, starts_b = np.r_[0, ends_a[:-1]], np.r_[0, ends_b[:-1]]
    first = np.searchsorted(ends_b, starts_a, "right")
    after = np.searchsorted(starts_b, ends_a, "left")
    many = after - first
    of_a = np.repeat(np.arange(len(ends_a)), many)
    of_b = np.arange(len(of_a)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first, many)
    return ids_a[of_a].astype(np.int64) << B_BITS | ids_b[of_b], docs_a[of_a]


# Spark

def align(docs: DataFrame, path_a: str, path_b: str, frequent_pairs: int = FREQUENT_PAIRS, id_column: str = "doc_id",
          text_column: str = "text") -> DataFrame:
    """One row per document: the id, ``n_a``, ``n_b`` (tokens), ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and
    ``groups_sha256``, the hex digest of the groups as ``groups_of`` writes them.

    The first tokenizer (a byte-level BPE file) sees a space and the text, the second (a sentencepiece model) the text, before
    which it writes a space itself. Groups read ``a1,a2|b1;a3|b2,b3``, ids in order. ``n_best`` are links whose pair of ids is
    linked in as many documents as any pair of its first id is; ``count_sum`` sums the documents of the pair over links.

    A text that is missing, empty or not given back by the tokens' bytes has no tokens, zeros, no groups and an empty digest. Rows with equal or missing ids, and repeated rows, are documents of their own. An empty table gives no rows.
    Other columns are left out.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    chosen = docs.select(F.col(f"`{id_column}`").alias("doc"), F.col(f"`{text_column}`").cast("string").alias("text"))
    found = staged(chosen.mapInArrow(
        lambda batches: _documents(batches, path_a, path_b),
        f"key long, doc {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<int>, times array<int>"), "aligned")
    counts = staged(found.select("pairs").mapInArrow(_partial_counts, "pair int, documents long")
                    .groupBy("pair").agg(F.sum("documents").alias("documents")), "pair-counts")
    # One number per id of the first vocabulary.
    best = counts.groupBy(F.shiftright("pair", B_BITS).alias("a")).agg(F.max("documents").alias("best"))
    shared = docs.sparkSession.sparkContext.broadcast((*_frequent(counts, frequent_pairs), *_as_arrays(best, "a", "best")))
    names = ["n_a", "n_b", "n_groups", "n_links"]
    kinds = ", ".join(f"{name} long" for name in names)
    looked_up = found.mapInArrow(
        lambda batches: _looked_up(batches, shared),
        f"key long, doc {kind}, {kinds}, groups_sha256 string, n_best long, count_sum long")
    rare = found.select("key", "pairs", "times").mapInArrow(lambda batches: _rare(batches, shared), "key long, pair int, times int, best long")
    of_rare = rare.join(counts, "pair").groupBy("key").agg(
        F.sum(F.when(F.col("documents") == F.col("best"), F.col("times")).otherwise(0)).alias("rare_best"),
        F.sum(F.col("documents") * F.col("times")).alias("rare_sum"))
    return looked_up.join(staged(of_rare, "rare-pairs"), "key", "left").select(
        F.col("doc").alias(id_column), *names, (F.col("n_best") + F.coalesce("rare_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("rare_sum", F.lit(0))).alias("count_sum"), "groups_sha256")


def groups_of(docs: DataFrame, path_a: str, path_b: str, text_column: str = "text") -> DataFrame:
    """All columns of ``docs``, nested in ``row``, and ``groups``, the text of the groups of each document."""
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row")
    nested = docs.select(row, F.col(f"`{text_column}`").cast("string").alias("text"))

    def run(batches):
        for part in slices(batches, 1):
            groups = aligned(part.column(1).to_pylist(), path_a, path_b)["groups"]
            yield pa.RecordBatch.from_arrays([part.column(0), groups], names=["row", "groups"])

    return nested.mapInArrow(run, f"row {nested.schema['row'].dataType.simpleString()}, groups string")


def _documents(batches, path_a, path_b):
    key = TaskContext.get().partitionId() << 40
    for part in slices(batches, 1):
        found = aligned(part.column(1).to_pylist(), path_a, path_b)
        digests = [hashlib.sha256(groups.encode()).hexdigest() if groups else "" for groups in found["groups"].to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(key, key + part.num_rows)), part.column(0),
             *(pa.array(found[name].astype(np.int64)) for name in ("n_a", "n_b", "n_groups", "n_links")),
             pa.array(digests, pa.string()), found["pairs"], found["times"]],
            names=["key", "doc", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])
        key += part.num_rows


def _partial_counts(batches):
    """Documents by pair of the rows seen so far, given out whenever there are many pairs."""
    held = None
    for batch in batches:
        more = pa.table({"pair": batch.column(0).flatten()}).append_column("documents", pa.array(np.ones(len(batch.column(0).flatten()), np.int64)))
        held = more if held is None else pa.concat_tables([held, more])
        held = held.group_by("pair").aggregate([("documents", "sum")]).rename_columns(["pair", "documents"])
        if held.num_rows >= PARTIAL_PAIRS:
            yield from held.to_batches()
            held = None
    if held is not None:
        yield from held.to_batches()


def _as_arrays(frame: DataFrame, *names: str) -> list[np.ndarray]:
    table = frame.select(*names).toArrow().sort_by(names[0])
    return [table.column(name).to_numpy() for name in names]


def _frequent(counts: DataFrame, most: int) -> list[np.ndarray]:
    """Pairs, in order, and their documents: all pairs from the smallest number of documents that at most ``most`` pairs reach."""
    # Classes of numbers, eight for each doubling.
    level = lambda documents: F.floor(8 * F.log2(documents))
    classes = counts.groupBy(level(F.col("documents")).alias("level")).agg(F.count("*").alias("pairs"), F.min("documents").alias("least")).collect()
    reached, least = 0, None
    for row in sorted(classes, key=lambda row: -row["level"]):
        reached += row["pairs"]
        if reached > most:
            break
        least = row["least"]
    chosen = counts.filter(F.col("documents") >= least) if least is not None else counts.limit(0)
    return _as_arrays(chosen, "pair", "documents")


def _found(pairs: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs among the frequent ones, and which of them are there."""
    if not len(frequent):
        return np.zeros(len(pairs), np.int64), np.zeros(len(pairs), bool)
    places = np.minimum(np.searchsorted(frequent, pairs), len(frequent) - 1)
    return places, frequent[places] == pairs


def _looked_up(batches, shared):
    frequent, documents, ids, best = shared.value
    for batch in batches:
        lists = batch.column(batch.num_columns - 2)
        pairs, times = lists.flatten().to_numpy(), batch.column(batch.num_columns - 1).flatten().to_numpy().astype(np.int64)
        places, there = _found(pairs, frequent)
        count = np.where(there, documents[places], 0) if len(documents) else np.zeros(len(pairs), np.int64)
        is_best = there & (count == best[np.minimum(np.searchsorted(ids, pairs >> B_BITS), len(ids) - 1)]) if len(ids) else there
        bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))])
        sums = [np.diff(np.concatenate([[0], np.cumsum(values)])[bounds]) for values in (is_best * times, count * times)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *(pa.array(values.astype(np.int64)) for values in sums)],
                                         names=[*batch.schema.names[:-2], "n_best", "count_sum"])


def _rare(batches, shared):
    frequent, _, ids, best = shared.value
    for batch in batches:
        lists = batch.column(1)
        pairs, docs = lists.flatten().to_numpy(), pc.list_parent_indices(lists).to_numpy()
        left = ~_found(pairs, frequent)[1]
        chosen = pairs[left]
        yield pa.RecordBatch.from_arrays(
            [pc.take(batch.column(0), pa.array(docs[left])), pa.array(chosen), pa.array(batch.column(2).flatten().to_numpy()[left]),
             pa.array(best[np.searchsorted(ids, chosen >> B_BITS)] if len(chosen) else np.zeros(0, np.int64))],
            names=["key", "pair", "times", "best"])
