"""SimHash near-duplicates by covering locality-sensitive hashing.

Bits of a fingerprint get vectors of r + 1 bits, and each nonzero vector v makes one table: its mask keeps the bits whose
vector has an odd number of common ones with v. Two fingerprints that differ in at most r bits give at most r vectors,
so some v is orthogonal to all of them; in its table both fingerprints look the same. Every pair within the radius
therefore collides in some table, without fail.

Buckets hold different fingerprints only, copies were put together before. Within a bucket no pairs are listed: a search
from one member takes all unvisited members within the radius, then goes on from those, and gives one edge per member.
A bucket of more than ``TILE`` members is dealt out in slices, each two of which are searched together.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlake.llm.components import components
from visitlake.session import shuffled, staged

TILE = 4096
SHINGLES_AT_ONCE = 255 * 256


def masks(radius: int) -> list[int]:
    """The bit masks of all tables, as signed 64-bit numbers: 2 ** (radius + 1) - 1 of them, about 32 bits in each."""
    vectors = 2 ** (radius + 1) - 1
    found = []
    for v in range(1, vectors + 1):
        mask = sum(1 << bit for bit in range(64) if ((bit % vectors + 1) & v).bit_count() % 2)
        found.append(mask - (1 << 64) if mask >> 63 else mask)
    return found


# Fingerprints

def words_of(text: bytes | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased."""
    return text.lower().split() if text else []


def shingle_hashes(words: list[bytes], size: int, seed: int):
    """XXH64 of all runs of so many words, joined by spaces, in pieces of bounded length; fewer words are one run."""
    joined = b" ".join(words)
    if len(words) <= size:
        yield np.array([xxhash.xxh64_intdigest(joined, seed)], np.uint64)
        return
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - size + 1]
    ends = ends[size - 1:]
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), SHINGLES_AT_ONCE):
        here = slice(at, at + SHINGLES_AT_ONCE)
        yield np.array([digest(joined[a:b], seed) for a, b in zip(starts[here].tolist(), ends[here].tolist())], np.uint64)


def simhash(hashes) -> int:
    """The fingerprint of hashes given in pieces: a bit is 1 if more than half of the hashes have it. Signed 64-bit."""
    ones, total = np.zeros(64, np.int64), 0
    for piece in hashes:
        bits = np.unpackbits(piece.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        whole = len(bits) - len(bits) % 255
        # Sums of 255 rows fit a byte.
        ones += bits[:whole].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        ones += bits[whole:].sum(axis=0, dtype=np.uint8)
        total += len(bits)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big", signed=True)


def shingle_fingerprint(text: bytes | None, size: int, seed: int) -> int:
    words = words_of(text)
    return simhash(shingle_hashes(words, size, seed)) if words else 0


def fingerprints(docs: DataFrame, words: int, seed: int, id_column: str, text_column: str) -> DataFrame:
    """The id and ``fingerprint`` (signed 64-bit) of each row's whole text; 0 for a missing text or one without words."""
    def run(batches):
        for batch in batches:
            found = [shingle_fingerprint(text, words, seed) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], names=["id", "fingerprint"])

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, F.col(text_column).cast("binary")).mapInArrow(
        run, f"`{id_column}` {kind}, fingerprint long")


# Links

def search(nodes: np.ndarray, neighbours) -> list[tuple[int, int]]:
    """Edges that connect what a chain of neighbours connects; ``neighbours(i, left)`` says which of ``left`` i has."""
    left, edges = np.argsort(nodes, kind="stable"), []
    while len(left) > 1:
        root, left = left[0], left[1:]
        open_nodes = [root]
        while open_nodes and len(left):
            near = neighbours(open_nodes.pop(), left)
            for node in left[near]:
                edges.append((int(nodes[root]), int(nodes[node])))
            open_nodes.extend(left[near])
            left = left[~near]
    return edges


def links(nodes: DataFrame, radius: int, tile: int = TILE) -> DataFrame:
    """Edges ``a``, ``b`` that connect every two nodes with fingerprints within the radius in at least one place.

    ``nodes`` has ``node`` (a number, once in the table) and ``prints``, an array of fingerprints. Places are compared
    one by one: the first fingerprint of one node with the first of another, and so on.
    """
    places = _places(nodes)
    if not places:
        return nodes.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)
    tables = [F.struct(F.xxhash64(F.lit(place), F.lit(number), print_.bitwiseAND(F.lit(mask))).alias("bucket"),
                       print_.alias("fingerprint"))
              for place, print_ in enumerate(F.col("prints")[place] for place in range(places))
              for number, mask in enumerate(masks(radius))]
    members = nodes.select("node", F.inline(F.array(*tables)))
    # A count of each bucket comes first: nearly all members are alone in theirs and go no further.
    shared = members.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
    members = shuffled(members).join(shared, "bucket")
    slices = F.ceil(F.col("size") / tile).cast("int")
    own = F.pmod(F.xxhash64("node"), slices).cast("int")
    pairs = F.when(slices == 1, F.array(F.lit(0))).otherwise(F.transform(
        F.filter(F.sequence(F.lit(0), slices - 1), lambda other: other != own),
        lambda other: F.least(own, other) * slices + F.greatest(own, other)))
    tiles = members.select("bucket", F.explode(pairs).alias("tile"), "node", "fingerprint")
    found = (tiles.repartition("bucket", "tile").sortWithinPartitions("bucket", "tile")
             .mapInArrow(lambda batches: _searched(batches, radius), "a long, b long"))
    return found.distinct()


def _places(nodes: DataFrame) -> int:
    return nodes.agg(F.max(F.size("prints"))).first()[0] or 0


def _searched(batches, radius):
    for nodes, prints in runs(batches):
        prints = prints.view(np.uint64)

        def near(i, left):
            return np.bitwise_count(prints[left] ^ prints[i]) <= radius

        edges = search(nodes, near)
        if edges:
            a, b = zip(*edges)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def runs(batches):
    """Column arrays of each run of equal first two columns in a sorted stream; a run may span batches."""
    kept: list[np.ndarray] | None = None
    for batch in batches:
        columns = [column.to_numpy(zero_copy_only=False) for column in batch.columns]
        if kept is not None:
            columns = [np.concatenate(parts) for parts in zip(kept, columns)]
        if not len(columns[0]):
            continue
        ends = np.flatnonzero((np.diff(columns[0]) != 0) | (np.diff(columns[1]) != 0)) + 1
        starts = [0, *ends.tolist()]
        for start, end in zip(starts, starts[1:]):
            if end - start > 1:
                yield [column[start:end] for column in columns[2:]]
        kept = [column[starts[-1]:] for column in columns]
    if kept is not None and len(kept[0]) > 1:
        yield kept[2:]


# Operators

def near_duplicates(docs: DataFrame, radius: int = 4, words: int = 4, seed: int = 42, id_column: str = "doc_id",
                    text_column: str = "text") -> DataFrame:
    """The id, ``fingerprint`` and ``component_id`` of every row.

    Rows are linked when their fingerprints differ in at most ``radius`` bits; ``component_id`` is the smallest id that
    a row reaches over links. A missing or empty text has fingerprint 0 and is linked like any other. Rows with equal
    ids are rows of their own; a component whose ids are all missing has no id. An empty table gives no rows.
    """
    rows = staged(fingerprints(docs, words, seed, id_column, text_column), "fingerprints")
    classes = staged(rows.groupBy("fingerprint").agg(F.min(id_column).alias("first_id")), "classes")
    edges = links(classes.select(F.col("fingerprint").alias("node"), F.array("fingerprint").alias("prints")), radius)
    labels = components(edges).withColumnRenamed("node", "fingerprint")
    rooted = classes.join(labels, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = shuffled(rooted).join(least, "root").select("fingerprint", "component_id")
    return shuffled(rows).join(named, "fingerprint").select(id_column, "fingerprint", "component_id")
