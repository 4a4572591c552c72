"""One document of each group of near-duplicates: covering SimHash, completed by an exact prefix join.

Fingerprints of the sets of words, linked by covering locality-sensitive hashing, join most near copies; each link is held
against the sets of runs of words. Fingerprints miss texts to which a passage was added or from which one was cut. A
prefix join finds those: in any one order of all runs, two texts with a share ``s`` of their runs in common have one of
their first ``n - ceil(s n) + 1`` runs in common.

The order is by the number of texts that have a run, counted over all texts. A run of one text alone leads to nobody, so
a text with enough runs of its own, as nearly all have, is done without being compared; passages that many texts share come
last and are reached by the few texts only that consist of them. For the counts each text's runs are dealt to buckets by
hash: four bytes a run and two for the text's place in its flush. A bucket gives back the shared runs only, to the
flush, where prefixes are cut. Runs that a bounded sample shows in very many texts are never dealt out; they come last in
the order, by a broadcast list of bounded size.

Full sets of runs are made again from the texts, for those texts only that have a link to be held against them.
"""

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlake.llm.batches import frugal, slices
from visitlake.llm.columns import let
from visitlake.llm.components import components
from visitlake.llm.covering_simhash import links, runs, search, simhash, words_of
from visitlake.session import shuffled, staged

TILE, TILE_RUNS = 1024, 1024
# A flush is bounded in runs and in texts, whose places in it take two bytes.
FLUSH_RUNS, FLUSH_TEXTS = 1 << 19, 1 << 16
BUCKET_RUNS, MOST_BUCKETS = 1 << 19, 1 << 17
# Runs are taken for widespread if so many texts of a sample of about so many runs have them.
SAMPLED_RUNS, WIDESPREAD = 2_000_000, 24
WORDS_KEPT = 150_000
# A filter of chosen texts has so many bits at most. Texts that pass it by chance only cost time.
FILTER_BITS = 1 << 28
# The same for the filter of texts that do not stay, which tasks read as one value.
STOPPED_BITS = 1 << 26
SET_BYTES = 8 << 20


# Words and runs

class WordHashes(dict):
    """Hashes of the words seen; forgotten when there are many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


def word_digest(words: list[bytes]) -> int:
    """What texts with the same words in the same order share; signed 64-bit."""
    return int.from_bytes(hashlib.blake2b(b" ".join(words), digest_size=8).digest(), "big", signed=True)


def run_set(words: list[bytes], size: int, hashes: WordHashes) -> np.ndarray:
    """The sorted set of hashes of all runs of ``size`` words; fewer words, or none, are one run."""
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), 1)], np.uint64)
    found = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    many = len(found) - size + 1
    total = np.zeros(many, np.uint64)
    for place in range(size):
        # Each place in the run multiplies by an odd number of its own and mixes the bits.
        total = (total ^ found[place:place + many]) * np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(29)
    return np.unique(total)


def prefix_size(length, similarity: float):
    """So many first runs of sets of the given sizes have one in common with those of any similar set."""
    return length - np.ceil(similarity * length - 1e-6).astype(np.int64) + 1


# Operator

def drop_near_duplicates(docs: DataFrame, radius: int = 4, prints: int = 1, words: int = 5, similarity: float = 0.8,
                         tile: int = TILE, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Keep one row, that with the smallest id, of each group of near-duplicate texts; all columns are kept, whatever their names.

    Two texts are linked if at least ``similarity`` of their runs of ``words`` words, without repeats, are common to both.
    Groups are what links connect; every link counts. Missing and empty texts, and all others without words, are copies of
    each other. Of rows with the same smallest id, or all without id, one stays. An empty table gives no rows.
    """
    # The row is nested, so its columns' names cannot clash with those made here.
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns])
    identity = F.col(f"`{id_column}`")
    text = F.col(f"`{text_column}`").cast("string")
    key = F.struct(identity.isNull().alias("no_id"), identity.alias("id"), F.xxhash64(text).alias("text"))
    named = docs.select(key.alias("key"), text.cast("binary").alias("text"), row.alias("row"))
    hashed = named.select(F.xxhash64("key").alias("hash"), "text")

    texts = staged(_texts(named.select("key", "text"), prints, words), "texts")
    classes = staged(texts.groupBy("node").agg(F.min("key").alias("key"), F.first("prints").alias("prints"), F.max("runs").alias("runs")),
                     "classes")
    chosen = lambda nodes: classes.join(shuffled(nodes.select("node")), "node", "left_semi")
    clusters = staged(components(links(classes.select("node", "prints"), radius)), "clusters")
    clusters = clusters.join(classes.select("node", "runs"), "node")
    edges = staged(_similar(clusters, _sets(hashed, chosen(clusters), words), similarity, tile), "similar")
    roots = components(edges)
    members = staged(_prefixes(hashed, classes, words, similarity), "prefixes")
    # Only runs that texts of different groups have in their prefixes are looked at. Neighbours by size are compared first: that
    # joins most of a large group, and what is joined is not listed as pairs afterwards.
    for neighbours in (True, False):
        pairs = staged(_prefix_pairs(members, roots, similarity, tile, neighbours), "pairs")
        if pairs.isEmpty():
            continue
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        more = staged(_verified(pairs, _sets(hashed, chosen(wanted), words), similarity), "similar")
        if more.isEmpty():
            continue
        edges = edges.unionByName(more)
        roots = components(edges)
    rooted = classes.select("node", "key").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    kept = rooted.groupBy("root").agg(F.min("key").alias("key")).select("key")
    return _first_rows(named.select("key", "row"), texts.select("key"), staged(kept, "kept")).select(
        [F.col("row")[name].alias(name) for name in docs.columns])


def _first_rows(rows: DataFrame, keys: DataFrame, kept: DataFrame) -> DataFrame:
    """One row of each kept key. Rows that a filter of dropped and of repeated keys does not stop stay as they are; those that
    it stops, few unless the filter is full, are shuffled to a join with the kept keys."""
    counted = keys.groupBy("key").agg(F.count("*").alias("rows"))
    stopped = staged(shuffled(counted).join(kept.withColumn("kept", F.lit(True)), "key", "left")
                     .filter("kept IS NULL OR rows > 1").select(F.xxhash64("key").alias("hash")), "stopped")
    bits = 1 << 10
    while bits < min(16 * stopped.count(), STOPPED_BITS):
        bits *= 2
    place = lambda hashed: hashed.bitwiseAND(F.lit(bits - 1))
    bit = lambda hashed: F.call_function("shiftleft", F.lit(1).cast("long"), hashed.bitwiseAND(F.lit(63)).cast("int"))
    filled = stopped.select(F.shiftright(place(F.col("hash")), 6).alias("at"), bit(F.col("hash")).alias("word")).unionByName(
        rows.sparkSession.range(bits // 64).select(F.col("id").alias("at"), F.lit(0).cast("long").alias("word")))
    words = (filled.groupBy("at").agg(F.bit_or("word").alias("word"))
             .agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("rows")).select(F.transform("rows", lambda one: one["word"]))).scalar()
    hashed = F.xxhash64("key")
    stops = words[F.shiftright(place(hashed), 6).cast("int")].bitwiseAND(bit(hashed)) != 0
    checked = shuffled(rows.filter(stops)).join(kept, "key", "left_semi").groupBy("key").agg(F.first("row").alias("row"))
    return rows.filter(~stops).select("row").unionByName(checked.select("row"))


def _texts(named: DataFrame, prints: int, words: int) -> DataFrame:
    """``key``, ``node`` (shared by equal sequences of words), ``prints`` over the set of words, ``runs`` (their number, or more)."""
    def run(batches):
        for batch in slices(batches, 1):
            nodes, found, counts = [], [], []
            for text in batch.column(1).to_pylist():
                own = words_of(text)
                different = sorted(set(own))
                nodes.append(word_digest(own))
                found.append([simhash([np.fromiter((xxhash.xxh64_intdigest(word, seed) for word in different), np.uint64, len(different))])
                              for seed in range(prints)])
                counts.append(max(1, len(own) - words + 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(nodes, pa.int64()), pa.array(found, pa.list_(pa.int64())), pa.array(counts, pa.int64())],
                names=["key", "node", "prints", "runs"])

    kind = named.schema["key"].dataType.simpleString()
    return named.mapInArrow(frugal(run), f"key {kind}, node long, prints array<long>, runs long")


# Chosen texts

def _filter_of(classes: DataFrame) -> tuple[np.ndarray, int]:
    """A bitmap of the hashes of the classes' keys and its number of bits, 16 for each key and at most ``FILTER_BITS``."""
    bits = 1 << 10
    while bits < min(16 * classes.count(), FILTER_BITS):
        bits *= 2
    place = F.xxhash64("key").bitwiseAND(F.lit(bits - 1))
    filled = classes.select(place.alias("place")).groupBy(F.shiftright("place", 6).alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(place & 63 AS INT))")).alias("word")).toArrow()
    words = np.zeros(bits // 64, np.int64)
    words[filled.column("at").to_numpy()] = filled.column("word").to_numpy()
    return words.view(np.uint64), bits


def _passing(batches, shared):
    """Texts, as words, of the rows that pass the filter."""
    words, bits = shared.value
    for batch in batches:
        place = batch.column(0).to_numpy().view(np.uint64) & np.uint64(bits - 1)
        passes = (words[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
        for at in np.flatnonzero(passes).tolist():
            yield words_of(batch.column(1)[at].as_py())


def _sets(hashed: DataFrame, classes: DataFrame, words: int) -> DataFrame:
    """``node`` and ``shingles``, the sorted set of its runs, once for each of the classes, and for a few other texts."""
    shared = hashed.sparkSession.sparkContext.broadcast(_filter_of(classes))

    def run(batches):
        hashes, nodes, sets, held = WordHashes(), [], [], 0
        for own in _passing(batches, shared):
            nodes.append(word_digest(own))
            sets.append(run_set(own, words, hashes).view(np.int64))
            held += sets[-1].nbytes
            if held >= SET_BYTES // 4:
                yield _set_batch(nodes, sets)
                nodes, sets, held = [], [], 0
        yield _set_batch(nodes, sets)

    found = hashed.mapInArrow(frugal(run), "node long, shingles array<long>")
    return staged(found.groupBy("node").agg(F.first("shingles").alias("shingles")), "sets")


def _set_batch(nodes, sets) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=["node", "shingles"])


# Links within clusters

def _tiles(size, tile: int):
    """The slice pairs of its group that a member takes part in: each two slices of ``tile`` members meet in one."""
    slices = F.ceil(size / tile).cast("int")
    own = F.pmod(F.xxhash64("node"), slices).cast("int")
    pairs = F.when(slices == 1, F.array(F.lit(0))).otherwise(F.transform(
        F.filter(F.sequence(F.lit(0), slices - 1), lambda other: other != own),
        lambda other: F.least(own, other) * slices + F.greatest(own, other)))
    return own, pairs


def _similar(clusters: DataFrame, sets: DataFrame, similarity: float, tile: int) -> DataFrame:
    """Edges between nodes of the same cluster whose sets of runs are similar enough, by slices of large clusters.

    A slice has about ``tile`` texts, or fewer where they have more than ``TILE_RUNS`` runs each.
    """
    sizes = clusters.groupBy("root").agg(F.greatest(F.count("*"), F.ceil(F.sum("runs") / TILE_RUNS)).alias("size"))
    tiles = clusters.join(sizes, "root").select("node", "root", F.explode(_tiles(F.col("size"), tile)[1]).alias("tile"))
    tiles = shuffled(tiles).join(sets, "node").select("root", "tile", "node", "shingles")

    def run(batches):
        for nodes, shingles in runs(batches):
            lengths = np.fromiter(map(len, shingles), np.int64, len(shingles))
            ends = np.cumsum(lengths)
            _, places = np.unique(np.concatenate(shingles), return_inverse=True)
            marked = np.zeros(places.max() + 1, bool)

            def near(i, left):
                own_places = places[ends[i] - lengths[i]:ends[i]]
                marked[own_places] = True
                # Sizes alone rule out most texts that are not similar.
                fits = np.minimum(lengths[left], lengths[i]) >= similarity * np.maximum(lengths[left], lengths[i])
                result = np.zeros(len(left), bool)
                for at in np.flatnonzero(fits):
                    node = left[at]
                    common = np.count_nonzero(marked[places[ends[node] - lengths[node]:ends[node]]])
                    result[at] = common >= similarity * (lengths[i] + lengths[node] - common)
                marked[own_places] = False
                return result

            edges = search(nodes, near)
            if edges:
                a, b = zip(*edges)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return (tiles.repartition("root", "tile").sortWithinPartitions("root", "tile")
            .mapInArrow(frugal(run), "a long, b long").distinct())


# Prefixes

DEALT = "bucket int, flush long, head boolean, one binary, two binary, three binary"


def _prefixes(hashed: DataFrame, classes: DataFrame, words: int, similarity: float) -> DataFrame:
    """``node``, ``length`` (of its set), ``place`` and ``shingle`` of the runs in prefixes that more than one text has."""
    spark = hashed.sparkSession
    total = classes.agg(F.coalesce(F.sum("runs"), F.lit(0))).first()[0]
    buckets = 1
    while buckets < min(total / BUCKET_RUNS, MOST_BUCKETS):
        buckets *= 2
    chosen = spark.sparkContext.broadcast(_filter_of(classes))
    common = spark.sparkContext.broadcast(_widespread(hashed, classes, total, words))
    dealt = hashed.mapInArrow(frugal(lambda batches: _dealt(batches, chosen, common, words, similarity, buckets)), DEALT)
    shared = (dealt.repartition(max(buckets, 1), "bucket").sortWithinPartitions("bucket").mapInArrow(frugal(_shared_runs), DEALT))
    found = (shared.repartition("flush").sortWithinPartitions("flush", "head")
             .mapInArrow(frugal(lambda batches: _cut(batches, similarity)), "node long, length long, place long, shingle long"))
    return found.dropDuplicates(["node", "shingle"])


def _widespread(hashed: DataFrame, classes: DataFrame, total: int, words: int) -> np.ndarray:
    """Hashes of runs in the order of their texts in a sample, for runs that ``WIDESPREAD`` of its texts have. At most
    ``SAMPLED_RUNS / WIDESPREAD`` are expected. Any list gives right results; it only decides which runs come last."""
    share = 1 + total // SAMPLED_RUNS
    some = classes.filter(F.pmod(F.xxhash64("node"), F.lit(share)) == 0)
    counted = _sets(hashed, some, words).join(some.select("node"), "node", "left_semi").select(F.explode("shingles").alias("shingle"))
    found = counted.groupBy("shingle").agg(F.count("*").alias("texts")).filter(F.col("texts") >= WIDESPREAD).toArrow()
    found = found.sort_by([("texts", "ascending"), ("shingle", "ascending")])
    return found.column("shingle").to_numpy().view(np.uint64)


class _Flush:
    def __init__(self):
        self.nodes, self.lengths, self.plain, self.lasts, self.runs, self.owners, self.held = {}, [], [], [], [], [], 0


def _dealt(batches, chosen, common, words, similarity, buckets):
    """For each flush, its runs by bucket, and a head row that passes a bucket untouched: nodes, sizes of sets, runs that are
    not widespread, and the widespread runs that a prefix reaches."""
    widespread = common.value
    by_hash = np.argsort(widespread, kind="stable")
    ordered = widespread[by_hash]
    number, hashes, flush = TaskContext.get().partitionId() << 24, WordHashes(), _Flush()
    for own in _passing(batches, chosen):
        node = word_digest(own)
        if node in flush.nodes:
            continue
        found = run_set(own, words, hashes)
        flush.nodes[node] = place = len(flush.nodes)
        flush.lengths.append(len(found))
        last = np.zeros(0, np.int64)
        if len(ordered):
            at = np.minimum(np.searchsorted(ordered, found), len(ordered) - 1)
            is_last = ordered[at] == found
            last, found = np.sort(by_hash[at[is_last]]), found[~is_last]
        flush.plain.append(len(found))
        reached = max(0, int(prefix_size(np.array(flush.lengths[-1]), similarity)) - len(found))
        flush.lasts.append(widespread[last[:reached]])
        flush.runs.append(found)
        flush.owners.append(np.full(len(found), place, np.uint16))
        flush.held += len(found)
        if flush.held >= FLUSH_RUNS or len(flush.nodes) == FLUSH_TEXTS:
            yield _flushed(flush, number, buckets)
            number, flush = number + 1, _Flush()
    if flush.nodes:
        yield _flushed(flush, number, buckets)


def _flushed(flush: _Flush, number: int, buckets: int) -> pa.RecordBatch:
    found, owners = np.concatenate(flush.runs), np.concatenate(flush.owners)
    # The lower half of a hash is a run's name in its bucket, the upper half chooses the bucket.
    bucket = (found >> np.uint64(32)) % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    bucket, names, owners = bucket[order], (found[order] & np.uint64(0xFFFFFFFF)).astype(np.uint32), owners[order]
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.zeros(0, np.int64)
    ends = np.r_[starts[1:], len(bucket)] if len(bucket) else starts
    rows = [(int(bucket[a]), number, False, names[a:b].tobytes(), owners[a:b].tobytes(), b"") for a, b in zip(starts, ends)]
    sizes = np.array([flush.lengths, flush.plain, [len(last) for last in flush.lasts]], np.int64)
    nodes = np.fromiter(flush.nodes, np.int64, len(flush.nodes))
    rows.append((number % buckets, number, True, nodes.tobytes(), sizes.tobytes(), np.concatenate(flush.lasts).astype(np.uint64).tobytes()))
    return _dealt_batch(rows)


def _dealt_batch(rows) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), pa.bool_(), pa.binary(), pa.binary(), pa.binary()]
    columns = zip(*rows) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(values, kind) for values, kind in zip(columns, kinds)],
                                      names=["bucket", "flush", "head", "one", "two", "three"])


def _grouped(batches, column: int):
    """Rows, as lists, of each run of equal numbers in a column of a sorted stream."""
    last, held = None, []
    for batch in batches:
        for row in zip(*(one.to_pylist() for one in batch.columns)):
            if row[column] != last and held:
                yield last, held
                held = []
            last = row[column]
            held.append(row)
    if held:
        yield last, held


def _shared_runs(batches):
    """Of each bucket, the runs of more than one text with their counts, by flush; head rows as they are."""
    for bucket, rows in _grouped(batches, 0):
        heads, parts = [row for row in rows if row[2]], [row for row in rows if not row[2]]
        if heads:
            yield _dealt_batch(heads)
        if not parts:
            continue
        names = np.concatenate([np.frombuffer(row[3], np.uint32) for row in parts])
        owners = np.concatenate([np.frombuffer(row[4], np.uint16) for row in parts])
        part = np.repeat(np.arange(len(parts)), [len(row[3]) // 4 for row in parts])
        order = np.argsort(names, kind="stable")
        names, owners, part = names[order], owners[order], part[order]
        starts = np.flatnonzero(np.r_[True, names[1:] != names[:-1]])
        counts = np.repeat(np.diff(np.r_[starts, len(names)]), np.diff(np.r_[starts, len(names)]))
        kept = counts > 1
        names, owners, part, counts = names[kept], owners[kept], part[kept], counts[kept]
        by_part = np.argsort(part, kind="stable")
        bounds = np.searchsorted(part[by_part], np.arange(len(parts) + 1))
        found = []
        for place, row in enumerate(parts):
            at = by_part[bounds[place]:bounds[place + 1]]
            if len(at):
                found.append((bucket, row[1], False, names[at].tobytes(), owners[at].tobytes(), counts[at].astype(np.int64).tobytes()))
        if found:
            yield _dealt_batch(found)


def _cut(batches, similarity):
    """Prefixes of the texts of each flush, without the runs of one text alone, which come first."""
    for _, rows in _grouped(batches, 1):
        head, parts = next(row for row in rows if row[2]), [row for row in rows if not row[2]]
        nodes = np.frombuffer(head[3], np.int64)
        lengths, plain, reached = np.frombuffer(head[4], np.int64).reshape(3, -1)
        first = prefix_size(lengths, similarity)
        found = []
        if parts:
            owners = np.concatenate([np.frombuffer(row[4], np.uint16) for row in parts]).astype(np.int64)
            counts = np.concatenate([np.frombuffer(row[5], np.int64) for row in parts])
            named = np.concatenate([np.frombuffer(row[3], np.uint32).astype(np.int64) | row[0] << 32 for row in parts])
            order = np.lexsort((named, counts, owners))
            owners, named = owners[order], named[order]
            many = np.bincount(owners, minlength=len(nodes))
            rank = np.arange(len(owners)) - (np.cumsum(many) - many)[owners]
            place = (plain - many)[owners] + rank
            kept = place < first[owners]
            found.append((owners[kept], place[kept], named[kept]))
        owners = np.repeat(np.arange(len(nodes)), reached)
        place = plain[owners] + np.arange(len(owners)) - np.repeat(np.cumsum(reached) - reached, reached)
        # Names of widespread runs are negative, so that they are never those of others.
        named = (np.frombuffer(head[5], np.uint64) | np.uint64(1 << 63)).view(np.int64)
        found.append((owners, place, named))
        owners, place, named = (np.concatenate(column) for column in zip(*found))
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes[owners]), pa.array(lengths[owners]), pa.array(place), pa.array(named)],
            names=["node", "length", "place", "shingle"])


# Pairs

def _prefix_pairs(members: DataFrame, roots: DataFrame, similarity: float, tile: int, neighbours: bool) -> DataFrame:
    """Pairs of nodes of different groups that share a run where enough of both is left behind it."""
    rooted = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    shared = (rooted.groupBy("shingle").agg(F.count("*").alias("size"), F.min("root").alias("least"), F.max("root").alias("most"))
              .filter("least <> most").select("shingle", "size"))
    own, pairs = _tiles(F.col("size"), tile)
    tiles = rooted.join(shared, "shingle").select(
        "shingle", F.explode(F.array(own) if neighbours else pairs).alias("tile"), "node", "root", "length", "place")

    def run(batches):
        for nodes, components_, lengths, places in runs(batches):
            if (components_ == components_[0]).all():
                continue
            order, chosen = np.lexsort((nodes, lengths)), []
            nodes, components_, lengths, left = nodes[order], components_[order], lengths[order], (lengths - places)[order]
            # Sizes rise, so the partners that are not too long are a range.
            longest = np.searchsorted(lengths, lengths / similarity + 1e-6, "right")
            for i in range(len(nodes) - 1):
                others = slice(i + 1, i + 2 if neighbours else longest[i])
                # At the first run that two sets share, all others that they share are behind it.
                fits = (np.minimum(left[i], left[others]) * (1 + similarity)
                        >= similarity * (lengths[i] + lengths[others]) - 1e-6) & (components_[others] != components_[i])
                found = nodes[others][fits]
                chosen.append((np.minimum(found, nodes[i]), np.maximum(found, nodes[i])))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(part)) for part in zip(*chosen)], names=["a", "b"])

    return (tiles.repartition("shingle", "tile").sortWithinPartitions("shingle", "tile")
            .mapInArrow(frugal(run), "a long, b long").distinct())


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose sets of runs are similar enough."""
    both = (shuffled(pairs).join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("first")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("second")), "b"))
    enough = let(F.size(F.array_intersect("first", "second")),
                 lambda common: common >= similarity * (F.size("first") + F.size("second") - common))
    return both.filter(enough).select("a", "b")
