"""Nearest neighbours by inner product: inverted lists, scanned dimension by dimension with early abandoning.

A vector x is extended by sqrt(M - |x|^2), where M is the largest squared norm, and a query by 0: the largest inner
products are then the smallest distances. Extended vectors are rotated at random, so that any block of dimensions is a
fair sample of all. Lists are cells of centroids fitted to a bounded sample; every vector is in one list.

A query first scans its nearest lists, which gives it a distance that its neighbours must beat, then the rest of its
probed lists. In a list vectors lie in blocks of columns. After each block a hypothesis test compares the distance over
the dimensions seen, scaled up, with the distance to beat, and abandons what is too far even for a lucky sample. What is
left is scored exactly on the original vectors, in double precision.

Equal vectors form one class, which keeps its smallest ids only: no query can return more of them. Lists with many
vectors or queries are dealt out in slices and chunks, so no task holds more than one slice and one chunk.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitlake.session import staged

SLICE, CHUNK = 4096, 2048


@dataclass(frozen=True)
class Index:
    """Rotation and centroids, and the largest squared norm."""
    rotation: np.ndarray
    centroids: np.ndarray
    largest: float

    def place(self, vectors: np.ndarray, queries: bool = False) -> np.ndarray:
        last = np.zeros(len(vectors)) if queries else np.sqrt(np.maximum(0.0, self.largest - (vectors ** 2).sum(axis=1)))
        return np.column_stack([vectors, last]) @ self.rotation

    def distances(self, placed: np.ndarray) -> np.ndarray:
        """Squared distances to the centroids, less the placed vectors' own norms."""
        return (self.centroids ** 2).sum(axis=1) - 2 * placed @ self.centroids.T


def usable(vector: Column) -> Column:
    """Not missing, empty or zero, and without missing or non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def fit(classes: DataFrame, lists: int, sample: int, seed: int, rounds: int = 12) -> Index:
    """Fit centroids to at most ``sample`` vectors, those with the smallest hashes."""
    # A bound on the squared norms: summing in another order must not make a root negative, which place() sees to.
    largest = classes.agg(F.max(F.aggregate("vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x))).first()[0]
    taken = classes.orderBy(F.xxhash64("vector"), "vector").select("vector").limit(sample).toPandas()
    vectors = np.array(taken["vector"].tolist(), np.float64)
    draw = np.random.default_rng(seed)
    rotation = np.linalg.qr(draw.standard_normal((vectors.shape[1] + 1,) * 2))[0]
    placed = Index(rotation, np.zeros((1, 1)), largest).place(vectors)
    centroids = placed[draw.choice(len(placed), min(lists, len(placed)), replace=False)]
    for _ in range(rounds):
        nearest = Index(rotation, centroids, largest).distances(placed).argmin(axis=1)
        sizes = np.bincount(nearest, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, placed)
        centroids = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centroids)
    return Index(rotation, centroids, largest)


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def scan(index: Index, vectors: np.ndarray, queries: np.ndarray, beat: np.ndarray, k: int, block: int,
         significance: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query the rows and scores of its k best vectors; ``beat`` has squared distances that neighbours are within."""
    placed, wanted = index.place(vectors), index.place(queries, True)
    dims = placed.shape[1]
    cuts = [*range(0, dims, block), dims]
    blocks = [np.ascontiguousarray(placed[:, a:b]) for a, b in zip(cuts, cuts[1:])]
    head = blocks[0]
    # The first block is one matrix product for all queries.
    start = (head ** 2).sum(axis=1) + ((wanted[:, :head.shape[1]] ** 2).sum(axis=1)[:, None] - 2 * wanted[:, :head.shape[1]] @ head.T)
    results = []
    for query, seen, limit, original in zip(wanted, start, beat, queries):
        if len(vectors) > 4 * k and not np.isfinite(limit):
            # Without a distance to beat, that of the k-th of some promising vectors will do.
            some = np.argpartition(seen, 2 * k)[:2 * k]
            limit = np.partition(((placed[some] - query) ** 2).sum(axis=1), k - 1)[k - 1]
        alive, partial, used = np.arange(len(vectors)), seen, head.shape[1]
        for number in range(1, len(blocks) + 1):
            bound = limit * (used / dims) * (1 + significance / np.sqrt(used)) ** 2 if used < dims else limit * (1 + 1e-9) + 1e-9
            near = partial <= bound
            alive, partial = alive[near], partial[near]
            if number == len(blocks) or not len(alive):
                break
            part = blocks[number]
            partial = partial + ((part[alive] - query[used:used + part.shape[1]]) ** 2).sum(axis=1)
            used += part.shape[1]
        if len(alive) > k:
            # Distances here and scores below are rounded differently, so what is about as near as the k-th stays too.
            kth = np.partition(partial, k - 1)[k - 1]
            alive = alive[partial <= kth * (1 + 1e-9) + 1e-9]
        results.append((alive, (vectors[alive] * original).sum(axis=1)))
    return results


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, probe: float = 0.6, least_probed: int = 2000,
            sample: int = 16384, max_lists: int = 4096, first_lists: int = 6, block: int = 16, significance: float = 2.1,
            seed: int = 7, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``query_id``, ``rank`` (from 1), the neighbour's id and ``score`` (inner product in double precision).

    Queries are the rows for which ``is_query`` holds; candidates are all rows with another id. A query probes the share
    ``probe`` of all lists, and more until it has seen ``least_probed`` vectors, so small tables are searched whole. Ties go
    to the smaller id. Unusable vectors (see ``usable``), those of another length than the most frequent one, and rows
    without id take no part. Rows with equal id and vector count once. Other columns are left out.
    """
    rows = vectors.select(F.col(id_column).alias("id"), F.col(vector_column).alias("vector"), is_query.alias("asks")).filter(
        usable(F.col("vector")) & F.col("id").isNotNull())
    usual = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    rows = rows.filter(F.size("vector") == (usual["size"] if usual else 0)).dropDuplicates(["id", "vector"])
    by_vector = Window.partitionBy("vector").orderBy("id")
    classes = staged(rows.withColumn("number", F.row_number().over(by_vector)).filter(F.col("number") <= k + 1)
                     .groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids")), "classes")
    amount = classes.count()
    empty = f"query_id long, rank int, {id_column} long, score double"
    if not amount:
        return vectors.sparkSession.createDataFrame([], empty)
    index = fit(classes, max(1, min(max_lists, round(amount ** 0.5 / 2))), sample, seed)
    listed = staged(classes.mapInArrow(lambda batches: _listed(batches, index), _fields(classes, "list int, slice_key long")), "lists")
    sizes = np.zeros(len(index.centroids), np.int64)
    for number, size in listed.groupBy("list").count().collect():  # as many rows as lists, which are bounded
        sizes[number] = size
    asked = rows.filter("asks").select("id", "vector", F.xxhash64("id", "vector").alias("query"))
    probes = staged(asked.mapInArrow(lambda batches: _probes(batches, index, sizes, probe, least_probed),
                                     _fields(asked, "list int, turn int")), "probes")
    scan_ = _Scan(index, sizes, k, block, significance)
    early = staged(scan_.run(listed, probes.filter(F.col("turn") < first_lists).withColumn("beat", F.lit(float("inf")))), "early")
    best = Window.partitionBy("query").orderBy(F.desc("score"))
    beat = (early.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") == k + 1)
            .select("query", F.col("score").alias("kth")))
    late = probes.filter(F.col("turn") >= first_lists).join(beat, "query", "left")
    length = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x)
    late = late.withColumn("beat", F.coalesce(length + index.largest - 2 * F.col("kth"), F.lit(float("inf")))).drop("kth")
    found = early.unionByName(scan_.run(listed, late))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    return (found.select("query", "query_id", "score", F.explode("ids").alias("id")).filter("id <> query_id")
            .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", F.col("id").alias(id_column), "score"))


def _fields(frame: DataFrame, more: str) -> str:
    return ", ".join([*(f"`{name}` {kind}" for name, kind in frame.dtypes), more])


def _listed(batches, index):
    for batch in batches:
        if batch.num_rows:
            nearest_list = index.distances(index.place(matrix(batch.column(0)))).argmin(axis=1)
            first_ids = [ids[0] for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(nearest_list, pa.int32()), pa.array(first_ids, pa.int64())],
                names=[*batch.schema.names, "list", "slice_key"])


def _probes(batches, index, sizes, probe, least_probed):
    share = max(1, round(probe * len(sizes)))
    for batch in batches:
        if not batch.num_rows:
            continue
        order = np.argsort(index.distances(index.place(matrix(batch.column(1)), True)), axis=1, kind="stable")
        enough = (np.cumsum(sizes[order], axis=1) < least_probed).sum(axis=1) + 1
        counts = np.minimum(np.maximum(enough, share), len(sizes))
        rows = np.repeat(np.arange(len(counts)), counts)
        turns = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
        for at in range(0, len(rows), 8192):
            part = slice(at, at + 8192)
            taken = pa.Table.from_batches([batch]).take(pa.array(rows[part])).combine_chunks()
            lists = order[rows[part], turns[part]]
            yield pa.RecordBatch.from_arrays(
                [*(column.combine_chunks() for column in taken.columns), pa.array(lists, pa.int32()),
                 pa.array(turns[part], pa.int32())], names=[*batch.schema.names, "list", "turn"])


class _Scan:
    """Meets queries and vectors of a list by slice and chunk."""

    def __init__(self, index, sizes, k, block, significance):
        self.index, self.k, self.block, self.significance = index, k, block, significance
        self.slices = [max(1, -(-int(size) // SLICE)) for size in sizes]

    def run(self, listed: DataFrame, probes: DataFrame) -> DataFrame:
        counts = {row["list"]: -(-row["count"] // CHUNK) for row in probes.groupBy("list").count().collect()}
        slices = F.array(*map(F.lit, self.slices))[F.col("list")]
        chunks = F.array(*[F.lit(counts.get(number, 0)) for number in range(len(self.slices))])[F.col("list")]
        cells = ["list", "slice", "chunk"]
        left = (probes.withColumn("chunk", F.pmod("query", chunks).cast("int"))
                .withColumn("slice", F.explode(F.sequence(F.lit(0), slices - 1)))
                .select(*cells, "query", F.col("id").alias("query_id"), "vector", "beat"))
        right = (listed.filter(chunks > 0).withColumn("slice", F.pmod(F.xxhash64("slice_key"), slices).cast("int"))
                 .withColumn("chunk", F.explode(F.sequence(F.lit(0), chunks - 1))).select(*cells, "vector", "ids"))
        index, k, block, significance = self.index, self.k + 1, self.block, self.significance

        def meet(queries: pa.Table, vectors: pa.Table) -> pa.Table:
            keys, ids, asked, found, scores = queries["query"], queries["query_id"], [], [], []
            if queries.num_rows and vectors.num_rows:
                results = scan(index, matrix(vectors["vector"]), matrix(queries["vector"]), queries["beat"].to_numpy(), k,
                               block, significance)
                for number, (rows, values) in enumerate(results):
                    asked.append(np.full(len(rows), number))
                    found.append(rows)
                    scores.append(values)
            asked, found = (np.concatenate([*parts, np.zeros(0, np.int64)]).astype(np.int64) for parts in (asked, found))
            return pa.table({"query": keys.take(asked), "query_id": ids.take(asked), "ids": vectors["ids"].take(found),
                             "score": np.concatenate([*scores, np.zeros(0)])})

        return left.groupBy(*cells).cogroup(right.groupBy(*cells)).applyInArrow(
            meet, "query long, query_id long, ids array<long>, score double")
