"""The prefix trie of conversations, by splitters and their skeleton.

A conversation is a path of turns, written as one fixed digest per turn, so paths in byte order are the trie in depth-first
order. Splitters, drawn from a sample of paths with their ids, divide this order into shards. A node whose conversations
lie in several shards is a prefix of a splitter between them: the trie of the splitters' paths, the skeleton, holds all
such nodes, is bounded, and is broadcast. Each sorted shard finishes all other nodes by itself in one pass with a stack,
and gives partial aggregates of the skeleton nodes it meets. Those are reduced over shards, and sums over subtrees of the
skeleton complete them.

Equal conversations, however many, are divided by their ids. A shard is read as a stream: a task holds the open nodes,
finished nodes that wait for their parent, and one conversation's digests (24 bytes a turn, never its texts).
"""

import bisect
import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlake.session import staged

# Bytes of a turn in a path.
TURN = 16
# Splitters and sampled paths are cut after so many turns, which leaves their place in the order sound.
SPLITTER_TURNS = 64
SAMPLED_BYTES = 24 << 20
SKELETON_NODES = 1 << 17
SHARD_TURNS = 1 << 19
ROWS_AT_ONCE = 20_000
ENDS_AT_ONCE = 8192
NO_ENDS = hashlib.sha256(b"").hexdigest()

# Rows of a pass over shards: finished nodes, partial aggregates of skeleton nodes, ids that end at skeleton nodes.
NODE, PARTIAL, ENDS = 0, 1, 2
FIELDS = [
    ("kind", pa.int32()), ("skeleton", pa.int32()), ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()),
    ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()),
    ("ends_sha256", pa.string()), ("shard", pa.int32()), ("piece", pa.int32()), ("ends", pa.binary())]
SCHEMA = ("kind int, skeleton int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
          "saved_tokens long, ends_sha256 string, shard int, piece int, ends binary")


# Paths

def turns_of(rows: DataFrame, id_column: str = "conv_id", order_column: str = "turn") -> DataFrame:
    """``conv_id`` and ``turns`` (arrays of ``digest`` in hex and ``chars``) of the conversations of rows with ``role`` and ``text``.

    Turns are in order, missing ones first; ties go by role and then by digest. A missing role or text is empty.
    ``chars`` are the code points of the text. Rows without id belong to no conversation. Texts are not shuffled.
    """
    role, text = (F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")) for name in ("role", "text"))
    digest = F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * TURN)
    turn = F.struct(F.col(f"`{order_column}`").alias("turn"), role.alias("role"), digest.alias("digest"), F.length(text).alias("chars"))
    found = rows.filter(F.col(f"`{id_column}`").isNotNull()).select(F.col(f"`{id_column}`").cast("long").alias("conv_id"), turn.alias("turn"))
    listed = found.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return listed.select("conv_id", F.transform("turns", lambda one: F.struct(one["digest"], one["chars"])).alias("turns"))


def prefix_trie(conversations: DataFrame, shard_turns: int = SHARD_TURNS, shards: int | None = None,
                skeleton_nodes: int = SKELETON_NODES) -> DataFrame:
    """One row per node of the trie of ``conversations``, which has ``conv_id`` (once each) and ``turns`` as in ``turns_of``.

    A node is a distinct sequence of first turns; the root is the empty one and is there if any conversation is. Columns, all
    long: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (the parent's, missing for the root), ``n_convs``
    (members), ``n_children``, ``n_leaves`` (childless nodes below or at it), ``saved_tokens`` (over it and all below, members
    but one times the code points of the last turn), and ``ends_sha256`` (hex digest of the ids of members without further turns,
    rising, with commas between). Conversations without turns end at the root. An empty table gives no rows.

    ``shards`` defaults to the session's shuffle partitions, and to more where a shard would have over ``shard_turns`` turns.
    """
    spark = conversations.sparkSession
    hexed = F.array_join(F.transform("turns", lambda one: one["digest"]), "")
    paths = staged(conversations.select(
        "conv_id", F.unhex(hexed).alias("path"), F.transform("turns", lambda one: one["chars"].cast("int")).alias("chars")), "paths")
    skeleton = _skeleton(paths, shard_turns, shards or 0, skeleton_nodes)
    shared = spark.sparkContext.broadcast(skeleton)
    sharded = paths.mapInArrow(lambda batches: _with_shard(batches, shared), "shard int, conv_id long, path binary, chars array<int>")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    in_order = (sharded.repartition(max(tasks, len(skeleton.splitters) // 4), "shard")
                .sortWithinPartitions("shard", "path", "conv_id"))
    found = staged(in_order.mapInArrow(lambda batches: _shard_rows(batches, shared), SCHEMA), "trie")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    whole = staged(_reduced(spark, found, skeleton), "skeleton")
    # Children of skeleton nodes take its smallest member from the bounded table of the skeleton.
    of_parent = whole.select("skeleton", F.col("conv_id").alias("of_skeleton"))
    local = (found.filter(F.col("kind") == NODE).join(of_parent, "skeleton", "left")
             .withColumn("parent_conv_id", F.coalesce("parent_conv_id", "of_skeleton")))
    return local.select(columns).unionByName(whole.select(columns))


# Splitters and their skeleton

@dataclass(frozen=True)
class Skeleton:
    """Splitters in order, and the nodes of their paths in depth-first order: number by path, parents, depths, code points,
    and the number after the last node below each."""

    splitters: list[tuple[bytes, int]]
    number: dict[bytes, int]
    parent: list[int]
    depth: list[int]
    chars: list[int]
    after: list[int]


def _skeleton(paths: DataFrame, shard_turns: int, shards: int, skeleton_nodes: int) -> Skeleton:
    """Splitters by quantiles of a sample of bounded size, weighed by turns, and fewer if their paths have too many nodes."""
    cut = SPLITTER_TURNS * TURN
    turns, rows, size = paths.agg(
        F.coalesce(F.sum(F.size("chars")), F.lit(0)), F.count("*"), F.coalesce(F.sum(F.least(F.octet_length("path"), F.lit(cut)) + 64), F.lit(0))).first()
    spark = paths.sparkSession
    wanted = shards or max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // shard_turns))
    chance = min(1.0, 32 * wanted / max(rows, 1), SAMPLED_BYTES / max(size, 1))
    draw = F.pmod(F.xxhash64(F.lit(13), "conv_id"), F.lit(1 << 30))
    some = paths.filter(draw < int(chance * (1 << 30)) + 1).select(
        F.substring("path", 1, cut).alias("path"), "conv_id", F.slice("chars", 1, SPLITTER_TURNS).alias("chars"), F.size("chars").alias("turns"))
    sample = sorted(((row["path"], row["conv_id"], row["chars"], row["turns"]) for row in some.collect()), key=lambda row: row[:2])
    weights = np.cumsum([1 + row[3] for row in sample]) if sample else np.zeros(0)
    while True:
        marks = np.arange(1, wanted) * (weights[-1] / wanted) if len(weights) else []
        chosen = sorted({int(place) for place in np.searchsorted(weights, marks)})
        made = _of_paths([sample[place] for place in chosen])
        if len(made.number) <= skeleton_nodes or wanted == 1:
            return made
        wanted = max(1, wanted // 2)


def _of_paths(rows: list) -> Skeleton:
    nodes = {b"": 0}
    for path, _, chars, _ in rows:
        for depth in range(1, len(path) // TURN + 1):
            nodes.setdefault(path[:TURN * depth], chars[depth - 1])
    order = sorted(nodes)
    number = {path: place for place, path in enumerate(order)}
    parent = [number[path[:-TURN]] if path else -1 for path in order]
    after = list(range(1, len(order) + 1))
    for place in reversed(range(1, len(order))):
        after[parent[place]] = max(after[parent[place]], after[place])
    return Skeleton([(path, conv_id) for path, conv_id, _, _ in rows], number, parent,
                    [len(path) // TURN for path in order], [nodes[path] for path in order], after)


def _with_shard(batches, shared):
    splitters = shared.value.splitters
    for batch in batches:
        keys = zip(batch.column(1).to_pylist(), batch.column(0).to_pylist())
        shard = pa.array([bisect.bisect_right(splitters, key) for key in keys], pa.int32())
        yield pa.RecordBatch.from_arrays([shard, *batch.columns], names=["shard", "conv_id", "path", "chars"])


# One pass over sorted shards

class _Open:
    """A node on the stack, with the finished nodes below it that wait for its smallest member."""

    __slots__ = ("skeleton", "chars", "least", "convs", "children", "leaves", "saved", "digest", "ends", "pieces", "waiting")

    def __init__(self, skeleton: int, chars: int):
        self.skeleton, self.chars, self.least = skeleton, chars, None
        self.convs = self.children = self.leaves = self.saved = self.pieces = 0
        self.digest, self.ends, self.waiting = None, [], []


class _Rows:
    def __init__(self):
        self.rows = []

    def add(self, kind, skeleton=None, conv_id=None, depth=None, parent=None, convs=None, children=None, leaves=None, saved=None,
            digest=None, shard=None, piece=None, ends=None):
        self.rows.append((kind, skeleton, conv_id, depth, parent, convs, children, leaves, saved, digest, shard, piece, ends))

    def take(self) -> pa.RecordBatch:
        columns = zip(*self.rows) if self.rows else [()] * len(FIELDS)
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(values, kind) for values, (_, kind) in zip(columns, FIELDS)],
                                          names=[name for name, _ in FIELDS])


def _shard_rows(batches, shared):
    skeleton = shared.value
    out, stack, last, last_shard = _Rows(), [], b"", None
    for batch in batches:
        for shard, conv_id, path, chars in zip(*(column.to_pylist() for column in batch.columns)):
            if shard != last_shard:
                while stack:
                    _close(stack, out, last_shard)
                stack, last, last_shard = [_Open(0, 0)], b"", shard
            common = _common_turns(last, path)
            while len(stack) > common + 1:
                _close(stack, out, shard)
            for depth in range(common + 1, len(path) // TURN + 1):
                # All nodes above one of the skeleton are in it as well.
                number = skeleton.number.get(path[:TURN * depth], -1) if stack[-1].skeleton >= 0 and depth <= SPLITTER_TURNS else -1
                stack.append(_Open(number, chars[depth - 1]))
            _end(stack[-1], conv_id, out, shard)
            last = path
            if len(out.rows) >= ROWS_AT_ONCE:
                yield out.take()
    while stack:
        _close(stack, out, last_shard)
    yield out.take()


def _common_turns(one: bytes, other: bytes) -> int:
    """Turns that both paths begin with."""
    low, high = 0, min(len(one), len(other)) // TURN
    while low < high:
        middle = (low + high + 1) // 2
        if one[TURN * low:TURN * middle] == other[TURN * low:TURN * middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _end(node: _Open, conv_id: int, out: _Rows, shard: int) -> None:
    """A conversation ends at the node. Those of one node come one after the other, by rising id."""
    node.convs += 1
    node.least = conv_id if node.least is None else min(node.least, conv_id)
    node.ends.append(conv_id)
    if len(node.ends) >= ENDS_AT_ONCE:
        _pass_ends(node, out, shard)


def _pass_ends(node: _Open, out: _Rows, shard: int) -> None:
    if node.ends:
        text = ",".join(map(str, node.ends)).encode()
        if node.skeleton >= 0:
            out.add(ENDS, node.skeleton, shard=shard, piece=node.pieces, ends=text)
        else:
            node.digest = node.digest or hashlib.sha256()
            node.digest.update(b"," * bool(node.pieces) + text)
        node.pieces, node.ends = node.pieces + 1, []


def _close(stack: list, out: _Rows, shard: int) -> None:
    """Take the deepest open node off the stack: as a partial aggregate if it is in the skeleton, else as a finished node."""
    node, depth = stack.pop(), len(stack)
    _pass_ends(node, out, shard)
    for conv_id, at, convs, children, leaves, saved, digest in node.waiting:
        in_skeleton = node.skeleton >= 0
        out.add(NODE, node.skeleton if in_skeleton else None, conv_id, at, None if in_skeleton else node.least, convs, children, leaves, saved, digest)
    above = stack[-1] if stack else None
    if node.skeleton >= 0:
        out.add(PARTIAL, node.skeleton, node.least, convs=node.convs, children=node.children, leaves=node.leaves, saved=node.saved)
        # The node's own share of the sums follows when its members are known; what is below it is passed up there.
        if above:
            above.convs += node.convs
            above.least = node.least if above.least is None else min(above.least, node.least)
        return
    leaves = node.leaves or 1
    saved = node.saved + (node.convs - 1) * node.chars
    above.waiting.append((node.least, depth, node.convs, node.children, leaves, saved, node.digest.hexdigest() if node.digest else NO_ENDS))
    above.convs += node.convs
    above.least = node.least if above.least is None else min(above.least, node.least)
    above.children += 1
    above.leaves += leaves
    above.saved += saved


# The skeleton's own nodes

def _reduced(spark: SparkSession, found: DataFrame, skeleton: Skeleton) -> DataFrame:
    """Finished rows of the skeleton nodes, with ``skeleton``. Their partial aggregates are reduced by Spark; the sums over
    subtrees of the skeleton, which has a bounded number of nodes, are differences of running sums in depth-first order."""
    partial = found.filter(F.col("kind") == PARTIAL).groupBy("skeleton").agg(
        F.min("conv_id").alias("conv_id"), *[F.sum(name).alias(name) for name in ("n_convs", "n_children", "n_leaves", "saved_tokens")])
    table = partial.toArrow().sort_by("skeleton")
    number = table.column("skeleton").to_numpy()
    conv_id, convs, children, leaves, saved = (table.column(name).to_numpy() for name in (
        "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"))
    parent, chars, after = (np.array(values, np.int64) for values in (skeleton.parent, skeleton.chars, skeleton.after))
    if len(number):  # every skeleton node has members, unless there are no conversations
        children = children + np.bincount(parent[1:], minlength=len(parent))
        leaves = leaves + (children == 0)
        saved = saved + (convs - 1) * chars

        def below(values):
            sums = np.concatenate([[0], np.cumsum(values)])
            return sums[after] - sums[np.arange(len(after))]

        leaves, saved = below(leaves), below(saved)
    parent_ids = [int(conv_id[above]) if above >= 0 else None for above in parent[:len(number)].tolist()]
    rows = pa.table({
        "skeleton": pa.array(number, pa.int32()), "conv_id": pa.array(conv_id, pa.int64()),
        "depth": pa.array(skeleton.depth[:len(number)], pa.int64()), "parent_conv_id": pa.array(parent_ids, pa.int64()),
        "n_convs": pa.array(convs, pa.int64()), "n_children": pa.array(children, pa.int64()),
        "n_leaves": pa.array(leaves, pa.int64()), "saved_tokens": pa.array(saved, pa.int64())})
    pieces = found.filter(F.col("kind") == ENDS).select("skeleton", "shard", "piece", "ends")
    digests = (pieces.repartition("skeleton").sortWithinPartitions("skeleton", "shard", "piece")
               .mapInArrow(_digests, "skeleton int, ends_sha256 string"))
    return spark.createDataFrame(rows).join(digests, "skeleton", "left").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS)))


def _digests(batches):
    """The digest of each skeleton node's ids, given in order; a digest is one stream, so a node's pieces meet in one task."""
    last, digest = None, None
    for batch in batches:
        found = []
        for number, ends in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist()):
            if number != last:
                if digest:
                    found.append((last, digest.hexdigest()))
                last, digest = number, hashlib.sha256()
                digest.update(ends)
            else:
                digest.update(b"," + ends)
        yield _digest_batch(found)
    if digest:
        yield _digest_batch([(last, digest.hexdigest())])


def _digest_batch(found) -> pa.RecordBatch:
    numbers, digests = zip(*found) if found else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(digests, pa.string())], names=["skeleton", "ends_sha256"])
