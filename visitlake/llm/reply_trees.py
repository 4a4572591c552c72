"""Reply trees to conversations: root-to-leaf paths by self-joins, ranked branches, one formatted text per path.

Paths are found by doubling: table k says which reply lies 2 ** k above each reply, and a self-join of table k gives
table k + 1. A leaf then meets each of its ancestors once, by jumping or not jumping through every table from the longest
jump to the shortest. So a path of length n needs log n joins, and no row ever holds a path before it is formatted.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitlake.session import staged

# The template, and the strings of it and of common chat formats that must not stand in a text unescaped.
BEGIN, END = "<s>", "\n</s>\n"
CONTROL = r"\\|<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>"


def escape(text: Column) -> Column:
    """A backslash before every control string and backslash. No control string stands bare in the result."""
    return F.regexp_replace(text, f"({CONTROL})", r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"\\({CONTROL})", "$1")


def _jumps(replies: DataFrame) -> list[DataFrame]:
    """Tables of ``tree``, ``node``, ``above``, ``steps``, ``total``: the reply 2 ** k above, if there is one.

    ``steps`` and ``total`` are the number and the summed score of the replies passed, the reply itself included. In the
    last table nothing is above, so they are depth and score of the whole path. Replies below a circle are not in it.
    """
    known = replies.select("tree", F.col("node").alias("parent"), F.lit(True).alias("known"))
    first = replies.join(known, ["tree", "parent"], "left").select(
        "tree", "node", F.when(F.col("known"), F.col("parent")).alias("above"), F.lit(1).cast("long").alias("steps"),
        F.col("score").alias("total"))
    tables = [staged(first, "jumps")]
    rows = tables[0].count()
    while tables[-1].filter("above IS NOT NULL").limit(1).count():
        last = tables[-1]
        if 2 ** (len(tables) - 1) > rows:
            return [*tables, last.filter("above IS NULL")]
        over = last.select("tree", F.col("node").alias("above"), F.col("above").alias("above_"),
                           F.col("steps").alias("steps_"), F.col("total").alias("total_"))
        further = last.filter("above IS NOT NULL").join(over, ["tree", "above"]).select(
            "tree", "node", F.col("above_").alias("above"), (F.col("steps") + F.col("steps_")).alias("steps"),
            (F.col("total") + F.col("total_")).alias("total"))
        tables.append(staged(last.filter("above IS NULL").unionByName(further), "jumps"))
    return tables


def paths(replies: DataFrame, branches: int | None = None) -> DataFrame:
    """``tree``, ``leaf``, ``rank`` (from 1), ``place`` (0 at the root) and ``node`` for all replies of the chosen paths.

    ``replies`` has ``tree``, ``node`` (once in its tree), ``parent`` and ``score``. A reply whose parent is missing or not
    in the tree is a root. Paths of a tree are ranked by their mean score, then by the smaller leaf; ``branches`` limits
    their number. Replies on or below a circle are on no path, and rows without tree or node are left out.
    """
    replies = replies.filter("tree IS NOT NULL AND node IS NOT NULL").select(
        "tree", "node", "parent", F.coalesce("score", F.lit(0)).cast("double").alias("score"))
    tables = _jumps(replies)
    inner = replies.select("tree", F.col("parent").alias("node"))
    leaves = tables[-1].join(inner, ["tree", "node"], "left_anti").withColumn("score", F.col("total") / F.col("steps"))
    order = Window.partitionBy("tree").orderBy(F.desc("score"), "node")
    ranked = leaves.withColumn("rank", F.row_number().over(order))
    if branches is not None:
        ranked = ranked.filter(F.col("rank") <= branches)
    walked = ranked.select("tree", F.col("node").alias("leaf"), "rank", "node", (F.col("steps") - 1).alias("place"))
    for k in reversed(range(len(tables) - 1)):
        jump = tables[k].select("tree", "node", "above")
        stay = F.struct("node", "place")
        go = F.when(F.col("above").isNotNull(), F.struct(F.col("above").alias("node"), (F.col("place") - 2 ** k).alias("place")))
        walked = walked.join(jump, ["tree", "node"]).select(
            "tree", "leaf", "rank", F.explode(F.array_compact(F.array(stay, go))).alias("at")).select("tree", "leaf", "rank", "at.*")
    return walked


def conversations(replies: DataFrame, branches: int | None = None) -> DataFrame:
    """One row per chosen path: ``tree``, ``leaf``, ``rank``, ``formatted`` and ``loss_mask``.

    ``replies`` has the columns of ``paths`` and ``role`` and ``text``; a missing role or text is empty. The mask lists
    ``start`` and ``length``, in code points from 0, of the assistant's texts in ``formatted``. Texts are escaped; see
    ``turns_of`` for the way back. Repeated rows must have nodes of their own. An empty table gives no rows.
    """
    text, role = escape(F.coalesce("text", F.lit(""))), F.coalesce("role", F.lit(""))
    head = F.concat(F.lit(BEGIN), F.url_encode(role), F.lit("\n"))
    turns = replies.select("tree", "node", head.alias("head"), text.alias("text"), (role == "assistant").alias("learned"))
    piece, along = F.concat("head", "text", F.lit(END)), Window.partitionBy("tree", "leaf").orderBy("place")
    placed = paths(replies, branches).join(turns, ["tree", "node"]).select(
        "tree", "leaf", "rank", "place", "learned", piece.alias("piece"), F.length("head").alias("head"),
        F.length("text").cast("long").alias("length"))
    until = F.sum(F.length("piece")).over(along.rowsBetween(Window.unboundedPreceding, 0))
    placed = placed.withColumn("start", (until - F.length("piece") + F.col("head")).cast("long"))
    turn = F.struct("place", "piece", "learned", "start", "length")
    rows = placed.groupBy("tree", "leaf", "rank").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return rows.select(
        "tree", "leaf", "rank", F.array_join(F.transform("turns", lambda turn: turn["piece"]), "").alias("formatted"),
        F.transform(F.filter("turns", lambda turn: turn["learned"]),
                    lambda turn: F.struct(turn["start"].alias("start"), turn["length"].alias("length"))).alias("loss_mask"))


def turns_of(formatted: Column) -> Column:
    """Array of ``role`` and ``text`` of the turns, read back from a formatted conversation."""
    pieces = F.split(formatted, END)
    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), lambda piece: F.struct(
        F.url_decode(F.regexp_extract(piece, f"^{BEGIN}([^\n]*)\n", 1)).alias("role"),
        unescape(F.regexp_extract(piece, f"(?s)^{BEGIN}[^\n]*\n(.*)$", 1)).alias("text")))


def learned_text(formatted: Column, loss_mask: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    return F.array_join(F.transform(loss_mask, lambda span: unescape(F.substring(
        formatted, span["start"].cast("int") + 1, span["length"].cast("int")))), "")
