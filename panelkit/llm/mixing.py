"""Mixing sources to target weights, by budgets handed down a tree.

The levels of the tree are columns (domain, language, source). A node shares its budget among its children by their
weights; a child that cannot use its share leaves the rest to its siblings, again by their weights. What a child
can use is what its whole subtree holds, times the epochs allowed, so a shortage goes to siblings first, and
to the ancestors' siblings only where a whole subtree is used up. Each leaf takes as many whole epochs as its
budget allows, and of the next one a prefix in an order drawn from the seed, the epoch and the document.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.sources.staging import stage

# Leading hexadecimal digits of the order that make a slice; leaves that may be broadcast; equal rows made in one lot.
SLICE_DIGITS, BROADCAST_LEAVES, COPIES = 3, 50_000, 4096
LEVELS = ["domain", "lang", "source"]
Weights = dict[tuple[str | None, ...], float]


def word_count(text: str = "text") -> Column:
    """Words, runs of characters other than ASCII white space; 0 for null."""
    trimmed = F.regexp_replace(F.coalesce(f"`{text}`", F.lit("")), r"[\x20\x09-\x0D]+", " ")
    trimmed = F.trim(trimmed)
    return F.when(trimmed == "", 0).otherwise(F.length(trimmed) - F.length(F.replace(trimmed, F.lit(" "))) + 1).cast("bigint")


def _weighted(nodes: DataFrame, weights: Weights) -> DataFrame:
    """``nodes`` with ``weight``: as given for their path, else 1."""
    spark = nodes.sparkSession
    given = spark.createDataFrame([(list(p), float(w)) for p, w in weights.items()], "path array<string>, given double")
    joined = nodes.join(F.broadcast(given), "path", "left")  # as many rows as the caller wrote
    return joined.withColumn("weight", F.coalesce("given", F.lit(1.0))).drop("given")


def _filled(nodes: DataFrame) -> DataFrame:
    """(path, budget) of nodes with (path, parent, cap, weight, of_parent): the parent's budget, shared.

    In the order of cap / weight, children are used up as long as what is left by weight is more than they hold; the
    others share the rest by weight. A window holds the children of one node.
    """
    open_ = nodes.withColumn("ratio", F.when(F.col("weight") > 0, F.col("cap") / F.col("weight")))
    order = Window.partitionBy("parent").orderBy(F.col("ratio").asc_nulls_last(), "path")
    used = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    level = F.when(F.col("weight") > 0, (F.col("of_parent") - used) / rest)
    leveled = open_.withColumn("level", level)
    full = F.col("ratio") <= F.col("level")
    water = F.max(F.when(~full, F.col("level"))).over(Window.partitionBy("parent"))
    share = F.when(F.col("ratio").isNull(), 0.0).when(full, F.col("cap").cast("double")).otherwise(water * F.col("weight"))
    return leveled.select("path", share.alias("budget"))


def leaf_budgets(leaves: DataFrame, depth: int, weights: Weights, epochs: int, share: float) -> DataFrame:
    """(path, supply, budget) of each leaf; ``leaves`` is a written table of (path, supply), one row for each leaf.

    The root's budget is ``share`` of all tokens, rounded down. Weights are not negative, 0 shuts a node; what it holds
    is no part of what the nodes above it can use.
    """
    whole = F.floor(F.sum("supply").over(Window.partitionBy("parent")) * F.lit(float(share))).cast("double")
    held = leaves.withColumn("cap", F.col("supply") * epochs)
    levels = []
    for k in range(depth, 0, -1):
        nodes = held.groupBy(F.slice("path", 1, k).alias("path")).agg(
            F.sum("cap").alias("cap"), F.sum("supply").alias("supply")
        )
        nodes = _weighted(nodes.withColumn("parent", F.slice("path", 1, k - 1)), weights)
        levels.insert(0, nodes)
        held = nodes.withColumn("cap", F.when(F.col("weight") > 0, F.col("cap")).otherwise(0))
    above = None
    for nodes in levels:
        if above is None:
            nodes = nodes.withColumn("of_parent", whole)
        else:
            nodes = nodes.join(above.select(F.col("path").alias("parent"), F.col("budget").alias("of_parent")), "parent")
        above = stage(_filled(nodes), "budgets")
    return leaves.join(above, "path")


def _order(seed: int) -> Column:
    """Place of a row in the epoch that its leaf uses in part, as text: by its id, text and number among equal rows."""
    parts = [F.lit(str(seed)), *[F.col(c).cast("string") for c in ("full", "doc_id", "row", "copy")]]
    return F.md5(F.concat_ws("|", *parts))


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with ``copy``, their number among rows that are equal, from 0.

    Equal rows are counted, combined before the shuffle, and made again from their number, in lots that are dealt out, so
    that no task gets all rows of one id.
    """
    counted = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n"))
    counted = stage(counted, "sizes")
    once = counted.filter("n = 1").withColumn("copy", F.lit(0).cast("bigint")).drop("n")
    lots = counted.filter("n > 1").withColumn("from", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1, F.lit(COPIES).cast("bigint"))))
    dealt = lots.repartition("doc_id", "row", "from")
    last = F.least(F.col("n") - 1, F.col("from") + COPIES - 1)
    again = dealt.withColumn("copy", F.explode(F.sequence(F.col("from"), last))).drop("n", "from")
    return once.unionByName(again)


def mix(
    docs: DataFrame,
    levels: list[str] = LEVELS,
    weights: Weights | None = None,
    epochs: int = 1,
    share: float = 0.8,
    seed: int = 11,
    n_tokens: Column | None = None,
) -> DataFrame:
    """(doc_id, path, row, n_tokens, epochs) for each document: how often it is taken, 0 if not; ``row`` is a hash of its
    text.

    ``weights`` maps paths, tuples of the values of the first levels, to weights; other nodes weigh 1. ``share`` of
    all tokens is the budget, ``epochs`` the most that a document may be taken. Of the last epoch of a leaf, the
    documents are taken whose tokens, added up in the epoch's order, stay within the budget. ``n_tokens`` counts a
    document's tokens (its words if not given); texts that are null or have no word are never taken. Null levels are
    nodes like others. Rows that repeat an id, and rows without one, have places of their own by their texts, and those
    that repeat the text too by their number. An empty table gives no rows.
    """
    path = F.array(*[F.col(f"`{c}`").cast("string") for c in levels])
    size = word_count() if n_tokens is None else n_tokens
    row = F.md5(F.coalesce(F.col("text"), F.lit("")))
    rows = _numbered(docs.select("doc_id", path.alias("path"), size.alias("n_tokens"), row.alias("row")))
    leaves = stage(rows.groupBy("path").agg(F.sum("n_tokens").alias("supply")), "leaves")
    budgets = leaf_budgets(leaves, len(levels), weights or {}, epochs, share)
    target = F.floor("budget").cast("bigint")
    full = F.when(F.col("supply") > 0, F.floor(target / F.col("supply"))).otherwise(0).cast("bigint")
    plan = stage(
        budgets.withColumn("full", full).withColumn("left", target - F.col("full") * F.col("supply")).select("path", "full", "left"),
        "plan",
    )
    few = plan.count() <= BROADCAST_LEAVES
    ordered = rows.join(F.broadcast(plan) if few else plan, "path").withColumn("order", _order(seed))
    ordered = ordered.withColumn("slice", F.substring("order", 1, SLICE_DIGITS))

    # Per leaf, the slice of the order in which the budget ends: 16 ** SLICE_DIGITS rows of a leaf at most.
    sums = ordered.groupBy("path", "left", "slice").agg(F.sum("n_tokens").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("path").orderBy("slice").rowsBetween(Window.unboundedPreceding, 0))
    over = sums.withColumn("upto", upto).filter(F.col("upto") > F.col("left"))
    ends = over.groupBy("path").agg(F.min(F.struct("slice", (F.col("upto") - F.col("n")).alias("before"))).alias("end"))
    ends = stage(ends.select("path", F.col("end.slice").alias("last"), F.col("end.before").alias("before")), "ends")

    placed = ordered.join(F.broadcast(ends) if few else ends, "path", "left")
    inside = placed.filter(F.coalesce(F.col("slice") != F.col("last"), F.lit(True)))
    inside = inside.withColumn("taken", F.coalesce(F.col("slice") < F.col("last"), F.lit(True)))
    # one slice of each leaf is added up document by document
    running = Window.partitionBy("path").orderBy("order").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    edge = placed.filter(F.col("slice") == F.col("last"))
    edge = edge.withColumn("taken", F.col("before") + F.sum("n_tokens").over(running) <= F.col("left"))
    taken = (F.col("taken") & (F.col("left") > 0)).cast("bigint")
    chosen = F.when(F.col("n_tokens") > 0, F.col("full") + taken).otherwise(0).cast("bigint")
    return inside.unionByName(edge).select("doc_id", "path", "row", "n_tokens", chosen.alias("epochs"))
