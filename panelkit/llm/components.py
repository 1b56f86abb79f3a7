"""Connected components of links between rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.sources.staging import stage


def _checksum(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def _star(neighbours: DataFrame, larger: bool) -> DataFrame:
    """One half-step. ``neighbours`` (u, v) lists for each u the ends that it looks at; each of these ends, and u
    itself, is linked to the smallest of them. The minima are written first: a join of two written tables can be
    split where one u has very many links."""
    least = stage(neighbours.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "minima")
    linked = neighbours.join(least, "u")
    if larger:
        moved = linked.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        # u itself comes once, out of the minima
        moved = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return stage(moved.filter(F.col("u") > F.col("v")).distinct(), "edges")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component_id) of every id that has a link: the smallest id that can be reached.

    Links are read in either direction; loops, repeated links and links with a null end do not matter. In turns,
    every id links its larger neighbours, then its smaller ones, to the smallest id it sees, until
    nothing changes; the number of rounds grows with the logarithm of the number of ids. Each
    half-step is written to the shared folder, nothing but a row count and a checksum comes to the driver.
    """
    known = links.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    ends = known.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    edges = stage(ends.filter(F.col("u") > F.col("v")).distinct(), "edges")
    before = _checksum(edges)
    while before[0]:
        turned = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
        edges = _star(edges.unionByName(turned), larger=True)
        edges = _star(edges, larger=False)
        after = _checksum(edges)
        if after == before:
            break
        before = after
    # every id now hangs directly on the smallest of its component
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component_id")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component_id")).unionByName(roots)
