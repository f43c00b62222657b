"""Connected components of a table of links, by alternating large and small stars.

Each round hangs the neighbours of every node under its smallest one. No node's
neighbours are gathered in one task: minima are aggregated, then joined back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envstream.session import materialise

#: Edges that one task reads; 16 bytes each.
TASK_EDGES = 1 << 16


def _ends(a, b, c, d):
    """Two edges as rows of (a, b) from one pass over what they are made of."""
    return F.inline(F.array(F.struct(F.col(a).alias("a"), F.col(b).alias("b")),
                            F.struct(F.col(c).alias("a"), F.col(d).alias("b"))))


def _largest(edges: DataFrame) -> DataFrame:
    """For every node: neighbours above it are hung under its smallest one, or under
    itself where it has none below."""
    low = edges.groupBy(F.col("b").alias("a")).agg(F.min("a").alias("m"))
    joined = edges.join(low, "a", "left")
    return joined.select(F.coalesce("m", "a").alias("a"), "b").distinct()


def _smallest(edges: DataFrame) -> DataFrame:
    """For every node: it and its neighbours below are hung under the smallest one."""
    low = edges.groupBy("b").agg(F.min("a").alias("m"))
    hung = edges.join(low, "b").select(_ends("m", "a", "m", "b"))
    return hung.where("a <> b").distinct()


def _mark(edges: DataFrame):
    row = edges.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(links: DataFrame, a="a", b="b") -> DataFrame:
    """Links -> (node, root) for every linked node; roots are the smallest nodes.
    Edges are kept as (smaller, larger)."""
    edges = materialise(links.select(
        F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a <> b").distinct())
    mark = _mark(edges)
    while mark[0]:
        # As many tasks as the edges fill: few edges need no shuffle.
        edges = edges.coalesce(mark[0] // TASK_EDGES + 1)
        edges = materialise(_smallest(_largest(edges)))
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    roots = edges.select("a").distinct()
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
        roots.select(F.col("a").alias("node"), F.col("a").alias("root")))
