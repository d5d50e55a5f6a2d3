"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termspace.session import scratch_path, settle


def connected_components(edges: DataFrame, work: str | None = None) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b); ``root`` is the smallest node that it reaches.

    Alternates two steps until nothing changes: each node hands its smallest
    neighbour to its larger neighbours, then to its smaller ones. Every step is
    a minimum per node (partial before the shuffle) and a join back, written
    down so that a lost executor costs one step. Edges never grow in number,
    and a node with very many neighbours is a large partition of the join, which
    Spark may split. Loops and repeated edges do no harm; without edges there
    are no rows.
    """
    work = work or scratch_path(edges.sparkSession, "components")
    high, low = F.greatest("a", "b"), F.least("a", "b")
    now = settle(edges.select(high.alias("a"), low.alias("b")).filter("a <> b").distinct(), "edges0", work)
    state, turn = _state(now), 0
    while True:
        turn += 1
        now = settle(_small(_large(now)), f"edges{turn}", work)
        before, state = state, _state(now)
        if state == before:
            break
    # Each node but the roots now has one edge, to its root.
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _state(edges: DataFrame):
    """Number and checksum of the edges."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are tied to the smallest of its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    larger = both.filter("b > a").join(least, "a")
    return larger.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are tied to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    smaller = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
    return smaller.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
