"""Connected components of an edge table, in DataFrame rounds.

Alternating large-star and small-star steps: every step replaces edges by edges to a
smaller neighbour, so the edge count never grows and each component ends as a star
around its smallest node. A hub's edges are joined to one row (its smallest neighbour)
by a shuffle join, which Spark splits if it is skewed; nothing is collected. Rounds are
written to the shared checkpoint folder: lineage stays short, lost executors cost one round.

At most ``FEW`` edges (a few MB, whatever the table) take the same steps in one task and without a
shuffle: as many partitions as the session shuffles into would cost the driver more than the edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, stored

#: Edges that one task moves.
FEW = 1 << 16


def _to_smallest(pairs: DataFrame, keep_larger_only: bool) -> DataFrame:
    """``pairs`` (u, v): edges from the v of each u to the smallest node around it."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    if keep_larger_only:  # large star: the larger neighbours of u
        least = least.select("u", F.least("u", "m").alias("m"))
        return pairs.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    moved = pairs.join(least, "u").filter("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))


def _shuffled_round(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    large = _to_smallest(both, True).distinct()
    down = large.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    return _to_smallest(down, False).distinct()


def _round_of_few(edges: DataFrame) -> DataFrame:
    """As ``_shuffled_round``, in the one partition of ``edges``: windows need neither joins nor a union."""
    def struct(x, y):
        return F.struct(F.col(x).alias("a"), F.col(y).alias("b"))

    least = F.min("v").over(Window.partitionBy("u"))
    both = edges.select(F.inline(F.array(struct("a", "b"), struct("b", "a")))).toDF("u", "v")
    large = both.withColumn("m", F.least("u", least)).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    small = large.withColumn("m", least).select(F.inline(F.array(struct("u", "m"), struct("v", "m"))))
    return small.filter("a <> b").distinct()


def _state(edges: DataFrame) -> tuple[int, int]:
    r = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return r["n"], r["x"]


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component): the smallest node of its component, for every node of ``edges`` (a, b);
    nodes are longs. Self-loops, repeated and null edges are ignored."""
    edges = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .distinct(), name)
    state = _state(edges)
    while state[0]:
        old = edges
        new = _round_of_few(edges.coalesce(1)) if state[0] <= FEW else _shuffled_round(edges)
        edges = stored(new, name)
        discard(old)
        # one task wrote one file of few edges
        before, state = state, _state(edges.coalesce(1) if state[0] <= FEW else edges)
        if state == before:
            break
    own = edges.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(own).distinct()
