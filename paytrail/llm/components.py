"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paytrail.session import materialized


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node hangs under one node alone, and none hangs under a node that hangs itself."""
    ends = F.explode(F.array(
        F.struct(F.col("a").alias("node"), F.col("b").alias("up")),
        F.struct(F.col("b").alias("node"), F.lit(None).cast("bigint").alias("up")),
    )).alias("e")
    nodes = edges.select(ends).groupBy("e.node").agg(
        F.min("e.up").alias("low"), F.max("e.up").alias("high"), F.bool_or(F.col("e.up").isNull()).alias("above")
    )
    return nodes.agg(F.count_if((F.col("low") < F.col("high")) | (F.col("above") & F.col("low").isNotNull()))).first()[0] == 0


def _star(edges: DataFrame, emit) -> DataFrame:
    """Every node's smallest neighbour, joined back to its edges, gives the new edges."""
    low = edges.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    return emit(edges.join(low, "a")).where(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """``id`` and ``component`` (its smallest reachable id) of every node of ``links`` (a, b).

    Each round hangs every node's larger neighbours, then its smaller ones, under the smallest id
    around it, until only stars are left; the rounds grow with the logarithm of the longest chain.
    Links that are stars already take no round.
    Each round's edges are written to the shared folder, so lost executors cost one round at most.
    Aggregation is partial before its shuffle and the joins may be split, so hubs do no harm.
    Loops and NULL ends are ignored; an empty table gives an empty result.
    """
    edges = materialized(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    while not _are_stars(edges):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _star(both, lambda e: e.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")))
        large = materialized(large, "large-star")
        small = _star(large, lambda e: e.select(F.explode(F.array(
            F.struct(F.col("b").alias("a"), F.col("low").alias("b")), F.struct(F.col("a"), F.col("low").alias("b"))
        )).alias("e")).select("e.*"))
        edges = materialized(small, "small-star")
    roots = edges.select(F.col("b").alias("id"), F.col("b").alias("component"))
    return roots.union(edges.select(F.col("a").alias("id"), F.col("b").alias("component"))).distinct()
