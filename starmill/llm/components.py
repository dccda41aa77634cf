"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import stored

#: Parts that the neighbours of one id are dealt over.
SALTS = 64


def components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable over ``links`` (a, b), both ways.

    Every round links larger neighbours, then smaller ones, to the smallest neighbour;
    the rounds needed grow with the logarithm of the longest path. They end when all links
    are stars around a smallest id. Each round is written to the shared folder, so that a
    lost executor repeats one round at most. Ids without a link to another id are not
    returned.
    """
    edges = stored(
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "links",
    )
    while not _are_stars(edges):
        both = edges.union(edges.select("v", "u"))
        large = _with_least(both, F.least(F.min("v"), F.first("u")))
        large = large.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where(F.col("u") != F.col("v")).distinct()
        linked = _with_least(large, F.min("v"))
        small = linked.select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(linked.select("u", F.col("m").alias("v")))
        edges = stored(small.where(F.col("u") != F.col("v")).distinct(), "links")
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        edges.select("v", "v").distinct()
    )


def _with_least(edges: DataFrame, least: Column) -> DataFrame:
    """(u, v, m): every edge with the least over all edges of its ``u``.

    The edges of an id are dealt over parts by their other end. Only the parts' least,
    at most SALTS for an id, meet in one place; they bring the overall least back to the
    parts, so that no task holds all edges of an id with very many.
    """
    dealt = edges.withColumn("part", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
    parts = dealt.groupBy("u", "part").agg(least.alias("least"))
    whole = parts.groupBy("u").agg(F.min("least").alias("m"))
    known = parts.select("u", "part").join(whole, "u")
    return dealt.join(known, ["u", "part"]).select("u", "v", "m")


def _are_stars(edges: DataFrame) -> bool:
    """Whether every id has one smaller neighbour or larger ones only."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("down"), F.lit(0).alias("up"))
    ends = ends.union(edges.select("v", F.lit(0), F.lit(1)))
    ends = ends.groupBy("id").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return ends.where(F.col("down") + F.col("up") > 1).where(F.col("down") > 0).isEmpty()
