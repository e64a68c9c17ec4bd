"""Connected components of links, by alternating stars on Spark; every step is staged in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import remove, scratch_dir, stage


def _state(edges: DataFrame) -> tuple[int, int]:
    r = edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()
    return r[0], int(r[1])


def _large(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are tied to its least neighbour (or itself)."""
    both = edges.select("a", "b").union(edges.selectExpr("b AS a", "a AS b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.where("b > a").join(least, "a").selectExpr("b AS a", "m AS b").where("a != b").distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are tied to the least of them."""
    down = edges.selectExpr("greatest(a, b) AS a", "least(a, b) AS b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    tied = down.join(least, "a").selectExpr("b AS a", "m AS b").where("a != b")
    return tied.union(least.selectExpr("a", "m AS b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """From `a`, `b` (long): `node`, `component` (its least node) of every node that has a link to another one.

    A node with any number of links is no hot key: minima are formed before the shuffle, and the joins are of
    kinds whose large side can be split. Repeated links and links of a node to itself change nothing.
    """
    spark = links.sparkSession
    folder = scratch_dir(spark, "links")
    edges = stage(links.select("a", "b").where("a != b").distinct(), path=folder)
    before = None
    while (now := _state(edges)) != before:
        before = now
        if not now[0]:
            break
        half, new = scratch_dir(spark, "links"), scratch_dir(spark, "links")
        edges = stage(_small(stage(_large(edges), path=half)), path=new)
        remove(spark, half)
        remove(spark, folder)
        folder = new
    least = edges.selectExpr("b AS node", "b AS component").distinct()
    return edges.selectExpr("a AS node", "b AS component").union(least)
