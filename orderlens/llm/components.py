"""Connected components of a table of links, by alternating stars.

A round links the larger neighbours of every node to its smallest one, then its smaller ones; the rounds end when
nothing changes, after a number of them that grows with the logarithm of the longest chain. Each step joins written
tables, so Spark may split a node with very many links, and minima leave the map tasks as one row per node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import written


def _smallest(links: DataFrame) -> DataFrame:
    return written(links.groupBy("u").agg(F.min("v").alias("m")), "links-smallest")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    small = _smallest(both).withColumn("m", F.least("u", "m"))
    return both.filter("v > u").join(small, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    small = _smallest(links)
    lower = links.join(small, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return lower.unionByName(small.withColumnRenamed("m", "v"))


def _mark(links: DataFrame):
    return links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b); a component's name is its smallest node.

    Links with a null end, and of a node with itself, say nothing. No links, no rows.
    """
    stars = written(
        links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    mark = None
    while (now := _mark(stars)) != mark:
        mark = now
        large = written(_large_star(stars).filter("u <> v").distinct(), "links-large")
        stars = written(_small_star(large).distinct(), "links-small")
    named = stars.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return named.unionByName(roots)
