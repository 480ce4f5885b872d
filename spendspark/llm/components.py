"""Connected components of a link table, by alternating star contraction.

Each round replaces every link by one to the smallest neighbour (Kiveris et al., SoCC 2014): the
larger neighbours of a node move to its smallest one, then the smaller ones do. Rounds are
logarithmic in the length of chains. Minima are combined before they are shuffled, so a node with
very many links costs its minimum only, and its links meet it in a join that can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendspark.session import materialise


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node with a link to another; component is the smallest reachable.

    ``links`` has columns a and b in any order, repeats allowed. Null ends and self links are left out.
    """
    edges = materialise(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "links",
    )
    before = None
    while (now := _fingerprint(edges)) != before:
        if now[0] == 0:
            break
        before = now
        edges = materialise(_small_star(_large_star(edges)), "links")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return (
        both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")
    ).first()
    return row["n"], row["h"]
