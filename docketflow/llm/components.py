"""Connected components of links, as Spark joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import dropping_shuffles, work_path


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the cluster's shared folder and read again, to cut lineage."""
    path = work_path(df.sparkSession, label)
    with dropping_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(links: DataFrame) -> DataFrame:
    """Rows (node, root) for every node of links (a, b) but the roots themselves.

    Stars are contracted in turn, every node to the least of its neighbours, until nothing
    changes; that takes about as many rounds as the logarithm of the largest component. A
    node with very many links is summed up on the map side, and its links are read from a
    written table, so that the join can split them.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges = stored(edges, "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), "links-least")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.distinct(), "links-large")
        least = stored(large.groupBy("u").agg(F.min("v").alias("m")), "links-least")
        small = large.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))
        )).alias("e")).select("e.u", "e.v")
        edges = stored(small.where("u <> v").distinct(), "links")
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now
