"""Connected components of a table of links, by alternating star contraction.

Every round hangs the larger neighbours of a node on its smallest one, then the smaller
neighbours likewise, until nothing changes. Only minima by node are gathered, so a node
with a third of all links costs a partial aggregate and a join that may split its rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from walletyield.llm.common import remove_folder, shared_folder


def _smallest(edges: DataFrame) -> DataFrame:
    """edges (u, v) with the least of u and its neighbours."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("m"))
    return edges.join(least, F.col("u") == F.col("node")).drop("node")


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """node, component (the smallest node reachable) of every node that has a link to another.

    Nodes are of any type that Spark orders and hashes (numbers, strings, binary).
    """
    spark, kind = links.sparkSession, links.schema[a].dataType.simpleString()
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    path = shared_folder(spark, "links")
    edges.write.parquet(path)
    before = None
    while True:
        edges = spark.read.schema(f"u {kind}, v {kind}").parquet(path)
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == before:
            break
        before = tuple(state)
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _smallest(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = _smallest(large)
        small = (small.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        done, path = path, shared_folder(spark, "links")
        small.write.parquet(path)
        remove_folder(spark, done)
    # now every node hangs on the least of its component
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(edges.select("v", "v").distinct())
