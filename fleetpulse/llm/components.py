"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.session import remove, work_path


def _lowest(edges: DataFrame) -> DataFrame:
    """The smallest of each node and its neighbours; summed up before the shuffle."""
    lowest = edges.groupBy("u").agg(F.min("v").alias("m"))
    return lowest.select("u", F.least("u", "m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node moves to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (
        both.join(_lowest(both), "u")
        .where("v > u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .where("u <> v")
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them. Edges run downwards."""
    lowest = _lowest(edges)
    moved = edges.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(lowest.withColumnRenamed("m", "v")).where("u <> v").distinct()


def component_roots(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): the smallest node of the component, for every linked node but the root itself.

    Each round leaves stars closer to the root and is written to the shared folder, so a lost
    executor costs one round at most. A hub is met by sums that are partial before the shuffle
    and by a join that adaptive execution can split.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v")
    edges, path = _store(edges.distinct(), None)
    print_of = _print(edges)
    while print_of[0]:
        edges, path = _store(_small_star(_large_star(edges)), path)
        now = _print(edges)
        if now == print_of:
            break
        print_of = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _store(edges: DataFrame, old: str | None) -> tuple[DataFrame, str]:
    spark = edges.sparkSession
    path = work_path(spark, "components")
    edges.write.parquet(path)
    if old:
        remove(spark, old)
    return spark.read.schema(edges.schema).parquet(path), path


def _print(edges: DataFrame) -> tuple[int, int]:
    """Rows and a checksum. Equal before and after a round: every component is a star."""
    row = edges.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")
    ).first()
    return row["n"], row["h"]
