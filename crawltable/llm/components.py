"""Connected components by alternating star contraction, as joins on staged tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawltable.workspace import scratch, stage

# Rows of two numbers that one task of a round writes.
ROWS_PER_TASK = 50_000


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, its smallest reachable node, for the ends of ``edges``.

    ``edges`` has the columns a and b, of one type with an order; null ends, loops and
    repeated edges say nothing and are left out. Each round hangs every node on smaller
    neighbours; rounds grow with the logarithm of the longest path. Minima come from
    pre-aggregating groupings and are staged, so that a node with very many neighbours
    meets them in a join whose hot side Spark splits. The edges never leave the cluster.
    A round writes as many files as its rows ask for, the cores at least: not one per shuffle
    partition, four times a round, however few links there are.
    """
    spark = edges.sparkSession
    kind = edges.schema["a"].dataType
    links = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    with scratch(spark, "stars") as folder:
        links = stage(links.distinct(), "links-0", folder)
        seen, tasks = None, _tasks(spark, links.count())
        for n in range(1, 100):
            links = _round(links, folder, n, tasks)
            now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
            if now == seen:
                break
            seen, tasks = now, _tasks(spark, now[0])
        else:
            raise RuntimeError("components did not settle")
        stars = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
        centres = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
        found = stage(stars.unionByName(centres.coalesce(tasks)), "components")
    return found.select(F.col("node").cast(kind), F.col("component").cast(kind))


def _tasks(spark: SparkSession, links: int) -> int:
    """Tasks that write a table of a round; none has more than two rows per link."""
    return max(spark.sparkContext.defaultParallelism, -(-2 * links // ROWS_PER_TASK))


def _round(links: DataFrame, folder: str, n: int, tasks: int) -> DataFrame:
    """Large stars, then small stars; ``a`` is always the larger end."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    least = stage(least.coalesce(tasks), f"large-{n}", folder)
    # A larger neighbour (here the link's a) hangs on the least neighbour of b.
    hung = links.join(least.withColumnRenamed("a", "b"), "b").select("a", F.col("m").alias("b"))
    hung = stage(hung.distinct().coalesce(tasks), f"hung-{n}", folder)
    smallest = hung.groupBy("a").agg(F.min("b").alias("m"))
    smallest = stage(smallest.coalesce(tasks), f"small-{n}", folder)
    # A node hangs on its least smaller neighbour, and so do its other smaller ones.
    others = hung.join(smallest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    moved = others.unionByName(smallest.withColumnRenamed("m", "b"))
    return stage(moved.distinct().coalesce(tasks), f"links-{n}", folder)
