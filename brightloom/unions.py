"""Union by name that stays correct when its branches are partitioned alike."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession


def guard(spark: SparkSession) -> None:
    """Switch off reuse of the branches' partitioning by unions.

    Spark 4.1 lets a union of branches that are hash partitioned on the same key claim that
    partitioning. With a broadcast join above such a union the claim reaches an aggregate that then runs
    without its shuffle and returns a key once per branch. A plain shuffle is always right.
    """
    spark.conf.set("spark.sql.unionOutputPartitioning", "false")


def union_all(*frames: DataFrame, missing: bool = False) -> DataFrame:
    guard(frames[0].sparkSession)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=missing), frames)
