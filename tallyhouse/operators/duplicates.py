"""Duplicate lines: which one stays, and how many there are."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEEP_FIRST = "keep_first"
KEEP_LATEST = "keep_latest"
REMOVE_ALL = "remove_all"


def deduplicate(
    df: DataFrame, keys: list[str], order: list[str], strategy: str = KEEP_FIRST
) -> DataFrame:
    """Keep one line per key, or none of a key that occurs twice.

    For the first two, Catalyst puts a group limit of one row below the
    shuffle, so each task sends at most one line per key however many copies it
    holds. For the third, counts are combined before the shuffle, and the join
    back is one that a skewed key can be split in.
    """
    if strategy == REMOVE_ALL:
        repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
        return df.join(repeated.select(*keys), keys, "left_anti")
    if strategy not in (KEEP_FIRST, KEEP_LATEST):
        raise ValueError(f"unknown strategy {strategy!r}")
    by = [F.col(c).desc() if strategy == KEEP_LATEST else F.col(c).asc() for c in order]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*by))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def duplicate_count(df: DataFrame, keys: list[str]) -> DataFrame:
    """Lines beyond the first of each key, and the keys they belong to."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return sizes.agg(
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_lines"),
        F.count_if(F.col("_n") > 1).alias("duplicated_keys"),
    )
