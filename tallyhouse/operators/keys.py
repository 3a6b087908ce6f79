"""Surrogate keys: dense, repeatable numbers without a global sort."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def position(seq: str = "seq", pos: str = "pos") -> Column:
    """One exact number for a line's place in the whole load."""
    return (
        F.col(seq).cast("decimal(20,0)") * F.lit(2**55).cast("decimal(17,0)")
        + F.col(pos).cast("decimal(19,0)")
    ).cast("decimal(38,0)")


def assign_keys(
    members: DataFrame, natural: str, key: str, after: Column, hex_digits: int = 3
) -> DataFrame:
    """Number distinct `members` from `after` + 1 on.

    Members are spread over 16 ** hex_digits buckets by a hash of the natural
    key; each bucket is numbered by itself and starts where the ones before it
    end. Only the bucket sizes meet in one place.
    """
    spread = members.withColumn("_bucket", F.left(F.md5(F.col(natural)), F.lit(hex_digits)))
    sizes = spread.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_bucket", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start")
    )
    inside = Window.partitionBy("_bucket").orderBy(natural)
    return (
        # One row per bucket, so never more than 16 ** hex_digits.
        spread.join(F.broadcast(starts), "_bucket")
        .withColumn(key, (after + F.col("_start") + F.row_number().over(inside)).cast("bigint"))
        .drop("_bucket", "_start")
    )


def highest(existing: DataFrame, key: str) -> Column:
    """Largest key in use, 0 for an empty table; read once as a scalar."""
    return existing.agg(F.coalesce(F.max(key), F.lit(0)).alias("top")).scalar()


def get_or_create(
    existing: DataFrame, incoming: DataFrame, natural: str, key: str
) -> DataFrame:
    """Natural and surrogate keys of all members, old ones unchanged.

    `incoming` needs no duplicates removed beyond its natural key being unique.
    """
    new = incoming.join(existing.select(natural), natural, "left_anti").select(natural)
    created = assign_keys(new, natural, key, highest(existing, key))
    return existing.select(natural, key, F.lit(False).alias("is_new")).unionByName(
        created.select(natural, key, F.lit(True).alias("is_new"))
    )
