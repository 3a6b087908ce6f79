"""Distinct counts that merge: for each day the set of keys sold, as bitmaps over the dense surrogate keys.

A load stores the totals and key sets of its own days. The distinct keys of any run of days are the union of their
sets, exact and without a fact row; loads of the same day merge the same way. A bitmap holds 32,768 neighbouring keys
in 4 KB, so a day is a few rows however many lines it has.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ("customer_key", "product_key")
TOTALS_SCHEMA = "day date, lines bigint, line_total decimal(28,2), valued bigint"
KEYS_SCHEMA = "day date, key string, bucket bigint, bits binary"


def day_totals(fact: DataFrame) -> DataFrame:
    """Lines, revenue and lines with a total, by day."""
    return fact.groupBy(F.to_date("transaction_datetime").alias("day")).agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum("line_total").cast("decimal(28,2)").alias("line_total"),
        F.count("line_total").alias("valued"),
    )


def day_keys(fact: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """One row per day, key column and bucket of 32,768 keys."""
    found = None
    for key in keys:
        at = fact.filter(F.col(key).isNotNull()).select(
            F.to_date("transaction_datetime").alias("day"),
            F.bitmap_bucket_number(key).alias("bucket"),
            F.bitmap_bit_position(key).cast("smallint").alias("_bit"),
        )
        # What crosses is each key once per task, as a number in the set of its day and bucket, 32,768 at most. The bitmaps
        # are made of whole sets: a task has few keys of each, and its own bitmaps would be 4 KB of mostly zeros.
        once = at.groupBy("day", "bucket").agg(F.collect_set("_bit").alias("_bits"))
        bits = once.select("day", "bucket", F.explode("_bits").alias("_bit")).groupBy("day", F.lit(key).alias("key"), "bucket").agg(
            F.bitmap_construct_agg(F.col("_bit").cast("bigint")).alias("bits")
        )
        found = bits if found is None else found.unionByName(bits)
    return found


def distinct_keys(sets: DataFrame) -> DataFrame:
    """key and distinct_keys of the union of all sets given."""
    merged = sets.groupBy("key", "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))
    return merged.groupBy("key").agg(F.sum("n").alias("distinct_keys"))


def sales_summary(totals: DataFrame, sets: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """What `analytics.sales_summary` tells of the trailing days, from the stored days alone."""
    first = F.date_sub(F.lit(as_of).cast("date"), days)
    found = distinct_keys(sets.filter(F.col("day") >= first))

    def distinct(key: str):
        return F.coalesce(found.filter(F.col("key") == key).select("distinct_keys").scalar(), F.lit(0))

    total = F.coalesce(F.sum("line_total"), F.lit(0).cast("decimal(28,2)"))
    return totals.filter(F.col("day") >= first).agg(
        F.coalesce(F.sum("lines"), F.lit(0)).alias("total_transactions"),
        total.cast("decimal(28,2)").alias("total_revenue"),
        F.coalesce(F.try_divide(total.cast("double"), F.sum("valued")), F.lit(0.0)).alias("avg_transaction_value"),
    ).select(
        "*",
        distinct("customer_key").alias("unique_customers"),
        distinct("product_key").alias("unique_products"),
        F.lit(days).alias("period_days"),
    )
