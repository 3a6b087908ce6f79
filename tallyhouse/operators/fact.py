"""Fact rows: key resolution, rejection of unresolved lines, final columns."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions.text import pack, unpack
from tallyhouse.operators.dimensions import GUEST
from tallyhouse.schemas import FACT_SALES


def promote_midnight(lines: DataFrame) -> DataFrame:
    """A line with a date only happens at midnight of that day."""
    midnight = F.col("transaction_date").cast("timestamp_ntz")
    return lines.withColumn(
        "transaction_datetime", F.coalesce("transaction_datetime", midnight)
    )


#: Texts of a sales row that no key is looked up by; they cross the network packed.
_RIDES = ("transaction_type", "batch_id", "data_source")


def resolve_keys(
    lines: DataFrame, dates: DataFrame, customers: DataFrame, products: DataFrame
) -> DataFrame:
    """Look up the three keys; an unknown natural key gives NULL.

    Dates are few whatever the load, so they are sent to the lines. Customers
    and products may be large: the choice of join is left to their size, and a
    customer or product with very many lines to the skew-join split.
    """
    lines = promote_midnight(lines)
    texts, columns = [c for c in _RIDES if c in lines.columns], lines.columns
    lines = lines.withColumn("_texts", pack(texts)).drop(*texts)
    days = dates.select(F.col("date_value").alias("_day"), "date_key")
    buyers = customers.filter("is_current").select(
        F.col("customer_id").alias("_customer"), "customer_key"
    )
    items = products.select(F.col("stock_code").alias("_stock"), "product_key")
    customer = F.coalesce(F.nullif("customer_id", F.lit("")), F.lit(GUEST))
    resolved = (
        lines.join(items, F.col("stock_code") == F.col("_stock"), "left")
        .join(buyers, customer == F.col("_customer"), "left")
        # One row per calendar day: a century is 36,525 rows. Last, so that the keys are not shuffled.
        .join(F.broadcast(days), F.to_date("transaction_datetime") == F.col("_day"), "left")
        .withColumns(unpack("_texts", texts))
    )
    return resolved.select(*columns, "date_key", "product_key", "customer_key")


def is_resolved(strict: bool = False) -> Column:
    """Product, date and line total are required; `strict` adds the customer."""
    needed = ["product_key", "date_key", "line_total"] + (["customer_key"] if strict else [])
    whole = F.lit(True)
    for name in needed:
        whole = whole & F.col(name).isNotNull()
    return whole


_IN_TASK = 33


def line_starts(stored: DataFrame) -> DataFrame:
    """For each scan task of a stored table's `row_id`s, how many lines the tasks before it had.

    One row per task, and only those rows are put in order.
    """
    sizes = stored.groupBy(_task().alias("_task")).agg((F.max(_place()) + 1).alias("_size"))
    earlier = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("_task", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start"))


def line_numbers(lines: DataFrame, starts: DataFrame) -> DataFrame:
    """Add `line_no`, from 1 on without great gaps, though a row id leaps from one scan task to the next.

    The same stored lines get the same numbers again, and no line is sorted.
    """
    numbered = lines.withColumn("_task", _task()).join(starts, "_task")
    return numbered.withColumn("line_no", F.col("_start") + _place() + 1).drop("_task", "_start")


def _task() -> Column:
    return F.shiftright("row_id", _IN_TASK)


def _place() -> Column:
    return F.col("row_id") % F.lit(2**_IN_TASK)


def build(resolved: DataFrame, after: Column | int = 0, version_id: int | None = None) -> DataFrame:
    """Fact columns of the resolved lines.

    `sales_key` counts on from `after`, by `line_no` where the lines have one;
    else it is numbered as the rows are written: unique, but with great gaps.
    """
    base = after if isinstance(after, Column) else F.lit(after)
    version_at = F.col("created_at") if version_id is not None else F.lit(None)
    number = F.col("line_no") if "line_no" in resolved.columns else F.monotonically_increasing_id() + 1
    values = {
        "sales_key": base + number,
        "version_id": F.lit(version_id),
        "version_created_at": version_at,
        "txn_year": F.year("transaction_datetime"),
    }
    return resolved.select(
        [
            values.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name)
            for f in FACT_SALES
        ]
    )


def write(fact: DataFrame, path: str, mode: str = "append") -> None:
    """Year-partitioned Parquet. Rows of one year may come from any task."""
    fact.write.partitionBy("txn_year").mode(mode).parquet(path, compression="zstd")


def read(spark, path: str) -> DataFrame:
    return spark.read.schema(FACT_SALES).parquet(path)


def since(fact: DataFrame, as_of: str, days: int) -> DataFrame:
    """Lines of the trailing window; the year bound prunes partitions."""
    start = F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL {int(days)} DAYS")
    recent = F.col("transaction_datetime") >= start
    if "txn_year" in fact.columns:
        recent = recent & (F.col("txn_year") >= F.year(start))
    return fact.filter(recent)


def load_range(fact: DataFrame) -> DataFrame:
    """First and last transaction of the load and the years it touches."""
    return fact.agg(
        F.min("transaction_datetime").alias("first_transaction"),
        F.max("transaction_datetime").alias("last_transaction"),
        F.countDistinct(F.year("transaction_datetime")).alias("years"),
    )
