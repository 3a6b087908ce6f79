"""Accepted lines to conformed sales lines; every step is row-local."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions import classify
from tallyhouse.schemas import DIM_TRANSACTION_TYPE, LINE_MONEY


def line_total(quantity: Column, unit_price: Column) -> Column:
    """Exact product in cents; NULL where it exceeds the column's range."""
    return (F.abs(quantity).cast("bigint") * unit_price).try_cast(LINE_MONEY)


def conform(lines: DataFrame) -> DataFrame:
    """The transformed record, with `seq`, `pos` and the invoice text kept.

    The invoice text tells a credit note from the invoice of the same number,
    which the numeric invoice_no no longer does.
    """
    parts = classify.categorize(F.col("stock_code"), F.col("description"))
    credit = classify.is_credit(F.col("invoice"))
    tagged = lines.withColumns(
        {
            "category": parts.category,
            "subcategory": parts.subcategory,
            "is_gift": parts.is_gift,
        }
    )
    kind = classify.transaction_type(
        F.col("stock_code"),
        F.col("quantity"),
        credit,
        F.col("category"),
        F.col("subcategory"),
    )
    provenance = [c for c in ("row_id", "created_at", "batch_id", "data_source") if c in lines.columns]
    return tagged.select(
        "seq",
        "pos",
        "invoice",
        classify.invoice_number(F.col("invoice")).alias("invoice_no"),
        kind.alias("transaction_type"),
        F.abs("quantity").alias("quantity"),
        F.abs("unit_price").alias("unit_price"),
        line_total(F.col("quantity"), F.col("unit_price")).alias("line_total"),
        "transaction_datetime",
        F.to_date("transaction_datetime").alias("transaction_date"),
        F.trim("customer_id").alias("customer_id"),
        "stock_code",
        "description",
        "country",
        *provenance,
        "category",
        "subcategory",
        "is_gift",
    )


def transaction_types(spark: SparkSession) -> DataFrame:
    """The fixed lookup of transaction types; fourteen rows."""
    return spark.createDataFrame(classify.TRANSACTION_TYPES, DIM_TRANSACTION_TYPE)


def signed(lines: DataFrame) -> DataFrame:
    """Add the signed amount; the direction comes back from the type lookup."""
    effects = transaction_types(lines.sparkSession).select("transaction_type", "effect_sign")
    return lines.join(F.broadcast(effects), "transaction_type", "left").withColumn(
        "signed_amount", F.col("line_total") * F.col("effect_sign")
    )


def metrics(lines: DataFrame) -> DataFrame:
    """Lines seen, converted and failed; a line fails if a measure has no value."""
    good = F.col("line_total").isNotNull() & F.col("transaction_datetime").isNotNull()
    return lines.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(good).alias("successful"),
        F.count_if(~good).alias("failed"),
    )


def net_revenue_by_type(lines: DataFrame) -> DataFrame:
    """Signed total per transaction type; summed first, signed afterwards."""
    totals = lines.groupBy("transaction_type").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("line_total").alias("line_total")
    )
    return signed(totals).select(
        "transaction_type",
        "lines",
        F.col("signed_amount").cast("decimal(28,2)").alias("net_revenue"),
    )
