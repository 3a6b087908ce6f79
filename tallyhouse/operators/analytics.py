"""Business queries on the loaded fact table."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.fact import since


def sales_summary(
    fact: DataFrame, as_of: str, days: int = 30, approximate: bool = False
) -> DataFrame:
    """Totals of the trailing days. `approximate` customers and products have a standard error of five percent.

    Exact distinct counts are aggregations of their own, so that no line is
    copied for each of them; `day_counts` answers from stored days.
    """
    rows = since(fact, as_of, days)

    def distinct(key: str) -> Column:
        return rows.groupBy(key).agg(F.lit(1)).agg(F.count(key)).scalar()

    total = F.coalesce(F.sum("line_total"), F.lit(0).cast("decimal(15,2)"))
    counted = [F.approx_count_distinct(c).alias(c) for c in ("customer_key", "product_key")] if approximate else []
    found = rows.agg(
        F.count(F.lit(1)).alias("total_transactions"),
        total.cast("decimal(28,2)").alias("total_revenue"),
        F.coalesce(
            F.try_divide(total.cast("double"), F.count("line_total")), F.lit(0.0)
        ).alias("avg_transaction_value"),
        *counted,
    )
    customers, products = (F.col(c) if approximate else distinct(c) for c in ("customer_key", "product_key"))
    return found.select(
        "total_transactions",
        "total_revenue",
        "avg_transaction_value",
        customers.alias("unique_customers"),
        products.alias("unique_products"),
        F.lit(days).alias("period_days"),
    )


def top_products(
    fact: DataFrame, products: DataFrame, as_of: str, limit: int = 10, days: int = 365
) -> DataFrame:
    """Best sellers by revenue; equal revenue is ordered by stock code.

    Revenue is summed per product key first, so the join only sees one row
    per product.
    """
    totals = (
        since(fact, as_of, days)
        .groupBy("product_key")
        .agg(
            F.sum(F.col("quantity").cast("bigint")).alias("total_quantity_sold"),
            F.sum("line_total").cast("decimal(28,2)").alias("total_revenue"),
            F.count(F.lit(1)).alias("transaction_count"),
        )
    )
    return (
        totals.join(products.select("product_key", "stock_code", "description"), "product_key")
        .orderBy(F.desc("total_revenue"), "stock_code")
        .limit(limit)
        .select(
            F.col("description").alias("product_name"),
            "stock_code",
            "total_quantity_sold",
            "total_revenue",
            "transaction_count",
        )
    )


def customer_stats(
    fact: DataFrame, customers: DataFrame, as_of: str, days: int = 365
) -> DataFrame:
    """Customers, recently active customers and countries among the buyers.

    The fact table shrinks to one row per buyer before the join. A buyer is in
    it once, so plain counts replace distinct counts.
    """
    start = F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL {int(days)} DAYS")
    buyers = fact.groupBy("customer_key").agg(F.max("transaction_datetime").alias("_latest"))
    homes = customers.select("customer_key", "country")
    by_country = (
        buyers.join(homes, "customer_key")
        .groupBy("country")
        .agg(
            F.count("customer_key").alias("_buyers"),
            F.count_if(F.col("_latest") >= start).alias("_active"),
        )
    )
    return by_country.agg(
        F.coalesce(F.sum("_buyers"), F.lit(0)).alias("total_customers"),
        F.coalesce(F.sum("_active"), F.lit(0)).alias("active_customers_365d"),
        F.count("country").alias("countries_served"),
    )


def count_sales(fact: DataFrame) -> DataFrame:
    return fact.agg(F.count(F.lit(1)).alias("total_sales"))


def recent_sales(fact: DataFrame, limit: int = 100) -> DataFrame:
    """Latest rows by load time; later and larger sales come first among equals."""
    return fact.orderBy(
        F.desc("created_at"),
        F.desc("transaction_datetime"),
        F.desc("line_total"),
        "invoice_no",
        "product_key",
        "transaction_type",
        "sales_key",
    ).limit(limit)


def distinct_count(fact: DataFrame, column: str, name: str) -> DataFrame:
    return fact.agg(F.count_distinct(column).alias(name))
