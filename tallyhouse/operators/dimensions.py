"""Date, product and customer dimensions and their change handling."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.carry import carry_last
from tallyhouse.operators.keys import assign_keys, highest, position
from tallyhouse.schemas import DIM_CUSTOMER, DIM_DATE, DIM_PRODUCT

GUEST = "GUEST"


def date_key(day: Column) -> Column:
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def date_dimension(lines: DataFrame, day: str = "transaction_date") -> DataFrame:
    """One row per day that occurs; weeks and weekdays follow ISO, Monday is 1."""
    d = F.col("date_value")
    days = lines.select(F.col(day).alias("date_value")).filter(d.isNotNull()).distinct()
    return days.select(
        date_key(d).alias("date_key"),
        "date_value",
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.weekofyear(d).alias("week"),
        F.dayofyear(d).alias("day_of_year"),
        F.dayofmonth(d).alias("day_of_month"),
        (F.weekday(d) + 1).alias("day_of_week"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.concat(F.lit("Q"), F.quarter(d)).alias("quarter_name"),
        (F.weekday(d) >= 5).alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
    )


def product_attributes(lines: DataFrame) -> DataFrame:
    """Per stock code: longest description, latest category, any gift flag.

    Lines are first reduced to the distinct variants of a product; that step
    keeps fixed-width values only and combines before the shuffle.
    """
    variants = lines.groupBy(
        "stock_code", "description", "category", "subcategory", "is_gift"
    ).agg(F.min(position()).alias("_first"), F.max(position()).alias("_latest"))
    latest = "_latest"
    return variants.groupBy("stock_code").agg(
        F.max_by(
            F.trim("description"), F.struct(F.length(F.trim("description")), -F.col("_first"))
        ).alias("description"),
        F.max_by("category", F.when(F.col("category") != "", F.col(latest))).alias("category"),
        F.max_by("subcategory", F.when(F.col("subcategory") != "", F.col(latest))).alias(
            "subcategory"
        ),
        F.bool_or("is_gift").alias("is_gift"),
    )


def customer_attributes(lines: DataFrame) -> DataFrame:
    """Per customer the first country seen; a blank customer is the guest."""
    named = F.when(F.coalesce("customer_id", F.lit("")) == "", GUEST).otherwise(
        F.col("customer_id")
    )
    homes = lines.groupBy(named.alias("customer_id"), "country").agg(
        F.min(position()).alias("_first")
    )
    country = F.min_by("country", F.when(F.col("country").isNotNull(), F.col("_first")))
    return homes.groupBy("customer_id").agg(
        F.coalesce(country, F.lit("Unknown")).alias("country")
    )


def _typed(df: DataFrame, schema) -> DataFrame:
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def new_products(attributes: DataFrame, after: Column, loaded_at: str, source: str) -> DataFrame:
    """Keyed product rows for stock codes the dimension does not hold yet."""
    keyed = assign_keys(attributes, "stock_code", "product_key", after)
    now = F.lit(loaded_at).cast("timestamp_ntz")
    return _typed(
        keyed.withColumns(
            {
                "version_id": F.lit(None),
                "version_created_at": F.lit(None),
                "is_active": F.lit(True),
                "created_at": now,
                "updated_at": now,
                "data_source": F.lit(source),
            }
        ),
        DIM_PRODUCT,
    )


def new_customers(attributes: DataFrame, after: Column, loaded_at: str, source: str) -> DataFrame:
    """Keyed, current customer rows for ids the dimension does not hold yet."""
    keyed = assign_keys(attributes, "customer_id", "customer_key", after)
    now = F.lit(loaded_at).cast("timestamp_ntz")
    return _typed(
        keyed.withColumns(
            {
                "effective_date": now,
                "expiry_date": F.lit(None),
                "version_id": F.lit(None),
                "version_created_at": F.lit(None),
                "is_current": F.lit(True),
                "created_at": now,
                "updated_at": now,
                "data_source": F.lit(source),
            }
        ),
        DIM_CUSTOMER,
    )


def changed_products(
    existing: DataFrame, attributes: DataFrame, loaded_at: str, source: str = "CSV"
) -> DataFrame:
    """The rows an upsert writes: known products with their new attributes and old keys, and new products."""
    incoming = attributes.select(
        "stock_code", *[F.col(c).alias(f"_{c}") for c in attributes.columns if c != "stock_code"]
    )
    updated = existing.join(incoming, "stock_code").withColumns(
        {
            **{c: F.col(f"_{c}") for c in ("description", "category", "subcategory", "is_gift")},
            "updated_at": F.lit(loaded_at).cast("timestamp_ntz"),
            "data_source": F.lit(source),
        }
    )
    unknown = attributes.join(existing.select("stock_code"), "stock_code", "left_anti")
    added = new_products(unknown, highest(existing, "product_key"), loaded_at, source)
    return _typed(updated, DIM_PRODUCT).unionByName(added)


def upsert_products(
    existing: DataFrame, attributes: DataFrame, loaded_at: str, source: str = "CSV"
) -> DataFrame:
    """Overwrite the attributes of known products, keep their keys, add the rest."""
    untouched = existing.join(attributes.select("stock_code"), "stock_code", "left_anti")
    return _typed(untouched, DIM_PRODUCT).unionByName(
        changed_products(existing, attributes, loaded_at, source)
    )


def absent_customers(
    existing: DataFrame, attributes: DataFrame, loaded_at: str, source: str = "CSV"
) -> DataFrame:
    """Rows for the customers the dimension does not hold yet."""
    unknown = attributes.join(existing.select("customer_id"), "customer_id", "left_anti")
    return new_customers(unknown, highest(existing, "customer_key"), loaded_at, source)


def insert_absent_customers(
    existing: DataFrame, attributes: DataFrame, loaded_at: str, source: str = "CSV"
) -> DataFrame:
    """Add unknown customers; known ones stay exactly as they are."""
    added = absent_customers(existing, attributes, loaded_at, source)
    return _typed(existing, DIM_CUSTOMER).unionByName(added)


def absent_dates(existing: DataFrame, days: DataFrame) -> DataFrame:
    """Days the dimension does not hold yet; `days` comes from date_dimension."""
    return _typed(days.join(existing.select("date_key"), "date_key", "left_anti"), DIM_DATE)


def insert_absent_dates(existing: DataFrame, days: DataFrame) -> DataFrame:
    """Add days the dimension does not hold yet."""
    return _typed(existing, DIM_DATE).unionByName(absent_dates(existing, days))


def customer_history(lines: DataFrame) -> DataFrame:
    """One row per stretch of time a customer kept a country.

    A change of country closes the open row and opens the next. Both looks, back
    for the previous country and ahead for the next change, go through daily
    chunks, so a customer with very many lines is spread over days.
    """
    seen = (
        lines.filter(F.col("transaction_datetime").isNotNull())
        .groupBy("customer_id", "transaction_datetime")
        .agg(F.min("country").alias("country"))
        .withColumn("_day", F.to_date("transaction_datetime"))
    )
    back = carry_last(
        seen, ["customer_id"], "_day", "transaction_datetime", "country", "_previous"
    )
    starts = back.filter(~F.col("country").eqNullSafe(F.col("_previous"))).select(
        "customer_id",
        "country",
        F.col("transaction_datetime").alias("effective_date"),
        F.to_date("transaction_datetime").alias("_day"),
    )
    closed = carry_last(
        starts.withColumn("_start", F.col("effective_date")),
        ["customer_id"],
        "_day",
        "effective_date",
        "_start",
        "expiry_date",
        backward=True,
    )
    return closed.select(
        "customer_id",
        "country",
        "effective_date",
        "expiry_date",
        F.col("expiry_date").isNull().alias("is_current"),
    )


def as_of(lines: DataFrame, history: DataFrame) -> DataFrame:
    """Attach the version that was valid at each line's time.

    A customer has few versions and their times do not overlap, so lines meet
    versions by customer, with the time as a further condition: a line finds one
    at most. The versions are the small side; how the two meet is left to their
    size, and a customer with very many lines to the skew-join split.
    """
    versions = history.select(
        F.col("customer_id").alias("_customer"),
        F.col("country").alias("version_country"),
        F.col("effective_date").alias("version_effective_date"),
        F.col("expiry_date").alias("version_expiry_date"),
    )
    at = F.col("transaction_datetime")
    valid = (
        (F.col("customer_id") == F.col("_customer"))
        & (F.col("version_effective_date") <= at)
        & (F.col("version_expiry_date").isNull() | (at < F.col("version_expiry_date")))
    )
    return lines.join(versions, valid, "left").drop("_customer")
