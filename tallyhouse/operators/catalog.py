"""What tables there are, what their columns mean, and how they relate."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions.rules import CLEANING_RULES, Rule
from tallyhouse.operators import lineage
from tallyhouse.schemas import DEFAULTS, RAW_COLUMNS, REQUIRED

# What each table and column holds.
TABLE_DESCRIPTIONS = {
    "fact_sales": "Core sales transactions with foreign keys to dimension tables",
    "dim_customer": "Customer dimension with SCD Type 2 for tracking changes",
    "dim_product": "Product master data with SCD Type 1 implementation",
    "dim_date": "Date dimension for time-based analysis",
    "data_lineage": "ETL job execution tracking and audit trail",
    "data_quality_metrics": "Data quality measurements and monitoring",
}
COLUMN_DESCRIPTIONS = {
    ("fact_sales", "sales_key"): "Surrogate primary key",
    ("fact_sales", "date_key"): "Foreign key to dim_date",
    ("fact_sales", "customer_key"): "Foreign key to dim_customer",
    ("fact_sales", "product_key"): "Foreign key to dim_product",
    ("fact_sales", "invoice_no"): "Business invoice number",
    ("fact_sales", "quantity"): "Number of items sold",
    ("fact_sales", "unit_price"): "Price per unit",
    ("fact_sales", "line_total"): "Total line amount (quantity * unit_price)",
    ("fact_sales", "transaction_type"): "SALE or RETURN",
    ("fact_sales", "batch_id"): "ETL batch identifier",
    ("dim_customer", "customer_key"): "Surrogate primary key",
    ("dim_customer", "customer_id"): "Business customer identifier",
    ("dim_customer", "country"): "Customer country",
    ("dim_customer", "is_current"): "Current record flag for SCD Type 2",
    ("dim_product", "product_key"): "Surrogate primary key",
    ("dim_product", "stock_code"): "Business product identifier",
    ("dim_product", "description"): "Product description",
}

# Child table and column, parent table and column.
RELATIONSHIPS = [
    ("fact_sales", "date_key", "dim_date", "date_key"),
    ("fact_sales", "customer_key", "dim_customer", "customer_key"),
    ("fact_sales", "product_key", "dim_product", "product_key"),
    ("fact_sales", "version_id", "data_versions", "version_id"),
]

# Dimension, the source columns it is made of, how it keeps changes.
DIMENSIONS = [
    ("dim_customer", ["CustomerID", "Country"], "SCD2"),
    ("dim_product", ["StockCode", "Description"], "SCD1"),
    ("dim_date", ["InvoiceDate"], "insert if absent"),
]


def column_catalog(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """One row per column, from the frames' own schemas.

    A Parquet column may always be null; whether it is meant to be is declared. Tables the package does not declare
    say what their frames say.
    """
    rows = [
        (
            name,
            TABLE_DESCRIPTIONS.get(name, f"Table: {name}"),
            field.name,
            place,
            field.dataType.simpleString(),
            field.name not in REQUIRED[name] if name in REQUIRED else field.nullable,
            DEFAULTS.get((name, field.name)),
            COLUMN_DESCRIPTIONS.get((name, field.name), f"Column: {field.name}"),
        )
        for name, df in tables.items()
        for place, field in enumerate(df.schema, start=1)
    ]
    return spark.createDataFrame(
        rows,
        "table_name string, table_description string, column_name string,"
        " ordinal_position int, data_type string, is_nullable boolean,"
        " column_default string, column_description string",
    )


def filled_columns(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and non-null values of every column, one pass per table."""
    parts = []
    for name, df in tables.items():
        totals = [F.count(F.lit(1)).alias("rows")]
        totals += [F.count(F.col(c)).alias(f"c{i}") for i, c in enumerate(df.columns)]
        pairs = ", ".join(f"'{c}', c{i}" for i, c in enumerate(df.columns))
        parts.append(
            df.agg(*totals)
            .selectExpr("rows", f"stack({len(df.columns)}, {pairs}) AS (column_name, non_null)")
            .select(F.lit(name).alias("table_name"), "column_name", "rows", "non_null")
        )
    return _union(parts)


def table_sizes(tables: dict[str, DataFrame]) -> DataFrame:
    return _union(
        [
            df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table_name"), "row_count"
            )
            for name, df in tables.items()
        ]
    )


def relationships(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        RELATIONSHIPS,
        "child_table string, child_column string, parent_table string, parent_column string",
    )


def dictionary(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: its meaning, its columns with the values they hold, its size and its parents."""
    columns = column_catalog(spark, tables).join(
        filled_columns(tables), ["table_name", "column_name"]
    )
    sizes = table_sizes(tables)
    parents = (
        relationships(spark)
        .groupBy(F.col("child_table").alias("table_name"))
        .agg(F.sort_array(F.collect_list(F.struct("child_column", "parent_table", "parent_column"))).alias("relationships"))
    )
    # A table has a fixed number of columns, so these lists cannot grow with data.
    return (
        columns.groupBy("table_name", "table_description")
        .agg(
            F.sort_array(
                F.collect_list(
                    F.struct(
                        "ordinal_position",
                        "column_name",
                        "data_type",
                        "is_nullable",
                        "column_default",
                        "column_description",
                        "non_null",
                    )
                )
            ).alias("columns")
        )
        .join(sizes, "table_name")
        .join(parents, "table_name", "left")
    )


def export_dictionary(spark: SparkSession, tables: dict[str, DataFrame], path: str) -> None:
    """The data dictionary as JSON lines, one document per table."""
    dictionary(spark, tables).write.json(path)


def sources(runs: DataFrame) -> DataFrame:
    """What the warehouse was loaded from, told by its finished runs; one row per source."""
    return (
        runs.filter("status = 'SUCCESS'")
        .groupBy("source_system", "source_file")
        .agg(
            F.count(F.lit(1)).alias("loads"),
            F.sum("records_processed").alias("records_processed"),
            F.sum("records_rejected").alias("records_rejected"),
            F.min("created_at").alias("first_loaded"),
            F.max("created_at").alias("last_loaded"),
        )
        .withColumn("columns", F.array(*map(F.lit, RAW_COLUMNS)))
    )


def transformations(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    """What happens to a line on its way: the rules as they are set, the dimensions, the fact; one row per step."""
    steps = [
        ("data_cleaning" if r in CLEANING_RULES else "validation", r.name, r.columns, r.severity if r.enabled else "OFF")
        for r in rules
    ]
    steps += [("dimension_creation", *d) for d in DIMENSIONS]
    steps.append(("fact_creation", "fact_sales", [c for t, c, _, _ in RELATIONSHIPS if t == "fact_sales"], "one row per accepted line"))
    return spark.createDataFrame(steps, "process string, name string, columns array<string>, mode string")


def repository(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    runs: DataFrame,
    storage: DataFrame,
    rules: list[Rule],
    recent: int = 5,
) -> DataFrame:
    """Everything known about a warehouse: section, name and a JSON document per row.

    `storage` has one row per table, its name first. All sections are of a size that does not grow with the data but
    for the sources, one row each.
    """

    def section(label: str, name, df: DataFrame) -> DataFrame:
        document = F.to_json(F.struct(*df.columns))
        return df.select(F.lit(label).alias("section"), name.alias("name"), document.alias("document"))

    return _union(
        [
            section("data_dictionary", F.col("table_name"), dictionary(spark, tables)),
            section("data_sources", F.concat_ws(":", "source_system", "source_file"), sources(runs)),
            section("transformations", F.col("name"), transformations(spark, rules)),
            section("storage_locations", F.col("table_name"), storage),
            section("recent_runs", F.col("batch_id"), lineage.recent_runs(runs, recent)),
        ]
    )


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
