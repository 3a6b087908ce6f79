"""Every operator as a named query over the order tables, with SQL to check it.

A query either reads the sales view itself, or the warehouse that one load of
that view has filled; the load runs once per session and data folder.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.functions import classify, cleaning, free_dates, rules, validation
from tallyhouse.operators import (
    analytics,
    catalog,
    day_counts,
    dimensions,
    duplicates,
    fact,
    keys,
    lineage,
    missing,
    outliers,
    quality,
    snapshots,
    transform,
    trends,
    verdict,
)
from tallyhouse.operators.feed_state import FeedState
from tallyhouse.plans.oracle_catalog import CATALOG_ROWS
from tallyhouse.plans.oracle_views import VIEWS
from tallyhouse.plans.oracle_views import query as sql
from tallyhouse.plans.warehouse import Warehouse, alert_rows
from tallyhouse.schemas import RAW_COLUMNS
from tallyhouse.session import CODEC, new_folder, tune
from tallyhouse.sources import files
from tallyhouse.sources.testdata import (
    EVENTS_AS_OF,
    LOADED_AT,
    SALES_AS_OF,
    quality_history,
    sales_view,
    table,
)
from tallyhouse.streaming import incremental, lateness

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

CHECKS = verdict.Checks(SALES_AS_OF)
BATCH = "batch-1"
_WAREHOUSES: dict[tuple[str, ...], Warehouse] = {}


def plain(df: DataFrame) -> DataFrame:
    """Only types that both engines print alike: text, long, double, boolean."""
    columns = []
    for field in df.schema:
        c, kind = F.col(field.name), field.dataType
        if isinstance(kind, (T.DateType, T.TimestampNTZType, T.TimestampType)):
            c = c.cast("string")
        elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(kind, (T.DecimalType, T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), 4)
        columns.append(c.alias(field.name))
    return df.select(columns)


def register(name: str, check: str | None = None, views: dict[str, str] | None = None):
    def add(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(function(tune(spark), sf_dir))

        run.__name__ = name
        run.__doc__ = function.__doc__
        QUERIES[name] = run
        if check is not None:
            ORACLES[name] = sql(check, views)
        return function

    return add


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The warehouse loaded from a data folder, once per session and folder."""
    at = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if at not in _WAREHOUSES:
        opened = Warehouse(spark, new_folder(spark, "warehouse"))
        opened.load(
            sales_view(spark, sf_dir),
            CHECKS,
            BATCH,
            LOADED_AT,
        )
        _WAREHOUSES[at] = opened
    return _WAREHOUSES[at]


def warehouse_of_three(spark: SparkSession, sf_dir: str) -> Warehouse:
    """A warehouse that one feed has filled in three loads, merged since; once per session and folder.

    An invoice's lines come in different loads: a line's place begins with its number in the order.
    """
    at = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), "three")
    if at not in _WAREHOUSES:
        opened, raw = Warehouse(spark, new_folder(spark, "warehouse")), sales_view(spark, sf_dir)
        for i, (first, end) in enumerate(((0, 3), (3, 5), (5, 2000)), start=1):
            part = raw.filter((F.col("pos") >= first * 2**52) & (F.col("pos") < end * 2**52))
            opened.load(part, CHECKS, f"part-{i}", f"{LOADED_AT[:10]} 0{i}:00:00", source_file=f"part-{i}.csv", feed="sales")
        opened.compact(whole=True)
        _WAREHOUSES[at] = opened
    return _WAREHOUSES[at]


# Which of the three loads a line comes with.
_PART = "CASE WHEN pos < 3 * 4503599627370496 THEN 1 WHEN pos < 5 * 4503599627370496 THEN 2 ELSE 3 END"

_HISTORY_AT = f"TIMESTAMP '{EVENTS_AS_OF}'"
_TREND = {
    "days": f"SELECT CAST(measured_at AS DATE) AS day, avg(CAST(metric_value AS DOUBLE)) AS avg_score, count(*) AS checks_count,"
    f" count(*) FILTER (WHERE metric_value < 90) AS poor_quality_count FROM history WHERE measured_at >= {_HISTORY_AT} - INTERVAL 30 DAY GROUP BY 1",
    "lagged": "SELECT *, lag(metric_value) OVER (PARTITION BY table_name, metric_name ORDER BY measured_at, metric_id) AS previous"
    f" FROM history WHERE measured_at >= {_HISTORY_AT} - INTERVAL 7 DAY",
    "drops": "SELECT metric_id, table_name, metric_name, CAST(metric_value AS DOUBLE) AS current_score, CAST(previous AS DOUBLE) AS previous_score,"
    " CAST(previous - metric_value AS DOUBLE) AS score_drop, CAST(measured_at AS VARCHAR) AS measured_at, 'HIGH' AS severity"
    " FROM lagged WHERE previous - metric_value > 90",
}


def use_warehouse(spark: SparkSession, sf_dir: str, house: Warehouse) -> None:
    """Answer the queries on a data folder from a warehouse that is already there."""
    _WAREHOUSES[(spark.sparkContext.applicationId, sf_dir.rstrip("/"))] = house


def _kept(rows: DataFrame) -> DataFrame:
    """Rows that are read more than once, stored as a load stores its lines and members."""
    folder = new_folder(rows.sparkSession, "kept")
    rows.write.parquet(folder, compression=CODEC)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def write_text(raw: DataFrame, folder: str) -> None:
    """Raw lines as delimited text, white space kept as it is."""
    (
        raw.select(RAW_COLUMNS)
        .write.option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(folder)
    )


# ---- sources and sinks


@register(
    "ingest_gate",
    "SELECT seq, pos, InvoiceNo AS invoice_text, is_admitted FROM gated",
)
def ingest_gate(spark, sf_dir):
    lines = files.gate(sales_view(spark, sf_dir, validation.GATE_COLUMNS))
    return lines.select("seq", "pos", F.col("InvoiceNo").alias("invoice_text"), "is_admitted")


@register(
    "provenance_stamp",
    f"SELECT seq, pos, '{BATCH}' AS batch_id, 'CSV' AS data_source, '{LOADED_AT}' AS created_at FROM raw_sales",
)
def provenance_stamp(spark, sf_dir):
    lines = files.stamp(sales_view(spark, sf_dir, ["InvoiceNo"]), BATCH, LOADED_AT)
    return lines.select("seq", "pos", "batch_id", "data_source", "created_at")


@register(
    "ingest_metrics",
    "SELECT count(*) AS records_read, count(*) FILTER (WHERE is_admitted) AS records_valid,"
    " count(*) FILTER (WHERE NOT is_admitted) AS records_invalid FROM gated",
)
def ingest_metrics(spark, sf_dir):
    return files.gate_counts(sales_view(spark, sf_dir, validation.GATE_COLUMNS))


@register(
    "csv_scan",
    "SELECT nullif(InvoiceNo, '') AS invoice_no, StockCode AS stock_code, nullif(Description, '') AS description,"
    " QuantityText AS quantity, InvoiceDate AS invoice_date, UnitPrice AS unit_price,"
    " nullif(CustomerID, '') AS customer_id, nullif(Country, '') AS country FROM raw_sales",
)
def csv_scan(spark, sf_dir):
    """Write the sales view as delimited text and scan it."""
    folder = new_folder(spark, "csv")
    write_text(sales_view(spark, sf_dir), folder)
    names = ["invoice_no", "stock_code", "description", "quantity", "invoice_date", "unit_price", "customer_id", "country"]
    scanned = files.read_csv(spark, folder)
    return scanned.select([F.col(c).alias(n) for c, n in zip(RAW_COLUMNS, names)])


# Every fiftieth order or so has a field too many, none but a delimiter, or a delimiter in an unquoted text.
_MALFORMED = {
    "written": """
        SELECT *, CASE WHEN seq % 50 = 0 THEN 'surplus' WHEN seq % 51 = 0 THEN 'empty' WHEN seq % 52 = 0 THEN 'unquoted' ELSE '' END AS fault
        FROM raw_sales""",
    "file_lines": """
        SELECT *, InvoiceNo || ',' || StockCode || ',' || CASE WHEN fault = 'unquoted' THEN 'LAMP, LARGE' ELSE '"' || Description || '"' END
          || ',' || QuantityText || ',' || InvoiceDate || ',' || UnitPrice || ',' || CustomerID || ',' || Country
          || CASE fault WHEN 'surplus' THEN ',SURPLUS' WHEN 'empty' THEN ',' ELSE '' END AS line
        FROM written""",
    "whole": "SELECT * EXCLUDE (fault) FROM written WHERE fault = ''",
    "gated": VIEWS["gated"].replace("FROM raw_sales", "FROM whole"),
}


def _malformed_text(spark, sf_dir) -> str:
    """The sales view as delimited text with faulty lines; lines of an invoice in their order, in one file."""
    raw = sales_view(spark, sf_dir)
    fault = F.when(F.col("seq") % 50 == 0, "surplus").when(F.col("seq") % 51 == 0, "empty").when(F.col("seq") % 52 == 0, "unquoted").otherwise("")
    text = F.when(fault == "unquoted", F.lit("LAMP, LARGE")).otherwise(F.concat(F.lit('"'), "Description", F.lit('"')))
    tail = F.when(fault == "surplus", F.lit(",SURPLUS")).when(fault == "empty", F.lit(",")).otherwise("")
    fields = [text if c == "Description" else F.col(c) for c in RAW_COLUMNS]
    line = F.concat(F.concat_ws(",", *fields), tail)
    folder = new_folder(spark, "csv")
    (
        raw.select("seq", "pos", line.alias(",".join(RAW_COLUMNS)))
        .repartitionByRange("seq")
        .sortWithinPartitions("seq", "pos")
        .drop("seq", "pos")
        .write.option("header", True)
        .option("sep", "\x01")
        .option("quote", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(folder)
    )
    return folder


@register(
    "csv_malformed",
    """
    SELECT nullif(InvoiceNo, '') AS invoice_no, StockCode AS stock_code,
      CASE WHEN fault = 'unquoted' THEN 'LAMP' ELSE nullif(Description, '') END AS description,
      CASE WHEN fault = 'unquoted' THEN ' LARGE' ELSE QuantityText END AS quantity,
      CASE WHEN fault = 'unquoted' THEN QuantityText ELSE InvoiceDate END AS invoice_date,
      CASE WHEN fault = 'unquoted' THEN InvoiceDate ELSE UnitPrice END AS unit_price,
      CASE WHEN fault = 'unquoted' THEN UnitPrice ELSE nullif(CustomerID, '') END AS customer_id,
      nullif(CASE WHEN fault = 'unquoted' THEN CustomerID ELSE Country END, '') AS country,
      CASE WHEN fault <> '' THEN line END AS raw_line
    FROM file_lines""",
    _MALFORMED,
)
def csv_malformed(spark, sf_dir):
    """Lines with more fields than the header keep their whole text."""
    names = ["invoice_no", "stock_code", "description", "quantity", "invoice_date", "unit_price", "customer_id", "country"]
    scanned = files.read_csv(spark, _malformed_text(spark, sf_dir))
    return scanned.select(*[F.col(c).alias(n) for c, n in zip(RAW_COLUMNS, names)], "raw_line")


@register(
    "malformed_load",
    "SELECT coalesce(reject_reason, 'accepted') AS verdict, '' AS raw_line, count(*) AS lines FROM judged GROUP BY 1"
    " UNION ALL SELECT 'malformed_line', line, count(*) FROM file_lines WHERE fault <> '' GROUP BY line"
    " UNION ALL SELECT 'missing', '', 0",
    _MALFORMED,
)
def malformed_load(spark, sf_dir):
    """A load of text with faulty lines: by verdict, those in quarantine with their text, and none unaccounted for."""
    house = Warehouse(spark, new_folder(spark, "warehouse"))
    counts = house.load(files.read_csv(spark, _malformed_text(spark, sf_dir)), CHECKS, BATCH, LOADED_AT)
    lines = F.count(F.lit(1)).alias("lines")
    ended = house.quarantine().groupBy(F.col("reject_reason").alias("verdict"), F.coalesce("raw_line", F.lit("")).alias("raw_line")).agg(lines)
    taken = house.fact_sales().agg(lines).select(F.lit("accepted").alias("verdict"), F.lit("").alias("raw_line"), "lines")
    missing = counts["records_read"] - counts["gate_rejected"] - counts["records_rejected"] - counts["records_inserted"]
    return ended.unionByName(taken).unionByName(spark.createDataFrame([("missing", "", missing)], "verdict string, raw_line string, lines bigint"))


@register(
    "table_source",
    "SELECT count(*) AS lines, count(DISTINCT InvoiceNo) AS invoices FROM raw_sales",
)
def table_source(spark, sf_dir):
    """Any frame with the eight columns can be the source of a load."""
    lines = files.from_table(sales_view(spark, sf_dir).select(RAW_COLUMNS))
    return lines.agg(
        F.count("row_id").alias("lines"), F.count_distinct("InvoiceNo").alias("invoices")
    )


@register(
    "partitioned_fact_sink",
    "SELECT txn_year, count(*) AS rows_written, CAST(sum(line_total) AS DOUBLE) AS line_total FROM fact GROUP BY 1",
)
def partitioned_fact_sink(spark, sf_dir):
    """What the year partitions of the fact table hold once read back."""
    facts = warehouse(spark, sf_dir).fact_sales()
    return facts.groupBy("txn_year").agg(
        F.count(F.lit(1)).alias("rows_written"), F.sum("line_total").alias("line_total")
    )


@register(
    "quarantine_sink",
    "SELECT seq, pos, InvoiceNo AS invoice_text, StockCode AS stock_text, QuantityText AS quantity_text,"
    " InvoiceDate AS date_text, UnitPrice AS price_text, customer_id, reject_reason"
    " FROM judged WHERE reject_reason IS NOT NULL",
)
def quarantine_sink(spark, sf_dir):
    rows = warehouse(spark, sf_dir).quarantine()
    return rows.select(
        "seq",
        "pos",
        F.col("InvoiceNo").alias("invoice_text"),
        F.col("StockCode").alias("stock_text"),
        F.col("Quantity").alias("quantity_text"),
        F.col("InvoiceDate").alias("date_text"),
        F.col("UnitPrice").alias("price_text"),
        "customer_id",
        "reject_reason",
    )


@register(
    "load_balance",
    "SELECT count(*) AS records_read, count(*) FILTER (WHERE NOT is_admitted) AS gate_rejected,"
    " count(*) FILTER (WHERE is_admitted AND reject_reason IS NOT NULL) AS records_rejected,"
    " count(*) FILTER (WHERE reject_reason IS NULL) AS records_inserted, 0::BIGINT AS missing FROM judged",
)
def load_balance(spark, sf_dir):
    """Every line read, by where it ended: turned away, in quarantine, or in the fact table."""
    house = warehouse(spark, sf_dir)
    told = F.from_json("job_metadata", "records_read bigint, gate_rejected bigint")
    run = house.data_lineage().select(told.alias("m"), "records_rejected", "records_inserted")
    refused = house.quarantine().agg(
        F.count_if(F.col("reject_reason") == verdict.GATE).alias("gate"),
        F.count_if(F.col("reject_reason") != verdict.GATE).alias("refused"),
    )
    facts = house.fact_sales().agg(F.count(F.lit(1)).alias("facts"))
    return run.select(
        "m.records_read",
        "m.gate_rejected",
        "records_rejected",
        "records_inserted",
        (
            F.col("m.records_read")
            - refused.select("gate").scalar()
            - refused.select("refused").scalar()
            - facts.scalar()
        ).alias("missing"),
    )


_FACT_SUITE = """
    SELECT 'fact_sales' AS table_name, * FROM (
      SELECT 'invoice_no' AS column_name, 'invoice_completeness' AS metric_name, 'completeness' AS metric_type,
             count(invoice_no) AS hits, count(*) AS rows_checked, 95.0 AS threshold_value FROM fact
      UNION ALL SELECT 'product_key', 'product_completeness', 'completeness', count(product_key), count(*), 95.0 FROM fact
      UNION ALL SELECT 'customer_key', 'customer_completeness', 'completeness', count(customer_key), count(*), 80.0 FROM fact
      UNION ALL SELECT 'sales_key', 'transaction_uniqueness', 'uniqueness', count(DISTINCT (invoice, stock_code)), count(*), 99.0 FROM fact
      UNION ALL SELECT 'quantity', 'quantity_range', 'validity', count(*) FILTER (WHERE quantity BETWEEN -1000 AND 10000), count(quantity), 95.0 FROM fact
      UNION ALL SELECT 'unit_price', 'price_range', 'validity', count(*) FILTER (WHERE unit_price BETWEEN 0 AND 1000), count(unit_price), 98.0 FROM fact
      UNION ALL SELECT 'transaction_datetime', 'date_validity', 'validity', count(transaction_datetime), count(*), 100.0 FROM fact)
"""
_DIM_SUITES = """
    SELECT 'dim_customer' AS table_name, 'customer_id' AS column_name, 'customer_id_completeness' AS metric_name,
           'completeness' AS metric_type, count(*) FILTER (WHERE trim(customer_id) <> '') AS hits, count(*) AS rows_checked, 90.0 AS threshold_value FROM customers
    UNION ALL SELECT 'dim_customer', 'country', 'country_completeness', 'completeness', count(*) FILTER (WHERE trim(country) <> ''), count(*), 95.0 FROM customers
    UNION ALL SELECT 'dim_customer', 'customer_id', 'customer_id_uniqueness', 'uniqueness', count(DISTINCT customer_id), count(customer_id), 100.0 FROM customers
    UNION ALL SELECT 'dim_product', 'stock_code', 'stock_code_completeness', 'completeness', count(*) FILTER (WHERE trim(stock_code) <> ''), count(*), 100.0 FROM products
    UNION ALL SELECT 'dim_product', 'stock_code', 'stock_code_uniqueness', 'uniqueness', count(DISTINCT stock_code), count(stock_code), 100.0 FROM products
    UNION ALL SELECT 'dim_product', 'description', 'description_validity', 'validity', count(*) FILTER (WHERE length(trim(description)) >= 3), count(*), 90.0 FROM products
"""
_SUITE_VIEWS = {
    "fact_suite": _FACT_SUITE,
    "dim_suites": _DIM_SUITES,
    "suite": "SELECT * FROM fact_suite UNION ALL SELECT * FROM dim_suites",
    "scored": "SELECT *, CASE WHEN rows_checked = 0 THEN 0.0 ELSE hits * 100.0 / rows_checked END AS score FROM suite",
    "fact_scored": "SELECT * FROM scored WHERE table_name = 'fact_sales'",
}


def _results(spark, sf_dir) -> DataFrame:
    house = warehouse(spark, sf_dir)
    tables = {
        "fact_sales": house.fact_sales(),
        "dim_customer": house.dim_customer(),
        "dim_product": house.dim_product(),
    }
    whole = None
    for name, df in tables.items():
        part = quality.check(df, name)
        whole = part if whole is None else whole.unionByName(part)
    return whole


@register(
    "metrics_sink",
    "SELECT table_name, column_name, metric_name, round(CAST(score AS DOUBLE), 4) AS metric_value,"
    f" CAST(threshold_value AS DOUBLE) AS threshold_value, score >= threshold_value AS is_threshold_met, '{BATCH}' AS batch_id"
    " FROM fact_scored",
    _SUITE_VIEWS,
)
def metrics_sink(spark, sf_dir):
    """The quality rows a load stored, read back."""
    stored = warehouse(spark, sf_dir).data_quality_metrics()
    return stored.select(
        "table_name", "column_name", "metric_name", "metric_value", "threshold_value", "is_threshold_met", "batch_id"
    )


@register(
    "alerts_sink",
    "SELECT 'ERROR' AS severity, 'Quality anomalies detected' AS message, count(*) AS anomaly_count, max(score_drop) AS worst_drop,"
    " string_agg(DISTINCT table_name, ',' ORDER BY table_name) AS affected_tables FROM drops HAVING count(*) > 0",
    _TREND,
)
def alerts_sink(spark, sf_dir):
    """Alert rows over the event history, written and read back."""
    found = trends.anomaly_alert(trends.anomalies(quality_history(spark, sf_dir), EVENTS_AS_OF))
    folder = new_folder(spark, "alerts")
    alert_rows(found, LOADED_AT).write.parquet(folder)
    return spark.read.parquet(folder).select(
        "severity",
        "message",
        F.get_json_object("metadata", "$.anomaly_count").cast("bigint").alias("anomaly_count"),
        F.get_json_object("metadata", "$.worst_drop").cast("double").alias("worst_drop"),
        F.get_json_object("metadata", "$.affected_tables").alias("affected_tables"),
    )


_SIZES = (
    "SELECT 'fact_sales' AS table_name, count(*) AS row_count FROM fact"
    " UNION ALL SELECT 'dim_customer', count(*) FROM customers UNION ALL SELECT 'dim_product', count(*) FROM products"
    " UNION ALL SELECT 'dim_date', count(DISTINCT transaction_date) FROM lines"
    " UNION ALL SELECT 'data_lineage', 1 FROM fact GROUP BY 1 UNION ALL SELECT 'data_versions', 1 FROM fact GROUP BY 1"
    " UNION ALL SELECT 'data_quality_metrics', 7 FROM fact GROUP BY 1"
    " UNION ALL SELECT 'dim_transaction_type', count(*) FROM effects"
    " UNION ALL SELECT 'fact_sales_archive', count(*) FROM fact WHERE false"
    " UNION ALL SELECT 'data_quality_alerts', count(*) FILTER (WHERE score < 90) FROM (SELECT avg(score) AS score FROM fact_scored)"
)


@register("dictionary_export", _SIZES, _SUITE_VIEWS)
def dictionary_export(spark, sf_dir):
    folder = new_folder(spark, "dictionary")
    catalog.export_dictionary(spark, warehouse(spark, sf_dir).tables(), folder)
    return spark.read.json(folder).select("table_name", "row_count")


@register(
    "repository_export",
    f"""
    SELECT 'data_dictionary' AS section, s.table_name AS name, s.row_count AS amount, CAST(n AS VARCHAR) || ' columns, parents: ' || parents AS detail
    FROM ({_SIZES}) s JOIN (VALUES ('data_lineage', 18, ''), ('data_quality_alerts', 4, ''), ('data_quality_metrics', 10, ''),
      ('data_versions', 10, ''), ('dim_customer', 11, ''), ('dim_date', 14, ''), ('dim_product', 12, ''),
      ('dim_transaction_type', 3, ''), ('fact_sales', 16, 'dim_customer,dim_date,dim_product,data_versions'),
      ('fact_sales_archive', 6, '')) t(table_name, n, parents) ON s.table_name = t.table_name
    UNION ALL SELECT 'data_sources', 'CSV', count(*) FILTER (WHERE is_admitted),
      '1: InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country' FROM judged
    UNION ALL SELECT 'recent_runs', '{BATCH}', count(*) FILTER (WHERE reject_reason IS NULL), 'SUCCESS' FROM judged
    UNION ALL SELECT 'storage_locations', name, 1, cut FROM (VALUES ('judged', 'verdict'), ('unresolved', ''), ('fact_sales', 'txn_year'),
      ('dim_date', ''), ('dim_customer', ''), ('dim_product', ''), ('day_totals', ''), ('day_keys', ''), ('data_versions', ''),
      ('data_lineage', ''), ('data_quality_metrics', ''), ('data_quality_alerts', '')) t(name, cut)
    UNION ALL SELECT 'transformations', name, n, process || ': ' || columns || ' ' || mode FROM (VALUES
      ('clean_invoice_no', 1, 'data_cleaning', 'InvoiceNo', 'ERROR'), ('clean_stock_code', 1, 'data_cleaning', 'StockCode', 'ERROR'),
      ('clean_description', 1, 'data_cleaning', 'Description', 'ERROR'), ('clean_quantity', 1, 'data_cleaning', 'Quantity', 'ERROR'),
      ('clean_unit_price', 1, 'data_cleaning', 'UnitPrice', 'ERROR'), ('clean_customer_id', 1, 'data_cleaning', 'CustomerID', 'ERROR'),
      ('clean_country', 1, 'data_cleaning', 'Country', 'ERROR'), ('clean_date', 1, 'data_cleaning', 'InvoiceDate', 'ERROR'),
      ('validate_required_fields_present', 3, 'validation', 'InvoiceNo,StockCode,CustomerID', 'ERROR'),
      ('validate_invoice_format', 1, 'validation', 'InvoiceNo', 'ERROR'), ('validate_quantity_exists', 1, 'validation', 'Quantity', 'ERROR'),
      ('validate_non_negative_price', 1, 'validation', 'UnitPrice', 'ERROR'), ('validate_date_range', 1, 'validation', 'InvoiceDate', 'ERROR'),
      ('dim_customer', 2, 'dimension_creation', 'CustomerID,Country', 'SCD2'), ('dim_product', 2, 'dimension_creation', 'StockCode,Description', 'SCD1'),
      ('dim_date', 1, 'dimension_creation', 'InvoiceDate', 'insert if absent'),
      ('fact_sales', 4, 'fact_creation', 'date_key,customer_key,product_key,version_id', 'one row per accepted line')) t(name, n, process, columns, mode)""",
    _SUITE_VIEWS,
)
def repository_export(spark, sf_dir):
    """The exported repository read back: every document of it, by what it counts and what it lists."""
    folder = new_folder(spark, "repository")
    warehouse(spark, sf_dir).export_repository(folder, CHECKS)
    parsed = {
        "data_dictionary": ("row_count bigint, columns array<string>, relationships array<struct<parent_table string>>", "d.row_count",
                            "concat(size(d.columns), ' columns, parents: ', coalesce(concat_ws(',', d.relationships.parent_table), ''))"),
        "data_sources": ("loads bigint, records_processed bigint, columns array<string>", "d.records_processed",
                         "concat(d.loads, ': ', concat_ws(',', d.columns))"),
        "recent_runs": ("records_inserted bigint, status string", "d.records_inserted", "d.status"),
        "storage_locations": ("folders bigint, bytes bigint, partitioned_by array<string>", "if(d.bytes > 0, d.folders, -1)",
                              "concat_ws(',', d.partitioned_by)"),
        "transformations": ("process string, columns array<string>, mode string", "size(d.columns)",
                            "concat(d.process, ': ', concat_ws(',', d.columns), ' ', d.mode)"),
    }
    rows, whole = spark.read.schema("section string, name string, document string").json(folder), None
    for section, (schema, amount, detail) in parsed.items():
        part = rows.filter(F.col("section") == section).withColumn("d", F.from_json("document", schema))
        part = part.select("section", "name", F.expr(amount).cast("bigint").alias("amount"), F.expr(detail).alias("detail"))
        whole = part if whole is None else whole.unionByName(part)
    return whole


# ---- cleaning


def _cleaner(name: str, column: str, expression: str, function) -> None:
    @register(name, f"SELECT seq, pos, {expression} AS cleaned FROM typed")
    def clean(spark, sf_dir):
        return sales_view(spark, sf_dir, [column]).select(
            "seq", "pos", function(F.col(column)).alias("cleaned")
        )


_cleaner("clean_invoice_no", "InvoiceNo", "invoice", cleaning.clean_invoice_no)
_cleaner("clean_stock_code", "StockCode", "stock_code", cleaning.clean_stock_code)
_cleaner(
    "clean_description",
    "Description",
    "description_clean",
    lambda c: cleaning.clean_description(cleaning.fill_unknown(c)),
)
_cleaner("clean_quantity", "Quantity", "quantity", cleaning.clean_quantity)
_cleaner("clean_unit_price", "UnitPrice", "CAST(unit_price AS DOUBLE)", cleaning.clean_unit_price)
_cleaner("clean_customer_id", "CustomerID", "own", cleaning.clean_customer_id)
_cleaner(
    "clean_country", "Country", "country_clean", lambda c: cleaning.clean_country(cleaning.fill_unknown(c))
)
_cleaner("clean_date", "InvoiceDate", "CAST(ts AS VARCHAR)", cleaning.clean_date)


@register(
    "cleaning_rule_counts",
    """
    SELECT rule_name, count(*) AS rows_applied, count(*) FILTER (WHERE changed) AS rows_changed FROM (
      SELECT 'clean_invoice_no' AS rule_name, invoice <> InvoiceNo AS changed FROM typed
      UNION ALL SELECT 'clean_stock_code', stock_code <> StockCode FROM typed
      UNION ALL SELECT 'clean_quantity', CAST(quantity AS VARCHAR) <> QuantityText FROM typed
      UNION ALL SELECT 'clean_unit_price', CAST(unit_price AS VARCHAR) <> UnitPrice FROM typed
      UNION ALL SELECT 'clean_customer_id', own <> CustomerID FROM typed
      UNION ALL SELECT 'clean_description', description_clean <> Description FROM typed
      UNION ALL SELECT 'clean_country', country_clean <> Country FROM typed
      UNION ALL SELECT 'clean_date', coalesce(strftime(ts, '%Y-%m-%d %H:%M:%S') <> InvoiceDate, true) FROM typed)
    GROUP BY rule_name""",
)
def cleaning_rule_counts(spark, sf_dir):
    """Applied and effective counts of all cleaning rules, in one pass."""
    return rules.rule_counts(sales_view(spark, sf_dir), rules.CLEANING_RULES)


_BY_HAND = [
    ("d MMM yyyy", "%-d %b %Y", ""), ("MMMM d, yyyy h:mm a", "%B %-d, %Y %-I:%M %p", ""), ("EEE, dd MMM yyyy HH:mm:ss 'GMT'", "%a, %d %b %Y %H:%M:%S GMT", ""),
    ("yyyyMMdd'T'HHmmss", "%Y%m%dT%H%M%S", ""), ("yyyy-MMM-dd", "%Y-%b-%d", ""), ("dd.MM.yyyy HH:mm", "%d.%m.%Y %H:%M", ""),
    ("yyyy-MM-dd'T'HH:mm:ss'+0230'", "%Y-%m-%dT%H:%M:%S+0230", " - INTERVAL 150 MINUTE"),
]


@register(
    "clean_date_free",
    "SELECT o_orderkey, CAST(CASE "
    + " ".join(
        f"WHEN o_orderkey % {len(_BY_HAND)} = {i} THEN strptime(strftime(moment, '{written}'), '{written}'){moved}"
        for i, (_, written, moved) in enumerate(_BY_HAND)
    )
    + " END AS VARCHAR) AS parsed FROM (SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) + to_seconds(o_orderkey % 86400) AS moment FROM orders)",
)
def clean_date_free(spark, sf_dir):
    """Order times written by hand in seven layouts and read back; a layout without a clock gives midnight."""
    at = F.col("o_orderdate").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("o_orderkey") % 86400)
    written = F
    for i, (layout, _, _) in enumerate(_BY_HAND):
        written = written.when(F.col("o_orderkey") % len(_BY_HAND) == i, F.date_format(at, layout))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", written.alias("text"))
    return orders.select("o_orderkey", free_dates.clean_date_free(F.col("text")).alias("parsed"))


# ---- validation


def _validator(name: str, columns: list[str], condition: str, function) -> None:
    @register(name, f"SELECT seq, pos, {condition} AS is_valid FROM typed")
    def validate(spark, sf_dir):
        return sales_view(spark, sf_dir, columns).select(
            "seq", "pos", function(*[F.col(c) for c in columns]).alias("is_valid")
        )


_validator(
    "required_present",
    ["InvoiceNo", "StockCode", "CustomerID"],
    "invoice <> '' AND stock_code <> '' AND own <> ''",
    lambda i, s, c: validation.present(cleaning.clean_invoice_no(i))
    & validation.present(cleaning.clean_stock_code(s))
    & validation.present(cleaning.clean_customer_id(c)),
)
_validator(
    "invoice_format",
    ["InvoiceNo"],
    "regexp_matches(invoice, '^[C]?\\d{5,7}[A-Z]?$')",
    lambda c: validation.invoice_format_ok(cleaning.clean_invoice_no(c)),
)
_validator(
    "quantity_nonzero",
    ["Quantity"],
    "quantity <> 0",
    lambda c: validation.quantity_ok(cleaning.clean_quantity(c)),
)
_validator(
    "price_non_negative",
    ["UnitPrice"],
    "unit_price >= 0",
    lambda c: validation.price_ok(cleaning.clean_unit_price(c)),
)
_validator(
    "date_range",
    ["InvoiceDate"],
    f"coalesce(CAST(ts AS DATE) BETWEEN DATE '2009-01-01' AND DATE '{SALES_AS_OF}', false)",
    lambda c: validation.date_ok(cleaning.clean_date(c), SALES_AS_OF),
)


@register(
    "zero_quarantine",
    "SELECT seq, pos, CASE WHEN quantity = 0 THEN 'quantity_zero'"
    " WHEN unit_price = 0 THEN 'unit_price_zero_quarantine' END AS reject_reason"
    " FROM typed WHERE quantity = 0 OR unit_price = 0",
)
def zero_quarantine(spark, sf_dir):
    zero = F.when(
        cleaning.clean_quantity(F.col("Quantity")) == 0, verdict.ZERO_QUANTITY
    ).when(cleaning.clean_unit_price(F.col("UnitPrice")) == 0, verdict.ZERO_PRICE)
    lines = sales_view(spark, sf_dir, ["Quantity", "UnitPrice"])
    return lines.select("seq", "pos", zero.alias("reject_reason")).filter(
        F.col("reject_reason").isNotNull()
    )


def _judged(spark, sf_dir) -> DataFrame:
    return verdict.judge(
        sales_view(spark, sf_dir), CHECKS, invoice_scan=sales_view(spark, sf_dir, ["InvoiceNo"])
    )


@register("line_verdict", "SELECT seq, pos, coalesce(reject_reason, 'accepted') AS verdict FROM judged")
def line_verdict(spark, sf_dir):
    return _judged(spark, sf_dir).select(
        "seq", "pos", F.coalesce("reject_reason", F.lit("accepted")).alias("verdict")
    )


@register(
    "line_verdict_split_invoices",
    "SELECT seq, pos, customer_id, coalesce(reject_reason, 'accepted') AS verdict FROM judged",
)
def line_verdict_split_invoices(spark, sf_dir):
    """The same verdicts with invoices of more than eight lines taken apart."""
    scan = sales_view(spark, sf_dir, ["InvoiceNo"])
    return verdict.judge(_kept(sales_view(spark, sf_dir)), CHECKS, 8, scan).select(
        "seq", "pos", "customer_id", F.coalesce("reject_reason", F.lit("accepted")).alias("verdict")
    )


@register(
    "line_verdict_over_loads",
    "SELECT seq, pos, customer_id, coalesce(reject_reason, 'accepted') AS verdict FROM judged",
)
def line_verdict_over_loads(spark, sf_dir):
    """The same verdicts where the lines of an invoice come in three loads of a feed."""
    state, raw, done, parts = FeedState(spark, new_folder(spark, "feed")), sales_view(spark, sf_dir), [], []
    # A line's place begins with its number in the order.
    for first, end in ((0, 3), (3, 5), (5, 2000)):
        part = raw.filter((F.col("pos") >= first * 2**52) & (F.col("pos") < end * 2**52))
        folder = new_folder(spark, "judged")
        verdict.judge(part, CHECKS, prior=state.prior(part, done)).write.parquet(folder, compression=CODEC)
        judged, load_id = spark.read.parquet(folder), f"{len(done) + 1:08d}"
        state.remember(judged, load_id)
        done.append(load_id)
        parts.append(judged.select("seq", "pos", "customer_id", F.coalesce("reject_reason", F.lit("accepted")).alias("verdict")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_TWICE = {
    "delivered": "SELECT *, 1 AS delivery, pos AS place FROM checked UNION ALL SELECT *, 2, pos FROM checked",
    "reachable": VIEWS["reachable"].replace("FROM checked", "FROM delivered").replace("ORDER BY pos", "ORDER BY delivery, pos"),
    "settled": VIEWS["settled"].replace("ORDER BY pos", "ORDER BY delivery, pos"),
    "filled": VIEWS["filled"].replace("ORDER BY pos", "ORDER BY delivery, pos"),
    "judged": VIEWS["judged"].replace("SELECT seq,", "SELECT delivery, seq,"),
}


@register(
    "incremental_dedup",
    "SELECT delivery::BIGINT AS delivery, seq, pos, customer_id, coalesce(reject_reason, 'accepted') AS verdict FROM judged",
    _TWICE,
)
def incremental_dedup(spark, sf_dir):
    """All lines delivered twice to one feed: what the first load has accepted, the second one turns down."""
    house = Warehouse(spark, new_folder(spark, "warehouse"))
    for delivery in ("first", "second"):
        house.load(sales_view(spark, sf_dir), CHECKS, delivery, LOADED_AT, feed="sales")
    number = F.substring("load_id", 1, 8).cast("bigint")
    return house.judged_by_load().select(number.alias("delivery"), "seq", "pos", "customer_id", "verdict")


@register(
    "first_failed_rule",
    f"""
    SELECT coalesce(failed_rule, 'none') AS failed_rule, count(*) AS lines FROM (
      SELECT CASE WHEN invoice = '' OR stock_code = '' OR own = '' THEN 'validate_required_fields_present'
                  WHEN NOT regexp_matches(invoice, '^[C]?\\d{{5,7}}[A-Z]?$') THEN 'validate_invoice_format'
                  WHEN quantity = 0 THEN 'validate_quantity_exists'
                  WHEN NOT coalesce(CAST(ts AS DATE) BETWEEN DATE '2009-01-01' AND DATE '{SALES_AS_OF}', false) THEN 'validate_date_range'
             END AS failed_rule FROM typed)
    GROUP BY 1""",
)
def first_failed_rule(spark, sf_dir):
    cleaned = rules.apply_cleaning(sales_view(spark, sf_dir))
    failed = rules.first_failure(rules.validation_rules(SALES_AS_OF))
    return cleaned.groupBy(F.coalesce(failed, F.lit("none")).alias("failed_rule")).agg(
        F.count(F.lit(1)).alias("lines")
    )


@register(
    "reject_reason_counts",
    "SELECT coalesce(reject_reason, 'accepted') AS verdict, count(*) AS lines FROM judged GROUP BY 1",
)
def reject_reason_counts(spark, sf_dir):
    return verdict.reason_counts(warehouse(spark, sf_dir).judged().drop("verdict"))


_SUMMARY = """
    SELECT count(*) FILTER (WHERE is_admitted) AS total_records,
      count(*) FILTER (WHERE reject_reason IS NULL) AS records_cleaned,
      count(*) FILTER (WHERE is_admitted AND reject_reason IS NOT NULL) AS records_rejected,
      count(*) FILTER (WHERE reject_reason = 'validation_failed') AS validation_errors,
      count(*) FILTER (WHERE reject_reason = 'duplicate') AS duplicates_removed,
      round(count(*) FILTER (WHERE reject_reason IS NULL) * 100.0 / count(*) FILTER (WHERE is_admitted), 4) AS cleaning_rate
    FROM judged"""


@register("validation_summary", _SUMMARY.replace("100.0", "100.0::DOUBLE"))
def validation_summary(spark, sf_dir):
    return verdict.summary(warehouse(spark, sf_dir).judged())


# ---- missing values, duplicates, outliers


@register(
    "missing_flags",
    "SELECT seq, pos, trim(CustomerID) = '' AS customer_missing, trim(Description) = '' AS description_missing,"
    " trim(Country) = '' AS country_missing FROM raw_sales",
)
def missing_flags(spark, sf_dir):
    lines = sales_view(spark, sf_dir, ["CustomerID", "Description", "Country"])
    return lines.select(
        "seq",
        "pos",
        missing.is_missing(lines, "CustomerID").alias("customer_missing"),
        missing.is_missing(lines, "Description").alias("description_missing"),
        missing.is_missing(lines, "Country").alias("country_missing"),
    )


@register(
    "missing_drop",
    "SELECT seq, pos, CASE WHEN trim(Description) = '' THEN 'Unknown' ELSE Description END AS description_text"
    " FROM raw_sales WHERE trim(InvoiceNo) <> '' AND trim(StockCode) <> '' AND trim(CustomerID) <> ''"
    " AND trim(QuantityText) <> '' AND trim(UnitPrice) <> '' AND trim(InvoiceDate) <> ''",
)
def missing_drop(spark, sf_dir):
    kept = missing.fill(sales_view(spark, sf_dir), missing.DEFAULT_STRATEGIES)
    return kept.select("seq", "pos", F.col("Description").alias("description_text"))


@register(
    "missing_fill_constants",
    "SELECT seq, pos, CASE WHEN trim(Country) = '' THEN 'Unknown' ELSE Country END AS country_text,"
    " CASE WHEN trim(CustomerID) = '' THEN '0' ELSE CustomerID END AS customer_text FROM raw_sales",
)
def missing_fill_constants(spark, sf_dir):
    lines = sales_view(spark, sf_dir, ["Country", "CustomerID"])
    filled = missing.fill(lines, {"Country": "fill_unknown", "CustomerID": "fill_zero"})
    return filled.select(
        "seq", "pos", F.col("Country").alias("country_text"), F.col("CustomerID").alias("customer_text")
    )


def _priced(spark, sf_dir) -> DataFrame:
    """Prices of the sales view; a zero price counts as not there."""
    price = cleaning.clean_unit_price(F.col("UnitPrice")).cast("double")
    lines = sales_view(spark, sf_dir, ["UnitPrice"])
    return lines.select("seq", "pos", F.when(price != 0, price).alias("price"))


_PRICED = {"priced": "SELECT seq, pos, CASE WHEN unit_price <> 0 THEN CAST(unit_price AS DOUBLE) END AS price FROM typed"}


@register(
    "missing_fill_mean",
    "SELECT seq, pos, round(coalesce(price, (SELECT avg(price) FROM priced)), 4) AS price FROM priced",
    _PRICED,
)
def missing_fill_mean(spark, sf_dir):
    return missing.fill(_priced(spark, sf_dir), {"price": "fill_mean"})


@register(
    "missing_fill_median",
    "SELECT seq, pos, round(coalesce(price, (SELECT quantile_cont(price, 0.5) FROM priced)), 4) AS price FROM priced",
    _PRICED,
)
def missing_fill_median(spark, sf_dir):
    return missing.fill(_priced(spark, sf_dir), {"price": "fill_median"})


@register(
    "missing_fill_mode",
    "SELECT seq, pos, CASE WHEN trim(Country) <> '' THEN Country ELSE (SELECT Country FROM raw_sales WHERE trim(Country) <> ''"
    " GROUP BY Country ORDER BY count(*) DESC, min(CAST(seq AS HUGEINT) * 36028797018963968 + pos) LIMIT 1) END AS country_text FROM raw_sales",
)
def missing_fill_mode(spark, sf_dir):
    filled = missing.fill(
        sales_view(spark, sf_dir, ["Country"]), {"Country": "fill_mode"}, keys.position()
    )
    return filled.select("seq", "pos", F.col("Country").alias("country_text"))


@register(
    "customer_backfill",
    "SELECT seq, pos, invoice, customer_id FROM judged"
    " WHERE lower(trim(CustomerID)) IN ('', 'nan', 'none', 'null', 'unknown') AND customer_id IS NOT NULL",
)
def customer_backfill(spark, sf_dir):
    """Lines without a customer of their own that took one from their invoice."""
    judged = warehouse(spark, sf_dir).judged()
    took = cleaning.names_no_customer(F.col("CustomerID")) & F.col("customer_id").isNotNull()
    return judged.filter(took).select("seq", "pos", "invoice", "customer_id")


@register(
    "missing_report",
    "SELECT column_name, missing_count, total_rows FROM ("
    " SELECT 'InvoiceNo' AS column_name, count(*) FILTER (WHERE trim(InvoiceNo) = '') AS missing_count, count(*) AS total_rows FROM raw_sales"
    " UNION ALL SELECT 'StockCode', count(*) FILTER (WHERE trim(StockCode) = ''), count(*) FROM raw_sales"
    " UNION ALL SELECT 'Description', count(*) FILTER (WHERE trim(Description) = ''), count(*) FROM raw_sales"
    " UNION ALL SELECT 'Quantity', count(*) FILTER (WHERE trim(QuantityText) = ''), count(*) FROM raw_sales"
    " UNION ALL SELECT 'InvoiceDate', count(*) FILTER (WHERE trim(InvoiceDate) = ''), count(*) FROM raw_sales"
    " UNION ALL SELECT 'UnitPrice', count(*) FILTER (WHERE trim(UnitPrice) = ''), count(*) FROM raw_sales"
    " UNION ALL SELECT 'CustomerID', count(*) FILTER (WHERE trim(CustomerID) = ''), count(*) FROM raw_sales"
    " UNION ALL SELECT 'Country', count(*) FILTER (WHERE trim(Country) = ''), count(*) FROM raw_sales)",
)
def missing_report(spark, sf_dir):
    return missing.report(sales_view(spark, sf_dir), RAW_COLUMNS)


_CODED = {"coded": "SELECT seq, pos, invoice, stock_code FROM typed WHERE invoice <> ''"}


def _coded(spark, sf_dir) -> DataFrame:
    lines = sales_view(spark, sf_dir, ["InvoiceNo", "StockCode"])
    return lines.select(
        "seq",
        "pos",
        cleaning.clean_invoice_no(F.col("InvoiceNo")).alias("invoice"),
        cleaning.clean_stock_code(F.col("StockCode")).alias("stock_code"),
    ).filter("invoice <> ''")


def _deduplicator(name: str, strategy: str, check: str) -> None:
    @register(name, check, _CODED)
    def deduplicate(spark, sf_dir):
        return duplicates.deduplicate(
            _coded(spark, sf_dir), ["invoice", "stock_code"], ["seq", "pos"], strategy
        )


_RANKED = "SELECT seq, pos, invoice, stock_code FROM coded QUALIFY "
_deduplicator(
    "dedup_keep_first",
    duplicates.KEEP_FIRST,
    _RANKED + "row_number() OVER (PARTITION BY invoice, stock_code ORDER BY seq, pos) = 1",
)
_deduplicator(
    "dedup_keep_latest",
    duplicates.KEEP_LATEST,
    _RANKED + "row_number() OVER (PARTITION BY invoice, stock_code ORDER BY seq DESC, pos DESC) = 1",
)
_deduplicator(
    "dedup_remove_all",
    duplicates.REMOVE_ALL,
    _RANKED + "count(*) OVER (PARTITION BY invoice, stock_code) = 1",
)


@register(
    "duplicate_count",
    "SELECT CAST(sum(n - 1) AS BIGINT) AS duplicate_lines, count(*) FILTER (WHERE n > 1) AS duplicated_keys"
    " FROM (SELECT count(*) AS n FROM coded GROUP BY invoice, stock_code)",
    _CODED,
)
def duplicate_count(spark, sf_dir):
    return duplicates.duplicate_count(_coded(spark, sf_dir), ["invoice", "stock_code"])


@register(
    "iqr_outliers",
    "SELECT seq, pos, coalesce(price < q1 - 1.5 * (q3 - q1) OR price > q3 + 1.5 * (q3 - q1), false) AS is_outlier"
    " FROM priced, (SELECT quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.75) AS q3 FROM priced)",
    _PRICED,
)
def iqr_outliers(spark, sf_dir):
    return outliers.flag_iqr(_priced(spark, sf_dir), "price").select("seq", "pos", "is_outlier")


@register(
    "iqr_bounds",
    "SELECT round(q1, 4) AS q1, round(q3, 4) AS q3, round(q1 - 1.5 * (q3 - q1), 4) AS lower_bound,"
    " round(q3 + 1.5 * (q3 - q1), 4) AS upper_bound"
    " FROM (SELECT quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.75) AS q3 FROM priced)",
    _PRICED,
)
def iqr_bounds(spark, sf_dir):
    return outliers.iqr_bounds(_priced(spark, sf_dir), "price")


@register(
    "zscore_outliers",
    "SELECT seq, pos, coalesce(s > 0 AND abs(price - m) > 3 * s, false) AS is_outlier"
    " FROM priced, (SELECT avg(price) AS m, stddev_pop(price) AS s FROM priced)",
    _PRICED,
)
def zscore_outliers(spark, sf_dir):
    return outliers.flag_zscore(_priced(spark, sf_dir), "price").select("seq", "pos", "is_outlier")


@register(
    "extreme_values",
    "SELECT seq, pos, abs(quantity) > 10000 AS extreme_quantity, unit_price > 1000 AS extreme_price FROM accepted",
)
def extreme_values(spark, sf_dir):
    lines = warehouse(spark, sf_dir).lines()
    return lines.select(
        "seq",
        "pos",
        validation.extreme_quantity(F.col("quantity")).alias("extreme_quantity"),
        validation.extreme_price(F.col("unit_price")).alias("extreme_price"),
    )


# ---- transformation


@register(
    "parse_invoice",
    "SELECT seq, pos, CASE WHEN regexp_matches(invoice, '^C?\\d+$') THEN CAST(regexp_replace(invoice, '^C', '') AS BIGINT) ELSE 0 END AS invoice_no,"
    " starts_with(invoice, 'C') AS is_credit FROM typed",
)
def parse_invoice(spark, sf_dir):
    invoice = cleaning.clean_invoice_no(F.col("InvoiceNo"))
    return sales_view(spark, sf_dir, ["InvoiceNo"]).select(
        "seq",
        "pos",
        classify.invoice_number(invoice).alias("invoice_no"),
        classify.is_credit(invoice).alias("is_credit"),
    )


@register(
    "categorize_stock_code",
    "SELECT seq, pos, stock_code, category, subcategory, is_gift FROM lines",
)
def categorize_stock_code(spark, sf_dir):
    return warehouse(spark, sf_dir).lines().select(
        "seq", "pos", "stock_code", "category", "subcategory", "is_gift"
    )


@register(
    "classify_transaction",
    "SELECT seq, pos, invoice_no, transaction_type FROM lines",
)
def classify_transaction(spark, sf_dir):
    return warehouse(spark, sf_dir).lines().select("seq", "pos", "invoice_no", "transaction_type")


@register(
    "line_measures",
    "SELECT seq, pos, quantity, CAST(unit_price AS DOUBLE) AS unit_price, CAST(line_total AS DOUBLE) AS line_total FROM lines",
)
def line_measures(spark, sf_dir):
    return warehouse(spark, sf_dir).lines().select("seq", "pos", "quantity", "unit_price", "line_total")


@register(
    "transaction_dates",
    "SELECT seq, pos, CAST(transaction_datetime AS VARCHAR) AS transaction_datetime,"
    " CAST(transaction_date AS VARCHAR) AS transaction_date FROM lines",
)
def transaction_dates(spark, sf_dir):
    return warehouse(spark, sf_dir).lines().select(
        "seq", "pos", "transaction_datetime", "transaction_date"
    )


@register(
    "conformed_lines",
    f"""
    SELECT seq, pos, invoice, invoice_no, transaction_type, quantity, CAST(unit_price AS DOUBLE) AS unit_price,
      CAST(line_total AS DOUBLE) AS line_total, CAST(transaction_datetime AS VARCHAR) AS transaction_datetime,
      CAST(transaction_date AS VARCHAR) AS transaction_date, customer_id, stock_code, description, country,
      '{LOADED_AT}' AS created_at, '{BATCH}' AS batch_id, 'CSV' AS data_source, category, subcategory, is_gift
    FROM lines""",
)
def conformed_lines(spark, sf_dir):
    """Raw text to conformed lines in one plan, without the stored warehouse."""
    stamped = files.stamp(sales_view(spark, sf_dir), BATCH, LOADED_AT)
    scan = sales_view(spark, sf_dir, ["InvoiceNo"])
    return transform.conform(verdict.accepted(verdict.judge(stamped, CHECKS, invoice_scan=scan))).drop("row_id")


@register(
    "signed_amounts",
    "SELECT seq, pos, transaction_type, CAST(effect_sign AS BIGINT) AS effect_sign, CAST(line_total * effect_sign AS DOUBLE) AS signed_amount"
    " FROM lines JOIN effects USING (transaction_type)",
)
def signed_amounts(spark, sf_dir):
    return transform.signed(warehouse(spark, sf_dir).lines()).select(
        "seq", "pos", "transaction_type", "effect_sign", "signed_amount"
    )


@register(
    "transform_metrics",
    "SELECT count(*) AS total_records, count(line_total) AS successful, count(*) - count(line_total) AS failed FROM lines",
)
def transform_metrics(spark, sf_dir):
    return transform.metrics(warehouse(spark, sf_dir).lines())


# ---- dimensions and fact


@register(
    "date_dimension",
    """
    SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, CAST(d AS VARCHAR) AS date_value, year(d) AS year,
      quarter(d) AS quarter, month(d) AS month, weekofyear(d) AS week, dayofyear(d) AS day_of_year,
      day(d) AS day_of_month, isodow(d) AS day_of_week, strftime(d, '%B') AS month_name,
      strftime(d, '%A') AS day_name, 'Q' || quarter(d) AS quarter_name, isodow(d) >= 6 AS is_weekend, false AS is_holiday
    FROM (SELECT DISTINCT transaction_date AS d FROM lines)""",
)
def date_dimension(spark, sf_dir):
    return dimensions.date_dimension(warehouse(spark, sf_dir).lines())


@register(
    "product_consolidation",
    "SELECT stock_code, description, category, subcategory, is_gift FROM products",
)
def product_consolidation(spark, sf_dir):
    return dimensions.product_attributes(warehouse(spark, sf_dir).lines())


@register("customer_dimension", "SELECT customer_id, country FROM customers")
def customer_dimension(spark, sf_dir):
    return dimensions.customer_attributes(warehouse(spark, sf_dir).lines())


# Two loads of the same lines, split by day, show what a second load changes.
_SPLIT = "2013-07-01"
_SPLIT_VIEWS = {
    "early": f"SELECT * FROM lines WHERE transaction_date < DATE '{_SPLIT}'",
    "late": f"SELECT * FROM lines WHERE transaction_date >= DATE '{_SPLIT}'",
    "early_customers": "SELECT customer_id, first(country ORDER BY seq, pos) AS country,"
    " row_number() OVER (ORDER BY substr(md5(customer_id), 1, 3), customer_id) AS customer_key FROM early GROUP BY customer_id",
    "late_customers": "SELECT customer_id, first(country ORDER BY seq, pos) AS country FROM late GROUP BY customer_id",
    "early_products": "SELECT stock_code, first(description ORDER BY length(description) DESC, seq, pos) AS description,"
    " last(category ORDER BY seq, pos) AS category, bool_or(is_gift) AS is_gift,"
    " row_number() OVER (ORDER BY substr(md5(stock_code), 1, 3), stock_code) AS product_key FROM early GROUP BY stock_code",
    "late_products": "SELECT stock_code, first(description ORDER BY length(description) DESC, seq, pos) AS description,"
    " last(category ORDER BY seq, pos) AS category, bool_or(is_gift) AS is_gift FROM late GROUP BY stock_code",
}


def _split(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    lines = warehouse(spark, sf_dir).lines()
    day = F.lit(_SPLIT).cast("date")
    return (
        lines.filter(F.col("transaction_date") < day),
        lines.filter(F.col("transaction_date") >= day),
    )


def _early_customers(early: DataFrame) -> DataFrame:
    attributes = dimensions.customer_attributes(early)
    return dimensions.new_customers(attributes, F.lit(0), LOADED_AT, "CSV")


def _early_products(early: DataFrame) -> DataFrame:
    attributes = dimensions.product_attributes(early)
    return dimensions.new_products(attributes, F.lit(0), LOADED_AT, "CSV")


@register(
    "get_or_create_keys",
    """
    SELECT customer_id, customer_key, false AS is_new FROM early_customers
    UNION ALL
    SELECT customer_id, (SELECT max(customer_key) FROM early_customers)
        + row_number() OVER (ORDER BY substr(md5(customer_id), 1, 3), customer_id), true
    FROM late_customers WHERE customer_id NOT IN (SELECT customer_id FROM early_customers)""",
    _SPLIT_VIEWS,
)
def get_or_create_keys(spark, sf_dir):
    early, late = _split(spark, sf_dir)
    known = _kept(dimensions.customer_attributes(early))
    known = _kept(dimensions.new_customers(known, F.lit(0), LOADED_AT, "CSV"))
    return keys.get_or_create(known, dimensions.customer_attributes(late), "customer_id", "customer_key")


@register(
    "product_scd1_upsert",
    """
    SELECT e.product_key, e.stock_code, coalesce(l.description, e.description) AS description,
      coalesce(l.category, e.category) AS category, coalesce(l.is_gift, e.is_gift) AS is_gift
    FROM early_products e LEFT JOIN late_products l ON e.stock_code = l.stock_code
    UNION ALL
    SELECT (SELECT max(product_key) FROM early_products) + row_number() OVER (ORDER BY substr(md5(stock_code), 1, 3), stock_code),
      stock_code, description, category, is_gift
    FROM late_products WHERE stock_code NOT IN (SELECT stock_code FROM early_products)""",
    _SPLIT_VIEWS,
)
def product_scd1_upsert(spark, sf_dir):
    early, late = _split(spark, sf_dir)
    known = _kept(dimensions.product_attributes(early))
    known = _kept(dimensions.new_products(known, F.lit(0), LOADED_AT, "CSV"))
    merged = dimensions.upsert_products(known, _kept(dimensions.product_attributes(late)), LOADED_AT)
    return merged.select("product_key", "stock_code", "description", "category", "is_gift")


@register(
    "customer_insert_if_absent",
    """
    SELECT customer_key, customer_id, country, true AS is_current FROM early_customers
    UNION ALL
    SELECT (SELECT max(customer_key) FROM early_customers) + row_number() OVER (ORDER BY substr(md5(customer_id), 1, 3), customer_id),
      customer_id, country, true
    FROM late_customers WHERE customer_id NOT IN (SELECT customer_id FROM early_customers)""",
    _SPLIT_VIEWS,
)
def customer_insert_if_absent(spark, sf_dir):
    early, late = _split(spark, sf_dir)
    merged = dimensions.insert_absent_customers(
        _early_customers(early), dimensions.customer_attributes(late), LOADED_AT
    )
    return merged.select("customer_key", "customer_id", "country", "is_current")


_HISTORY = {
    "moments": "SELECT customer_id, transaction_datetime AS moment, min(country) AS country FROM lines GROUP BY 1, 2",
    "turns": "SELECT *, lag(country) OVER (PARTITION BY customer_id ORDER BY moment) AS previous FROM moments",
    "versions": "SELECT customer_id, country, moment AS effective_date,"
    " lead(moment) OVER (PARTITION BY customer_id ORDER BY moment) AS expiry_date FROM turns WHERE previous IS DISTINCT FROM country",
}


@register(
    "customer_scd2_history",
    "SELECT customer_id, country, CAST(effective_date AS VARCHAR) AS effective_date,"
    " CAST(expiry_date AS VARCHAR) AS expiry_date, expiry_date IS NULL AS is_current FROM versions",
    _HISTORY,
)
def customer_scd2_history(spark, sf_dir):
    return dimensions.customer_history(warehouse(spark, sf_dir).lines())


@register(
    "scd2_as_of",
    "SELECT l.seq, l.pos, l.customer_id, v.country AS version_country, CAST(v.effective_date AS VARCHAR) AS version_effective_date"
    " FROM lines l JOIN versions v ON l.customer_id = v.customer_id AND v.effective_date <= l.transaction_datetime"
    " AND (v.expiry_date IS NULL OR l.transaction_datetime < v.expiry_date)",
    _HISTORY,
)
def scd2_as_of(spark, sf_dir):
    lines = warehouse(spark, sf_dir).lines()
    matched = dimensions.as_of(lines, dimensions.customer_history(lines))
    return matched.select(
        "seq", "pos", "customer_id", "version_country", "version_effective_date"
    )


@register(
    "fact_key_resolution",
    "SELECT seq, pos, date_key, customer_key, product_key FROM fact",
)
def fact_key_resolution(spark, sf_dir):
    house = warehouse(spark, sf_dir)
    resolved = fact.resolve_keys(
        house.lines(), house.dim_date(), house.dim_customer(), house.dim_product()
    )
    return resolved.select("seq", "pos", "date_key", "customer_key", "product_key")


@register(
    "unresolved_lines",
    "SELECT seq, pos, l.customer_id, l.stock_code FROM late l"
    " WHERE l.stock_code NOT IN (SELECT stock_code FROM early_products)"
    " OR l.customer_id NOT IN (SELECT customer_id FROM early_customers)",
    _SPLIT_VIEWS,
)
def unresolved_lines(spark, sf_dir):
    """Later lines against the earlier dimensions: what a strict load turns away."""
    early, late = _split(spark, sf_dir)
    dates = warehouse(spark, sf_dir).dim_date()
    resolved = fact.resolve_keys(late, dates, _early_customers(early), _early_products(early))
    return resolved.filter(~fact.is_resolved(strict=True)).select(
        "seq", "pos", "customer_id", "stock_code"
    )


@register(
    "midnight_promotion",
    "SELECT seq, pos, CAST(CASE WHEN minute(transaction_datetime) % 2 = 0 THEN CAST(transaction_date AS TIMESTAMP)"
    " ELSE transaction_datetime END AS VARCHAR) AS transaction_datetime FROM lines",
)
def midnight_promotion(spark, sf_dir):
    """Lines with the clock time taken away are dated to the start of the day."""
    lines = warehouse(spark, sf_dir).lines()
    odd = F.minute("transaction_datetime") % 2 != 0
    cut = lines.withColumn("transaction_datetime", F.when(odd, F.col("transaction_datetime")))
    return fact.promote_midnight(cut).select("seq", "pos", "transaction_datetime")


@register(
    "fact_build",
    f"""
    SELECT date_key, customer_key, product_key, invoice_no, transaction_type, quantity, CAST(unit_price AS DOUBLE) AS unit_price,
      CAST(line_total AS DOUBLE) AS line_total, CAST(transaction_datetime AS VARCHAR) AS transaction_datetime,
      '{LOADED_AT}' AS created_at, '{BATCH}' AS batch_id, 'CSV' AS data_source, 1::BIGINT AS version_id, txn_year FROM fact""",
)
def fact_build(spark, sf_dir):
    return warehouse(spark, sf_dir).fact_sales().select(
        "date_key", "customer_key", "product_key", "invoice_no", "transaction_type", "quantity", "unit_price",
        "line_total", "transaction_datetime", "created_at", "batch_id", "data_source", "version_id", "txn_year",
    )


@register(
    "compacted_fact",
    f"""
    SELECT date_key, customer_id, stock_code, invoice_no, transaction_type, quantity, CAST(unit_price AS DOUBLE) AS unit_price,
      CAST(line_total AS DOUBLE) AS line_total, CAST(transaction_datetime AS VARCHAR) AS transaction_datetime,
      'part-' || {_PART} AS batch_id, CAST({_PART} AS BIGINT) AS version_id, txn_year FROM fact""",
)
def compacted_fact(spark, sf_dir):
    """The sales of three loads after their folders were merged, with the members their keys stand for."""
    house = warehouse_of_three(spark, sf_dir)
    facts = house.fact_sales().join(house.dim_customer().select("customer_key", "customer_id"), "customer_key")
    return facts.join(house.dim_product().select("product_key", "stock_code"), "product_key").select(
        "date_key", "customer_id", "stock_code", "invoice_no", "transaction_type", "quantity", "unit_price",
        "line_total", "transaction_datetime", "batch_id", "version_id", "txn_year",
    )


@register(
    "load_range",
    "SELECT CAST(min(transaction_datetime) AS VARCHAR) AS first_transaction,"
    " CAST(max(transaction_datetime) AS VARCHAR) AS last_transaction, count(DISTINCT txn_year) AS years FROM fact",
)
def load_range(spark, sf_dir):
    return fact.load_range(warehouse(spark, sf_dir).fact_sales())


# ---- business queries

_SUMMARY_30 = f"""
    SELECT count(*) AS total_transactions, CAST(coalesce(sum(line_total), 0) AS DOUBLE) AS total_revenue,
      round(CAST(sum(line_total) AS DOUBLE) / count(*), 4) AS avg_transaction_value,
      count(DISTINCT customer_key) AS unique_customers, count(DISTINCT product_key) AS unique_products, 30::BIGINT AS period_days
    FROM fact WHERE transaction_datetime >= TIMESTAMP '{SALES_AS_OF}' - INTERVAL 30 DAY"""
_TOP = f"""
    SELECT p.description AS product_name, f.stock_code, CAST(sum(quantity) AS BIGINT) AS total_quantity_sold,
      CAST(sum(line_total) AS DOUBLE) AS total_revenue, count(*) AS transaction_count
    FROM fact f JOIN products p ON f.product_key = p.product_key
    WHERE f.transaction_datetime >= TIMESTAMP '{SALES_AS_OF}' - INTERVAL 365 DAY
    GROUP BY p.product_key, p.description, f.stock_code ORDER BY sum(line_total) DESC, f.stock_code LIMIT 10"""
_STATS = f"""
    SELECT count(DISTINCT f.customer_key) AS total_customers,
      count(DISTINCT CASE WHEN transaction_datetime >= TIMESTAMP '{SALES_AS_OF}' - INTERVAL 365 DAY THEN f.customer_key END) AS active_customers_365d,
      count(DISTINCT c.country) AS countries_served
    FROM fact f JOIN customers c ON f.customer_key = c.customer_key"""


@register("sales_summary", _SUMMARY_30)
def sales_summary(spark, sf_dir):
    return analytics.sales_summary(warehouse(spark, sf_dir).fact_sales(), SALES_AS_OF)


@register("sales_summary_by_days", _SUMMARY_30)
def sales_summary_by_days(spark, sf_dir):
    """The same from the totals and key sets that loads store by day; no fact row is read."""
    house = warehouse(spark, sf_dir)
    return day_counts.sales_summary(house.day_totals(), house.day_keys(), SALES_AS_OF)


@register("top_products", _TOP)
def top_products(spark, sf_dir):
    house = warehouse(spark, sf_dir)
    return analytics.top_products(house.fact_sales(), house.dim_product(), SALES_AS_OF)


@register("customer_stats", _STATS)
def customer_stats(spark, sf_dir):
    house = warehouse(spark, sf_dir)
    return analytics.customer_stats(house.fact_sales(), house.dim_customer(), SALES_AS_OF)


@register("count_sales", "SELECT count(*) AS total_sales FROM fact")
def count_sales(spark, sf_dir):
    return analytics.count_sales(warehouse(spark, sf_dir).fact_sales())


@register(
    "recent_sales",
    f"""
    SELECT '{LOADED_AT}' AS created_at, CAST(transaction_datetime AS VARCHAR) AS transaction_datetime,
      CAST(line_total AS DOUBLE) AS line_total, invoice_no, product_key, quantity
    FROM fact f ORDER BY f.transaction_datetime DESC, f.line_total DESC, invoice_no, product_key, transaction_type LIMIT 100""",
)
def recent_sales(spark, sf_dir):
    return analytics.recent_sales(warehouse(spark, sf_dir).fact_sales()).select(
        "created_at", "transaction_datetime", "line_total", "invoice_no", "product_key", "quantity"
    )


@register("customer_count", "SELECT count(DISTINCT customer_key) AS customers FROM fact")
def customer_count(spark, sf_dir):
    return analytics.distinct_count(
        warehouse(spark, sf_dir).fact_sales(), "customer_key", "customers"
    )


@register("product_count", "SELECT count(DISTINCT product_key) AS products FROM fact")
def product_count(spark, sf_dir):
    return analytics.distinct_count(
        warehouse(spark, sf_dir).fact_sales(), "product_key", "products"
    )


@register(
    "net_revenue_by_type",
    "SELECT transaction_type, count(*) AS lines, CAST(sum(line_total * effect_sign) AS DOUBLE) AS net_revenue"
    " FROM fact JOIN effects USING (transaction_type) GROUP BY 1",
)
def net_revenue_by_type(spark, sf_dir):
    return transform.net_revenue_by_type(warehouse(spark, sf_dir).fact_sales())


def _stored(spark, sf_dir, name: str) -> DataFrame:
    """A summary table written twice for a day and read back; the second time replaces the first."""
    folder = new_folder(spark, "summaries")
    for _ in range(2):
        warehouse(spark, sf_dir).summarise(SALES_AS_OF, folder)
    return spark.read.parquet(f"{folder}/{name}")


@register("stored_top_products", f"SELECT *, '{SALES_AS_OF}' AS as_of FROM ({_TOP})")
def stored_top_products(spark, sf_dir):
    return _stored(spark, sf_dir, "top_products")


@register("stored_sales_summary", f"SELECT *, '{SALES_AS_OF}' AS as_of FROM ({_SUMMARY_30})")
def stored_sales_summary(spark, sf_dir):
    return _stored(spark, sf_dir, "sales_summary")


@register("stored_customer_stats", f"SELECT *, '{SALES_AS_OF}' AS as_of FROM ({_STATS})")
def stored_customer_stats(spark, sf_dir):
    return _stored(spark, sf_dir, "customer_stats")


# ---- quality


@register(
    "quality_suite",
    "SELECT table_name, column_name, metric_name, metric_type, hits, rows_checked, round(CAST(score AS DOUBLE), 4) AS metric_value,"
    " CAST(threshold_value AS DOUBLE) AS threshold_value, score >= threshold_value AS is_threshold_met FROM scored",
    _SUITE_VIEWS,
)
def quality_suite(spark, sf_dir):
    return _results(spark, sf_dir)


_RAW_SUITE = [
    quality.completeness("customer_text_completeness", "CustomerID"),
    quality.uniqueness("invoice_uniqueness", "InvoiceNo"),
    quality.validity("country_validity", "Country"),
    quality.validity("date_text_validity", "InvoiceDate", quality.is_date_time),
    quality.validity("description_validity", "Description", quality.is_description),
    quality.numeric_range("quantity_range", "Quantity", 1, 1000),
]


@register(
    "quality_measures_on_raw",
    """
    SELECT metric_name, metric_type, hits, rows_checked, round(CASE WHEN rows_checked = 0 THEN 0 ELSE hits * 100.0::DOUBLE / rows_checked END, 4) AS metric_value FROM (
      SELECT 'customer_text_completeness' AS metric_name, 'completeness' AS metric_type, count(*) FILTER (WHERE trim(CustomerID) <> '') AS hits, count(*) AS rows_checked FROM raw_sales
      UNION ALL SELECT 'invoice_uniqueness', 'uniqueness', count(DISTINCT InvoiceNo), count(InvoiceNo) FROM raw_sales
      UNION ALL SELECT 'country_validity', 'validity', count(*) FILTER (WHERE trim(Country) <> ''), count(*) FROM raw_sales
      UNION ALL SELECT 'date_text_validity', 'validity', count(*) FILTER (WHERE try_strptime(InvoiceDate, '%Y-%m-%d %H:%M:%S') IS NOT NULL), count(*) FROM raw_sales
      UNION ALL SELECT 'description_validity', 'validity', count(*) FILTER (WHERE length(trim(Description)) >= 3), count(*) FROM raw_sales
      UNION ALL SELECT 'quantity_range', 'validity', count(*) FILTER (WHERE TRY_CAST(QuantityText AS DOUBLE) BETWEEN 1 AND 1000), count(TRY_CAST(QuantityText AS DOUBLE)) FROM raw_sales)""",
)
def quality_measures_on_raw(spark, sf_dir):
    """Each kind of measure once, where it does not come out at a hundred."""
    raw = sales_view(spark, sf_dir)
    return quality.measure(raw, "raw_sales", _RAW_SUITE).select(
        "metric_name", "metric_type", "hits", "rows_checked", "metric_value"
    )


@register(
    "composite_uniqueness",
    "SELECT 'line_uniqueness' AS metric_name, count(DISTINCT (invoice, stock_code)) AS hits, count(*) AS rows_checked FROM coded",
    _CODED,
)
def composite_uniqueness(spark, sf_dir):
    suite = [quality.composite_uniqueness("line_uniqueness", ["invoice", "stock_code"])]
    return quality.measure(_coded(spark, sf_dir), "raw_sales", suite).select(
        "metric_name", "hits", "rows_checked"
    )


_TOTALS = """
    SELECT count(*) AS total_checks, count(*) FILTER (WHERE score >= threshold_value) AS passed_checks,
      count(*) FILTER (WHERE score < threshold_value) AS failed_checks,
      round(count(*) FILTER (WHERE score >= threshold_value) * 100.0::DOUBLE / count(*), 4) AS success_rate,
      round(avg(CAST(score AS DOUBLE)), 4) AS overall_score"""


@register("quality_summary", _TOTALS + " FROM scored", _SUITE_VIEWS)
def quality_summary(spark, sf_dir):
    return quality.summary(_results(spark, sf_dir))


@register(
    "quality_summary_by_type",
    "SELECT metric_type, round(avg(CAST(score AS DOUBLE)), 4) AS average_score, round(min(CAST(score AS DOUBLE)), 4) AS min_score,"
    " round(max(CAST(score AS DOUBLE)), 4) AS max_score, count(*) AS check_count FROM scored GROUP BY 1",
    _SUITE_VIEWS,
)
def quality_summary_by_type(spark, sf_dir):
    return quality.summary_by_type(_results(spark, sf_dir))


@register(
    "quality_report",
    "SELECT table_name, metric_name, CASE WHEN score >= threshold_value THEN 'PASS' ELSE 'FAIL' END AS status,"
    " round(CAST(score AS DOUBLE), 2) AS metric_value, CAST(threshold_value AS DOUBLE) AS threshold_value, hits, rows_checked FROM scored",
    _SUITE_VIEWS,
)
def quality_report(spark, sf_dir):
    return quality.report(_results(spark, sf_dir))


@register(
    "load_quality_gate",
    _TOTALS + ", 95.0::DOUBLE AS quality_threshold, avg(score) >= 95 AS is_gate_passed,"
    " CASE WHEN avg(score) < 95 THEN 'Quality score below threshold' END AS warning FROM fact_scored",
    _SUITE_VIEWS,
)
def load_quality_gate(spark, sf_dir):
    results = quality.check(warehouse(spark, sf_dir).fact_sales(), "fact_sales")
    return quality.load_gate(quality.summary(results))


@register(
    "quality_trend",
    "SELECT CAST(day AS VARCHAR) AS day, round(avg_score, 4) AS avg_score, checks_count, poor_quality_count FROM days",
    _TREND,
)
def quality_trend(spark, sf_dir):
    return trends.daily(quality_history(spark, sf_dir), EVENTS_AS_OF)


@register(
    "quality_trend_by_table",
    "SELECT CAST(CAST(measured_at AS DATE) AS VARCHAR) AS day, table_name, metric_name, round(avg(CAST(metric_value AS DOUBLE)), 4) AS avg_score,"
    f" count(*) AS checks_count, count(*) FILTER (WHERE metric_value < 90) AS poor_quality_count FROM history WHERE measured_at >= {_HISTORY_AT} - INTERVAL 30 DAY GROUP BY 1, 2, 3",
    _TREND,
)
def quality_trend_by_table(spark, sf_dir):
    return trends.daily(
        quality_history(spark, sf_dir), EVENTS_AS_OF, by=("table_name", "metric_name")
    )


@register(
    "quality_trend_summary",
    "SELECT round(avg(avg_score), 4) AS avg_quality_score, round(min(avg_score), 4) AS min_quality_score, round(max(avg_score), 4) AS max_quality_score,"
    " CASE WHEN last(avg_score ORDER BY day) > first(avg_score ORDER BY day) THEN 'IMPROVING'"
    " WHEN last(avg_score ORDER BY day) < first(avg_score ORDER BY day) THEN 'DECLINING' ELSE 'STABLE' END AS quality_trend,"
    " CAST(sum(checks_count) AS BIGINT) AS total_checks, count(*) FILTER (WHERE poor_quality_count > 0) AS poor_quality_days FROM days",
    _TREND,
)
def quality_trend_summary(spark, sf_dir):
    return trends.trend_summary(trends.daily(quality_history(spark, sf_dir), EVENTS_AS_OF))


@register("quality_anomalies", "SELECT * FROM drops", _TREND)
def quality_anomalies(spark, sf_dir):
    return trends.anomalies(quality_history(spark, sf_dir), EVENTS_AS_OF)


@register(
    "anomaly_alert",
    "SELECT 'ERROR' AS severity, 'Quality anomalies detected' AS message, count(*) AS anomaly_count, round(max(score_drop), 4) AS worst_drop,"
    " string_agg(DISTINCT table_name, ',' ORDER BY table_name) AS affected_tables FROM drops HAVING count(*) > 0",
    _TREND,
)
def anomaly_alert(spark, sf_dir):
    return trends.anomaly_alert(trends.anomalies(quality_history(spark, sf_dir), EVENTS_AS_OF))


@register(
    "score_alerts",
    "SELECT CASE WHEN avg_score < 70 THEN 'CRITICAL' ELSE 'WARNING' END AS severity,"
    " CASE WHEN avg_score < 70 THEN 'Critical quality issue in fact_sales' ELSE 'Quality degradation in fact_sales' END AS message,"
    " round(avg_score, 4) AS overall_score, poor_quality_count AS failed_checks, 'fact_sales' AS table_name FROM days WHERE avg_score < 90",
    _TREND,
)
def score_alerts(spark, sf_dir):
    """Alerts for the days of the event history, each day taken as one summary."""
    days = trends.daily(quality_history(spark, sf_dir), EVENTS_AS_OF)
    summaries = days.select(
        F.col("avg_score").alias("overall_score"), F.col("poor_quality_count").alias("failed_checks")
    )
    return quality.score_alerts(summaries)


@register(
    "check_constraints",
    "SELECT 'quantity_positive' AS constraint_name, count(*) FILTER (WHERE quantity <= 0) AS violations FROM fact"
    " UNION ALL SELECT 'unit_price_non_negative', count(*) FILTER (WHERE unit_price < 0) FROM fact"
    " UNION ALL SELECT 'line_total_is_product', count(*) FILTER (WHERE line_total <> quantity * unit_price) FROM fact"
    " UNION ALL SELECT 'effect_sign_known', count(*) FILTER (WHERE effect_sign NOT IN (-1, 0, 1)) FROM effects",
)
def check_constraints(spark, sf_dir):
    found = quality.constraint_violations(warehouse(spark, sf_dir).fact_sales())
    signs = quality.invalid_effect_signs(transform.transaction_types(spark)).agg(
        F.lit("effect_sign_known").alias("constraint_name"), F.count(F.lit(1)).alias("violations")
    )
    return found.unionByName(signs)


@register(
    "raw_constraint_violations",
    "SELECT 'quantity_positive' AS constraint_name, count(*) FILTER (WHERE quantity <= 0) AS violations FROM typed"
    " UNION ALL SELECT 'unit_price_non_negative', 0 FROM typed GROUP BY 1"
    " UNION ALL SELECT 'line_total_is_product', count(*) FILTER (WHERE abs(abs(quantity) * unit_price - quantity * unit_price) > 0) FROM typed",
)
def raw_constraint_violations(spark, sf_dir):
    """The same rules on lines that were not yet conformed, where they do fail."""
    lines = sales_view(spark, sf_dir, ["Quantity", "UnitPrice"]).select(
        cleaning.clean_quantity(F.col("Quantity")).alias("quantity"),
        cleaning.clean_unit_price(F.col("UnitPrice")).alias("unit_price"),
    )
    total = transform.line_total(F.col("quantity"), F.col("unit_price"))
    return quality.constraint_violations(lines.withColumn("line_total", total))


@register(
    "referential_integrity",
    """
    SELECT child_column, parent_column, count(DISTINCT key) AS orphan_keys, count(key) AS orphan_rows FROM (
      SELECT 'stock_code' AS child_column, 'stock_code' AS parent_column,
        CASE WHEN stock_code NOT IN (SELECT stock_code FROM early_products) THEN stock_code END AS key FROM late
      UNION ALL SELECT 'customer_id', 'customer_id',
        CASE WHEN customer_id NOT IN (SELECT customer_id FROM early_customers) THEN customer_id END FROM late)
    GROUP BY 1, 2""",
    _SPLIT_VIEWS,
)
def referential_integrity(spark, sf_dir):
    """Later lines checked against the members of the earlier load."""
    early, late = _split(spark, sf_dir)
    products, customers = _kept(_early_products(early)), _kept(_early_customers(early))
    return quality.orphans(late, "stock_code", products, "stock_code").unionByName(
        quality.orphans(late, "customer_id", customers, "customer_id")
    )


@register(
    "fact_foreign_keys",
    "SELECT child_column, 0::BIGINT AS orphan_rows FROM (SELECT DISTINCT unnest(['date_key', 'customer_key', 'product_key', 'version_id']) AS child_column FROM fact)",
)
def fact_foreign_keys(spark, sf_dir):
    house = warehouse(spark, sf_dir)
    tables = house.tables()
    whole = None
    for _, column, parent, parent_column in catalog.RELATIONSHIPS:
        part = quality.orphans(tables["fact_sales"], column, tables[parent], parent_column)
        whole = part if whole is None else whole.unionByName(part)
    return whole.select("child_column", "orphan_rows")


# ---- lineage, versions, catalog

_RUNS = {
    "runs": """
        SELECT 'orders-' || strftime(o_orderdate, '%Y-%m') AS batch_id, count(*) AS records_processed,
          count(*) FILTER (WHERE o_orderstatus <> 'P') AS records_inserted, min(o_orderdate) AS start_time,
          max(o_orderdate) AS end_time FROM orders GROUP BY 1""",
    "numbered": "SELECT *, CAST(replace(substr(batch_id, 8), '-', '') AS BIGINT) AS version_id FROM runs",
}


def _runs(spark, sf_dir) -> DataFrame:
    """A run per month of orders, as a lineage table of a long-lived warehouse."""
    month = F.date_format(F.to_date("o_orderdate"), "yyyy-MM")
    runs = (
        table(spark, sf_dir, "orders")
        .groupBy(F.concat(F.lit("orders-"), month).alias("batch_id"))
        .agg(
            F.count(F.lit(1)).alias("records_processed"),
            F.count_if(F.col("o_orderstatus") != "P").alias("records_inserted"),
            F.min("o_orderdate").alias("start_time"),
            F.max("o_orderdate").alias("end_time"),
        )
    )
    return runs.select(
        "*",
        F.lit("table").alias("source_system"),
        F.lit("orders").alias("source_file"),
        F.lit("fact_sales").alias("target_table"),
        F.lit("monthly").alias("etl_job_name"),
        F.lit(0).cast("bigint").alias("records_updated"),
        (F.datediff("end_time", "start_time") * 86400).alias("duration_seconds"),
        F.lit("SUCCESS").alias("status"),
        F.lit("none").alias("error_message"),
    )


def _versions(spark, sf_dir) -> DataFrame:
    number = F.regexp_replace(F.substring("batch_id", 8, 7), "-", "")
    return _runs(spark, sf_dir).select(
        number.cast("bigint").alias("version_id"),
        lineage.version_number(F.col("start_time")).alias("version_number"),
        F.lit("ACTIVE").alias("status"),
        F.col("records_inserted").alias("records_count"),
        F.col("start_time").alias("created_at"),
    )


@register(
    "lineage_record",
    "SELECT 'CSV' AS source_system, 'fact_sales' AS target_table, "
    f"'{BATCH}' AS batch_id, count(*) FILTER (WHERE is_admitted) AS records_processed,"
    " count(*) FILTER (WHERE reject_reason IS NULL) AS records_inserted,"
    " count(*) FILTER (WHERE is_admitted AND reject_reason IS NOT NULL) AS records_rejected, 'SUCCESS' AS status FROM judged",
)
def lineage_record(spark, sf_dir):
    """The run the load itself recorded; times of day are its own."""
    return warehouse(spark, sf_dir).data_lineage().select(
        "source_system", "target_table", "batch_id", "records_processed", "records_inserted", "records_rejected", "status"
    )


@register(
    "recent_lineage",
    "SELECT batch_id, 'orders' AS source_file, 'fact_sales' AS target_table, 'monthly' AS etl_job_name, records_processed, records_inserted,"
    " CAST(r.start_time AS VARCHAR) AS start_time, CAST(r.end_time AS VARCHAR) AS end_time, 'SUCCESS' AS status"
    " FROM runs r ORDER BY r.start_time DESC, batch_id LIMIT 10",
    _RUNS,
)
def recent_lineage(spark, sf_dir):
    return lineage.recent_runs(_runs(spark, sf_dir))


@register(
    "batch_lineage",
    "SELECT 'table' AS source_system, 'orders' AS source_file, 'fact_sales' AS target_table, records_processed, records_inserted, 0::BIGINT AS records_updated,"
    " CAST(r.start_time AS VARCHAR) AS start_time, CAST(r.end_time AS VARCHAR) AS end_time, date_diff('day', r.start_time, r.end_time) * 86400 AS duration_seconds,"
    " 'SUCCESS' AS status, 'none' AS error_message FROM runs r WHERE batch_id = 'orders-1998-10'",
    _RUNS,
)
def batch_lineage(spark, sf_dir):
    return lineage.runs_of_batch(_runs(spark, sf_dir), "orders-1998-10")


@register(
    "load_metrics",
    "SELECT batch_id, records_processed, records_inserted, round(records_inserted * 100.0::DOUBLE / records_processed, 4) AS success_rate,"
    " round(CASE WHEN start_time < end_time THEN records_processed / (date_diff('day', start_time, end_time) * 86400.0::DOUBLE) ELSE 0 END, 4) AS records_per_second FROM runs",
    _RUNS,
)
def load_metrics(spark, sf_dir):
    rates = lineage.load_metrics(
        F.col("records_processed"), F.col("records_inserted"), F.col("duration_seconds")
    )
    runs = _runs(spark, sf_dir).withColumns(rates)
    return runs.select(
        "batch_id", "records_processed", "records_inserted", "success_rate", "records_per_second"
    )


_PARTS = {
    "parts": f"SELECT part, count(*) FILTER (WHERE is_admitted) AS processed, count(*) FILTER (WHERE reject_reason IS NULL) AS inserted,"
    f" count(*) FILTER (WHERE is_admitted AND reject_reason IS NOT NULL) AS rejected FROM (SELECT *, {_PART} AS part FROM judged) GROUP BY 1",
}


@register(
    "recent_lineage_of_loads",
    "SELECT 4 - part::BIGINT AS place, 'part-' || part AS batch_id, 'part-' || part || '.csv' AS source_file, 'fact_sales' AS target_table,"
    " 'sales_import' AS etl_job_name, processed AS records_processed, inserted AS records_inserted, 'SUCCESS' AS status FROM parts",
    _PARTS,
)
def recent_lineage_of_loads(spark, sf_dir):
    """The latest runs of a log that three loads have written; when they ran is their own."""
    runs = lineage.recent_runs(warehouse_of_three(spark, sf_dir).data_lineage())
    place = F.row_number().over(Window.orderBy(F.desc("start_time")))
    return runs.withColumn("place", place).drop("start_time", "end_time")


@register(
    "batch_lineage_of_loads",
    "SELECT 'CSV' AS source_system, 'part-2.csv' AS source_file, 'fact_sales' AS target_table, processed AS records_processed,"
    " inserted AS records_inserted, 0::BIGINT AS records_updated, 'SUCCESS' AS status, true AS is_timed FROM parts WHERE part = 2",
    _PARTS,
)
def batch_lineage_of_loads(spark, sf_dir):
    """The runs of one batch, from the same log."""
    runs = lineage.runs_of_batch(warehouse_of_three(spark, sf_dir).data_lineage(), "part-2")
    lasted = F.unix_timestamp(F.col("end_time").cast("timestamp")) - F.unix_timestamp(F.col("start_time").cast("timestamp"))
    timed = runs.withColumn("is_timed", F.abs(lasted - F.col("duration_seconds")) <= 1)
    return timed.drop("start_time", "end_time", "duration_seconds", "error_message")


@register(
    "load_metrics_of_loads",
    "SELECT 'part-' || part AS batch_id, processed AS records_processed, inserted AS records_inserted, rejected AS records_rejected,"
    " round(inserted * 100.0::DOUBLE / processed, 4) AS success_rate FROM parts",
    _PARTS,
)
def load_metrics_of_loads(spark, sf_dir):
    """Share of the lines of each load that arrived, from the same log."""
    rates = lineage.load_metrics(F.col("records_processed"), F.col("records_inserted"))
    runs = warehouse_of_three(spark, sf_dir).data_lineage().withColumns(rates)
    return runs.select("batch_id", "records_processed", "records_inserted", "records_rejected", "success_rate")


@register(
    "versions_of_loads",
    f"SELECT 'v{LOADED_AT[:10].replace('-', '')}_0' || part || '0000' AS version_number, inserted AS records_count, 'ACTIVE' AS status,"
    f" '{LOADED_AT[:10]} 0' || part || ':00:00' AS created_at, inserted AS sales_rows FROM parts",
    _PARTS,
)
def versions_of_loads(spark, sf_dir):
    """The versions the same loads have made, with the sales rows that carry each."""
    house = warehouse_of_three(spark, sf_dir)
    ids = house.data_versions().select("version_number", "version_id")
    held = lineage.rows_per_version(house.fact_sales()).withColumnRenamed("records_count", "sales_rows")
    return lineage.versions_list(house.data_versions()).join(ids, "version_number").join(held, "version_id").drop("version_id")


# A field stands behind its length, fields are joined by "|"; twelve hex digits per row, sixteen in all.
_PRINTS = f"""
    SELECT version_id, substr(md5(count(*) || ':' || CAST(sum(h) AS VARCHAR)), 1, 16) AS file_hash,
      'INCREMENTAL' AS version_type, (SELECT count(*) FROM fact) AS records_count FROM (
      SELECT 1::BIGINT AS version_id, CAST('0x' || substr(md5(concat_ws('|', {", ".join(
        f"length({c}) || ':' || {c}" for c in ("InvoiceNo", "StockCode", "Description", "QuantityText", "InvoiceDate", "UnitPrice", "CustomerID", "Country")
      )})), 1, 12) AS BIGINT) AS h FROM raw_sales) GROUP BY 1"""


@register("version_create", _PRINTS)
def version_create(spark, sf_dir):
    """The load's version: it names all source lines, whatever order they come in."""
    return warehouse(spark, sf_dir).data_versions().select(
        "version_id", "file_hash", "version_type", "records_count"
    )


@register(
    "version_tag",
    "SELECT o_orderkey AS sales_key, CAST(CASE WHEN o_orderkey % 3 = 0 THEN 1 WHEN o_orderstatus <> 'P' THEN 2 ELSE -1 END AS BIGINT) AS version_id FROM orders",
)
def version_tag(spark, sf_dir):
    """Every third order has a version already; the open ones stay untagged."""
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("sales_key"),
        F.when(F.col("o_orderkey") % 3 == 0, 1).alias("version_id"),
        F.lit(None).cast("timestamp_ntz").alias("version_created_at"),
        "o_orderstatus",
    )
    at = F.lit(LOADED_AT).cast("timestamp_ntz")
    tagged = lineage.tag(rows, 2, at, only=F.col("o_orderstatus") != "P")
    return tagged.select("sales_key", F.coalesce("version_id", F.lit(-1)).alias("version_id"))


@register("version_record_count", "SELECT 1::BIGINT AS version_id, count(*) AS records_count FROM fact")
def version_record_count(spark, sf_dir):
    return lineage.rows_per_version(warehouse(spark, sf_dir).fact_sales())


@register(
    "versions_list",
    "SELECT strftime(r.start_time, 'v%Y%m%d_%H%M%S') AS version_number, records_inserted AS records_count, 'ACTIVE' AS status,"
    " CAST(r.start_time AS VARCHAR) AS created_at FROM runs r ORDER BY r.start_time DESC LIMIT 10",
    _RUNS,
)
def versions_list(spark, sf_dir):
    return lineage.versions_list(_versions(spark, sf_dir))


@register(
    "version_show",
    "SELECT version_id, strftime(start_time, 'v%Y%m%d_%H%M%S') AS version_number, 'ACTIVE' AS status, records_inserted AS records_count,"
    " CAST(start_time AS VARCHAR) AS created_at FROM numbered WHERE version_id = 199810",
    _RUNS,
)
def version_show(spark, sf_dir):
    versions = _versions(spark, sf_dir)
    first = versions.filter("version_id = 199810").select("version_number").scalar()
    return versions.filter(F.col("version_number") == first)


_OLD_LINES = (
    "invoice_no, transaction_type, quantity AS old_quantity, CAST(unit_price AS DOUBLE) AS unit_price, CAST(line_total AS DOUBLE) AS line_total,"
    " CAST(transaction_datetime AS VARCHAR) AS transaction_datetime"
)


@register(
    "change_archive",
    "SELECT invoice, stock_code, CASE WHEN pos % 17 = 0 THEN 'DELETE' ELSE 'UPDATE' END AS operation,"
    " CAST(CASE WHEN pos % 17 = 0 THEN 1 ELSE 2 END AS BIGINT) AS version_id, seq, pos, customer_id,"
    f" '{LOADED_AT}' AS created_at, '{BATCH}' AS batch_id, 'CSV' AS data_source,"
    " description, country, category,"
    f" subcategory, is_gift, {_OLD_LINES} FROM lines WHERE pos % 17 = 0 OR pos % 13 = 0",
)
def change_archive(spark, sf_dir):
    """Lines against a later state with some deleted and some corrected, both as stored snapshots; the whole old image."""
    before = warehouse(spark, sf_dir).lines().withColumn("version_id", F.lit(1)).drop("transaction_date", "row_id")
    corrected = F.col("pos") % 13 == 0
    after = before.filter("pos % 17 <> 0").withColumns(
        {
            "quantity": F.when(corrected, F.col("quantity") + 1).otherwise(F.col("quantity")),
            "version_id": F.when(corrected, 2).otherwise(F.col("version_id")),
        }
    )
    key, folder = ["invoice", "stock_code"], new_folder(spark, "snapshots")
    snapshots.write(before, key, f"{folder}/before", buckets=16)
    snapshots.write(after, key, f"{folder}/after", buckets=16)
    archive = snapshots.stored_changes(spark, f"{folder}/before", f"{folder}/after", before.schema, key)
    image = T.StructType([f for f in before.schema if f.name not in (*key, "version_id")])
    return archive.select(
        *key, "operation", "version_id", F.from_json("payload", image.json()).alias("p")
    ).select(*key, "operation", "version_id", "p.*").withColumnRenamed("quantity", "old_quantity")


@register(
    "archive_sink",
    "SELECT CASE WHEN invoice_no % 17 = 0 THEN 'DELETE' ELSE 'UPDATE' END AS operation, CAST(CASE WHEN invoice_no % 17 = 0 THEN 1 ELSE 2 END AS BIGINT) AS version_id,"
    f" '{LOADED_AT}' AS changed_at, 'clerk' AS changed_by, date_key, customer_key, product_key, '{BATCH}' AS batch_id, txn_year, 1::BIGINT AS old_version,"
    f" {_OLD_LINES} FROM fact WHERE invoice_no % 17 = 0 OR invoice_no % 13 = 0",
)
def archive_sink(spark, sf_dir):
    """What the archive table holds after a correction of the loaded sales rows."""
    before = warehouse(spark, sf_dir).fact_sales()
    corrected = F.col("invoice_no") % 13 == 0
    after = before.filter("invoice_no % 17 <> 0").withColumns(
        {
            "quantity": F.when(corrected, F.col("quantity") + 1).otherwise(F.col("quantity")),
            "version_id": F.when(corrected, 2).otherwise(F.col("version_id")),
        }
    )
    house = Warehouse(spark, new_folder(spark, "warehouse"))
    house.archive(before, after, LOADED_AT, "clerk")
    kept = house.fact_sales_archive().withColumn("p", F.from_json("payload", before.schema.json()))
    return kept.select(
        "operation", "version_id", "changed_at", "changed_by", "p.date_key", "p.customer_key", "p.product_key", "p.batch_id", "p.txn_year",
        F.col("p.version_id").alias("old_version"), "p.invoice_no", "p.transaction_type", F.col("p.quantity").alias("old_quantity"),
        "p.unit_price", "p.line_total", "p.transaction_datetime",
    )


@register(
    "column_catalog",
    "SELECT v.*, s.row_count AS rows, CASE WHEN s.row_count = 0 OR v.column_name IN ('source_file', 'error_message', 'expiry_date') THEN 0"
    f" ELSE s.row_count END AS non_null FROM (VALUES {CATALOG_ROWS})"
    " v(table_name, table_description, column_name, ordinal_position, data_type, is_nullable, column_default, column_description)"
    f" JOIN ({_SIZES}) s ON v.table_name = s.table_name",
    _SUITE_VIEWS,
)
def column_catalog(spark, sf_dir):
    """Columns of all ten tables with their types, defaults and meaning, and how many values they hold."""
    tables = warehouse(spark, sf_dir).tables()
    described = catalog.column_catalog(spark, tables)
    return described.join(catalog.filled_columns(tables), ["table_name", "column_name"])


@register(
    "table_sizes",
    _SIZES,
    _SUITE_VIEWS,
)
def table_sizes(spark, sf_dir):
    return catalog.table_sizes(warehouse(spark, sf_dir).tables())


@register(
    "relationships",
    """
    SELECT 'fact_sales' AS child_table, child_column, parent_table, parent_column, count(*) AS child_rows
    FROM fact, (VALUES ('date_key', 'dim_date', 'date_key'), ('customer_key', 'dim_customer', 'customer_key'),
      ('product_key', 'dim_product', 'product_key'), ('version_id', 'data_versions', 'version_id')) t(child_column, parent_table, parent_column)
    GROUP BY ALL""",
)
def relationships(spark, sf_dir):
    """Each relationship with the child rows that take part in it."""
    facts = catalog.filled_columns({"fact_sales": warehouse(spark, sf_dir).fact_sales()})
    filled = facts.select(
        F.col("table_name").alias("child_table"),
        F.col("column_name").alias("child_column"),
        F.col("non_null").alias("child_rows"),
    )
    return catalog.relationships(spark).join(filled, ["child_table", "child_column"])


# ---- streaming and user rules


@register(
    "incremental_load",
    "SELECT transaction_type, count(*) AS lines, CAST(sum(quantity) AS BIGINT) AS quantity, CAST(sum(line_total) AS DOUBLE) AS line_total FROM fact GROUP BY 1",
)
def incremental_load(spark, sf_dir):
    """Every line file that is not loaded yet, by a stream that stops when none is left."""
    home = new_folder(spark, "incremental")
    house = Warehouse(spark, f"{home}/warehouse")
    lines = sales_view(spark, sf_dir, lineitem=incremental.line_stream(spark, sf_dir))
    incremental.load_stream(house, lines, f"{home}/progress", CHECKS, LOADED_AT)
    return house.fact_sales().groupBy("transaction_type").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum(F.col("quantity").cast("bigint")).alias("quantity"),
        F.sum("line_total").alias("line_total"),
    )


@register(
    "streaming_clean",
    "SELECT seq, pos, invoice, stock_code, description_clean AS description, country_clean AS country, quantity,"
    " CAST(unit_price AS DOUBLE) AS unit_price, own AS customer_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS transaction_datetime"
    " FROM typed WHERE is_admitted",
)
def streaming_clean(spark, sf_dir):
    """The row-local rules on a stream of lines joined with stored tables."""
    stream = incremental.line_stream(spark, sf_dir)
    cleaned = incremental.clean_stream(sales_view(spark, sf_dir, lineitem=stream))
    return incremental.drain(cleaned, new_folder(spark, "stream"))


_SOUND = {
    "accepted": "SELECT seq, pos, invoice, stock_code, quantity, unit_price, ts, own AS customer_id,"
    " description_clean AS description, country_clean AS country FROM checked WHERE is_admitted AND valid AND unit_price <> 0 AND own <> ''",
    "tagged": VIEWS["tagged"],
    "lines": VIEWS["lines"],
}


@register(
    "streaming_conform",
    "SELECT seq, pos, invoice_no, transaction_type, quantity, CAST(unit_price AS DOUBLE) AS unit_price,"
    " CAST(line_total AS DOUBLE) AS line_total, strftime(transaction_datetime, '%Y-%m-%d %H:%M:%S') AS transaction_datetime,"
    " customer_id, stock_code, description, country, category, subcategory, is_gift FROM lines",
    _SOUND,
)
def streaming_conform(spark, sf_dir):
    """Lines that pass every check by themselves, conformed on the stream as in a batch."""
    stream = incremental.line_stream(spark, sf_dir)
    cleaned = incremental.clean_stream(sales_view(spark, sf_dir, lineitem=stream))
    done = incremental.drain(incremental.conform_stream(cleaned, CHECKS), new_folder(spark, "stream"))
    return done.drop("invoice", "transaction_date")


@register(
    "streaming_dedup",
    "SELECT 'kept' AS outcome, invoice, stock_code, 1::BIGINT AS lines FROM typed WHERE is_admitted AND ts IS NOT NULL GROUP BY invoice, stock_code"
    " UNION ALL SELECT 'undated', invoice, stock_code, count(*) FROM typed WHERE is_admitted AND ts IS NULL GROUP BY invoice, stock_code"
    " UNION ALL SELECT 'late', '', '', 0",
)
def streaming_dedup(spark, sf_dir):
    """One line per invoice and stock code over the life of a stream, and what it could not place."""
    stream = incremental.line_stream(spark, sf_dir)
    cleaned = incremental.clean_stream(sales_view(spark, sf_dir, lineitem=stream)).select("invoice", "stock_code", "transaction_datetime")
    # Two streams follow: the lines are made and cleaned once, and only what both need is kept.
    landed, folder = cleaned.schema, new_folder(spark, "stream")
    incremental.drain(cleaned, folder)
    cleaned = spark.readStream.schema(landed).parquet(f"{folder}/rows")
    report: dict[str, int] = {}
    once = incremental.drain(incremental.deduplicate_stream(cleaned, "20 days"), new_folder(spark, "stream"), report)
    undated = incremental.drain(incremental.undated_stream(cleaned), new_folder(spark, "stream"))
    late = spark.createDataFrame([("late", "", "", report["late"])], "outcome string, invoice string, stock_code string, lines bigint")
    count = F.count(F.lit(1)).alias("lines")
    kept, apart = (
        rows.groupBy("invoice", "stock_code").agg(count).select(F.lit(name).alias("outcome"), "invoice", "stock_code", "lines")
        for name, rows in (("kept", once), ("undated", undated))
    )
    return kept.unionByName(apart).unionByName(late)


_LATE_SPLIT = "2014-06-01"
_LATE = {
    "dealt": f"SELECT *, CASE WHEN pos % 11 = 0 THEN 3 WHEN ts < TIMESTAMP '{_LATE_SPLIT}' THEN 1 ELSE 2 END AS delivery FROM typed WHERE is_admitted AND ts IS NOT NULL",
    "marks": "SELECT (SELECT max(ts) FROM dealt WHERE delivery = 1) - INTERVAL 20 DAY AS second,"
    " (SELECT max(ts) FROM dealt WHERE delivery < 3) - INTERVAL 20 DAY AS third",
    "timed": "SELECT d.*, CASE delivery WHEN 2 THEN second WHEN 3 THEN third END AS mark FROM dealt d JOIN marks ON true",
    "timely": "SELECT *, row_number() OVER (PARTITION BY delivery, invoice, stock_code ORDER BY pos) AS place FROM timed WHERE coalesce(ts > mark, true)",
    "kept1": "SELECT * FROM timely WHERE delivery = 1 AND place = 1",
    "kept2": "SELECT * FROM timely t WHERE delivery = 2 AND place = 1 AND NOT EXISTS (SELECT 1 FROM kept1 k"
    " WHERE k.invoice = t.invoice AND k.stock_code = t.stock_code AND k.ts + INTERVAL 20 DAY > t.mark)",
    "kept12": "SELECT * FROM kept1 UNION ALL SELECT * FROM kept2",
    "kept3": "SELECT * FROM timely t WHERE delivery = 3 AND place = 1 AND NOT EXISTS (SELECT 1 FROM kept12 k"
    " WHERE k.invoice = t.invoice AND k.stock_code = t.stock_code AND k.ts + INTERVAL 20 DAY > t.mark)",
    "kept": "SELECT seq, pos FROM kept12 UNION ALL SELECT seq, pos FROM kept3",
}


@register(
    "streaming_late_lines",
    "SELECT t.seq, t.pos, invoice, stock_code, CAST(delivery - 1 AS BIGINT) AS batch, CASE WHEN ts <= mark THEN 'late' WHEN k.pos IS NOT NULL THEN 'kept' ELSE 'duplicate' END AS outcome"
    " FROM timed t LEFT JOIN kept k ON t.seq = k.seq AND t.pos = k.pos"
    " UNION ALL SELECT seq, pos, invoice, stock_code, CASE WHEN pos % 11 = 0 THEN 2 ELSE 1 END, 'undated' FROM typed WHERE is_admitted AND ts IS NULL",
    _LATE,
)
def streaming_late_lines(spark, sf_dir):
    """Lines in three deliveries, the last of which comes long after its time; each line once, with what became of it."""
    cleaned = incremental.clean_stream(sales_view(spark, sf_dir))
    early = F.coalesce(F.col("transaction_datetime") < F.lit(_LATE_SPLIT).cast("timestamp_ntz"), F.lit(False))
    delivery = F.when(F.col("pos") % 11 == 0, 3).when(early, 1).otherwise(2)
    folder = new_folder(spark, "stream")
    cleaned.withColumn("delivery", delivery).write.partitionBy("delivery").parquet(f"{folder}/dealt", compression=CODEC)
    ledger = lateness.LateLedger(f"{folder}/ledger", "20 days", ["invoice", "stock_code"], ["pos"])
    for number in (1, 2, 3):
        dealt = spark.read.schema(cleaned.schema).parquet(f"{folder}/dealt/delivery={number}")
        dealt.write.mode("append").parquet(f"{folder}/inbox", compression=CODEC)
        ledger.run(spark.readStream.schema(cleaned.schema).parquet(f"{folder}/inbox"))
    return ledger.lines(spark, cleaned.schema).select("seq", "pos", "invoice", "stock_code", "batch", "outcome")


@register(
    "user_rules",
    """
    SELECT 'short_code' AS metric_name, count(*) FILTER (WHERE length(StockCode) <= 5) AS hits, count(*) AS rows_checked FROM raw_sales
    UNION ALL SELECT 'vowel_country', count(*) FILTER (WHERE regexp_matches(lower(trim(Country)), '^[aeiou]')), count(*) FROM raw_sales""",
)
def user_rules(spark, sf_dir):
    """A caller's predicate as a column expression and one as a Python function."""
    vowel = rules.python_rule(
        "vowel_country", ["Country"], lambda v: (v or "").strip().lower()[:1] in set("aeiou") - {""}, "boolean"
    )
    suite = [
        quality.validity("short_code", "StockCode", lambda c: F.length(c) <= 5),
        quality.validity("vowel_country", "Country", vowel.apply),
    ]
    raw = sales_view(spark, sf_dir, ["StockCode", "Country"])
    return quality.measure(raw, "raw_sales", suite).select("metric_name", "hits", "rows_checked")
