"""Declared schemas; nothing in the package infers a type from data."""

from pyspark.sql import types as T

RAW_COLUMNS = [
    "InvoiceNo",
    "StockCode",
    "Description",
    "Quantity",
    "InvoiceDate",
    "UnitPrice",
    "CustomerID",
    "Country",
]

RAW = T.StructType([T.StructField(name, T.StringType()) for name in RAW_COLUMNS])

MONEY = T.DecimalType(10, 2)
LINE_MONEY = T.DecimalType(15, 2)
SCORE = T.DecimalType(15, 4)


_TYPES = {
    "int": T.IntegerType(),
    "smallint": T.ShortType(),
    "bigint": T.LongType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(),
    "money": MONEY,
    "line_money": LINE_MONEY,
    "score": SCORE,
}


def _table(columns: str) -> T.StructType:
    """Schema from "name type" pairs; needs no session, unlike fromDDL."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


DIM_DATE = _table(
    "date_key int, date_value date, year int, quarter int, month int, week int,"
    " day_of_year int, day_of_month int, day_of_week int, month_name string,"
    " day_name string, quarter_name string, is_weekend boolean, is_holiday boolean"
)

DIM_CUSTOMER = _table(
    "customer_key bigint, customer_id string, country string,"
    " effective_date timestamp, expiry_date timestamp, version_id int,"
    " version_created_at timestamp, is_current boolean,"
    " created_at timestamp, updated_at timestamp, data_source string"
)

DIM_PRODUCT = _table(
    "product_key bigint, stock_code string, description string, version_id int,"
    " version_created_at timestamp, category string, subcategory string,"
    " is_active boolean, is_gift boolean, created_at timestamp,"
    " updated_at timestamp, data_source string"
)

DATA_VERSIONS = _table(
    "version_id int, version_number string, version_type string,"
    " description string, source_file string, file_hash string,"
    " etl_job_id string, status string, records_count bigint,"
    " created_at timestamp"
)

DIM_TRANSACTION_TYPE = _table(
    "transaction_type string, effect_sign smallint, description string"
)

DATA_LINEAGE = _table(
    "lineage_id string, source_system string, source_table string,"
    " source_file string, target_table string, etl_job_name string,"
    " batch_id string, records_processed bigint, records_inserted bigint,"
    " records_updated bigint, records_rejected bigint,"
    " start_time timestamp, end_time timestamp, duration_seconds int,"
    " status string, error_message string, job_metadata string,"
    " created_at timestamp"
)

DATA_QUALITY_METRICS = _table(
    "metric_id string, table_name string, column_name string,"
    " metric_name string, metric_value score,"
    " threshold_value score, is_threshold_met boolean,"
    " batch_id string, measured_at timestamp, details string"
)

DATA_QUALITY_ALERTS = _table(
    "alert_time timestamp, severity string, message string, metadata string"
)

# Every raw line of a load with its clean columns; stored by verdict.
JUDGED = _table(
    "seq bigint, pos bigint, row_id bigint, InvoiceNo string, StockCode string,"
    " Description string, Quantity string, InvoiceDate string, UnitPrice string,"
    " CustomerID string, Country string, raw_line string, batch_id string, data_source string,"
    " created_at timestamp, invoice string, stock_code string, units int,"
    " unit_price money, transaction_datetime timestamp, customer_id string,"
    " clean_description string, clean_country string, reject_reason string,"
    " verdict string"
)

# Lines of merged loads also say which load they came with.
JUDGED_MERGED = T.StructType([*JUDGED.fields, T.StructField("merged_from", T.StringType())])

FACT_SALES = _table(
    "sales_key bigint, date_key int, version_id int,"
    " version_created_at timestamp, customer_key bigint,"
    " product_key bigint, invoice_no bigint, transaction_type string,"
    " quantity int, unit_price money, line_total line_money,"
    " transaction_datetime timestamp, created_at timestamp,"
    " batch_id string, data_source string, txn_year int"
)

FACT_SALES_ARCHIVE = _table(
    "sales_key bigint, operation string, version_id int,"
    " changed_at timestamp, changed_by string, payload string"
)

TABLES = {
    "data_lineage": DATA_LINEAGE,
    "data_quality_alerts": DATA_QUALITY_ALERTS,
    "data_quality_metrics": DATA_QUALITY_METRICS,
    "data_versions": DATA_VERSIONS,
    "dim_customer": DIM_CUSTOMER,
    "dim_date": DIM_DATE,
    "dim_product": DIM_PRODUCT,
    "dim_transaction_type": DIM_TRANSACTION_TYPE,
    "fact_sales": FACT_SALES,
    "fact_sales_archive": FACT_SALES_ARCHIVE,
}

# Columns that always hold a value, and what a column holds where a load gives none.
REQUIRED = {
    "data_lineage": (
        "lineage_id", "source_system", "source_table", "target_table", "etl_job_name", "batch_id", "records_processed",
        "records_inserted", "records_updated", "records_rejected", "start_time", "end_time", "duration_seconds", "status",
    ),
    "data_quality_alerts": (),
    "data_quality_metrics": ("metric_id", "table_name", "metric_name", "metric_value", "batch_id", "measured_at"),
    "data_versions": ("version_id", "version_number"),
    "dim_customer": ("customer_key",),
    "dim_date": ("date_key", "date_value"),
    "dim_product": ("product_key",),
    "dim_transaction_type": ("transaction_type", "effect_sign", "description"),
    "fact_sales": (
        "sales_key", "date_key", "customer_key", "product_key", "invoice_no", "transaction_type", "quantity", "unit_price",
        "line_total", "transaction_datetime", "created_at", "data_source",
    ),
    "fact_sales_archive": ("sales_key", "operation", "changed_at", "payload"),
}
DEFAULTS = {
    ("data_lineage", "records_rejected"): "0",
    ("data_lineage", "created_at"): "load time",
    ("data_quality_alerts", "alert_time"): "load time",
    ("data_quality_metrics", "measured_at"): "load time",
    ("data_versions", "version_type"): "INCREMENTAL",
    ("data_versions", "created_at"): "load time",
    ("dim_customer", "customer_key"): "next key",
    ("dim_product", "product_key"): "next key",
    ("dim_product", "is_active"): "true",
    ("dim_product", "is_gift"): "false",
    ("fact_sales", "sales_key"): "next key",
    ("fact_sales_archive", "changed_at"): "load time",
}
