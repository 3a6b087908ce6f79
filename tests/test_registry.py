"""Registered queries against DuckDB on the same tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from tallyhouse.plans import registry
from tests.conftest import SF_DIR

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

# A cross-section of the operators; the whole list is checked by the driver.
CHOSEN = [
    "ingest_gate", "clean_description", "clean_date", "clean_unit_price", "line_verdict",
    "line_verdict_split_invoices", "customer_backfill", "validation_summary", "missing_fill_mode",
    "iqr_bounds", "dedup_keep_latest", "conformed_lines", "date_dimension", "product_scd1_upsert",
    "customer_scd2_history", "scd2_as_of", "fact_build", "sales_summary", "top_products",
    "customer_stats", "net_revenue_by_type", "quality_suite", "quality_anomalies", "archive_sink",
    "quality_trend_summary", "referential_integrity", "change_archive", "version_create",
    "streaming_clean", "table_sizes", "compacted_fact", "recent_lineage_of_loads", "batch_lineage_of_loads",
    "load_metrics_of_loads", "versions_of_loads", "repository_export", "column_catalog",
]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def rows(pdf):
    pdf = pdf[sorted(pdf.columns)]
    return list(pdf.columns), sorted(
        repr(tuple(None if v is None or v != v else v for v in row))
        for row in pdf.astype(object).itertuples(index=False, name=None)
    )


@pytest.mark.parametrize("name", CHOSEN)
def test_matches_duckdb(spark, duck, name):
    found = contract.queries()[name](spark, SF_DIR).toPandas()
    expected = duck.sql(contract.oracle_sql()[name]).df()
    assert rows(found) == rows(expected)


def test_every_check_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(CHOSEN) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).count() == 10


def test_warehouse_is_loaded_once(spark):
    assert registry.warehouse(spark, SF_DIR) is registry.warehouse(spark, SF_DIR + "/")


def test_columns_that_must_hold_a_value_do(spark):
    found = registry.QUERIES["column_catalog"](spark, SF_DIR).filter("not is_nullable").collect()
    assert len(found) == 45 and all(r.non_null == r.rows for r in found)
