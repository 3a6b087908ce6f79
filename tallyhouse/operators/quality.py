"""Data-quality scores, verdicts, summaries, alerts and constraint checks."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.text import is_blank, strip

COMPLETENESS, UNIQUENESS, VALIDITY = "completeness", "uniqueness", "validity"


@dataclass(frozen=True)
class Measure:
    """A percentage: hits of all counted rows."""

    name: str
    kind: str
    column: str
    hits: Callable[[str], Column]
    rows: Callable[[str], Column]


def _all_rows(_: str) -> Column:
    return F.count(F.lit(1))


def completeness(name: str, column: str) -> Measure:
    return Measure(
        name, COMPLETENESS, column, lambda c: F.count_if(~is_blank(F.col(c))), _all_rows
    )


def uniqueness(name: str, column: str) -> Measure:
    """Distinct values of the values that are there."""
    return Measure(
        name,
        UNIQUENESS,
        column,
        lambda c: F.count_distinct(F.col(c)),
        lambda c: F.count(F.col(c)),
    )


def composite_uniqueness(name: str, columns: list[str]) -> Measure:
    """Uniqueness of several columns taken together."""
    return Measure(
        name,
        UNIQUENESS,
        "|".join(columns),
        lambda _: F.count_distinct(F.struct(*columns)),
        _all_rows,
    )


def validity(
    name: str, column: str, predicate: Callable[[Column], Column] | None = None
) -> Measure:
    """Share of rows that pass a predicate; by default any value will do."""
    check = predicate or (lambda c: ~is_blank(c))
    return Measure(
        name,
        VALIDITY,
        column,
        lambda c: F.count_if(F.coalesce(check(F.col(c)), F.lit(False))),
        _all_rows,
    )


def numeric_range(
    name: str, column: str, low: float | None = None, high: float | None = None
) -> Measure:
    """Share of the numeric values that lie in the range, both ends included."""

    def hits(c: str) -> Column:
        x = F.col(c).try_cast("double")
        inside = x.isNotNull()
        inside = inside & (x >= low) if low is not None else inside
        inside = inside & (x <= high) if high is not None else inside
        return F.count_if(inside)

    return Measure(name, VALIDITY, column, hits, lambda c: F.count(F.col(c).try_cast("double")))


def is_date_time(c: Column) -> Column:
    """A timestamp, or text laid out as year-month-day hour:minute:second."""
    layout = r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$"
    text = c.cast("string")
    return text.rlike(layout) & text.try_cast("timestamp_ntz").isNotNull()


def is_timestamp(c: Column) -> Column:
    return c.isNotNull()


def is_description(c: Column) -> Column:
    return F.length(strip(c)) >= 3


# The checks of each table.
SUITES = {
    "fact_sales": [
        completeness("invoice_completeness", "invoice_no"),
        completeness("product_completeness", "product_key"),
        completeness("customer_completeness", "customer_key"),
        uniqueness("transaction_uniqueness", "sales_key"),
        numeric_range("quantity_range", "quantity", -1000, 10000),
        numeric_range("price_range", "unit_price", 0, 1000),
        validity("date_validity", "transaction_datetime", is_timestamp),
    ],
    "dim_customer": [
        completeness("customer_id_completeness", "customer_id"),
        completeness("country_completeness", "country"),
        uniqueness("customer_id_uniqueness", "customer_id"),
    ],
    "dim_product": [
        completeness("stock_code_completeness", "stock_code"),
        uniqueness("stock_code_uniqueness", "stock_code"),
        validity("description_validity", "description", is_description),
    ],
}

# The score each check has to reach, in percent.
THRESHOLDS = {
    "invoice_completeness": 95.0,
    "product_completeness": 95.0,
    "customer_completeness": 80.0,
    "transaction_uniqueness": 99.0,
    "quantity_range": 95.0,
    "price_range": 98.0,
    "date_validity": 100.0,
    "customer_id_completeness": 90.0,
    "country_completeness": 95.0,
    "customer_id_uniqueness": 100.0,
    "stock_code_completeness": 100.0,
    "stock_code_uniqueness": 100.0,
    "description_validity": 90.0,
}


def measure(df: DataFrame, table: str, suite: list[Measure] | None = None) -> DataFrame:
    """All checks of a table, one output row per check.

    Plain counters share one aggregation that combines before any shuffle. A
    distinct count would send their counters along with each of its values, so
    each one is an aggregation of its own, over its own column.
    """
    suite = SUITES[table] if suite is None else suite
    plain = [m for m in suite if m.kind != UNIQUENESS]
    parts = [[m] for m in suite if m.kind == UNIQUENESS] + ([plain] if plain else [])
    whole = None
    for part in parts:
        rows = _measured(df, table, part)
        whole = rows if whole is None else whole.unionByName(rows)
    return whole


def _measured(df: DataFrame, table: str, suite: list[Measure]) -> DataFrame:
    totals = []
    for i, m in enumerate(suite):
        totals += [m.hits(m.column).alias(f"h{i}"), m.rows(m.column).alias(f"r{i}")]
    rows = ", ".join(
        f"'{m.name}', '{m.kind}', '{m.column}', h{i}, r{i}" for i, m in enumerate(suite)
    )
    score = F.coalesce(F.try_divide(F.col("hits") * 100.0, F.col("rows_checked")), F.lit(0.0))
    return (
        df.agg(*totals)
        .selectExpr(
            f"stack({len(suite)}, {rows})"
            " AS (metric_name, metric_type, column_name, hits, rows_checked)"
        )
        .select(
            F.lit(table).alias("table_name"),
            "column_name",
            "metric_name",
            "metric_type",
            score.alias("metric_value"),
            "hits",
            "rows_checked",
        )
    )


def _compare(value: Column, limit: Column, operator: str) -> Column:
    near = F.abs(value - limit) < 0.01
    return {">=": value >= limit, "<=": value <= limit, "==": near, "!=": ~near}[operator]


def with_thresholds(
    results: DataFrame,
    thresholds: dict[str, float] = THRESHOLDS,
    operators: dict[str, str] | None = None,
) -> DataFrame:
    """Add the threshold of each check and whether it is met, NULL if it has none."""
    limit, met = F, F
    for name, value in thresholds.items():
        here = F.col("metric_name") == name
        operator = (operators or {}).get(name, ">=")
        limit = limit.when(here, F.lit(float(value)))
        met = met.when(here, _compare(F.col("metric_value"), F.lit(float(value)), operator))
    none = F.lit(None)
    return results.withColumns(
        {
            "threshold_value": limit.otherwise(none.cast("double")),
            "is_threshold_met": met.otherwise(none.cast("boolean")),
        }
    )


def check(df: DataFrame, table: str) -> DataFrame:
    """Scores and verdicts of a table, over all its rows."""
    return with_thresholds(measure(df, table))


def summary(results: DataFrame) -> DataFrame:
    """One row: checks, passes, fails, success rate and mean score."""
    passed = F.count_if(F.col("is_threshold_met"))
    checks = F.count(F.lit(1))
    return results.agg(
        checks.alias("total_checks"),
        passed.alias("passed_checks"),
        F.count_if(~F.col("is_threshold_met")).alias("failed_checks"),
        F.coalesce(F.try_divide(passed * 100.0, checks), F.lit(0.0)).alias("success_rate"),
        F.coalesce(F.avg("metric_value"), F.lit(0.0)).alias("overall_score"),
    )


def summary_by_type(results: DataFrame) -> DataFrame:
    return results.groupBy("metric_type").agg(
        F.avg("metric_value").alias("average_score"),
        F.min("metric_value").alias("min_score"),
        F.max("metric_value").alias("max_score"),
        F.count(F.lit(1)).alias("check_count"),
    )


def load_gate(summaries: DataFrame, quality_threshold: float = 0.95) -> DataFrame:
    """Mark a load whose overall score is too low, or that had no data to check."""
    limit = quality_threshold * 100
    warning = F.when(F.col("total_checks") == 0, "No data available for quality checks").when(
        F.col("overall_score") < limit, F.lit("Quality score below threshold")
    )
    return summaries.withColumns(
        {
            "quality_threshold": F.lit(float(limit)),
            "is_gate_passed": (F.col("total_checks") > 0) & (F.col("overall_score") >= limit),
            "warning": warning,
        }
    )


def score_alerts(summaries: DataFrame, table: str = "fact_sales") -> DataFrame:
    """At most one alert per summary: critical below 70, warning below 90."""
    severity = F.when(F.col("overall_score") < 70, "CRITICAL").when(
        F.col("overall_score") < 90, "WARNING"
    )
    message = F.when(
        severity == "CRITICAL", F.lit(f"Critical quality issue in {table}")
    ).otherwise(F.lit(f"Quality degradation in {table}"))
    return summaries.filter(severity.isNotNull()).select(
        severity.alias("severity"),
        message.alias("message"),
        "overall_score",
        "failed_checks",
        F.lit(table).alias("table_name"),
    )


def report(results: DataFrame) -> DataFrame:
    """The report as rows: one status line per check."""
    return results.select(
        "table_name",
        "metric_name",
        F.when(F.col("is_threshold_met"), "PASS").otherwise("FAIL").alias("status"),
        F.round("metric_value", 2).alias("metric_value"),
        "threshold_value",
        "hits",
        "rows_checked",
    )


def constraint_violations(fact: DataFrame, tolerance: float = 0.0) -> DataFrame:
    """Rows that break each column rule of the fact table, in one pass."""
    off = F.abs(F.col("line_total") - F.col("quantity") * F.col("unit_price")) > tolerance
    broken = {
        "quantity_positive": F.col("quantity") <= 0,
        "unit_price_non_negative": F.col("unit_price") < 0,
        "line_total_is_product": off,
    }
    pairs = ", ".join(f"'{name}', {name}" for name in broken)
    return fact.agg(*[F.count_if(c).alias(n) for n, c in broken.items()]).selectExpr(
        f"stack({len(broken)}, {pairs}) AS (constraint_name, violations)"
    )


def invalid_effect_signs(types: DataFrame) -> DataFrame:
    return types.filter(~F.col("effect_sign").isin(-1, 0, 1))


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose key has no parent; a NULL key refers to nothing.

    Keys are counted before they meet the parent, so a key with very many
    rows travels as one row per task.
    """
    keys = (
        child.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("_key"))
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    known = parent.select(F.col(parent_column).alias("_key"))
    return (
        keys.join(known, "_key", "left_anti")
        .agg(
            F.count(F.lit(1)).alias("orphan_keys"),
            F.coalesce(F.sum("_rows"), F.lit(0)).alias("orphan_rows"),
        )
        .select(
            F.lit(column).alias("child_column"),
            F.lit(parent_column).alias("parent_column"),
            "orphan_keys",
            "orphan_rows",
        )
    )
