from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import quality, trends


def results(spark, scores):
    return spark.createDataFrame([(n, float(s)) for n, s in scores.items()], "metric_name string, metric_value double")


def test_each_measure(spark):
    df = spark.createDataFrame(
        [("a", "1", "2010-12-01 08:26:00"), ("", "x", "2010-13-01 08:26:00"), (None, "5000", None), ("a", " 7 ", "x")],
        "s string, n string, t string",
    )
    suite = [
        quality.completeness("complete", "s"),
        quality.uniqueness("unique", "s"),
        quality.validity("valid", "s"),
        quality.validity("dated", "t", quality.is_date_time),
        quality.numeric_range("range", "n", 1, 1000),
        quality.numeric_range("no_numbers", "t", 1, 2),
        quality.composite_uniqueness("pair", ["s", "n"]),
    ]
    out = {r.metric_name: (r.hits, r.rows_checked, round(r.metric_value, 2)) for r in quality.measure(df, "t", suite).collect()}
    assert out == {
        "complete": (2, 4, 50.0),
        "unique": (2, 3, 66.67),
        "valid": (2, 4, 50.0),
        "dated": (1, 4, 25.0),
        "range": (2, 3, 66.67),
        "no_numbers": (0, 0, 0.0),
        "pair": (4, 4, 100.0),
    }


@pytest.mark.parametrize(
    "operator,score,met",
    [(">=", 95.0, True), (">=", 94.9, False), ("<=", 95.0, True), ("<=", 95.1, False),
     ("==", 95.005, True), ("==", 95.1, False), ("!=", 95.1, True), ("!=", 95.005, False)],
)
def test_threshold_operators(spark, operator, score, met):
    row = quality.with_thresholds(results(spark, {"m": score}), {"m": 95.0}, {"m": operator}).first()
    assert row.is_threshold_met is met


def test_a_metric_without_a_threshold_has_no_verdict(spark):
    row = quality.with_thresholds(results(spark, {"m": 1.0}), {"other": 95.0}).first()
    assert row.threshold_value is None and row.is_threshold_met is None


def test_summary_gate_and_alerts(spark):
    scored = quality.with_thresholds(results(spark, {"a": 100.0, "b": 60.0}), {"a": 95.0, "b": 95.0})
    total = quality.summary(scored)
    row = quality.load_gate(total).first()
    assert (row.total_checks, row.passed_checks, row.failed_checks) == (2, 1, 1)
    assert (row.success_rate, row.overall_score, row.is_gate_passed) == (50.0, 80.0, False)
    assert [r.severity for r in quality.score_alerts(total).collect()] == ["WARNING"]
    nothing = quality.summary(scored.limit(0))
    empty = quality.load_gate(nothing).first()
    assert empty.warning == "No data available for quality checks"
    assert empty.overall_score == 0.0


@pytest.mark.parametrize("score,severity", [(69.9, ["CRITICAL"]), (70.0, ["WARNING"]), (90.0, [])])
def test_alert_levels(spark, score, severity):
    total = spark.createDataFrame([(score, 1)], "overall_score double, failed_checks int")
    assert [r.severity for r in quality.score_alerts(total).collect()] == severity


def test_orphans(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (3,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (4,)], "id int")
    row = quality.orphans(child, "k", parent, "id").first()
    assert (row.orphan_keys, row.orphan_rows) == (2, 3)


def test_constraints_with_tolerance(spark):
    df = spark.createDataFrame(
        [(2, Decimal("1.50"), Decimal("3.00")), (0, Decimal("1.00"), Decimal("0.01")), (1, Decimal("-1.00"), Decimal("5.00"))],
        "quantity int, unit_price decimal(10,2), line_total decimal(15,2)",
    )

    def broken(tolerance):
        return {r.constraint_name: r.violations for r in quality.constraint_violations(df, tolerance).collect()}

    assert broken(0) == {"quantity_positive": 1, "unit_price_non_negative": 1, "line_total_is_product": 2}
    assert broken(0.01)["line_total_is_product"] == 1


def history(spark, rows):
    df = spark.createDataFrame(rows, "metric_id string, table_name string, metric_name string, v double, t string")
    return df.select(
        "metric_id", "table_name", "metric_name", F.col("v").cast("decimal(15,4)").alias("metric_value"),
        F.col("t").cast("timestamp_ntz").alias("measured_at"),
    )


ROWS = [
    ("1", "f", "m", 100.0, "2024-01-01 10:00:00"),
    ("2", "f", "m", 5.0, "2024-01-01 10:00:30"),
    ("3", "f", "m", 99.0, "2024-01-02 10:00:00"),
    ("4", "f", "m", 75.0, "2024-01-03 10:00:00"),
    ("5", "g", "m", 1.0, "2024-01-03 10:00:00"),
]


def test_anomalies_compare_with_the_measurement_before(spark):
    found = trends.anomalies(history(spark, ROWS), "2024-01-04", threshold=20.0)
    out = sorted((r.metric_id, r.previous_score, r.score_drop, r.severity) for r in found.collect())
    assert out == [("2", 100.0, 95.0, "HIGH"), ("4", 99.0, 24.0, "HIGH")]
    alert = trends.anomaly_alert(found).first()
    assert (alert.anomaly_count, alert.worst_drop, alert.affected_tables) == (2, 95.0, "f")
    assert trends.anomaly_alert(found.limit(0)).isEmpty()


def test_trend(spark):
    days = trends.daily(history(spark, ROWS), "2024-01-04")
    out = sorted((str(r.day), r.avg_score, r.checks_count, r.poor_quality_count) for r in days.collect())
    assert out == [("2024-01-01", 52.5, 2, 1), ("2024-01-02", 99.0, 1, 0), ("2024-01-03", 38.0, 2, 2)]
    total = trends.trend_summary(days).first()
    assert total.quality_trend == "DECLINING"
    assert (total.total_checks, total.poor_quality_days) == (5, 2)


def test_plain_measures_meet_no_key(spark):
    """Only the distinct count shuffles values; the counters combine into one row per task."""
    from tallyhouse.operators import quality

    df = spark.range(100).selectExpr("id AS sales_key", "id AS invoice_no", "id AS product_key")
    suite = [quality.completeness("a", "invoice_no"), quality.completeness("b", "product_key"), quality.uniqueness("c", "sales_key")]
    assert sorted((r.metric_name, r.hits) for r in quality.measure(df, "t", suite).collect()) == [("a", 100), ("b", 100), ("c", 100)]
    plan = quality.measure(df, "t", suite[:2])._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "Exchange SinglePartition" in plan
