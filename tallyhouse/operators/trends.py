"""Quality scores over time: daily trend, its summary, and sudden drops."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.carry import carry_last


def _start(as_of: str, days: int) -> Column:
    return F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL {int(days)} DAYS")


def daily(
    history: DataFrame, as_of: str, days: int = 30, by: tuple[str, ...] = ()
) -> DataFrame:
    """Mean score, checks and weak checks per day, optionally split further."""
    recent = history.filter(F.col("measured_at") >= _start(as_of, days))
    return recent.groupBy(F.to_date("measured_at").alias("day"), *by).agg(
        F.avg(F.col("metric_value").cast("double")).alias("avg_score"),
        F.count(F.lit(1)).alias("checks_count"),
        F.count_if(F.col("metric_value") < 90).alias("poor_quality_count"),
    )


def trend_summary(days: DataFrame) -> DataFrame:
    """Level and direction over the days; days without a score only count checks."""
    scored = F.col("avg_score") > 0
    score = F.when(scored, F.col("avg_score"))
    day = F.when(scored, F.col("day"))
    first, last = F.min_by("avg_score", day), F.max_by("avg_score", day)
    direction = (
        F.when(last > first, "IMPROVING").when(last < first, "DECLINING").otherwise("STABLE")
    )
    return days.agg(
        F.avg(score).alias("avg_quality_score"),
        F.min(score).alias("min_quality_score"),
        F.max(score).alias("max_quality_score"),
        direction.alias("quality_trend"),
        F.sum("checks_count").alias("total_checks"),
        F.count_if(F.col("poor_quality_count") > 0).alias("poor_quality_days"),
    )


def anomalies(
    history: DataFrame, as_of: str, days: int = 7, threshold: float = 90.0
) -> DataFrame:
    """Scores that fell by more than `threshold` points since the last one.

    There are few tables and metrics but any number of measurements, so the
    look back runs in chunks of one minute instead of one window per metric.
    """
    at = F.col("measured_at")
    minute = (
        F.datediff(F.to_date(at), F.lit("1970-01-01").cast("date")).cast("bigint") * 1440
        + F.hour(at) * 60
        + F.minute(at)
    )
    recent = history.filter(at >= _start(as_of, days)).withColumns(
        {"_at": F.struct("measured_at", "metric_id"), "_minute": minute}
    )
    looked = carry_last(
        recent, ["table_name", "metric_name"], "_minute", "_at", "metric_value", "_previous"
    )
    drop = F.col("_previous") - F.col("metric_value")
    return looked.filter(drop > threshold).select(
        "metric_id",
        "table_name",
        "metric_name",
        F.col("metric_value").cast("double").alias("current_score"),
        F.col("_previous").cast("double").alias("previous_score"),
        drop.cast("double").alias("score_drop"),
        "measured_at",
        F.when(drop > 20, "HIGH").otherwise("MEDIUM").alias("severity"),
    )


def anomaly_alert(found: DataFrame) -> DataFrame:
    """One alert over the severe anomalies; no row if there are none."""
    severe = found.filter("severity = 'HIGH'")
    return (
        severe.agg(
            F.count(F.lit(1)).alias("anomaly_count"),
            F.max("score_drop").alias("worst_drop"),
            # As many entries as there are tables, whatever the history's size.
            F.sort_array(F.collect_set("table_name")).alias("_tables"),
        )
        .filter("anomaly_count > 0")
        .select(
            F.lit("ERROR").alias("severity"),
            F.lit("Quality anomalies detected").alias("message"),
            "anomaly_count",
            "worst_drop",
            F.array_join("_tables", ",").alias("affected_tables"),
        )
    )
