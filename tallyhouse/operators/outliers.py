"""Outlier flags on a numeric column; they mark lines and drop none."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.quantiles import exact_quantiles


def iqr_bounds(
    df: DataFrame, column: str, k: float = 1.5, approximate: bool = False
) -> DataFrame:
    """Lower and upper fence around the middle half of the values, one row.

    `approximate` quartiles are off by at most a ten-thousandth of the ranks.
    """
    if approximate:
        edges = df.agg(
            F.percentile_approx(F.col(column).cast("double"), [0.25, 0.75], 10000).alias("q")
        ).select(F.col("q")[0].alias("q1"), F.col("q")[1].alias("q3"))
    else:
        edges = exact_quantiles(df, column, {"q1": 0.25, "q3": 0.75})
    spread = F.col("q3") - F.col("q1")
    return edges.select(
        "q1",
        "q3",
        (F.col("q1") - k * spread).alias("lower_bound"),
        (F.col("q3") + k * spread).alias("upper_bound"),
    )


def flag_iqr(
    df: DataFrame,
    column: str,
    k: float = 1.5,
    approximate: bool = False,
    flag: str = "is_outlier",
) -> DataFrame:
    fence = (
        iqr_bounds(df, column, k, approximate)
        .select(F.struct("lower_bound", "upper_bound").alias("fence"))
        .scalar()
    )
    x = F.col(column).cast("double")
    outside = (x < fence["lower_bound"]) | (x > fence["upper_bound"])
    return df.withColumn(flag, F.coalesce(outside, F.lit(False)))


def flag_zscore(
    df: DataFrame, column: str, threshold: float = 3.0, flag: str = "is_outlier"
) -> DataFrame:
    """Distance from the mean in population standard deviations above the limit."""
    x = F.col(column).cast("double")
    moments = df.agg(
        F.struct(F.avg(x).alias("mean"), F.stddev_pop(x).alias("sigma")).alias("m")
    ).scalar()
    distance: Column = F.abs(x - moments["mean"])
    outside = (moments["sigma"] > 0) & (distance > threshold * moments["sigma"])
    return df.withColumn(flag, F.coalesce(outside, F.lit(False)))
