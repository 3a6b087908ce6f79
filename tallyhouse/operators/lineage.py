"""Runs, versions and change history, kept as ordinary tables."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def recent_runs(lineage: DataFrame, limit: int = 10) -> DataFrame:
    return (
        lineage.orderBy(F.desc("start_time"), "batch_id")
        .limit(limit)
        .select(
            "batch_id",
            "source_file",
            "target_table",
            "etl_job_name",
            "records_processed",
            "records_inserted",
            "start_time",
            "end_time",
            "status",
        )
    )


def runs_of_batch(lineage: DataFrame, batch_id: str) -> DataFrame:
    return lineage.filter(F.col("batch_id") == batch_id).select(
        "source_system",
        "source_file",
        "target_table",
        "records_processed",
        "records_inserted",
        "records_updated",
        "start_time",
        "end_time",
        "duration_seconds",
        "status",
        "error_message",
    )


def row_text(columns: list[str]) -> Column:
    """A row as text. Each field stands behind its length, so no two rows read alike."""
    fields = [
        F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))
        for text in (F.col(c).cast("string") for c in columns)
    ]
    return F.concat_ws("|", *fields)


def row_print(columns: list[str]) -> Column:
    """A number for a row."""
    return F.conv(F.substring(F.md5(row_text(columns)), 1, 12), 16, 10).cast("decimal(20,0)")


def set_print(rows: Column, total: Column) -> Column:
    """First sixteen hex digits for a number of rows and the sum of their numbers."""
    total = F.coalesce(total.cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)"))
    return F.left(F.md5(F.concat_ws(":", rows.cast("string"), total.cast("string"))), F.lit(16))


def fingerprint(df: DataFrame, columns: list[str]) -> Column:
    """Sixteen hex digits that identify a set of rows in any order.

    Rows are hashed one by one and the hashes added up, so no task ever holds
    more than a running sum.
    """
    return df.agg(set_print(F.count(F.lit(1)), F.sum(row_print(columns))).alias("h")).scalar()


def version_number(at: Column) -> Column:
    """vYYYYMMDD_HHMMSS for a timestamp without time zone."""
    text = F.substring(at.cast("string"), 1, 19)
    return F.concat(F.lit("v"), F.replace(F.regexp_replace(text, "[-:]", ""), F.lit(" "), F.lit("_")))


def tag(df: DataFrame, version_id: int | Column, at: Column, only: Column | None = None) -> DataFrame:
    """Give untagged rows a version; rows that have one, or fail `only`, stay."""
    version = version_id if isinstance(version_id, Column) else F.lit(version_id)
    untagged = F.col("version_id").isNull()
    if only is not None:
        untagged = untagged & only
    return df.withColumns(
        {
            "version_created_at": F.when(untagged, at).otherwise(F.col("version_created_at")),
            "version_id": F.when(untagged, version).otherwise(F.col("version_id")),
        }
    )


def rows_per_version(fact: DataFrame) -> DataFrame:
    return fact.groupBy("version_id").agg(F.count(F.lit(1)).alias("records_count"))


def versions_list(versions: DataFrame, limit: int = 10) -> DataFrame:
    return (
        versions.orderBy(F.desc("created_at"), F.desc("version_number"))
        .limit(limit)
        .select(
            "version_number",
            F.coalesce("records_count", F.lit(0)).alias("records_count"),
            "status",
            "created_at",
        )
    )


def version_show(versions: DataFrame, number: str) -> DataFrame:
    return versions.filter(F.col("version_number") == number)


def load_metrics(extracted: Column, loaded: Column, seconds: Column | None = None) -> dict[str, Column]:
    """Share of the read lines that arrived, and lines per second."""
    rate = F.coalesce(F.try_divide(loaded * 100.0, extracted), F.lit(0.0))
    found = {"success_rate": rate}
    if seconds is not None:
        found["records_per_second"] = F.coalesce(F.try_divide(extracted, seconds), F.lit(0.0))
    return found
