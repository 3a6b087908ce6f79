"""Raw sales lines from delimited files or from any table Spark can read."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallyhouse.functions.validation import passes_gate
from tallyhouse.schemas import RAW_COLUMNS
from tallyhouse.session import fit_shuffles

PROVENANCE = ["batch_id", "data_source", "created_at"]
#: Text of a line with more fields than its header names; NULL for all others.
RAW_LINE = "raw_line"
_UNREAD = "_unread"


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    delimiter: str = ",",
    encoding: str = "utf-8",
    multi_line: bool = False,
) -> DataFrame:
    """Every field as text, in file order; empty fields read as NULL.

    Columns are found by their names in the header. One that is absent is NULL
    throughout, so its lines fail the gate. Each path has a header of its own;
    the files of one folder share theirs, and a file that differs is an error,
    not lines read in the wrong order. `multi_line` allows line breaks in
    quoted fields, at the price that a file is no longer split between tasks.

    A line with more fields than the header names keeps its whole text in
    `raw_line`, and no load accepts it; what a line has too few of is NULL.
    """
    reader = as_text(spark.read, delimiter).option("encoding", encoding).option("multiLine", multi_line)
    # Paths of the same header are one scan.
    headers: dict[tuple, list[str]] = {}
    for one in [path] if isinstance(path, str) else path:
        headers.setdefault(tuple(reader.csv(one).columns), []).append(one)
    whole = None
    for names, paths in headers.items():
        found = with_raw_line(reader.schema(text_schema(list(names))).csv(paths), len(names), delimiter)
        fit_shuffles(found)
        columns = [F.col(RAW_LINE)] + [
            F.col(c) if c in names else F.lit(None).cast("string").alias(c)
            for c in [*RAW_COLUMNS, *PROVENANCE]
        ]
        part = found.select(columns)
        whole = part if whole is None else whole.unionByName(part)
    given = [c for c in PROVENANCE if any(c in names for names in headers)]
    return in_order(whole.select(*RAW_COLUMNS, RAW_LINE, *given))


def as_text(reader, delimiter: str = ","):
    """Options of a batch or stream reader for delimited text; a line it cannot fit keeps its text."""
    return (
        reader.option("header", True)
        .option("sep", delimiter)
        .option("escape", '"')
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _UNREAD)
    )


def text_schema(names: list[str]) -> StructType:
    """Text fields, and the place for a line that does not fit them."""
    return StructType([StructField(n, StringType()) for n in [*names, _UNREAD]])


def with_raw_line(found: DataFrame, fields: int, delimiter: str = ",") -> DataFrame:
    """`raw_line` for the lines with more than so many fields; delimiters in quotes part nothing."""
    bare = F.regexp_replace(_UNREAD, r'"([^"]|"")*"', "")
    parted = (F.length(bare) - F.length(F.replace(bare, F.lit(delimiter), F.lit("")))) / len(delimiter)
    return found.withColumn(RAW_LINE, F.when(parted + 1 > fields, F.col(_UNREAD))).drop(_UNREAD)


def from_table(df: DataFrame) -> DataFrame:
    """A table source: any frame with the eight columns, cast to text."""
    missing = [c for c in RAW_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"the source lacks the columns {missing}")
    return in_order(df.select([F.col(c).cast("string").alias(c) for c in RAW_COLUMNS]))


def in_order(raw: DataFrame) -> DataFrame:
    """Number the lines as the scan yields them, without a shuffle."""
    numbered = raw.withColumn("row_id", F.monotonically_increasing_id())
    return numbered.withColumns({"seq": F.lit(0).cast("bigint"), "pos": F.col("row_id")})


def stamp(
    raw: DataFrame, batch_id: str, loaded_at: str, data_source: str = "CSV"
) -> DataFrame:
    """Add provenance columns; a value the record already has stays."""
    values = {
        "batch_id": F.lit(batch_id),
        "data_source": F.lit(data_source),
        "created_at": F.lit(loaded_at).cast("timestamp_ntz"),
    }

    def kept(name: str, value: Column) -> Column:
        if name not in raw.columns:
            return value
        kind = "timestamp_ntz" if name == "created_at" else "string"
        return F.coalesce(F.col(name).try_cast(kind), value)

    return raw.withColumns({name: kept(name, value) for name, value in values.items()})


def gate(raw: DataFrame) -> DataFrame:
    """Mark each raw line as admitted or not."""
    return raw.withColumn("is_admitted", passes_gate())


def gate_counts(raw: DataFrame) -> DataFrame:
    """Lines read, admitted and turned away, in one pass."""
    admitted = passes_gate()
    return raw.agg(
        F.count(F.lit(1)).alias("records_read"),
        F.count_if(admitted).alias("records_valid"),
        F.count_if(~admitted).alias("records_invalid"),
    )
