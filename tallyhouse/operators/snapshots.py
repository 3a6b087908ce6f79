"""Two states of a table, compared by hashes before any row travels.

Rows fall into buckets by a hash of their key, and each bucket into leaves. A
digest is the number of rows of a leaf and the sums of two 64-bit hashes of
them; a bucket's digest is the sum of its leaves'. Stored snapshots lie in
folders by bucket beside their digests, so only folders of buckets that differ
are read, and only rows of leaves that differ are joined at full width.

Digests are bounded by buckets * LEAVES rows, whatever the table holds. A key
stands once in a snapshot. A row without a key cannot be found again in the
other state and takes no part.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.functions.text import pack, unpack
from tallyhouse.session import CODEC

#: Folders of a stored snapshot unless the writer says otherwise; snapshots to be compared have the same number.
BUCKETS = 256
LEAVES = 256

_SPOTS = ["_bucket", "_leaf"]
_SUMS = ["_rows", "_low", "_high"]


def spots(key: list[str], buckets: int = BUCKETS) -> dict[str, Column]:
    """Bucket and leaf of a row by its key."""
    spot = F.pmod(F.xxhash64(*key), F.lit(buckets * LEAVES))
    return {
        "_bucket": F.floor(spot / LEAVES).cast("int"),
        "_leaf": (spot % LEAVES).cast("int"),
    }


def digests(rows: DataFrame, values: list[str]) -> DataFrame:
    """Rows and hash sums by bucket and leaf; `rows` has both spots. Combined before the shuffle."""
    # A hash passes over NULL, so each field is told apart by whether it holds one.
    fields = [c for name in values for c in (F.col(name), F.col(name).isNull())]
    hashed = [F.xxhash64(F.lit(number), *fields).cast("decimal(20,0)") for number in (1, 2)]
    return rows.groupBy(*_SPOTS).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.sum(hashed[0]).cast("decimal(38,0)").alias("_low"),
        F.sum(hashed[1]).cast("decimal(38,0)").alias("_high"),
    )


def write(rows: DataFrame, key: list[str], path: str, buckets: int = BUCKETS) -> None:
    """Store a snapshot by bucket, and its digests beside it; the rebalance hint sizes tasks and files."""
    texts, others = _texts(rows, rows.columns)
    sent = rows.dropna(subset=key).select(*others, pack(texts).alias("_texts"), *[c.alias(n) for n, c in spots(key, buckets).items()])
    whole = unpack("_texts", texts)
    back = sent.hint("rebalance", "_bucket").select([whole.get(c, F.col(c)).alias(c) for c in [*rows.columns, "_bucket", "_leaf"]])
    back.write.partitionBy("_bucket").parquet(f"{path}/rows", compression=CODEC)
    stored = read(rows.sparkSession, path, rows.schema)
    digests(stored, sorted(rows.columns)).coalesce(1).write.parquet(f"{path}/digests")


def _texts(rows: DataFrame, columns: list[str]) -> tuple[list[str], list[str]]:
    """The texts among the columns, which cross the network packed, and the others."""
    texts = [f.name for f in rows.schema if f.name in columns and isinstance(f.dataType, T.StringType)]
    return texts, [c for c in columns if c not in texts]


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stored snapshot with the spots of its rows."""
    spots_at = [T.StructField("_leaf", T.IntegerType()), T.StructField("_bucket", T.IntegerType())]
    return spark.read.schema(T.StructType([*schema, *spots_at])).parquet(f"{path}/rows")


def changed_leaves(before: DataFrame, after: DataFrame) -> DataFrame:
    """Spots whose digests differ; at most buckets * LEAVES rows."""
    old = before.select(*_SPOTS, F.struct(*_SUMS).alias("_old"))
    new = after.select(*_SPOTS, F.struct(*_SUMS).alias("_new"))
    return old.join(new, _SPOTS, "full").filter(~F.col("_old").eqNullSafe(F.col("_new"))).select(*_SPOTS)


def changes(before: DataFrame, after: DataFrame, key: list[str], leaves: DataFrame) -> DataFrame:
    """The old image of every row that was updated or deleted, of rows with spots.

    `leaves` has a proven bound, so it goes to every task; the full-width join
    sees only rows it names.
    """
    values = [c for c in before.columns if c not in key and c not in _SPOTS]
    texts, others = _texts(before, values)
    near = F.broadcast(leaves)
    old = before.join(near, _SPOTS, "left_semi").select(
        *key, F.struct(*others).alias("_old"), pack(texts).alias("_old_texts"), "version_id"
    )
    new = after.join(near, _SPOTS, "left_semi").select(
        *key,
        F.struct(*others).alias("_new"),
        pack(texts).alias("_new_texts"),
        F.col("version_id").alias("_nv"),
        F.lit(True).alias("_kept"),
    )
    gone = F.col("_kept").isNull()
    same = F.col("_old").eqNullSafe(F.col("_new")) & (F.col("_old_texts") == F.col("_new_texts"))
    whole = unpack("_old_texts", texts)
    return (
        old.join(new, key, "left")
        .filter(gone | ~same)
        .select(
            *key,
            F.when(gone, "DELETE").otherwise("UPDATE").alias("operation"),
            F.coalesce("_nv", "version_id").alias("version_id"),
            F.to_json(F.struct(*key, *[whole.get(c, F.col(f"_old.{c}")).alias(c) for c in values])).alias("payload"),
        )
    )


def change_archive(before: DataFrame, after: DataFrame, key: list[str]) -> DataFrame:
    """Old images between two frames: both are read twice, only rows of differing leaves are shuffled."""
    columns = sorted(before.columns)
    old, new = (df.select(columns).dropna(subset=key).withColumns(spots(key)) for df in (before, after))
    return changes(old, new, key, changed_leaves(digests(old, columns), digests(new, columns)))


def stored_changes(spark: SparkSession, before: str, after: str, schema, key: list[str]) -> DataFrame:
    """Old images between two stored snapshots; folders of equal buckets are not read.

    The driver gets the numbers of the differing buckets, at most as many as there are folders.
    """
    sums = [spark.read.parquet(f"{path}/digests") for path in (before, after)]
    leaves = changed_leaves(*sums)
    buckets = [r[0] for r in leaves.select("_bucket").distinct().collect()]
    sides = [read(spark, path, schema).filter(F.col("_bucket").isin(buckets)) for path in (before, after)]
    return changes(*sides, key, leaves)
