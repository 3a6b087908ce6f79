"""Streaming duplicates where no line gets lost: late, undated and repeated lines are rows as well.

Each batch carries its own watermark: the latest event time of all batches
before it, less the delay. A line at or behind it is late. A timely line is
kept if no kept line has its key, or that line's time plus the delay is not
past the watermark; among lines of one batch the least by order is kept.

    <folder>/landed/batch=...             the batch's lines, numbered
    <folder>/lines/batch=.../outcome=...  every line once: kept, duplicate, late or undated
    <folder>/keys/batch=...               keys the batch has kept, and until when they count
    <folder>/clock/batch=...              the batch's latest event time; put last

A batch reads only what earlier batches have left and writes folders of its
own, so a repeated batch replaces itself. Keys are read from batches that may
still count, so the state a batch meets is bounded by the delay.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tallyhouse.functions.text import pack, unpack
from tallyhouse.session import CODEC

_CLOCK = "batch bigint, latest timestamp_ntz, keys_until timestamp_ntz"


class LateLedger:
    """What a stream has kept so far, below a folder that all executors can reach."""

    def __init__(
        self, folder: str, delay: str, key: Sequence[str], order: Sequence[str], event: str = "transaction_datetime"
    ):
        self.folder, self.key, self.order, self.event = folder.rstrip("/"), list(key), list(order), event
        self.delay = F.expr(f"INTERVAL {delay}")

    def run(self, lines: DataFrame) -> None:
        """Place all that waits, then stop."""
        query = (
            lines.writeStream.foreachBatch(self.place)
            .option("checkpointLocation", f"{self.folder}/progress")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()

    def lines(self, spark: SparkSession, schema) -> DataFrame:
        """Every line of every finished batch with its `batch` and `outcome`."""
        done = [r.batch for r in self._clock(spark).collect()]
        found = spark.read.schema(f"{_ddl(schema)}, batch bigint, outcome string")
        if not done:
            return spark.createDataFrame([], f"{_ddl(schema)}, batch bigint, outcome string")
        return found.option("basePath", f"{self.folder}/lines").parquet(*[self._at("lines", n) for n in done])

    def place(self, batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        fields = batch.schema
        batch.withColumn("_row", F.monotonically_increasing_id()).write.mode("overwrite").parquet(
            self._at("landed", number), compression=CODEC
        )
        rows = spark.read.schema(f"{_ddl(fields)}, _row bigint").parquet(self._at("landed", number))
        before = self._clock(spark).filter(F.col("batch") < number)
        watermark = before.agg((F.max("latest") - self.delay).alias("w")).first().w
        mark = F.lit(watermark).cast("timestamp_ntz")
        late = F.coalesce(F.col(self.event) <= mark, F.lit(False))

        # Combined before the shuffle, and joined back by line, so a key with many lines is never gathered.
        first = (
            rows.filter(F.col(self.event).isNotNull() & ~late)
            .groupBy(*self.key)
            .agg(F.min(F.struct(*self.order, "_row", F.col(self.event).alias("_at"))).alias("f"))
            .select(*self.key, "f._row", (F.col("f._at") + self.delay).alias("until"))
        )
        # Without a watermark no line before had a time, so none was kept.
        alive = [r.batch for r in before.filter(F.col("keys_until") > mark).collect()]
        if alive:
            known = (
                spark.read.parquet(*[self._at("keys", n) for n in alive])
                .filter(F.col("until") > mark)
                .select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(self.key)])
            )
            same = [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(self.key)]
            first = first.join(known, same, "left_anti")
        first.write.mode("overwrite").parquet(self._at("keys", number), compression=CODEC)
        kept = spark.read.schema(first.schema).parquet(self._at("keys", number))

        outcome = (
            F.when(F.col(self.event).isNull(), "undated")
            .when(late, "late")
            .when(F.col("_kept"), "kept")
            .otherwise("duplicate")
        )
        texts = [f.name for f in fields if isinstance(f.dataType, StringType)]
        others = [n for n in fields.names if n not in texts]
        # Whole lines cross the network here, with their texts packed.
        whole = rows.select("_row", *others, pack(texts).alias("_texts")) if texts else rows
        whole = whole.join(kept.select("_row", F.lit(True).alias("_kept")), "_row", "left")
        whole = whole.withColumns(unpack("_texts", texts)) if texts else whole
        whole.select(*fields.names, outcome.alias("outcome")).write.mode("overwrite").partitionBy("outcome").parquet(
            self._at("lines", number), compression=CODEC
        )
        ends = rows.agg(F.max(self.event).cast("timestamp_ntz").alias("latest")).join(
            kept.agg(F.max("until").cast("timestamp_ntz").alias("keys_until"))
        )
        ends.select(F.lit(number).cast("bigint").alias("batch"), "*").write.mode("overwrite").parquet(
            self._at("clock", number), compression=CODEC
        )

    def _clock(self, spark: SparkSession) -> DataFrame:
        """One row per finished batch."""
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/clock")
        if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
            return spark.createDataFrame([], _CLOCK)
        return spark.read.schema(_CLOCK).option("recursiveFileLookup", True).parquet(f"{self.folder}/clock")

    def _at(self, part: str, number: int) -> str:
        return f"{self.folder}/{part}/batch={number}"


def _ddl(schema) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
