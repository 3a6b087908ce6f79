"""What a feed has accepted so far: line keys and customers that outlive a load.

A feed's files come day by day, and an invoice may go on in the next one. Each
load leaves one row per accepted line, (invoice, stock code, customer), in
buckets by a hash of the invoice, and one Bloom filter per bucket. The next
load asks the filters which buckets may hold any of its invoices and reads
only those; a filter errs by naming a bucket too many, never one too few.

    <root>/line_keys/load_id=.../bucket=...    accepted keys, by bucket
    <root>/line_filters/load_id=...            bits of the filters

An accepted line's customer is its own or the one filled in, so that of an
invoice's last accepted line is what its next line would be given.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions import cleaning
from tallyhouse.session import CODEC

BUCKETS = 64
#: Bits of one bucket's filter, in pieces of the size Spark's bitmaps have, and positions set per invoice.
PIECE_BITS = 32_768
PIECES = 8
HASHES = 4

KEYS = "invoice string, stock_code string, customer_id string, pos bigint, row_id bigint"
_FILTERS = "bucket int, piece int, bits binary"


def bucket_of(invoice: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(invoice), F.lit(buckets)).cast("int")


def _positions(invoices: DataFrame, buckets: int) -> DataFrame:
    """bucket, invoice, piece and bit of every position of each invoice, and how many positions it has."""
    places = F.array(*[F.pmod(F.xxhash64("invoice", F.lit(k)), F.lit(PIECES * PIECE_BITS)) for k in range(HASHES)])
    return (
        invoices.select("invoice", bucket_of(F.col("invoice"), buckets).alias("bucket"), F.array_distinct(places).alias("places"))
        .select("invoice", "bucket", F.size("places").alias("wanted"), F.explode("places").alias("at"))
        .select("invoice", "bucket", "wanted", F.expr(f"at div {PIECE_BITS}").cast("int").alias("piece"), (F.col("at") % PIECE_BITS).alias("bit"))
    )


def _is_set() -> Column:
    byte = F.conv(F.hex(F.substring(F.col("bits"), (F.col("bit") / 8).cast("int") + 1, F.lit(1))), 16, 10)
    return F.getbit(byte.cast("int"), (F.col("bit") % 8).cast("int")) == 1


class FeedState:
    """The state of one feed below a folder all executors reach."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets

    def remember(self, judged: DataFrame, load_id: str) -> None:
        """Store the keys a load has accepted, and their filters; seen once `load_id` is asked for."""
        accepted = judged.filter(F.col("reject_reason").isNull())
        keys = f"{self.root}/line_keys/load_id={load_id}"
        (
            accepted.select("invoice", "stock_code", "customer_id", "pos", "row_id")
            .withColumn("bucket", bucket_of(F.col("invoice"), self.buckets))
            .repartition("bucket", F.pmod("row_id", F.lit(16)))  # a large invoice's lines are written by several tasks
            .write.partitionBy("bucket")
            .parquet(keys, compression=CODEC)
        )
        stored = self.spark.read.schema(KEYS).parquet(keys)
        bits = (
            _positions(stored.select("invoice").distinct(), self.buckets)
            .groupBy("bucket", "piece")
            .agg(F.bitmap_construct_agg("bit").alias("bits"))
        )
        bits.write.parquet(f"{self.root}/line_filters/load_id={load_id}")

    def hit_buckets(self, invoices: DataFrame, load_ids: list[str]) -> list[tuple[str, int]]:
        """(load, bucket) pairs that may hold one of the invoices; at most one per load and bucket."""
        if not load_ids:
            return []
        filters = (
            self.spark.read.option("basePath", f"{self.root}/line_filters")
            .schema(_FILTERS + ", load_id string")
            .parquet(*[f"{self.root}/line_filters/load_id={i}" for i in load_ids])
        )
        found = (
            _positions(invoices, self.buckets).join(filters, ["bucket", "piece"]).filter(_is_set())
            .groupBy("load_id", "bucket", "invoice").agg(F.count("*").alias("found"), F.max("wanted").alias("wanted"))
        )
        hits = found.filter("found >= wanted").select("load_id", "bucket").distinct()
        return sorted((r.load_id, r.bucket) for r in hits.collect())

    def prior(self, raw: DataFrame, load_ids: list[str]) -> DataFrame | None:
        """invoice, stock_code and customer_id of what matters to these lines; None if no bucket is hit.

        A row per key that is accepted already, and one without stock code per invoice that is known; both have
        the customer the invoice's next line would be given. `load_ids`: finished loads, in their order.
        """
        invoice = cleaning.clean_invoice_no(F.col("InvoiceNo")).alias("invoice")
        # From their own column: by way of the pairs every line would be shuffled.
        invoices = raw.select(invoice).filter("invoice <> ''").distinct()
        lines = raw.select(invoice, cleaning.clean_stock_code(F.col("StockCode")).alias("stock_code")).filter("invoice <> ''").distinct()
        hits = self.hit_buckets(invoices, load_ids)
        if not hits:
            return None
        known = (
            self.spark.read.option("basePath", f"{self.root}/line_keys")
            .schema(KEYS + ", load_id string")
            .parquet(*[f"{self.root}/line_keys/load_id={i}/bucket={b}" for i, b in hits])
        ).join(invoices, "invoice", "left_semi")
        # A load's id begins with its number.
        last = known.groupBy("invoice").agg(F.max_by("customer_id", F.struct("load_id", "pos", "row_id")).alias("customer_id"))
        again = known.select("invoice", "stock_code").join(lines, ["invoice", "stock_code"], "left_semi").distinct()
        return again.unionByName(last.select("invoice", F.lit("").alias("stock_code"))).join(last, "invoice")
