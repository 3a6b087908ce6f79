"""Session settings and the shared work folder."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

WORK_DIR_KEY = "spark.checkpoint.dir"
#: Bytes of input files per shuffle partition at most: some 300,000 narrow lines of Parquet, sorted in memory at full width.
SHUFFLE_BYTES = 4 * 1024 * 1024
#: Codec of what is stored line by line, mostly text: a third less than Spark's own leaves.
CODEC = "zstd"
#: Files that a task of a partitioned write has open at once: more than there are verdicts, or years in most loads.
OPEN_FILES = 32


def tune(spark: SparkSession) -> SparkSession:
    """Runtime settings the jobs rely on; all are per-session SQL settings."""
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # Split a skewed join even where the split costs one more exchange.
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    # The JVM never compiles a method of more than 8000 bytes. Long cleaning
    # expressions in one fused method would run interpreted; beyond this size
    # Spark leaves the operators apart and splits their code into small methods.
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    # Rows go to a file for each year or verdict as they come; else every task sorts all it writes, at full width, by a
    # handful of values. A task that meets more values sorts what is left.
    spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", str(OPEN_FILES))
    # Merged partitions stay small enough to be sorted twice in memory: some 260,000 raw lines at full width.
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "32m")
    return spark


def fit_shuffles(scan: DataFrame) -> int:
    """Start shuffles with enough partitions for the input; returns its tasks.

    Scan tasks grow with the input up to Spark's limit of bytes, and packed
    columns are many times larger as rows; so the files' bytes are the measure.
    Adaptive execution only ever merges partitions, so it has to start from
    many; small inputs keep the configured number.
    """
    spark = scan.sparkSession
    tasks = scan.rdd.getNumPartitions()
    configured = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(configured, 2 * tasks, _file_bytes(scan) // SHUFFLE_BYTES)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(wanted))
    return tasks


def _file_bytes(scan: DataFrame) -> int:
    """Bytes of the files a frame reads; 0 for one that reads none."""
    spark, total = scan.sparkSession, 0
    for name in scan.inputFiles():
        place = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(name))
        total += place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).getLen()
    return total


def spread(scan: DataFrame, key: str) -> DataFrame:
    """Use all cores for a scan too small to fill them; leave any other as it is.

    The test of size is the number of tasks the scan gets, so whatever is
    shuffled here is less than one task per core.
    """
    if scan.isStreaming:
        return scan
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores, key) if fit_shuffles(scan) < cores else scan


def work_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    A private temporary folder is used only where the setting is absent and the
    session is local, as in tests.
    """
    shared = spark.conf.get(WORK_DIR_KEY, None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {WORK_DIR_KEY} to a folder all executors share")
    private = tempfile.mkdtemp(prefix="tallyhouse-")
    spark.conf.set(WORK_DIR_KEY, private)
    return private


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the work folder; never reused, so never overwritten."""
    return f"{work_dir(spark)}/tallyhouse/{label}-{uuid.uuid4().hex}"
