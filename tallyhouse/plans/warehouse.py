"""The load job and the tables it leaves behind.

Each load writes folders of its own and becomes visible by one file in the log
of loads, put there last and only if its number is free. A load that dies
halfway leaves nothing a reader sees, a batch that is already in the log is not
loaded again, and of two loads at once the slower one builds anew on the other.

    <root>/loads/<number>.json             one file per finished load
    <root>/merges/<number>.json            the folders to read since a merge of loads, see plans/compaction
    <root>/feeds/<feed>/...                accepted keys of a feed, see operators/feed_state
    <root>/landed/load_id=...              every raw line as it came, numbered
    <root>/judged/load_id=.../verdict=...  every raw line with its verdict
    <root>/unresolved/load_id=...          accepted lines that found no keys
    <root>/fact_sales/load_id=...          accepted lines, by year
    <root>/dim_*/load_id=...               members the load added, products also those it changed
    <root>/day_*/load_id=...               totals and key sets of the load's days
    <root>/data_*/load_id=...              versions, lineage, quality rows of the load
    <root>/failed_runs                     lineage rows of loads that failed
"""

import json
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyhouse import schemas
from tallyhouse.functions.rules import CLEANING_RULES, validation_rules
from tallyhouse.operators import (
    analytics,
    catalog,
    day_counts,
    dimensions,
    fact,
    lineage,
    quality,
    snapshots,
    transform,
    trends,
    verdict,
)
from tallyhouse.operators.feed_state import FeedState
from tallyhouse.plans.commits import CommitLog
from tallyhouse.plans.compaction import Merges, remove_older
from tallyhouse.session import CODEC
from tallyhouse.sources.files import stamp
from tallyhouse.schemas import RAW_COLUMNS

ACCEPTED = "accepted"
UNRESOLVED = "unresolved_keys"

#: All that a load writes for readers, and the columns it is cut into folders by.
STORED = {
    "judged": schemas.JUDGED,
    "unresolved": schemas.JUDGED,
    "fact_sales": schemas.FACT_SALES,
    "dim_date": schemas.DIM_DATE,
    "dim_customer": schemas.DIM_CUSTOMER,
    "dim_product": schemas.DIM_PRODUCT,
    "day_totals": day_counts.TOTALS_SCHEMA,
    "day_keys": day_counts.KEYS_SCHEMA,
    "data_versions": schemas.DATA_VERSIONS,
    "data_lineage": schemas.DATA_LINEAGE,
    "data_quality_metrics": schemas.DATA_QUALITY_METRICS,
    "data_quality_alerts": schemas.DATA_QUALITY_ALERTS,
}
CUT_BY = {"judged": ["verdict"], "fact_sales": ["txn_year"]}


class Warehouse:
    """A star schema below one folder that all executors can reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.log = CommitLog(spark, f"{self.root}/loads")
        self.merges = Merges(spark, f"{self.root}/merges")

    # ---- reading

    def loads(self) -> DataFrame:
        return self.log.rows()

    def _folders(self, finished: list | None = None) -> list[str]:
        """Folders to read, oldest first: what merges have left, then one per load since."""
        merged = self.merges.last()
        if finished is None:  # after the merges, so that it knows every load they name
            finished = self.loads().orderBy("load_no").collect()
        return [*merged.folders, *(r.folder for r in finished if r.load_no > merged.upto)]

    def _all(self, table: str, schema, folders: list[str] | None = None, extra: tuple = ()) -> DataFrame:
        """One scan over the table's folders of all finished loads, however many they are."""
        folders = self._folders() if folders is None else folders
        if not folders:
            return self.spark.createDataFrame([], schema).withColumns({c: F.lit(None) for c in extra})
        found = self.spark.read.option("basePath", f"{self.root}/{table}").schema(schema)
        names = [c.split()[0] for c in schema.split(", ")] if isinstance(schema, str) else [f.name for f in schema]
        names += list(extra)
        return found.parquet(*[self._place(table, f) for f in folders]).select(names)

    def _place(self, table: str, folder: str) -> str:
        return f"{self.root}/{table}/load_id={folder}"

    def _products(self, folders: list[str]) -> DataFrame:
        """The last row written of each product; a load's id begins with its number."""
        rows = self._all("dim_product", schemas.DIM_PRODUCT, folders, extra=("load_id",))
        if len(folders) < 2:
            return rows.drop("load_id")
        fields = [f.name for f in schemas.DIM_PRODUCT]
        last = rows.groupBy("product_key").agg(F.max_by(F.struct(*fields), "load_id").alias("p"))
        return last.select([F.col(f"p.{n}").alias(n) for n in fields])

    def fact_sales(self) -> DataFrame:
        return self._all("fact_sales", schemas.FACT_SALES)

    def dim_date(self) -> DataFrame:
        return self._all("dim_date", schemas.DIM_DATE)

    def dim_customer(self) -> DataFrame:
        return self._all("dim_customer", schemas.DIM_CUSTOMER)

    def dim_product(self) -> DataFrame:
        return self._products(self._folders())

    def data_versions(self) -> DataFrame:
        return self._all("data_versions", schemas.DATA_VERSIONS)

    def data_lineage(self, folders: list[str] | None = None) -> DataFrame:
        """One row per run: those of finished loads, and those of loads that failed."""
        done = self._all("data_lineage", schemas.DATA_LINEAGE, folders)
        failed = f"{self.root}/failed_runs"
        if not self._exists(failed):
            return done
        return done.unionByName(self.spark.read.schema(schemas.DATA_LINEAGE).parquet(failed))

    def data_quality_metrics(self) -> DataFrame:
        return self._all("data_quality_metrics", schemas.DATA_QUALITY_METRICS)

    def data_quality_alerts(self) -> DataFrame:
        return self._all("data_quality_alerts", schemas.DATA_QUALITY_ALERTS)

    def fact_sales_archive(self) -> DataFrame:
        path = f"{self.root}/fact_sales_archive"
        if not self._exists(path):
            return self.spark.createDataFrame([], schemas.FACT_SALES_ARCHIVE)
        return self.spark.read.schema(schemas.FACT_SALES_ARCHIVE).parquet(path)

    def judged(self) -> DataFrame:
        """Every raw line of every load; `verdict` is a folder level."""
        return self._all("judged", schemas.JUDGED)

    def day_totals(self) -> DataFrame:
        """Totals by day and load."""
        return self._all("day_totals", day_counts.TOTALS_SCHEMA)

    def day_keys(self) -> DataFrame:
        """Sets of the keys sold, by day and load."""
        return self._all("day_keys", day_counts.KEYS_SCHEMA)

    def judged_by_load(self, folders: list[str] | None = None) -> DataFrame:
        """The same with the load's folder, whose name begins with the load's number; merged lines keep theirs."""
        rows = self._all("judged", schemas.JUDGED_MERGED, folders, extra=("load_id",))
        return rows.withColumn("load_id", F.coalesce("merged_from", "load_id")).drop("merged_from")

    def lines(self) -> DataFrame:
        """Accepted lines in conformed shape; reads one folder level only."""
        return conformed(self.judged())

    def quarantine(self) -> DataFrame:
        """Lines turned down by their verdict, and accepted ones that found no keys."""
        refused = self.judged().filter(F.col("verdict") != ACCEPTED)
        return verdict.rejected(refused.unionByName(self._all("unresolved", schemas.JUDGED)))

    def tables(self) -> dict[str, DataFrame]:
        folders = self._folders()
        stored = {
            "data_quality_alerts": schemas.DATA_QUALITY_ALERTS,
            "data_quality_metrics": schemas.DATA_QUALITY_METRICS,
            "data_versions": schemas.DATA_VERSIONS,
            "dim_customer": schemas.DIM_CUSTOMER,
            "dim_date": schemas.DIM_DATE,
            "fact_sales": schemas.FACT_SALES,
        }
        found = {n: self._all(n, schema, folders) for n, schema in stored.items()}
        found["dim_product"] = self._products(folders)
        found["data_lineage"] = self.data_lineage(folders)
        found["dim_transaction_type"] = transform.transaction_types(self.spark)
        found["fact_sales_archive"] = self.fact_sales_archive()
        return dict(sorted(found.items()))

    def storage(self) -> DataFrame:
        """Where each table lies, how it is cut into folders, how many files and bytes its readers see."""
        folders, rows = self._folders(), []
        for name in STORED:
            found = [self._content(self._place(name, f)) for f in folders]
            rows.append((name, f"{self.root}/{name}", CUT_BY.get(name, []), len(folders), sum(c[0] for c in found), sum(c[1] for c in found)))
        return self.spark.createDataFrame(
            rows, "table_name string, location string, partitioned_by array<string>, folders int, files bigint, bytes bigint"
        )

    def export_repository(self, path: str, checks: verdict.Checks, recent: int = 5) -> None:
        """Dictionary, sources, transformations, storage and latest runs as JSON lines, one document each."""
        rules = [*CLEANING_RULES, *validation_rules(checks.as_of)]
        catalog.repository(self.spark, self.tables(), self.data_lineage(), self.storage(), rules, recent).write.json(path)

    def archive(self, before: DataFrame, after: DataFrame, changed_at: str, changed_by: str) -> None:
        """Keep the old image of the sales rows that a correction updates or deletes."""
        changes = snapshots.change_archive(before, after, ["sales_key"])
        changes.select(
            "sales_key",
            "operation",
            F.col("version_id").cast("int").alias("version_id"),
            F.lit(changed_at).cast("timestamp_ntz").alias("changed_at"),
            F.lit(changed_by).alias("changed_by"),
            "payload",
        ).write.mode("append").parquet(f"{self.root}/fact_sales_archive")

    # ---- loading

    def load(
        self,
        raw: DataFrame,
        checks: verdict.Checks,
        batch_id: str,
        loaded_at: str,
        job_name: str = "sales_import",
        source: str = "CSV",
        source_file: str | None = None,
        hot_rows: int = verdict.HOT_ROWS,
        feed: str | None = None,
    ) -> dict[str, int]:
        """Run one load end to end and return its counts.

        The loads of one `feed` remember what they have accepted: a line repeated in
        a later load is a duplicate, and an invoice that goes on in a later load
        keeps its customer. Without a feed a load stands for itself.

        Every line read ends in one of them: records_read is gate_rejected, plus
        records_rejected, plus records_inserted. A load that fails leaves a
        lineage row that says why.
        """
        run = _Run(batch_id, loaded_at, job_name, source, source_file, _now(), feed)
        landed = None
        try:
            while True:
                done = self.loads()
                if not done.filter(F.col("batch_id") == batch_id).isEmpty():
                    return {}
                landed = self._land(raw, run) if landed is None else landed
                number, folder, counts = self._load(landed, checks, done, run, hot_rows)
                row = {"batch_id": batch_id, "folder": folder, "loaded_at": loaded_at, "feed": feed}
                if self.log.publish(number, row):
                    return counts
                # Another load has taken the number: its members and keys are known now.
        except Exception as error:
            row = run.lineage({}, _now(), "FAILED", str(error)[:2000], {})
            self.spark.createDataFrame([row], schemas.DATA_LINEAGE).coalesce(1).write.mode("append").parquet(
                f"{self.root}/failed_runs"
            )
            raise

    def _land(self, raw: DataFrame, run: "_Run") -> DataFrame:
        """The one pass over the source; the lines' numbers are fixed from here on."""
        landed = stamp(raw, run.batch_id, run.loaded_at, run.source)
        path = self._place("landed", uuid.uuid4().hex)
        landed.write.parquet(path, compression=CODEC)
        return self.spark.read.schema(landed.schema).parquet(path)

    def _load(self, landed: DataFrame, checks, done: DataFrame, run: "_Run", hot_rows: int) -> tuple[int, str, dict[str, int]]:
        """Number, folder and counts of a load on top of the finished ones; not visible yet."""
        finished = done.orderBy("load_no").collect()
        load_no = (finished[-1].load_no if finished else 0) + 1
        folder = f"{load_no:08d}-{uuid.uuid4().hex}"
        home = partial(self._place, folder=folder)
        earlier = self._folders(finished)
        state = prior = None
        if run.feed is not None:
            state = FeedState(self.spark, f"{self.root}/feeds/{run.feed}")
            prior = state.prior(landed, [r.folder for r in finished if r.feed == run.feed])

        seen = Observation()
        judged = verdict.judge(landed, checks, hot_rows, prior=prior).observe(seen, *_counts())
        judged.withColumn("verdict", F.coalesce("reject_reason", F.lit(ACCEPTED))).write.partitionBy(
            "verdict"
        ).parquet(home("judged"), compression=CODEC)
        judged = self.spark.read.schema(schemas.JUDGED).parquet(home("judged"))
        lines = conformed(judged)
        if state is not None:
            state.remember(judged, folder)

        self._write_dimensions(lines, home, run.loaded_at, run.source, load_no, earlier)
        known = [*earlier, folder]
        dates = self._all("dim_date", schemas.DIM_DATE, known)
        customers = self._all("dim_customer", schemas.DIM_CUSTOMER, known)
        products = self._products(known)
        written = Observation()
        # Stored, so that Spark knows how few rows they are.
        starts = fact.line_starts(landed)
        schema = starts.schema
        starts.write.parquet(home("line_starts"))
        starts = self.spark.read.schema(schema).parquet(home("line_starts"))
        resolved = fact.resolve_keys(fact.line_numbers(lines, starts), dates, customers, products)
        base = self._all("fact_sales", schemas.FACT_SALES, earlier).agg(F.max("sales_key")).first()[0] or 0
        fact.write(
            fact.build(
                resolved.observe(
                    written,
                    F.count_if(fact.is_resolved()).alias("inserted"),
                    F.count_if(~fact.is_resolved()).alias("unresolved"),
                ).filter(fact.is_resolved()),
                after=base,
                version_id=load_no,
            ),
            home("fact_sales"),
        )
        # An empty result has no observation.
        inserted, unresolved = (written.get.get(n, 0) for n in ("inserted", "unresolved"))
        self._write_unresolved(resolved, judged, home, unresolved)
        loaded = fact.read(self.spark, home("fact_sales"))

        results = metric_rows(quality.check(loaded, "fact_sales"), run.batch_id, run.loaded_at)
        _at_once(
            partial((results if inserted else results.limit(0)).write.parquet, home("data_quality_metrics")),
            partial(day_counts.day_totals(loaded).coalesce(1).write.parquet, home("day_totals")),
            partial(day_counts.day_keys(loaded).write.parquet, home("day_keys")),
        )
        totals = {"read": 0, "gate_rejected": 0, "cleaned": 0, "print": None} | seen.get
        counts = {
            "records_read": totals["read"],
            "gate_rejected": totals["gate_rejected"],
            "records_processed": totals["read"] - totals["gate_rejected"],
            "records_cleaned": totals["cleaned"],
            "records_inserted": inserted,
            "records_rejected": totals["read"] - totals["gate_rejected"] - totals["cleaned"] + unresolved,
            "records_unresolved": unresolved,
        }
        print_ = (
            self.spark.range(1)
            .select(lineage.set_print(F.lit(totals["read"]), F.lit(totals["print"])).alias("h"))
            .first()
        )
        self._write_records(home, counts, load_no, run, print_.h)
        return load_no, folder, counts

    def _write_unresolved(self, resolved: DataFrame, judged: DataFrame, home: Callable[[str], str], n: int) -> None:
        """Accepted lines without their keys, as they came, with a reason of their own."""
        lost = resolved.filter(~fact.is_resolved()).select("row_id") if n else None
        rows = judged.filter(F.col("verdict") == ACCEPTED)
        rows = rows.limit(0) if lost is None else rows.join(lost, "row_id", "left_semi")
        rows.withColumn("reject_reason", F.lit(UNRESOLVED)).select(
            [f.name for f in schemas.JUDGED]
        ).write.parquet(home("unresolved"))

    def _write_dimensions(
        self, lines: DataFrame, home: Callable[[str], str], loaded_at: str, source: str, load_no: int, earlier: list[str]
    ) -> None:
        """Members first, keys second; only new and changed members are written.

        Assigning keys reads the members more than once, so what the lines say
        about them is worked out and stored before. None of the three
        dimensions needs another, so they are written side by side.
        """
        members = {
            "dim_date": dimensions.date_dimension(lines),
            "dim_product": dimensions.product_attributes(lines),
            "dim_customer": dimensions.customer_attributes(lines),
        }
        _at_once(
            *[partial(df.write.parquet, home(f"{n}_members"), compression=CODEC) for n, df in members.items()]
        )
        found = {n: self.spark.read.parquet(home(f"{n}_members")) for n in members}
        frames = {
            "dim_date": dimensions.absent_dates(
                self._all("dim_date", schemas.DIM_DATE, earlier), found["dim_date"]
            ),
            "dim_product": dimensions.changed_products(
                self._products(earlier), found["dim_product"], loaded_at, source
            ),
            "dim_customer": dimensions.absent_customers(
                self._all("dim_customer", schemas.DIM_CUSTOMER, earlier), found["dim_customer"], loaded_at, source
            ),
        }
        # Products and current customers that have no version yet get this load's.
        at = F.lit(loaded_at).cast("timestamp_ntz")
        frames["dim_product"] = lineage.tag(frames["dim_product"], load_no, at)
        frames["dim_customer"] = lineage.tag(frames["dim_customer"], load_no, at, F.col("is_current"))
        _at_once(*[partial(df.write.parquet, home(n)) for n, df in frames.items()])

    def _write_records(
        self, home: Callable[[str], str], counts: dict[str, int], load_no: int, run: "_Run", file_hash: str
    ) -> None:
        """Alert, version and lineage rows of one load; a handful each."""
        spark, at = self.spark, _moment(run.loaded_at)
        scored = spark.read.schema(schemas.DATA_QUALITY_METRICS).parquet(
            home("data_quality_metrics")
        )
        total = quality.summary(scored)
        gate = quality.load_gate(total).first()
        # Loads within one second share the time, not the number.
        number = f"v{at:%Y%m%d_%H%M%S}"
        if not self.data_versions().filter(F.col("version_number") == number).isEmpty():
            number = f"{number}_{load_no}"
        version = (
            load_no, number, "INCREMENTAL", f"ETL load from {run.source_file or 'pipeline'}",
            run.source_file, file_hash, run.job_name, "ACTIVE", counts["records_inserted"], at,
        )
        facts = {"overall_score": gate.overall_score, "warning": gate.warning}
        facts |= {n: counts[n] for n in ("records_read", "gate_rejected", "records_unresolved")}
        history = self.data_quality_metrics().unionByName(scored)
        drops = trends.anomaly_alert(trends.anomalies(history, run.loaded_at[:10]))
        alerts = alert_rows(quality.score_alerts(total), run.loaded_at)
        frames = {
            "data_quality_alerts": alerts.unionByName(alert_rows(drops, run.loaded_at)),
            "data_versions": spark.createDataFrame([version], schemas.DATA_VERSIONS),
            "data_lineage": spark.createDataFrame(
                [run.lineage(counts, _now(), "SUCCESS", None, facts)], schemas.DATA_LINEAGE
            ),
        }
        _at_once(
            *[partial(df.coalesce(1).write.parquet, home(n)) for n, df in frames.items()]
        )

    def summarise(self, as_of: str, path: str) -> None:
        """Store the business summaries for a day; readers then skip the fact table.

        A day stored before is replaced, other days stay.
        """
        facts = self.fact_sales()
        stored = {
            "sales_summary": analytics.sales_summary(facts, as_of),
            "top_products": analytics.top_products(facts, self.dim_product(), as_of),
            "customer_stats": analytics.customer_stats(facts, self.dim_customer(), as_of),
        }
        for name, df in stored.items():
            df.withColumn("as_of", F.lit(as_of).cast("date")).write.partitionBy("as_of").mode(
                "overwrite"
            ).option("partitionOverwriteMode", "dynamic").parquet(f"{path}/{name}")

    # ---- upkeep

    def compact(self, whole: bool = False) -> list[str]:
        """Merge the folders of the newest loads into one; returns the folders merged, none if nothing is worth it.

        Merged is what is not larger than all newer folders together, so every folder that stays is larger than the
        rest behind it: their number grows with the logarithm of the bytes, and a row is written anew about as often.
        Readers and loads that run meanwhile keep the old folders. `whole` merges everything.
        """
        before = self.merges.last()
        finished = self.loads().orderBy("load_no").collect()
        folders = self._folders(finished)
        taken = folders if whole else folders[_tail(self._bytes(folders)) :]
        if len(taken) < 2:
            return []
        upto = finished[-1].load_no
        folder = f"{upto:08d}-{uuid.uuid4().hex}"
        tables = self._folder_tables(taken)
        _at_once(*[partial(self._merge, df, CUT_BY.get(n, []), self._place(n, folder)) for n, df in tables.items()])
        kept = folders[: len(folders) - len(taken)]
        if not self.merges.publish(before, upto, [*kept, folder], _now()):
            return []  # another merge was first; what this one wrote is never read
        return taken

    def _folder_tables(self, folders: list[str]) -> dict[str, DataFrame]:
        """All that a load writes for readers."""
        found = {n: self._all(n, schema, folders) for n, schema in STORED.items()}
        found["dim_product"] = self._products(folders)
        found["judged"] = self.judged_by_load(folders).withColumnRenamed("load_id", "merged_from")
        return found

    def _merge(self, df: DataFrame, by: list[str], path: str) -> None:
        """One file per scan task, so neither shuffled nor sorted: Spark's scans pack small files and cut large ones.

        A year or verdict at a time, each into the folder `partitionBy` would give it.
        """
        values = [r[0] for r in df.select(by).distinct().collect()] if by else []  # at most one per folder
        if not values:
            df.write.partitionBy(*by).parquet(path)
        for value in values:
            (name,) = by
            folder = f"{name}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}"
            df.filter(F.col(name).eqNullSafe(F.lit(value))).drop(name).write.parquet(f"{path}/{folder}", compression=CODEC)

    def _bytes(self, folders: list[str]) -> list[int]:
        """Bytes of each folder's lines and sales."""
        return [sum(self._content(self._place(t, f))[1] for t in ("judged", "fact_sales")) for f in folders]

    def _content(self, path: str) -> tuple[int, int]:
        """Files and bytes below a path, without their checksums."""
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        found = place.getFileSystem(self.spark._jsc.hadoopConfiguration()).getContentSummary(place)
        return found.getFileCount(), found.getLength()

    def remove_unread(self, before: datetime) -> list[str]:
        """Delete folders that no reader has seen since `before` (UTC); returns them.

        These are folders merged away, what a load needs only while it runs, and what lost or failed loads and
        merges have left. `before` must lie further back than any load or query that still runs. The logs stay: a
        number that is taken must never become free.
        """
        finished = self.loads().orderBy("load_no").collect()
        read = set()
        for state in self.merges.since(before):
            read |= {*state.folders, *(r.folder for r in finished if r.load_no > state.upto)}
        passing = ("landed", "line_starts", "dim_date_members", "dim_product_members", "dim_customer_members")
        gone = []
        for table in (*passing, *STORED):
            keep = set() if table in passing else {f"load_id={f}" for f in read}
            gone += remove_older(self.spark, f"{self.root}/{table}", keep, before)
        return gone

    def _exists(self, path: str) -> bool:
        jvm = self.spark._jvm
        hadoop = jvm.org.apache.hadoop.fs.Path(path)
        return hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(hadoop)


@dataclass(frozen=True)
class _Run:
    """What a lineage row says about a load besides its counts."""

    batch_id: str
    loaded_at: str
    job_name: str
    source: str
    source_file: str | None
    started: datetime
    feed: str | None = None

    def lineage(self, counts: dict, ended: datetime, status: str, error: str | None, facts: dict) -> tuple:
        return (
            uuid.uuid4().hex, self.source, "raw_sales", self.source_file, "fact_sales", self.job_name, self.batch_id,
            counts.get("records_processed", 0), counts.get("records_inserted", 0), 0, counts.get("records_rejected", 0),
            self.started, ended, int((ended - self.started).total_seconds()), status, error,
            json.dumps(facts), _moment(self.loaded_at),
        )


def _counts() -> list:
    """What is counted while the judged lines are written; the print covers every line of the source."""
    reason = F.col("reject_reason")
    return [
        F.count(F.lit(1)).alias("read"),
        F.count_if(reason == verdict.GATE).alias("gate_rejected"),
        F.count_if(reason.isNull()).alias("cleaned"),
        F.sum(lineage.row_print(RAW_COLUMNS)).cast("decimal(38,0)").alias("print"),
    ]


def conformed(judged: DataFrame) -> DataFrame:
    if "verdict" in judged.columns:
        judged = judged.filter(F.col("verdict") == ACCEPTED).drop("verdict")
    return transform.conform(verdict.accepted(judged))


def metric_rows(results: DataFrame, batch_id: str, measured_at: str) -> DataFrame:
    """Quality results in the shape of the metrics table."""
    details = F.to_json(F.struct("hits", "rows_checked", "metric_type"))
    values = {
        "metric_id": F.md5(F.concat_ws("|", F.lit(batch_id), "table_name", "metric_name")),
        "batch_id": F.lit(batch_id),
        "measured_at": F.lit(measured_at),
        "details": details,
    }
    return results.select(
        [
            values.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name)
            for f in schemas.DATA_QUALITY_METRICS
        ]
    )


def alert_rows(alerts: DataFrame, at: str) -> DataFrame:
    return alerts.select(
        F.lit(at).cast("timestamp_ntz").alias("alert_time"),
        "severity",
        "message",
        F.to_json(F.struct([c for c in alerts.columns if c not in ("severity", "message")])).alias(
            "metadata"
        ),
    )


def check_table(warehouse: Warehouse, table: str, as_of: str) -> dict[str, DataFrame]:
    """Quality check of a stored table: results, summary, alerts, anomalies."""
    results = quality.check(warehouse.tables()[table], table)
    total = quality.summary(results)
    drops = trends.anomalies(warehouse.data_quality_metrics(), as_of)
    return {
        "results": results,
        "summary": total,
        "alerts": quality.score_alerts(total, table),
        "anomalies": drops,
    }


def _tail(sizes: list[int]) -> int:
    """Where the newest folders begin of which none is larger than all newer ones together."""
    start, total = len(sizes) - 1, sizes[-1] if sizes else 0
    while start > 0 and sizes[start - 1] <= total:
        start -= 1
        total += sizes[start]
    return max(start, 0)


def _at_once(*jobs: Callable) -> list:
    """Run independent Spark jobs side by side and wait for all of them."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        return [running.result() for running in [pool.submit(job) for job in jobs]]


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def _moment(text: str) -> datetime:
    return datetime.fromisoformat(text)
