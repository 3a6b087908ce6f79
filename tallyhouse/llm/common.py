"""Helpers the operators share: stored steps, id ranges and word hashes."""

from __future__ import annotations

import tempfile
import zipfile
from dataclasses import dataclass
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.session import new_folder

#: An id that is missing sorts before all others.
NO_ID = -(2**63)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python, once per application; they need not have it installed."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="run-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the shared work folder: no lineage, and a size Spark knows."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@dataclass(frozen=True)
class Cuts:
    """Upper ends of ranges of rows, ordered by doc_id, rows of one id downwards by their text's hash.

    A range ends with all rows of an id. An id that fills ranges by itself ends several, each with a hash of its own.
    """

    ids: np.ndarray
    hashes: np.ndarray
    split: frozenset[int]

    def __len__(self) -> int:
        return len(self.ids)


def id_cuts(docs: DataFrame, buckets: int) -> Cuts:
    """Cuts for at most `buckets` ranges of about equal counts; the last is the largest id.

    Reads the id column; texts only of ids that fill ranges by themselves, such as the missing one. Copies of one text
    under one id stay together. The driver gets one cut per range, as Spark's own range partitioning does.
    """
    ids = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"))
    at = [i / buckets for i in range(1, buckets)]
    row = ids.agg(
        F.percentile_approx("doc_id", at or [0.5], F.lit(10_000)).alias("cuts"), F.max("doc_id").alias("last")
    ).first()
    if row is None or row["last"] is None:
        return Cuts(np.array([NO_ID], dtype=np.int64), np.zeros(1, np.int64), frozenset())
    found, n = np.unique(np.array([*(row["cuts"] or []), row["last"]], dtype=np.int64), return_counts=True)
    split = {int(i): int(k) for i, k in zip(found, n, strict=True) if k > 1}
    cuts = [(int(i), 0) for i in found if int(i) not in split]
    if split:
        # The least hash of each of an id's parts is there, so that a row is known to be its part's upper end.
        hashed = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), F.xxhash64("text").alias("hash"))
        parts = hashed.join(F.broadcast(docs.sparkSession.createDataFrame(list(split.items()), "doc_id long, parts int")), "doc_id")
        part = F.floor((F.col("hash") / F.lit(2.0**64) + F.lit(0.5)) * F.col("parts"))
        ends = parts.groupBy("doc_id", part.alias("part")).agg(F.min("hash").alias("hash"))
        cuts += [(r.doc_id, r.hash) for r in ends.select("doc_id", "hash").collect()]
    cuts.sort(key=lambda c: (c[0], -c[1]))
    return Cuts(np.array([c[0] for c in cuts], np.int64), np.array([c[1] for c in cuts], np.int64), frozenset(split))


def bucket_of(cuts: Cuts, doc_id: Column, text: Column) -> Column:
    """Twice the number of the row's range, plus one if the row is at the range's upper end."""

    @F.pandas_udf(T.LongType())
    def place(ids, hashes):
        import pandas as pd

        values, hashes = ids.to_numpy(dtype=np.int64), hashes.to_numpy(dtype=np.int64)
        spot = np.minimum(np.searchsorted(cuts.ids, values), len(cuts) - 1)
        upper = cuts.ids[spot] == values
        for i in cuts.split:
            rows = np.flatnonzero(values == i)
            ends = cuts.hashes[cuts.ids == i][::-1]  # ascending
            # The range that ends with the largest of the hashes that do not exceed the row's.
            own = np.searchsorted(ends, hashes[rows], "right") - 1
            spot[rows] += len(ends) - 1 - own
            upper[rows] = ends[own] == hashes[rows]
        return pd.Series(2 * spot + upper)

    return place(F.coalesce(doc_id, F.lit(NO_ID)), F.xxhash64(text) if cuts.split else F.lit(0).cast("long"))


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# -- word and shingle hashes --------------------------------------------------------------------------------------

_ODD = np.uint64(0x9E3779B97F4A7C15 | 1)
_BACK = np.uint64(pow(int(_ODD), -1, 2**64))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, 2 * len(_powers[0]), 1 << 14)
        for i, base in enumerate((_ODD, _BACK)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on all input bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


#: Bytes that part words: blank, tab, line feed, vertical tab, form feed, carriage return.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: A-Z to a-z.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_hashes(text: str | None) -> np.ndarray:
    """One 64-bit hash per word; words are runs of anything but white space, A-Z lower-cased."""
    raw = _LOWER[np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)]
    inside = np.concatenate(([False], ~_SPACE[raw], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    begin, end = edges[::2], edges[1::2]
    if not len(begin):
        return np.empty(0, np.uint64)
    up, down = _power_tables(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    return mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def shingle_set(text: str | None, size: int = 3) -> np.ndarray:
    """The sorted set of hashes of `size` consecutive words; fewer words make one shingle, none make none."""
    words = word_hashes(text)
    if not len(words):
        return words
    size_here = min(size, len(words))
    grams = np.full(len(words) - size_here + 1, np.uint64(size_here))
    for i in range(size_here):
        grams = mix(grams * np.uint64(0x9FB21C651E98DF25) + words[i : len(words) - size_here + 1 + i])
    return np.unique(grams)
