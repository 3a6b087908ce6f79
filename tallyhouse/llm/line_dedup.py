"""Line dedup by winnowing over line hashes.

Lines are compared without blanks at their ends; empty lines are passed over. Of each RUN consecutive lines the least
line hash, the rightmost among equals, is a fingerprint: documents that share RUN lines share a fingerprint. Only these
minima travel, each once, with the line's place and a 128-bit hash for every way to extend it over its neighbours to a
run of RUN lines of which it is the minimum. Places with a fingerprint that occurs twice are joined to the first place
that extends alike, and every line of a run that stands earlier, in a document with a smaller doc_id or further up, is
deleted; neighbouring and overlapping runs are one. A line of at least LONG words is a run by itself. The first place
of any line stays, so no line vanishes from the corpus.

Missing and empty texts stay as they are. A row without doc_id stays whole and counts as no place. Rows that share a
doc_id are ordered by their text's hash; fully equal rows lose the same lines. A very long text is worked through in one
task; columns other than doc_id and text are kept as they are, whatever their names
(but `_lines` and `_removed`, which are added).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import mix, stored

RUN, LONG = 2, 50
_BLANK = " \t\r"
_HALF = 2**64 - 1
POSITIONS = (
    "doc_id long, row long, at int, fingerprint long,"
    " runs array<struct<start:int,lines:int,content:long,proof:long>>"
)


def positions_of(text: str | None, run: int = RUN, long: int = LONG) -> list[tuple[int, int, list[tuple[int, int, int, int]]]]:
    """(line, fingerprint, runs) of each selected line; a run is (first line, lines, 128 bits of hash in two halves).

    Empty lines do not count. The runs of a minimum are the windows that select it.
    """
    lines = [s for s in (x.strip(_BLANK) for x in (text or "").split("\n")) if s]
    found: dict[tuple[int, int], list[tuple[int, int, int, int]]] = {}
    if len(lines) >= run:
        digests = [xxhash.xxh3_128_intdigest(s.encode("utf-8", "surrogatepass")) for s in lines]
        low = np.array([d & _HALF for d in digests], np.uint64)
        high = np.array([d >> 64 for d in digests], np.uint64)
        n = len(low) - run + 1
        best, spot = low[:n].copy(), np.arange(n)
        content, proof = np.full(n, np.uint64(run)), np.full(n, np.uint64(run))
        for i in range(run):
            lower = low[i : i + n] <= best
            best, spot = np.where(lower, low[i : i + n], best), np.where(lower, np.arange(i, i + n), spot)
            content = mix(content * np.uint64(0x9FB21C651E98DF25) + low[i : i + n])
            proof = mix(proof * np.uint64(0xD6E8FEB86659FD93) + high[i : i + n])
        signed = (x.view(np.int64).tolist() for x in (best, content, proof))
        for start, (at, print_, c, p) in enumerate(zip(spot.tolist(), *signed, strict=True)):
            found.setdefault((at, print_), []).append((start, run, c, p))
    for i, s in enumerate(lines):
        if len(s) >= 2 * long - 1 and len(s.split()) >= long:
            d = xxhash.xxh3_128_intdigest(s.encode("utf-8", "surrogatepass"), seed=1)
            low_, high_ = (x - (x >> 63 << 64) for x in (d & _HALF, d >> 64))
            found.setdefault((i, low_), []).append((i, 1, low_, high_))
    return [(at, print_, runs) for (at, print_), runs in found.items()]


def positions(docs: DataFrame, run: int = RUN, long: int = LONG) -> DataFrame:
    """The selected lines of all documents with their places, one row each; no texts."""
    names = ["doc_id", "row", "at", "fingerprint", "runs"]
    parts = pa.struct([("start", pa.int32()), ("lines", pa.int32()), ("content", pa.int64()), ("proof", pa.int64())])
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64()]

    def emit(batches):
        for batch in batches:
            out, runs, ends = [], [], [0]
            for doc_id, row, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for at, print_, around in positions_of(text, run, long):
                    out.append((doc_id, row, at, print_))
                    runs += around
                    ends.append(len(runs))
            columns = [pa.array(c, k) for c, k in zip(list(zip(*out, strict=True)) or [()] * 4, kinds, strict=True)]
            fields = [pa.array(c, f.type) for c, f in zip(list(zip(*runs, strict=True)) or [()] * 4, parts, strict=True)]
            around = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(fields, fields=list(parts)))
            yield pa.RecordBatch.from_arrays([*columns, around], names)

    return docs.filter("doc_id is not null").select("doc_id", F.xxhash64("text").alias("row"), "text").mapInArrow(emit, POSITIONS)


def repeated(found: DataFrame) -> DataFrame:
    """doc_id, row, spans: the runs that stand earlier, as (first line, lines)."""
    place = F.struct("doc_id", "row", "at")
    # Minimum and maximum combine before the shuffle, whatever share of the rows has one fingerprint.
    shared = (
        found.groupBy("fingerprint")
        .agg(F.min(place).alias("low"), F.max(place).alias("high"))
        .filter("low <> high")
        .select("fingerprint")
    )
    # Both sides of each join come from tables, so that a line a third of all documents have is split between tasks.
    near = found.join(stored(shared, "shared-lines"), "fingerprint", "left_semi")
    # Extended both ways: every place with every run it is the minimum of.
    near = stored(near.select("doc_id", "row", F.inline("runs")), "near-lines")
    first = near.groupBy("content", "proof").agg(F.min(F.struct("doc_id", "row", "start")).alias("first"), F.count("*").alias("n"))
    first = stored(first.filter("n > 1").select("content", "proof", "first"), "first-lines")
    later = near.join(first, ["content", "proof"]).filter(F.struct("doc_id", "row", "start") > F.col("first"))
    return later.groupBy("doc_id", "row").agg(F.collect_set(F.struct("start", "lines")).alias("spans"))


def _strip(text: str | None, spans) -> str | None:
    if text is None or spans is None or not len(spans):
        return text
    lines = text.split("\n")
    full = [i for i, x in enumerate(lines) if x.strip(_BLANK)]
    gone = np.zeros(len(full) + 1, np.int64)
    for span in spans:
        gone[span["start"]] += 1
        gone[span["start"] + span["lines"]] -= 1
    drop = {i for i, g in zip(full, np.cumsum(gone)[:-1], strict=True) if g}
    return "\n".join(x for i, x in enumerate(lines) if i not in drop)


def _stripped(text: Column, spans: Column) -> Column:
    @F.pandas_udf("string")
    def strip(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([_strip(t, s) for t, s in zip(texts, spans, strict=True)], dtype=object)

    # Else Spark would copy the call into filters on what it gives: two Python workers a task, and every text cut twice.
    return strip.asNondeterministic()(text, spans)


def _full_lines(text: Column) -> Column:
    kept = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.length(F.trim(x, F.lit(_BLANK))) > 0)
    return F.size(kept).cast("long")


def dedup_lines(docs: DataFrame, run: int = RUN, long: int = LONG) -> DataFrame:
    """The rows with all their columns, `text` without later runs, and `_lines`, `_removed`: full lines before, deleted."""
    spans = repeated(stored(positions(docs, run, long), "line-places"))
    spans = spans.select(F.col("doc_id").alias("_id"), F.col("row").alias("_row"), F.col("spans").alias("_spans"))
    matched = docs.join(spans, (docs["doc_id"] == spans["_id"]) & (F.xxhash64(docs["text"]) == spans["_row"]), "left")
    text = F.when(F.col("_spans").isNull(), docs["text"]).otherwise(_stripped(docs["text"], F.col("_spans")))
    columns = [text.alias("text") if c == "text" else docs[c] for c in docs.columns]
    before = _full_lines(docs["text"]).alias("_lines")
    out = matched.select(*columns, before, F.col("_spans").isNotNull().alias("_hit"))
    return out.withColumn("_removed", F.when(F.col("_hit"), F.col("_lines") - _full_lines(F.col("text"))).otherwise(F.lit(0).cast("long"))).drop("_hit")


ORACLE = r"""
WITH lines AS (
  SELECT doc_id, i, trim(line, E' \t\r') AS line, line AS raw
  FROM (SELECT doc_id, unnest(string_split(text, E'\n')) AS line, generate_subscripts(string_split(text, E'\n'), 1) AS i
        FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL)
), solid AS (
  SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS s, i FROM lines WHERE line <> ''
), pairs AS (
  SELECT doc_id, s, 2 AS n, line AS c1, lead(line) OVER (PARTITION BY doc_id ORDER BY s) AS c2 FROM solid
), wins AS (
  SELECT * FROM pairs WHERE c2 IS NOT NULL
  UNION ALL
  SELECT doc_id, s, 1, line, '' FROM solid WHERE len(regexp_split_to_array(line, '\s+')) >= 50
), ranked AS (
  SELECT doc_id, s, n, row_number() OVER (PARTITION BY n, c1, c2 ORDER BY doc_id, s) AS k FROM wins
), gone AS (
  SELECT DISTINCT doc_id, s + o AS s FROM ranked, (VALUES (0), (1)) AS t(o) WHERE k > 1 AND o < n
), marked AS (
  SELECT l.doc_id, l.i, l.raw, x.s IS NOT NULL AS solid, g.s IS NOT NULL AS gone
  FROM lines l LEFT JOIN solid x ON l.doc_id = x.doc_id AND l.i = x.i
  LEFT JOIN gone g ON x.doc_id = g.doc_id AND x.s = g.s
), kept AS (
  SELECT doc_id, string_agg(raw, E'\n' ORDER BY i) FILTER (WHERE NOT gone) AS text,
         count(*) FILTER (WHERE solid) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed
  FROM marked GROUP BY doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
       coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""
