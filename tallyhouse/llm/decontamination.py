"""Benchmark decontamination by winnowing, in Spark expressions only.

Of the GRAM-word hashes in every SPAN consecutive words the least is a fingerprint. A document and a benchmark item
that share SPAN words share one. Fingerprints of both sides are joined; the documents that remain extend each hit:
every span around it is compared word by word with the benchmark's spans. An item of fewer than SPAN words is a span of
its own, looked up among the documents' runs of that many words.

Missing and empty texts have no words. An item without words, or without item_id, is nothing to be found. Rows that
share a doc_id are judged each by its own text; a missing doc_id is kept. Repeated items count as one item.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import NO_ID, stored
from tallyhouse.llm.words import folded_words, gram_hashes, words

SPAN, GRAM = 10, 5


def minima(hashes: Column, span: int, gram: int) -> Column:
    """The distinct least hashes of all windows of span - gram + 1 hashes."""
    width = span - gram + 1
    last = F.size(hashes) - F.lit(width)
    starts = F.when(last >= 0, F.sequence(F.lit(1), last + 1)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.array_min(F.slice(hashes, i, width))))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("_id"), F.xxhash64("text").alias("_row"), "text")


def spans_of(benchmark: DataFrame, span: int = SPAN) -> DataFrame:
    """item_id, size, span: the texts of every item's spans; items shorter than a span have one."""
    items = benchmark.filter("item_id is not null").select("item_id", words(F.col("text")).alias("w"))
    items = items.filter(F.size("w") > 0).withColumn("size", F.least(F.size("w"), F.lit(span)))
    starts = F.sequence(F.lit(1), F.size("w") - F.col("size") + 1)
    texts = F.transform(starts, lambda i: F.array_join(F.slice(F.col("w"), i, F.col("size")), " "))
    return items.select("item_id", "size", F.explode(F.array_distinct(texts)).alias("span")).distinct()


def fingerprints_of(spans: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """size, fingerprint: what documents are searched for."""
    w = spans.select("size", "span").distinct().withColumn("w", folded_words(F.col("span")))
    long = w.filter(F.col("size") == span).withColumn("g", gram_hashes(F.col("w"), gram)).select("size", F.array_min("g").alias("fingerprint"))
    short = w.filter(F.col("size") < span).select("size", _whole_hash(F.col("w"), F.col("size"), span).alias("fingerprint"))
    return long.unionByName(short).distinct()


def _whole_hash(w: Column, size: Column, span: int) -> Column:
    chosen = F.lit(None).cast("long")
    for n in range(1, span):
        chosen = F.when(size == n, F.xxhash64(*[F.get(w, F.lit(k)) for k in range(n)])).otherwise(chosen)
    return chosen


def _cut(w: Column, at: Column, n: int) -> Column:
    """The n words from each place on, as (start, span)."""
    return F.transform(at, lambda s: F.struct(s.alias("start"), F.array_join(F.slice(w, s + 1, n), " ").alias("span")))


def hits(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """Hits (_id, _row, start, size, span) in the documents, and the benchmark's spans with their items.

    What is searched for is stored first: Spark knows its size from the files and sends it to every task only where it
    is below its own limit; else both sides are shuffled.
    """
    spans = stored(spans_of(benchmark, span), "spans")
    wanted = stored(fingerprints_of(spans, span, gram), "fingerprints")
    short = sorted(r["size"] for r in wanted.filter(F.col("size") < span).select("size").distinct().collect())
    keyed = _keyed(docs).withColumn("w", folded_words(F.col("text"))).select("_id", "_row", "w")

    def look(found: DataFrame, size: int) -> DataFrame:
        return found.join(wanted.filter(F.col("size") == size), "fingerprint").select("_id", "_row", "size", "fingerprint")

    grams = keyed.select("_id", "_row", gram_hashes(F.col("w"), gram).alias("g"))
    near = look(grams.select("_id", "_row", F.explode(minima(F.col("g"), span, gram)).alias("fingerprint")), span)
    for n in short:
        whole = keyed.select("_id", "_row", F.explode(F.array_distinct(gram_hashes(F.col("w"), n))).alias("fingerprint"))
        near = near.unionByName(look(whole, n))
    # One row per document and size; a document cannot have more fingerprints than words.
    near = stored(near.groupBy("_id", "_row", "size").agg(F.collect_set("fingerprint").alias("found")), "near")

    # The documents that remain are a share of all, so they are no side to send to every task.
    texts = _keyed(docs).join(near.hint("merge"), ["_id", "_row"])
    texts = texts.withColumn("f", folded_words(F.col("text"))).withColumn("w", words(F.col("text")))
    tried = []
    for n in [*short, span]:
        size = gram if n == span else n
        here = texts.filter(F.col("size") == n)
        # The hashes are what is gone through, never looked up from inside: Spark would make them anew for each.
        at = F.transform(gram_hashes(F.col("f"), size), lambda h, i: F.when(F.array_contains(F.col("found"), h), i))
        at = F.array_compact(at)
        if n == span:  # every span that holds the run
            around = F.transform(at, lambda p: F.sequence(F.greatest(p - (span - gram), F.lit(0)), F.greatest(p, F.lit(0))))
            at = F.filter(F.array_distinct(F.flatten(around)), lambda s: s + span <= F.size("w"))
        tried.append(
            here.withColumn("at", at)
            .select("_id", "_row", "size", F.explode(_cut(F.col("w"), F.col("at"), n)).alias("x"))
            .select("_id", "_row", "size", "x.start", "x.span")
        )
    found = tried[0]
    for more in tried[1:]:
        found = found.unionByName(more)
    texts_wanted = spans.select("size", "span").distinct()
    return stored(found.join(texts_wanted, ["size", "span"]).distinct(), "hits"), spans


def verdicts(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """_id, _row of contaminated texts with n_hit, n_items, items: the words hit and the items found, sorted as text."""
    found, spans = hits(docs, benchmark, span, gram)
    words_hit = (
        found.select("_id", "_row", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("size") - 1)).alias("at"))
        .distinct()
        .groupBy("_id", "_row")
        .agg(F.count("*").alias("n_hit"))
    )
    items = (
        found.select("_id", "_row", "size", "span")
        .distinct()
        .join(spans, ["size", "span"])
        .select("_id", "_row", F.col("item_id").cast("string").alias("item"))
        .groupBy("_id", "_row")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    return words_hit.join(items, ["_id", "_row"]).withColumn("n_items", F.size("items").cast("long"))


def report(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items, contaminated for every row."""
    judged = stored(verdicts(docs, benchmark, span, gram), "verdicts")
    counted = docs.select(
        "doc_id", F.coalesce("doc_id", F.lit(NO_ID)).alias("_id"), F.xxhash64("text").alias("_row"), F.size(folded_words(F.col("text"))).cast("long").alias("n_words")
    )
    out = counted.join(judged, ["_id", "_row"], "left")
    zero = F.lit(0).cast("long")
    return out.select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", zero).alias("n_hit"),
        F.coalesce("n_items", zero).alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """The rows without a hit, unchanged."""
    judged = stored(verdicts(docs, benchmark, span, gram), "verdicts").select("_id", "_row").hint("merge")
    same = (F.coalesce(docs["doc_id"], F.lit(NO_ID)) == judged["_id"]) & (F.xxhash64(docs["text"]) == judged["_row"])
    return docs.join(judged, same, "left_anti")


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
#: All windows of the items held against all places of the documents, for tables whose ids are unique.
ORACLE = f"""
WITH d AS MATERIALIZED (SELECT doc_id, {_WORDS} AS w FROM documents),
items AS MATERIALIZED (SELECT item_id, w, least({SPAN}, len(w)) AS k FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
windows AS MATERIALIZED (
  SELECT DISTINCT item_id, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS span
  FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM items)),
lengths AS (SELECT DISTINCT k FROM windows),
places AS MATERIALIZED (
  SELECT doc_id, k, i, array_to_string(list_slice(w, i, i + k - 1), ' ') AS span
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, lengths WHERE len(w) >= k)),
hits AS MATERIALIZED (SELECT doc_id, item_id, i, p.k FROM places p JOIN windows v ON p.k = v.k AND p.span = v.span),
hit_words AS (SELECT doc_id, count(DISTINCT spot) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS spot FROM hits) GROUP BY doc_id),
hit_items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS named
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(named, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""
