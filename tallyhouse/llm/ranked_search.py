"""Ranked lexical search by pipelined term partitioning: the best documents for each item, in whole numbers.

1. Each task turns its documents into posting blocks: for one term, where in a shard of at most SHARD documents it
   stands, how often, and how long those documents are. Terms no item has are left out by a bitmap of fixed size; what
   passes it by chance finds no item in the join. A term a third of all documents have is a block per shard.
2. A term's owner is the stage that holds terms of its rarity, the rarest first. Items are dealt to bundles. For each
   bundle and shard, a stage cogroups the bundle's accumulators with the blocks of the terms it owns, adds their
   contributions, and sends on only what is not zero. What cannot come among the shard's best any more, even with all
   that the later owners could add, is dropped on the way, which loses no result.
3. The last stage selects the best of each shard; the best of those by item are the result.

Missing and empty texts have no term and no rank. Rows are documents: rows that share a doc_id, or have none, are
ranked each for itself, a missing id after all others. Equal scores go by doc_id, and by the row's place where ids are
equal too. Rows of items that share an item_id are items of their own; an item without terms has no result. Very long
texts are counted term by term, so a document takes as much memory as its text and one entry per distinct term.
"""

from __future__ import annotations

import zlib
from array import array
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import stored

#: Documents of a shard, and postings after which it ends early.
SHARD, POSTINGS = 16_384, 2_000_000
#: Items that travel together.
BUNDLE = 64
#: A stage owns the terms that at most this share of all documents have; the last one owns the rest.
OWNERS = (1 / 1024, 1 / 32, 1.0)
#: Bits of the bitmap that tells the items' terms: half a megabyte whatever the items are.
BITS = 22
#: No term adds more than its weight times this.
MOST = 1_000_000
TOP = 10

#: Bytes that end a term become blanks, A-Z become a-z; bytes of other characters belong to terms.
_FOLD = bytes(b if b >= 128 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256))

POSTING = "shard long, term binary, at binary, tf binary, n binary, ids array<long>, n_docs long, n_terms long"


def terms(raw: bytes | None) -> list[bytes]:
    """Runs of letters, digits and whatever is not ASCII, A-Z lower-cased; raw: UTF-8."""
    return raw.translate(_FOLD).split() if raw else []


def item_terms(items: DataFrame) -> DataFrame:
    """item (the row's number), item_id, term, repeats."""

    def split(batches):
        for batch in batches:
            rows = [
                (item, item_id, term, count)
                for item, item_id, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True)
                for term, count in Counter(terms(raw)).items()
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([r[1] for r in rows], batch.schema.field(1).type),
                    pa.array([r[2] for r in rows], pa.binary()),
                    pa.array([r[3] for r in rows], pa.int64()),
                ],
                ["item", "item_id", "term", "repeats"],
            )

    numbered = items.select(F.monotonically_increasing_id().alias("item"), "item_id", F.col("text").cast("binary").alias("text"))
    kind = items.schema["item_id"].dataType.simpleString()
    return stored(numbered.mapInArrow(split, f"item long, item_id {kind}, term binary, repeats long"), "item-terms")


def bitmap(wanted: DataFrame) -> bytes:
    """One bit per slot of a hash; set where an item has a term. Spark builds it, in pieces of 32,768 bits."""
    slot = F.pmod(F.crc32("term"), F.lit(1 << BITS))
    pieces = (
        wanted.select(slot.alias("slot")).groupBy(F.expr("slot div 32768").alias("piece")).agg(F.bitmap_construct_agg(F.expr("slot % 32768")).alias("bits"))
    )
    out = np.zeros((1 << BITS) // 8, np.uint8)
    for row in pieces.collect():  # at most 128 rows of 4 KB
        part = np.frombuffer(bytes(row["bits"]), np.uint8)
        out[row["piece"] * 4096 :][: len(part)] = part
    return out.tobytes()


def postings(docs: DataFrame, flags: bytes, shard: int = SHARD) -> DataFrame:
    """Posting blocks by shard and term; one more row per shard, without term, has its doc_ids and counts."""

    def index(batches):
        passes = np.unpackbits(np.frombuffer(flags, np.uint8), bitorder="little").tobytes()
        mask, crc = (1 << BITS) - 1, zlib.crc32
        first, shards = TaskContext.get().partitionId() << 32, 0
        ids, blocks, held, n_docs, n_terms = [], {}, 0, 0, 0

        def flush():
            nonlocal shards, ids, blocks, held, n_docs, n_terms
            found = list(blocks)
            rows = len(found) + 1
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array([first + shards] * rows, pa.int64()),
                    pa.array([*found, None], pa.binary()),
                    *(pa.array([*(blocks[t][k].tobytes() for t in found), None], pa.binary()) for k in range(3)),
                    pa.array([None] * len(found) + [ids], pa.list_(pa.int64())),
                    pa.array([None] * len(found) + [n_docs], pa.int64()),
                    pa.array([None] * len(found) + [n_terms], pa.int64()),
                ],
                ["shard", "term", "at", "tf", "n", "ids", "n_docs", "n_terms"],
            )
            shards, ids, blocks, held, n_docs, n_terms = shards + 1, [], {}, 0, 0, 0
            return out

        for batch in batches:
            for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = terms(raw)
                n, at = len(words), len(ids)
                ids.append(doc_id)
                n_docs, n_terms = n_docs + (n > 0), n_terms + n
                for term, tf in Counter(words).items():
                    if passes[crc(term) & mask]:
                        block = blocks.get(term)
                        if block is None:
                            block = blocks[term] = (array("i"), array("i"), array("i"))
                        block[0].append(at)
                        block[1].append(tf)
                        block[2].append(n)
                        held += 1
                if len(ids) >= shard or held >= POSTINGS:
                    yield flush()
        if ids:
            yield flush()

    return stored(docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(index, POSTING), "postings")


def weighted(blocks: DataFrame, wanted: DataFrame, n_docs: int) -> DataFrame:
    """item, item_id, term, owner (stage) and gain (weight times repeats) of the items' terms that documents hold."""
    df = blocks.filter("term is not null").groupBy("term").agg(F.sum(F.octet_length("at") / 4).cast("long").alias("df"))
    weight = F.floor(1000 * F.log((2 * F.lit(n_docs) + 2).cast("double") / (2 * F.col("df") + 1))).cast("long")
    owner = F.lit(len(OWNERS) - 1)
    for k in reversed(range(len(OWNERS) - 1)):
        owner = F.when(F.col("df") <= OWNERS[k] * n_docs, F.lit(k)).otherwise(owner)
    return wanted.join(df, "term").select("item", "item_id", "term", owner.alias("owner"), (weight * F.col("repeats")).alias("gain"))


def uses(gains: DataFrame, bundles: int) -> DataFrame:
    """One row per owner, term and bundle: the items of the bundle that use the term, with gain and what may still come.

    rest: the most that the owners after this one can add to the item's score.
    """
    later = Window.partitionBy("item").orderBy("owner").rangeBetween(1, Window.unboundedFollowing)
    rest = F.coalesce(F.sum("gain").over(later), F.lit(0)) * MOST
    bundle = F.pmod(F.xxhash64("item"), F.lit(bundles)).cast("int")
    return (
        gains.select("owner", "term", bundle.alias("bundle"), F.struct("item", "gain", rest.alias("rest")).alias("use"))
        .groupBy("owner", "term", "bundle")
        .agg(F.collect_list("use").alias("uses"))  # at most the items of one bundle
    )


def _kept(score: np.ndarray, rest: int, top: int) -> np.ndarray:
    """Places of scores that may still end among the shard's best."""
    at = np.flatnonzero(score > 0)
    if len(at) > top:
        least = np.partition(score[at], len(at) - top)[len(at) - top]
        at = at[score[at] + rest >= least]
    return at


def _stage(n_docs: int, n_terms: int, last: bool, top: int):
    """What an owner does with the accumulators of one bundle and shard; n_docs, n_terms: of all documents."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        bundle, shard = next((t.column("bundle")[0].as_py(), t.column("shard")[0].as_py()) for t in (left, right) if t.num_rows)
        carried = {
            item: (np.frombuffer(at, np.int32), np.frombuffer(score, np.int64))
            for item, at, score in zip(*(left.column(c).to_pylist() for c in ("item", "at", "score")), strict=True)
        }
        ids, blocks, size = None, [], 0
        for own, at, tf, n, used in zip(*(right.column(c).to_pylist() for c in ("ids", "at", "tf", "n", "uses")), strict=True):
            if own is not None:
                ids = own
                continue
            at, tf, n = (np.frombuffer(x, np.int32) for x in (at, tf, n))
            blocks.append((at, tf.astype(np.int64), n.astype(np.int64), used))
            size = max(size, int(at[-1]) + 1)
        size = max([size, *(int(at[-1]) + 1 for at, _ in carried.values())])
        scores, rests = {}, {}
        for item, (at, score) in carried.items():
            scores[item] = np.zeros(size, np.int64)
            scores[item][at] = score
        for at, tf, n, used in blocks:
            m = 25 + (75 * n * n_docs) // n_terms
            part = (1_000_000_000 * tf) // (1000 * tf + 8 * m)
            for use in used:
                total = scores.get(use["item"])
                if total is None:
                    total = scores[use["item"]] = np.zeros(size, np.int64)
                total[at] += use["gain"] * part  # a document is in a block once
                rests[use["item"]] = use["rest"]
        rows = []
        for item, score in scores.items():
            if not last:
                # Without a term here the item's rest is not known, and all of it goes on.
                at = _kept(score, rests[item], top) if item in rests else np.flatnonzero(score)
                if len(at):
                    rows.append((item, at.astype(np.int32).tobytes(), score[at].tobytes()))
                continue
            at = _kept(score, 0, top)
            best = sorted(((-int(score[i]), ids[i] is None, ids[i] or 0, int(i)) for i in at.tolist()))[:top]
            rows += [(item, ids[i], -s, shard, i) for s, _, _, i in best]
        if last:
            return pa.table(
                {c: pa.array([r[k] for r in rows], pa.int64()) for k, c in enumerate(("item", "doc_id", "score", "shard", "at"))}
            )
        return pa.table(
            {
                "bundle": pa.array([bundle] * len(rows), pa.int32()),
                "shard": pa.array([shard] * len(rows), pa.int64()),
                "item": pa.array([r[0] for r in rows], pa.int64()),
                "at": pa.array([r[1] for r in rows], pa.binary()),
                "score": pa.array([r[2] for r in rows], pa.binary()),
            }
        )

    return run


ACCUMULATORS = "bundle int, shard long, item long, at binary, score binary"


def search(docs: DataFrame, items: DataFrame, top: int = TOP, shard: int = SHARD, bundle: int = BUNDLE) -> DataFrame:
    """item_id, rank, doc_id, score: the `top` best documents of each item, score above 0."""
    spark = docs.sparkSession
    wanted = item_terms(items)
    blocks = postings(docs, bitmap(wanted), shard)
    total = blocks.agg(F.sum("n_docs").alias("docs"), F.sum("n_terms").alias("terms")).first()
    n_docs, n_terms = total["docs"] or 0, total["terms"] or 0
    gains = stored(weighted(blocks, wanted, n_docs), "gains")
    bundles = max(1, -(-gains.select("item").distinct().count() // bundle))
    used = stored(uses(gains, bundles), "uses")
    now = spark.createDataFrame([], ACCUMULATORS)
    use = used.schema["uses"].dataType
    none = F.lit(None).cast(use).alias("uses")
    for owner in range(len(OWNERS)):
        last = owner == len(OWNERS) - 1
        columns = ("bundle", "shard", "at", "tf", "n", "ids", "uses")
        right = blocks.filter("term is not null").join(used.filter(F.col("owner") == owner), "term").select(*columns)
        if last:  # each bundle's selection needs the ids of each shard: the items against all documents, in blocks
            shards = blocks.filter("term is null").select("shard", "at", "tf", "n", "ids", none)
            each = F.explode(F.sequence(F.lit(0), F.lit(bundles - 1)))
            right = right.unionByName(shards.withColumn("bundle", each).select(*columns))
        schema = "item long, doc_id long, score long, shard long, at long" if last else ACCUMULATORS
        now = now.groupBy("bundle", "shard").cogroup(right.groupBy("bundle", "shard")).applyInArrow(_stage(n_docs, n_terms, last, top), schema)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "shard", "at")
    best = now.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    names = wanted.select("item", "item_id").distinct()
    return best.join(names, "item").select("item_id", "rank", "doc_id", "score")


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TERMS = rf"regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
ORACLE = f"""
WITH d AS (SELECT doc_id, {_TERMS} AS w FROM documents WHERE text IS NOT NULL),
size AS (SELECT CAST(count(*) AS BIGINT) AS big_n, CAST(sum(len(w)) AS BIGINT) AS big_l FROM d WHERE len(w) > 0),
held AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM d) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * max(big_n) + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w FROM held, size GROUP BY term),
wanted AS (
  SELECT item_id, term, count(*) AS repeats FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
scores AS (
  SELECT item_id, doc_id,
         CAST(sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * big_n) // big_l)))) AS BIGINT) AS score
  FROM wanted JOIN weights USING (term) JOIN held USING (term), size GROUP BY item_id, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""
