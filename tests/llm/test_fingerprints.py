import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from tallyhouse.llm import fingerprints as fp
from tallyhouse.llm.common import bucket_of, id_cuts
from tests.llm import cases


def slow_grams(text):
    """Hashes of all runs, one run at a time, by the same rolling rule."""
    codes = fp.codes_of(text)
    k = min(fp.K, len(codes))
    return [int(fp.gram_hashes(codes[i : i + k], k)[0]) for i in range(len(codes) - k + 1)] if len(codes) else []


def slow_winnow(hashes, w):
    w = min(w, len(hashes))
    return sorted({max(i for i in range(s, s + w) if hashes[i] == min(hashes[s : s + w])) for s in range(len(hashes) - w + 1)}) if hashes else []


def test_rolling_hashes_equal_single_ones():
    for text in ("", "a", "short", cases.prose(1, 40), "é" * 50, "\U0001f600" * 20):
        assert fp.gram_hashes(fp.codes_of(text)).tolist() == slow_grams(text)


def test_winnowing_picks_the_rightmost_least():
    draw = random.Random(1)
    for n in (0, 1, 5, 31, 32, 33, 200):
        hashes = [draw.randrange(4) for _ in range(n)]
        for w in (1, 2, 7, 32):
            assert fp.winnow(np.array(hashes, np.uint32), w).tolist() == slow_winnow(hashes, w)


def test_every_long_shared_span_is_found():
    draw = random.Random(2)
    for _ in range(50):
        span = "".join(draw.choice("abcdef") for _ in range(fp.GUARANTEE))
        a = cases.prose(draw.random(), 30) + span + cases.prose(draw.random(), 5)
        b = cases.prose(draw.random(), 3) + span
        assert set(fp.fingerprint(a)[1].tolist()) & set(fp.fingerprint(b)[1].tolist())


def expected(rows):
    """(doc_id, n_chars, sha256 of the edited text) by ordering everything in one place."""
    order = sorted(rows, key=lambda r: -(r[0] if r[0] is not None else fp.NO_ID))
    out = []
    for i, (doc_id, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        out.append((doc_id, len(text), hashlib.sha256(edited.encode("utf-8")).hexdigest()))
    return out


def test_edited_texts(spark):
    rows = [(i * i % 97, t) for i, t in enumerate(cases.texts())] + [(None, "no id")]
    rows = list({r[0]: r for r in rows}.values())
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("bucket", F.lit("clash")).repartition(3)
    found = fp.compare_with_next(docs).collect()
    order = lambda r: (r[0] is None, r[0])
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in found), key=order) == sorted(expected(rows), key=order)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    by_text = {}
    for r in found:
        by_text.setdefault(dict(rows)[r.doc_id] or "", set()).add(r.fingerprint)
    assert all(len(v) == 1 for v in by_text.values())


def test_repeated_ids_and_empty_tables(spark):
    assert fp.compare_with_next(cases.documents(spark, extra=True)).count() == len(cases.texts()) + 4
    assert fp.compare_with_next(cases.empty(spark)).count() == 0
    alone = fp.compare_with_next(spark.createDataFrame([(1, "all alone")], "doc_id long, text string")).first()
    assert (alone.near_next, alone.n_chars) == (1.0, 9)


def test_positions_tell_where_the_hashes_begin(spark):
    rows = dict(enumerate(cases.texts()))
    docs = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    for r in fp.compare_with_next(docs).collect():
        spots, hashes = fp.fingerprint(rows[r.doc_id])
        assert r.positions == spots.tolist()
        kept = [int(r.fingerprint[i : i + 8], 16) for i in range(0, len(r.fingerprint), 8)]
        grams = fp.gram_hashes(fp.codes_of(rows[r.doc_id]))
        assert kept == grams[r.positions].tolist() if r.positions else not kept
        # No stretch of the guaranteed length is without a hash that lies in it whole.
        gaps = np.diff([-1, *r.positions, len(grams)]) if r.positions else []
        assert all(g <= fp.W for g in gaps)


def test_many_rows_without_an_id_are_split(spark):
    """A third of all rows has no id, another third one id; both are cut, and every row has its next one."""
    rows = [(None, f"{i} {cases.prose(i, 20)}") for i in range(300)]
    rows += [(7, f"{i} {cases.prose(i, 21)}") for i in range(290)] + [(7, "copy")] * 10 + [(i, cases.prose(i, 22)) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    hashed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("text").alias("h")).collect()
    order = sorted(hashed, key=lambda r: (-(r.doc_id if r.doc_id is not None else fp.NO_ID), r.h))
    expect = []
    for i, r in enumerate(order):
        half = len(r.text) // 2
        edited = r.text[: len(r.text) - half] + order[(i + 1) % len(order)].text[:half]
        expect.append((str(r.doc_id), len(r.text), hashlib.sha256(edited.encode()).hexdigest()))
    found = [(str(r.doc_id), r.n_chars, r.edited_sha256) for r in fp.compare_with_next(docs).collect()]
    assert sorted(found) == sorted(expect)
    cuts = id_cuts(docs, 32)
    assert cuts.split == {fp.NO_ID, 7}
    spot = F.shiftright(bucket_of(cuts, F.col("doc_id"), F.col("text")), 1).alias("spot")
    sizes = [r["count"] for r in docs.select(spot).groupBy("spot").count().collect()]
    assert len(sizes) > 25 and max(sizes) < 80
    assert id_cuts(docs.filter("doc_id > 7"), 8).split == frozenset()
