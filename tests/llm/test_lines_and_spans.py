import hashlib
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import decontamination, licenses, line_dedup, queries
from tests.conftest import SF_DIR
from tests.llm import cases


def plain_lines(rows, run=line_dedup.RUN, long=line_dedup.LONG):
    """Texts without lines of runs seen before, window by window in order of the ids."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        lines = (text or "").split("\n")
        full = [i for i, x in enumerate(lines) if x.strip(" \t\r")]
        solid = [lines[i].strip(" \t\r") for i in full]
        gone = set()
        for s in range(len(solid)):
            for n in ([run] if s + run <= len(solid) else []) + ([1] if len(solid[s].split()) >= long else []):
                window = (n, *solid[s : s + n])
                if window in seen:
                    gone.update(full[s : s + n])
                seen.add(window)
        out[doc_id] = text if text is None else "\n".join(x for i, x in enumerate(lines) if i not in gone)
    return out


def test_lines_equal_the_plain_version(spark):
    long = cases.prose(9, 60)
    rows = [(3, "a\nb\nc\nd"), (1, "x\na\nb\nc"), (2, "a\n\n  b\t\nq"), (4, "z\nz\nz\nz"), (5, f"{long}\nend"), (6, f"start\n{long}"), (7, None), (8, "")]
    rows += [(100 + i, t) for i, t in enumerate(cases.texts())]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in cases.CLASHING}).repartition(4)
    out = line_dedup.dedup_lines(docs)
    assert out.columns == [*docs.columns, "_lines", "_removed"]
    assert {r.doc_id: r.text for r in out.collect()} == plain_lines(rows)


@pytest.mark.parametrize("run", [2, 3, 5])
def test_only_window_minima_are_places_and_each_window_is_one_run(run):
    text = "\n".join(cases.prose(i % 7, 3) for i in range(40)) + "\n\n  \n" + cases.prose(1, 3)
    found = line_dedup.positions_of(text, run)
    lines = [x.strip(" \t\r") for x in text.split("\n") if x.strip(" \t\r")]
    starts = sorted(s for _, _, runs in found for s, _, _, _ in runs)
    assert starts == list(range(len(lines) - run + 1)) and len({at for at, _, _ in found}) == len(found) < len(lines)
    prints, contents = {}, {}
    for at, print_, runs in found:
        assert prints.setdefault(lines[at], print_) == print_
        for s, n, *hashes in runs:
            assert s <= at < s + n == s + run
            assert contents.setdefault(tuple(lines[s : s + n]), hashes) == hashes
    assert len({tuple(h) for h in contents.values()}) == len(contents)


@pytest.mark.parametrize("run", [3, 4])
def test_longer_runs(spark, run):
    rows = [(1, "a\nb\nc\nd\ne"), (2, "b\nc\nd\nq\na\nb"), (3, "q\na\nb\nc\nd\ne\nf")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs, run).collect()}
    assert found == plain_lines(rows, run)


def test_lines_of_odd_rows(spark):
    docs = cases.documents(spark, extra=True)
    out = line_dedup.dedup_lines(docs).collect()
    assert len(out) == docs.count()
    assert [r.text for r in out if r.doc_id is None] == ["no id at all"]
    assert line_dedup.dedup_lines(cases.empty(spark)).count() == 0


def test_line_query_equals_its_sql(spark):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    want = sorted(map(repr, duck.sql(line_dedup.ORACLE).fetchall()))
    got = queries.QUERIES["op2_line_dedup"](spark, SF_DIR)
    assert sorted(repr(tuple(r)) for r in got.select("doc_id", "text", "n_lines", "n_removed").collect()) == want


def plain_hits(text, items, span=10):
    w, hit, found = cases.words(text), set(), set()
    for item_id, item in items:
        x = cases.words(item)
        n = min(span, len(x))
        wins = {tuple(x[s : s + n]) for s in range(len(x) - n + 1)} if n else set()
        for s in range(len(w) - n + 1 if n else 0):
            if tuple(w[s : s + n]) in wins:
                hit.update(range(s, s + n))
                found.add(str(item_id))
    return len(w), len(hit), sorted(found)


def test_contamination_equals_the_plain_version(spark):
    long = [cases.prose(i, 30, 50_000) for i in range(4)]
    items = [(1, long[0]), (2, long[1].upper()), (10, long[0]), (3, "three short words"), (4, None), (5, ""), (6, "one"), (7, "seven words are enough for a span"), (8, "ΑΣ ß Éa b c d e f g h ı"), (None, long[3])]
    half = long[0].split()
    rows = [
        (1, f"before {long[0]} after"), (2, " ".join(half[5:15])), (3, " ".join(half[5:14])), (4, f"x {long[1].title()} y {long[1]}"),
        (5, "it has THREE, short-words here"), (6, "One"), (7, "these seven words are enough for a span too"), (8, "αΣ ß Éa b c d e f g h ı"),
        (9, "αΣ ß éa b c d e f g h i"), (10, long[3]), (11, "ΑΣ ß Éa B c D e F g H ı z"), (12, " ".join(half[:12] + ["cut"] + half[12:])),
    ]
    rows += [(100 + i, t) for i, t in enumerate(cases.texts())]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in cases.CLASHING}).repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    known = [x for x in items if x[0] is not None]
    found = {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in decontamination.report(docs, bench).collect()}
    assert found == {i: plain_hits(t, known) for i, t in rows}
    kept = decontamination.clean(docs, bench)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, t in rows if not plain_hits(t, known)[1]}


def test_contamination_of_odd_rows(spark):
    docs, bench = cases.documents(spark), spark.createDataFrame([(1, "equal rows"), (1, "equal rows")], "item_id long, text string")
    found = decontamination.report(docs, bench).collect()
    assert len(found) == docs.count() and [r.n_hit for r in found if r.doc_id == 990] == [2, 2]
    assert decontamination.report(docs, bench.limit(0)).filter("contaminated").count() == 0
    assert decontamination.report(cases.empty(spark), bench).count() == 0


def test_benchmark_query_on_its_tables(spark):
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    for r in queries.QUERIES["op4_decontamination"](spark, SF_DIR).filter("doc_id % 5 = 0 or contaminated").collect():
        n, hit, found = plain_hits(texts[r.doc_id], items)
        sha = hashlib.sha256(",".join(found).encode()).hexdigest()
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (n, hit, len(found), sha, hit > 0)


def plain_licenses(text):
    w, starts, labels = cases.words(text), [], set()
    for phrase, label in licenses.BASE:
        p = phrase.split()
        at = [s for s in range(len(w) - len(p) + 1) if w[s : s + len(p)] == p]
        starts += at
        labels |= {label} if at else set()
    return len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def test_licenses_equal_the_plain_version(spark):
    rows = [
        (1, "Released under the MIT License. UNDER THE MIT LICENSE"), (2, "Apache License, Version 2.0 cc-by-nc cc by nc by nc"),
        (3, "under the mit licence"), (4, "CC BY NC"), (5, "cc by"), (6, None), (7, "Kelvin under the MİT license"),
        (8, "This work is licensed under the new GNU General Public License, version 3."),
        (9, "licensed under the gnu general public license"), (10, "x " * 5000 + "under the mit license"),
    ]
    rows += [(100 + i, t) for i, t in enumerate(cases.texts())]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in cases.CLASHING})
    found = {r.doc_id: r for r in licenses.scan(docs).collect()}
    for doc_id, text in rows:
        r = found.pop(doc_id)
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain_licenses(text)
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
        if doc_id == 8:  # a word put in moves the rest to the next diagonal
            assert r.labels == "gpl-3" and 0.7 <= r.score < 1
    assert not found


def plain_share(text, template):
    """The most grams of a template that lie, each at its place or up to SLACK words later, in one span."""
    words, want = re.findall(licenses._WORD, (text or "").lower()), template.split()
    n = len(want) - licenses.GRAM + 1
    gram = lambda w, i: tuple(w[i : i + licenses.GRAM])
    votes = {(s - t, t) for s in range(len(words) - licenses.GRAM + 1) for t in range(n) if gram(words, s) == gram(want, t)}
    return max((len({t for d, t in votes if low <= d <= low + licenses.SLACK}) / n for low, _ in votes), default=0.0)


def test_license_labels_need_one_span(spark):
    """Grams of a template one after another, or far apart, are not the license; a few words put in or left out are."""
    gpl = "licensed under the gnu general public license version 3".split()
    grams = [" ".join(gpl[i : i + 3]) for i in range(len(gpl) - 2)]
    texts = {
        1: " ".join(grams), 2: " and some other words of no note ".join(grams), 3: " ".join(grams[::-1]), 4: " ".join(gpl),
        5: " ".join([*gpl[:5], "and", "free", *gpl[5:]]), 6: " ".join([*gpl[:4], *gpl[5:]]), 7: " ".join(gpl[:8]), 8: "x " * 3000 + " ".join(gpl),
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r.doc_id: r for r in licenses.scan(docs).collect()}
    for doc_id, text in texts.items():
        shares = {(t, label): plain_share(text, t) for t, label in licenses.BASE + licenses.TEMPLATES}
        assert found[doc_id].score == max(shares.values())
        assert found[doc_id].labels == ",".join(sorted({label for (_, label), v in shares.items() if v >= licenses.SHARE}))
    assert [i for i in texts if "gpl-3" in found[i].labels] == [4, 5, 7, 8]


def test_licenses_of_odd_rows(spark):
    docs = cases.documents(spark)
    assert licenses.scan(docs).count() == docs.count()
    twice = spark.createDataFrame([(1, "cc by nc")] * 2 + [(None, "cc by nc")], "doc_id long, text string")
    assert [(r.n_base, r.labels) for r in licenses.scan(twice).collect()] == [(1, "cc-by-nc")] * 3
    assert licenses.scan(cases.empty(spark)).count() == 0
