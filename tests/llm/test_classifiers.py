import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from tallyhouse.llm import quality_gam, queries, secrets, toxicity
from tests.llm import cases

#: The smallest tables with enough labels of both kinds to learn from.
SF_DIR = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int"


def accuracy(spark, name, label, of, held):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").select("doc_id", label)
    rows = queries.QUERIES[name](spark, SF_DIR).join(labels, "doc_id", "left").collect()
    assert len(rows) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % of == held) for r in rows)
    judged = [r for r in rows if r.held_out and r[label] is not None]
    return sum(r.predicted == r[label] for r in judged) / len(judged)


def test_quality_on_held_out_documents(spark):
    assert accuracy(spark, "op7_quality", "quality", 5, 0) >= 0.9


def test_toxicity_on_held_out_documents(spark):
    assert accuracy(spark, "op10_toxicity", "toxic", 3, 1) >= 0.85


def test_samples_are_bounded_where_many_rows_share_an_id(spark, monkeypatch):
    docs = spark.range(3000).selectExpr("if(id % 2 = 0, 7, id) AS doc_id", "concat('text number ', id % 1500) AS text")
    labels = spark.createDataFrame([(7, 1, 1)] + [(i, i % 3 % 2, 0) for i in range(1, 99, 2) if i != 7], "doc_id long, quality int, toxic int")
    taken = []
    monkeypatch.setattr(quality_gam, "SAMPLE", 60)
    monkeypatch.setattr(quality_gam, "fit", lambda x, y: taken.append((len(x), len(y))))
    quality_gam.train(docs, labels)
    assert taken == [(60, 60)]
    monkeypatch.setattr(toxicity, "TOXIC_SAMPLE", 20)
    monkeypatch.setattr(toxicity, "CLEAN_SAMPLE", 30)
    chosen = toxicity._sample(docs, labels, F.lit(True)).collect()
    assert sorted(r.label for r in chosen) == [0] * 30 + [1] * 20
    assert len({(r.doc_id, r.text) for r in chosen}) == 50
    assert {(r.doc_id, r.text) for r in chosen} <= {(r.doc_id, r.text) for r in docs.collect()}


def test_tables_and_pairs_learn_what_they_must():
    """One rule on a single feature, one that only shows in two features together."""
    x = np.random.default_rng(0).random((4000, 4)).astype(np.float32)
    model = quality_gam.fit(x, (x[:, 1] > 0.3).astype(float))
    assert ((model.scores(x) > 0.5) == (x[:, 1] > 0.3)).mean() > 0.98
    both = (x[:, 0] > 0.5) ^ (x[:, 2] > 0.5)
    model = quality_gam.fit(x, both.astype(float))
    assert ((model.scores(x) > 0.5) == both).mean() > 0.95
    assert {on for on, _ in model.tables if len(on) == 2} >= {(0, 2)}
    # Scoring is nothing but a sum of table entries.
    bins = model.bins(x[:5])
    sums = [model.intercept + sum(t[tuple(b[j] for j in on)] for on, t in model.tables) for b in bins]
    assert np.allclose(model.logits(x[:5]), sums)


def test_features_of_odd_texts():
    for text in cases.texts():
        assert np.isfinite(quality_gam.features(text)).all()
    assert not quality_gam.features(None).any() and not quality_gam.features("").any()


def labelled(spark):
    rows, labels = [], []
    for i in range(160):
        bad = i % 2
        rows.append((i, " ".join(f"w{i}!!".upper() if bad else f"w{i + k}" for k in range(40)), "en", "src0", 0))
        labels.append((i, 1 - bad, 0))
    return spark.createDataFrame(rows, cases.SCHEMA), spark.createDataFrame(labels, LABELS)


def test_quality_of_odd_rows(spark):
    docs, labels = labelled(spark)
    model = quality_gam.train(docs, labels)
    odd = cases.documents(spark, extra=True)
    kept = quality_gam.keep(odd, model)
    assert kept.columns == odd.columns
    scored = quality_gam.score_documents(odd, labels)
    assert scored.count() == odd.count() and scored.filter("score is null or score < 0 or score > 1").count() == 0
    assert quality_gam.score_documents(cases.empty(spark), labels).count() == 0
    none = quality_gam.score_documents(docs, labels.limit(0)).select("score").distinct().collect()
    assert [r.score for r in none] == [0.5]


def kernel(a, b):
    """The gapped subsequence kernel, by listing every subsequence of both strings."""
    def listed(s):
        s, out = toxicity.symbols(s).tolist(), {}
        for i in range(len(s)):
            for j in range(i + 1, min(i + toxicity.SPAN, len(s))):
                for k in range(j + 1, min(i + toxicity.SPAN, len(s))):
                    u = (s[i], s[j], s[k])
                    out[u] = out.get(u, 0) + toxicity.LAMBDA ** (k - i - 2)
        return out

    x, y = listed(a), listed(b)
    return sum(v * y.get(u, 0) for u, v in x.items())


def fast_kernel(a, b):
    weights = np.zeros(1 << 18)
    _, u, w = toxicity.subsequences(toxicity.symbols(b))
    np.add.at(weights, u, w)
    _, u, w = toxicity.subsequences(toxicity.symbols(a))
    return float((weights[u] * w).sum())


def test_kernel_equals_its_definition():
    for a, b in (("idiot", "i-d-iot"), ("abcabc", "cab"), ("", "x"), ("Über Ärger", "über"), ("aaaa", "aaa")):
        assert np.isclose(fast_kernel(a, b), kernel(a, b))


def test_window_margins_are_sums_of_weights():
    draw = np.random.default_rng(1)
    model = toxicity.Model(draw.normal(size=1 << 18).astype(np.float32), 0.25)
    for text in ("", "a", "ab", "some words here", cases.prose(4, 20)):
        s = toxicity.symbols(text)
        starts, u, w = toxicity.subsequences(s)
        each = np.bincount(starts, model.weights[u] * w, minlength=max(1, len(s) - 2)) if len(starts) else np.zeros(1)
        n = min(toxicity.WINDOW, len(s) - 2)
        want = [each[i : i + n].sum() + 0.25 for i in range(len(s) - 2 - n + 1)] if n > 0 else [0.25]
        assert np.allclose(model.margins(s), want, atol=1e-4)


def test_inserted_characters_are_tolerated(spark):
    """The insult in the labels is plain; in new texts it has marks put in."""
    draw, rows, labels = random.Random(3), [], []
    for i in range(300):
        w = cases.prose(i, 60).replace("w", "ta").split()
        if i % 3 == 0:
            for _ in range(3):
                w[draw.randrange(60)] = draw.choice(["blockhead", "nitwit"])
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(i % 3 == 0)))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, LABELS)
    model = toxicity.train(docs, labels)
    calm = cases.prose(999, 60).replace("w", "ta")
    scores = model.scores([calm, calm + " n.itwit", calm + " block-head you nit wit", calm + " blockhead nitwit"])
    assert scores[0] < 0.7 and (scores[1:] > scores[0]).all() and (scores[2:] >= 0.7).all()
    odd = cases.documents(spark, extra=True)
    out = toxicity.score_documents(odd, labels)
    assert out.count() == odd.count() and out.filter("score is null or score < 0 or score > 1").count() == 0
    assert toxicity.score_documents(cases.empty(spark), labels).count() == 0
    none = toxicity.score_documents(docs, labels.limit(0)).filter("score > 0.01").count()
    assert none == 0


def test_secrets_are_told_from_words(spark):
    draw, rows = random.Random(5), []
    for i in range(200):
        code = "".join(draw.choice("0123456789abcdef") for _ in range(40))
        kind = i % 4
        text = (f'before token = "{code}" after', "a longwordmadeofletters here", f"commit {draw.randrange(10**17, 10**18)} done", f"AKIA{code[:16].upper()} x")[kind]
        rows.append((i, cases.prose(i, 20) + " " + text, "src/test" if i % 2 else "src"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({c: F.lit("clash") for c in cases.CLASHING})
    found = secrets.find(docs, quality_gam.fold(3) == 0).collect()
    assert len(found) == 200
    held = [r for r in found if r.held_out]
    assert held and np.mean([r.is_secret == (r.doc_id % 4 in (0, 3)) for r in held]) >= 0.95
    assert {r.at for r in found if r.doc_id % 4 == 0} == {23}


def test_upper_case_codes_are_secrets(spark):
    draw, rows = random.Random(6), []
    for i in range(200):
        code = "".join(draw.choice("0123456789abcdef") for _ in range(40))
        text = (f'token = "{code}"', f'TOKEN = "{code.upper()}"', "a longwordmadeofletters here", f"commit {draw.randrange(10**17, 10**18)} done")[i % 4]
        rows.append((i, cases.prose(i, 20) + " " + text, "src"))
    found = secrets.find(spark.createDataFrame(rows, "doc_id long, text string, source string"), quality_gam.fold(3) == 0).collect()
    assert len(found) == 200 and all(r.labelled == (r.doc_id % 4 < 2) for r in found)
    held = [r for r in found if r.held_out and r.doc_id % 4 == 1]
    assert held and np.mean([r.is_secret for r in held]) >= 0.95
    assert {r.labelled for r in secrets.find(spark.createDataFrame([(1, 'TOKEN = "0123456789abcdefABCDEF01"', "src")], "doc_id long, text string, source string"), F.lit(True)).collect()} == {0}


def test_secrets_of_odd_rows(spark):
    docs = cases.documents(spark)
    more = docs.unionByName(spark.createDataFrame([(None, 'password="0123456789abcdef01" ' + "x" * 500, None, None, 1)], cases.SCHEMA))
    found = secrets.find(more, F.lit(False)).collect()
    assert {r.length for r in found} == {18, 500} and all(r.score is not None for r in found)
    assert secrets.find(cases.empty(spark), F.lit(False)).count() == 0
    assert secrets.find(docs.drop("source"), F.lit(True)).count() == 0
