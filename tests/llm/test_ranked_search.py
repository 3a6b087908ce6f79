import math
import random
import re
from collections import Counter

import pytest

from tallyhouse.llm import ranked_search
from tests.llm import cases

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall(cases.ascii_lower(text or ""))


def plain_search(docs, items, top=10):
    """docs, items: (id, text); all documents against all items."""
    held = [(i, Counter(t), len(t)) for i, t in ((i, plain_terms(t)) for i, t in docs) if t]
    big_n, big_l = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        found = []
        for doc_id, tf, n in held:
            m = 25 + 75 * n * big_n // big_l
            score = sum(math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 8 * m)) for t in plain_terms(text) if t in tf)
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0))
        out += [(item, rank, None if none else doc_id, -s) for rank, (s, none, doc_id) in enumerate(sorted(found)[:top], 1)]
    return sorted(out, key=repr)


def searched(spark, docs, items, **how):
    found = ranked_search.search(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string"), **how
    )
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in found.collect()), key=repr)


def test_terms():
    for t in [*cases.texts(), "A_b-c1 ÄÖ\x85x\xa0y z", "x\x7fy"]:
        assert [w.decode() for w in ranked_search.terms((t or "").encode())] == plain_terms(t)


@pytest.mark.parametrize("how", [{}, {"shard": 7, "bundle": 2}, {"shard": 1, "bundle": 1, "top": 3}])
def test_equals_all_pairs(spark, how):
    """Rare and frequent words, one word a third of all documents have, more equal scores than places."""
    draw = random.Random(4)
    docs = [(i, cases.prose(i, draw.choice([3, 20, 80]), draw.choice([30, 400])) + (" Common" if i % 3 == 0 else "")) for i in range(150)]
    docs += [(1000 - i, "equal scores here") for i in range(25)] + [(2000 + i, t) for i, t in enumerate(cases.texts())]
    items = [(i, cases.prose(500 + i, 12, 60)) for i in range(9)] + [(20, "COMMON common equal"), (21, "nowhere"), (22, None), (23, ""), (24, docs[3][1])]
    items += [(25, "w1 rare-one"), (26, docs[len(docs) - 9][1] or "one")]
    assert searched(spark, docs, items, **how) == plain_search(docs, items, how.get("top", 10))


def test_nulls_repeated_rows_and_clashing_names(spark):
    docs, items = cases.documents(spark, extra=True), [(1, "equal rows"), (1, "an id twice at all"), (2, "one more line")]
    found = ranked_search.search(docs, spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' AS term", "0 AS item", "0 AS shard"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in found.collect()), key=repr) == plain_search(rows, items)


def test_empty_tables(spark):
    docs, none = cases.documents(spark), spark.createDataFrame([], "item_id long, text string")
    items = spark.createDataFrame([(1, "one")], "item_id long, text string")
    assert ranked_search.search(docs, none).count() == 0
    assert ranked_search.search(cases.empty(spark), items).count() == 0
    assert ranked_search.search(cases.empty(spark), none).columns == ["item_id", "rank", "doc_id", "score"]
