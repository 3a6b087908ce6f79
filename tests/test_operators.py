"""Operators on small frames against brute force."""

import json
import random
import re
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.functions import rules
from tallyhouse.operators import day_counts, dimensions, duplicates, fact, keys, lineage, missing, outliers, snapshots
from tallyhouse.operators.carry import carry_last
from tallyhouse.operators.quantiles import exact_quantiles
from tallyhouse.sources.testdata import sales_view
from tests.conftest import SF_DIR


@pytest.mark.parametrize("backward", [False, True])
def test_carry_last(spark, backward):
    draw = random.Random(7)
    rows = [
        (draw.choice("abc"), at, at // 7, draw.choice([None, None, "x", "y", "z"]))
        for at in range(200)
    ]
    df = spark.createDataFrame(rows, "k string, at int, chunk int, v string")
    out = carry_last(df, ["k"], "chunk", "at", "v", "found", backward).collect()
    for r in out:
        side = [
            (at, v)
            for k, at, _, v in rows
            if k == r.k and v is not None and (at > r["at"] if backward else at < r["at"])
        ]
        nearest = (min(side) if backward else max(side))[1] if side else None
        assert r.found == nearest


@pytest.mark.parametrize(
    "values",
    [[3.0], [1.0, 1.0, 1.0], [float(i) ** 3 for i in range(101)], [0.01, 0.02, 1e9], [-5.0, 2.5, None, 7.0]],
)
def test_exact_quantiles(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    wanted = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}
    row = exact_quantiles(df, "v", wanted).first()
    present = [v for v in values if v is not None]
    assert list(row) == pytest.approx([np.percentile(present, q * 100) for q in wanted.values()])


def test_one_value_far_out_does_not_gather_the_rest(spark, monkeypatch):
    """No step that is put in order has more values than allowed, and the answer stays exact."""
    from tallyhouse.operators import quantiles

    kept = []
    span_of = quantiles._span_of

    def watched(counted, *rest):
        first, last, before = span_of(counted, *rest)
        kept.append(counted.filter(F.col("x").between(first, last)).count())
        return first, last, before

    monkeypatch.setattr(quantiles, "_span_of", watched)
    df = spark.range(20_001).select(F.when(F.col("id") == 20_000, 1e12).otherwise(F.col("id").cast("double")).alias("v"))
    row = exact_quantiles(df, "v", {"q": 0.25, "m": 0.5}, most=100).first()
    assert (row.q, row.m) == (5000.0, 10000.0)
    assert max(kept) <= 100


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert exact_quantiles(df, "v", {"m": 0.5}).first().m is None


def test_outliers(spark):
    values = [1.0, 2.0, 2.0, 3.0, 2.5, 100.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r.v for r in outliers.flag_iqr(df, "v").filter("is_outlier").collect()] == [100.0]
    assert [r.v for r in outliers.flag_zscore(df, "v", 2).filter("is_outlier").collect()] == [100.0]
    near = outliers.flag_iqr(df, "v", approximate=True).filter("is_outlier").collect()
    assert [r.v for r in near] == [100.0]
    flat = spark.createDataFrame([(1.0,), (1.0,)], "v double")
    assert outliers.flag_zscore(flat, "v", 0.0).filter("is_outlier").isEmpty()


def test_fills(spark):
    df = spark.createDataFrame(
        [(0, 1.0, "a", " "), (1, None, "b", "q"), (2, 4.0, "b", None), (3, 10.0, "", "r")],
        "i int, n double, s string, t string",
    )

    def column(strategies, name):
        return [r[name] for r in missing.fill(df, strategies, F.col("i")).orderBy("i").collect()]

    assert column({"n": "fill_mean"}, "n") == [1.0, 5.0, 4.0, 10.0]
    assert column({"n": "fill_median"}, "n") == [1.0, 4.0, 4.0, 10.0]
    assert column({"n": "fill_zero"}, "n") == [1.0, 0.0, 4.0, 10.0]
    assert column({"s": "fill_mode"}, "s") == ["a", "b", "b", "b"]
    assert column({"t": "fill_unknown"}, "t") == ["Unknown", "q", "Unknown", "r"]
    assert column({"t": "drop"}, "i") == [1, 3]
    with pytest.raises(ValueError):
        missing.fill(df, {"t": "guess"})


def test_mode_prefers_the_first_seen_of_equals(spark):
    df = spark.createDataFrame([(0, "b"), (1, "a"), (2, "a"), (3, "b"), (4, "")], "i int, s string")
    assert df.select(missing.mode_of(df, "s", F.col("i"))).first()[0] == "b"


def test_deduplicate(spark):
    rows = [("k", 1), ("k", 2), ("l", 3), ("k", 4)]
    df = spark.createDataFrame(rows, "k string, at int")

    def kept(strategy):
        out = duplicates.deduplicate(df, ["k"], ["at"], strategy)
        return sorted(r["at"] for r in out.collect())

    assert kept(duplicates.KEEP_FIRST) == [1, 3]
    assert kept(duplicates.KEEP_LATEST) == [3, 4]
    assert kept(duplicates.REMOVE_ALL) == [3]
    count = duplicates.duplicate_count(df, ["k"]).first()
    assert (count.duplicate_lines, count.duplicated_keys) == (2, 1)
    with pytest.raises(ValueError):
        kept("keep_some")


def test_dedup_limits_each_task_before_the_shuffle(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 3)
    plan = duplicates.deduplicate(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_keys_are_dense_and_stable(spark):
    first = spark.createDataFrame([(f"c{i}",) for i in range(300)], "n string")
    empty = spark.createDataFrame([], "n string, k bigint")
    old = keys.get_or_create(empty, first, "n", "k").drop("is_new")
    assert sorted(r.k for r in old.collect()) == list(range(1, 301))
    more = spark.createDataFrame([(f"c{i}",) for i in range(200, 450)], "n string")
    both = {r.n: (r.k, r.is_new) for r in keys.get_or_create(old, more, "n", "k").collect()}
    assert {n: k for n, (k, new) in both.items() if not new} == {r.n: r.k for r in old.collect()}
    assert sorted(k for k, new in both.values() if new) == list(range(301, 451))


def _sales(spark, rows):
    df = spark.createDataFrame(rows, "customer_id string, at int, country string")
    start = F.lit("2010-01-01").cast("timestamp_ntz")
    hours = F.expr("make_dt_interval(0, at, 0, 0)")
    return df.withColumn("transaction_datetime", start + hours)


def test_history_and_as_of(spark):
    draw = random.Random(5)
    rows = [(draw.choice("ab"), at, draw.choice(["UK", "FR"])) for at in range(0, 300, 3)]
    lines = _sales(spark, rows)
    history = dimensions.customer_history(lines)
    base = datetime(2010, 1, 1)
    expected = []
    for customer in "ab":
        mine = [(base + timedelta(hours=at), c) for k, at, c in rows if k == customer]
        turns = [x for i, x in enumerate(mine) if i == 0 or mine[i - 1][1] != x[1]]
        for i, (at, country) in enumerate(turns):
            expected.append((customer, country, at, turns[i + 1][0] if i + 1 < len(turns) else None))
    found = [tuple(r)[:4] for r in history.collect()]
    assert sorted(found, key=str) == sorted(expected, key=str)
    assert history.filter("is_current").count() == 2

    later = _sales(spark, [("a", 10_000, "XX"), ("b", 1, "XX"), ("zz", 5, "XX")])
    both = lines.unionByName(later)
    for r in dimensions.as_of(both, history).collect():
        at = r.transaction_datetime
        valid = [e for e in expected if e[0] == r.customer_id and e[2] <= at and (e[3] is None or at < e[3])]
        assert r.version_country == (valid[0][1] if valid else None)


def test_product_attributes(spark):
    rows = [
        (0, 0, "A", "Box", "Merchandise", "General", False),
        (0, 1, "A", "Red Box", "Shipping", "Postage", False),
        (1, 0, "A", "Big Box", "Merchandise", "General", True),
    ]
    df = spark.createDataFrame(
        rows,
        "seq bigint, pos bigint, stock_code string, description string, category string, subcategory string, is_gift boolean",
    )
    assert [tuple(r) for r in dimensions.product_attributes(df).collect()] == [
        ("A", "Red Box", "Merchandise", "General", True)
    ]


def test_upsert_keeps_keys_and_overwrites_attributes(spark):
    def attributes(rows):
        return spark.createDataFrame(
            rows, "stock_code string, description string, category string, subcategory string, is_gift boolean"
        )

    old = dimensions.new_products(
        attributes([("A", "Old", "M", "G", False), ("B", "Stay", "M", "G", False)]), F.lit(0), "2016-01-01", "CSV"
    )
    new = dimensions.upsert_products(
        old, attributes([("A", "New", "S", "P", True), ("C", "Add", "M", "G", False)]), "2016-02-01"
    )
    before = {r.stock_code: r.product_key for r in old.collect()}
    after = {r.stock_code: r for r in new.collect()}
    assert {k: after[k].product_key for k in before} == before
    assert (after["A"].description, after["A"].is_gift, after["B"].description) == ("New", True, "Stay")
    assert after["C"].product_key == 3
    assert str(after["A"].updated_at) == "2016-02-01 00:00:00"
    assert str(after["B"].updated_at) == "2016-01-01 00:00:00"


def test_archive_holds_old_images(spark):
    old = spark.createDataFrame([(1, 5, None, 1), (2, 6, "x", 1), (3, 7, "y", 1)], "k int, q int, s string, version_id int")
    new = spark.createDataFrame([(1, 5, None, 1), (2, 9, "x", 2)], "k int, q int, s string, version_id int")
    out = {r.k: r for r in snapshots.change_archive(old, new, ["k"]).collect()}
    assert set(out) == {2, 3}
    assert (out[2].operation, out[2].version_id, out[3].operation, out[3].version_id) == ("UPDATE", 2, "DELETE", 1)
    assert '"q":6' in out[2].payload


def test_snapshots_read_only_what_differs(spark, tmp_path):
    """Two of 5,000 rows change: two buckets are read, and both ways find the plain loop's rows."""
    rows = spark.range(5000).selectExpr("id AS k", "if(id % 3 = 0, NULL, id * 2) AS v", "1 AS version_id")
    later = rows.filter("k <> 7").withColumn("v", F.expr("if(k = 9, 1, v)"))
    paths = [str(tmp_path / name) for name in ("before", "after")]
    for df, path in zip((rows, later), paths, strict=True):
        snapshots.write(df, ["k"], path, 16)
    found = snapshots.stored_changes(spark, *paths, rows.schema, ["k"])
    expected = [(7, "DELETE", 1, '{"k":7,"v":14,"version_id":1}'), (9, "UPDATE", 1, '{"k":9,"version_id":1}')]
    assert sorted(map(tuple, found.collect())) == expected
    assert sorted(map(tuple, snapshots.change_archive(rows, later, ["k"]).collect())) == expected
    plan = found._jdf.queryExecution().executedPlan().toString()
    buckets = [r[0] for r in rows.filter("k IN (7, 9)").select(snapshots.spots(["k"], 16)["_bucket"]).distinct().collect()]
    named = [re.findall(r"\d+", part) for part in re.findall(r"PartitionFilters: \[[^\]]*?_bucket#\d+ IN \(([\d,]*)\)", plan)]
    assert len(named) >= 2 and all(set(map(int, n)) == set(buckets) for n in named), plan


def test_equal_snapshots_read_no_rows(spark, tmp_path):
    rows = spark.range(100).selectExpr("id AS k", "1 AS version_id")
    for name in ("a", "b"):
        snapshots.write(rows, ["k"], str(tmp_path / name), 8)
    found = snapshots.stored_changes(spark, str(tmp_path / "a"), str(tmp_path / "b"), rows.schema, ["k"])
    assert found.collect() == []
    assert "FileScan" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_snapshots_of_nothing_and_without_keys(spark, tmp_path):
    some = spark.createDataFrame([(1, "a", 1), (None, "b", 1), (None, "b", 1)], "k int, s string, version_id int")
    none = some.limit(0)
    for name, df in (("some", some), ("none", none)):
        snapshots.write(df, ["k"], str(tmp_path / name), 8)
    some_at, none_at = str(tmp_path / "some"), str(tmp_path / "none")
    gone = snapshots.stored_changes(spark, some_at, none_at, some.schema, ["k"]).collect()
    assert [(r.k, r.operation) for r in gone] == [(1, "DELETE")]
    assert snapshots.stored_changes(spark, none_at, some_at, some.schema, ["k"]).collect() == []


def test_fingerprint_ignores_order(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2), ("y", 2)], "s string, i int")
    b = spark.createDataFrame([("y", 2), ("x", 1), ("y", 2)], "s string, i int")
    c = spark.createDataFrame([("y", 2), ("x", 1)], "s string, i int")
    prints = [df.select(lineage.fingerprint(df, ["s", "i"])).first()[0] for df in (a, b, c)]
    assert prints[0] == prints[1] != prints[2]
    assert len(prints[0]) == 16


def test_own_rules(spark):
    df = spark.createDataFrame([("12345", "UK"), ("x", None)], "InvoiceNo string, Country string")
    shout = rules.python_rule("shout", ["Country"], lambda v: None if v is None else v + "!")
    off = rules.Rule("off", ["InvoiceNo"], lambda c: F.lit("gone"), enabled=False)
    out = rules.apply_cleaning(df, [shout, off]).orderBy("InvoiceNo").collect()
    assert [tuple(r) for r in out] == [("12345", "UK!"), ("x", None)]
    digits = rules.Rule("digits", ["InvoiceNo"], lambda c: c.rlike("^[0-9]+$"))
    soft = rules.Rule("has_country", ["Country"], lambda c: c.isNotNull(), severity="WARNING")
    checked = df.select(
        rules.first_failure([digits, soft]).alias("failed"), rules.warnings([digits, soft]).alias("soft")
    ).collect()
    assert [tuple(r) for r in checked] == [(None, []), ("digits", ["has_country"])]
    counts = {r.rule_name: (r.rows_applied, r.rows_changed) for r in rules.rule_counts(df, [shout, off]).collect()}
    assert counts == {"shout": (2, 1)}


def test_orders_meet_their_customers_before_the_lines(spark):
    """So that lines are shuffled once for both."""
    view = sales_view(spark, SF_DIR)
    plan = view._jdf.queryExecution().optimizedPlan().toString().split("\n")
    at = next(i for i, line in enumerate(plan) if "Join Inner" in line and "c_custkey" in line)
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    below = []
    for line in plan[at + 1 :]:
        if depth(line) <= depth(plan[at]):
            break
        below.append(line)
    assert below and not any("l_orderkey" in line for line in below)


def test_digests_tell_a_null_from_its_neighbour(spark):
    """The hash of a row passes over NULL, so (NULL, x) and (x, NULL) would read alike."""
    schema = "k int, a int, b int, version_id int"
    old, new = (spark.createDataFrame([row], schema) for row in ((1, None, 5, 1), (1, 5, None, 1)))
    assert [r.operation for r in snapshots.change_archive(old, new, ["k"]).collect()] == ["UPDATE"]
    found = snapshots.digests(old.withColumns(snapshots.spots(["k"])), ["a", "b"])
    assert "md5" not in found._jdf.queryExecution().toString()


def test_the_sales_view_shuffles_no_more_than_texts_are_made_of(spark):
    """Prices, taxes and ship dates end in a line's place and its price before the first join."""
    top, *below = sales_view(spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    assert "l_extendedprice" not in top and "l_shipdate" not in top
    first = next(i for i, line in enumerate(below) if "l_extendedprice" in line)
    assert not any("Join" in line and "l_orderkey" in line for line in below[first:])


def test_the_bitmaps_of_days_are_made_where_whole_sets_are(spark):
    """No task makes a bitmap of its own few keys, so none is sorted or shuffled."""
    fact = spark.createDataFrame([("2020-01-01", 7, 9)], "t string, customer_key long, product_key long").withColumn("transaction_datetime", F.col("t").cast("timestamp_ntz"))
    plan = day_counts.day_keys(fact, ("customer_key",))._jdf.queryExecution().executedPlan().toString().split("\n")
    shuffled = [i for i, line in enumerate(plan) if "Exchange" in line]
    made = [i for i, line in enumerate(plan) if "partial_bitmap_construct_agg" in line]
    assert len(shuffled) == 1 and made and max(made) < shuffled[0]


def test_sales_rows_are_shuffled_with_their_texts_packed(spark):
    line = [("S1", "7", "2020-01-01 10:00:00", "SALE", None, "C\x1fV")]
    lines = spark.createDataFrame(line, "stock_code string, customer_id string, t string, transaction_type string, batch_id string, data_source string")
    lines = lines.withColumn("transaction_datetime", F.col("t").cast("timestamp_ntz")).withColumn("transaction_date", F.to_date("t"))
    dates = spark.createDataFrame([(20200101, "2020-01-01")], "date_key int, d string").select("date_key", F.col("d").cast("date").alias("date_value"))
    customers = spark.createDataFrame([(3, "7", True)], "customer_key long, customer_id string, is_current boolean")
    products = spark.createDataFrame([(5, "S1")], "product_key long, stock_code string")
    found = fact.resolve_keys(lines, dates, customers.hint("merge"), products.hint("merge"))
    row = found.first()
    assert (row.date_key, row.customer_key, row.product_key) == (20200101, 3, 5)
    assert (row.transaction_type, row.batch_id, row.data_source) == ("SALE", None, "C\x1fV")
    plan = found._jdf.queryExecution().optimizedPlan().toString().split("\n")
    joins = [i for i, line in enumerate(plan) if "Join LeftOuter" in line]
    assert len(joins) == 3 and "_day" in plan[joins[0]] and not any("batch_id" in line and "_texts" not in line for line in plan[joins[0] : joins[2]])


def test_old_images_cross_the_network_with_their_texts_packed(spark, tmp_path):
    schema = "k int, a string, n int, b string, version_id int"
    old = spark.createDataFrame([(1, "x\x1f", None, None, 1), (2, None, 5, "", 1), (3, "", 6, "é", 1), (4, "y", 7, "z", 1)], schema)
    new = spark.createDataFrame([(1, "x\x1f", None, None, 1), (2, "", 5, None, 2), (4, "y", 8, "z", 2)], schema)
    found = snapshots.change_archive(old, new, ["k"])
    for name, rows in (("old", old), ("new", new)):
        snapshots.write(rows, ["k"], str(tmp_path / name), 4)
    stored = snapshots.stored_changes(spark, str(tmp_path / "old"), str(tmp_path / "new"), old.schema, ["k"])
    for changes in (found, stored):
        rows = {r.k: (r.operation, r.version_id, json.loads(r.payload)) for r in changes.collect()}
        assert rows == {
            2: ("UPDATE", 2, {"k": 2, "n": 5, "b": "", "version_id": 1}),
            3: ("DELETE", 1, {"k": 3, "a": "", "n": 6, "b": "é", "version_id": 1}),
            4: ("UPDATE", 2, {"k": 4, "a": "y", "n": 7, "b": "z", "version_id": 1}),
        }
    assert "_old_texts" in found._jdf.queryExecution().optimizedPlan().toString()
