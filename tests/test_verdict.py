"""The closed form against a plain loop over the lines."""

import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tallyhouse import session
from tallyhouse.operators import verdict
from tallyhouse.schemas import RAW_COLUMNS
from tallyhouse.sources.files import gate_counts, in_order

CHECKS = verdict.Checks("2016-08-02")
NO_CUSTOMER = {"", "nan", "none", "null", "unknown"}


def loop(rows):
    """Line by line, keeping the last customer per invoice and the keys seen."""
    context, seen, out = {}, set(), {}
    for at, r in sorted(rows.items()):
        invoice = (r["InvoiceNo"] or "").strip().upper()
        raw = r["CustomerID"] or ""
        customer, blank = raw, raw.strip() == ""
        if invoice and raw.strip().lower() in NO_CUSTOMER and invoice in context:
            customer, blank = context[invoice], False
        clean = "" if customer.strip().lower() in NO_CUSTOMER else customer.strip()
        clean = clean[:-2] if clean.endswith(".0") else clean
        price, units = float(r["UnitPrice"]), int(float(r["Quantity"]))
        reason = None
        if not invoice:
            reason = "ingest_invalid"
        elif blank:
            reason = "missing_required_field"
        elif not clean or len(invoice) < 5 or units == 0:
            reason = "validation_failed"
        elif price == 0:
            reason = "unit_price_zero_quarantine"
        elif (invoice, r["StockCode"]) in seen:
            reason = "duplicate"
        else:
            seen.add((invoice, r["StockCode"]))
            context[invoice] = clean
        out[at] = (clean or None, reason)
    return out


def random_lines(seed, count):
    draw = random.Random(seed)
    rows = {}
    for at in range(count):
        rows[at] = {
            "InvoiceNo": draw.choice(["536365", " 536366", "c536367", "536368", "12", "", "536365"]),
            "StockCode": draw.choice("ABCDEFGH"),
            "Description": "x",
            "Quantity": draw.choice(["1", "2", "-3", "0", "5"]),
            "InvoiceDate": "2010-12-01 08:26:00",
            "UnitPrice": draw.choice(["1.5", "2", "3", "0"]),
            "CustomerID": draw.choice(["", "", None, "nan", "Unknown", "1.0", "2", ".0"]),
            "Country": "UK",
        }
    return rows


def frame(spark, rows):
    data = [(at, at, *[r[c] for c in RAW_COLUMNS]) for at, r in rows.items()]
    columns = ", ".join(f"{c} string" for c in RAW_COLUMNS)
    df = spark.createDataFrame(data, f"pos bigint, row_id bigint, {columns}")
    return df.withColumn("seq", F.lit(0).cast("bigint")).repartition(5)


def judged(spark, rows, **options):
    out = verdict.judge(frame(spark, rows), CHECKS, **options)
    return {r.pos: (r.customer_id, r.reject_reason) for r in out.collect()}


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("hot_rows", [verdict.HOT_ROWS, 30, 4])
def test_equals_the_loop(spark, seed, hot_rows):
    rows = random_lines(seed, 400)
    expected = loop(rows)
    found = judged(spark, rows, hot_rows=hot_rows)
    # The customer of a line that is not part of any invoice is not filled.
    for at, (customer, reason) in expected.items():
        assert found[at][1] == reason, (at, rows[at])
        if reason != "ingest_invalid":
            assert found[at][0] == customer, (at, rows[at])


def test_one_invoice_holds_a_third_of_all_lines(spark):
    rows = random_lines(3, 600)
    for at in range(0, 600, 3):
        rows[at] = rows[at] | {"InvoiceNo": "777777", "StockCode": f"S{at % 40}"}
    expected = loop(rows)
    found = judged(spark, rows, hot_rows=20)
    assert {a: r for a, (_, r) in found.items()} == {a: r for a, (_, r) in expected.items()}


def test_copies_that_share_a_position(spark):
    """A third of the lines are one line over and over; exactly one is kept."""
    line = {c: "x" for c in RAW_COLUMNS} | {
        "InvoiceNo": "536365", "StockCode": "A", "Quantity": "1", "UnitPrice": "2",
        "InvoiceDate": "2010-12-01", "CustomerID": "",
    }
    opener = line | {"StockCode": "B", "CustomerID": "9.0"}
    data = [(0, 0, *[opener[c] for c in RAW_COLUMNS])]
    data += [(5, i, *[line[c] for c in RAW_COLUMNS]) for i in range(1, 31)]
    columns = ", ".join(f"{c} string" for c in RAW_COLUMNS)
    raw = spark.createDataFrame(data, f"pos bigint, row_id bigint, {columns}")
    for hot_rows in (verdict.HOT_ROWS, 10):
        out = verdict.judge(raw, CHECKS, hot_rows).collect()
        kept = [r for r in out if r.reject_reason is None]
        assert sorted((r.stock_code, r.customer_id) for r in kept) == [("A", "9"), ("B", "9")]
        assert sum(r.reject_reason == "duplicate" for r in out) == 29


def test_hot_invoice_with_leaps_in_its_numbers(spark):
    """All lines of an invoice from one scan task, one from a far later task."""
    rows = {at: r | {"InvoiceNo": "777777", "StockCode": f"S{at}"} for at, r in random_lines(6, 300).items()}
    rows[5 << 33] = rows[0] | {"StockCode": "LAST", "CustomerID": "", "UnitPrice": "2", "Quantity": "1"}
    expected = loop(rows)
    found = judged(spark, rows, hot_rows=20)
    assert {a: r for a, (_, r) in found.items()} == {a: r for a, (_, r) in expected.items()}
    chunks = {at // 5 for at in rows}
    assert max(sum(at // 5 == c for at in rows) for c in chunks) <= 5


def test_gate_failures_keep_their_own_reason(spark):
    rows = random_lines(4, 5)
    rows[0]["Quantity"] = "abc"
    rows[1]["UnitPrice"] = "£2.55"
    raw = frame(spark, rows)
    found = {r.pos: r.reject_reason for r in verdict.judge(raw, CHECKS).collect()}
    assert found[0] == found[1] == "ingest_invalid"
    counts = gate_counts(raw).first()
    assert counts.records_read == 5
    assert counts.records_invalid == sum(r == "ingest_invalid" for r in found.values())


def test_summary_counts_every_line_once(spark):
    rows = random_lines(5, 200)
    out = verdict.judge(frame(spark, rows), CHECKS)
    reasons = defaultdict(int)
    for _, reason in loop(rows).values():
        reasons[reason] += 1
    total = verdict.summary(out).first()
    assert total.total_records == 200 - reasons["ingest_invalid"]
    assert total.records_cleaned == reasons[None]
    assert total.duplicates_removed == reasons["duplicate"]
    assert verdict.accepted(out).count() + verdict.rejected(out).count() == 200


def test_ordinary_plan_has_one_shuffle(spark):
    raw = in_order(spark.createDataFrame([tuple("x" for _ in RAW_COLUMNS)], RAW_COLUMNS))
    plan = verdict.judge(raw, CHECKS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_lines_of_ordinary_invoices_are_sorted_twice_at_most(spark, capsys):
    raw = spark.createDataFrame([(0, 0, *["1"] * 8)], ["pos", "row_id", *RAW_COLUMNS])
    verdict.judge(raw, verdict.Checks("2016-08-02")).explain()
    assert capsys.readouterr().out.count("- Sort ") == 2


def test_shuffles_start_from_the_bytes_of_the_files(spark, tmp_path, monkeypatch):
    """One scan task however large its file: the number of tasks does not tell the input."""
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    spark.range(100_000).coalesce(1).write.parquet(str(tmp_path / "rows"))
    monkeypatch.setattr(session, "SHUFFLE_BYTES", 4096)
    with_files = spark.read.parquet(str(tmp_path / "rows"))
    held = sum(f.stat().st_size for f in (tmp_path / "rows").glob("*.parquet"))
    session.fit_shuffles(with_files)
    assert int(spark.conf.get(key)) == held // 4096 > 50
    session.fit_shuffles(spark.range(10).coalesce(1))
    assert int(spark.conf.get(key)) == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_of_lines_with_one_row_id_one_is_accepted(spark):
    line = ("536365", "85123A", "LAMP", "6", "2010-12-01 08:26:00", "2.55", "17850", "France")
    raw = spark.createDataFrame([(7, 1, *line), (7, 1, *line)], ["pos", "row_id", *RAW_COLUMNS])
    found = verdict.judge(raw, verdict.Checks("2016-08-02")).select("reject_reason").collect()
    assert sorted(str(r.reject_reason) for r in found) == ["None", "duplicate"]


def test_what_earlier_loads_accepted_crosses_the_network_with_the_lines(spark):
    rows = [["C540001", "A1", "LAMP", "1", "2011-01-05", "2.5", "", "France"], ["540002", "A1", "LAMP", "1", "2011-01-05", "2.5", "7", "France"]]
    raw = in_order(spark.createDataFrame(rows, ", ".join(f"{c} string" for c in RAW_COLUMNS)))
    known = [("C540001", "", "9"), ("540002", "A1", "7")]
    prior = spark.createDataFrame(known, "invoice string, stock_code string, customer_id string")
    for hot_rows in (verdict.HOT_ROWS, 0):
        found = verdict.judge(raw, verdict.Checks("2012-01-01"), hot_rows, prior=prior)
        assert {r.invoice: (r.customer_id, r.reject_reason) for r in found.collect()} == {"C540001": ("9", None), "540002": ("7", "duplicate")}
        if hot_rows:
            plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
            assert len(re.findall(r"Exchange hashpartitioning\(_group", plan)) == 1


def test_lines_of_oversized_invoices_are_checked_once(spark):
    """They are read several times, so from what was stored of them."""
    raw = in_order(spark.createDataFrame([("540001", "A1", "LAMP", "1", "2011-01-05", "2.5", "7", "France")], RAW_COLUMNS))
    found = verdict.judge(raw, verdict.Checks("2012-01-01"), 0)
    assert any("/oversized-" in f for f in found.inputFiles()) and found.first().reject_reason is None


def test_texts_cross_the_network_packed(spark, capsys):
    """One text of those that are checked, one of those that are carried along; each comes back as it was."""
    text = ["536365", "85123A", "LAMP\x1f\x1b", "6", "2010-12-01 08:26:00", "2.55", "17850", None]
    raw = in_order(spark.createDataFrame([text], ", ".join(f"{c} string" for c in RAW_COLUMNS)))
    found = verdict.judge(raw, verdict.Checks("2016-08-02"))
    assert [found.first()[c] for c in RAW_COLUMNS] == text
    found.explain("formatted")
    sent = re.search(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", capsys.readouterr().out).group(1)
    assert "_texts" in sent and "_carried" in sent and not any(re.search(rf"\b{c}#", sent) for c in RAW_COLUMNS)
