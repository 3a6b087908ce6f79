"""Loads end to end: files, repeated batches, dimensions, streams."""

import csv
import os
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import analytics, catalog, day_counts, quality
from tallyhouse.operators.verdict import Checks
from tallyhouse.operators.feed_state import FeedState, _positions, bucket_of
from tallyhouse.plans.commits import CommitLog
from tallyhouse.plans.warehouse import Warehouse, _tail, check_table
from tallyhouse.schemas import RAW_COLUMNS
from tallyhouse.sources.files import from_table, read_csv, stamp
from tallyhouse.streaming import incremental, lateness

CHECKS = Checks("2016-08-02")
LOADED = "2016-08-02 00:00:00"

FIRST = [
    ["536365", "85123A", "WHITE HANGING HEART T-LIGHT HOLDER", "6", "2010-12-01 08:26:00", "2.55", "17850.0", "United Kingdom"],
    ["536365", "71053", "WHITE METAL LANTERN", "6", "2010-12-01 08:26:00", "3.39", "", "United Kingdom"],
    ["536365", "71053", "WHITE METAL LANTERN", "6", "2010-12-01 08:26:00", "3.39", "", "United Kingdom"],
    ["C536366", "85123A", "HEART", "-1", "1/2/2011 9:00", "2.55", "17850", "uk"],
    ["536367", "POST", 'SAID "POSTAGE, PAID"', "1", "2012-01-05", "18", "9.0", ""],
    ["536368", "22752", "BOXES", "2", "2010-12-01 08:26:00", "£7.65", "17850.0", "UK"],
    ["536369", "22752", "BOXES", "2", "2010-12-01 08:26:00", "0", "17850.0", "UK"],
]
SECOND = [
    ["536400", "85123A", "WHITE HANGING HEART T-LIGHT HOLDER LARGE", "1", "2012-03-01", "2.95", "17850.0", "France"],
    ["536400", "NEW1", "LAMP", "1", "2012-03-01", "10", "12.0", "France"],
]


def write(path, rows, header=RAW_COLUMNS, delimiter=","):
    with open(path, "w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out, delimiter=delimiter)
        writer.writerow(header)
        writer.writerows(rows)
    return str(path)


def test_scan_keeps_text_and_order(spark, tmp_path):
    path = write(tmp_path / "a.csv", FIRST)
    rows = read_csv(spark, path).orderBy("pos").collect()
    assert [[r[c] or "" for c in RAW_COLUMNS] for r in rows] == FIRST


def test_scan_finds_columns_by_name(spark, tmp_path):
    path = write(tmp_path / "b.csv", [["UK", "536365", "x"]], ["Country", "InvoiceNo", "Extra"], ";")
    row = read_csv(spark, path, delimiter=";").first()
    assert (row.InvoiceNo, row.Country, row.StockCode) == ("536365", "UK", None)


def test_table_source_needs_the_columns(spark):
    with pytest.raises(ValueError):
        from_table(spark.range(1))


def test_stamp_keeps_what_a_record_brings(spark):
    df = spark.createDataFrame([("own",), (None,)], "batch_id string")
    out = stamp(df, "mine", LOADED).orderBy("batch_id").collect()
    assert [r.batch_id for r in out] == ["mine", "own"]
    assert {r.data_source for r in out} == {"CSV"}


def test_two_loads(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "house"))
    raw = read_csv(spark, write(tmp_path / "1.csv", FIRST))
    counts = house.load(raw, CHECKS, "first", LOADED, source_file="1.csv")
    assert counts == {
        "records_read": 7, "gate_rejected": 1, "records_processed": 6, "records_cleaned": 4,
        "records_inserted": 4, "records_rejected": 2, "records_unresolved": 0,
    }
    reasons = sorted(r.reject_reason for r in house.quarantine().collect())
    assert reasons == ["duplicate", "ingest_invalid", "unit_price_zero_quarantine"]

    facts = {(r.invoice_no, r.product_key): r for r in house.fact_sales().collect()}
    assert sorted(r.transaction_type for r in facts.values()) == ["RETURN", "SALE", "SALE", "SHIPPING_CHARGE"]
    assert {r.txn_year for r in facts.values()} == {2010, 2011, 2012}
    products = {r.stock_code: r for r in house.dim_product().collect()}
    customers = {r.customer_id: r for r in house.dim_customer().collect()}
    assert products["85123A"].description == "White Hanging Heart T-Light Holder"
    assert customers["17850"].country == "United Kingdom" and customers["9"].country == "Unknown"
    assert house.dim_date().count() == 3

    assert house.load(raw, CHECKS, "first", LOADED) == {}
    assert house.fact_sales().count() == 4

    again = house.load(read_csv(spark, write(tmp_path / "2.csv", SECOND)), CHECKS, "second", LOADED)
    assert again["records_inserted"] == 2
    later = {r.stock_code: r for r in house.dim_product().collect()}
    assert {k: later[k].product_key for k in products} == {k: r.product_key for k, r in products.items()}
    assert later["85123A"].description.endswith("Large")
    assert {r.customer_id: r.country for r in house.dim_customer().collect()}["17850"] == "United Kingdom"
    keys = [r.sales_key for r in house.fact_sales().collect()]
    assert len(keys) == len(set(keys)) == 6 and max(keys) <= len(FIRST) + len(SECOND)
    assert {r.version_id for r in house.dim_product().collect()} == {1, 2}
    assert {r.version_id for r in house.dim_customer().collect()} == {1, 2}
    numbers = [r.version_number for r in house.data_versions().collect()]
    assert len(set(numbers)) == 2
    prints = {r.file_hash for r in house.data_versions().collect()}
    assert len(prints) == 2
    assert sorted(r.version_id for r in house.data_versions().collect()) == [1, 2]
    assert house.data_lineage().count() == 2
    assert house.data_quality_metrics().count() == 14

    tables = house.tables()
    for child, column, parent, parent_column in catalog.RELATIONSHIPS:
        assert quality.orphans(tables[child], column, tables[parent], parent_column).first().orphan_rows == 0
    checked = check_table(house, "dim_customer", "2016-08-02")
    assert checked["summary"].first().total_checks == 3

    for _ in range(2):
        house.summarise("2012-03-02", str(tmp_path / "summaries"))
    stored = spark.read.parquet(str(tmp_path / "summaries" / "sales_summary")).collect()
    assert [r.total_transactions for r in stored] == [2]


def test_load_without_lines(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "house"))
    raw = read_csv(spark, write(tmp_path / "empty.csv", []))
    assert house.load(raw, CHECKS, "empty", LOADED)["records_inserted"] == 0
    assert house.fact_sales().isEmpty() and house.data_quality_metrics().isEmpty()
    assert "No data available" in house.data_lineage().first().job_metadata
    assert house.load(read_csv(spark, write(tmp_path / "1.csv", FIRST)), CHECKS, "full", LOADED)["records_inserted"] == 4
    assert house.lines().count() == 4


def test_unfinished_load_is_invisible(spark, tmp_path, monkeypatch):
    house = Warehouse(spark, str(tmp_path / "house"))
    raw = read_csv(spark, write(tmp_path / "1.csv", FIRST))

    def fail(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(Warehouse, "_write_records", fail)
        with pytest.raises(RuntimeError):
            house.load(raw, CHECKS, "first", LOADED)
    assert house.fact_sales().isEmpty() and house.dim_product().isEmpty()
    run = house.data_lineage().first()
    assert (run.status, run.error_message, run.batch_id) == ("FAILED", "lost", "first")
    assert house.load(raw, CHECKS, "first", LOADED)["records_inserted"] == 4
    assert sorted(r.status for r in house.data_lineage().collect()) == ["FAILED", "SUCCESS"]


def test_no_line_is_lost(spark, tmp_path):
    """A line total that no column holds, and a line without keys, are kept with their reason."""
    house = Warehouse(spark, str(tmp_path / "house"))
    rows = FIRST + [["536370", "BIG", "BIG", "2000000000", "2010-12-01 08:26:00", "99999999", "17850.0", "UK"]]
    counts = house.load(read_csv(spark, write(tmp_path / "1.csv", rows)), CHECKS, "first", LOADED)
    assert counts["records_read"] == counts["gate_rejected"] + counts["records_rejected"] + counts["records_inserted"]
    kept = {r.InvoiceNo: r.reject_reason for r in house.quarantine().collect()}
    assert kept["536370"] == "line_total_out_of_range"
    assert "BIG" not in {r.stock_code for r in house.dim_product().collect()}


def test_lines_without_keys_are_kept(spark, tmp_path, monkeypatch):
    from tallyhouse.operators import fact

    resolve = fact.resolve_keys
    monkeypatch.setattr(fact, "resolve_keys", lambda lines, d, c, p: resolve(lines, d, c, p.filter("stock_code <> '71053'")))
    house = Warehouse(spark, str(tmp_path / "house"))
    counts = house.load(read_csv(spark, write(tmp_path / "1.csv", FIRST)), CHECKS, "first", LOADED)
    assert (counts["records_unresolved"], counts["records_inserted"], counts["records_rejected"]) == (1, 3, 3)
    lost = [r for r in house.quarantine().collect() if r.reject_reason == "unresolved_keys"]
    assert [(r.InvoiceNo, r.UnitPrice) for r in lost] == [("536365", "3.39")]


def test_two_streams_into_one_warehouse(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "house"))
    for name, rows in (("a", FIRST), ("b", SECOND)):
        os.mkdir(tmp_path / name)
        write(tmp_path / name / "1.csv", rows)
        incremental.load_available(house, str(tmp_path / name), str(tmp_path / f"progress-{name}"), CHECKS, LOADED)
    assert house.fact_sales().count() == 6 and house.loads().count() == 2


def test_plan_does_not_grow_with_the_loads(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "house"))
    sizes = []
    for n in range(3):
        house.load(read_csv(spark, write(tmp_path / f"{n}.csv", SECOND)), CHECKS, f"load-{n}", LOADED)
        sizes.append(house.fact_sales()._jdf.queryExecution().optimizedPlan().toString().count("Relation"))
    assert sizes == [1, 1, 1]


def test_archive_keeps_old_images(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "house"))
    house.load(read_csv(spark, write(tmp_path / "1.csv", FIRST)), CHECKS, "first", LOADED)
    before = house.fact_sales()
    house.archive(before, before.filter("invoice_no <> 536367"), LOADED, "clerk")
    rows = house.fact_sales_archive().collect()
    assert [(r.operation, r.changed_by) for r in rows] == [("DELETE", "clerk")]
    assert '"invoice_no":536367' in rows[0].payload


def test_files_with_other_column_orders(spark, tmp_path):
    first = write(tmp_path / "1.csv", FIRST[:1])
    turned = [RAW_COLUMNS[1], RAW_COLUMNS[0], *RAW_COLUMNS[2:]]
    second = write(tmp_path / "2.csv", [["B1", "536999", *FIRST[0][2:]]], turned)
    rows = read_csv(spark, [first, second]).collect()
    assert sorted((r.InvoiceNo, r.StockCode) for r in rows) == [("536365", "85123A"), ("536999", "B1")]
    assert len({r.row_id for r in rows}) == 2


def test_year_filter_prunes_partitions(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "house"))
    house.load(read_csv(spark, write(tmp_path / "1.csv", FIRST)), CHECKS, "first", LOADED)
    from tallyhouse.operators.fact import since

    plan = since(house.fact_sales(), "2012-01-31", 30)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(txn_year" in plan
    assert "PushedFilters: [IsNotNull(transaction_datetime)" in plan


def test_watched_folder_loads_each_file_once(spark, tmp_path):
    inbox = tmp_path / "inbox"
    os.mkdir(inbox)
    write(inbox / "1.csv", FIRST)
    house = Warehouse(spark, str(tmp_path / "house"))
    progress = str(tmp_path / "progress")

    def run():
        incremental.load_available(house, str(inbox), progress, CHECKS, LOADED)

    run()
    assert house.fact_sales().count() == 4
    run()
    assert house.fact_sales().count() == 4
    write(inbox / "2.csv", SECOND)
    run()
    assert house.fact_sales().count() == 6

    batch = Warehouse(spark, str(tmp_path / "batch"))
    batch.load(read_csv(spark, str(inbox / "1.csv")), CHECKS, "a", LOADED)
    batch.load(read_csv(spark, str(inbox / "2.csv")), CHECKS, "b", LOADED)
    columns = ["invoice_no", "customer_key", "product_key", "quantity", "line_total", "transaction_type"]
    streamed = sorted(map(tuple, house.fact_sales().select(columns).collect()))
    assert streamed == sorted(map(tuple, batch.fact_sales().select(columns).collect()))


def test_streaming_dedup_keeps_one_line_per_key(spark, tmp_path):
    inbox = tmp_path / "inbox"
    os.mkdir(inbox)
    write(inbox / "1.csv", FIRST)
    write(inbox / "2.csv", FIRST[:3])
    raw = (
        spark.readStream.schema(", ".join(f"{c} string" for c in RAW_COLUMNS))
        .option("header", True)
        .option("escape", '"')
        .csv(str(inbox))
        .withColumns({"seq": F.lit(0).cast("bigint"), "pos": F.lit(0).cast("bigint")})
    )
    once = incremental.deduplicate_stream(incremental.clean_stream(raw), "1 day")
    out = incremental.drain(once.select("invoice", "stock_code"), str(tmp_path / "out"))
    keys = sorted(map(tuple, out.collect()))
    assert keys == sorted({(r[0], r[1]) for r in FIRST if r[5] != "£7.65"})


def test_late_lines_are_rows(spark, tmp_path):
    """Three batches against a plain loop; equal rows without numbers, missing times and keys, and a repeated batch."""
    from datetime import datetime, timedelta

    batches = [
        [("a", 1, 20), ("a", 1, 20), ("b", 2, 3), (None, 3, 5), (None, 4, 6), ("x", 1, None)],
        [("a", 1, 21), ("b", 1, 9), ("b", 2, 12), ("c", 1, 40), ("b", 0, 10)],
        [("a", 1, 31), ("c", 2, 38), ("c", 1, 30), ("c", 1, 39)],
        [],
    ]
    schema = "k string, o int, transaction_datetime timestamp_ntz"
    day = lambda n: None if n is None else datetime(2020, 1, 1) + timedelta(days=n)
    ledger = lateness.LateLedger(str(tmp_path / "ledger"), "10 days", ["k"], ["o"])
    expected, kept, latest = [], [], None
    for number, lines in enumerate(batches):
        df = spark.createDataFrame([(k, o, day(n)) for k, o, n in lines], schema)
        for _ in range(2):
            ledger.place(df, number)
        mark = None if latest is None else latest - 10
        taken = set()
        for k, o, n in sorted(lines, key=lambda r: r[1]):
            if n is None:
                what = "undated"
            elif mark is not None and n <= mark:
                what = "late"
            elif k in taken or any(k == k2 and n2 + 10 > mark for b, k2, n2 in kept if b < number):
                what = "duplicate"
            else:
                what = "kept"
                kept.append((number, k, n))
            if what != "undated" and what != "late":
                taken.add(k)
            expected.append((k, o, day(n), number, what))
        latest = max([n for _, _, n in lines if n is not None] + ([] if latest is None else [latest]))
    found = list(map(tuple, ledger.lines(spark, df.schema).collect()))
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    assert {"kept", "duplicate", "late", "undated"} == {r[4] for r in found}


def test_two_loads_at_once(spark, tmp_path, monkeypatch):
    """Both build on the empty warehouse; the slower one starts over, and no key is given twice."""
    from threading import Barrier

    house = Warehouse(spark, str(tmp_path / "house"))
    sources = {n: read_csv(spark, write(tmp_path / f"{n}.csv", rows)) for n, rows in (("a", FIRST), ("b", SECOND))}
    both, build, begun = Barrier(2), Warehouse._load, []

    def load(self, *args):
        begun.append(args)
        made = build(self, *args)
        if len(begun) <= 2:
            both.wait(120)
        return made

    monkeypatch.setattr(Warehouse, "_load", load)
    with ThreadPoolExecutor(2) as pool:
        running = [pool.submit(house.load, raw, CHECKS, n, LOADED) for n, raw in sources.items()]
        counts = [r.result() for r in running]
    assert len(begun) == 3 and sorted(c["records_inserted"] for c in counts) == [2, 4]
    assert sorted((r.load_no, r.batch_id) for r in house.loads().collect()) in ([(1, "a"), (2, "b")], [(1, "b"), (2, "a")])
    for table, key in (("fact_sales", "sales_key"), ("dim_customer", "customer_key"), ("dim_product", "product_key"), ("data_versions", "version_id")):
        keys = [r[key] for r in house.tables()[table].collect()]
        assert len(keys) == len(set(keys)) and keys
    tables = house.tables()
    for child, column, parent, parent_column in catalog.RELATIONSHIPS:
        assert quality.orphans(tables[child], column, tables[parent], parent_column).first().orphan_rows == 0
    assert house.load(sources["a"], CHECKS, "a", LOADED) == {}


def test_commit_takes_a_number_once(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "loads"))
    assert log.rows().isEmpty()
    row = {"batch_id": "x", "folder": "f", "loaded_at": LOADED, "feed": None}
    assert log.publish(1, row) and not log.publish(1, {**row, "batch_id": "y"}) and log.publish(2, row)
    assert sorted((r.load_no, r.batch_id, str(r.loaded_at), r.feed) for r in log.rows().collect()) == [(1, "x", LOADED, None), (2, "x", LOADED, None)]


def line(invoice, code, customer, quantity="1"):
    return [invoice, code, "LAMP", quantity, "2012-03-01", "2", customer, "France"]


@pytest.mark.parametrize("hot_rows", [1_000_000, 2])
def test_a_feed_remembers_keys_and_customers(spark, tmp_path, hot_rows):
    """Repeated lines, an invoice opened later, a customer carried over, and the same again without a feed."""
    days = [
        [line("540001", "A1", ""), line("540001", "A2", "7.0"), line("540002", "B1", "8")],
        [line("540001", "A2", "7.0"), line("540001", "A3", ""), line("540001", "A1", ""), line("540003", "C1", "")],
        [line("540003", "C1", "9"), line("540003", "C2", ""), line("540001", "A4", "11"), line("540001", "A5", ""), line("540002", "B1", "8")],
        [line("540001", "A6", ""), line("540009", "Z", "1")],
    ]
    want = [
        ["missing_required_field", None, None],
        ["duplicate", None, None, "missing_required_field"],
        [None, None, None, None, "duplicate"],
        [None, None],
    ]
    house = Warehouse(spark, str(tmp_path / "house"))
    for day, rows in enumerate(days):
        house.load(read_csv(spark, write(tmp_path / f"{day}.csv", rows)), CHECKS, f"day-{day}", LOADED, feed="shop", hot_rows=hot_rows)
    judged = house.judged_by_load().collect()
    got = [[r.reject_reason for r in sorted((r for r in judged if r.load_id.startswith(f"{n + 1:08d}")), key=lambda r: r.pos)] for n in range(4)]
    assert got == want
    customers = {r.StockCode: r.customer_id for r in judged if r.reject_reason is None}
    assert [customers[c] for c in ("A1", "A3", "A5", "A6", "C2")] == ["7", "7", "11", "11", "9"]

    alone = house.load(read_csv(spark, write(tmp_path / "again.csv", days[0])), CHECKS, "again", LOADED)
    assert alone["records_inserted"] == 2
    other = house.load(read_csv(spark, write(tmp_path / "other.csv", days[0])), CHECKS, "other", LOADED, feed="second shop")
    assert other["records_inserted"] == 2


def test_only_hit_buckets_are_read(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "house"))
    house.load(read_csv(spark, write(tmp_path / "1.csv", [line(str(540000 + i), "A", "1") for i in range(200)])), CHECKS, "1", LOADED, feed="f")
    state, folders = FeedState(spark, str(tmp_path / "house/feeds/f")), [r.folder for r in house.loads().collect()]
    asked = lambda *numbers: spark.createDataFrame([(str(n),) for n in numbers], "invoice string")
    assert state.hit_buckets(asked(540007), folders) == [(folders[0], spark.range(1).select(bucket_of(F.lit("540007"), 64)).first()[0])]
    assert len(state.hit_buckets(asked(*range(540000, 540200)), folders)) > 50
    assert len(state.hit_buckets(asked(*range(600000, 600200)), folders)) <= 2
    raw = read_csv(spark, write(tmp_path / "2.csv", [line("540007", "A", "1"), line("540007", "B", "")]))
    prior = state.prior(raw, folders)
    assert sorted(map(tuple, prior.select("invoice", "stock_code", "customer_id").collect())) == [("540007", "", "1"), ("540007", "A", "1")]
    files = {f.split("bucket=")[1].split("/")[0] for f in prior.inputFiles() if "line_keys" in f}
    assert len(files) == 1
    assert state.prior(read_csv(spark, write(tmp_path / "3.csv", [line("999999", "A", "1")])), folders[:0]) is None


def test_lines_with_surplus_fields_are_kept_whole(spark, tmp_path):
    """A field too many, an empty one, a delimiter in an unquoted text; too few fields are no fault of this kind."""
    with open(tmp_path / "1.csv", "w", encoding="utf-8") as out:
        out.write(",".join(RAW_COLUMNS) + "\n")
        out.write("540001,A1,LAMP,1,2012-03-01,2,7,France\n")
        out.write("540001,A2,LAMP,1,2012-03-01,2,7,France,SURPLUS\n")
        out.write("540001,A3,LAMP,1,2012-03-01,2,7,France,\n")
        out.write("540001,A4,LAMP, LARGE,1,2012-03-01,2,7,France\n")
        out.write('540001,A5,"LAMP, ""LARGE""",1,2012-03-01,2,7,"Fra,nce"\n')
        out.write("540001,A6,LAMP,1,2012-03-01,2\n")
    faulty = ["540001,A2,LAMP,1,2012-03-01,2,7,France,SURPLUS", "540001,A3,LAMP,1,2012-03-01,2,7,France,", "540001,A4,LAMP, LARGE,1,2012-03-01,2,7,France"]
    raw = read_csv(spark, str(tmp_path / "1.csv"))
    rows = raw.orderBy("pos").collect()
    assert [r.raw_line for r in rows] == [None, *faulty, None, None]
    assert (rows[4].Description, rows[4].Country, rows[5].CustomerID) == ('LAMP, "LARGE"', "Fra,nce", None)
    house = Warehouse(spark, str(tmp_path / "house"))
    counts = house.load(raw, CHECKS, "first", LOADED)
    assert (counts["records_read"], counts["records_inserted"], counts["records_rejected"], counts["gate_rejected"]) == (6, 3, 3, 0)
    kept = house.quarantine().collect()
    assert sorted(r.raw_line for r in kept) == sorted(faulty) and {r.reject_reason for r in kept} == {"malformed_line"}

    os.mkdir(tmp_path / "inbox")
    os.rename(tmp_path / "1.csv", tmp_path / "inbox" / "1.csv")
    streamed = Warehouse(spark, str(tmp_path / "streamed"))
    incremental.load_available(streamed, str(tmp_path / "inbox"), str(tmp_path / "progress"), CHECKS, LOADED)
    assert sorted(r.raw_line for r in streamed.quarantine().collect()) == sorted(faulty)
    assert streamed.fact_sales().count() == 3


def test_distinct_counts_of_stored_days(spark, tmp_path):
    """Equal to counting the fact's keys, over loads that share days; no Expand, and no fact row read."""
    house = Warehouse(spark, str(tmp_path / "house"))
    for n, rows in enumerate((FIRST, SECOND, FIRST[:4])):
        house.load(read_csv(spark, write(tmp_path / f"{n}.csv", rows)), CHECKS, f"{n}", LOADED)
    for as_of, days in (("2012-03-02", 30), ("2012-03-02", 5000), ("2010-12-15", 30), ("2031-01-01", 1)):
        whole = analytics.sales_summary(house.fact_sales(), as_of, days)
        stored = day_counts.sales_summary(house.day_totals(), house.day_keys(), as_of, days)
        assert whole.collect() == stored.collect()
        plain = house.fact_sales().filter(F.col("transaction_datetime") >= F.lit(as_of).cast("date") - F.expr(f"INTERVAL {days} DAYS"))
        counted = plain.agg(F.count("*"), F.count_distinct("customer_key"), F.count_distinct("product_key")).first()
        row = stored.first()
        assert (row.total_transactions, row.unique_customers, row.unique_products) == tuple(counted)
    for df in (whole, stored):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "Expand" not in plan
    assert "fact_sales" not in "".join(stored.inputFiles())


def test_key_sets_hold_all_keys(spark):
    rows = [(f"2020-01-0{1 + i % 3} 10:00:00", i * 7919 % 100_000, None if i % 5 else i) for i in range(3000)] * 2
    fact = spark.createDataFrame(rows, "t string, customer_key long, product_key long").withColumn("transaction_datetime", F.col("t").cast("timestamp_ntz"))
    sets = day_counts.day_keys(fact)
    for first in range(1, 4):
        last = [r for r in rows if r[0] >= f"2020-01-0{first}"]
        found = {r.key: r.distinct_keys for r in day_counts.distinct_keys(sets.filter(f"day >= '2020-01-0{first}'")).collect()}
        assert found == {"customer_key": len({r[1] for r in last}), "product_key": len({r[2] for r in last} - {None})}


def _loaded_in_turn(spark, tmp_path, n):
    house = Warehouse(spark, str(tmp_path / "house"))
    for i in range(n):
        rows = [["%d" % (536400 + i), "NEW%d" % (i % 3), "LAMP " * (i + 1), "1", "2012-03-%02d" % (i + 1), "10", "12.0", "France"], FIRST[0]]
        raw = read_csv(spark, write(tmp_path / f"{i}.csv", rows))
        house.load(raw, CHECKS, f"batch-{i}", f"2016-08-02 00:00:{i:02d}", feed="f")
    return house


def _content(house):
    found = {n: df for n, df in house.tables().items() if n != "dim_transaction_type"}
    found |= {"judged": house.judged_by_load(), "quarantine": house.quarantine(), "day_keys": house.day_keys(), "day_totals": house.day_totals()}
    return {n: sorted(repr(sorted(r.asDict().items())) for r in df.collect()) for n, df in found.items()}


def test_merged_loads_read_the_same(spark, tmp_path):
    house = _loaded_in_turn(spark, tmp_path, 4)
    before, old = _content(house), house.fact_sales()
    old_folders = house._folders()
    taken = house.compact(whole=True)
    assert taken == old_folders and len(house._folders()) == 1
    assert _content(house) == before
    assert house.compact() == []
    # A reader that planned before the merge is not disturbed; nor by removing what was unread before it.
    house.remove_unread(datetime(2000, 1, 1))
    assert old.count() == len(before["fact_sales"])
    # A repeated batch stays known, a later load goes on with keys, feed and products, and merges again.
    raw = read_csv(spark, write(tmp_path / "more.csv", [FIRST[0], ["536500", "NEW0", "LAMP", "2", "2012-04-01", "10", "12.0", "France"]]))
    assert house.load(raw, CHECKS, "batch-0", LOADED, feed="f") == {}
    counts = house.load(raw, CHECKS, "more", "2016-08-02 00:01:00", feed="f")
    assert (counts["records_inserted"], counts["records_rejected"]) == (1, 1)
    keys = [r.sales_key for r in house.fact_sales().collect()]
    assert len(set(keys)) == len(keys) == 6
    before = _content(house)
    assert len(house.compact(whole=True)) == 2 and _content(house) == before
    assert {r.load_id[:8] for r in house.judged_by_load().collect()} == {f"{i:08d}" for i in range(1, 6)}
    gone = house.remove_unread(datetime(2100, 1, 1))
    assert gone and _content(house) == before
    assert len(os.listdir(tmp_path / "house/fact_sales")) == 1 and not os.listdir(tmp_path / "house/landed")
    assert house.loads().count() == 5 and house.remove_unread(datetime(2100, 1, 1)) == []


def test_of_two_merges_one_counts(spark, tmp_path):
    house = _loaded_in_turn(spark, tmp_path, 2)
    before = house.merges.last()
    assert house.merges.publish(before, 2, ["x"], datetime(2016, 8, 2))
    assert not house.merges.publish(before, 2, ["y"], datetime(2016, 8, 2))
    assert house.merges.last().folders == ("x",)


def test_a_merge_takes_the_small_folders_at_the_end():
    assert _tail([]) == 0 and _tail([5]) == 0
    assert _tail([100, 10, 4, 2, 2]) == 2  # 2 + 2, then 4, but not 10
    assert _tail([1] * 50) == 0
    sizes = []
    for _ in range(1000):  # loads of one size, merged after each
        sizes.append(1)
        start = _tail(sizes)
        sizes = [*sizes[:start], sum(sizes[start:])]
        assert len(sizes) <= 11


def test_merging_an_empty_warehouse(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "house"))
    assert house.compact() == [] and house.remove_unread(datetime(2100, 1, 1)) == []


def test_every_position_of_a_filter_knows_how_many_its_invoice_has(spark):
    """So that a hit needs no second pass over the invoices."""
    rows = spark.createDataFrame([(str(540000 + i),) for i in range(50)], "invoice string")
    found = _positions(rows, 64).groupBy("invoice").agg(F.count("*").alias("n"), F.max("wanted").alias("most"), F.min("wanted").alias("least"))
    assert {(r.n, r.most, r.least) for r in found.collect()} <= {(4, 4, 4), (3, 3, 3)} and found.count() == 50


def test_a_merge_shuffles_nothing(spark, tmp_path):
    """Files are those of the scan tasks, and a year that is NULL is kept."""
    house = Warehouse(spark, str(tmp_path / "house"))
    rows = spark.range(4000).selectExpr("id AS k", "if(id % 2 = 0, 2011, NULL) AS txn_year")
    for part in (0, 1):
        rows.filter(f"k % 4 DIV 2 = {part}").coalesce(1).write.partitionBy("txn_year").parquet(str(tmp_path / f"in/part={part}"))
    key = "spark.sql.files.maxPartitionBytes"
    held = spark.conf.get(key)
    spark.conf.set(key, "1k")
    try:
        found = spark.read.schema("k bigint, txn_year int").parquet(str(tmp_path / "in"))
        house._merge(found.select("k", "txn_year"), ["txn_year"], str(tmp_path / "out"))
    finally:
        spark.conf.set(key, held)
    merged = spark.read.schema("k bigint, txn_year int").parquet(str(tmp_path / "out"))
    assert sorted(map(repr, merged.collect())) == sorted(map(repr, rows.collect()))
    assert len([f for f in os.listdir(tmp_path / "out/txn_year=2011") if f.endswith(".parquet")]) > 1


def test_partitioned_writes_sort_nothing(spark, tmp_path):
    """A task keeps a file open per year; sorting all it writes by a handful of years took most of its memory."""
    spark.sql(f"CREATE TABLE by_year (n bigint, txn_year int) USING parquet PARTITIONED BY (txn_year) LOCATION '{tmp_path}/sales'")
    try:
        insert = "INSERT INTO by_year SELECT id, CASE WHEN id % 50 < 49 THEN CAST(1970 + id % 50 AS INT) END FROM range(0, 5000, 1, 2)"
        plan = spark.sql(f"EXPLAIN {insert}").first()[0]
        assert "WriteFiles" in plan and "Sort" not in plan
        spark.sql(insert)  # more years than open files
        rows = spark.table("by_year").groupBy("txn_year").count().collect()
        assert len(rows) == 50 and {r["count"] for r in rows} == {100}
    finally:
        spark.sql("DROP TABLE by_year")


def test_late_lines_keep_their_texts_and_are_stored_tightly(spark, tmp_path):
    rows = [("a", "2020-01-05", "x\x1fy", None, 1), ("a", "2020-01-05", None, "\x1bn", 2), ("b", None, "", "z", 3)]
    lines = spark.createDataFrame(rows, "k string, t string, left string, right string, n int").withColumn("t", F.col("t").cast("timestamp_ntz"))
    lines.write.parquet(str(tmp_path / "inbox"))
    ledger = lateness.LateLedger(str(tmp_path / "ledger"), "20 days", ["k"], ["n"], "t")
    ledger.run(spark.readStream.schema(lines.schema).parquet(str(tmp_path / "inbox")))
    found = {r.n: (r.k, r.left, r.right, r.outcome) for r in ledger.lines(spark, lines.schema).collect()}
    assert found == {1: ("a", "x\x1fy", None, "kept"), 2: ("a", None, "\x1bn", "duplicate"), 3: ("b", "", "z", "undated")}
    files = [f.name for f in (tmp_path / "ledger").rglob("*.parquet")]
    assert files and all(f.endswith(".zstd.parquet") for f in files)
