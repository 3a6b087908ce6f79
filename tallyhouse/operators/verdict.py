"""One verdict per raw line: accepted, or rejected with a single reason.

Two rules look at other lines of the same invoice. A line without a customer
takes the customer of the last accepted line before it, and of the lines that
share invoice and stock code only the first acceptable one stays. Read line by
line each rule feeds the other, but they have a closed form:

* a line can be accepted once its invoice has shown a usable customer on a line
  that passes all checks, or if it is such a line itself;
* the first of those lines per invoice and stock code is accepted;
* a missing customer is the last customer named on an accepted line before.

What earlier loads of a feed have accepted can be given along: it stands before
all lines of its invoice, as lines that are not judged again.

Invoices of ordinary size are settled by windows over one shuffle.
An invoice of more than `hot_rows` lines never meets in one task: it takes the
aggregate path, which shuffles partial results and cuts the invoice into chunks.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions import cleaning, validation
from tallyhouse.functions.text import is_blank, pack, unpack
from tallyhouse.operators.carry import carry_last
from tallyhouse.operators.transform import line_total
from tallyhouse.schemas import RAW_COLUMNS
from tallyhouse.session import CODEC, new_folder
from tallyhouse.sources.files import RAW_LINE

# Reject reasons in order of precedence. A zero quantity already fails
# validation, so its own label only appears where that check is lifted.
MALFORMED = "malformed_line"
GATE = "ingest_invalid"
MISSING = "missing_required_field"
INVALID = "validation_failed"
ZERO_QUANTITY = "quantity_zero"
ZERO_PRICE = "unit_price_zero_quarantine"
TOO_LARGE = "line_total_out_of_range"
DUPLICATE = "duplicate"
REASONS = [MALFORMED, GATE, MISSING, INVALID, ZERO_QUANTITY, ZERO_PRICE, TOO_LARGE, DUPLICATE]

ORDER = ["pos", "row_id"]
HOT_ROWS = 1_000_000
_SCATTER = 4096


@dataclass(frozen=True)
class Checks:
    """What the load accepts; the two days are both included."""

    as_of: str
    first_day: str = validation.FIRST_SALE_DAY


def with_checks(raw: DataFrame, checks: Checks) -> DataFrame:
    """Typed columns and every check that needs no other line.

    Column names ignore case, so the typed quantity goes by `units` for as long
    as the raw Quantity is there.

    Of the required fields only the customer can still be blank behind the
    gate, and a blank customer may yet be filled; so MISSING is decided later.
    """
    typed = raw.withColumns(
        {
            "invoice": cleaning.clean_invoice_no(F.col("InvoiceNo")),
            "stock_code": cleaning.clean_stock_code(F.col("StockCode")),
            "units": cleaning.clean_quantity(F.col("Quantity")),
            "unit_price": cleaning.clean_unit_price(F.col("UnitPrice")),
            "transaction_datetime": cleaning.clean_date(F.col("InvoiceDate")),
            "_own": F.nullif(cleaning.clean_customer_id(F.col("CustomerID")), F.lit("")),
            "_seeks": cleaning.names_no_customer(F.col("CustomerID")),
            "_no_customer_text": is_blank(F.col("CustomerID")),
        }
    )
    valid = (
        validation.present(F.col("stock_code"))
        & validation.invoice_format_ok(F.col("invoice"))
        & validation.quantity_ok(F.col("units"))
        & validation.price_ok(F.col("unit_price"))
        & validation.date_ok(F.col("transaction_datetime"), checks.as_of, checks.first_day)
        # An id such as ".0" names a customer, yet nothing is left of it.
        & (F.col("_seeks") | F.col("_own").isNotNull())
    )
    # A line whose fields do not fit its header may stand in the wrong columns.
    whole = F.col(RAW_LINE).isNull() if RAW_LINE in raw.columns else F.lit(True)
    local = (
        F.when(~whole, MALFORMED)
        .when(~validation.passes_gate(), GATE)
        .when(~valid, INVALID)
        .when(F.col("units") == 0, ZERO_QUANTITY)
        .when(F.col("unit_price") == 0, ZERO_PRICE)
        .when(line_total(F.col("units"), F.col("unit_price")).isNull(), TOO_LARGE)
    )
    return typed.withColumn("_local", local)


def _ok() -> Column:
    return F.col("_local").isNull()


def _named() -> Column:
    return _ok() & F.col("_own").isNotNull()


def _settle_whole(rows: DataFrame) -> DataFrame:
    """Invoices of ordinary size: windows over one shuffle by invoice and two sorts.

    The opening line and the copies take the order by stock code as it is; only
    the fill needs the lines' own. Copies are counted, so of lines that share
    even their row id one is accepted.
    """
    at = F.struct(*ORDER)
    group = Window.partitionBy("_group")
    copies = Window.partitionBy("_group", "stock_code").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = group.orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.sortWithinPartitions("_group", "stock_code", *ORDER)
    rows = rows.withColumn("_opens", F.min(F.when(_named(), at)).over(group))
    rows = rows.withColumn("_reach", _ok() & F.coalesce(F.col("_opens") <= at, F.lit(False))).drop("_opens")
    rows = rows.withColumn("_accepted", F.col("_reach") & (F.count_if("_reach").over(copies) == 1))
    source = F.when(F.col("_accepted"), F.col("_own"))
    return rows.withColumn("_fill", F.last(source, ignorenulls=True).over(before))


#: Texts that no check looks at; they stay packed until the verdict is known.
_CARRIED = ("Description", "Country", "batch_id", "data_source")
_CHECKED = tuple(c for c in RAW_COLUMNS if c not in _CARRIED)


def _by_group(rows: DataFrame) -> DataFrame:
    """Lines by invoice; the texts that are checked cross the network packed."""
    others = [c for c in rows.columns if c not in _CHECKED]
    sent = rows.select(*others, pack(_CHECKED).alias("_texts")).repartition("_group")
    return sent.select(*others, *[text.alias(name) for name, text in unpack("_texts", _CHECKED).items()])


def _stored(rows: DataFrame) -> DataFrame:
    """Checked lines of oversized invoices: they are read four times and checked once."""
    folder = new_folder(rows.sparkSession, "oversized")
    rows.write.parquet(folder, compression=CODEC)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def _settle_hot(rows: DataFrame, hot_rows: int) -> DataFrame:
    """Oversized invoices: the same answers from partial aggregates only.

    Every shuffle here is by a key that splits an invoice, or moves
    pre-aggregated rows.
    Conditions sit inside the aggregates: as filters they would be pushed into
    the scan and evaluate every check a second time.
    """
    at = F.struct(*ORDER)
    opening = rows.groupBy("_group").agg(F.min(F.when(_named(), at)).alias("_opens"))
    # One row per oversized invoice; how it gets to the lines is left to its size.
    rows = rows.join(opening, "_group", "left").withColumn(
        "_reach",
        _ok() & F.coalesce(F.col("_opens") <= at, F.lit(False)),
    )
    winners = (
        rows.groupBy("_group", "stock_code")
        .agg(F.min(F.when(F.col("_reach"), at)).alias("_win"))
        .select("_group", "stock_code", "_win.*", F.lit(True).alias("_first"))
    )
    rows = rows.join(winners, ["_group", "stock_code", *ORDER], "left").withColumn(
        "_accepted", F.col("_reach") & F.coalesce("_first", F.lit(False))
    )
    # So many neighbouring positions make a chunk, however far apart the invoice's
    # first and last ones are: numbers leap from one scan task to the next.
    span = max(1, hot_rows // 4)
    rows = rows.withColumn("_chunk", F.floor(F.col("pos") / F.lit(span)))
    # Lines at one position are copies, so they share their source and answer.
    points = rows.groupBy("_group", "_chunk", "pos").agg(
        F.max(F.when(F.col("_accepted"), F.col("_own"))).alias("_source")
    )
    filled = carry_last(points, ["_group"], "_chunk", "pos", "_source", "_fill")
    return rows.join(filled.select("_group", "pos", "_fill"), ["_group", "pos"], "left")


def oversized_invoices(lines: DataFrame, hot_rows: int) -> DataFrame | None:
    """Invoices of more than `hot_rows` lines; None if there is none.

    Counts one column in one pass and combines before the shuffle. The result
    cannot have more than total rows / hot_rows rows. It is stored, so that all
    who use it see the same, and Spark knows its size.
    """
    invoice = cleaning.clean_invoice_no(F.col("InvoiceNo"))
    sized = lines.select(invoice.alias("_group")).groupBy("_group").agg(F.count(F.lit(1)).alias("_lines"))
    large = (F.col("_lines") > hot_rows) & (F.col("_group") != "")
    spark = lines.sparkSession
    kept = new_folder(spark, "oversized")
    sized.filter(large).select("_group").write.parquet(kept)
    found = spark.read.schema("_group string").parquet(kept)
    return None if found.isEmpty() else found


def _before(prior: DataFrame, raw: DataFrame) -> DataFrame:
    """Accepted keys and customers of earlier loads as raw lines that stand before all others of their invoice.

    All of an invoice have the customer its next line would be given, so their order does not matter. They join the
    raw lines, so that both cross the network together and once; `_taken_over` gives them what was settled before.
    """
    return prior.select(
        F.col("invoice").alias("_group"),
        F.col("invoice").alias("InvoiceNo"),
        F.col("stock_code").alias("StockCode"),
        F.col("customer_id").alias("CustomerID"),
        F.lit(-1).cast(raw.schema["pos"].dataType).alias("pos"),
        F.xxhash64("invoice", "stock_code").cast(raw.schema["row_id"].dataType).alias("row_id"),
    )


def _taken_over(typed: DataFrame) -> DataFrame:
    """Lines of earlier loads are clean and accepted; nothing about them is judged again."""
    settled = {
        "invoice": F.col("InvoiceNo"),
        "stock_code": F.col("StockCode"),
        "_own": F.col("CustomerID"),
        "_seeks": F.lit(False),
        "_no_customer_text": F.lit(False),
        "_local": F.lit(None).cast("string"),
    }
    return typed.withColumns({n: F.when(F.col("pos") < 0, value).otherwise(F.col(n)) for n, value in settled.items()})


def judge(
    raw: DataFrame,
    checks: Checks,
    hot_rows: int = HOT_ROWS,
    invoice_scan: DataFrame | None = None,
    prior: DataFrame | None = None,
) -> DataFrame:
    """Raw columns, clean columns and `reject_reason`, NULL for accepted lines.

    `raw` holds the eight raw columns, `pos` (a line's place in its invoice; lines
    that share one are copies of each other) and `row_id` (unique). One small job
    runs first to find oversized invoices, and only if there are any does the
    plan get their path; pass `invoice_scan` where a narrower source of
    `InvoiceNo` exists. Both paths read `raw`, so it has to give the same lines
    with the same numbers each time: a load stores them first. `prior` holds what
    `FeedState.prior` found of earlier loads; `raw` then has positions from 0 on.
    """
    given, carried = raw.columns, [c for c in _CARRIED if c in raw.columns]
    raw = raw.withColumn("_carried", pack(carried)).drop(*carried)
    hot = oversized_invoices(raw if invoice_scan is None else invoice_scan, hot_rows)
    invoice = cleaning.clean_invoice_no(F.col("InvoiceNo"))
    is_hot = invoice == F.col("_group")

    # Lines without an invoice share nothing and are spread out evenly.
    scattered = F.concat(F.lit("\x01"), F.pmod("row_id", F.lit(_SCATTER)).cast("string"))
    group = F.when(invoice != "", invoice).otherwise(scattered)
    # The split is made on the raw lines, so that it only reads the invoice.
    whole = raw if hot is None else raw.join(hot, is_hot, "left_anti")
    # Raw text is what the quarantine needs, so it has to cross the network;
    # typed columns do not, and are made on the far side.
    whole = whole.withColumn("_group", group)
    if prior is not None:
        before = _before(prior, raw)
        rare = before if hot is None else before.join(hot, "_group", "left_anti")
        whole = whole.unionByName(rare, allowMissingColumns=True)
    typed = with_checks(_by_group(whole), checks)
    settled = _settle_whole(typed if prior is None else _taken_over(typed))
    if hot is not None:
        split = raw.join(hot, is_hot)
        if prior is not None:
            split = split.unionByName(before.join(hot, "_group", "left_semi"), allowMissingColumns=True)
        split = with_checks(split, checks)
        split = _settle_hot(_stored(split if prior is None else _taken_over(split)), hot_rows)
        settled = settled.unionByName(split.select(settled.columns))
    if prior is not None:
        settled = settled.filter(F.col("pos") >= 0)
    customer = F.coalesce("_own", F.when(F.col("_seeks"), F.col("_fill")))
    reason = (
        F.when(F.col("_local").isin(MALFORMED, GATE), F.col("_local"))
        .when(F.col("_no_customer_text") & customer.isNull(), MISSING)
        .when((F.col("_local") == INVALID) | customer.isNull(), INVALID)
        .when(F.col("_local").isNotNull(), F.col("_local"))
        .when(~F.col("_accepted"), DUPLICATE)
    )
    order = [c for c in ("seq", *ORDER) if c in given]
    extra = [c for c in given if c not in RAW_COLUMNS and c not in order]
    settled = settled.withColumns(unpack("_carried", carried)).drop("_carried")
    return settled.select(
        *order,
        *RAW_COLUMNS,
        *extra,
        "invoice",
        "stock_code",
        "units",
        "unit_price",
        "transaction_datetime",
        customer.alias("customer_id"),
        cleaning.clean_description(cleaning.fill_unknown(F.col("Description"))).alias(
            "clean_description"
        ),
        cleaning.clean_country(cleaning.fill_unknown(F.col("Country"))).alias("clean_country"),
        reason.alias("reject_reason"),
    )


def accepted(judged: DataFrame) -> DataFrame:
    """Accepted lines, clean columns only."""
    renamed = {
        "units": "quantity",
        "clean_description": "description",
        "clean_country": "country",
    }
    drop = {*RAW_COLUMNS, RAW_LINE, "reject_reason"}
    return judged.filter(F.col("reject_reason").isNull()).select(
        *[F.col(c).alias(renamed.get(c, c)) for c in judged.columns if c not in drop]
    )


def rejected(judged: DataFrame) -> DataFrame:
    """Quarantine: rejected lines as they came, with the reason."""
    return judged.filter(F.col("reject_reason").isNotNull()).select(
        *[c for c in judged.columns if c in (*RAW_COLUMNS, RAW_LINE, "seq", *ORDER)],
        "customer_id",
        "reject_reason",
    )


def summary(judged: DataFrame) -> DataFrame:
    """Totals of a run in one row."""
    admitted = F.col("reject_reason").isNull() | (F.col("reject_reason") != GATE)
    total, cleaned = F.count_if(admitted), F.count_if(F.col("reject_reason").isNull())
    return judged.agg(
        total.alias("total_records"),
        cleaned.alias("records_cleaned"),
        (total - cleaned).alias("records_rejected"),
        F.count_if(F.col("reject_reason") == INVALID).alias("validation_errors"),
        F.count_if(F.col("reject_reason") == DUPLICATE).alias("duplicates_removed"),
        F.round(F.coalesce(F.try_divide(cleaned * 100.0, total), F.lit(0.0)), 6).alias(
            "cleaning_rate"
        ),
    )


def reason_counts(judged: DataFrame) -> DataFrame:
    return (
        judged.groupBy(F.coalesce("reject_reason", F.lit("accepted")).alias("verdict"))
        .agg(F.count(F.lit(1)).alias("lines"))
    )
