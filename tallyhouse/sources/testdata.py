"""Raw sales lines derived from the order tables, with dirt of every kind.

The tables are clean and typed, so each line is turned into the text a sales
export would hold, and a line's own numbers decide which fault it gets. `D`
below is that number. All expressions use integer arithmetic on values both
engines print alike, so the same view can be written in plain SQL.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.schemas import RAW_COLUMNS
from tallyhouse.session import spread

# The last order is of 2016-08-01 once moved forward by fifteen years.
SALES_AS_OF = "2016-08-02"
LOADED_AT = "2016-08-02 00:00:00"
EVENTS_AS_OF = "2024-01-31"
_MONTHS_FORWARD = 15 * 12

CODES = [
    "POST", "D", "M", "S", "C2", "DOT", "CRUK", "BANKCHARGES", "AMAZONFEE",
    "GIFT_0001_20", "DCGSSBOY", "DCGS0001", "GIFT_0002", "DCGSSGIRL", "PADS",
]

_POSITION_BASE = 2**52


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _cents(price: Column) -> Column:
    return F.round(price * 100).cast("bigint")


def _text(c: Column) -> Column:
    return c.cast("string")


def _choose(number: Column, cases: list[tuple[int, Column]], otherwise: Column) -> Column:
    """First case whose modulus divides the number."""
    chain = F
    for modulus, value in cases:
        chain = chain.when(number % modulus == 0, value)
    return chain.otherwise(otherwise)


def sales_view(
    spark: SparkSession,
    sf_dir: str,
    columns: list[str] = RAW_COLUMNS,
    lineitem: DataFrame | None = None,
) -> DataFrame:
    """`seq`, `pos`, `row_id` and the raw columns asked for.

    Only the tables behind the wanted columns are joined. `lineitem` may be a
    stream; lines are then not numbered.
    """
    streaming = lineitem is not None and lineitem.isStreaming
    lines = table(spark, sf_dir, "lineitem") if lineitem is None else lineitem
    number = F.lit(0).cast("bigint") if streaming else F.monotonically_increasing_id()
    lines = spread(lines.withColumn("row_id", number), "row_id")

    order, part = F.col("l_orderkey"), F.col("l_partkey")
    content = F.concat_ws(
        "|",
        _text(order),
        _text(part),
        _text(F.col("l_suppkey")),
        _text(F.col("l_linenumber")),
        _text(_cents(F.col("l_extendedprice"))),
        _text(F.col("l_quantity").cast("bigint")),
        _text(_cents(F.col("l_discount"))),
        _text(_cents(F.col("l_tax"))),
        F.col("l_returnflag"),
        F.col("l_linestatus"),
        F.date_format(F.to_date("l_shipdate"), "yyyy-MM-dd"),
    )
    # Lines of an order have no stored place: line number, then a hash of all
    # that the line holds, stands in for the place in a file.
    place = F.conv(F.substring(F.md5(content), 1, 13), 16, 10).cast("bigint")
    pos = F.col("l_linenumber").cast("bigint") * _POSITION_BASE + place
    # Whole cents per unit; DIV keeps the arithmetic exact in both engines.
    unit_cents = (
        "CAST(round(l_extendedprice * 100) AS BIGINT)"
        " DIV (CAST(l_quantity AS BIGINT) * 1000)"
    )
    # What the joins shuffle of a line: its place, and the columns that texts are made of.
    lines = lines.select(
        "l_orderkey",
        "l_partkey",
        "row_id",
        pos.alias("pos"),
        F.col("l_quantity").cast("bigint").alias("_units"),
        F.expr(unit_cents).alias("_each"),
        (F.col("l_returnflag") == "R").alias("_credit"),
    )
    if streaming:
        # A stream's files are few and its plan is fixed before they are seen; the first join takes this shuffle as it is.
        lines = lines.repartition("l_partkey" if "Description" in columns else "l_orderkey")
    units, each, credit = F.col("_units"), F.col("_each"), F.col("_credit")
    dirt = order * 7 + part * 3 + F.expr(f"pos DIV {_POSITION_BASE}")

    if "Description" in columns:
        parts = table(spark, sf_dir, "part")
        lines = lines.join(parts, part == F.col("p_partkey"))
    if {"InvoiceDate", "CustomerID", "Country"} & set(columns):
        # Last, so that lines come order by order, as a till would list them.
        orders = table(spark, sf_dir, "orders")
        if "Country" in columns:
            # Orders meet their customers first: they are fewer than the lines, which meet both at once.
            customers = table(spark, sf_dir, "customer")
            nations = table(spark, sf_dir, "nation")
            homes = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
            orders = orders.join(homes, F.col("o_custkey") == F.col("c_custkey"))
        lines = lines.join(orders, order == F.col("o_orderkey"))

    number = _text(500000 + order % 9000000)
    invoice = F.concat(F.when(credit, "C").otherwise(""), number)
    code = F.concat(_text(part), F.char(65 + part % 26))
    special = F.element_at(F.array(*[F.lit(c) for c in CODES]), (part % 200 + 1).cast("int"))
    sign = F.when(credit | (dirt % 79 == 0), -1).otherwise(1)
    signed = units * sign
    price = F.concat(
        _text(F.expr("_each DIV 100")),
        F.lit("."),
        F.lpad(_text(each % 100), 2, "0"),
    )

    def texts() -> dict[str, Column]:
        made = {
            "InvoiceNo": _choose(
                dirt,
                [
                    (101, F.lit("")),
                    (97, F.concat(F.lit("BAD"), number)),
                    (31, F.concat(invoice, F.lit("A"))),
                    (29, F.concat(F.lit("  "), F.lower(invoice), F.lit(" "))),
                ],
                invoice,
            ),
            "StockCode": _choose(
                dirt,
                [
                    (211, F.lit("###")),
                    (37, F.concat(F.lit(" "), F.lower(code), F.lit(" #1"))),
                ],
                F.when(
                    (order % 5 == 0) & (dirt % 4 == 0),
                    F.concat(_text(10000 + order % 900), F.lit("B")),
                )
                .when(part % 200 < len(CODES), special)
                .otherwise(code),
            ),
            "Quantity": _choose(
                dirt,
                [
                    (71, F.lit("abc")),
                    (61, F.lit("0")),
                    (83, F.lit("nan")),
                    (67, F.concat(_text(signed), F.lit(".7"))),
                    (73, F.lit("1e1")),
                    (89, _text(signed * 1000)),
                ],
                _text(signed),
            ),
            "UnitPrice": _choose(
                dirt,
                [
                    (113, F.concat(F.lit("£"), price)),
                    (103, F.lit("0.00")),
                    (107, F.concat(F.lit("-"), price)),
                    (109, F.concat(_text(each), F.lit(".125"))),
                    (193, F.concat(_text(each), F.lit(".375"))),
                    (127, F.lit("1500.5")),
                ],
                price,
            ),
        }
        if "Description" in columns:
            name = F.upper(F.col("p_name"))
            made["Description"] = _choose(
                dirt,
                [
                    (41, F.lit("")),
                    (43, F.concat(name, F.lit("., -"))),
                    (47, F.concat(F.lit("children's  "), name, F.lit(" t-light"))),
                    (53, F.concat(name, F.lit(" POSTAGE"))),
                    (59, F.concat(name, F.lit(" discount 2nd"))),
                ],
                name,
            )
        if {"InvoiceDate", "CustomerID", "Country"} & set(columns):
            day = F.add_months(F.to_date("o_orderdate"), _MONTHS_FORWARD)
            hour = _text(8 + order % 10)
            minute = F.lpad(_text(order % 60), 2, "0")

            def dated(layout: str, *clock: Column) -> Column:
                return F.concat(F.date_format(day, layout), *clock)

            made["InvoiceDate"] = _choose(
                dirt,
                [
                    (131, F.lit("not a date")),
                    (137, F.lit("2008-12-31 10:00:00")),
                    (139, F.lit("2099-01-01")),
                    (7, dated("dd-MM-yyyy", F.lit(" "), hour, F.lit(":"), minute, F.lit(":00"))),
                    (11, dated("d/M/yyyy")),
                    (13, dated("d-M-yyyy")),
                    (17, dated("yyyy-MM-dd")),
                    (3, dated("d/M/yyyy", F.lit(" "), hour, F.lit(":"), minute)),
                ],
                dated("yyyy-MM-dd", F.lit(" "), hour, F.lit(":"), minute, F.lit(":00")),
            )
            customer = F.col("o_custkey")
            made["CustomerID"] = _choose(
                dirt,
                [
                    (157, F.lit(".0")),
                    (149, F.lit("nan")),
                    (151, F.lit(" Unknown ")),
                    (5, F.lit("")),
                    (19, F.concat(_text(customer + 1), F.lit(".0"))),
                    (23, _text(customer)),
                ],
                F.concat(_text(customer), F.lit(".0")),
            )
        if "Country" in columns:
            # Decided per order, so that a customer's country changes over time.
            made["Country"] = F.when(dirt % 167 == 0, F.lit("")).otherwise(
                _choose(
                    order,
                    [
                        (17, F.lit("UK")),
                        (19, F.lit(" usa ")),
                        (23, F.lit("united  arab-emirates")),
                    ],
                    F.upper(F.col("n_name")),
                )
            )
        return made

    made = texts()
    return lines.select(
        order.alias("seq"),
        "pos",
        "row_id",
        *[made[c].alias(c) for c in RAW_COLUMNS if c in columns],
    )


def quality_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Past quality measurements, read off the event stream's values."""
    events = table(spark, sf_dir, "events")
    return events.select(
        F.col("event_id").cast("string").alias("metric_id"),
        F.when(F.col("user_id") % 3 == 0, "dim_customer")
        .when(F.col("user_id") % 3 == 1, "dim_product")
        .otherwise("fact_sales")
        .alias("table_name"),
        F.col("event_type").alias("metric_name"),
        F.least(F.col("value"), F.lit(100.0)).cast("decimal(15,4)").alias("metric_value"),
        F.col("ts").alias("measured_at"),
        F.col("event_id"),
    )
