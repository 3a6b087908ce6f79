from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhouse.functions import classify
from tallyhouse.operators import transform

CASES = [
    # stock code, description, invoice, units, category, subcategory, gift, type
    ("85123A", "Heart", "536365", 2, "Merchandise", "General", False, "SALE"),
    ("85123A", "Heart", "C536365", -2, "Merchandise", "General", False, "RETURN"),
    ("85123A", "Heart", "C536365", 2, "Merchandise", "General", False, "RETURN"),
    ("85123A", "Heart", "536365", -2, "Merchandise", "General", False, "ADJUSTMENT_OUT"),
    ("POST", "Postage", "536365", 1, "Shipping", "Postage", False, "SHIPPING_CHARGE"),
    ("C2", "Carriage", "C536365", -1, "Shipping", "Carrier Surcharge", False, "SHIPPING_REFUND"),
    ("X1", "Dotcom Postage", "536365", 1, "Shipping", "Postage", False, "SHIPPING_CHARGE"),
    ("X1", "Summer Discount", "536365", 1, "Discount", "Promotion", False, "DISCOUNT"),
    ("D", "Discount", "C536365", -1, "Discount", "Manual Discount", False, "DISCOUNT_REVERSAL"),
    ("AMAZONFEE", "Fee", "536365", 1, "Fees", "Marketplace Fee", False, "FEE"),
    ("BANKCHARGES", "Fee", "C536365", -1, "Fees", "Bank Charge", False, "FEE_REVERSAL"),
    ("CRUK", "Charity", "C536365", -1, "Charity", "Donation", False, "DONATION"),
    ("M", "Manual", "536365", 3, "Adjustment", "Manual", False, "ADJUSTMENT_IN"),
    ("DOT", "Round", "536365", -3, "Adjustment", "Rounding", False, "ADJUSTMENT_OUT"),
    ("S", "Sample", "536365", 1, "Services", "Service Charge", False, "ADJUSTMENT_IN"),
    ("GIFT_0001_20", "Voucher", "536365", 1, "Gift Voucher", "Voucher £20", True, "VOUCHER_SALE"),
    ("GIFT_0002", "Voucher", "536365", -1, "Gift Voucher", "Voucher", True, "VOUCHER_REDEMPTION"),
    ("GIFT_0001_20", "Voucher", "C536365", 1, "Gift Voucher", "Voucher £20", True, "VOUCHER_REDEMPTION"),
    ("DCGSSBOY", "Set", "536365", 1, "Gift Sets", "Boy", True, "SALE"),
    ("DCGSSGIRL", "Set", "536365", 1, "Gift Sets", "Girl", True, "SALE"),
    ("DCGS0001", "Set", "536365", 1, "Gift Sets", "DCGS", True, "SALE"),
    ("PADS", "Pads", "536365", 1, "Stationery", "Pads", False, "SALE"),
]


def test_category_and_type(spark):
    df = spark.createDataFrame(
        [c[:4] for c in CASES], "stock_code string, description string, invoice string, units int"
    )
    parts = classify.categorize(F.col("stock_code"), F.col("description"))
    credit = classify.is_credit(F.col("invoice"))
    kind = classify.transaction_type(
        F.col("stock_code"), F.col("units"), credit, parts.category, parts.subcategory
    )
    out = df.select("*", parts.category, parts.subcategory, parts.is_gift, kind).collect()
    assert [tuple(r) for r in out] == CASES


@pytest.mark.parametrize(
    "text,number",
    [("536365", 536365), ("C536379", 536379), ("536365A", 0), ("", 0), ("C", 0), ("CC1", 0)],
)
def test_invoice_number(spark, text, number):
    df = spark.createDataFrame([(text,)], "v string")
    assert df.select(classify.invoice_number(F.col("v"))).first()[0] == number


def test_basic_sale(spark):
    line = (0, 0, "536365", "85123A", 2, Decimal("3.50"), "17850", "Heart", "United Kingdom", "2010-12-01 08:26:00")
    df = spark.createDataFrame(
        [line],
        "seq bigint, pos bigint, invoice string, stock_code string, quantity int, unit_price decimal(10,2),"
        " customer_id string, description string, country string, t string",
    ).withColumn("transaction_datetime", F.col("t").cast("timestamp_ntz"))
    row = transform.conform(df).first()
    assert row.transaction_type == "SALE"
    assert row.invoice_no == 536365
    assert row.quantity == 2
    assert row.line_total == Decimal("7.00")
    assert row.customer_id == "17850"
    assert str(row.transaction_date) == "2010-12-01"


def test_every_emitted_type_has_an_effect(spark):
    known = {r.transaction_type for r in transform.transaction_types(spark).collect()}
    assert {c[-1] for c in CASES} <= known
    assert len(known) == 14


def test_line_total_beyond_its_range_has_no_value(spark):
    df = spark.createDataFrame([(2**31 - 1, Decimal("99999999.99"))], "q int, p decimal(10,2)")
    assert df.select(transform.line_total(F.col("q"), F.col("p"))).first()[0] is None
