"""Invoice parsing, stock-code categories and transaction types."""

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Category, subcategory and gift flag of special stock codes.
SPECIAL_CODES = {
    "AMAZONFEE": ("Fees", "Marketplace Fee", False),
    "BANKCHARGES": ("Fees", "Bank Charge", False),
    "POST": ("Shipping", "Postage", False),
    "DOT": ("Adjustment", "Rounding", False),
    "D": ("Discount", "Manual Discount", False),
    "M": ("Adjustment", "Manual", False),
    "S": ("Services", "Service Charge", False),
    "CRUK": ("Charity", "Donation", False),
    "PADS": ("Stationery", "Pads", False),
    "C2": ("Shipping", "Carrier Surcharge", False),
    "DCGSSBOY": ("Gift Sets", "Boy", True),
    "DCGSSGIRL": ("Gift Sets", "Girl", True),
}

# Transaction type, effect on revenue, description.
TRANSACTION_TYPES = [
    ("SALE", 1, "Normal sale (positive)"),
    ("RETURN", -1, "Customer return"),
    ("ADJUSTMENT_IN", 1, "Stock added"),
    ("ADJUSTMENT_OUT", -1, "Stock removed"),
    ("DISCOUNT", -1, "Promotion or markdown"),
    ("DISCOUNT_REVERSAL", 1, "Reversal of discount"),
    ("FEE", -1, "Cost fee"),
    ("FEE_REVERSAL", 1, "Reversal of fee"),
    ("SHIPPING_CHARGE", 1, "Customer paid postage"),
    ("SHIPPING_REFUND", -1, "Refunded postage"),
    ("VOUCHER_SALE", 0, "Neutral"),
    ("VOUCHER_REDEMPTION", -1, "Redeemed voucher"),
    ("DONATION", -1, "Charitable expense"),
    ("SERVICE", 1, "Service income"),
]

_VOUCHER_AMOUNT = r"GIFT_[A-Z0-9]+_(\d+)"


def is_credit(invoice: Column) -> Column:
    return invoice.startswith("C")


def invoice_number(invoice: Column) -> Column:
    """Digits after an optional leading C as a number; 0 for anything else."""
    digits = F.regexp_extract(invoice, r"^C?(\d+)$", 1)
    return F.coalesce(digits.try_cast("bigint"), F.lit(0).cast("bigint"))


@dataclass(frozen=True)
class Category:
    category: Column
    subcategory: Column
    is_gift: Column


def categorize(stock_code: Column, description: Column) -> Category:
    """First match wins: special code, voucher, gift set, description hint."""
    hint = F.upper(description)
    amount = F.regexp_extract(stock_code, _VOUCHER_AMOUNT, 1)
    cases = [
        (stock_code == code, (F.lit(c), F.lit(s), F.lit(g)))
        for code, (c, s, g) in SPECIAL_CODES.items()
    ]
    cases += [
        (
            stock_code.startswith("GIFT_"),
            (
                F.lit("Gift Voucher"),
                F.when(amount != "", F.concat(F.lit("Voucher £"), amount)).otherwise("Voucher"),
                F.lit(True),
            ),
        ),
        (stock_code.startswith("DCGS"), (F.lit("Gift Sets"), F.lit("DCGS"), F.lit(True))),
        (
            hint.contains("POSTAGE") | hint.contains("SHIPPING"),
            (F.lit("Shipping"), F.lit("Postage"), F.lit(False)),
        ),
        (hint.contains("DISCOUNT"), (F.lit("Discount"), F.lit("Promotion"), F.lit(False))),
    ]
    default = (F.lit("Merchandise"), F.lit("General"), F.lit(False))
    picked = []
    for part in range(3):
        chain = F
        for condition, values in cases:
            chain = chain.when(condition, values[part])
        picked.append(chain.otherwise(default[part]))
    return Category(*picked)


def transaction_type(
    stock_code: Column,
    quantity: Column,
    credit: Column,
    category: Column,
    subcategory: Column,
) -> Column:
    """Type of a line; direction is part of the type, so measures stay positive.

    Code S counts as an adjustment before it could count as a service.
    """

    def by_credit(on_credit: str, otherwise: str) -> Column:
        return F.when(credit, on_credit).otherwise(otherwise)

    adjustment = (
        F.when(quantity < 0, "ADJUSTMENT_OUT")
        .when(quantity > 0, "ADJUSTMENT_IN")
        .otherwise("ADJUSTMENT")
    )
    discount = F.upper(subcategory).contains("DISCOUNT")
    return (
        F.when(category == "Fees", by_credit("FEE_REVERSAL", "FEE"))
        .when(category == "Shipping", by_credit("SHIPPING_REFUND", "SHIPPING_CHARGE"))
        .when(
            (category == "Discount") | discount,
            by_credit("DISCOUNT_REVERSAL", "DISCOUNT"),
        )
        .when(category == "Charity", F.lit("DONATION"))
        .when((category == "Adjustment") | (stock_code == "S"), adjustment)
        .when(
            category == "Gift Voucher",
            F.when(credit | (quantity < 0), "VOUCHER_REDEMPTION").otherwise("VOUCHER_SALE"),
        )
        .when(category == "Services", F.lit("SERVICE"))
        .when(credit, F.lit("RETURN"))
        .when(quantity < 0, F.lit("ADJUSTMENT_OUT"))
        .otherwise(F.lit("SALE"))
    )
