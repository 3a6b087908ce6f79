"""Row-local checks on raw and on cleaned columns; none returns NULL."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyhouse.functions.text import is_blank, strip

# Columns a raw line needs before it enters the load.
GATE_COLUMNS = ["InvoiceNo", "StockCode", "Quantity", "InvoiceDate", "UnitPrice"]

# Fixed value: an optional credit mark, five to seven digits, an optional letter.
INVOICE_PATTERN = r"^[C]?\d{5,7}[A-Z]?$"

# Fixed value: the first day a sale may carry.
FIRST_SALE_DAY = "2009-01-01"

# A decimal number, or one of the special floating-point names.
_NUMBER = r"(?i)^[+-]?((\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?|inf(inity)?|nan)$"


def is_number(c: Column) -> Column:
    """A decimal cast settles the common case; the pattern decides the rest."""
    plain = strip(c)
    decimal = plain.try_cast("decimal(38,18)").isNotNull()
    return decimal | F.coalesce(plain.rlike(_NUMBER), F.lit(False))


def passes_gate() -> Column:
    """A raw line is admitted with all five columns present and both numbers legible."""
    admitted = is_number(F.col("Quantity")) & is_number(F.col("UnitPrice"))
    for name in GATE_COLUMNS:
        admitted = admitted & ~is_blank(F.col(name))
    return admitted


def present(c: Column) -> Column:
    return ~is_blank(c)


def invoice_format_ok(c: Column) -> Column:
    return F.coalesce(c.rlike(INVOICE_PATTERN), F.lit(False))


def quantity_ok(c: Column) -> Column:
    return F.coalesce(c != 0, F.lit(False))


def price_ok(c: Column) -> Column:
    return F.coalesce(c >= 0, F.lit(False))


def date_ok(c: Column, as_of: str, first_day: str = FIRST_SALE_DAY) -> Column:
    """Between the first sale day and as_of, both days included."""
    day = c.cast("date")
    inside = (day >= F.lit(first_day).cast("date")) & (day <= F.lit(as_of).cast("date"))
    return F.coalesce(inside, F.lit(False))


def extreme_quantity(c: Column, limit: int = 10000) -> Column:
    return F.coalesce(F.abs(c) > limit, F.lit(False))


def extreme_price(c: Column, limit: int = 1000) -> Column:
    return F.coalesce(c > limit, F.lit(False))
