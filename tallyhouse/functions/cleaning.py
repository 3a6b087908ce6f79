"""Cleaning rules: each takes a raw string column and returns a clean one."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyhouse.functions.text import is_blank, strip, title_case, trimmed
from tallyhouse.schemas import MONEY

# Texts that stand for an unknown customer.
NO_CUSTOMER = ["", "nan", "none", "null", "unknown"]

# Country abbreviations after title-casing.
COUNTRY_NAMES = {
    "Uk": "United Kingdom",
    "Usa": "United States",
    "Uae": "United Arab Emirates",
    "Rsa": "South Africa",
}

# A price is parsed exactly before it is rounded to cents.
_EXACT = "decimal(38,18)"


def clean_invoice_no(c: Column) -> Column:
    return F.upper(strip(F.coalesce(c, F.lit(""))))


def clean_stock_code(c: Column) -> Column:
    # (?U): letters and digits of every script count as word characters.
    return F.regexp_replace(
        F.upper(strip(F.coalesce(c, F.lit("")))), r"(?U)[^\w\-\.]", ""
    )


def clean_description(c: Column) -> Column:
    one_spaced = trimmed(F.regexp_replace(c, r"(?U)\s+", " "))
    titled = F.regexp_replace(title_case(one_spaced), r"(?U)[\.\,\-\s]+$", "")
    return F.when(F.coalesce(c, F.lit("")) == "", F.lit("Unknown")).otherwise(titled)


def clean_quantity(c: Column) -> Column:
    """Whole number, cut toward zero; 0 where the text holds none.

    Letters are dropped first, so 1e5 reads as 15. A number outside the integer
    range cannot be stored and also becomes 0. Plain integers, nearly all there
    are, need no pattern.
    """
    kept = F.regexp_replace(c, r"[^\d\-\.]", "")
    return F.coalesce(c.try_cast("int"), kept.try_cast("double").try_cast("int"), F.lit(0))


def clean_unit_price(c: Column) -> Column:
    """Absolute price in cents, half to even; 0.00 where the text holds none."""
    plain = strip(c)
    bare = F.regexp_replace(plain, r"(?U)[£$€\s,]", "")
    exact = F.coalesce(plain.try_cast(_EXACT), bare.try_cast(_EXACT))
    cents = F.bround(F.abs(exact), 2)
    return F.coalesce(cents.try_cast(MONEY), F.lit(0).cast(MONEY))


def names_no_customer(c: Column) -> Column:
    """True where the raw text is absent or one of the unknown markers."""
    return F.lower(strip(F.coalesce(c, F.lit("")))).isin(NO_CUSTOMER)


def clean_customer_id(c: Column) -> Column:
    bare = strip(F.coalesce(c, F.lit("")))
    shortened = F.when(
        bare.endswith(".0"), F.left(bare, F.length(bare) - 2)
    ).otherwise(bare)
    return F.when(names_no_customer(c), F.lit("")).otherwise(shortened)


def clean_country(c: Column) -> Column:
    bare = trimmed(c)
    # Only short texts can be abbreviations.
    named = F.when(F.length(bare) > max(map(len, COUNTRY_NAMES)), title_case(bare))
    for short, full in COUNTRY_NAMES.items():
        named = named.when(F.lower(bare) == short.lower(), F.lit(full))
    return F.when(F.coalesce(c, F.lit("")) == "", F.lit("Unknown")).otherwise(
        named.otherwise(title_case(bare))
    )


# Accepted date layouts in order of preference. Each pattern
# names the parts it captures; years have four digits, other parts one or two.
_TIME = r"\s+(\d{1,2}):(\d{1,2})"
_SECONDS = r":(\d{1,2})"
DATE_LAYOUTS = [
    (r"^(\d{4})-(\d{1,2})-(\d{1,2})" + _TIME + _SECONDS + "$", "ymdHMS"),
    (r"^(\d{1,2})/(\d{1,2})/(\d{4})" + _TIME + "$", "dmyHM"),
    (r"^(\d{1,2})-(\d{1,2})-(\d{4})" + _TIME + _SECONDS + "$", "dmyHMS"),
    (r"^(\d{4})-(\d{1,2})-(\d{1,2})$", "ymd"),
    (r"^(\d{1,2})/(\d{1,2})/(\d{4})$", "dmy"),
    (r"^(\d{1,2})-(\d{1,2})-(\d{4})$", "dmy"),
    # Beyond the declared list: the common layouts a free-form parser accepts.
    (r"^(\d{4})[-/](\d{1,2})[-/](\d{1,2})[T ]\s*(\d{1,2}):(\d{1,2})(?::(\d{1,2}))?(?:\.\d+)?Z?$", "ymdHMS"),
    (r"^(\d{4})/(\d{1,2})/(\d{1,2})$", "ymd"),
    (r"^(\d{1,2})[-/](\d{1,2})[-/](\d{4})(?:" + _TIME + "(?:" + _SECONDS + ")?)?$", "mdyHMS"),
    (r"^(\d{1,2})[-/](\d{1,2})[-/](\d{4})" + _TIME + _SECONDS + "$", "dmyHMS"),
]


def _layout(c: Column, pattern: str, parts: str) -> Column:
    """Rearrange the captured parts to ISO text and cast; NULL if no such date.

    The text is cast to TIMESTAMP_NTZ directly, so the session time zone has no
    say in the result.
    """
    at = {part: f"${i + 1}" for i, part in enumerate(parts)}
    iso = f"{at['y']}-{at['m']}-{at['d']}"
    if "H" in at:
        iso += f" {at['H']}:{at['M']}:" + (at["S"] if "S" in at else "0")
    text = F.regexp_replace(c, pattern, iso)
    if ")?" in pattern:
        # Optional time parts that were absent leave empty places behind.
        text = F.regexp_replace(F.regexp_replace(text, r" ::$", ""), r":$", ":0")
    return F.when(c.rlike(pattern), text.try_cast("timestamp_ntz"))


# Text in one of these forms is cast as it stands.
_CASTABLE = r"^\d{4}-\d{1,2}-\d{1,2}( \d{1,2}:\d{1,2}:\d{1,2})?$"


def clean_date(c: Column) -> Column:
    """First layout that yields a real date; NULL where none does."""
    bare = strip(c)
    direct = F.when(bare.rlike(_CASTABLE), bare.try_cast("timestamp_ntz"))
    return F.coalesce(direct, *[_layout(bare, p, parts) for p, parts in DATE_LAYOUTS])


def fill_unknown(c: Column) -> Column:
    return F.when(is_blank(c), F.lit("Unknown")).otherwise(c)
