"""Dates people write by hand, as column expressions without a Python worker.

A text is a date and perhaps a clock: numbers, one month by name, a weekday,
ordinal endings, AM or PM, and a zone after a clock. The clock is taken out
first; what is left has to fit one of the orders in `ORDERS`, so a text with
anything else in it is NULL.

Two-digit years up to 68 are in this century. Day first comes before month
first. A zone is taken off the clock, so the result is in UTC.
"""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyhouse.functions.cleaning import clean_date
from tallyhouse.functions.text import strip

# Names a date may hold.
MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
_MONTH = (
    r"\b(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?"
    r"|nov(?:ember)?|dec(?:ember)?)(?![a-z])"
)
_WEEKDAY = r"\b(?:mon(?:day)?|tue(?:s(?:day)?)?|wed(?:nesday)?|thu(?:r(?:s(?:day)?)?)?|fri(?:day)?|sat(?:urday)?|sun(?:day)?)\b"
_CLOCK = r"(?:\b|(?<=\d)t)(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,]\d+)?)?\s*([ap])?(?:(?<=[ap])\.?m\.?)?"
_ZONE = r"\s*(z|utc|gmt|[+-]\d{2}:?\d{2})?$"
_HOUR = r"\b(\d{1,2})\s*([ap])\.?m\.?$"
_PACKED_CLOCK = r"(?<=\d{8})[t ]?(\d{2})(\d{2})(\d{2})?" + _ZONE

_YEAR = r"(\d{4}|\d{2})"
#: Patterns of the date without clock, single blanks between its parts and @ for the month's name, with what they capture.
ORDERS = [
    (rf"^(\d{{1,2}}) ?@ ?{_YEAR}$", "dy"),
    (rf"^@ ?(\d{{1,2}}) {_YEAR}$", "dy"),
    (r"^(\d{4}) ?@ ?(\d{1,2})$", "yd"),
    (r"^@ ?(\d{4})$", "y"),
    (r"^(\d{4})(\d{2})(\d{2})$", "ymd"),
    (r"^(\d{4}) (\d{1,2}) (\d{1,2})$", "ymd"),
    (rf"^(\d{{1,2}}) (\d{{1,2}}) {_YEAR}$", "dmy"),
    (rf"^(\d{{1,2}}) (\d{{1,2}}) {_YEAR}$", "mdy"),
]


def clean_date_free(c: Column) -> Column:
    """As `clean_date`; texts that fit none of its layouts are read as written by hand."""
    return F.coalesce(clean_date(c), free_date(c))


def free_date(c: Column) -> Column:
    """Date and time of a text written by hand; NULL if it is none."""
    # @ stands for the month below, so a text's own @ must not.
    text = F.regexp_replace(F.translate(F.lower(strip(c)), "@", "?"), r"(\d)(?:st|nd|rd|th)\b", "$1")
    return _let(text, lambda t: _let(F.struct(_named_month(t).alias("month"), _bare(t).alias("bare")), _read))


def _named_month(text: Column) -> Column:
    return (F.instr(F.lit(MONTHS), F.left(F.regexp_extract(text, _MONTH, 1), F.lit(3))) + 2) / 3


def _bare(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, _WEEKDAY, " "), _MONTH, "@")


def _read(found: Column) -> Column:
    bare = found["bare"]
    clock, hour, packed = _CLOCK + _ZONE, _HOUR, _PACKED_CLOCK
    forms = [
        (clock, _time(bare, clock, 1, 2, 3, 4, 5)),
        (hour, _time(bare, hour, 1, None, None, 2, None)),
        (packed, _time(bare, packed, 1, 2, 3, None, 4)),
    ]
    date = F
    seconds = F
    for pattern, value in forms:
        date = date.when(bare.rlike(pattern), F.regexp_replace(bare, pattern, " "))
        seconds = seconds.when(bare.rlike(pattern), value)
    date, seconds = date.otherwise(bare), seconds.otherwise(F.lit(0))
    parts = F.regexp_replace(F.regexp_replace(date, r"\b(?:of|at|the)\b", " "), r"[\s,./-]+", " ")

    def day(text: Column) -> Column:
        return F.coalesce(*[_ordered(text, pattern, what, found["month"]) for pattern, what in ORDERS])

    return _let(F.trim(parts), day) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is worked out once; written in place, it would be repeated wherever it is named."""
    return F.get(F.transform(F.array(value), body), 0)


def _time(text: Column, pattern: str, hour: int, minute: int | None, second: int | None, half: int | None, zone: int | None) -> Column:
    """Seconds after midnight UTC; NULL if the clock cannot show that."""
    part = lambda n: F.lit("") if n is None else F.regexp_extract(text, pattern, n)
    number = lambda n: F.coalesce(part(n).try_cast("int"), F.lit(0))
    h, m, s, noon = number(hour), number(minute), number(second), part(half)
    of_day = F.when(noon == "", F.when(h < 24, h)).when(h.between(1, 12), h % 12 + F.when(noon == "p", 12).otherwise(0))
    digits = F.regexp_replace(part(zone), "[^0-9]", "")
    ahead = F.coalesce(F.left(digits, F.lit(2)).try_cast("int"), F.lit(0)) * 3600
    ahead += F.coalesce(F.substring(digits, 3, 2).try_cast("int"), F.lit(0)) * 60
    ahead *= F.when(F.left(part(zone), F.lit(1)) == "-", -1).otherwise(1)
    return F.when((m < 60) & (s < 60), of_day * 3600 + m * 60 + s - ahead).cast("decimal(18,6)")


def _ordered(text: Column, pattern: str, parts: str, named: Column) -> Column:
    at = {p: F.regexp_extract(text, pattern, i + 1) for i, p in enumerate(parts)}
    short = at["y"].try_cast("int")
    year = F.when(F.length(at["y"]) == 2, short + F.when(short <= 68, 2000).otherwise(1900)).otherwise(short)
    month = at["m"].try_cast("int") if "m" in at else named.cast("int")
    day = at["d"].try_cast("int") if "d" in at else F.lit(1)
    iso = F.format_string("%04d-%02d-%02d", year, month, day)
    return F.when(text.rlike(pattern), iso.try_cast("timestamp_ntz"))
