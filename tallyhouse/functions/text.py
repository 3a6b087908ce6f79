"""String helpers shared by the cleaning rules; all stay in generated code."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a Python str.strip() removes.
SPACES = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

_MARK = "\x01 "


def _starts_visibly(c: Column) -> Column:
    """True where the first character is one of ASCII's visible ones; text compares by its bytes."""
    return (c >= "!") & (c < "\x7f")


def trimmed(c: Column) -> Column:
    """Text without white space at its ends."""
    return F.btrim(c, F.lit(SPACES))


def strip(c: Column) -> Column:
    """The same for a plain column: most text has no white space at its ends, and is not searched for it.

    The column is named four times, so what has to be worked out first is better `trimmed`.
    """
    last = F.right(c, F.lit(1))
    return F.when(_starts_visibly(c) & _starts_visibly(last), c).otherwise(trimmed(c))


def is_blank(c: Column) -> Column:
    """True for NULL and for text of white space only; never NULL."""
    text = c.cast("string")
    return F.when(_starts_visibly(text), False).otherwise(F.coalesce(trimmed(text) == "", F.lit(True)))


def title_case(c: Column) -> Column:
    """Capitalise every run of letters, so T-LIGHT becomes T-Light.

    initcap only sees spaces as word ends. A marker that ends in a space goes
    between each non-letter and the letter after it, and comes out again.
    """
    marked = F.regexp_replace(c, r"(\P{L})(?=\p{L})", "$1" + _MARK)
    return F.replace(F.initcap(marked), F.lit(_MARK), F.lit(""))


_BETWEEN, _ESCAPE = "\x1f", "\x1b"


def pack(columns: Sequence[str]) -> Column:
    """Texts as one text, NULL and the marks themselves kept apart; a row pays for its slots on the network, not for each text."""

    def safe(name: str) -> Column:
        text = F.replace(F.replace(F.col(name), F.lit(_ESCAPE), F.lit(_ESCAPE + "e")), F.lit(_BETWEEN), F.lit(_ESCAPE + "s"))
        return F.coalesce(text, F.lit(_ESCAPE + "n"))

    return F.concat_ws(_BETWEEN, *[safe(c) for c in columns])


def unpack(packed: str, columns: Sequence[str]) -> dict[str, Column]:
    """The texts that `pack` made one of, byte for byte; each is looked for from the nearer end."""

    marked = F.contains(F.col(packed), F.lit(_ESCAPE))

    def text(place: int) -> Column:
        first, last = place + 1, place - len(columns)
        near, end = (first, -1) if first <= -last else (last, 1)
        part = F.substring_index(packed, _BETWEEN, near)
        if near != -end:
            part = F.substring_index(part, _BETWEEN, end)
        plain = F.replace(F.replace(part, F.lit(_ESCAPE + "s"), F.lit(_BETWEEN)), F.lit(_ESCAPE + "e"), F.lit(_ESCAPE))
        return F.when(~marked, part).when(part != _ESCAPE + "n", plain)

    return {name: text(place) for place, name in enumerate(columns)}
