"""Words and word grams as Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What parts words once A-Z are lower case, and once a-z are upper case.
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD_UPPER = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _extract(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def words(text: Column) -> Column:
    """A-Z lower-cased, then runs of letters, digits and whatever is not ASCII; missing text has none."""
    text = F.coalesce(text, F.lit(""))
    # lower() changes other letters too, so only plain ASCII may take that way; translate() is slower.
    ascii_only = F.octet_length(text) == F.char_length(text)
    return _extract(F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER)), _WORD)


def folded_words(text: Column) -> Column:
    """The same words, upper-cased letter by letter: equal words stay equal, and this is fast for any text."""
    return _extract(F.upper(F.coalesce(text, F.lit(""))), _WORD_UPPER)


def positions(words: Column, size: int) -> Column:
    """0, 1, ...: where `size` consecutive words begin."""
    last = F.size(words) - F.lit(size)
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def gram_hashes(words: Column, size: int) -> Column:
    """A hash of each run of `size` words."""
    return F.transform(positions(words, size), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(size)]))
