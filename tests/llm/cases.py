"""Small tables with everything an operator may meet, and plain versions of what it should find."""

import random
import re

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names the operators use inside.
CLASHING = ["label", "score", "bucket", "key", "w", "row", "a", "b", "_id", "_row", "component", "at", "found"]


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def words(text):
    return WORD.findall(ascii_lower(text or ""))


def prose(seed, n, vocabulary=400):
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(vocabulary)}" for _ in range(n))


def texts():
    """Nulls, empty and blank texts, odd white space, letters outside ASCII, copies, near copies and a long text."""
    base = prose(1, 300, 5000)
    near = base.split(" ")
    near[150] = "changed"
    long = prose(2, 30_000, 5000)
    return [
        None, "", "   \n\n ", "one", "two words", "Über ßtraße ÉTÉ İstanbul Kelvin", base, base, " ".join(near),
        base + " one more", long, long + " tail", "a\tb\x1cc d", "line one\nline two\nline three",
        "other\nline one\nline two\nend", "<|endoftext|> Don't stop.\r\n", prose(3, 12), prose(3, 12) + " x", "퟿ \U0001f600 emoji",
    ]


def documents(spark, extra=False, rows=None):
    """The texts as a table; a null id, a repeated id and fully equal rows are among the rows."""
    given = texts() if rows is None else rows
    data = [(10 * i, t, "en", "src0" if i % 2 else None, None if t is None else len(t)) for i, t in enumerate(given)]
    if rows is None:
        data += [(None, "no id at all", None, None, None), (10, "an id twice", "en", "src1", 11)] + [(990, "equal rows", "en", "src1", 10)] * 2
    df = spark.createDataFrame(data, SCHEMA)
    if extra:
        from pyspark.sql import functions as F

        df = df.withColumns({c: F.lit("clash") for c in CLASHING})
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
