"""Golden values of every cleaning and validation rule."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhouse.functions import cleaning, free_dates, text, validation
from tallyhouse.functions.text import is_blank, strip, title_case


def apply(spark, function, values):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, v string")
    out = df.select("i", function(F.col("v")).alias("r")).orderBy("i").collect()
    return [r.r for r in out]


def check(spark, function, cases):
    assert apply(spark, function, list(cases)) == list(cases.values())


def test_invoice_no(spark):
    check(
        spark,
        cleaning.clean_invoice_no,
        {"536365": "536365", " c536379\t": "C536379", None: "", "": "", "a563185": "A563185"},
    )


def test_stock_code(spark):
    check(
        spark,
        cleaning.clean_stock_code,
        {" 85123a ": "85123A", "gift 0001_20": "GIFT0001_20", "É1": "É1", "a-1.b#": "A-1.B", None: ""},
    )


def test_description(spark):
    check(
        spark,
        cleaning.clean_description,
        {
            "WHITE HANGING HEART T-LIGHT HOLDER": "White Hanging Heart T-Light Holder",
            "CHILDREN'S  SET. ,-": "Children'S Set",
            None: "Unknown",
            "": "Unknown",
            "  ": "",
            "3d dog 4you": "3D Dog 4You",
        },
    )


def test_title_case_is_python_title(spark):
    texts = ["o'neil x9y_z", "élan VITAL", "a\tb", " lead", "x--y", "T-LIGHT 2ND", "", "123abc"]
    assert apply(spark, title_case, texts) == [t.title() for t in texts]


def test_quantity(spark):
    check(
        spark,
        cleaning.clean_quantity,
        {
            "6": 6, "-1": -1, "2.7": 2, "-2.7": -2, "0": 0, "abc": 0, "1e5": 15, "": 0, " ": 0,
            None: 0, "nan": 0, "1,200": 1200, "99999999999": 0, "--5": 0, "12d": 12,
        },
    )


def test_unit_price(spark):
    expected = {
        "2.55": "2.55", "-2.55": "2.55", "0": "0.00", "2.125": "2.12", "2.135": "2.14",
        "2.1250000001": "2.13", "£2.55": "2.55", "1,234.5": "1234.50", "nan": "0.00",
        "": "0.00", None: "0.00", "x": "0.00", "1e2": "100.00",
    }
    check(spark, cleaning.clean_unit_price, {k: Decimal(v) for k, v in expected.items()})


def test_customer_id(spark):
    check(
        spark,
        cleaning.clean_customer_id,
        {"17850.0": "17850", " 12 ": "12", "nan": "", "Unknown": "", "NONE": "", None: "", ".0": "", "1.00": "1.00"},
    )


def test_country(spark):
    check(
        spark,
        cleaning.clean_country,
        {"UK": "United Kingdom", " usa": "United States", "uae": "United Arab Emirates", "Rsa": "South Africa",
         "EIRE": "Eire", "": "Unknown", None: "Unknown", "united kingdom": "United Kingdom"},
    )


DATES = {
    "2010-12-01 08:26:00": datetime(2010, 12, 1, 8, 26),
    "1/12/2010 8:26": datetime(2010, 12, 1, 8, 26),
    "12/1/2010 8:26": datetime(2010, 1, 12, 8, 26),
    "01-12-2010 08:26:00": datetime(2010, 12, 1, 8, 26),
    "2010-12-01": datetime(2010, 12, 1),
    "31/12/2010": datetime(2010, 12, 31),
    "31-12-2010": datetime(2010, 12, 31),
    " 2010-1-2 3:04:05 ": datetime(2010, 1, 2, 3, 4, 5),
    "12/31/2010 8:26": datetime(2010, 12, 31, 8, 26),
    "12/31/2010": datetime(2010, 12, 31),
    "2010-12-01T08:26": datetime(2010, 12, 1, 8, 26),
    "2010-12-01 08:26": datetime(2010, 12, 1, 8, 26),
    "13/12/2010 08:26:00": datetime(2010, 12, 13, 8, 26),
    "2010-02-30": None,
    "x": None,
    "": None,
    None: None,
}


def test_date(spark):
    check(spark, cleaning.clean_date, DATES)


# Every layout of FREE is one that `clean_date` turns down.
FREE = {
    "1 Dec 2010": datetime(2010, 12, 1),
    "01-Dec-2010": datetime(2010, 12, 1),
    "1-dec-10 8:26": datetime(2010, 12, 1, 8, 26),
    "1st of December 2010": datetime(2010, 12, 1),
    "Dec 1, 2010": datetime(2010, 12, 1),
    "Dec 1, 2010 8:26 AM": datetime(2010, 12, 1, 8, 26),
    "December 22nd, 2010 at 8:26:07 p.m.": datetime(2010, 12, 22, 20, 26, 7),
    "Wed, 01 Dec 2010 08:26:00 GMT": datetime(2010, 12, 1, 8, 26),
    "Wednesday 1 December 2010": datetime(2010, 12, 1),
    "2010-Dec-01": datetime(2010, 12, 1),
    "2010 Sept. 3": datetime(2010, 9, 3),
    "May 2010": datetime(2010, 5, 1),
    "20101201": datetime(2010, 12, 1),
    "20101201T082600": datetime(2010, 12, 1, 8, 26),
    "20101201 0826": datetime(2010, 12, 1, 8, 26),
    "01.12.2010": datetime(2010, 12, 1),
    "31.12.2010 23:59": datetime(2010, 12, 31, 23, 59),
    "12.31.2010": datetime(2010, 12, 31),
    "1/12/10": datetime(2010, 12, 1),
    "1/12/69 8:26": datetime(1969, 12, 1, 8, 26),
    "12/1/2010 12:05 am": datetime(2010, 1, 12, 0, 5),
    "12/1/2010 12 PM": datetime(2010, 1, 12, 12),
    "2010-12-01T08:26:00+02:00": datetime(2010, 12, 1, 6, 26),
    "2010-12-01 23:30:00 -0100": datetime(2010, 12, 2, 0, 30),
}
NOT_DATES = ["30 Feb 2010", "Dec 2010 Jan", "1 Dec", "13:61 1 Dec 2010", "1 Dec 2010 13:00 pm", "Decade 1 2010", "8:26", "1 2",
             "2010", "x 1 Dec 2010", "32 Dec 2010", "1 Dec 2010 25:00", "20101301", "mayday 1 2010", "may", "@", "1 @ 2010"]


def test_free_dates(spark):
    check(spark, free_dates.clean_date_free, {**DATES, **FREE, **dict.fromkeys(NOT_DATES)})
    check(spark, cleaning.clean_date, dict.fromkeys(FREE))
    df = spark.createDataFrame([("1 Dec 2010",)], "t string").select(free_dates.clean_date_free(F.col("t")))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("zone", ["America/New_York", "Europe/London"])
def test_date_does_not_depend_on_the_session_time_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        check(spark, cleaning.clean_date, {"2010-03-14 02:30:00": datetime(2010, 3, 14, 2, 30)} | DATES)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_numbers_follow_the_python_grammar(spark):
    cases = {"1": True, "-1.5e3": True, ".5": True, "5.": True, "nan": True, "Infinity": True,
             "12d": False, "0x1p3": False, "": False, None: False, "£2": False, " 7 ": True}
    check(spark, validation.is_number, cases)


def test_invoice_format(spark):
    cases = {"536365": True, "C536365": True, "536365A": True, "A563185": False, "1234": False,
             "12345678": False, "": False, None: False}
    check(spark, validation.invoice_format_ok, cases)


def test_date_range_includes_both_ends(spark):
    cases = {"2009-01-01 00:00:00": True, "2008-12-31 23:59:59": False, "2016-08-02 23:59:59": True,
             "2016-08-03 00:00:00": False, None: False}
    check(spark, lambda c: validation.date_ok(c.cast("timestamp_ntz"), "2016-08-02"), cases)


def test_white_space_is_found_at_either_end_and_texts_without_it_stay(spark):
    texts = [None, "", " ", "a", "a b", " a", "a ", "\xa0a", "a　", "\x1fa\x85", "é", "é ", "\x7f", "~ ", "!", "日本", "日本 "]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = rows.select("i", strip(F.col("t")).alias("s"), is_blank(F.col("t")).alias("b")).collect()
    assert {r.i: r.s for r in found} == {i: None if t is None else t.strip() for i, t in enumerate(texts)}
    assert {r.i: r.b for r in found} == {i: not (t or "").strip() for i, t in enumerate(texts)}


def test_only_short_countries_are_looked_up(spark):
    texts = ["uk", " USA ", "Rsa", "uae", "ukraine", "usa east", "us", "t-land", "ＵＫ", "", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = {texts[r.i]: r.c for r in rows.select("i", cleaning.clean_country(F.col("t")).alias("c")).collect()}
    assert found == {
        "uk": "United Kingdom", " USA ": "United States", "Rsa": "South Africa", "uae": "United Arab Emirates", "ukraine": "Ukraine",
        "usa east": "Usa East", "us": "Us", "t-land": "T-Land", "ＵＫ": "Ｕｋ", "": "Unknown", None: "Unknown",
    }


def test_packed_texts_come_back_byte_for_byte(spark):
    values = [None, "", "a", "\x1f", "\x1b", "\x1bn", "\x1bs", "x\x1fy", "\x1b\x1f", "é£ "]
    for n in (1, 2, 3, 6):
        names = [f"c{i}" for i in range(n)]
        rows = [tuple(values[(i * 7 + j * j * 3 + i // 5) % len(values)] for j in range(n)) for i in range(50)]
        df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in names)).select("*", text.pack(names).alias("p"))
        back = df.select(*[c.alias(f"b{i}") for i, c in enumerate(text.unpack("p", names).values())], *names).collect()
        assert all(tuple(r[:n]) == tuple(r[n:]) for r in back)
    torn = spark.range(1).select(F.unhex(F.lit("FFFE61")).cast("string").alias("a"), F.lit("b").alias("b"))
    back = torn.select("a", text.pack(["a", "b"]).alias("p")).select(F.hex("a"), F.hex(text.unpack("p", ["a", "b"])["a"])).first()
    assert back[0] == back[1] == "FFFE61"
