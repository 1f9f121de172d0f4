"""Conversions cell by cell."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from perron.functions import casts, nested, text

CASES = {
    casts.to_flag: [
        *[(word, True) for word in ("true", "T", "yes", "Y", "on", "ON", "1", " true ", " On")],
        *[(word, False) for word in ("false", "f", "NO", "n", "off", "Off", "0")],
        *[(word, None) for word in ("maybe", "", "2", "onn", "tru", None)],
    ],
    casts.to_whole: [
        ("7", 7), (" 7 ", 7), ("2.5", 3), ("-2.5", -3), ("2.49", 2), ("1e3", 1000), ("+4", 4),
        ("x", None), ("", None), ("1 000", None), (None, None),
        ("9223372036854775807", 2**63 - 1), ("9223372036854775808", None), ("1" * 39, None),
    ],
    casts.to_year: [("2018", 2018), ("2018.4", 2018), ("20222", None), ("", None)],
    casts.to_float: [("2681000.5", 2681000.5), ("-1", -1.0), ("n/a", None), ("", None)],
    casts.to_day: [
        ("31.01.2024", date(2024, 1, 31)), ("29.02.2024", date(2024, 2, 29)), ("29.02.2023", None),
        ("1.1.2024", None), ("2024-01-31", None), ("31.01.2024 05:07", None), ("31.01.24", None),
        ("31x01x2024", None), ("", None), ("a\nb", None), (None, None),
    ],
    casts.to_minute: [
        ("31.01.2024 05:07", datetime(2024, 1, 31, 5, 7)), ("31.03.2024 02:30", datetime(2024, 3, 31, 2, 30)),
        ("31.01.2024 24:00", None), ("31.01.2024 5:07", None), ("31.01.2024", None),
        ("31.01.2024 05:07:09", None), ("2024-01-31 05:07", None), (None, None),
    ],
    casts.to_second: [
        ("31.01.2024 05:07:09", datetime(2024, 1, 31, 5, 7, 9)), ("31.01.2024 05:07", None),
        ("31.01.2024 05:07:61", None), ("31.01.2024 05:07:09 ", None),
    ],
}


@pytest.mark.parametrize("zone", ["UTC", "Europe/Zurich", "America/New_York"])
@pytest.mark.parametrize("cast", CASES, ids=lambda f: f.__name__)
def test_casts(spark, cast, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        frame = spark.createDataFrame([(i, given) for i, (given, _) in enumerate(CASES[cast])], "i int, t string")
        got = [row["v"] for row in frame.select("i", cast(F.col("t")).alias("v")).orderBy("i").collect()]
        assert dict(zip([g for g, _ in CASES[cast]], got)) == dict(CASES[cast])
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_decimals_round_half_up(spark):
    frame = spark.createDataFrame([("35.25",), ("35.24",), ("9999.94",), ("9999.95",), ("-0.05",)], "t string")
    got = [row[0] for row in frame.select(casts.to_decimal(F.col("t"), 5, 1)).collect()]
    assert got == [Decimal("35.3"), Decimal("35.2"), Decimal("9999.9"), None, Decimal("-0.1")]


def one(spark, value, *columns):
    return tuple(spark.createDataFrame([(value,)], "t string").select(*columns).first())


@pytest.mark.parametrize("value, first, last, count", [
    ("A - B - C", "A", " C", 2), ("A -B", "A", "B", 1), ("A", "A", "A", 0), ("", "", "", 0),
    (" -", "", "", 1), (None, None, None, None), ("a.b", "a.b", "a.b", 0),
])
def test_tokens(spark, value, first, last, count):
    t = F.col("t")
    assert one(spark, value, text.first_token(t, " -"), text.last_segment(t, " -"), text.occurrences(t, " -")) == (
        first, last, count)


def test_literal_delimiters_and_spaces(spark):
    t = F.col("t")
    assert one(spark, "a.b.c 1 234", text.occurrences(t, "."), text.first_token(t, "."), text.without_spaces(t),
               text.last_segment(t, ".", trim=True)) == (2, "a", "a.b.c1234", "c 1 234")


def test_prefixed_key(spark):
    frame = spark.createDataFrame([(8503000,), (1,), (None,)], "n bigint").select(F.col("n").cast("decimal(38,0)"))
    got = [row[0] for row in frame.select(text.prefixed_key("p:", F.col("n"), 8500000)).collect()]
    assert got == ["p:3000", "p:-8499999", None]


def test_paths(spark):
    doc = '{"a": {"b": [{"c": 2.5}, {"c": "17"}, {"c": "x"}, {"c": true}]}, "n": null, "s": "t"}'
    frame = spark.createDataFrame([(doc,)], "t string").select(F.parse_json("t").alias("d"))
    got = frame.select(
        *[nested.whole_at("d", f"$.a.b[{i}].c").alias(f"c{i}") for i in range(5)],
        nested.whole_at("d", "$.n").alias("n"),
        nested.size_at("d", "$.a.b").alias("size"),
        nested.size_at("d", "$.s").alias("no_array"),
        nested.size_at("d", "$.missing").alias("missing"),
    ).first()
    assert tuple(got) == (3, 17, None, 1, None, None, 4, None, None)


def test_elements(spark):
    frame = spark.createDataFrame([([5, 6],), ([],), (None,)], "a array<int>")
    assert [tuple(r) for r in frame.select(nested.element("a", 1), nested.element("a", 9)).collect()] == [
        (6, None), (None, None), (None, None)]
    assert [tuple(r) for r in nested.explode_array(frame.withColumn("k", F.lit("x")), "a", "i", "v").collect()] == [
        ("x", 0, 5), ("x", 1, 6)]


def test_days_and_times_need_no_replacement(spark):
    """What a regular expression with groups gave, to the line break at the end, without building a text by it."""
    from perron.functions import casts

    def before(text, clock):
        pattern = r"(?s)^(?:(\d{2})\.(\d{2})\.(\d{4})(" + clock + r")|.*)$"
        return F.regexp_replace(text, pattern, "$3-$2-$1$4")

    days = ["31.12.2024", "29.02.2023", "1.12.2024", "31.12.24", "٣١.١٢.٢٠٢٤", "+1.12.2024", "31-12-2024", "2024-12-31", "", " ", None]
    ends = ["", " 23:59", " 24:00", " 23:59:59", " 23:59:60", "\n", "\r\n", "\u0085", "\n\n", " 23:59\n", " 23:59:59\r", "x", " "]
    texts = [None if day is None else day + end for day in days for end in ends]
    text, kinds = F.col("t"), (("", "date", casts.to_day), (r" \d{2}:\d{2}", "timestamp_ntz", casts.to_minute),
                               (r" \d{2}:\d{2}:\d{2}", "timestamp_ntz", casts.to_second))
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    for clock, kind, read in kinds:
        pairs = frame.select("t", before(text, clock).try_cast(kind).alias("then"), read(text).alias("now")).collect()
        assert [r for r in pairs if r["then"] != r["now"]] == [] and any(r["now"] for r in pairs)
    plan = frame.select(casts.to_second(text))._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" not in plan
