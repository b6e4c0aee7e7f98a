import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import values as V
from ledgerloom.functions.envelope import format_envelope, parse_envelope
from ledgerloom.operators.parameters import bind_parameters


def texts(spark, rows):
    return spark.createDataFrame([(r,) for r in rows], "t string")


def test_date_floor(spark):
    days = [dt.datetime(1752, 12, 31), dt.datetime(1753, 1, 1), dt.datetime(1753, 1, 2), None]
    df = spark.createDataFrame([(d,) for d in days], "d timestamp_ntz")
    got = [r[0] for r in df.select(V.floor_date(F.col("d"))).collect()]
    assert got == [days[1], days[1], days[2], None]


def test_string_size_counts_utf16_units(spark):
    df = texts(spark, ["", "abc", "ä", "😀a", None])
    assert [r[0] for r in df.select(V.string_size(F.col("t"))).collect()] == [1, 3, 1, 3, None]
    sql = df.selectExpr(V.text_units_sql("t"))
    assert [r[0] for r in sql.collect()] == [0, 3, 1, 3, None]


def test_is_blank(spark):
    df = texts(spark, [None, "", "  ", " a ", "\t"])
    assert [r[0] for r in df.select(V.is_blank(F.col("t"))).collect()] == [True, True, True, False, False]


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin"])
def test_duration_does_not_depend_on_the_zone(spark, conf, zone):
    conf({"spark.sql.session.timeZone": zone})
    # Clocks change in Berlin between these two.
    times = (dt.datetime(2024, 3, 31, 1, 0), dt.datetime(2024, 3, 31, 4, 0, 0, 1500))
    df = spark.createDataFrame([times, (times[0], None)], "a timestamp_ntz, b timestamp_ntz")
    assert [r[0] for r in df.select(V.duration_ms(F.col("a"), F.col("b"))).collect()] == [10800001, None]


CASTS = [
    ("byte", ["0", "255", "256", "-1", "x"], [0, 255, None, None, None]),
    ("sbyte", ["-128", "127", "128"], [-128, 127, None]),
    ("short", ["32767", "32768", "1.5"], [32767, None, None]),
    ("ushort", ["65535", "65536"], [65535, None]),
    ("int", ["2147483647", "2147483648", ""], [2147483647, None, None]),
    ("uint", ["4294967295", "4294967296", "-1"], [4294967295, None, None]),
    ("long", ["-9223372036854775808", "9223372036854775808"], [-9223372036854775808, None]),
    ("ulong", ["18446744073709551615", "18446744073709551616", "1.5"], [decimal.Decimal(2**64 - 1), None, None]),
    ("float", ["1.5", "x"], [1.5, None]),
    ("double", ["1e300", "x"], [1e300, None]),
    ("decimal", ["1.25", "x"], [decimal.Decimal("1.2500000000"), None]),
    ("decimal(5,2)", ["1.25", "12345.6"], [decimal.Decimal("1.25"), None]),
    ("bool", ["true", "False", "maybe"], [True, False, None]),
    ("string", ["", "a"], ["", "a"]),
    ("char", ["a", "ab", ""], ["a", None, None]),
    ("Guid", ["0F8FAD5B-D9CB-469F-A165-70867728950E", "0f8f"], ["0f8fad5b-d9cb-469f-a165-70867728950e", None]),
    ("DateTime", ["2024-01-02 03:04:05", "0001-01-01", "x"], [dt.datetime(2024, 1, 2, 3, 4, 5), dt.datetime(1753, 1, 1), None]),
    ("byte[]", ["ab"], [bytearray(b"ab")]),
    ("XElement", ["<a/>"], ["<a/>"]),
    ("XmlDocument", ["<a/>"], ["<a/>"]),
]


@pytest.mark.parametrize("type_name,given,expected", CASTS, ids=[c[0] for c in CASTS])
def test_cast_text(spark, type_name, given, expected):
    got = texts(spark, given).select(V.cast_text(F.col("t"), type_name)).collect()
    assert [r[0] for r in got] == expected


def test_date_time_offset_keeps_the_offset(spark):
    df = texts(spark, ["0001-01-01T02:00:00+02:00", "x"])
    got = [r[0] for r in df.select(V.cast_text(F.col("t"), "DateTimeOffset").cast("string")).collect()]
    assert got == ["{0001-01-01 00:00:00, +02:00}", None]


def test_unsupported_type_is_an_error():
    with pytest.raises(ValueError, match="TimeSpan"):
        V.cast_text(None, "TimeSpan")


def test_bind_columns_lists_what_does_not_fit(spark):
    df = spark.createDataFrame([("1", "x", "k"), (None, "2", "l")], "a string, b string, c string")
    got = V.bind_columns(df, {"a": "int", "b": "byte"}).collect()
    assert [tuple(r) for r in got] == [(1, None, "k", "b"), (None, 2, "l", "")]


def test_bind_parameters(spark):
    rows = [
        (1, "@a", "int", "5"), (1, "@b", "int?", None), (1, "@c", "TimeSpan", "1"), (1, "@d", "string", ""),
        (2, "@a", "int", "x"), (2, "@b", "string", "x"), (2, "@b", "string", "y"),
    ]
    df = spark.createDataFrame(rows, "request_id int, name string, type_name string, value string")
    got = sorted((r.request_id, r.name, r.db_type, r.size, r.status) for r in bind_parameters(df).collect())
    assert got == [
        (1, "@a", "Int32", None, "ok"),
        (1, "@b", "Int32", None, "ok"),
        (1, "@c", None, None, "unsupported type"),
        (1, "@d", "String", 1, "ok"),
        (2, "@a", "Int32", None, "bad value"),
        (2, "@b", "String", 1, "duplicate name"),
        (2, "@b", "String", 1, "duplicate name"),
    ]


def test_envelopes(spark):
    df = texts(spark, ["5,ok", "-1,a, b", "7", "x,bad code", None])
    got = [tuple(r) for r in df.select(parse_envelope(F.col("t")).alias("e")).select("e.*").collect()]
    assert got == [
        (5, "ok", "Debug", True),
        (-1, "a, b", "Error", False),
        (7, None, "Debug", True),
        (None, "bad code", None, None),
        (None, None, None, None),
    ]
    assert df.select(format_envelope(F.lit(3), F.lit("a, b"))).first()[0] == "3,a, b"


def test_binding_loses_nothing(spark):
    """Digits and zones that a type can't keep are refused, sizes and nullable marks are known."""
    cases = [
        ("decimal", "0.123456789012345", False), ("decimal", "1234567890123456789012345678.0123456789", True),
        ("decimal", "0001.50", True), ("decimal", ".", False), ("decimal(4,2)", "99.99", True),
        ("decimal(4,2)", "100", False), ("decimal(4,2)", "1.001", False), ("decimal(4,2)?", "1.10", True),
        ("DateTime", "2020-01-01T10:00:00+05:00", False), ("DateTime", "2020-01-01 10:00:00Z", False),
        ("DateTime", "2020-01-01 10:00:00.123456", True), ("int?", None, True), ("int?", "1", True),
    ]
    rows = [(i, "@p", t, v) for i, (t, v, _) in enumerate(cases)]
    df = spark.createDataFrame(rows, "request_id int, name string, type_name string, value string")
    got = {r.request_id: r.status for r in bind_parameters(df).collect()}
    assert got == {i: "ok" if fits else "bad value" for i, (_, _, fits) in enumerate(cases)}
