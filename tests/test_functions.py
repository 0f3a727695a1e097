import math
import random

import pytest
from pyspark.sql import functions as F
from tests.helpers import at, tuples

from skyair.functions.predicates import in_range, valid_position
from skyair.functions.text import blank_to_null, concentration, day_label, fixed_decimals, measure, yes_no
from skyair.functions.times import as_instant, days_before, format_utc, from_epoch, parse_utc, utc_day


@pytest.mark.parametrize(
    "text, expected",
    [
        (None, None),
        ("", None),
        ("   ", None),
        ("\tBAW12 \n", "BAW12"),
        ("  a b ", "a b"),
        (" x ", "x"),
        ("\x1cx\x1f", "x"),
    ],
)
def test_blank_to_null_strips_like_python(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(blank_to_null(F.col("t"))).first()[0] == expected
    assert (text or "").strip() or None == expected


def test_fixed_decimals_equals_python_formatting(spark):
    rng = random.Random(7)
    values = [k / 20000 for k in range(-3000, 3000)] + [k / 20 for k in range(-3000, 3000)]
    values += [rng.uniform(-1e-4, 1e-4) for _ in range(3000)] + [rng.uniform(-1e6, 1e6) for _ in range(3000)]
    values += [5e-05, -5e-05, 0.05, -0.05, 0.5, 1.5, 2.5, 0.0, 1e15, 123456789.25]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    shown = df.select("v", *(fixed_decimals(F.col("v"), p).alias(f"p{p}") for p in (0, 1, 4)))
    for row in shown.collect():
        assert (row.p0, row.p1, row.p4) == (f"{row.v:.0f}", f"{row.v:.1f}", f"{row.v:.4f}")


@pytest.mark.parametrize(
    "value, expected",
    [(None, "—"), (math.nan, "—"), (0.0, "0.0000"), (0.008, "0.0080"), (-0.25, "-0.2500"), (1.0, "1.0"), (12.25, "12.2"), (-3.75, "-3.8")],
)
def test_concentration(spark, value, expected):
    assert spark.createDataFrame([(value,)], "v double").select(concentration(F.col("v"))).first()[0] == expected


def test_measure_and_flags(spark):
    df = spark.createDataFrame([(1234.5, True), (None, None), (math.nan, False)], "v double, f boolean")
    assert [tuple(r) for r in df.select(measure(F.col("v"), 0), yes_no(F.col("f"))).collect()] == [
        ("1234", "Yes"),
        ("—", "No"),
        ("—", "No"),
    ]


def test_day_label_is_null_if_a_part_is(spark):
    df = spark.createDataFrame([("Roof", "2026-01-02"), (None, "2026-01-02")], "n string, d string")
    labels = df.select(day_label(F.col("n"), F.col("d").cast("date")))
    assert [r[0] for r in labels.collect()] == ["Roof (2026-01-02)", None]


def test_range_excludes_null_and_nan_and_includes_bounds(spark):
    rows = [(v,) for v in (None, math.nan, -0.1, 0.0, 90.0, 90.0001, math.inf)]
    df = spark.createDataFrame(rows, "v double")
    assert tuples(df.filter(in_range("v", low=0.0))) == [(0.0,), (90.0,), (90.0001,), (math.inf,)]
    assert tuples(df.filter(in_range("v", 0.0, 90.0))) == [(0.0,), (90.0,)]
    assert df.filter(~in_range("v", 0.0, 90.0)).count() == 5


def test_valid_position_bounds(spark):
    rows = [(90.0, 180.0), (-90.0, -180.0), (90.0001, 0.0), (0.0, 180.0001), (None, 0.0), (0.0, math.nan)]
    df = spark.createDataFrame(rows, "latitude double, longitude double")
    assert tuples(df.filter(valid_position())) == [(-90.0, -180.0), (90.0, 180.0)]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Karachi"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    # one microsecond either side of midnight, and a day on which New York shifts its clocks
    seconds = 1_767_225_600  # 2026-01-01T00:00:00Z
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        micros = [(seconds * 10**6 - 1,), (seconds * 10**6,), (1_772_971_200_500_000,)]
        df = spark.createDataFrame(micros, "m bigint").select(F.timestamp_micros("m").alias("t"))
        out = df.select(
            utc_day(df, "t").cast("string").alias("day"),
            format_utc(df, "t").alias("text"),
            F.unix_micros(days_before(df, "t", 1)).alias("before"),
        )
        assert [tuple(r) for r in out.collect()] == [
            ("2025-12-31", "2025-12-31T23:59:59Z", (seconds - 1 - 86400) * 10**6),
            ("2026-01-01", "2026-01-01T00:00:00Z", (seconds - 86400) * 10**6),
            ("2026-03-08", "2026-03-08T12:00:00Z", 1_772_884_800_000_000),
        ]
        naive = spark.sql("SELECT timestamp_ntz'2026-03-08 02:30:00.25' AS t")
        row = naive.select(
            F.unix_micros(as_instant(naive, "t")), utc_day(naive, "t").cast("string"), days_before(naive, "t", 1).cast("string")
        ).first()
        assert tuple(row) == (1_772_937_000_250_000, "2026-03-08", "2026-03-07 02:30:00")
        text = spark.createDataFrame([("2026-01-01T00:00:00Z",), ("soon",), (None,)], "s string")
        assert [r[0] for r in text.select(F.unix_seconds(parse_utc(F.col("s")))).collect()] == [seconds, None, None]
        assert spark.range(1).select(F.unix_seconds(from_epoch(F.lit(seconds)))).first()[0] == seconds
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_at_helper():
    assert at("2026-01-01T00:00:00").year == 2026
