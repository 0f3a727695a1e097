import json
import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from tests.helpers import at, tuples

from skyair.functions.predicates import valid_reading
from skyair.operators.cleaning import clean
from skyair.operators.joining import parse_boxes
from skyair.operators.selection import latest
from skyair.plans.medallion import refine
from skyair.schemas import FLIGHTS
from skyair.streaming.incremental import clean_stream, compact_latest, latest_stream, maintain_latest, read_latest
from skyair.streaming.landing import land, land_states, query_id
from skyair.streaming.silver import LATE, maintain_silver, merge_late, read_silver, touched_days, watermark_of
from skyair.streaming.states import parse_states

RECORDS = "icao24 string, observed_at timestamp, value double, arrival int"


class Feed:
    """A folder that a stream reads one file per batch, in the order of their numbers."""

    def __init__(self, spark, folder, schema):
        self.spark, self.folder, self.schema, self.files = spark, folder, schema, 0
        folder.mkdir()

    def add(self, rows):
        df = self.spark.createDataFrame(rows, self.schema)
        lines = df.select(F.to_json(F.struct(*df.columns), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})).collect()
        self.files += 1
        (self.folder / f"{self.files:04d}.json").write_text("\n".join(line[0] for line in lines))

    def stream(self):
        return self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1).json(str(self.folder))


@pytest.fixture
def feed(spark, tmp_path):
    return lambda schema=RECORDS: Feed(spark, tmp_path / "feed", schema)


@pytest.fixture
def paths(tmp_path):
    return lambda name: str(tmp_path / name)


def run(query):
    query.awaitTermination()
    assert query.exception() is None


def payload(time, *icao24):
    states = [[i, None, "X", 0, 0, 1.0 * n, 2.0 * n, None, False, None, None, None, None, None, None] for n, i in enumerate(icao24)]
    return json.dumps({"time": time, "states": states})


def test_payload_stream_is_tagged_with_boxes(spark, feed, paths):
    source = feed("value string")
    source.add([(payload(10, "a", "b", "c"),), (payload(11),)])
    boxes = parse_boxes(spark, "zero,0,0,1,1|wide,0,0,3,3")
    run(land(parse_states(source.stream(), boxes), paths("out"), paths("cp"), "parquet", seconds=None))
    out = spark.read.parquet(paths("out"))
    assert set(out.columns) == set(FLIGHTS.names)
    assert tuples(out, "region", "icao24") == [("wide", "a"), ("wide", "b"), ("zero", "a")]


def test_landing_resumes_without_loss_or_repeats(spark, feed, paths):
    source = feed()
    source.add([("a", at("2026-01-01"), 1.0, i) for i in range(1200)])
    run(land(source.stream(), paths("out"), paths("cp"), seconds=None, max_records_per_file=500))
    out = spark.read.schema(RECORDS).json(paths("out"))
    assert out.count() == 1200
    per_file = out.groupBy(F.input_file_name()).count()
    assert per_file.agg(F.max("count")).first()[0] <= 500
    run(land(source.stream(), paths("out"), paths("cp"), seconds=None))
    source.add([("b", at("2026-01-01"), 1.0, 5000)])
    run(land(source.stream(), paths("out"), paths("cp"), seconds=None))
    landed = spark.read.schema(RECORDS).json(paths("out"))
    assert (landed.count(), landed.select("arrival").distinct().count()) == (1201, 1201)


def test_bad_payloads_are_set_aside_and_the_stream_goes_on(spark, feed, paths):
    source = feed("region string, value string")
    source.add([("r1", payload(10, "a")), ("r1", '{"time": 11, "states": [[')])
    source.add([("r2", "oops"), ("r2", None)])
    source.add([("r3", payload(12, "b", "c"))])
    for _ in range(2):
        run(land_states(source.stream(), paths("good"), paths("bad"), paths("cp"), keep=("region",), seconds=None))
    good = spark.read.schema("region string, icao24 string, observed_at timestamp").json(paths("good"))
    assert tuples(good, "region", "icao24") == [("r1", "a"), ("r3", "b"), ("r3", "c")]
    bad = spark.read.schema("region string, value string").json(paths("bad"))
    assert tuples(bad, "region", "value") == [
        ("r1", '{"time": 11, "states": [['),
        ("r2", "oops"),
        ("r2", None),
    ]


def test_from_payload_stream_to_silver(spark, feed, paths):
    source = feed("value string")
    source.add([(payload(10, "a", "b", "c"),), (payload(10, "a"),)])
    source.add([(payload(20, "a"),)])
    boxes = parse_boxes(spark, "zero,0,0,1,1|wide,0,0,3,3")
    lake = paths("lake")
    run(land_states(source.stream(), f"{lake}/bronze/flights", paths("bad"), paths("cp"), boxes=boxes, seconds=None))
    assert spark.read.schema(FLIGHTS).json(f"{lake}/bronze/flights").select(*FLIGHTS.names).count() == 7
    assert refine(spark, lake, ["flights"]) == ["flights"]
    silver = spark.read.parquet(f"{lake}/silver/flights")
    assert tuples(silver, "region", "icao24", F.unix_seconds("observed_at")) == [
        ("wide", "b", 10),
        ("zero", "a", 10),
        ("zero", "a", 20),
    ]


KEYS = ["icao24", "observed_at"]


@pytest.fixture
def rules(spark):
    return {"required": ["icao24", "observed_at"], "valid": valid_reading()}


@pytest.mark.parametrize("validate_first", [False, True])
@pytest.mark.parametrize("salts", [1, 16])
def test_incremental_cleaning_equals_batch_keep_first(spark, feed, paths, rules, validate_first, salts):
    rng = random.Random(5)
    source, everything = feed(), []
    for batch in range(4):
        # one row per key and batch: which of two copies in one batch arrives first is not defined
        keys = rng.sample([(i, t) for i in ("a", "b", None) for t in range(6)], 9)
        rows = [
            (i, at("2026-01-01") + timedelta(minutes=t), rng.choice([1.0, -1.0, 2.0]), batch * 100 + n)
            for n, (i, t) in enumerate(keys)
        ]
        source.add(rows)
        everything += rows
    cleaned = clean_stream(
        source.stream(), KEYS, "observed_at", "1 hour", validate_first=validate_first, salts=salts, **rules
    )
    run(land(cleaned, paths("out"), paths("cp"), "parquet", seconds=None))
    batch_rows = spark.createDataFrame(everything, RECORDS)
    expected = clean(batch_rows, KEYS, newest=["arrival"], keep_first=True, validate_first=validate_first, **rules)
    assert tuples(spark.read.parquet(paths("out"))) == tuples(expected)


def test_rows_behind_the_watermark_are_dropped(spark, feed, paths, rules):
    source = feed()
    source.add([("a", at("2026-01-01T12:00:00"), 1.0, 1)])
    source.add([("a", at("2026-01-01T11:30:00"), 1.0, 2)])  # late, but within the hour
    source.add([("a", at("2026-01-01T10:30:00"), 1.0, 3)])  # too late
    cleaned = clean_stream(source.stream(), KEYS, "observed_at", "1 hour", **rules)
    run(land(cleaned, paths("out"), paths("cp"), "parquet", seconds=None))
    assert tuples(spark.read.parquet(paths("out")), "arrival") == [(1,), (2,)]


def test_event_time_has_to_be_a_key(spark, feed, rules):
    with pytest.raises(ValueError, match="event time"):
        clean_stream(feed().stream(), ["icao24"], "observed_at", "1 hour", **rules)


def test_latest_state_follows_the_stream(spark, feed, paths):
    rng = random.Random(3)
    source, everything = feed(), []
    for batch in range(4):
        rows = [
            (rng.choice(["a", "b", "c", None]), at("2026-01-01") + timedelta(minutes=rng.randrange(5)), rng.choice([None, 1.0, 2.0]), n)
            for n in range(batch * 10, batch * 10 + 10)
        ]
        source.add(rows)
        everything += rows
        run(maintain_latest(source.stream(), "icao24", "observed_at", paths("out"), paths("cp"), seconds=None))
        expected = tuples(latest(spark.createDataFrame(everything, RECORDS), ["icao24"], "observed_at"))
        assert tuples(read_latest(spark, paths("out"), "icao24", "observed_at")) == expected
    table = latest_stream(spark.createDataFrame(everything, RECORDS), "icao24", "observed_at")
    assert tuples(table) == expected


def test_the_trigger_of_a_topic_is_left_to_its_source():
    from skyair.streaming.landing import _triggered

    class Writer:
        def trigger(self, **given):
            return given

    assert _triggered(Writer(), 0) == {"processingTime": "0 seconds"}
    assert _triggered(Writer(), 30) == {"processingTime": "30 seconds"}
    assert _triggered(Writer(), None) == {"availableNow": True}


def test_latest_carries_a_map_along(spark):
    rows = [("a", at("2026-01-01"), 1, {"x": 1}), ("a", at("2026-01-02"), 2, {"x": 2}), ("a", at("2026-01-02"), 1, {"x": 3})]
    df = spark.createDataFrame(rows, "k string, t timestamp, n int, m map<string,int>")
    assert [tuple(r) for r in latest_stream(df, "k", "t").collect()] == [("a", at("2026-01-02"), 2, {"x": 2})]


def test_malformed_payloads_give_no_rows(spark):
    from skyair.operators.shaping import unpack_states

    good = '{"time": 1, "states": [["a"]]}'
    rows = [('{"time": "x", "states": [["b"]]}',), ('{"states": [["c"]]}',), (good,), ("{",), (None,)]
    assert tuples(unpack_states(spark.createDataFrame(rows, "value string")), "icao24") == [("a",)]


@pytest.mark.parametrize("validate_first", [False, True])
@pytest.mark.parametrize("salts", [1, 16])
def test_silver_takes_late_rows_in(spark, feed, paths, rules, validate_first, salts):
    rng = random.Random(11)
    source, everything = feed(), []
    for batch, day in enumerate([1, 4, 2, 5, 1, 9]):  # whole days behind the watermark, and on time
        keys = rng.sample([(i, d, t) for i in ("a", "b", None) for d in (day, 4) for t in range(4)], 14)
        rows = [
            (i, at("2026-01-01") + timedelta(days=d, hours=t), rng.choice([1.0, -1.0, 2.0, None]), batch * 100 + n)
            for n, (i, d, t) in enumerate(keys)
        ]
        source.add(rows)
        everything += rows
    args = (source.stream(), paths("silver"), paths("cp"), KEYS, "observed_at", "1 hour")
    for _ in range(2):
        run(maintain_silver(*args, arrival=["arrival"], validate_first=validate_first, salts=salts, seconds=None, **rules))
    expected = clean(
        spark.createDataFrame(everything, RECORDS), KEYS, newest=["arrival"], keep_first=True, validate_first=validate_first, **rules
    )
    found = read_silver(spark, paths("silver"))
    assert tuples(found, *expected.columns) == tuples(expected)
    assert found.filter(F.col("event_date") != F.to_date("observed_at")).count() == 0
    assert read_silver(spark, paths("silver"), LATE).count() >= 10
    if not validate_first:
        rejected = read_silver(spark, paths("silver"), "missing").count() + read_silver(spark, paths("silver"), "out_of_range").count()
        assert found.count() + rejected == spark.createDataFrame(everything, RECORDS).select(*KEYS).distinct().count()


def test_late_rows_are_merged_into_their_days_only(spark, feed, paths, rules):
    source = feed()
    source.add([("a", at("2026-01-0%d" % d), 1.0, d) for d in range(1, 8)])
    source.add([("a", at("2026-01-07T00:30:00"), 1.0, 10)])  # state drops by the watermark of one batch before
    source.add([("a", at("2026-01-02"), 5.0, 20), ("b", at("2026-01-02"), 5.0, 21)])
    run(maintain_silver(source.stream(), paths("silver"), paths("cp"), KEYS, "observed_at", "1 hour", seconds=None, **rules))
    assert ("b", 21) in tuples(read_silver(spark, paths("silver")), "icao24", "arrival")
    name = f"{query_id(spark, paths('cp'))}-2"
    assert touched_days(spark, paths("silver"), name) == ["event_date=2026-01-02"]
    # merging once more gives the same rows, and reads the files of that day alone
    again = merge_late(spark, paths("silver"), name, KEYS, [], **rules)
    assert tuples(again, "icao24", "arrival") == [("b", 21)]
    assert again.inputFiles() and all("event_date=2026-01-02" in f for f in again.inputFiles())
    assert merge_late(spark, paths("silver"), f"{name}9", KEYS, [], **rules) is None
    source.add([("c", at("2026-01-06T23:30:00"), 1.0, 30)])  # at the watermark, which state takes for late
    run(maintain_silver(source.stream(), paths("silver"), paths("cp"), KEYS, "observed_at", "1 hour", seconds=None, **rules))
    assert ("c", 30) in tuples(read_silver(spark, paths("silver")), "icao24", "arrival")
    assert watermark_of(spark, paths("cp"), 1) == (at("2026-01-06T23:00:00") - at("1970-01-01")).total_seconds() * 1000


def test_the_log_of_latest_states_stays_bounded(spark, feed, paths, tmp_path):
    source, everything, sizes = feed(), [], []
    for batch in range(9):
        rows = [("k%d" % (n % 5), at("2026-01-01") + timedelta(minutes=(7 * batch + n) % 40), 1.0, 10 * batch + n) for n in range(6)]
        source.add(rows)
        everything += rows
        run(maintain_latest(source.stream(), "icao24", "observed_at", paths("out"), paths("cp"), seconds=None))
        if batch % 2:
            compact_latest(spark, paths("out"), "icao24", "observed_at", grace_seconds=0)
        expected = tuples(latest(spark.createDataFrame(everything, RECORDS), ["icao24"], "observed_at"))
        assert tuples(read_latest(spark, paths("out"), "icao24", "observed_at")) == expected
        sizes.append((len(list(tmp_path.glob("out/changes/*/batch_id=*"))), len(list(tmp_path.glob("out/snapshot/*")))))
    assert max(n for n, _ in sizes) <= 5 and max(n for _, n in sizes) <= 1
    compact_latest(spark, paths("out"), "icao24", "observed_at")  # with the grace time nothing goes yet
    compact_latest(spark, paths("out"), "icao24", "observed_at")
    assert len(list(tmp_path.glob("out/snapshot/*"))) == 3
    assert tuples(read_latest(spark, paths("out"), "icao24", "observed_at")) == expected
