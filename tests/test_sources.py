"""Payload parsing, messages, keyed tables and statistics on hand-written input."""

import json

import pytest
from pyspark.sql import functions as F

from quakeloom import schemas
from quakeloom.sources import messages, payloads, stats
from quakeloom.sources.tables import ORDER, Collection, writer_of


def pages(spark, *documents):
    return spark.createDataFrame([(json.dumps(d),) for d in documents], "payload STRING")


def test_earthquake_page(spark):
    full = {"id": "a", "properties": {"mag": 5.1, "place": "p", "time": 1704067207179, "sig": 400, "tsunami": 1, "alert": "red"},
            "geometry": {"coordinates": [10.5, 0.0, 33.0]}}
    bare = {"id": "b", "properties": {"time": None}}
    got = {r.event_id: r for r in payloads.parse_earthquakes(pages(spark, {"features": [full, bare]}, {"features": []})).collect()}
    a, b = got["a"], got["b"]
    assert (a.magnitude, a.longitude, a.latitude, a.depth_km, a.significance) == (5.1, 10.5, 0.0, 33.0, 400.0)
    assert (a.time, a.source, a.type) == ("2024-01-01T00:00:07.179000+00:00", "USGS", "earthquake")
    assert (b.longitude, b.latitude, b.depth_km, b.time, b.magnitude) == (None,) * 5
    assert a.ingested_at.endswith("+00:00")


@pytest.mark.parametrize("coordinates, point", [
    ([1.5, 2.5], (1.5, 2.5)), ([[1.5, 2.5], [3, 4]], (1.5, 2.5)), ([[[1.5, 2.5], [3, 4]]], (1.5, 2.5)), ([], (None, None))])
def test_geometry_shapes(spark, coordinates, point):
    event = {"id": "e", "title": "t", "status": "open", "categories": [{"id": "floods", "title": "Floods"}],
             "geometry": [{"date": "d0", "coordinates": [9, 9]}, {"date": "d1", "coordinates": coordinates}],
             "sources": [{"url": "u"}]}
    r = payloads.parse_natural_events(pages(spark, {"events": [event]})).first()
    assert (r.longitude, r.latitude) == point
    assert (r.type, r.geometry_count, r.start_date, r.last_date) == ("flood", 2, "d0", "d1")
    assert (r.categories, r.sources) == (["Floods"], ["u"])


def test_event_without_geometry_or_category(spark):
    r = payloads.parse_natural_events(pages(spark, {"events": [{"id": "e", "geometry": [], "categories": []}]})).first()
    assert (r.type, r.geometry_count, r.longitude, r.last_date, r.categories, r.sources) == ("unknown", 0, None, None, [], [])


def test_declaration_page(spark):
    record = {"disasterNumber": 4321, "state": "TX", "designatedArea": None, "incidentType": "Fire",
              "declarationDate": "2024-01-02T00:00:00.000Z", "ihProgramDeclared": True}
    r = payloads.parse_declarations(pages(spark, {"DisasterDeclarationsSummaries": [record]})).first()
    assert (r.event_id, r.county, r.ih_program_declared, r.pa_program_declared) == ("4321", None, True, None)


def test_pages_as_whole_files(spark, folder):
    for i in range(3):
        with open(f"{folder}/page{i}.json", "w") as f:
            json.dump({"features": [{"id": str(i)}]}, f, indent=2)
    parsed = payloads.parse_earthquakes(payloads.read_pages(spark, folder))
    assert sorted(r.event_id for r in parsed.collect()) == ["0", "1", "2"]


def test_ingest_windows(spark):
    quakes = spark.createDataFrame(
        [("a", 2.5, "2024-01-05T00:00:00+00:00"), ("b", 2.4, "2024-01-05T00:00:00+00:00"),
         ("c", 3.0, "2024-01-06T00:00:00+00:00"), ("", 3.0, "2024-01-05T00:00:00+00:00"), ("d", 3.0, "no date")],
        "event_id STRING, magnitude DOUBLE, time STRING")
    assert [r.event_id for r in payloads.historical_quakes(quakes, "2024-01-05", "2024-01-06").collect()] == ["a"]
    declared = spark.createDataFrame([("a", "2024-01-05T00:00:00.000Z"), ("b", "2024-01-05T00:00:01.000Z")],
                                     "event_id STRING, declaration_date STRING")
    assert [r.event_id for r in payloads.declared_after(declared, "2024-01-05").collect()] == ["b"]


def records(spark, *values):
    return spark.createDataFrame([(v, i) for i, v in enumerate(values)], "value STRING, offset BIGINT")


def test_decode_and_dead_letters(spark):
    decoded = messages.decode(records(
        spark, '{"event_id": 4321, "magnitude": 5.5, "extra": 1}', "no json", '{"magnitude": 1.0}',
        '{"event_id": "x", "magnitude": "5.1"}', '{"event_id": ""}', None), schemas.EARTHQUAKE, keep=["offset"])
    rows = {r.event_id: r for r in messages.accepted(decoded).collect()}
    assert set(rows) == {"4321", "x"}
    assert rows["4321"].magnitude == 5.5 and rows["x"].magnitude is None and rows["x"].offset == 3
    dead = sorted((r.reason, r.message_key) for r in messages.dead_letters(decoded).na.fill("-").collect())
    assert dead == [("bad field", "x"), ("missing key", ""), ("missing key", "-"), ("missing key", "-"), ("undecodable", "-")]


def test_encode_round_trip(spark):
    df = spark.createDataFrame([(1, None, "TX")], "event_id INT, county STRING, state STRING")
    r = messages.encode(df, messages.declaration_key(), ["event_id", "state"]).first()
    assert r.key == "1-None-summaries" and json.loads(r.value) == {"event_id": 1, "state": "TX"}


def test_kafka_options():
    options = messages.kafka_options("t", "host:1")
    assert options["startingOffsets"] == "earliest" and "maxOffsetsPerTrigger" not in options
    assert messages.kafka_options("t", "host:1", 1000)["maxOffsetsPerTrigger"] == "1000"
    assert options["failOnDataLoss"] == "false" and options["subscribe"] == "t"


SCHEMA = "id STRING, part STRING, a INT, b INT"


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), f"{SCHEMA}, {ORDER} BIGINT")


def content(store):
    return sorted(((r.id, r.part, r.a, r.b) for r in store.current().collect()), key=str)


@pytest.fixture
def store(spark, folder):
    return Collection(spark, f"{folder}/c", SCHEMA, ["id", "part"])


def test_empty_collection(store):
    assert store.current().count() == 0 and store.compact() == 0 and store.dead_letters().count() == 0


@pytest.mark.parametrize("compacted", [False, True])
def test_newest_version_wins_and_nulls_overwrite(spark, store, compacted):
    store.upsert(batch(spark, ("x", None, 1, 1, 1), ("x", None, 2, 2, 2), ("y", "p", 1, 1, 3)), 0)
    if compacted:
        assert store.compact() >= 1
    store.upsert(batch(spark, ("x", None, None, 7, 9), ("z", "p", 5, 5, 8)), 1)
    assert content(store) == sorted([("x", None, None, 7), ("y", "p", 1, 1), ("z", "p", 5, 5)], key=str)


def test_replays_change_nothing(spark, store):
    first, second = batch(spark, ("x", "p", 1, 1, 10)), batch(spark, ("x", "p", 2, 2, 20), ("y", "p", 3, 3, 21))
    store.upsert(first, 0)
    store.upsert(second, 1)
    store.upsert(second, 1)
    store.compact()
    want = [("x", "p", 2, 2), ("y", "p", 3, 3)]
    assert content(store) == want
    store.upsert(first, 0)
    store.upsert(second, 1)
    assert content(store) == want
    store.compact()
    assert content(store) == want and store.compact() == 0


@pytest.mark.parametrize("compacted", [False, True])
def test_a_new_writer_counts_from_zero_and_loses_nothing(spark, store, compacted):
    store.upsert(batch(spark, ("x", "p", 1, 1, 5000), ("y", "p", 1, 1, 5001)), 0, writer=1)
    store.upsert(batch(spark, ("z", "p", 1, 1, 5002)), 1, writer=1)
    if compacted:
        store.compact()
    store.upsert(batch(spark, ("x", "p", 2, 2, 3), ("new", "p", 2, 2, 4)), 0, writer=2)
    want = sorted([("new", "p", 2, 2), ("x", "p", 2, 2), ("y", "p", 1, 1), ("z", "p", 1, 1)])
    assert content(store) == want
    store.compact()
    assert content(store) == want


def test_writers_are_told_by_their_checkpoint(spark, folder):
    one = writer_of(spark, f"{folder}/a")
    assert writer_of(spark, f"{folder}/a") == one < writer_of(spark, f"{folder}/b")


@pytest.mark.parametrize("compacted", [False, True])
def test_first_version_can_be_kept(spark, folder, compacted):
    store = Collection(spark, f"{folder}/f", SCHEMA, ["id", "part"], first=True)
    store.upsert(batch(spark, ("x", "p", 1, 1, 7), ("x", "p", 2, 2, 8)), 0)
    if compacted:
        store.compact()
    store.upsert(batch(spark, ("x", "p", 3, 3, 1), ("late", "p", 4, 4, 0)), 1)
    assert content(store) == [("late", "p", 4, 4), ("x", "p", 1, 1)]


@pytest.mark.parametrize("compacted", [False, True])
def test_columns_not_supplied_survive(spark, store, compacted):
    store.upsert(batch(spark, ("x", "p", 1, 1, 1)), 0)
    if compacted:
        store.compact()
    narrow = batch(spark, ("x", "p", 9, 0, 2), ("n", "p", 4, 0, 3)).drop("b")
    store.upsert(narrow, 1)
    store.upsert(narrow, 1)
    assert content(store) == [("n", "p", 4, None), ("x", "p", 9, 1)]


def test_compaction_rewrites_touched_buckets_only(spark, store, folder):
    import glob

    rows = spark.range(200).select(F.col("id").cast("string").alias("id"), F.lit("p").alias("part"), F.lit(1).alias("a"),
                                   F.lit(1).alias("b"), F.col("id").alias(ORDER))
    store.upsert(rows, 0)
    assert store.compact() == store.buckets
    before = set(glob.glob(f"{folder}/c/base/*/*.parquet"))
    store.upsert(batch(spark, ("5", "p", 2, 2, 999)), 1)
    assert store.compact() == 1
    assert len(before & set(glob.glob(f"{folder}/c/base/*/*.parquet"))) == len(before) - 1
    assert store.current().count() == 200 and ("5", "p", 2, 2) in content(store)


def test_a_compaction_cut_off_is_finished(spark, store, folder):
    store.upsert(batch(spark, ("x", "p", 1, 1, 1), ("y", "p", 1, 1, 2)), 0)
    store.compact()
    store.upsert(batch(spark, ("x", "p", 2, 2, 3)), 1)
    # the state after staging: the driver is lost before the base is replaced
    replace, store._replace = store._replace, lambda: None
    store.compact()
    store._replace = replace
    store.upsert(batch(spark, ("z", "p", 1, 1, 4)), 2)
    store.compact()
    assert content(store) == [("x", "p", 2, 2), ("y", "p", 1, 1), ("z", "p", 1, 1)]


def test_compacted_base_is_not_shuffled_by_a_read(spark, store):
    big = spark.range(200_000).select(F.col("id").cast("string").alias("id"), F.lit("p").alias("part"),
                                      F.lit(1).alias("a"), F.lit(1).alias("b"), F.col("id").alias(ORDER))
    store.upsert(big, 0)
    store.compact()
    store.upsert(batch(spark, ("5", "p", 2, 2, 10 ** 9), ("new", "p", 3, 3, 10 ** 9)), 1)
    plan = store.current()._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin LeftOuter" not in plan and "BroadcastHashJoin" in plan
    assert store.current().count() == 200_001


def test_base_is_sorted_by_time_within_a_bucket(spark, folder):
    import glob

    import pyarrow.parquet as pq

    store = Collection(spark, f"{folder}/t", "id STRING, ts TIMESTAMP", ["id"], "ts")
    rows = spark.range(5000).select(
        F.col("id").cast("string").alias("id"), F.timestamp_seconds(F.pmod(F.col("id") * 7919, F.lit(5000))).alias("ts"),
        F.col("id").alias(ORDER))
    store.upsert(rows, 0)
    store.compact()
    for file in glob.glob(f"{folder}/t/base/*/*.parquet"):
        assert pq.ParquetFile(file).metadata.row_group(0).column(1).statistics.has_min_max
        times = [r.ts for r in spark.read.parquet(file).collect()]
        assert times == sorted(times)
    assert store.current().count() == 5000


def test_a_bad_item_takes_no_other_with_it(spark):
    pages = spark.createDataFrame([
        ('{"features":[{"id":"a","properties":{"mag":4.5,"place":"x"}}, 7, null, {"id":"b","properties":{"mag":"big","place":"y"}}, "t"]}',),
        ('{"features":[{"id":"c"',), ("",), (None,), ('{"other":1}',), ('{"features":[]}',)], "payload STRING")
    rows = {r.event_id: (r.magnitude, r.place) for r in payloads.parse_earthquakes(pages).collect()}
    assert rows == {"a": (4.5, "x"), "b": (None, "y")}
    lost = payloads.page_dead_letters(pages, schemas.EARTHQUAKE_PAYLOAD, "id").collect()
    assert sorted(r.reason for r in lost) == ["bad field"] + ["unreadable item"] * 3 + ["unreadable page"] * 4
    assert [r.message_key for r in lost if r.reason == "bad field"] == ["b"]


def test_statistics_round_trip(spark, folder):
    df = spark.createDataFrame([("0.0,5.0", 1, 0.25), ("5.0,5.0", 2, None)], "cell STRING, n INT, rate DOUBLE")
    assert stats.read_json(spark, f"{folder}/s", df.schema) is None
    stats.write_json(df, f"{folder}/s")
    assert sorted(map(tuple, stats.read_json(spark, f"{folder}/s", df.schema).collect())) == sorted(map(tuple, df.collect()))
