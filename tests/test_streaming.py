"""Streams over landed topics: restart, replay, all feeds at once, state."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from quakeloom.functions.scoring import with_risk
from quakeloom.schemas import DECLARATION, EARTHQUAKE
from quakeloom.sources import adapters, messages, samples
from quakeloom.sources.tables import ORDER, Collection
from quakeloom.streaming import ingest, live
from quakeloom.streaming.corrected import CorrectedCells

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def quakes(spark):
    return adapters.quakes(spark, SF)


def ids(df):
    return sorted(r.event_id for r in df.select("event_id").collect())


def test_stream_equals_batch_over_several_files_and_a_restart(spark, quakes, folder):
    feed = ingest.FEEDS["earthquakes"]
    store = ingest.open_collection(spark, feed, folder)
    counts = []
    records = samples.quake_records(quakes)
    for part in range(2):
        messages.land(records.filter(F.col("offset") % 2 == part).repartition(3), f"{folder}/topic")
        stream = messages.topic_stream(spark, f"{folder}/topic", files_per_trigger=2)
        ingest.start(feed, stream, store, f"{folder}/checkpoint", available_now=True,
                     on_batch=lambda b, n: counts.append((b, n))).awaitTermination()
    assert len(counts) >= 4 and sum(n for _, n in counts) == quakes.count()
    assert store.compact() >= 1
    want = {r.event_id: (r.risk_score, r.risk_tier) for r in with_risk(quakes).collect()}
    rows = store.current().collect()
    assert {r.event_id: (r.risk_score, r.risk_tier) for r in rows} == want
    assert len(rows) == len(want)
    assert all((r.location is None) == (r.latitude is None or r.longitude is None) for r in rows)


def test_all_feeds_run_side_by_side(spark, quakes, folder):
    declared = adapters.declarations(spark, SF)
    event = adapters.natural_events(spark, SF).select(
        "event_id", "type", "title", F.lit("open").alias("status"), "longitude", "latitude",
        F.date_format("last_ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("last_date"))
    numbered = messages.encode(event, "event_id").select(
        "*", F.lit(0).alias("partition"), F.monotonically_increasing_id().alias("offset"), F.current_timestamp().alias("timestamp"))
    topics = {"earthquakes": samples.quake_records(quakes), "declarations": samples.declaration_records(declared),
              "natural_events": numbered}
    for name, records in topics.items():
        messages.land(records, f"{folder}/topics/{name}")
    sources = {name: messages.topic_stream(spark, f"{folder}/topics/{name}") for name in topics}
    stores = ingest.run_all(spark, sources, f"{folder}/store", available_now=True)
    assert stores["earthquakes"].current().count() == quakes.count()
    assert stores["natural_events"].current().count() == event.count()
    assert stores["declarations"].current().count() == declared.select("event_id", "county").distinct().count()
    assert stores["natural_events"].current().filter("last_ts IS NULL").count() == 0


def test_continuous_run_stops_after_the_timeout(spark, quakes, folder):
    messages.land(samples.quake_records(quakes), f"{folder}/topic")
    source = messages.topic_stream(spark, f"{folder}/topic")
    stores = ingest.run_all(spark, {"earthquakes": source}, f"{folder}/store", timeout=25)
    for q in spark.streams.active:
        q.processAllAvailable()
        q.stop()
    assert stores["earthquakes"].current().count() == quakes.count()


@pytest.mark.parametrize("cached", [False, True])
def test_dead_letters_of_a_stream(spark, quakes, folder, cached):
    feed = ingest.FEEDS["earthquakes"]
    store = ingest.open_collection(spark, feed, folder)
    records = samples.damaged(samples.quake_records(quakes))
    messages.land(records, f"{folder}/topic")
    ingest.start(feed, messages.topic_stream(spark, f"{folder}/topic"), store, f"{folder}/cp", available_now=True,
                 cache_batches=cached).awaitTermination()
    reasons = {r.reason: r["count"] for r in store.dead_letters().groupBy("reason").count().collect()}
    lost = reasons["undecodable"] + reasons["missing key"]
    assert reasons["bad field"] > 0 and store.current().count() == quakes.count() - lost


def test_dedup_keeps_the_first_even_of_a_hot_key_and_late_files(spark, quakes, folder):
    records = samples.quake_records(quakes)
    hot = records.limit(1).join(spark.range(400).select(F.col("id").alias("n")), F.lit(True)).withColumn(
        "offset", F.col("n") + 10 ** 9).drop("n")
    store = Collection(spark, f"{folder}/first", "event_id STRING, magnitude DOUBLE", ["event_id"], first=True)
    for part in (records.filter("offset % 3 > 0"), hot, records):
        messages.land(part, f"{folder}/topic")
        stream = messages.decode(messages.topic_stream(spark, f"{folder}/topic"), EARTHQUAKE, keep=["offset"])
        rows = messages.accepted(stream).select("event_id", "magnitude", F.col("offset").alias(ORDER))
        live.keep_updated(rows, store, f"{folder}/cp", mode="append").awaitTermination()
    assert ids(store.current()) == ids(quakes)


def test_daily_cells_grow_with_late_events(spark, quakes, folder):
    store = Collection(spark, f"{folder}/cells", "day DATE, grid_lat DOUBLE, grid_lon DOUBLE, event_count BIGINT, max_mag DOUBLE",
                       ["day", "grid_lat", "grid_lon"])
    records = samples.quake_records(quakes).orderBy(F.desc("offset"))
    for part in (1, 0):
        messages.land(records.filter(F.col("offset") % 2 == part), f"{folder}/topic")
        decoded = messages.accepted(messages.decode(messages.topic_stream(spark, f"{folder}/topic"), EARTHQUAKE))
        cells = live.daily_cells(decoded.withColumn("ts", F.try_to_timestamp("time")))
        live.keep_updated(cells, store, f"{folder}/cp").awaitTermination()
    located = quakes.filter("latitude IS NOT NULL AND longitude IS NOT NULL AND magnitude IS NOT NULL")
    assert store.current().agg(F.sum("event_count")).first()[0] == located.count()


def test_newest_version_is_kept(spark, folder):
    declared = adapters.declarations(spark, SF)
    store = Collection(spark, f"{folder}/docs", "event_id STRING, county STRING, state STRING", ["event_id", "county"])
    messages.land(samples.declaration_records(declared).repartition(4, "key"), f"{folder}/topic")
    stream = messages.decode(messages.topic_stream(spark, f"{folder}/topic", 1), DECLARATION, keep=["offset"])
    stream = messages.accepted(stream).select("event_id", "county", "state", F.col("offset").alias(ORDER))
    live.keep_updated(stream, store, f"{folder}/cp", mode="append").awaitTermination()
    want = declared.groupBy("event_id", "county").agg(F.max_by("state", "seq").alias("state"))
    key = lambda r: (r.event_id, r.county, r.state or "")
    assert sorted(map(key, store.current().collect())) == sorted(map(key, want.collect()))


def test_unavailable_broker_package_is_reported(spark):
    with pytest.raises(Exception, match="kafka"):
        messages.kafka_stream(spark, "t", "localhost:1")


def test_closed_days_take_no_late_events(spark, folder):
    store = Collection(spark, f"{folder}/cells", "day DATE, grid_lat DOUBLE, grid_lon DOUBLE, event_count BIGINT, max_mag DOUBLE",
                       ["day", "grid_lat", "grid_lon"])
    rows = [("a", "2024-01-01T10:00:00Z"), ("b", "2024-01-20T10:00:00Z")], [("c", "2024-01-01T11:00:00Z"), ("d", "2024-01-20T11:00:00Z")]
    for n, part in enumerate(rows):
        df = spark.createDataFrame([(k, t, 10 * n + i) for i, (k, t) in enumerate(part)], "event_id STRING, time STRING, offset BIGINT")
        full = df.select("event_id", "time", F.lit(4.0).alias("magnitude"), F.lit(1.0).alias("latitude"), F.lit(1.0).alias("longitude"), "offset")
        records = messages.encode(full, "event_id").withColumn("partition", F.lit(0)).withColumn(
            "offset", F.lit(n).cast("long")).withColumn("timestamp", F.current_timestamp())
        messages.land(records, f"{folder}/topic")
        decoded = messages.accepted(messages.decode(messages.topic_stream(spark, f"{folder}/topic"), EARTHQUAKE))
        cells = live.daily_cells(decoded.withColumn("ts", F.try_to_timestamp("time")), delay="2 days")
        live.keep_updated(cells, store, f"{folder}/cp").awaitTermination()
    assert {str(r.day): r.event_count for r in store.current().collect()} == {"2024-01-01": 1, "2024-01-20": 2}


def test_corrected_cells_follow_every_revision(spark, folder):
    schema = "event_id STRING, latitude DOUBLE, longitude DOUBLE, magnitude DOUBLE, ts TIMESTAMP, _order BIGINT"
    day = datetime(2024, 1, 1, 10)
    batches = [
        [("a", 1.0, 1.0, 5.0, day, 1), ("b", 1.0, 1.0, 4.0, day, 2), ("c", 1.0, 1.0, None, day, 3), ("a", 1.0, 1.0, 6.0, day, 0)],
        [("a", 1.0, 1.0, 3.0, day, 4), ("c", 30.0, 1.0, 2.0, day, 5)],   # the largest shrinks; an unknown one becomes known
        [("b", 30.0, 1.0, 1.0, day, 6)],                                  # one moves away
        [("a", None, 1.0, 3.0, day, 7), ("c", 30.0, 1.0, 9.0, day, 8)],   # a cell empties; a maximum grows
    ]
    want = [{(0.0, 0.0): (2, 5.0)}, {(0.0, 0.0): (2, 4.0), (30.0, 0.0): (1, 2.0)}, {(0.0, 0.0): (1, 3.0), (30.0, 0.0): (2, 2.0)}, {(30.0, 0.0): (2, 9.0)}]
    view = CorrectedCells(spark, folder)
    for n, (rows, cells) in enumerate(zip(batches, want)):
        for again in range(1 + n % 2):  # a batch that runs again changes nothing
            view.apply(spark.createDataFrame(rows, schema), n)
            assert {(r.grid_lat, r.grid_lon): (r.event_count, r.max_mag) for r in view.current().collect()} == cells
        if n == 1:
            view.compact()


def test_corrected_cells_look_for_repeats_once(spark, folder, monkeypatch):
    schema = "event_id STRING, latitude DOUBLE, longitude DOUBLE, magnitude DOUBLE, ts TIMESTAMP, _order BIGINT"
    day, looked = datetime(2024, 1, 1), []
    latest = Collection._latest
    monkeypatch.setattr(Collection, "_latest", lambda self, rows: looked.append(self.path) or latest(self, rows))
    view = CorrectedCells(spark, folder)
    rows = [("a", 1.0, 1.0, 5.0, day, 1), ("a", 1.0, 1.0, 4.0, day, 2), (None, 1.0, 1.0, 1.0, day, 3), (None, 1.0, 1.0, 3.0, day, 4)]
    view.apply(spark.createDataFrame(rows, schema), 0)
    assert not looked
    assert [(r.event_count, r.max_mag) for r in view.current().collect()] == [(2, 4.0)]


def test_a_batch_cut_off_between_its_writes_is_made_good(spark, folder, monkeypatch):
    schema = "event_id STRING, latitude DOUBLE, longitude DOUBLE, magnitude DOUBLE, ts TIMESTAMP, _order BIGINT"
    first = spark.createDataFrame([("a", 1.0, 1.0, 5.0, datetime(2024, 1, 1), 1)], schema)
    second = spark.createDataFrame([("a", 30.0, 1.0, 2.0, datetime(2024, 1, 1), 2)], schema)
    view = CorrectedCells(spark, folder)
    view.apply(first, 0)

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(view.events, "upsert", fail)
        with pytest.raises(RuntimeError):
            view.apply(second, 1)
    assert view._holds(0, 1)
    view.apply(second, 1)
    assert [(r.grid_lat, r.event_count, r.max_mag) for r in view.current().collect()] == [(30.0, 1, 2.0)]


def test_repeats_within_the_delay_are_dropped_after_a_restart_too(spark, folder):
    batches = [
        [("a", 1), ("a", 1), ("b", 9)],           # a repeat in one batch
        [("b", 10), ("c", 20)],                   # b within its delay, after a restart
        [("b", 18), ("a", 18), ("d", 2)],         # b and a are forgotten; d is older than the watermark
    ]
    remembered = []
    for n, rows in enumerate(batches):
        frame = spark.createDataFrame([(k, datetime(2024, 1, d), n) for k, d in rows], "event_id STRING, ts TIMESTAMP, batch INT")
        frame.write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(frame.schema).parquet(f"{folder}/in")
        out = live.without_repeats(stream, ["event_id"], "3 days").writeStream.format("parquet").option("path", f"{folder}/out")
        q = out.option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start()
        q.awaitTermination()
        remembered.append(q.lastProgress["stateOperators"][0]["numRowsTotal"])
    found = spark.read.schema("event_id STRING, ts TIMESTAMP, batch INT").parquet(f"{folder}/out").collect()
    assert sorted((r.event_id, r.batch) for r in found) == [("a", 0), ("a", 2), ("b", 0), ("b", 2), ("c", 1)]
    assert max(remembered) <= 4


def test_newest_in_state_by_groups_of_keys(spark, folder):
    batches = [
        [("a", None, 1, 1.0, 1), ("a", "x", 1, 2.0, 2), ("a", "x", 1, 3.0, 2), ("b", None, 9, None, 3)],
        [("b", None, 10, 9.0, 1), ("c", "y", 30, 4.0, 4)],     # an older version of b changes neither it nor its timer
        [("b", None, 31, 5.0, 5), ("d", None, 2, 6.0, 6)],     # b is founded anew; d is older than the watermark
    ]
    schema = "k STRING, l STRING, ts TIMESTAMP, seen TIMESTAMP, magnitude DOUBLE, n LONG"
    for rows in batches:
        day = lambda d: datetime(2024, 1, d)
        frame = spark.createDataFrame([(k, l, day(d), day(d) if k == "a" else None, m, n) for k, l, d, m, n in rows], schema)
        frame.coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(frame.schema).parquet(f"{folder}/in")
        changes = live.newest_in_state(stream, ["k", "l"], "n", "3 days", groups=2)
        out = changes.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/cp")
        q = out.trigger(availableNow=True).start()
        q.awaitTermination()
        assert q.lastProgress["stateOperators"][0]["numRowsTotal"] <= 2
    found = spark.read.schema(changes.schema).parquet(f"{folder}/out").collect()
    assert sorted((r.k, r.l or "", r.magnitude or 0.0, r.n, r.ts.day, r.expired) for r in found) == [
        ("a", "", 1.0, 1, 1, False), ("a", "", 1.0, 1, 1, True), ("a", "x", 2.0, 2, 1, False), ("a", "x", 2.0, 2, 1, True),
        ("b", "", 0.0, 3, 9, False), ("b", "", 0.0, 3, 9, True), ("b", "", 5.0, 5, 31, False), ("c", "y", 4.0, 4, 30, False)]
    assert all(r.seen == (datetime(2024, 1, 1) if r.k == "a" else None) for r in found)
