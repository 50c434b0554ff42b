"""Every query by name: (spark, directory of the tables) to a DataFrame.

Moments are written out as text and floating means cut to six digits, so that
results can be compared by value with another engine.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quakeloom.functions import grid
from quakeloom.functions.numeric import exact_half_even, is_known, settled
from quakeloom.functions.scoring import risk_tier, with_risk
from quakeloom.functions.text import category_name, title_case
from quakeloom.ml import regions, risk_forest
from quakeloom.operators import anomaly, baseline, proximity, regional, reports, rows, sampling, seasonal
from quakeloom.schemas import DECLARATION, EARTHQUAKE, EARTHQUAKE_PAYLOAD
from quakeloom.session import materialise, prepare, scratch_path
from quakeloom.sources import adapters, messages, payloads, samples, stats, windows
from quakeloom.sources.tables import ORDER, Collection
from quakeloom.streaming import ingest, live, spikes
from quakeloom.streaming.corrected import CorrectedCells

AS_OF = "2024-01-31"
TRAINING_START = "1996-01-01"
TREND_SINCE = "2024-01-10"
SPIKE_FROM = "2024-01-29"
SPIKE_DAYS = 2
SEEN_UNTIL = "2024-01-16"
OPEN_DAYS = 3
DEDUP_DELAY = "5 days"
STATE_DELAY = "10 days"
GROWING_FILL = 150
ALERT_WINDOW, ALERT_SLIDE, ALERT_DELAY = "2 days", "12 hours", "1 day"
WANTED_FROM = "2024-01-01"
BACKFILLS = [("2024-01-12", "2024-01-15"), ("2024-01-05", "2024-01-08"), ("2024-01-07", "2024-01-13"), ("2024-01-05", "2024-01-25")]
NICE_BINS = {"magnitude": 12, "depth_km": 20, "significance": 30, "risk_score": 7, "far_magnitude": 25}
DECLARED_AFTER = "1998-06-01"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(prepare(spark), sf_dir.rstrip("/"))

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = run
    return run


def _quakes(spark, sf):
    return adapters.quakes(spark, sf)


def _ranked(found: DataFrame, *order: Column) -> DataFrame:
    """A list that a limit bounds, with each row's place in it."""
    return found.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def _scored(spark, sf):
    return with_risk(adapters.quakes(spark, sf))


def _events(spark, sf):
    return adapters.natural_events(spark, sf)


def _moment_text(ts: str) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(ts)


def _six(c: str) -> Column:
    return exact_half_even(settled(c), 6).alias(c)


# Scoring

@query
def risk_scored(spark, sf):
    return _scored(spark, sf).select("event_id", "risk_score", "risk_tier")


@query
def tier_counts(spark, sf):
    return reports.value_counts(_scored(spark, sf), "risk_tier", "tier")


# Baselines and anomalies

@query
def cell_baseline(spark, sf):
    return baseline.fit_baseline(_quakes(spark, sf))[0]


@query
def baseline_thresholds(spark, sf):
    return baseline.thresholds(baseline.cell_stats(_quakes(spark, sf)))


@query
def cell_statistics(spark, sf):
    cells = baseline.cell_stats(_quakes(spark, sf))
    return cells.select(*grid.CELL, "event_count", _six("avg_mag"), "max_mag", _six("std_mag"))


@query
def live_cells(spark, sf):
    return anomaly.live_cells(_quakes(spark, sf)).select(*grid.CELL, "event_count", "max_mag")


@query
def cell_places(spark, sf):
    """Place of the newest event of every live cell."""
    quakes = _quakes(spark, sf)
    return anomaly.newest_places(quakes, materialise(anomaly.live_cells(quakes), "cells"))


@query
def nearby_events_range(spark, sf):
    cells = anomaly.live_cells(_quakes(spark, sf)).select(*grid.CELL, "event_count")
    found = proximity.cells_with_nearby(cells, _events(spark, sf))
    return found.select(*grid.CELL, "event_count", "nearby",
                        F.array_join(F.array_sort("nearby_types"), ", ").alias("types"))


@query
def anomalies_threshold(spark, sf):
    return anomaly.anomalies_from_history(_quakes(spark, sf), _events(spark, sf))


@query
def anomalies_saved_thresholds(spark, sf):
    """Thresholds trained, saved as JSON, loaded again and applied to the live rows."""
    path = f"{scratch_path(spark, 'thresholds')}/stats"
    trained = baseline.thresholds(baseline.cell_stats(_quakes(spark, sf)))
    stats.write_json(trained, path)
    saved = stats.thresholds_or_default(spark, path, trained.schema)
    return anomaly.detect(_quakes(spark, sf).drop("anomaly_flag"), _events(spark, sf), saved)


@query
def anomalies_flagged(spark, sf):
    return anomaly.flagged_anomalies(_quakes(spark, sf))


@query
def anomalies(spark, sf):
    return anomaly.detect(_quakes(spark, sf), _events(spark, sf))


@query
def headline_anomaly(spark, sf):
    return anomaly.headline(anomaly.anomalies_from_history(_quakes(spark, sf), _events(spark, sf)))


@query
def rate_spikes(spark, sf):
    quakes = _quakes(spark, sf)
    cells, totals = baseline.fit_baseline(quakes)
    return baseline.rate_spikes(rows.since(quakes, "ts", SPIKE_FROM), cells, totals, SPIKE_DAYS)


@query
def hazard_correlation(spark, sf):
    return proximity.hazard_correlation(_quakes(spark, sf), _events(spark, sf))


@query
def hazard_correlation_top(spark, sf):
    cells = proximity.hazard_correlation(_quakes(spark, sf), _events(spark, sf))
    return rows.top(cells, 15, F.desc("eq_count"), *grid.CELL)


# Regions

@query
def regional_risk(spark, sf):
    return regional.regional_risk(_scored(spark, sf))


@query
def regional_leaderboard(spark, sf):
    return regional.leaderboard(_scored(spark, sf))


@query
def top_regions(spark, sf):
    return regional.most_active(_quakes(spark, sf))


# Reports

@query
def kpis(spark, sf):
    declared = adapters.declarations(spark, sf)
    return reports.key_figures(_scored(spark, sf), _events(spark, sf), reports.declarations_by_state(declared))


@query
def alert_feed(spark, sf):
    return reports.alert_feed(_scored(spark, sf), _events(spark, sf))


@query
def high_risk_table(spark, sf):
    found = _ranked(reports.high_risk_table(_scored(spark, sf)), F.desc("risk_score"), F.asc("event_id"))
    return found.withColumn("ts", _moment_text("ts"))


@query
def recent_quakes(spark, sf):
    found = _ranked(reports.recent_quakes(_quakes(spark, sf), 500, 2.5), F.desc("ts"), F.asc("event_id"))
    return found.select("rank", "event_id", "magnitude", "place", _moment_text("ts"))


@query
def recent_events(spark, sf):
    found = _ranked(reports.recent_events(_events(spark, sf), 200, ["wildfire", "storm"]), F.desc("last_ts"), F.asc("event_id"))
    return found.select("rank", "event_id", "type", "title", _moment_text("last_ts"))


@query
def tsunami_prob_top(spark, sf):
    return _ranked(reports.tsunami_probabilities(_scored(spark, sf)), F.desc("tsunami_prob"), F.asc("event_id"))


@query
def declarations_by_state(spark, sf):
    by_state = reports.declarations_by_state(adapters.declarations(spark, sf))
    return by_state.select("state", "count", F.array_join("types", "|", "null").alias("types"))


@query
def top_states(spark, sf):
    found = reports.declarations_by_state(adapters.declarations(spark, sf), 20)
    return _ranked(found.select("state", "count"), F.desc("count"), F.asc_nulls_last("state"))


@query
def daily_trend(spark, sf):
    trend = seasonal.daily_trend(_quakes(spark, sf), TREND_SINCE)
    return trend.select(F.col("date").cast("string").alias("date"), "count", _six("avg_mag"))


@query
def events_by_month_type(spark, sf):
    return reports.events_by_month_type(_events(spark, sf))


@query
def depth_categories(spark, sf):
    return reports.depth_categories(_quakes(spark, sf))


@query
def type_counts(spark, sf):
    return reports.value_counts(_events(spark, sf), "type")


@query
def mag_histogram(spark, sf):
    return reports.histogram(_quakes(spark, sf), "magnitude", 0.5)


@query
def risk_histogram(spark, sf):
    return reports.histogram(_scored(spark, sf), "risk_score", 2.5, 100.0)


@query
def nice_histograms(spark, sf):
    """Histograms between round edges; the last column's range is narrow and far from zero."""
    quakes = _scored(spark, sf).withColumn("far_magnitude", F.col("magnitude") / 100 + 1000000)
    parts = [reports.nice_histogram(quakes, c, n).withColumn("name", F.lit(c)) for c, n in NICE_BINS.items()]
    prices = spark.read.parquet(f"{sf}/lineitem.parquet")
    parts.append(reports.nice_histogram(prices, "l_extendedprice", 15).withColumn("name", F.lit("price")))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every.withColumns({"lower": exact_half_even("lower", 6), "upper": exact_half_even("upper", 6)})


@query
def map_layer(spark, sf):
    quakes, events = _scored(spark, sf), _events(spark, sf)
    return reports.map_layer(quakes, events, anomaly.anomalies_from_history(quakes, events))


@query
def depth_scatter(spark, sf):
    return reports.depth_scatter(_quakes(spark, sf))


@query
def risk_scatter(spark, sf):
    return reports.risk_scatter(_scored(spark, sf))


@query
def flat_export(spark, sf):
    """Raw export: the known columns in their fixed order."""
    wanted = ["event_id", "magnitude", "place", "ts", "longitude", "latitude", "depth_km", "felt", "tsunami", "alert",
              "risk_score", "risk_tier", "anomaly_flag", "tsunami_prob"]
    return rows.existing(_scored(spark, sf), wanted).withColumn("ts", _moment_text("ts"))


@query
def event_export(spark, sf):
    """Raw export of the natural events."""
    wanted = ["event_id", "type", "title", "status", "longitude", "latitude", "last_ts"]
    return rows.existing(_events(spark, sf), wanted).withColumn("last_ts", _moment_text("last_ts"))


@query
def state_export(spark, sf):
    """Raw export of the state summary: the list of types as JSON."""
    return reports.declarations_by_state(adapters.declarations(spark, sf)).select("state", "count", F.to_json("types").alias("types"))


# Seasons

def _calendar(spark, sf):
    history = rows.since(adapters.archive(spark, sf), "ts", TRAINING_START)
    return seasonal.calendar_counts(history, "2001-08-01")


@query
def seasonal_pattern(spark, sf):
    return seasonal.patterns(_calendar(spark, sf))


@query
def seasonal_rates(spark, sf):
    return seasonal.rates(_calendar(spark, sf))


@query
def weekday_pattern(spark, sf):
    return seasonal.weekdays(_calendar(spark, sf)).select("day", "count")


@query
def trend_forecast(spark, sf):
    quakes = _quakes(spark, sf)
    centre = seasonal.rates(seasonal.calendar_counts(quakes, AS_OF))
    ahead = seasonal.trend_forecast(seasonal.daily_trend(quakes, TREND_SINCE), centre)
    return ahead.select(F.col("date").cast("string").alias("date"), _six("value"), _six("lower"), _six("upper"))


# Parsing and messages

@query
def usgs_parse(spark, sf):
    parsed = payloads.parse_earthquakes(samples.quake_pages(_quakes(spark, sf)))
    return parsed.select("event_id", "source", "type", "magnitude", "place", "time", "updated", "longitude",
                         "latitude", "depth_km", "status", "tsunami", "alert", "felt", "url", "significance")


@query
def eonet_parse(spark, sf):
    parsed = payloads.parse_natural_events(samples.event_pages(_events(spark, sf)))
    return parsed.select(
        "event_id", "source", "type", "title", "status", F.array_join("categories", "|").alias("categories"),
        "longitude", "latitude", "geometry_count", "start_date", "last_date",
        F.array_join("sources", "|").alias("sources"))


@query
def fema_parse(spark, sf):
    parsed = payloads.parse_declarations(samples.declaration_pages(adapters.declarations(spark, sf)))
    return parsed.drop("ingested_at")


@query
def landed_pages(spark, sf):
    """Pages landed as files, read back and cut to the ingest floor and window."""
    path = f"{scratch_path(spark, 'pages')}/quakes"
    samples.quake_pages(_quakes(spark, sf)).write.text(path)
    parsed = payloads.parse_earthquakes(payloads.read_pages(spark, path, one_per_line=True))
    found = payloads.historical_quakes(parsed, "2024-01-05", "2024-01-20")
    return found.select("event_id", "magnitude", "time")


def _loaded(spark, sf) -> DataFrame:
    """Windows of several lengths, one per some of the events, in no order."""
    n = F.substring_index("event_id", "_", -1).cast("long")
    start = F.date_trunc("hour", F.col("last_ts").cast("timestamp"))
    picked = _events(spark, sf).filter((n % 17 == 3) & (F.col("type") != "volcano"))
    return picked.select(F.col("type").alias("feed"), start.alias("start"), (start + F.make_dt_interval(hours=(n % 5 * 2).cast("int"))).alias("end"))


def _wanted(spark, sf) -> DataFrame:
    """All types over the same time, the type that was never loaded among them."""
    feeds = _events(spark, sf).select(F.col("type").alias("feed")).distinct()
    return feeds.withColumns({"since": F.lit(WANTED_FROM).cast("timestamp"), "until": F.lit(AS_OF).cast("timestamp")})


def _window_text(found: DataFrame) -> DataFrame:
    return found.withColumns({x: F.date_format(x, "yyyy-MM-dd HH:mm:ss") for x in ("start", "end")})


@query
def window_gaps(spark, sf):
    """What a feed's loads have left out, in pieces of three days at most."""
    return _window_text(windows.in_steps(windows.missing(_loaded(spark, sf), _wanted(spark, sf)), "3 days"))


@query
def window_overlaps(spark, sf):
    """What was loaded more than once, and how often at most."""
    return _window_text(windows.overlaps(_loaded(spark, sf)))


@query
def window_backfill(spark, sf):
    """Loads out of order and overlapping, then one over all: every quake of the span is loaded once."""
    root = scratch_path(spark, "backfill")
    samples.quake_pages(_quakes(spark, sf)).write.text(f"{root}/pages")
    parsed = payloads.parse_earthquakes(payloads.read_pages(spark, f"{root}/pages", one_per_line=True))
    ledger = windows.WindowLedger(spark, f"{root}/ledger")

    def load(start, end):
        found = payloads.historical_quakes(parsed, str(start), str(end)).select("event_id", "magnitude", "time")
        found.write.mode("overwrite").parquet(f"{root}/loaded/from={start:%Y%m%d%H%M%S}")

    for since, until in BACKFILLS:
        ledger.load("earthquakes", datetime.fromisoformat(since), datetime.fromisoformat(until), load, "10 days")
    return spark.read.parquet(f"{root}/loaded").select("event_id", "magnitude", "time")


@query
def page_dead_letters(spark, sf):
    """What damaged pages lose: items that are no objects, a page cut off, a bad field."""
    pages = samples.damaged_pages(_quakes(spark, sf))
    lost = payloads.page_dead_letters(pages, EARTHQUAKE_PAYLOAD, "id")
    return lost.select("reason", "message_key", F.when(F.col("reason") != "bad field", F.col("value")).alias("value"))


@query
def damaged_page_parse(spark, sf):
    """What can still be read of damaged pages."""
    return payloads.parse_earthquakes(samples.damaged_pages(_quakes(spark, sf))).select("event_id", "magnitude", "place")


@query
def category_map(spark, sf):
    ids = F.element_at(
        F.array(*[F.lit(c) for c in ["wildfires", "severeStorms", "seaLakeIce", "dustHaze", "tempExtremes"]]),
        (F.col("event_id").substr(7, 20).cast("long") % 5 + 1).cast("int"))
    named = _events(spark, sf).select(category_name(ids).alias("type"))
    return named.groupBy("type").agg(F.count("*").alias("count")).withColumn("title", title_case("type"))


@query
def decode_messages(spark, sf):
    records = samples.damaged(samples.quake_records(_quakes(spark, sf)))
    decoded = messages.accepted(messages.decode(records, EARTHQUAKE))
    return decoded.select("event_id", "source", "magnitude", "place", "time", "longitude", "latitude", "depth_km",
                          "status", "tsunami", "alert", "significance")


@query
def dead_letter(spark, sf):
    records = samples.damaged(samples.quake_records(_quakes(spark, sf)))
    dead = messages.dead_letters(messages.decode(records, EARTHQUAKE))
    return dead.select("reason", "message_key", F.when(F.col("reason") == "undecodable", F.col("value")).alias("value"))


@query
def kafka_records(spark, sf):
    declared = adapters.declarations(spark, sf)
    out = messages.encode(declared, messages.declaration_key(), ["event_id", "state", "incident_type", "seq"])
    return out.select(
        "key", F.get_json_object("value", "$.state").alias("state"),
        F.get_json_object("value", "$.seq").cast("long").alias("seq"))


@query
def ingest_window(spark, sf):
    """What the three live loads take: new quakes, open events, late declarations."""
    quakes = payloads.parse_earthquakes(samples.quake_pages(_quakes(spark, sf)))
    events = payloads.parse_natural_events(samples.event_pages(_events(spark, sf)))
    declared = payloads.parse_declarations(samples.declaration_pages(adapters.declarations(spark, sf)))
    parts = {
        "earthquake": payloads.historical_quakes(quakes, "2024-01-29", "2024-01-31"),
        "open_event": payloads.open_events(events, AS_OF, OPEN_DAYS),
        "closed_event": payloads.closed_events(events),
        "declaration": payloads.declared_after(declared, DECLARED_AFTER),
    }
    counted = [
        p.groupBy("event_id").agg(F.count("*").alias("count")).select(F.lit(name).alias("load"), "event_id", "count")
        for name, p in parts.items()]
    return counted[0].unionByName(counted[1]).unionByName(counted[2]).unionByName(counted[3])


# Keyed tables and streams

def _declaration_parts(spark, sf):
    records = samples.declaration_records(adapters.declarations(spark, sf))
    return [records.filter(F.col("offset") % 2 == p) for p in (0, 1)]


def _stream_feed(spark, sf, feed_name: str, parts: list[DataFrame]) -> Collection:
    """Land the parts one after the other; the stream restarts in between."""
    root = scratch_path(spark, feed_name)
    feed = ingest.FEEDS[feed_name]
    store = ingest.open_collection(spark, feed, root)
    for part in parts:
        messages.land(part, f"{root}/topic")
        stream = messages.topic_stream(spark, f"{root}/topic")
        ingest.start(feed, stream, store, f"{root}/checkpoint", available_now=True).awaitTermination()
    return store


@query
def upsert_latest(spark, sf):
    store = _stream_feed(spark, sf, "declarations", _declaration_parts(spark, sf))
    return store.current().select("event_id", "county", "state", "incident_type", "title")


DECLARED = "event_id STRING, county STRING, state STRING, incident_type STRING"
DECLARED_KEYS = ["event_id", "county"]


@query
def upsert_replay(spark, sf):
    """Batches replayed before and after a compaction leave the same documents."""
    store = Collection(spark, scratch_path(spark, "replay"), DECLARED, DECLARED_KEYS)
    declared = adapters.declarations(spark, sf).withColumn(ORDER, F.col("seq"))
    columns = [*DECLARED_KEYS, "state", "incident_type", ORDER]
    early, late = [declared.filter(F.col("seq") % 2 == p).select(columns) for p in (1, 0)]
    store.upsert(early, 0)
    store.compact()
    store.upsert(late, 1)
    store.upsert(late, 1)
    store.upsert(early, 0)
    return store.current()


@query
def upsert_growing(spark, sf):
    """A collection that grows past several splits, with a replay on either side of each."""
    store = Collection(spark, scratch_path(spark, "growing"), DECLARED, DECLARED_KEYS, buckets=3, fill=GROWING_FILL)
    declared = adapters.declarations(spark, sf).withColumn(ORDER, F.col("seq"))
    n = F.col("event_id").cast("long")
    parts = [n < 20, (n >= 10) & (n < 150), n >= 100]  # some keys come in two parts
    for batch, part in enumerate(parts):
        rows_ = declared.filter(part).select(*DECLARED_KEYS, "state", "incident_type", ORDER)
        store.upsert(rows_, batch)
        store.compact()
        store.upsert(rows_, batch)
    first, now = store.layout()
    return store.current().withColumn("grown", F.lit(now >= 2 * first))


def _second_writer(spark, sf, label: str, shift: int, compact: bool) -> DataFrame:
    """The first half under one checkpoint, the second under a fresh one whose
    batches start from 0 again and whose offsets are lowered by ``shift``."""
    root = scratch_path(spark, label)
    feed = ingest.FEEDS["declarations"]
    store = ingest.open_collection(spark, feed, root)
    records = samples.declaration_records(adapters.declarations(spark, sf))
    middle = records.agg(F.percentile_approx("offset", 0.5))
    halves = records.filter(F.col("offset") <= middle.scalar()), records.filter(F.col("offset") > middle.scalar())
    for n, half in enumerate(halves):
        messages.land(half.withColumn("offset", F.col("offset") - n * shift), f"{root}/topic{n}")
        stream = messages.topic_stream(spark, f"{root}/topic{n}")
        ingest.start(feed, stream, store, f"{root}/checkpoint{n}", available_now=True).awaitTermination()
        if compact:
            store.compact()
    return store.current().select("event_id", "county", "state", "incident_type", "title")


@query
def upsert_new_checkpoint(spark, sf):
    """A second checkpoint counts its batches from 0 again and loses nothing."""
    return _second_writer(spark, sf, "new-checkpoint", 0, compact=True)


@query
def upsert_topic_reset(spark, sf):
    """A topic made anew has small offsets; its documents are newer all the same."""
    return _second_writer(spark, sf, "topic-reset", 10_000_000_000, compact=False)


@query
def unseen_anti_join(spark, sf):
    """Live rows no earlier load has seen, first arrival of each."""
    quakes = _quakes(spark, sf).select("event_id", "magnitude", "ts")
    seen = quakes.filter(F.col("ts") < F.lit(SEEN_UNTIL).cast("timestamp_ntz"))
    incoming = rows.since(quakes, "ts", TREND_SINCE)
    twice = incoming.withColumn("pass", F.lit(1)).unionByName(incoming.withColumn("pass", F.lit(2)))
    return rows.unseen(twice, seen, ["event_id"], "pass").select("event_id", "magnitude", "pass")


@query
def unique_key_check(spark, sf):
    return rows.key_violations(adapters.declarations(spark, sf), ["event_id", "county"])


@query
def latest_declarations(spark, sf):
    newest = rows.latest_per_key(adapters.declarations(spark, sf), ["event_id", "county"], "seq")
    return newest.select("event_id", "county", "state", "incident_type", "seq")


@query
def stream_scored(spark, sf):
    records = samples.quake_records(_quakes(spark, sf))
    store = _stream_feed(spark, sf, "earthquakes", [records.filter(F.col("offset") % 3 != 0), records])
    return store.current().select(
        "event_id", "magnitude", "risk_score", "risk_tier", F.to_json("location.coordinates").isNotNull().alias("located"),
        F.get("location.coordinates", F.lit(0)).alias("lon"), F.get("location.coordinates", F.lit(1)).alias("lat"),
        _moment_text("ts"))


@query
def stream_natural_events(spark, sf):
    records = samples.event_records(_events(spark, sf))
    store = _stream_feed(spark, sf, "natural_events", [records])
    return store.current().select(
        "event_id", "source", "type", "title", "status", F.get("location.coordinates", F.lit(0)).alias("lon"),
        F.get("location.coordinates", F.lit(1)).alias("lat"), "geometry_count", _moment_text("last_ts"))


@query
def stream_dead_letters(spark, sf):
    store = _stream_feed(spark, sf, "earthquakes", [samples.damaged(samples.quake_records(_quakes(spark, sf)))])
    return store.dead_letters().select("reason", "message_key")


@query
def stream_dedup(spark, sf):
    """Records of several partitions, some files ten days late, then many of them
    again with later offsets: the first arrival of every key stays."""
    root = scratch_path(spark, "dedup")
    records = samples.quake_records(_quakes(spark, sf))
    late = (F.col("offset") % 5 == 0)
    again = records.filter(F.col("offset") % 2 == 0).withColumns({
        "offset": F.col("offset") + 1_000_000_000, "value": F.regexp_replace("value", r'"magnitude":[-0-9.E]+', '"magnitude":99.0')})
    store = Collection(spark, f"{root}/first", "event_id STRING, magnitude DOUBLE", ["event_id"], first=True)
    for part in (records.filter(~late), records.filter(late).withColumn("timestamp", F.col("timestamp") - F.expr("INTERVAL '10' DAY")), again):
        messages.land(part, f"{root}/topic")
        stream = messages.decode(messages.topic_stream(spark, f"{root}/topic"), EARTHQUAKE, keep=["offset"])
        rows_ = messages.accepted(stream).select("event_id", "magnitude", F.col("offset").alias(ORDER))
        live.keep_updated(rows_, store, f"{root}/checkpoint", mode="append").awaitTermination()
    return store.current()


@query
def stream_daily_cells(spark, sf):
    root = scratch_path(spark, "daily")
    records = samples.quake_records(_quakes(spark, sf))
    store = Collection(spark, f"{root}/cells", "day DATE, grid_lat DOUBLE, grid_lon DOUBLE, event_count BIGINT, max_mag DOUBLE",
                       ["day", *grid.CELL])
    for remainder in (0, 1):
        messages.land(records.filter(F.col("offset") % 2 == remainder), f"{root}/topic")
        stream = messages.decode(messages.topic_stream(spark, f"{root}/topic"), EARTHQUAKE)
        cells = live.daily_cells(messages.accepted(stream).withColumn("ts", F.try_to_timestamp("time")))
        live.keep_updated(cells, store, f"{root}/checkpoint").awaitTermination()
    return store.current().withColumn("day", F.col("day").cast("string"))


@query
def stream_dedup_window(spark, sf):
    """Every event again at the time of the last one, after a restart: those still remembered are dropped, the others pass."""
    root = scratch_path(spark, "dedup-window")
    quakes = _quakes(spark, sf).filter(F.col("ts").isNotNull())
    last = quakes.agg(F.max("ts")).scalar()
    for n, part in enumerate((quakes, quakes.withColumns({"magnitude": F.lit(99.0), "ts": last}))):
        records = samples.quake_records(part).withColumn("offset", F.col("offset") + n * 1_000_000_000)
        messages.land(records, f"{root}/topic")
        stream = messages.decode(messages.topic_stream(spark, f"{root}/topic"), EARTHQUAKE, keep=["offset"])
        rows_ = messages.accepted(stream).withColumn("ts", F.try_to_timestamp("time")).select("event_id", "magnitude", "ts")
        first = live.without_repeats(rows_, ["event_id"], DEDUP_DELAY)
        out = first.writeStream.format("parquet").option("path", f"{root}/first").option("checkpointLocation", f"{root}/checkpoint")
        out.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{root}/first").select("event_id", "magnitude")


@query
def stream_rate_alerts(spark, sf):
    """Spikes of sliding windows: some events come late within the delay, others, far too late, are dropped."""
    root = scratch_path(spark, "alerts")
    quakes = _quakes(spark, sf).filter(F.col("ts").isNotNull())
    cells, totals = baseline.fit_baseline(quakes)
    cells, totals = materialise(cells, "rates"), materialise(totals, "limits")
    n, day = F.col("event_id").cast("long"), F.col("ts").cast("timestamp")
    early = (day < F.lit("2024-01-20").cast("timestamp")) & ~((n % 5 == 0) & (day >= F.lit("2024-01-19 12:00:00").cast("timestamp")))
    stale = quakes.filter(n % 7 == 0).withColumn("ts", F.col("ts") - F.expr("INTERVAL '20' DAY"))
    for batch, part in enumerate((quakes.filter(early), quakes.filter(~early), stale)):
        records = samples.quake_records(part).withColumn("offset", F.col("offset") + batch * 1_000_000_000)
        messages.land(records, f"{root}/topic")
        stream = messages.accepted(messages.decode(messages.topic_stream(spark, f"{root}/topic"), EARTHQUAKE))
        alerts = spikes.rate_alerts(
            stream.withColumn("ts", F.try_to_timestamp("time")), cells, totals, ALERT_WINDOW, ALERT_SLIDE, ALERT_DELAY)
        spikes.emit(alerts, f"{root}/alerts", f"{root}/checkpoint").awaitTermination()
    found = spark.read.parquet(f"{root}/alerts")
    return found.withColumns({x: F.date_format(x, "yyyy-MM-dd HH:mm:ss") for x in ("window_start", "window_end")})


def _revised(quakes: DataFrame, version: int) -> DataFrame:
    """All events with a higher magnitude; half of them moved; a third as they are."""
    n = F.col("event_id").cast("long")
    if version == 0:
        return quakes.withColumn("magnitude", F.col("magnitude") + 1)
    if version == 1:
        return quakes.filter(n % 2 == 0).withColumns({"magnitude": F.col("magnitude") + 3, "latitude": F.col("latitude") / 2})
    return quakes.filter(n % 3 == 0)


@query
def stream_corrected_cells(spark, sf):
    """Every event one to three times, with other magnitudes and places: only its newest version counts."""
    root = scratch_path(spark, "corrected")
    view = CorrectedCells(spark, root)
    for version in range(3):
        records = samples.quake_records(_revised(_quakes(spark, sf), version))
        messages.land(records.withColumn("offset", F.col("offset") + version * 1_000_000_000), f"{root}/topic")
        stream = messages.decode(messages.topic_stream(spark, f"{root}/topic"), EARTHQUAKE, keep=["offset"])
        versions = messages.accepted(stream).withColumns({"ts": F.try_to_timestamp("time"), ORDER: F.col("offset")})
        view.follow(versions, f"{root}/checkpoint", compact_every=2).awaitTermination()
    return view.current().withColumn("day", F.col("day").cast("string"))


@query
def stream_newest_state(spark, sf):
    """Newest version per key as streaming state: what it holds at the end, and which keys it has forgotten."""
    root = scratch_path(spark, "newest-state")
    for version in range(3):
        part = _revised(_quakes(spark, sf), version).filter(F.col("ts").isNotNull())
        records = samples.quake_records(part).withColumn("offset", F.col("offset") + version * 1_000_000_000)
        messages.land(records, f"{root}/topic")
        if version == 0:  # the first two versions come in one run, the third after a restart
            continue
        stream = messages.accepted(messages.decode(messages.topic_stream(spark, f"{root}/topic"), EARTHQUAKE, keep=["offset"]))
        rows_ = stream.withColumn("ts", F.try_to_timestamp("time")).select("event_id", "magnitude", "ts", F.col("offset").alias(ORDER))
        changes = live.newest_in_state(rows_, ["event_id"], ORDER, STATE_DELAY)
        spikes.emit(changes, f"{root}/changes", f"{root}/checkpoint").awaitTermination()
    changes = spark.read.parquet(f"{root}/changes")
    return changes.groupBy("event_id").agg(
        F.max_by("magnitude", ORDER).alias("magnitude"), F.max("expired").alias("expired"))


@query
def stream_pages_topic(spark, sf):
    """Archive and live pages into one topic, with a restart in between, and from there into the collection."""
    root = scratch_path(spark, "pages-topic")
    events = _events(spark, sf)
    n = F.substring_index("event_id", "_", -1).cast("long")
    late = events.filter(n % 3 == 0).withColumn("title", F.concat("title", F.lit(", seen live")))
    feed = ingest.FEEDS["natural_events"]
    store = ingest.open_collection(spark, feed, root)
    for archive, now in ((events.filter(n % 2 == 0), late.filter(n % 2 == 0)), (events.filter(n % 2 == 1), late.filter(n % 2 == 1))):
        samples.event_pages(archive).write.mode("append").text(f"{root}/archive")
        samples.event_pages(now).write.mode("append").text(f"{root}/live")
        pages = [payloads.pages_stream(spark, f"{root}/{x}", one_per_line=True) for x in ("archive", "live")]
        ingest.publish_pages(pages, payloads.parse_natural_events, "event_id", f"{root}/topic", f"{root}/published").awaitTermination()
        stream = messages.topic_stream(spark, f"{root}/topic")
        ingest.start(feed, stream, store, f"{root}/checkpoint", available_now=True).awaitTermination()
    copies = spark.read.parquet(f"{root}/topic").groupBy(F.col("key").alias("event_id")).agg(F.count("*").alias("copies"))
    return store.current().join(copies, "event_id").select("event_id", "title", "status", "copies")


@query
def stream_newest_versions(spark, sf):
    """Newest version per key, kept by the collection rather than as stream state."""
    root = scratch_path(spark, "newest")
    store = Collection(spark, f"{root}/docs", DECLARED, DECLARED_KEYS)
    for part in _declaration_parts(spark, sf):
        messages.land(part, f"{root}/topic")
        stream = messages.decode(messages.topic_stream(spark, f"{root}/topic"), DECLARATION, keep=["offset"])
        stream = messages.accepted(stream).select(*DECLARED_KEYS, "state", "incident_type", F.col("offset").alias(ORDER))
        live.keep_updated(stream, store, f"{root}/checkpoint", mode="append").awaitTermination()
        store.compact()
    return store.current()


# Learning

@query
def training_window(spark, sf):
    return rows.since(adapters.archive(spark, sf), "ts", TRAINING_START).select("event_id", "magnitude", _moment_text("ts"))


@query
def stratified_sample(spark, sf):
    return sampling.stratified(_quakes(spark, sf).filter(is_known("magnitude"))).select("event_id", "magnitude")


@query
def rf_features(spark, sf):
    return risk_forest.features(_quakes(spark, sf)).withColumn("log_depth", _six("log_depth")).withColumn(
        "mag_squared", _six("mag_squared"))


@query
def rf_label(spark, sf):
    return risk_forest.labelled(_quakes(spark, sf)).select("event_id", "sig_norm", "risk_tier")


@query
def dataset_counts(spark, sf):
    return sampling.dataset_counts(risk_forest.training_frame(_quakes(spark, sf)))


@query
def region_features(spark, sf):
    cells = baseline.region_features(_quakes(spark, sf))
    return cells.select(*grid.CELL, "eq_count", _six("avg_mag"), "max_mag", _six("avg_depth"), _six("mag_variability"))


@query
def region_scaled(spark, sf):
    """Standardised cluster features."""
    cells = baseline.region_features(adapters.archive(spark, sf))
    scaled = regions.standardiser(cells).transform(cells).withColumn("v", vector_to_array("features"))
    named = [F.col("v")[i].alias(f"z_{name}") for i, name in enumerate(regions.FEATURES)]
    return scaled.select(*grid.CELL, *named).select(*grid.CELL, *[_six(f"z_{name}") for name in regions.FEATURES])


@query
def alert_index(spark, sf):
    """Alert levels as model inputs, indexed by falling frequency."""
    x = risk_forest.features(_quakes(spark, sf))
    return risk_forest.alert_indexer().fit(x).transform(x).select("event_id", "alert", "alert_idx")


def _sweep(spark, sf):
    return regions.sweep(baseline.region_features(rows.since(adapters.archive(spark, sf), "ts", TRAINING_START)))


@query
def elbow(spark, sf):
    """The elbow rule over the costs of the sweep."""
    return regions.elbow(_sweep(spark, sf).costs).select("k", _six("wssse"), _six("drop"), "best_k", "chosen")


@query
def cluster_profiles(spark, sf):
    """Profiles and labels of the clusters that the sweep finds under the elbow's k."""
    p = regions.cluster_profiles(_sweep(spark, sf).chosen())
    return p.select("cluster_id", "region_count", _six("avg_eq_count"), _six("cluster_avg_mag"), "cluster_max_mag", _six("cluster_avg_depth"), "label")


@query
def region_model(spark, sf):
    """Every region's cluster and squared distance to its centre, for each k of the sweep."""
    found = _sweep(spark, sf)
    return regions.nearest(found.points, found.centres).select("k", *grid.CELL, "cluster_id", _six("distance"))


_forests: dict[tuple[str, str], str] = {}


def _forest(spark, sf) -> str:
    """The tables of a forest trained on ``sf``, once a session."""
    known = (spark.sparkContext.applicationId, sf)
    if known not in _forests:
        path = scratch_path(spark, "forest")
        risk_forest.train(_quakes(spark, sf), f"{path}/model")
        risk_forest.write_tables(spark, f"{path}/model", path)
        _forests[known] = path
    return _forests[known]


@query
def rf_metrics(spark, sf):
    """RMSE and R2 over predictions that the table fixes."""
    fixed = risk_forest.labelled(_quakes(spark, sf)).withColumn("prediction", F.col("magnitude") * 10)
    m = risk_forest.metrics(fixed)
    return m.select("rows", _six("rmse"), _six("r2"))


@query
def rf_importance(spark, sf):
    """Feature importances from the gains in the forest's node table."""
    return risk_forest.importances_by_nodes(spark, _forest(spark, sf)).select("feature", _six("importance"))


@query
def rf_scored(spark, sf):
    """Scores and tiers of all events, by the forest's node table."""
    return risk_forest.score_by_nodes(_quakes(spark, sf), _forest(spark, sf)).select("event_id", _six("predicted_score"), "predicted_tier")


@query
def stats_roundtrip(spark, sf):
    """Cell statistics saved as JSON lines and loaded again."""
    path = f"{scratch_path(spark, 'stats')}/cells"
    cells, _ = baseline.fit_baseline(_quakes(spark, sf))
    keyed = cells.select(stats.cell_key().alias("cell"), "historical_count", "daily_rate", "avg_mag", "max_mag", "std_mag")
    stats.write_json(keyed, path)
    return stats.read_json(spark, path, keyed.schema)
