"""Topic messages to stored documents, one streaming query per topic."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quakeloom import schemas
from quakeloom.functions.scoring import geo_point, with_risk
from quakeloom.sources.messages import accepted, dead_letters, decode, encode
from quakeloom.sources.tables import ORDER, Collection, writer_of

POINT = "location STRUCT<type: STRING, coordinates: ARRAY<DOUBLE>>"


def with_location(rows: DataFrame) -> DataFrame:
    return rows.withColumn("location", geo_point())


def as_stored_quakes(rows: DataFrame) -> DataFrame:
    """Scored, with a GeoJSON point and a typed event time that scans can prune on."""
    return with_location(with_risk(rows)).withColumn("ts", F.try_to_timestamp("time"))


def as_stored_events(rows: DataFrame) -> DataFrame:
    return with_location(rows).withColumn("last_ts", F.try_to_timestamp("last_date"))


def as_stored_declarations(rows: DataFrame) -> DataFrame:
    return rows.withColumn("declaration_ts", F.try_to_timestamp("declaration_date"))


@dataclass(frozen=True)
class Feed:
    """One topic: message schema, enrichment, stored columns, trigger interval and layout."""

    topic: str
    collection: str
    schema: str
    enrich: Callable[[DataFrame], DataFrame]
    stored: str
    interval: str
    time_column: str

    @property
    def keys(self) -> list[str]:
        return schemas.KEYS[self.collection]


FEEDS = {
    "earthquakes": Feed(
        "usgs-earthquakes", "earthquakes", schemas.EARTHQUAKE, as_stored_quakes,
        f"{schemas.EARTHQUAKE}, risk_score DOUBLE, risk_tier STRING, {POINT}, ts TIMESTAMP", "30 seconds", "ts"),
    "natural_events": Feed(
        "nasa-eonet-events", "eonet_events", schemas.NATURAL_EVENT, as_stored_events,
        f"{schemas.NATURAL_EVENT}, {POINT}, last_ts TIMESTAMP", "60 seconds", "last_ts"),
    "declarations": Feed(
        "fema-disasters", "fema_disasters", schemas.DECLARATION, as_stored_declarations,
        f"{schemas.DECLARATION}, declaration_ts TIMESTAMP", "120 seconds", "declaration_ts"),
}


def publish_pages(sources: list[DataFrame], parse: Callable[[DataFrame], DataFrame], key: Column | str, topic: str,
                  checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Items of streamed pages into one topic folder, each page once, restarts included.

    ``sources`` are streams of pages (see :func:`payloads.pages_stream`), such as the archive and the live
    pages of one feed; they share the topic and the checkpoint. A record's offset is the moment of its
    micro-batch, which a batch run again keeps, so what lands later is newer; within a batch a later
    source in the list is newer. Items without a key are left to the page dead letters.
    """
    moment = F.unix_micros(F.current_timestamp()) * len(sources)
    parts = []
    for rank, pages in enumerate(sources):
        rows = parse(pages)
        named = rows.filter(F.col("event_id").isNotNull() & (F.col("event_id") != ""))
        messages = encode(named, key, [c for c in rows.columns if c != "ingested_at"])
        parts.append(messages.select("key", "value", F.lit(rank).alias("partition"), (moment + rank).alias("offset"),
                                     F.current_timestamp().alias("timestamp")))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    out = every.writeStream.format("parquet").option("path", topic).option("checkpointLocation", checkpoint).outputMode("append")
    return (out.trigger(availableNow=True) if available_now else out).start()


def open_collection(spark: SparkSession, feed: Feed, root: str, fill: int = 1_000_000) -> Collection:
    return Collection(spark, f"{root}/{feed.collection}", feed.stored, feed.keys, feed.time_column, fill=fill)


def start(feed: Feed, records: DataFrame, collection: Collection, checkpoint: str, available_now: bool = False,
          on_batch: Callable[[int, int], None] | None = None, cache_batches: bool = False) -> StreamingQuery:
    """Decode, enrich and upsert every micro-batch of ``records``.

    Delivery is at least once; versions are ordered by checkpoint, batch and
    offset, so a replay changes nothing and a re-created topic hides nothing.
    Documents and dead letters are two passes over the batch: parsing twice is
    cheaper than caching the parsed rows, but ``cache_batches`` spares a slow
    source the second read. Call ``collection.compact()`` beside the stream now
    and then; the stream itself never rewrites what is stored.
    """
    decoded = decode(records, feed.schema, keep=["offset"]).withColumnRenamed("offset", ORDER)
    writer = writer_of(collection.spark, checkpoint)

    def store(batch: DataFrame, batch_id: int) -> None:
        if cache_batches:
            batch = batch.persist()
        try:
            seen = Observation()
            rows = feed.enrich(accepted(batch)).observe(seen, F.count(F.lit(1)).alias("rows"))
            collection.upsert(rows, batch_id, writer)
            collection.append_dead_letters(dead_letters(batch), batch_id, writer)
            if on_batch:
                on_batch(batch_id, seen.get["rows"])
        finally:
            if cache_batches:
                batch.unpersist()

    out = decoded.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    out = out.trigger(availableNow=True) if available_now else out.trigger(processingTime=feed.interval)
    return out.start()


def run_all(spark: SparkSession, sources: dict[str, DataFrame], root: str, available_now: bool = False,
            timeout: float | None = None) -> dict[str, Collection]:
    """Run every feed that has a source, each with its own checkpoint.

    With ``available_now`` the queries drain their topics and end; otherwise
    this waits until one of them stops or ``timeout`` seconds have passed.
    """
    stores = {name: open_collection(spark, FEEDS[name], root) for name in sources}
    running = [
        start(FEEDS[name], stream, stores[name], f"{root}/checkpoints/{name}", available_now)
        for name, stream in sources.items()
    ]
    if available_now:
        for query in running:
            query.awaitTermination()
    elif timeout is None:
        spark.streams.awaitAnyTermination()
    else:
        spark.streams.awaitAnyTermination(timeout)
    return stores
