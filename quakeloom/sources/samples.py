"""Pages and topic records built from the adapter tables.

They put the parsers and the streams in front of realistic text: nested pages,
geometries of several shapes, numeric ids, broken and incomplete messages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quakeloom.functions.text import iso_utc
from quakeloom.sources.messages import declaration_key

PAGE_ROWS = 500


def _millis(ts: str) -> Column:
    return F.unix_millis(F.col(ts).cast("timestamp"))


def _pages(rows: DataFrame, item: Column, field: str) -> DataFrame:
    """Pages of at most ``PAGE_ROWS`` items, as the public feeds deliver them.

    Pages follow the row number within a partition, not a key, so none can
    outgrow its size; callers pass rows in an order that a retry repeats.
    """
    page = F.floor(F.monotonically_increasing_id() / PAGE_ROWS)
    paged = rows.select(page.alias("page"), item.alias("item")).groupBy("page").agg(F.collect_list("item").alias("items"))
    text = F.concat(F.lit(f'{{"{field}":['), F.array_join("items", ","), F.lit("]}"))
    return paged.select(text.alias("payload"))


def quake_pages(quakes: DataFrame, change: Callable[[Column], Column] = lambda item: item) -> DataFrame:
    """Earthquake pages; events without a latitude have no geometry."""
    properties = F.struct(
        F.col("magnitude").alias("mag"), "place", _millis("ts").alias("time"),
        (_millis("ts") + 60000).alias("updated"), F.lit("reviewed").alias("status"), "tsunami", "alert",
        F.lit(None).cast("int").alias("felt"), F.concat(F.lit("event/"), F.col("event_id")).alias("url"),
        F.col("significance").alias("sig"))
    geometry = F.when(
        F.col("latitude").isNotNull(), F.struct(F.array("longitude", "latitude", "depth_km").alias("coordinates")))
    feature = F.struct(F.col("event_id").alias("id"), properties.alias("properties"), geometry.alias("geometry"))
    return _pages(quakes, change(F.to_json(feature)), "features")


def damaged_pages(quakes: DataFrame) -> DataFrame:
    """Earthquake pages with items that are no objects, numbers as text, and one page cut off."""
    n = F.col("event_id").cast("long")
    whole = quake_pages(quakes, lambda item: F.when(n % 50 == 3, F.concat(F.lit('"lost '), F.col("event_id"), F.lit('"')))
                        .when(n % 70 == 5, F.regexp_replace(item, r'"mag":[-0-9.E]+', '"mag":"5.1 Mw"')).otherwise(item))
    return whole.unionByName(quakes.sparkSession.createDataFrame([('{"features":[{"id":"cut","properties":{"mag":5.',)], "payload STRING"))


def _event_number() -> Column:
    return F.substring_index("event_id", "_", -1).cast("long")


def event_pages(events: DataFrame) -> DataFrame:
    """Natural-event pages with point, line and polygon geometries, unmapped and
    missing categories, and an empty geometry list where the latitude is unknown."""
    n = _event_number()
    category = (
        F.when(n % 50 == 0, "tempExtremes").when(F.col("type") == "wildfire", "wildfires")
        .when(F.col("type") == "storm", "severeStorms").otherwise("volcanoes"))
    categories = F.when(n % 77 == 0, F.array().cast("array<struct<id:string,title:string>>")).otherwise(
        F.array(F.struct(category.alias("id"), F.col("type").alias("title"))))
    head = F.to_json(F.struct(
        F.col("event_id").alias("id"), "title", F.when(n % 4 == 0, "closed").otherwise("open").alias("status"),
        categories.alias("categories"),
        F.array(F.struct(F.concat(F.lit("source/"), F.col("event_id")).alias("url"))).alias("sources")))
    point = F.to_json(F.array("longitude", "latitude"))
    shape = (
        F.when(n % 4 == 1, F.concat(F.lit("[["), F.col("longitude"), F.lit(","), F.col("latitude"), F.lit("],[0,0]]")))
        .when(n % 4 == 2, F.concat(F.lit("[ [["), F.col("longitude"), F.lit(","), F.col("latitude"), F.lit("],[0,0],[1,1]]]")))
        .otherwise(point))
    first = F.concat(F.lit('{"date":"2023-12-01T00:00:00Z","coordinates":[0.5,0.5]},'))
    last = F.concat(F.lit('{"date":"'), F.date_format("last_ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit('","coordinates":'), shape, F.lit("}"))
    geometry = F.when(F.col("latitude").isNull(), "").when(n % 5 == 0, last).otherwise(F.concat(first, last))
    item = F.concat(F.expr("substring(_head, 1, length(_head) - 1)"), F.lit(',"geometry":['), geometry, F.lit("]}"))
    return _pages(events.withColumn("_head", head), item, "events")


def declaration_pages(declarations: DataFrame) -> DataFrame:
    odd = F.col("seq") % 2 == 1
    item = F.struct(
        F.col("event_id").cast("long").alias("disasterNumber"), "state", F.col("county").alias("designatedArea"),
        F.col("incident_type").alias("incidentType"),
        F.date_format("declaration_ts", "yyyy-MM-dd'T'HH:mm:ss'.000Z'").alias("declarationDate"),
        F.concat(F.lit("Declaration "), F.col("seq")).alias("declarationTitle"),
        odd.alias("ihProgramDeclared"), (~odd).alias("iaProgramDeclared"),
        F.lit(True).alias("paProgramDeclared"), F.lit(False).alias("hmProgramDeclared"))
    return _pages(declarations.sortWithinPartitions("seq"), F.to_json(item), "DisasterDeclarationsSummaries")


def _record(messages: DataFrame, offset: Column, ts: Column) -> DataFrame:
    return messages.select(
        "key", "value", F.pmod(offset, F.lit(3)).cast("int").alias("partition"), offset.cast("long").alias("offset"), ts.cast("timestamp").alias("timestamp"))


def quake_records(quakes: DataFrame) -> DataFrame:
    """Topic records of earthquakes; the event number is the offset."""
    fields = [
        "event_id", F.lit("USGS").alias("source"), F.lit("earthquake").alias("type"), "magnitude", "place",
        iso_utc(_millis("ts")).alias("time"), "longitude", "latitude", "depth_km", "tsunami", "alert",
        "significance", F.lit("dropped").alias("updated")]
    value = F.to_json(F.struct(*fields)).alias("value")
    return _record(
        quakes.select(F.col("event_id").alias("key"), value, "event_id", "ts"), F.col("event_id"), F.col("ts"))


def damaged(records: DataFrame) -> DataFrame:
    """Some records broken: no JSON at all, text for a number, no key."""
    n = F.col("offset")
    value = (
        F.when(n % 50 == 3, F.concat(F.lit("not json "), F.col("key")))
        .when(n % 70 == 5, F.regexp_replace("value", r'"magnitude":[-0-9.E]+', '"magnitude":"5.1 Mw"'))
        .when(n % 90 == 7, F.regexp_replace("value", r'"event_id":"[0-9]+",', ""))
        .otherwise(F.col("value")))
    return records.withColumn("value", value)


def event_records(events: DataFrame) -> DataFrame:
    """Topic records of natural events; the event number is the offset."""
    n = _event_number()
    fields = [
        "event_id", F.lit("NASA_EONET").alias("source"), "type", "title",
        F.when(n % 4 == 0, "closed").otherwise("open").alias("status"), "longitude", "latitude",
        iso_utc(_millis("last_ts")).alias("last_date"), F.lit(1).alias("geometry_count"),
        F.array("title").alias("categories")]
    value = F.to_json(F.struct(*fields)).alias("value")
    return _record(events.select(F.col("event_id").alias("key"), value, n.alias("n"), "last_ts"), F.col("n"), F.col("last_ts"))


def declaration_records(declarations: DataFrame) -> DataFrame:
    """Topic records of declarations; ids are JSON numbers, as the feed sends them."""
    rows = declarations.select(
        F.col("event_id").cast("long").alias("event_id"), "state", "county", "incident_type",
        F.concat(F.lit("Declaration "), F.col("seq")).alias("title"),
        F.date_format("declaration_ts", "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("declaration_date"),
        declaration_key().alias("_key"), "seq", "declaration_ts")
    columns = ["event_id", "state", "county", "incident_type", "title", "declaration_date"]
    value = F.to_json(F.struct(*columns)).alias("value")
    return _record(
        rows.select(F.col("_key").alias("key"), value, "seq", "declaration_ts"), F.col("seq"), F.col("declaration_ts"))


