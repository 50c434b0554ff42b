"""Landed API pages (one JSON document each) to flat rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quakeloom import schemas
from quakeloom.functions.text import category_name, iso_utc
from quakeloom.operators.rows import with_key
from quakeloom.sources.messages import CORRUPT


def read_pages(spark: SparkSession, path: str, one_per_line: bool = False) -> DataFrame:
    """Pages as one text column ``payload``: a file each, or a line each."""
    return spark.read.text(path, wholetext=not one_per_line).select(F.col("value").alias("payload"))


def pages_stream(spark: SparkSession, path: str, one_per_line: bool = False, files_per_trigger: int | None = None) -> DataFrame:
    """Landed pages as a stream of ``payload``: each file is taken once, whenever it lands."""
    reader = spark.readStream.option("wholetext", not one_per_line)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path).select(F.col("value").alias("payload"))


def _parsed(pages: DataFrame, schema: str) -> DataFrame:
    """One row per item with its text and ``x``, or one per page that is no page.

    The array is split as text and every item parsed on its own, so an item
    that does not fit takes no other item of its page with it.
    """
    page = StructType.fromDDL(schema)
    field, item = page.fields[0].name, page.fields[0].dataType.elementType
    texts = F.from_json("payload", f"{field} ARRAY<STRING>")[field]
    whole = F.array(F.struct(F.col("payload").alias("item"), F.lit(True).alias("page")))
    one = F.when(texts.isNull(), whole).otherwise(F.transform(texts, lambda t: F.struct(t.alias("item"), F.lit(False).alias("page"))))
    rows = pages.select(F.inline(one))
    kept = StructType(item.fields).add(CORRUPT, "string")
    # in a generator, as a projection would be copied into every filter on parsed columns
    return rows.select("item", "page", F.explode(F.array(F.from_json("item", kept, {"columnNameOfCorruptRecord": CORRUPT}))).alias("x"))


def _some(rows: DataFrame) -> Column:
    """Something of the item could be read."""
    names = [f.name for f in rows.schema["x"].dataType.fields if f.name != CORRUPT]
    return F.greatest(*[F.col(f"x.{n}").isNotNull() for n in names])


def _items(pages: DataFrame, schema: str) -> DataFrame:
    rows = _parsed(pages, schema)
    return rows.filter(~F.col("page") & _some(rows)).select("x.*").drop(CORRUPT)


def page_dead_letters(pages: DataFrame, schema: str, key: str) -> DataFrame:
    """What the parsers lost, as messages have it: reason, message_key and the text.

    Unreadable pages and items are lost whole; an item with a field that does
    not fit is kept without that field and is listed here too.
    """
    rows = _parsed(pages, schema)
    reason = (F.when(F.col("page"), "unreadable page").when(~_some(rows), "unreadable item")
              .when(F.col(f"x.{CORRUPT}").isNotNull(), "bad field"))
    return rows.select(reason.alias("reason"), F.col(f"x.{key}").cast("string").alias("message_key"), F.col("item").alias("value")).filter(
        F.col("reason").isNotNull())


def _iso_or_null(millis: str) -> Column:
    c = F.col(millis)
    return F.when(c.isNotNull(), iso_utc(c))


def parse_earthquakes(pages: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Features to the flat earthquake record; a missing geometry gives null coordinates."""
    x = _items(pages, schemas.EARTHQUAKE_PAYLOAD)
    point = F.col("geometry.coordinates")
    return x.select(
        F.col("id").alias("event_id"), F.lit("USGS").alias("source"), F.lit("earthquake").alias("type"),
        F.col("properties.mag").alias("magnitude"), F.col("properties.place").alias("place"),
        _iso_or_null("properties.time").alias("time"), _iso_or_null("properties.updated").alias("updated"),
        F.get(point, F.lit(0)).alias("longitude"), F.get(point, F.lit(1)).alias("latitude"),
        F.get(point, F.lit(2)).alias("depth_km"),
        F.col("properties.status").alias("status"), F.col("properties.tsunami").alias("tsunami"),
        F.col("properties.alert").alias("alert"), F.col("properties.felt").alias("felt"),
        F.col("properties.url").alias("url"), _stamp(ingested_at).alias("ingested_at"),
        F.col("properties.sig").alias("significance"),
    )


def _stamp(ingested_at: Column | None) -> Column:
    if ingested_at is not None:
        return ingested_at
    return iso_utc(F.unix_millis(F.current_timestamp()))


def first_point(coordinates: Column) -> Column:
    """[lon, lat] of a point, of a line's first vertex, or of the first vertex
    of a polygon's outer ring. The nesting shows in the opening brackets."""
    text = F.regexp_replace(coordinates, r"\s", "")
    return (
        F.when(text.startswith("[[["), F.get(F.get(F.from_json(text, "array<array<array<double>>>"), F.lit(0)), F.lit(0)))
        .when(text.startswith("[["), F.get(F.from_json(text, "array<array<double>>"), F.lit(0)))
        .otherwise(F.from_json(text, "array<double>"))
    )


def parse_natural_events(pages: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Events to flat records: first category, first and last geometry."""
    x = _items(pages, schemas.NATURAL_EVENT_PAYLOAD)
    first = F.get("geometry", F.lit(0))
    last = F.try_element_at("geometry", F.lit(-1))
    category = F.coalesce(F.get("categories", F.lit(0))["id"], F.lit("unknown"))
    x = x.withColumn("_point", first_point(last["coordinates"]))
    return x.select(
        F.col("id").alias("event_id"), F.lit("NASA_EONET").alias("source"), category_name(category).alias("type"),
        "title", "description", "status",
        _column_of("categories", "title").alias("categories"),
        F.get("_point", F.lit(0)).alias("longitude"), F.get("_point", F.lit(1)).alias("latitude"),
        F.coalesce(F.size("geometry"), F.lit(0)).alias("geometry_count"),
        first["date"].alias("start_date"), last["date"].alias("last_date"),
        _column_of("sources", "url").alias("sources"), _stamp(ingested_at).alias("ingested_at"),
    )


def _column_of(array: str, field: str) -> Column:
    values = F.transform(F.col(array), lambda e: e[field])
    return F.coalesce(values, F.array().cast("array<string>"))


def parse_declarations(pages: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    x = _items(pages, schemas.DECLARATION_PAYLOAD)
    return x.select(
        F.col("disasterNumber").cast("string").alias("event_id"), "state", F.col("designatedArea").alias("county"),
        F.col("incidentType").alias("incident_type"), F.col("declarationDate").alias("declaration_date"),
        F.col("declarationTitle").alias("title"),
        F.col("ihProgramDeclared").alias("ih_program_declared"),
        F.col("iaProgramDeclared").alias("ia_program_declared"),
        F.col("paProgramDeclared").alias("pa_program_declared"),
        F.col("hmProgramDeclared").alias("hm_program_declared"),
        _stamp(ingested_at).alias("ingested_at"),
    )


def moment(text: Column | str) -> Column:
    """ISO text as a timestamp; unreadable text becomes null."""
    return F.try_to_timestamp(F.col(text) if isinstance(text, str) else text)


# Ingest windows: which parsed rows a load takes.

def historical_quakes(rows: DataFrame, start: str, end: str, floor: float = 2.5) -> DataFrame:
    """Keyed quakes from the floor magnitude up in the half-open window [start, end)."""
    ts = moment("time")
    window = (ts >= F.lit(start).cast("timestamp")) & (ts < F.lit(end).cast("timestamp"))
    return with_key(rows).filter((F.col("magnitude") >= floor) & window)


def closed_events(rows: DataFrame) -> DataFrame:
    return with_key(rows).filter(F.col("status") == "closed")


def open_events(rows: DataFrame, as_of: str, days: int) -> DataFrame:
    """Open events last seen within ``days`` before ``as_of``."""
    start = F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL '{int(days)}' DAY")
    return with_key(rows).filter((F.col("status") == "open") & (moment("last_date") >= start))


def declared_after(rows: DataFrame, since: str) -> DataFrame:
    """Declarations strictly later than ``since``."""
    return with_key(rows).filter(moment("declaration_date") > F.lit(since).cast("timestamp"))
