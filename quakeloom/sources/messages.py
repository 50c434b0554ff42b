"""Keyed topic messages: encode, land, read, decode, dead letters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quakeloom.functions.text import shown
from quakeloom.schemas import RECORD

CORRUPT = "_corrupt_record"


def declaration_key(event_id: str = "event_id", county: str = "county") -> Column:
    return F.concat_ws("-", shown(event_id), shown(county), F.lit("summaries"))


def encode(rows: DataFrame, key: Column | str, value_columns: Sequence[str] | None = None) -> DataFrame:
    """(key, value) messages; the value is the row as JSON."""
    columns = list(value_columns or rows.columns)
    key = F.col(key) if isinstance(key, str) else key
    return rows.select(key.cast("string").alias("key"), F.to_json(F.struct(*columns)).alias("value"))


def land(records: DataFrame, path: str) -> None:
    """Append records (key, value, partition, offset, timestamp) to a topic folder."""
    records.select("key", "value", "partition", "offset", "timestamp").write.mode("append").parquet(path)


def topic_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Landed records as a stream, with the file's arrival time as ``arrived_at``."""
    reader = spark.readStream.schema(RECORD)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path).select("*", F.col("_metadata.file_modification_time").alias("arrived_at"))


def kafka_options(topic: str, brokers: str, offsets_per_trigger: int | None = None) -> dict[str, str]:
    """Without ``offsets_per_trigger`` a trigger takes all there is."""
    options = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }
    return options if offsets_per_trigger is None else options | {"maxOffsetsPerTrigger": str(offsets_per_trigger)}


def kafka_stream(spark: SparkSession, topic: str, brokers: str, offsets_per_trigger: int | None = None) -> DataFrame:
    """A broker topic with the columns of :func:`topic_stream` (needs the Kafka package)."""
    source = spark.readStream.format("kafka").options(**kafka_options(topic, brokers, offsets_per_trigger)).load()
    return source.select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
        "partition", "offset", "timestamp", F.col("timestamp").alias("arrived_at"))


def kafka_publish(messages: DataFrame, topic: str, brokers: str, checkpoint: str | None = None):
    """Publish (key, value) messages to a broker topic (needs the Kafka package).

    A streaming frame also needs a checkpoint; its running query is returned.
    """
    options = {"kafka.bootstrap.servers": brokers, "topic": topic}
    if not messages.isStreaming:
        messages.write.format("kafka").options(**options).save()
        return None
    writer = messages.writeStream.format("kafka").options(**options).option("checkpointLocation", checkpoint)
    return writer.start()


def decode(records: DataFrame, schema: str, keep: Sequence[str] = ()) -> DataFrame:
    """Flatten JSON values to the declared columns; unknown fields are dropped.

    Text that does not fit the schema is kept in ``_corrupt_record``. The text
    is parsed once, in a generator: as a projection the optimizer would copy
    the parse into every later filter on the parsed columns.
    """
    parsed = F.from_json("value", f"{schema}, {CORRUPT} STRING", {"columnNameOfCorruptRecord": CORRUPT})
    return records.select(*keep, "value", F.inline(F.array(parsed)))


def _keyless(key: str) -> Column:
    return F.col(key).isNull() | (F.col(key) == "")


def accepted(decoded: DataFrame, key: str = "event_id") -> DataFrame:
    """Rows with a key, as stored."""
    return decoded.filter(~_keyless(key)).drop("value", CORRUPT)


def dead_letters(decoded: DataFrame, key: str = "event_id") -> DataFrame:
    """Messages that were lost or lost a field, with the reason."""
    broken = F.col(CORRUPT).isNotNull()
    reason = (
        F.when(_keyless(key) & broken, "undecodable")
        .when(_keyless(key), "missing key")
        .when(broken, "bad field")
    )
    return decoded.select(reason.alias("reason"), F.col(key).alias("message_key"), "value").filter(
        F.col("reason").isNotNull())
