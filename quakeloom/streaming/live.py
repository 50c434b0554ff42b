"""Live results: daily cells, newest or first version per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType, TimestampNTZType, TimestampType

from quakeloom.functions import grid
from quakeloom.functions.numeric import is_known
from quakeloom.sources.tables import ORDER, Collection, writer_of


def daily_cells(quakes: DataFrame, size: float = 5.0, delay: str | None = None) -> DataFrame:
    """Events and largest magnitude per day and live cell.

    Without ``delay`` every day stays open and late events still count; state
    is one row per day and grid cell. With it, days older than the delay close.
    """
    rows = quakes.filter(is_known("latitude", "longitude", "magnitude") & F.col("ts").isNotNull())
    if delay:
        rows = rows.withWatermark("ts", delay)
    cells = grid.with_cell(rows, size, grid.LIVE)
    return cells.groupBy(F.window("ts", "1 day").alias("day"), *grid.CELL).agg(
        F.count("*").alias("event_count"), F.max("magnitude").alias("max_mag"),
    ).select(F.to_date("day.start").alias("day"), *grid.CELL, "event_count", "max_mag")


def without_repeats(rows: DataFrame, keys: list[str], delay: str, ts: str = "ts") -> DataFrame:
    """First arrivals of the keys, remembered in bounded state: a key is forgotten once the
    watermark (the latest time seen less ``delay``) passes its time by ``delay``.

    A repeat within that span is dropped, one beyond it passes as new, and a row older
    than the watermark is late and dropped. For repeats however late see :func:`keep_updated`
    with a collection of first arrivals, whose memory is the collection itself.
    """
    return rows.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def newest_in_state(rows: DataFrame, keys: list[str], order: str, delay: str, ts: str = "ts", groups: int = 2048) -> DataFrame:
    """Changes of the newest version of each key, which streaming state holds until the key has been quiet for ``delay``.

    A row a key whose newest version changed in a batch, with ``expired`` false; it has the columns of
    ``rows``. When the watermark (the latest ``ts`` less ``delay``) passes the time of a key's newest
    version, the key is forgotten: one last row with ``expired`` true. A version that comes later founds
    the key anew. Of versions of equal ``order`` the first one held stays. Rows older than the
    watermark are dropped: unlike stored versions (:func:`keep_updated`) state is bounded by what ``delay`` holds.

    A group of state holds the keys of one of ``groups`` hash values as a table, so that Python is called once a
    group and batch rather than once a key. Like the state's partitions their number is fixed by the checkpoint.
    """
    names = [c for c in rows.columns if c not in (*keys, ts)]
    types = rows.schema
    columns = [*keys, *names, "_ts"]
    plain = ", ".join(f"`{c}` {types[c].dataType.simpleString()}" for c in (*keys, *names))
    # pandas sees times without their zone
    bare = lambda t: TimestampNTZType() if isinstance(t, TimestampType) else t
    stored = to_arrow_schema(StructType([*[StructField(c, bare(types[c].dataType)) for c in (*keys, *names)],
                                         StructField("_ts", LongType()), StructField("_due", LongType())]))

    def follow(_, batches, state):
        import pandas as pd
        import pyarrow as pa

        now = state.getCurrentWatermarkMs()
        held = pa.ipc.open_stream(state.get[0]).read_pandas() if state.exists else stored.empty_table().to_pandas()
        new = [b[columns] for b in batches if len(b)]
        came = pd.concat(new, ignore_index=True) if new else held.iloc[:0][columns]
        # the newest first, of equal ones the first held: -1 marks rows that came in this batch
        every = pd.concat([x for x in (held, came.assign(_due=-1)) if len(x)] or [held], ignore_index=True)
        newest = every.sort_values(order, ascending=False, kind="stable").drop_duplicates(keys)
        changed = newest[newest["_due"] == -1]
        # a timer must lie after the watermark of its batch
        due = (changed["_ts"] // 1000).clip(lower=now) + 1
        rest = newest[newest["_due"] != -1]
        gone = rest["_due"] < now
        if len(changed) or gone.any():
            kept = pd.concat([x for x in (rest[~gone], changed.assign(_due=due)) if len(x)] or [rest.iloc[:0]], ignore_index=True)
            table = pa.Table.from_pandas(kept, schema=stored, preserve_index=False)
            if len(kept):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, stored) as out:
                    out.write_table(table)
                state.update((sink.getvalue().to_pybytes(),))
            elif state.exists:
                state.remove()
            if len(changed):
                yield changed[columns].assign(expired=False)
            if gone.any():
                yield rest[gone][columns].assign(expired=True)
        else:
            kept = rest
        if len(kept):
            state.setTimeoutTimestamp(max(int(kept["_due"].min()), now, 1))

    marked = rows.filter(F.col(ts).isNotNull() & F.col(order).isNotNull()).withWatermark(ts, delay).withColumns({
        "_ts": F.unix_micros(F.col(ts).cast("timestamp")), "_group": F.pmod(F.xxhash64(*keys), F.lit(groups)).cast("int")})
    changes = marked.groupBy("_group").applyInPandasWithState(
        follow, f"{plain}, _ts long, expired boolean", "held binary", "append", "EventTimeTimeout")
    return changes.withColumn(ts, F.timestamp_micros("_ts")).drop("_ts")


def keep_updated(changes: DataFrame, collection: Collection, checkpoint: str, available_now: bool = True,
                 mode: str = "update") -> StreamingQuery:
    """Upsert what every trigger yields: the changed groups of an aggregate, or
    with ``mode="append"`` plain rows, of which the collection keeps one per key.

    A collection made with ``first=True`` so drops repeated messages: each batch
    is thinned to one row per key without any state, and the stored first
    arrival stays, however late or often its copies come. No arrival is lost,
    and what has to be remembered is the collection itself.
    """
    writer = writer_of(collection.spark, checkpoint)

    def store(batch: DataFrame, batch_id: int) -> None:
        rows = batch if ORDER in batch.columns else batch.withColumn(ORDER, F.lit(batch_id).cast("long"))
        collection.upsert(rows, batch_id, writer)

    out = changes.writeStream.outputMode(mode).foreachBatch(store).option("checkpointLocation", checkpoint)
    out = out.trigger(availableNow=True) if available_now else out
    return out.start()
