"""Row selection shared by the reports: top-k lists, latest and first rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quakeloom.functions.numeric import as_col


def top(df: DataFrame, n: int | None, *order: Column) -> DataFrame:
    """Sorted, and cut to ``n`` rows when a report asks for that."""
    out = df.orderBy(*order)
    return out if n is None else out.limit(n)


def not_before(df: DataFrame, ts: str, edge: DataFrame) -> DataFrame:
    """Rows from the moment in the one-value frame ``edge`` on, undated rows included.

    The moment is known when the scan starts, so files and row groups that end
    before it are skipped where the table is roughly in time order.
    """
    return df.filter(F.col(ts).isNull() | (F.col(ts) >= edge.scalar()))


def newest(df: DataFrame, ts: str, n: int | None, *ties: Column) -> DataFrame:
    """The ``n`` newest rows. A first pass over the time column alone finds the
    moment of the last of them; whole rows are read from there on only."""
    order = [F.desc_nulls_last(ts), *ties]
    if n is None:
        return df.orderBy(*order)
    edge = df.select(ts).orderBy(F.desc_nulls_last(ts)).limit(n).agg(F.min(ts))
    return not_before(df, ts, edge).orderBy(*order).limit(n)


def ranked_first(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """One row per key. The rank limit is applied before the shuffle as well,
    so a key holding a third of the rows sends one row per task."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def latest_per_key(df: DataFrame, keys: Sequence[str], *order: Column | str) -> DataFrame:
    return ranked_first(df, keys, *[as_col(o).desc_nulls_last() for o in order])


def first_per_key(df: DataFrame, keys: Sequence[str], *order: Column | str) -> DataFrame:
    return ranked_first(df, keys, *[as_col(o).asc_nulls_last() for o in order])


def unseen(incoming: DataFrame, seen: DataFrame, keys: Sequence[str], *order: Column | str) -> DataFrame:
    """First arrival of every key that an earlier load has not delivered."""
    fresh = first_per_key(with_key(incoming, keys[0]), keys, *order)
    return fresh.join(seen.select(*keys), list(keys), "left_anti")


def with_key(df: DataFrame, key: str = "event_id") -> DataFrame:
    """Rows whose key is present: neither null nor empty."""
    return df.filter(F.col(key).isNotNull() & (F.col(key) != ""))


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).filter("rows > 1")


def existing(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns the frame has, in the wanted order."""
    return df.select(*[c for c in wanted if c in df.columns])


def of_types(df: DataFrame, types: Sequence[str] | None) -> DataFrame:
    """Only the listed types; no list means no filter."""
    return df.filter(F.col("type").isin(*types)) if types else df


def at_least(df: DataFrame, column: str, floor: float) -> DataFrame:
    """Rows whose value reaches the floor. The bare comparison goes down to the
    scan; NaN, which sorts above every number, is taken out after it."""
    return df.filter((F.col(column) >= floor) & ~F.isnan(column))


def since(df: DataFrame, ts: str, moment: str) -> DataFrame:
    return df.filter(F.col(ts) >= F.lit(moment).cast(df.schema[ts].dataType))


def last_days(df: DataFrame, ts: str, as_of: str, days: int) -> DataFrame:
    """Rows within ``days`` before ``as_of``."""
    moment = F.lit(as_of).cast(df.schema[ts].dataType) - F.expr(f"INTERVAL '{int(days)}' DAY")
    return df.filter(F.col(ts) >= moment)
