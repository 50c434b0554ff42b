"""Calendar patterns, rates and the short magnitude forecast."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quakeloom.functions.numeric import exact_half_even, is_known, known, settled
from quakeloom.functions.text import weekday_name
from quakeloom.operators.baseline import only, span_days

RECENT_DAYS = 30


def _moment(df: DataFrame, as_of: str):
    return F.lit(as_of).cast(df.schema["ts"].dataType)


def calendar_counts(quakes: DataFrame, as_of: str, recent_days: int = RECENT_DAYS) -> DataFrame:
    """Sums per (year, month, weekday): every pattern below is a sum over these
    few rows, so the events are grouped once however many patterns are asked for."""
    rows = quakes.filter(is_known("magnitude") & F.col("ts").isNotNull())
    recent = F.col("ts") >= _moment(quakes, as_of) - F.expr(f"INTERVAL '{int(recent_days)}' DAY")
    return rows.groupBy(
        F.year("ts").alias("year"), F.month("ts").alias("month"), F.dayofweek("ts").alias("day_of_week")
    ).agg(
        F.count("*").alias("n"), F.sum("magnitude").alias("s"),
        F.count(F.when(recent, F.lit(1))).alias("recent_n"),
        F.sum(F.when(recent, F.col("magnitude"))).alias("recent_s"),
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"),
    )


def patterns(counts: DataFrame) -> DataFrame:
    """Monthly, year-by-month and weekday patterns as one frame, told apart by ``level``."""
    keys = ["year", "month", "day_of_week"]
    sets = counts.groupingSets(
        [[F.col("month")], [F.col("year"), F.col("month")], [F.col("day_of_week")]], *[F.col(k) for k in keys])
    grouped = sets.agg(
        F.grouping_id().alias("_gid"),
        F.sum("n").alias("count"),
        exact_half_even(settled(F.sum("s") / F.sum("n")), 3).alias("avg_mag"),
    )
    level = F.when(F.col("_gid") == 0b101, "month").when(F.col("_gid") == 0b001, "year_month").otherwise("day_of_week")
    return grouped.select(level.alias("level"), *keys, "count", "avg_mag").orderBy("level", *keys)


def monthly(counts: DataFrame) -> DataFrame:
    return patterns(counts).filter("level = 'month'").select("month", "count", "avg_mag")


def yearly_monthly(counts: DataFrame) -> DataFrame:
    return patterns(counts).filter("level = 'year_month'").select("year", "month", "count", "avg_mag")


def weekdays(counts: DataFrame) -> DataFrame:
    """Events per weekday with its name, Sunday first."""
    return (
        patterns(counts).filter("level = 'day_of_week'")
        .select("day_of_week", weekday_name("day_of_week").alias("day"), "count", "avg_mag")
        .orderBy("day_of_week")
    )


def rates(counts: DataFrame, recent_days: int = RECENT_DAYS) -> DataFrame:
    """One row: overall and recent daily rates and the recent mean magnitude."""
    totals = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_events"),
        span_days(F.min("first_ts"), F.max("last_ts")).alias("total_days"),
        F.coalesce(F.sum("recent_n"), F.lit(0)).alias("recent_n"),
        F.sum("recent_s").alias("recent_s"),
    )
    return totals.select(
        exact_half_even(F.col("total_events") / F.col("total_days"), 2).alias("daily_event_rate"),
        exact_half_even(F.col("recent_n") / F.lit(float(recent_days)), 2).alias("recent_daily_rate"),
        # unknown for an empty window, so that a forecast falls back on the days it has
        exact_half_even(settled(F.try_divide("recent_s", "recent_n")), 3).alias("recent_avg_magnitude"),
        "total_events", "total_days",
    )


def per_day(quakes: DataFrame) -> DataFrame:
    return quakes.filter(F.col("ts").isNotNull()).groupBy(F.to_date("ts").alias("date")).agg(
        F.count("*").alias("count"), F.avg(known("magnitude")).alias("avg_mag")).orderBy("date")


def daily_trend(quakes: DataFrame, since: str) -> DataFrame:
    """Events and mean magnitude per day from ``since`` on."""
    return per_day(quakes.filter(F.col("ts") >= _moment(quakes, since)))


def forecast_draws(days: int = 14, seed: int = 42) -> list[float]:
    """Standard normal draws of the forecast, fixed by the seed."""
    return [float(z) for z in np.random.RandomState(seed).standard_normal(days)]


def trend_forecast(trend: DataFrame, centre: DataFrame | None = None, days: int = 14, seed: int = 42,
                   tail: int = 7) -> DataFrame:
    """Next days' magnitude with a 95 % band.

    Spread is half the deviation of the last ``tail`` daily means. ``centre`` is
    a one-row frame with ``recent_avg_magnitude``; without it the mean of the
    same days is used.
    """
    last_days = trend.orderBy(F.desc("date")).limit(tail)
    base = last_days.agg(
        F.max("date").alias("last_date"), F.avg("avg_mag").alias("tail_mean"),
        (F.stddev_samp("avg_mag") * 0.5).alias("sigma"))
    middle = F.col("tail_mean")
    if centre is not None:
        middle = F.coalesce(only(centre, "recent_avg_magnitude"), middle)
    draws = F.array(*[F.lit(z) for z in forecast_draws(days, seed)])
    steps = base.select("last_date", "sigma", middle.alias("centre"), F.posexplode(draws).alias("step", "z"))
    value = F.col("centre") + F.col("sigma") * F.col("z")
    margin = 1.96 * F.col("sigma")
    return steps.select(
        F.date_add("last_date", F.col("step") + 1).alias("date"),
        value.alias("value"),
        F.greatest(F.lit(0.0), value - margin).alias("lower"),
        (value + margin).alias("upper"),
    ).orderBy("date")
