"""Report tables: key figures, feeds, counts, histograms and plot data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quakeloom.functions.numeric import is_known, known, scaled_half_even, settled
from quakeloom.functions.scoring import depth_category, severity_band
from quakeloom.functions.text import minute_text, shown, title_case
from quakeloom.operators.baseline import located
from quakeloom.operators.rows import at_least, existing, newest, of_types, top
from quakeloom.session import materialise


def recent_quakes(quakes: DataFrame, n: int | None = 500, floor: float = 0.0) -> DataFrame:
    return newest(at_least(quakes, "magnitude", floor), "ts", n, F.asc("event_id"))


def recent_events(events: DataFrame, n: int | None = 200, types: Sequence[str] | None = None) -> DataFrame:
    return newest(of_types(events, types), "last_ts", n, F.asc("event_id"))


def declarations_by_state(declarations: DataFrame, n: int | None = None) -> DataFrame:
    """Declarations and distinct incident types per state, a missing state included.

    Counted per (state, type) first: a state with most of the rows is reduced
    on the map side and only its few types are gathered.
    """
    per_type = declarations.groupBy("state", "incident_type").agg(F.count("*").alias("n"))
    types = F.transform(
        F.array_sort(F.collect_list(F.struct("incident_type"))), lambda t: t["incident_type"])
    return top(
        per_type.groupBy("state").agg(F.sum("n").alias("count"), types.alias("types")),
        n, F.desc("count"), F.asc_nulls_last("state"))


def value_counts(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """Rows per value, missing values dropped, most frequent first."""
    name = name or column
    rows = df.select(F.col(column).alias(name)).filter(F.col(name).isNotNull())
    return rows.groupBy(name).agg(F.count("*").alias("count")).orderBy(F.desc("count"), name)


def depth_categories(quakes: DataFrame) -> DataFrame:
    return value_counts(quakes.withColumn("category", depth_category()), "category")


def events_by_month_type(events: DataFrame) -> DataFrame:
    """Events per month and type; an unreadable date counts as month ``NaT``."""
    month = F.coalesce(F.date_format("last_ts", "yyyy-MM"), F.lit("NaT")).alias("month")
    rows = events.filter(F.col("type").isNotNull())
    return rows.groupBy(month, "type").agg(F.count("*").alias("count")).orderBy("month", "type")


def histogram(df: DataFrame, column: str, width: float, upper: float | None = None) -> DataFrame:
    """Counts per fixed-width bin; a value at ``upper`` falls into the last bin.

    Missing values count as 0 in a bin of their own, which is dropped at the
    end: a filter ahead of the grouping would repeat a computed column's work.
    """
    value = known(column)
    index = F.floor(value / F.lit(width))
    if upper is not None:
        last = int(round(upper / width)) - 1
        index = F.when(value == upper, F.lit(last).cast("long")).otherwise(index)
    counts = df.groupBy(index.alias("bin")).agg(F.count(value).alias("count")).filter("count > 0")
    return counts.select(
        "bin", (F.col("bin") * F.lit(width)).alias("lower"), ((F.col("bin") + 1) * F.lit(width)).alias("upper"),
        "count").orderBy("bin")


def _power(k: Column) -> Column:
    """10 to the power of ``|k|``, read from text: exact, unlike a product of tens."""
    return F.concat(F.lit("1e"), F.abs(k)).cast("double")


def _place(value: Column, step: Column) -> Column:
    """Number of the bin of width ``m * 10**k`` that the value falls into."""
    m, k = step["m"], step["k"]
    return F.floor(F.when(k >= 0, value / (m * _power(k))).otherwise(value * _power(k) / m))


def _edge(number: Column, step: Column) -> Column:
    m, k = step["m"], step["k"]
    return F.when(k >= 0, number * (m * _power(k))).otherwise(number * m / _power(k))


def nice_step(low: Column, high: Column, bins: int) -> Column:
    """(k, m): the least width ``m * 10**k``, m one of 1, 2 and 5, whose multiples cut the range into at most ``bins``.

    A range of one value has width 1.
    """
    rough = F.floor(F.log10((high - low) / F.lit(float(bins)))).cast("int")
    powers = F.transform(F.array(*[F.lit(d) for d in range(-1, 3)]), lambda d: rough + d)
    steps = F.flatten(F.transform(powers, lambda k: F.transform(
        F.array(F.lit(1.0), F.lit(2.0), F.lit(5.0)), lambda m: F.struct(k.alias("k"), m.alias("m")))))
    fits = F.filter(steps, lambda s: _place(high, s) - _place(low, s) < bins)
    return F.when(high > low, F.array_min(fits)).otherwise(F.struct(F.lit(0).alias("k"), F.lit(1.0).alias("m")))


def nice_histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Counts per bin between round edges, chosen from the data for at most ``bins`` (two or more); empty bins are left out.

    One pass counts values that agree in their first four digits, with the range of each such group,
    so what follows reads a small table: 18,000 groups for each power of ten at most. Groups that an
    edge cuts in two are counted again from their rows; that happens only where the range is
    narrow and far from zero. Missing and infinite values are left out; an empty table has no bins.
    """
    if bins < 2:
        raise ValueError("a range around zero needs two bins")
    value = known(F.col(column).cast("double"))
    rows = df.select(value.alias("v")).filter(F.abs("v") < float("inf"))
    power = F.floor(F.log10(F.abs("v"))).cast("int")
    scale = F.pow(F.lit(10.0), F.lit(3.0) - power)
    keyed = rows.withColumns({"power": F.coalesce(power, F.lit(-400)), "digits": F.coalesce(F.floor(F.col("v") * scale), F.lit(0))})
    fine = materialise(keyed.groupBy("power", "digits").agg(
        F.count("*").alias("count"), F.min("v").alias("low"), F.max("v").alias("high")), "fine-counts")
    ends = fine.agg(F.min("low").alias("low"), F.max("high").alias("high"))
    # one row; as a subquery it would be copied into every use of the step
    chosen = ends.select(nice_step(F.col("low"), F.col("high"), bins).alias("step")).first()["step"]
    step = F.struct(F.lit(chosen["k"]).alias("k"), F.lit(chosen["m"]).alias("m"))
    placed = fine.withColumn("step", step).withColumns({"bin": _place(F.col("low"), F.col("step")), "last": _place(F.col("high"), F.col("step"))})
    cut = placed.filter("bin <> last").select("power", "digits")
    counts = placed.filter("bin = last").select("bin", "count")
    if not cut.isEmpty():
        again = keyed.join(cut, ["power", "digits"], "left_semi").withColumn("step", step)
        counts = counts.unionByName(again.select(_place(F.col("v"), F.col("step")).alias("bin"), F.lit(1).cast("long").alias("count")))
    total = counts.groupBy("bin").agg(F.sum("count").alias("count")).withColumn("step", step)
    return total.select("bin", _edge(F.col("bin"), F.col("step")).alias("lower"), _edge(F.col("bin") + 1, F.col("step")).alias("upper"), "count").orderBy("bin")


def key_figures(quakes: DataFrame, events: DataFrame, states: DataFrame) -> DataFrame:
    """One row of headline figures; empty tables give zeros."""
    magnitude = known("magnitude")
    risky = F.count_if(F.col("risk_score") >= 70) if "risk_score" in quakes.columns else F.lit(0).cast("long")
    waves = F.sum("tsunami") if "tsunami" in quakes.columns else F.lit(0)
    quake_side = quakes.agg(
        F.coalesce(scaled_half_even(settled(F.avg(magnitude)), 2), F.lit(0.0)).alias("avg_mag"),
        F.coalesce(scaled_half_even(F.max(magnitude), 1), F.lit(0.0)).alias("max_mag"),
        F.count_if(magnitude >= 6.0).alias("critical_quakes"),
        F.coalesce(waves, F.lit(0)).cast("long").alias("tsunami_warnings"),
        risky.alias("high_risk"),
        F.count("*").alias("quakes"),
    )
    total = F.count("*")
    return quake_side.withColumns({
        "active_events": events.agg(total).scalar(),
        "states": states.agg(total).scalar(),
    })


def alert_feed(quakes: DataFrame, events: DataFrame, n_quakes: int = 20, n_events: int = 10) -> DataFrame:
    """Strong earthquakes, then the newest natural events, in display order."""
    strong = top(at_least(quakes, "magnitude", 5.0), n_quakes, F.desc("magnitude"), F.asc("event_id"))
    first = strong.select(
        F.lit(1).alias("source_rank"), severity_band("magnitude", 5.0).alias("severity"),
        F.concat(F.lit("M "), F.col("magnitude").cast("string")).alias("badge"),
        F.coalesce("risk_score", F.lit(0.0)).alias("risk"),
        F.substring(shown("place"), 1, 36).alias("title"), minute_text("ts").alias("at"),
        F.col("magnitude").alias("_mag"), F.col("ts").alias("_ts"), F.col("event_id").alias("_id"))
    second = newest(events, "last_ts", n_events, F.asc("event_id")).select(
        F.lit(2).alias("source_rank"), F.lit("yellow").alias("severity"),
        title_case(shown("type")).alias("badge"), F.lit(None).cast("double").alias("risk"),
        F.substring(shown("title"), 1, 36).alias("title"), minute_text("last_ts").alias("at"),
        F.lit(None).cast("double").alias("_mag"), F.col("last_ts").alias("_ts"), F.col("event_id").alias("_id"))
    return (
        first.unionByName(second)
        .orderBy("source_rank", F.desc_nulls_last("_mag"),
                 F.when(F.col("source_rank") == 2, F.col("_ts")).desc_nulls_last(), "_id")
        .drop("_mag", "_ts", "_id")
    )


HIGH_RISK_COLUMNS = ["event_id", "ts", "place", "magnitude", "depth_km", "alert", "tsunami", "risk_score",
                     "risk_tier", "tsunami_prob"]
TSUNAMI_COLUMNS = ["event_id", "place", "magnitude", "depth_km", "tsunami_prob", "risk_score", "risk_tier"]


def high_risk_table(quakes: DataFrame, n: int = 25) -> DataFrame:
    order = "risk_score" if "risk_score" in quakes.columns else "magnitude"
    strong = existing(at_least(quakes, "magnitude", 5.5), HIGH_RISK_COLUMNS)
    return top(strong, n, F.desc_nulls_last(order), F.asc("event_id"))


def tsunami_probabilities(quakes: DataFrame, n: int = 15) -> DataFrame:
    likely = existing(at_least(quakes, "tsunami_prob", 0.10), TSUNAMI_COLUMNS)
    return top(likely, n, F.desc("tsunami_prob"), F.asc("event_id"))


def map_layer(quakes: DataFrame, events: DataFrame, anomalies: DataFrame) -> DataFrame:
    """Every located event and every anomaly as one map row."""
    score = F.col("risk_score") if "risk_score" in quakes.columns else F.lit(0.0)
    tier = F.col("risk_tier") if "risk_tier" in quakes.columns else F.lit("")
    quake_rows = located(quakes).select(
        F.lit("earthquake").alias("layer"), "event_id", F.col("latitude").alias("lat"),
        F.col("longitude").alias("lon"), severity_band().alias("band"),
        F.coalesce(score, F.lit(0.0)).alias("score"), F.coalesce(tier, F.lit("")).alias("label"))
    event_rows = located(events).select(
        F.lit("natural_event").alias("layer"), "event_id", F.col("latitude").alias("lat"),
        F.col("longitude").alias("lon"), F.lit("").alias("band"), F.lit(0.0).alias("score"),
        title_case(F.coalesce("type", F.lit("unknown"))).alias("label"))
    anomaly_rows = anomalies.select(
        F.lit("anomaly").alias("layer"), F.lit(None).cast("string").alias("event_id"), "lat", "lon",
        F.when(F.col("severity") == "HIGH", "red").otherwise("orange").alias("band"), F.lit(0.0).alias("score"),
        F.col("description").alias("label"))
    return quake_rows.unionByName(event_rows).unionByName(anomaly_rows)


def depth_scatter(quakes: DataFrame) -> DataFrame:
    return quakes.filter(is_known("depth_km", "magnitude")).select(
        "event_id", "depth_km", "magnitude", depth_category().alias("depth_category"))


def risk_scatter(quakes: DataFrame) -> DataFrame:
    return quakes.filter(is_known("magnitude") & F.col("risk_score").isNotNull()).select(
        "event_id", "magnitude", "risk_score", "risk_tier")
