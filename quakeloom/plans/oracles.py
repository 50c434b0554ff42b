"""SQL for another engine (DuckDB) that answers each query independently.

The SQL states the rules in its own way: plain range joins instead of grid
candidates, ``printf`` for decimal rounding, window functions for versions.
"""

from __future__ import annotations

from quakeloom.operators.seasonal import forecast_draws
from quakeloom.plans import catalog as c
from quakeloom.sources import adapters

ORACLES: dict[str, str] = {}


def _exact(x: str, digits: int) -> str:
    """Decimal rounding of the exact binary value, ties to even."""
    return f"(CAST(printf('%.{digits}f', {x}) AS DOUBLE) + 0e0)"


def _mean(x: str, digits: int) -> str:
    """The same for a mean or deviation, first cut to nine decimals."""
    return _exact(f"round({x}, 9)", digits)


def _scaled(x: str, digits: int) -> str:
    factor = f"{10 ** digits}e0"
    return f"(round_even(({x}) * {factor}, 0) / {factor} + 0e0)"


def _live(x: str, size: int = 5) -> str:
    return f"(round_even({x} / {size}e0, 0) * {size}e0 + 0e0)"


def _batch(x: str, size: int = 5) -> str:
    return f"(round({x} / {size}e0, 0) * {size}e0 + 0e0)"


def _iso(ms: str) -> str:
    return (f"strftime(epoch_ms({ms}), '%Y-%m-%dT%H:%M:%S') || CASE WHEN {ms} % 1000 = 0 THEN '' "
            f"ELSE '.' || lpad(CAST({ms} % 1000 AS VARCHAR), 3, '0') || '000' END || '+00:00'")


def _ms(ts: str) -> str:
    return f"(epoch_us({ts}) // 1000)"


def _text(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S.%f')"


SCORE = """CASE WHEN magnitude IS NULL THEN 0e0 ELSE """ + _exact("""least(least(magnitude * 10, 60e0)
    + CASE WHEN tsunami <> 0 THEN 20 ELSE 0 END
    + CASE alert WHEN 'red' THEN 20 WHEN 'orange' THEN 15 WHEN 'yellow' THEN 10 WHEN 'green' THEN 5 ELSE 0 END
    + CASE WHEN depth_km <> 0 AND depth_km < 70 THEN 5 ELSE 0 END, 100e0)""", 2) + " END"
TIER = "CASE WHEN {0} >= 90 THEN 'Critical' WHEN {0} >= 70 THEN 'High' WHEN {0} >= 40 THEN 'Moderate' ELSE 'Low' END"
REGION = """CASE WHEN place IS NULL THEN 'Unknown' ELSE trim(list_extract(string_split(place, ','), -1)) END"""
SHALLOW, MIDDLE, DEEP = "Shallow (<70 km)", "Intermediate (70-300 km)", "Deep (>300 km)"
DEPTH = (f"CASE WHEN depth_km > 0 AND depth_km <= 70 THEN '{SHALLOW}' WHEN depth_km > 70 AND depth_km <= 300 "
         f"THEN '{MIDDLE}' WHEN depth_km > 300 AND depth_km <= 9999 THEN '{DEEP}' END")

_FEATURES = ["eq_count", "avg_mag", "max_mag", "avg_depth", "mag_variability", "grid_lat", "grid_lon"]
_DISTANCE = "(" + " + ".join(f"(s.z{i} - x.c{i}) * (s.z{i} - x.c{i})" for i in range(7)) + ")"

_PARTS = {
    "quakes": adapters.QUAKES,
    "eonet": adapters.NATURAL_EVENTS,
    "fema": adapters.DECLARATIONS,
    "arch": adapters.ARCHIVE,
    "scored0": f"SELECT *, {SCORE} AS risk_score FROM quakes",
    "scored": f"SELECT *, {TIER.format('risk_score')} AS risk_tier FROM scored0",
    "located": f"SELECT *, {_live('latitude')} AS grid_lat, {_live('longitude')} AS grid_lon FROM quakes "
               "WHERE latitude IS NOT NULL AND longitude IS NOT NULL",
    "history": f"SELECT *, {_batch('latitude')} AS grid_lat, {_batch('longitude')} AS grid_lon FROM quakes "
               "WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND magnitude IS NOT NULL",
    "cells": "SELECT grid_lat, grid_lon, count(*) AS event_count, avg(magnitude) AS avg_mag, max(magnitude) AS max_mag, "
             "coalesce(stddev_samp(magnitude), 0e0) AS std_mag FROM history GROUP BY 1, 2",
    "span": "SELECT greatest(coalesce(datediff('day', min(ts), max(ts)), 1), 1) AS days FROM history",
    "totals": "SELECT avg(event_count) AS mean, stddev_samp(event_count) AS std, count(*) AS n, "
              "(SELECT days FROM span) AS days FROM cells",
    "limits": f"SELECT {_mean('mean', 2)} AS global_mean_count, {_mean('std', 2)} AS global_std_count, "
              f"{_mean('mean / days', 6)} AS global_daily_rate, 3e0 AS spike_multiplier, "
              f"{_mean('mean + 2 * std', 2)} AS threshold_moderate, {_mean('mean + 3 * std', 2)} AS threshold_high, "
              "n AS total_cells, CAST(days AS INT) AS historical_span_days FROM totals",
    "baselines": "SELECT grid_lat, grid_lon, event_count AS historical_count, "
                 f"{_exact('event_count / CAST((SELECT days FROM span) AS DOUBLE)', 6)} AS daily_rate, "
                 f"{_mean('avg_mag', 3)} AS avg_mag, {_exact('max_mag', 2)} AS max_mag, {_mean('std_mag', 3)} AS std_mag "
                 "FROM cells",
    "live": "SELECT grid_lat, grid_lon, count(magnitude) AS event_count, max(magnitude) AS max_mag, "
            "arg_max(coalesce(place, 'None'), (ts, event_id)) AS top_place FROM located GROUP BY 1, 2",
    "near": "SELECT l.grid_lat, l.grid_lon, e.type, count(*) AS n, max(e.last_ts) AS newest FROM live l JOIN eonet e "
            "ON e.latitude BETWEEN l.grid_lat - 5 AND l.grid_lat + 5 AND e.longitude BETWEEN l.grid_lon - 5 AND l.grid_lon + 5 "
            "GROUP BY 1, 2, 3",
    "nearby": "SELECT grid_lat, grid_lon, CAST(sum(n) AS BIGINT) AS nearby, "
              "string_agg(type, ', ' ORDER BY newest DESC, type DESC) AS by_time, "
              "string_agg(type, ', ' ORDER BY type) AS by_name FROM near GROUP BY 1, 2",
    "crowded": "SELECT l.*, coalesce(n.nearby, 0) AS nearby, n.by_time FROM live l LEFT JOIN nearby n USING (grid_lat, grid_lon) "
               "WHERE event_count > (SELECT threshold_moderate FROM limits)",
    "found": "SELECT CASE WHEN max_mag >= 6 OR nearby > 0 THEN 'HIGH' ELSE 'MODERATE' END AS severity, "
             "CAST(event_count AS VARCHAR) || ' earthquakes (max M' || printf('%.1f', max_mag) || ') near ' || top_place || "
             "CASE WHEN nearby > 0 THEN ' + ' || CAST(nearby AS VARCHAR) || ' ' || by_time || ' event(s) — MULTI-TYPE CLUSTER' "
             "ELSE '' END AS description, grid_lat AS lat, grid_lon AS lon, event_count AS eq_count, nearby AS eonet_count, "
             "nearby > 0 AS multi_type, max_mag FROM crowded",
    "flagged": "SELECT CASE WHEN max(magnitude) >= 6 THEN 'HIGH' ELSE 'MODERATE' END AS severity, "
               "CAST(count(*) AS VARCHAR) || ' flagged events (max M' || printf('%.1f', max(magnitude)) || ') near ' || "
               "arg_max(coalesce(place, 'None'), (ts, event_id)) AS description, grid_lat AS lat, grid_lon AS lon, "
               "count(*) AS eq_count, CAST(0 AS BIGINT) AS eonet_count, false AS multi_type, max(magnitude) AS max_mag "
               "FROM located WHERE anomaly_flag GROUP BY grid_lat, grid_lon",
    "corr": "SELECT * FROM (SELECT grid_lat, grid_lon, count(magnitude) AS eq_count, max(magnitude) AS max_mag FROM located "
            "GROUP BY 1, 2) JOIN (SELECT " + _live("latitude") + " AS grid_lat, " + _live("longitude") + " AS grid_lon, "
            "count(type) AS eonet_count, array_to_string(list_sort(list(DISTINCT type)), ', ') AS event_types FROM eonet "
            "WHERE latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY 1, 2) USING (grid_lat, grid_lon)",
    "regions": f"SELECT *, CASE WHEN max_mag >= 6 THEN 'Critical Seismic Zone' WHEN avg_mag >= 4.5e0 THEN "
               "'High Seismic Activity' WHEN eq_count >= 10 THEN 'Frequent Activity' ELSE 'Low Activity' END AS profile FROM "
               f"(SELECT {REGION} AS region, count(magnitude) AS eq_count, {_scaled('round(avg(magnitude), 9)', 2)} AS avg_mag, "
               f"max(magnitude) AS max_mag, {_scaled('round(avg(risk_score), 9)', 1)} AS avg_risk FROM scored "
               "WHERE latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY 1)",
    "trend": f"SELECT CAST(ts AS DATE) AS date, count(*) AS count, avg(magnitude) AS avg_mag FROM quakes "
             f"WHERE ts >= TIMESTAMP '{c.TREND_SINCE}' GROUP BY 1",
    "hist": f"SELECT * FROM arch WHERE ts >= TIMESTAMP '{c.TRAINING_START}'",
    "grid10": f"SELECT {_batch('latitude', 10)} AS grid_lat, {_batch('longitude', 10)} AS grid_lon, count(*) AS eq_count, "
              "avg(magnitude) AS avg_mag, max(magnitude) AS max_mag, avg(coalesce(depth_km, 33e0)) AS avg_depth, "
              "coalesce(stddev_samp(magnitude), 0e0) AS mag_variability FROM hist GROUP BY 1, 2",
    # k-means for k = 3 to 8 by recursion: 40 steps, of which those after the last move change nothing
    "spots": "SELECT *, row_number() OVER (ORDER BY eq_count, grid_lat, grid_lon) - 1 AS number, " + ", ".join(
        f"round(coalesce(({n} - avg({n}) OVER ()) / nullif(stddev_samp({n}) OVER (), 0), 0e0), 9) AS z{i}" for i, n in enumerate(_FEATURES)) + " FROM grid10",
    "lloyd": f"""SELECT 0 AS step, CAST(k AS INT) AS k, CAST(i AS INT) AS cluster_id, {', '.join(f'z{i} AS c{i}' for i in range(7))}
        FROM (SELECT unnest([3, 4, 5, 6, 7, 8]) AS k) JOIN (SELECT unnest(range(8)) AS i) ON i < k
        JOIN spots ON number = ((2 * i + 1) * (SELECT count(*) FROM spots)) // (2 * k)
        UNION ALL SELECT l.step + 1, l.k, l.cluster_id, {', '.join(f'coalesce(m.z{i}, l.c{i})' for i in range(7))} FROM lloyd l LEFT JOIN
        (SELECT k, cluster_id, {', '.join(f'round(avg(z{i}), 9) AS z{i}' for i in range(7))} FROM (SELECT x.k, x.cluster_id, s.*, row_number() OVER
        (PARTITION BY x.k, s.number ORDER BY {_DISTANCE}, x.cluster_id) AS place FROM lloyd x CROSS JOIN spots s) WHERE place = 1 GROUP BY k, cluster_id) m
        ON m.k = l.k AND m.cluster_id = l.cluster_id WHERE l.step < 40""",
    "placed": f"""SELECT * FROM (SELECT x.k, x.cluster_id, s.*, {_DISTANCE} AS distance, row_number() OVER (PARTITION BY x.k, s.number
        ORDER BY {_DISTANCE}, x.cluster_id) AS place FROM lloyd x CROSS JOIN spots s WHERE x.step = 40) WHERE place = 1""",
    "costs": "SELECT *, lag(wssse) OVER (ORDER BY k) - wssse AS d FROM (SELECT k, round(sum(distance), 9) AS wssse FROM placed GROUP BY k)",
    "bestk": "SELECT * FROM placed WHERE k = coalesce((SELECT arg_max(k, (d, -k)) FROM costs WHERE d > 0), 5)",
    "newest": "SELECT *, row_number() OVER (PARTITION BY event_id, county ORDER BY seq DESC) AS rn FROM fema",
    "msg": "SELECT *, CAST(event_id AS BIGINT) % 50 = 3 AS broken, CAST(event_id AS BIGINT) % 50 <> 3 AND "
           "CAST(event_id AS BIGINT) % 70 = 5 AND magnitude IS NOT NULL AS bad, CAST(event_id AS BIGINT) % 50 <> 3 AND "
           "CAST(event_id AS BIGINT) % 70 <> 5 AND CAST(event_id AS BIGINT) % 90 = 7 AS keyless, epoch_us(ts) // 1000 AS ms FROM quakes",
    "letters": "SELECT CASE WHEN broken THEN 'undecodable' WHEN keyless THEN 'missing key' ELSE 'bad field' END AS reason, "
               "CASE WHEN bad THEN event_id END AS message_key, CASE WHEN broken THEN 'not json ' || event_id END AS value "
               "FROM msg WHERE broken OR keyless OR bad",
    "parsed_events": "SELECT *, CAST(substr(event_id, 7) AS BIGINT) AS num FROM eonet",
    "sampled": "SELECT * FROM quakes WHERE magnitude >= 5 OR (magnitude >= 4 AND magnitude < 5 AND u < 0.30e0) OR "
               "(magnitude < 4 AND u < 0.05e0)",
}
_PARTS["quakes_u"] = ("SELECT *, CAST(('0x' || substr(md5(event_id), 1, 8)) AS BIGINT) / 4294967296e0 AS u, "
                      "CAST(('0x' || substr(md5('split:' || event_id), 1, 8)) AS BIGINT) / 4294967296e0 AS v FROM quakes")
_PARTS["sampled"] = _PARTS["sampled"].replace("FROM quakes", "FROM quakes_u")


def _needs(sql: str) -> set[str]:
    words = {w.strip("(),") for w in sql.replace("\n", " ").split(" ")}
    return {name for name in _PARTS if name in words}


def _add(name: str, sql: str) -> None:
    """Register ``sql`` with the parts it mentions, in dependency order."""
    ordered: list[str] = []

    def visit(text: str, path: tuple[str, ...]) -> None:
        for part in sorted(_needs(text)):
            if part not in ordered and part not in path:
                visit(_PARTS[part], (*path, part))
                if part not in ordered:
                    ordered.append(part)

    visit(sql, ())
    ctes = ", ".join(f"{p} AS ({_PARTS[p].strip()})" for p in ordered)
    ORACLES[name] = f"WITH {'RECURSIVE ' * ('lloyd' in ordered)}{ctes} {sql}" if ctes else sql


# Scoring
_add("risk_scored", "SELECT event_id, risk_score, risk_tier FROM scored")
_add("tier_counts", "SELECT risk_tier AS tier, count(*) AS count FROM scored GROUP BY 1")

# Baselines and anomalies
_add("cell_baseline", "SELECT * FROM baselines")
_add("baseline_thresholds", "SELECT * FROM limits")
_add("cell_statistics", f"SELECT grid_lat, grid_lon, event_count, {_mean('avg_mag', 6)} AS avg_mag, max_mag, "
     f"{_mean('std_mag', 6)} AS std_mag FROM cells")
_add("live_cells", "SELECT grid_lat, grid_lon, event_count, max_mag FROM live")
_add("cell_places", "SELECT grid_lat, grid_lon, top_place FROM live")
_add("nearby_events_range", "SELECT l.grid_lat, l.grid_lon, l.event_count, coalesce(n.nearby, 0) AS nearby, "
     "coalesce(n.by_name, '') AS types FROM live l LEFT JOIN nearby n USING (grid_lat, grid_lon)")
for _name in ("anomalies_threshold", "anomalies_saved_thresholds"):
    _add(_name, "SELECT * FROM found")
for _name in ("anomalies_flagged", "anomalies"):
    _add(_name, "SELECT * FROM flagged")
_add("headline_anomaly", "SELECT * FROM found ORDER BY multi_type DESC, max_mag DESC, lat, lon LIMIT 1")
_add("rate_spikes", f"""SELECT * FROM (SELECT w.grid_lat, w.grid_lon, w.window_count, w.window_max_mag,
    {_exact(f'w.window_count / {c.SPIKE_DAYS}e0', 6)} AS window_rate,
    coalesce(b.daily_rate, (SELECT global_daily_rate FROM limits)) AS baseline_rate
    FROM (SELECT grid_lat, grid_lon, count(*) AS window_count, max(magnitude) AS window_max_mag FROM history
          WHERE ts >= TIMESTAMP '{c.SPIKE_FROM}' GROUP BY 1, 2) w LEFT JOIN baselines b USING (grid_lat, grid_lon))
    WHERE window_count / {c.SPIKE_DAYS}e0 > 3e0 * baseline_rate""")
_add("hazard_correlation", "SELECT * FROM corr")
_add("hazard_correlation_top", "SELECT * FROM corr ORDER BY eq_count DESC, grid_lat, grid_lon LIMIT 15")

# Regions
_add("regional_risk", "SELECT * FROM regions")
_add("regional_leaderboard", "SELECT * FROM regions ORDER BY avg_risk DESC, region LIMIT 20")
_add("top_regions", f"SELECT {REGION} AS region, count(magnitude) AS count, {_scaled('round(avg(magnitude), 9)', 2)} AS avg_mag "
     "FROM quakes GROUP BY 1 ORDER BY count DESC, region LIMIT 15")

# Reports
_add("kpis", f"""SELECT coalesce({_scaled('round(avg(magnitude), 9)', 2)}, 0e0) AS avg_mag,
    coalesce({_scaled('max(magnitude)', 1)}, 0e0) AS max_mag, count(*) FILTER (magnitude >= 6) AS critical_quakes,
    CAST(coalesce(sum(tsunami), 0) AS BIGINT) AS tsunami_warnings, count(*) FILTER (risk_score >= 70) AS high_risk,
    count(*) AS quakes, (SELECT count(*) FROM eonet ) AS active_events,
    (SELECT count(*) FROM (SELECT DISTINCT state FROM fema )) AS states FROM scored""")
_add("alert_feed", """SELECT * FROM (SELECT 1 AS source_rank, CASE WHEN magnitude >= 6 THEN 'red' ELSE 'orange' END AS severity,
    'M ' || CAST(magnitude AS VARCHAR) AS badge, risk_score AS risk, substr(coalesce(place, 'None'), 1, 36) AS title,
    strftime(ts, '%Y-%m-%dT%H:%M') AS at FROM scored WHERE magnitude >= 5 ORDER BY magnitude DESC, event_id LIMIT 20)
    UNION ALL SELECT * FROM (SELECT 2 AS source_rank, 'yellow' AS severity, upper(type[1]) || substr(type, 2) AS badge,
    CAST(NULL AS DOUBLE) AS risk, substr(title, 1, 36) AS title, strftime(last_ts, '%Y-%m-%dT%H:%M') AS at
    FROM eonet ORDER BY last_ts DESC, event_id LIMIT 10)""")
_add("high_risk_table", f"""SELECT CAST(row_number() OVER (ORDER BY risk_score DESC, event_id) AS INT) AS rank, event_id, {_text('ts')} AS ts, place, magnitude, depth_km, alert, tsunami, risk_score, risk_tier,
    tsunami_prob FROM scored s WHERE magnitude >= 5.5e0 ORDER BY risk_score DESC, event_id LIMIT 25""")
_add("recent_quakes", f"SELECT CAST(row_number() OVER (ORDER BY q.ts DESC, event_id) AS INT) AS rank, event_id, magnitude, place, {_text('q.ts')} AS ts FROM quakes q WHERE magnitude >= 2.5e0 "
     "ORDER BY q.ts DESC, event_id LIMIT 500")
_add("recent_events", f"SELECT CAST(row_number() OVER (ORDER BY e.last_ts DESC, event_id) AS INT) AS rank, event_id, type, title, {_text('e.last_ts')} AS last_ts FROM eonet e "
     "WHERE type IN ('wildfire', 'storm') ORDER BY e.last_ts DESC, event_id LIMIT 200")
_add("tsunami_prob_top", "SELECT CAST(row_number() OVER (ORDER BY tsunami_prob DESC, event_id) AS INT) AS rank, event_id, place, magnitude, depth_km, tsunami_prob, risk_score, risk_tier FROM scored "
     "WHERE tsunami_prob >= 0.10e0 ORDER BY tsunami_prob DESC, event_id LIMIT 15")
_add("declarations_by_state", "SELECT state, count(*) AS count, array_to_string(list_sort(list(DISTINCT incident_type)), '|') "
     "AS types FROM fema GROUP BY state")
_add("top_states", "SELECT state, count(*) AS count, CAST(row_number() OVER (ORDER BY count(*) DESC, state NULLS LAST) AS INT) AS rank "
     "FROM fema GROUP BY state ORDER BY count DESC, state NULLS LAST LIMIT 20")
_add("daily_trend", f"SELECT CAST(date AS VARCHAR) AS date, count, {_mean('avg_mag', 6)} AS avg_mag FROM trend")
_add("events_by_month_type", "SELECT coalesce(strftime(last_ts, '%Y-%m'), 'NaT') AS month, type, count(*) AS count FROM eonet "
     "WHERE type IS NOT NULL GROUP BY 1, 2")
_add("depth_categories", f"SELECT {DEPTH} AS category, count(*) AS count FROM quakes WHERE {DEPTH} IS NOT NULL GROUP BY 1")
_add("type_counts", "SELECT type, count(*) AS count FROM eonet GROUP BY 1")
_nice = " UNION ALL ".join(f"SELECT '{x}' AS name, {n} AS bins, {v} AS v FROM {t} WHERE {v} IS NOT NULL" for x, n, v, t in [
    *((x, n, "magnitude / 100 + 1000000" if x == "far_magnitude" else x, "scored") for x, n in c.NICE_BINS.items()),
    ("price", 15, "CAST(l_extendedprice AS DOUBLE)", "lineitem")])
_PARTS["charted"] = _nice
_number = "CAST(floor(CASE WHEN k >= 0 THEN {0} / (m * p) ELSE {0} * p / m END) AS BIGINT)"
_PARTS["steps"] = "SELECT k, m, CAST('1e' || abs(k) AS DOUBLE) AS p FROM (SELECT unnest(generate_series(-9, 9)) AS k), (SELECT unnest([1e0, 2e0, 5e0]) AS m)"
_PARTS["chosen"] = f"""SELECT name, min({{'k': k, 'm': m, 'p': p}}) AS s FROM (SELECT name, bins, min(v) AS low, max(v) AS high FROM charted GROUP BY 1, 2), steps
    WHERE {_number.format('high')} - {_number.format('low')} < bins GROUP BY 1"""
_add("nice_histograms", f"""SELECT name, bin, count(*) AS count, {_exact('CASE WHEN k >= 0 THEN bin * (m * p) ELSE bin * m / p END', 6)} AS lower,
    {_exact('CASE WHEN k >= 0 THEN (bin + 1) * (m * p) ELSE (bin + 1) * m / p END', 6)} AS upper
    FROM (SELECT name, s.k AS k, s.m AS m, s.p AS p, {_number.replace('k >=', 's.k >=').replace('(m * p)', '(s.m * s.p)').replace('* p / m', '* s.p / s.m').format('v')} AS bin
    FROM charted JOIN chosen USING (name)) GROUP BY name, bin, k, m, p""")
_add("mag_histogram", "SELECT bin, bin * 0.5e0 AS lower, (bin + 1) * 0.5e0 AS upper, count FROM (SELECT CAST(floor(magnitude / "
     "0.5e0) AS BIGINT) AS bin, count(*) AS count FROM quakes WHERE magnitude IS NOT NULL GROUP BY 1)")
_add("risk_histogram", "SELECT bin, bin * 2.5e0 AS lower, (bin + 1) * 2.5e0 AS upper, count FROM (SELECT CASE WHEN risk_score = "
     "100 THEN 39 ELSE CAST(floor(risk_score / 2.5e0) AS BIGINT) END AS bin, count(*) AS count FROM scored GROUP BY 1)")
_add("map_layer", """SELECT 'earthquake' AS layer, event_id, latitude AS lat, longitude AS lon,
    CASE WHEN magnitude >= 6 THEN 'red' WHEN magnitude >= 4 THEN 'orange' ELSE 'yellow' END AS band,
    risk_score AS score, risk_tier AS label FROM scored WHERE latitude IS NOT NULL AND longitude IS NOT NULL
    UNION ALL SELECT 'natural_event', event_id, latitude, longitude, '', 0e0, upper(type[1]) || substr(type, 2) FROM eonet
    WHERE latitude IS NOT NULL AND longitude IS NOT NULL
    UNION ALL SELECT 'anomaly', NULL, lat, lon, CASE WHEN severity = 'HIGH' THEN 'red' ELSE 'orange' END, 0e0, description
    FROM found""")
_add("depth_scatter", f"SELECT event_id, depth_km, magnitude, {DEPTH} AS depth_category FROM quakes "
     "WHERE depth_km IS NOT NULL AND magnitude IS NOT NULL")
_add("risk_scatter", "SELECT event_id, magnitude, risk_score, risk_tier FROM scored WHERE magnitude IS NOT NULL")

_add("flat_export", f"""SELECT event_id, magnitude, place, {_text('s.ts')} AS ts, longitude, latitude, depth_km, tsunami, alert,
    risk_score, risk_tier, anomaly_flag, tsunami_prob FROM scored s""")

_add("event_export", f"SELECT event_id, type, title, longitude, latitude, {_text('e.last_ts')} AS last_ts FROM eonet e")
_add("state_export", "SELECT state, count(*) AS count, '[' || coalesce(array_to_string(list_sort(list(DISTINCT '\"' || incident_type || '\"')), ','), '') "
     "|| ']' AS types FROM fema GROUP BY state")

# Seasons
_avg3 = _mean("sum(magnitude) / count(*)", 3)
_add("seasonal_pattern", f"""SELECT 'month' AS level, CAST(NULL AS INT) AS year, CAST(month(ts) AS INT) AS month,
    CAST(NULL AS INT) AS day_of_week, count(*) AS count, {_avg3} AS avg_mag FROM hist GROUP BY month(ts)
    UNION ALL SELECT 'year_month', CAST(year(ts) AS INT), CAST(month(ts) AS INT), NULL, count(*), {_avg3} FROM hist
    GROUP BY year(ts), month(ts)
    UNION ALL SELECT 'day_of_week', NULL, NULL, CAST(dayofweek(ts) + 1 AS INT), count(*), {_avg3} FROM hist
    GROUP BY dayofweek(ts)""")


def _rates(table: str, as_of: str) -> str:
    recent = f"ts >= TIMESTAMP '{as_of}' - INTERVAL 30 DAY"
    days = "greatest(coalesce(datediff('day', min(ts), max(ts)), 1), 1)"
    return (f"SELECT {_exact(f'count(*) / CAST({days} AS DOUBLE)', 2)} AS daily_event_rate, "
            f"{_exact(f'count(*) FILTER ({recent}) / 30e0', 2)} AS recent_daily_rate, "
            f"coalesce({_mean(f'avg(magnitude) FILTER ({recent})', 3)}, 0e0) AS recent_avg_magnitude, "
            f"count(*) AS total_events, CAST({days} AS INT) AS total_days FROM {table} WHERE magnitude IS NOT NULL")


_add("seasonal_rates", _rates("hist", "2001-08-01"))
_add("weekday_pattern", "SELECT ['Sun', 'Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat'][dayofweek(ts) + 1] AS day, count(*) AS count "
     "FROM hist GROUP BY 1")
_draws = ", ".join(f"({i}, {z!r}::DOUBLE)" for i, z in enumerate(forecast_draws()))
_add("trend_forecast", f"""SELECT CAST(CAST(last_date + INTERVAL 1 DAY * (step + 1) AS DATE) AS VARCHAR) AS date,
    {_mean('centre + sigma * z', 6)} AS value, {_mean('greatest(0e0, centre + sigma * z - 1.96e0 * sigma)', 6)} AS lower,
    {_mean('centre + sigma * z + 1.96e0 * sigma', 6)} AS upper
    FROM (SELECT max(date) AS last_date, stddev_samp(avg_mag) * 0.5e0 AS sigma FROM
          (SELECT * FROM trend ORDER BY date DESC LIMIT 7)),
    (SELECT recent_avg_magnitude AS centre FROM ({_rates('quakes', c.AS_OF)} )), (VALUES {_draws}) AS d(step, z)""")

# Parsing and messages
_add("usgs_parse", f"""SELECT event_id, 'USGS' AS source, 'earthquake' AS type, magnitude, place, {_iso(_ms('ts'))} AS time,
    {_iso(f"({_ms('ts')} + 60000)")} AS updated, CASE WHEN latitude IS NOT NULL THEN longitude END AS longitude, latitude,
    CASE WHEN latitude IS NOT NULL THEN depth_km END AS depth_km, 'reviewed' AS status, tsunami, alert,
    CAST(NULL AS INT) AS felt, 'event/' || event_id AS url, significance FROM quakes""")
_category = "CASE WHEN num % 77 = 0 THEN 'unknown' WHEN num % 50 = 0 THEN 'tempExtremes' ELSE type END"
_add("eonet_parse", f"""SELECT event_id, 'NASA_EONET' AS source, {_category} AS type, title,
    CASE WHEN num % 4 = 0 THEN 'closed' ELSE 'open' END AS status, CASE WHEN num % 77 = 0 THEN '' ELSE type END AS categories,
    CASE WHEN latitude IS NOT NULL THEN longitude END AS longitude, latitude,
    CAST(CASE WHEN latitude IS NULL THEN 0 WHEN num % 5 = 0 THEN 1 ELSE 2 END AS INT) AS geometry_count,
    CASE WHEN latitude IS NULL THEN NULL WHEN num % 5 = 0 THEN strftime(last_ts, '%Y-%m-%dT%H:%M:%SZ')
         ELSE '2023-12-01T00:00:00Z' END AS start_date,
    CASE WHEN latitude IS NOT NULL THEN strftime(last_ts, '%Y-%m-%dT%H:%M:%SZ') END AS last_date,
    'source/' || event_id AS sources FROM parsed_events""")
_add("fema_parse", """SELECT event_id, state, county, incident_type, strftime(declaration_ts, '%Y-%m-%dT%H:%M:%S.000Z') AS
    declaration_date, 'Declaration ' || CAST(seq AS VARCHAR) AS title, seq % 2 = 1 AS ih_program_declared,
    seq % 2 <> 1 AS ia_program_declared, true AS pa_program_declared, false AS hm_program_declared FROM fema""")
_add("landed_pages", f"SELECT event_id, magnitude, {_iso(_ms('ts'))} AS time FROM quakes WHERE magnitude >= 2.5e0 AND "
     "epoch_ms(epoch_us(ts) // 1000) >= TIMESTAMP '2024-01-05' AND epoch_ms(epoch_us(ts) // 1000) < TIMESTAMP '2024-01-20'")
_add("window_backfill", f"SELECT event_id, magnitude, {_iso(_ms('ts'))} AS time FROM quakes WHERE magnitude >= 2.5e0 AND "
     "epoch_ms(epoch_us(ts) // 1000) >= TIMESTAMP '2024-01-05' AND epoch_ms(epoch_us(ts) // 1000) < TIMESTAMP '2024-01-25'")
# hour by hour: a window is a stretch of hours that some load holds
_hours = f"""SELECT f.feed, h.hour, (SELECT count(*) FROM loads l WHERE l.feed = f.feed AND h.hour >= l.since AND h.hour < l.until) AS depth
    FROM (SELECT DISTINCT type AS feed FROM eonet) f, (SELECT unnest(generate_series(
    (SELECT least(min(since), TIMESTAMP '{c.WANTED_FROM}') FROM loads), (SELECT greatest(max(until), TIMESTAMP '{c.AS_OF}') FROM loads),
    INTERVAL 1 HOUR)) AS hour) h"""
_PARTS["loads"] = """SELECT type AS feed, date_trunc('hour', last_ts) AS since, date_trunc('hour', last_ts)
    + INTERVAL 1 HOUR * (CAST(string_split(event_id, '_')[2] AS BIGINT) % 5 * 2) AS until FROM eonet
    WHERE type <> 'volcano' AND CAST(string_split(event_id, '_')[2] AS BIGINT) % 17 = 3"""
_PARTS["hours"] = _hours
_stretch = """SELECT *, hour - INTERVAL 1 HOUR * row_number() OVER (PARTITION BY feed ORDER BY hour) AS run FROM hours WHERE """
_add("window_gaps", f"""SELECT feed, strftime(min(hour), '%Y-%m-%d %H:%M:%S') AS start,
    strftime(max(hour) + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS end FROM (SELECT *, (row_number() OVER (PARTITION BY feed, run ORDER BY hour) - 1) // 72 AS piece
    FROM ({_stretch} depth = 0 AND hour >= TIMESTAMP '{c.WANTED_FROM}' AND hour < TIMESTAMP '{c.AS_OF}')) GROUP BY feed, run, piece""")
_add("window_overlaps", f"""SELECT feed, strftime(min(hour), '%Y-%m-%d %H:%M:%S') AS start,
    strftime(max(hour) + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS end, max(depth) AS most FROM ({_stretch} depth > 1) GROUP BY feed, run""")
_add("category_map", """SELECT type, count(*) AS count, CASE type WHEN 'wildfire' THEN 'Wildfire' WHEN 'storm' THEN 'Storm'
    WHEN 'ice' THEN 'Ice' WHEN 'dust_haze' THEN 'Dust_Haze' ELSE 'Tempextremes' END AS title FROM
    (SELECT ['wildfire', 'storm', 'ice', 'dust_haze', 'tempExtremes'][num % 5 + 1] AS type FROM parsed_events) GROUP BY type""")
_bad = "CAST(event_id AS BIGINT) % 50 <> 3 AND CAST(event_id AS BIGINT) % 70 = 5 AND magnitude IS NOT NULL"
_add("page_dead_letters", f"""SELECT 'unreadable item' AS reason, CAST(NULL AS VARCHAR) AS message_key, 'lost ' || event_id AS value
    FROM quakes WHERE CAST(event_id AS BIGINT) % 50 = 3 UNION ALL SELECT 'bad field', event_id, NULL FROM quakes WHERE {_bad}
    UNION ALL SELECT 'unreadable page', NULL, '{{"features":[{{"id":"cut","properties":{{"mag":5.'""")
_add("damaged_page_parse", f"""SELECT event_id, CASE WHEN NOT ({_bad}) THEN magnitude END AS magnitude, place FROM quakes
    WHERE CAST(event_id AS BIGINT) % 50 <> 3""")
_add("decode_messages", f"""SELECT event_id, 'USGS' AS source, CASE WHEN NOT bad THEN magnitude END AS magnitude, place,
    {_iso('ms')} AS time, longitude, latitude, depth_km, CAST(NULL AS VARCHAR) AS status, tsunami, alert, significance
    FROM msg WHERE NOT broken AND NOT keyless""")
_add("dead_letter", "SELECT * FROM letters")
_add("kafka_records", "SELECT event_id || '-' || county || '-summaries' AS key, state, seq FROM fema")
_add("ingest_window", f"""SELECT 'earthquake' AS load, event_id, count(*) AS count FROM quakes WHERE magnitude >= 2.5e0 AND
    epoch_ms(epoch_us(ts) // 1000) >= TIMESTAMP '2024-01-29' AND epoch_ms(epoch_us(ts) // 1000) < TIMESTAMP '2024-01-31' GROUP BY 2
    UNION ALL SELECT 'open_event', event_id, count(*) FROM parsed_events WHERE num % 4 <> 0 AND latitude IS NOT NULL AND
    date_trunc('second', last_ts) >= TIMESTAMP '{c.AS_OF}' - INTERVAL {c.OPEN_DAYS} DAY GROUP BY 2
    UNION ALL SELECT 'closed_event', event_id, count(*) FROM parsed_events WHERE num % 4 = 0 GROUP BY 2
    UNION ALL SELECT 'declaration', event_id, count(*) FROM fema WHERE declaration_ts > TIMESTAMP '{c.DECLARED_AFTER}' GROUP BY 2""")

# Keyed tables and streams
for _name in ("upsert_latest", "upsert_new_checkpoint", "upsert_topic_reset"):
    _add(_name, "SELECT event_id, county, state, incident_type, 'Declaration ' || CAST(seq AS VARCHAR) AS title "
                "FROM newest WHERE rn = 1")
for _name in ("upsert_replay", "stream_newest_versions"):
    _add(_name, "SELECT event_id, county, state, incident_type FROM newest WHERE rn = 1")
_add("upsert_growing", f"SELECT event_id, county, state, incident_type, (SELECT count(*) >= 6 * {c.GROWING_FILL} FROM newest WHERE rn = 1) AS grown "
     "FROM newest WHERE rn = 1")
_add("latest_declarations", "SELECT event_id, county, state, incident_type, seq FROM newest WHERE rn = 1")
_add("unseen_anti_join", f"SELECT event_id, magnitude, 1 AS pass FROM quakes WHERE ts >= TIMESTAMP '{c.SEEN_UNTIL}'")
_add("unique_key_check", "SELECT event_id, county, count(*) AS rows FROM fema GROUP BY 1, 2 HAVING count(*) > 1")
_add("stream_scored", f"""SELECT event_id, magnitude, risk_score, risk_tier, latitude IS NOT NULL AND longitude IS NOT NULL AS located,
    CASE WHEN latitude IS NOT NULL THEN longitude END AS lon, CASE WHEN longitude IS NOT NULL THEN latitude END AS lat,
    {_text('epoch_ms(epoch_us(s.ts) // 1000)')} AS ts FROM scored s""")
_add("stream_natural_events", f"""SELECT event_id, 'NASA_EONET' AS source, type, title,
    CASE WHEN num % 4 = 0 THEN 'closed' ELSE 'open' END AS status, CASE WHEN latitude IS NOT NULL THEN longitude END AS lon,
    CASE WHEN longitude IS NOT NULL THEN latitude END AS lat, CAST(1 AS INT) AS geometry_count,
    {_text('epoch_ms(epoch_us(p.last_ts) // 1000)')} AS last_ts FROM parsed_events p""")
_add("stream_dead_letters", "SELECT reason, message_key FROM letters")
_add("stream_dedup", "SELECT event_id, magnitude FROM quakes")
_add("stream_daily_cells", "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, grid_lat, grid_lon, count(magnitude) AS event_count, "
     "max(magnitude) AS max_mag FROM located WHERE magnitude IS NOT NULL GROUP BY 1, 2, 3")
_add("stream_dedup_window", f"""SELECT event_id, magnitude FROM quakes WHERE ts IS NOT NULL UNION ALL SELECT event_id, 99e0 FROM quakes
    WHERE ts < (SELECT max(ts) FROM quakes) - 2 * INTERVAL '{c.DEDUP_DELAY}'""")
_add("stream_rate_alerts", f"""SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, strftime(w + INTERVAL {c.ALERT_WINDOW}, '%Y-%m-%d %H:%M:%S')
    AS window_end, grid_lat, grid_lon, window_count, window_max_mag, {_exact('window_count / 2e0', 6)} AS window_rate, baseline_rate FROM (
    SELECT c.*, coalesce(b.daily_rate, (SELECT global_daily_rate FROM limits)) AS baseline_rate FROM (SELECT w, grid_lat, grid_lon,
    count(*) AS window_count, max(magnitude) AS window_max_mag FROM history, (SELECT unnest(generate_series(TIMESTAMP '2023-12-01',
    TIMESTAMP '2024-03-01', INTERVAL {c.ALERT_SLIDE})) AS w) WHERE epoch_ms(epoch_us(ts) // 1000) >= w
    AND epoch_ms(epoch_us(ts) // 1000) < w + INTERVAL {c.ALERT_WINDOW} GROUP BY 1, 2, 3) c LEFT JOIN baselines b USING (grid_lat, grid_lon))
    WHERE window_count / 2e0 > 3e0 * baseline_rate AND w + INTERVAL {c.ALERT_WINDOW} <=
    (SELECT max(epoch_ms(epoch_us(ts) // 1000)) - INTERVAL {c.ALERT_DELAY} FROM history)""")
_third, _half = "CAST(event_id AS BIGINT) % 3 = 0", "CAST(event_id AS BIGINT) % 2 = 0"
_add("stream_corrected_cells", f"""SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, {_live('latitude')} AS grid_lat, {_live('longitude')} AS grid_lon,
    count(*) AS event_count, max(magnitude) AS max_mag FROM (SELECT ts, longitude, CASE WHEN {_third} THEN latitude WHEN {_half} THEN latitude / 2
    ELSE latitude END AS latitude, magnitude + CASE WHEN {_third} THEN 0 WHEN {_half} THEN 3 ELSE 1 END AS magnitude FROM quakes)
    WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND magnitude IS NOT NULL GROUP BY 1, 2, 3""")

_add("stream_pages_topic", """SELECT event_id, title || CASE WHEN num % 3 = 0 THEN ', seen live' ELSE '' END AS title,
    CASE WHEN num % 4 = 0 THEN 'closed' ELSE 'open' END AS status, CASE WHEN num % 3 = 0 THEN 2 ELSE 1 END AS copies FROM parsed_events""")
_add("stream_newest_state", f"""SELECT event_id, CASE WHEN ts < late THEN CASE WHEN {_half} THEN magnitude + 3 ELSE magnitude + 1 END
    WHEN {_third} THEN magnitude WHEN {_half} THEN magnitude + 3 ELSE magnitude + 1 END AS magnitude, ts <= late AS expired
    FROM quakes, (SELECT max(epoch_ms(epoch_us(ts) // 1000)) - INTERVAL {c.STATE_DELAY} AS late FROM quakes) WHERE ts IS NOT NULL""")

# Learning
_add("training_window", f"SELECT event_id, magnitude, {_text('h.ts')} AS ts FROM hist h")
_add("stratified_sample", "SELECT event_id, magnitude FROM sampled")
_add("rf_features", f"""SELECT event_id, magnitude, greatest(coalesce(depth_km, 33e0), 0e0) AS depth_km,
    coalesce(tsunami, 0) AS tsunami, coalesce(alert, 'none') AS alert, CAST(month(ts) AS INT) AS month,
    CAST(hour(ts) AS INT) AS hour_of_day, CAST(dayofweek(ts) + 1 AS INT) AS day_of_week,
    CAST(greatest(coalesce(depth_km, 33e0), 0e0) < 70 AS INT) AS is_shallow,
    CAST(coalesce(depth_km, 33e0) >= 70 AND coalesce(depth_km, 33e0) < 300 AS INT) AS is_intermediate,
    {_mean('ln(1e0 + greatest(coalesce(depth_km, 33e0), 0e0))', 6)} AS log_depth,
    {_mean('magnitude * magnitude', 6)} AS mag_squared
    FROM quakes WHERE magnitude IS NOT NULL""")
_add("rf_label", f"""SELECT event_id, sig_norm, {TIER.format('sig_norm')} AS risk_tier FROM (SELECT event_id,
    CAST(round(CAST(CAST(CASE WHEN significance > 1000 THEN 100e0 WHEN significance < 0 THEN 0e0 ELSE significance / 10e0 END
    AS VARCHAR) AS DECIMAL(38, 20)), 2) AS DOUBLE) AS sig_norm FROM quakes WHERE magnitude IS NOT NULL AND
    significance IS NOT NULL)""")
_add("dataset_counts", """SELECT CASE WHEN magnitude < 4 THEN 'low' WHEN magnitude < 5 THEN 'mid' ELSE 'high' END AS band,
    CASE WHEN v < 0.8e0 THEN 'train' ELSE 'test' END AS part, count(*) AS count FROM sampled WHERE significance IS NOT NULL
    GROUP BY 1, 2""")
_z = ", ".join(f"{_mean(f'({n} - avg({n}) OVER ()) / stddev_samp({n}) OVER ()', 6)} AS z_{n}" for n in _FEATURES)
_add("region_scaled", f"""SELECT grid_lat, grid_lon, {_z} FROM (SELECT {_batch('latitude', 10)} AS grid_lat,
    {_batch('longitude', 10)} AS grid_lon, count(*) AS eq_count, avg(magnitude) AS avg_mag, max(magnitude) AS max_mag,
    avg(coalesce(depth_km, 33e0)) AS avg_depth, coalesce(stddev_samp(magnitude), 0e0) AS mag_variability
    FROM arch GROUP BY 1, 2)""")
_add("alert_index", """SELECT event_id, alert, alert_idx FROM (SELECT event_id, coalesce(alert, 'none') AS alert FROM quakes
    WHERE magnitude IS NOT NULL) JOIN (SELECT coalesce(alert, 'none') AS alert,
    CAST(row_number() OVER (ORDER BY count(*) DESC, coalesce(alert, 'none')) - 1 AS DOUBLE) AS alert_idx FROM quakes
    WHERE magnitude IS NOT NULL GROUP BY 1) USING (alert)""")
_add("region_features", f"""SELECT {_batch('latitude', 10)} AS grid_lat, {_batch('longitude', 10)} AS grid_lon,
    count(*) AS eq_count, {_mean('avg(magnitude)', 6)} AS avg_mag, max(magnitude) AS max_mag,
    {_mean('avg(coalesce(depth_km, 33e0))', 6)} AS avg_depth, {_mean('coalesce(stddev_samp(magnitude), 0e0)', 6)} AS mag_variability
    FROM quakes WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND magnitude IS NOT NULL GROUP BY 1, 2""")
_add("stats_roundtrip", "SELECT CAST(grid_lat AS VARCHAR) || ',' || CAST(grid_lon AS VARCHAR) AS cell, historical_count, "
     "daily_rate, avg_mag, max_mag, std_mag FROM baselines")

# Models: k-means by recursion, the metrics' rule on predictions that the table fixes. A fitted forest has no SQL: tests walk its tables
_add("elbow", f"""SELECT k, {_mean('wssse', 6)} AS wssse, {_mean('d', 6)} AS drop, CAST(coalesce((SELECT arg_max(k, (d, -k)) FROM costs
    WHERE d > 0), 5) AS INT) AS best_k, k = coalesce((SELECT arg_max(k, (d, -k)) FROM costs WHERE d > 0), 5) AS chosen FROM costs""")
_add("cluster_profiles", f"""SELECT *, CASE WHEN cluster_max_mag >= 7 AND avg_eq_count > 50 THEN 'Critical Seismic Zone'
    WHEN cluster_avg_mag >= 4.5e0 THEN 'High Seismic Activity' WHEN avg_eq_count >= 20 THEN 'Frequent Moderate Activity'
    WHEN cluster_avg_depth > 200 THEN 'Deep Seismic Zone' ELSE 'Low Activity' END AS label FROM (SELECT
    cluster_id, count(*) AS region_count,
    {_mean('avg(eq_count)', 6)} AS avg_eq_count, {_mean('avg(avg_mag)', 6)} AS cluster_avg_mag, max(max_mag) AS cluster_max_mag,
    {_mean('avg(avg_depth)', 6)} AS cluster_avg_depth FROM bestk GROUP BY 1)""")
_add("region_model", f"SELECT k, grid_lat, grid_lon, cluster_id, {_mean('distance', 6)} AS distance FROM placed")
_add("rf_metrics", f"""SELECT count(*) AS rows, {_mean('sqrt(avg(e * e))', 6)} AS rmse,
    {_mean('1e0 - sum(e * e) / (var_pop(sig_norm) * count(*))', 6)} AS r2 FROM (SELECT sig_norm, sig_norm - magnitude * 10 AS e
    FROM (SELECT magnitude, CAST(round(CAST(CAST(least(greatest(significance / 10e0, 0e0), 100e0) AS VARCHAR) AS DECIMAL(38, 20)), 2)
    AS DOUBLE) AS sig_norm FROM quakes WHERE magnitude IS NOT NULL AND significance IS NOT NULL))""")
