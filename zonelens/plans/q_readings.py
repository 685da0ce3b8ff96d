"""Registered queries over ``events`` read as readings (profiles, percentiles, samples)."""
from __future__ import annotations

from zonelens.operators import clean, profile, sample, stats
from zonelens.plans.config import EVENT_MEASURES as M
from zonelens.plans.config import EVENT_SCALE, VALID_HIGH, VALID_LOW
from zonelens.plans.registry import register, table
from zonelens.plans.sqltext import in_list, profile_cte, q, r6, scaled_value, valid_events
from zonelens.sources.readings import readings_from_events, station_table_from_events

AVG = [f"{m}_avg" for m in M]


def readings(spark, sf):
    return readings_from_events(table(spark, sf, "events"))


def profile_df(spark, sf):
    return profile.district_profile(readings(spark, sf), M, scale=EVENT_SCALE, low=VALID_LOW, high=VALID_HIGH)


def winsorized(spark, sf):
    return stats.winsorize(profile_df(spark, sf), AVG, 0.95, drop_null="district")


READINGS_SQL = """SELECT user_id AS location, user_id AS district, ts AS datetime, event_type AS parameter, value,
       CAST(year(ts) AS INTEGER) AS year, CAST(hour(ts) AS INTEGER) AS hour
FROM events"""


@register("scan_readings", READINGS_SQL)
def scan_readings(spark, sf):
    """A1: the events table as canonical readings (year and hour derived)."""
    return readings(spark, sf)


@register("clean_readings", READINGS_SQL + f"\nWHERE {valid_events()}")
def clean_readings(spark, sf):
    """B1 + B2: membership filter and open-interval validity filter."""
    return clean.clean_readings(readings(spark, sf), M, low=VALID_LOW, high=VALID_HIGH)


@register("unit_correct", f"""SELECT user_id AS location, user_id AS district, ts AS datetime, event_type AS parameter,
       {r6(scaled_value())} AS value, CAST(year(ts) AS INTEGER) AS year, CAST(hour(ts) AS INTEGER) AS hour
FROM events WHERE {valid_events()}""")
def unit_correct(spark, sf):
    """Conditional unit correction after the validity filter."""
    r = clean.clean_readings(readings(spark, sf), M, low=VALID_LOW, high=VALID_HIGH)
    return clean.unit_correct(r, EVENT_SCALE)


@register("row_counts", f"""SELECT count(*) AS n_rows,
       count(*) FILTER (WHERE event_type IN ({in_list(M)})) AS n_measured,
       count(*) FILTER (WHERE {valid_events()}) AS n_valid,
       count(*) FILTER (WHERE {valid_events()} AND event_type IN ({in_list(list(EVENT_SCALE))})) AS n_scaled,
       count(*) FILTER (WHERE user_id IS NULL) AS n_null_key,
       count(*) FILTER (WHERE value IS NULL) AS n_null_value
FROM events""")
def row_counts(spark, sf):
    """The row-count data checks as one aggregate."""
    return profile.row_counts(readings(spark, sf), M, scale=EVENT_SCALE, low=VALID_LOW, high=VALID_HIGH)


_PROFILE_SQL = "SELECT district, " + ", ".join(r6(c) + f" AS {c}" for c in AVG) + f"\nFROM ({profile_cte()}) p"


@register("district_profile", _PROFILE_SQL)
def district_profile(spark, sf):
    """D1 + B7 + B8: pivoted mean per district, missing measure 0, ``_avg`` names."""
    return profile_df(spark, sf)


_hourly_cols = ",\n       ".join(
    r6(f"coalesce(avg({scaled_value()}) FILTER (WHERE event_type = {q(m)}), 0)") + f" AS {m}" for m in M)


@register("hourly_vectors", f"""SELECT user_id AS district, CAST(year(ts) AS INTEGER) AS year, CAST(hour(ts) AS INTEGER) AS hour,
       {_hourly_cols}
FROM events WHERE {valid_events()}
GROUP BY user_id, year(ts), hour(ts)""")
def hourly_vectors(spark, sf):
    """Pivoted mean per (district, year, hour of day) over all readings."""
    return profile.hourly_vectors(readings(spark, sf), M, scale=EVENT_SCALE, low=VALID_LOW, high=VALID_HIGH)


_conc_cols = ",\n         ".join(f"arg_min(value, ts) FILTER (WHERE event_type = {q(m)}) AS {m}" for m in M)


@register("concurrent_vectors", f"""SELECT * FROM (
  SELECT user_id AS location, CAST(date_trunc('day', ts) AS TIMESTAMP) AS datetime,
         {_conc_cols}
  FROM events WHERE {valid_events()}
  GROUP BY user_id, date_trunc('day', ts)) c
WHERE {' AND '.join(f'{m} IS NOT NULL' for m in M)}""")
def concurrent_vectors(spark, sf):
    """D3 + B9 + B10: concurrent readings per (location, day), all measures present."""
    return profile.concurrent_vectors(readings(spark, sf), M, grain="day", low=VALID_LOW, high=VALID_HIGH)


@register("p95", "SELECT " + ", ".join(f"{r6(f'quantile_disc({c}, 0.95)')} AS p95_{c}" for c in AVG)
          + f"\nFROM ({profile_cte()}) p")
def p95(spark, sf):
    """95th percentile of every profile column in one aggregate."""
    return stats.percentiles(profile_df(spark, sf), AVG, 0.95)


_P95_CTE = ("WITH prof AS (" + profile_cte() + "),\npct AS (SELECT "
            + ", ".join(f"quantile_disc({c}, 0.95) AS {c}" for c in AVG) + " FROM prof),\n"
            + "win AS (SELECT prof.district, "
            + ", ".join(f"CASE WHEN prof.{c} > pct.{c} THEN pct.{c} ELSE prof.{c} END AS {c}" for c in AVG)
            + " FROM prof, pct WHERE prof.district IS NOT NULL)\n")


@register("winsorize", _P95_CTE + "SELECT district, " + ", ".join(f"{r6(c)} AS {c}" for c in AVG) + " FROM win")
def winsorize(spark, sf):
    """H5 (D4 + C2 + G9): cap every profile column at its p95; drop the null district."""
    return winsorized(spark, sf)


_greatest = "greatest(" + ", ".join(AVG) + ")"
_dominant_case = "CASE " + " ".join(f"WHEN {c} = {_greatest} THEN {q(m)}" for c, m in zip(AVG, M)) + " END"


@register("dominant_measure", _P95_CTE + f"SELECT district, {_dominant_case} AS dominant_measure, "
          f"{r6(_greatest)} AS dominant_value FROM win")
def dominant_measure(spark, sf):
    """Dominant measure (ties: first listed) of every capped district profile."""
    return profile.dominant_measure(winsorized(spark, sf), AVG, keys=["district"], names=M)


@register("global_stats", f"SELECT {r6('avg(value)')} AS mean, {r6('stddev_samp(value)')} AS std FROM events")
def global_stats(spark, sf):
    """Global mean and sample standard deviation of the target."""
    return stats.global_stats(station_table_from_events(table(spark, sf, "events")), "PM25")


_STATION_SQL = ("SELECT user_id AS station, ts AS ReadTime, value AS PM25, "
                "TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS PM10 FROM events")


@register("zscore_filter", f"""WITH s AS ({_STATION_SQL}),
g AS (SELECT avg(PM25) AS m, stddev_samp(PM25) AS sd FROM s)
SELECT station, ReadTime, {r6('PM25')} AS PM25, {r6('PM10')} AS PM10, {r6('(PM25 - m) / sd')} AS zscore
FROM s, g WHERE (PM25 - m) / sd BETWEEN -4 AND 4""")
def zscore_filter(spark, sf):
    """H6 (D5 + C2 + G8 + B11): z-score of the target, rows within [-4, 4]."""
    st = station_table_from_events(table(spark, sf, "events"))
    return stats.zscore_filter(st, "PM25", limit=4.0, keep_score=True)


@register("hash_sample", "SELECT * FROM events WHERE substr(md5(CAST(event_id AS VARCHAR)), 1, 8) < "
          "'051eb852'")
def hash_sample(spark, sf):
    """deterministic 2 % Bernoulli sample by md5 of the key."""
    return sample.hash_sample(table(spark, sf, "events"), ["event_id"], 0.02)


@register("hash_limit", "SELECT * FROM events ORDER BY substr(md5(CAST(event_id AS VARCHAR)), 1, 8), event_id "
          "LIMIT 3000")
def hash_limit(spark, sf):
    """3000 rows chosen by the smallest key hashes (deterministic limit)."""
    return sample.hash_limit(table(spark, sf, "events"), ["event_id"], 3000)
