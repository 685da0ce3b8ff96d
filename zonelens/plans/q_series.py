"""Registered queries over ``events`` read as station series, and ``orders`` dates."""
from __future__ import annotations

from pyspark.sql import functions as F

from zonelens.functions.calendar import calendar_columns, safe_ratio
from zonelens.operators import clean, forecast, timeseries as ts
from zonelens.plans.registry import register, table
from zonelens.plans.sqltext import r6
from zonelens.sources.readings import station_table_from_events

SPEC = ts.SeriesSpec()
KEYS = ["station", "ReadTime"]


def stations(spark, sf):
    return station_table_from_events(table(spark, sf, "events"))


def features(spark, sf, **kw):
    return ts.series_features(stations(spark, sf), SPEC, **kw)


def frame(spark, sf):
    return ts.model_frame(stations(spark, sf), SPEC)


STATION_SQL = ("SELECT user_id AS station, ts AS ReadTime, value AS PM25, "
               "TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS PM10 FROM events")
W = "PARTITION BY station ORDER BY ReadTime"


def _rows(n: int) -> str:
    return f"({W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


LAGS = {f"lag_{n}h": f"lag(PM25, {n}) OVER ({W})" for n in SPEC.lags}
MEANS = {f"rolling_mean_{n}h": f"avg(PM25) OVER {_rows(n)}" for n in SPEC.means}
STDS = {f"rolling_std_{n}h": f"stddev_samp(PM25) OVER {_rows(n)}" for n in SPEC.stds}
DIFFS = {f"diff_{n}h": f"PM25 - lag(PM25, {n}) OVER ({W})" for n in SPEC.diffs}
CAL = {
    "hour": "CAST(hour(ReadTime) AS INTEGER)",
    "day_of_week": "CAST(dayofweek(ReadTime) + 1 AS INTEGER)",
    "month": "CAST(month(ReadTime) AS INTEGER)",
    "is_weekend": "CASE WHEN dayofweek(ReadTime) IN (0, 6) THEN 1 ELSE 0 END",
    "season": ("CASE WHEN month(ReadTime) IN (12, 1, 2) THEN 'winter' WHEN month(ReadTime) IN (3, 4, 5) "
               "THEN 'spring' WHEN month(ReadTime) IN (6, 7, 8) THEN 'summer' ELSE 'fall' END"),
}
RATIO = {"pm25_to_pm10_ratio": "CASE WHEN PM10 > 0 THEN PM25 / PM10 ELSE 0 END"}


def _select(exprs: dict[str, str], rounded: bool = True) -> str:
    return ", ".join(f"{r6(e) if rounded else e} AS {n}" for n, e in exprs.items())


def _feature_sql(exprs: dict[str, str]) -> str:
    return f"WITH s AS ({STATION_SQL})\nSELECT station, ReadTime, {r6('PM25')} AS PM25, {_select(exprs)} FROM s"


@register("ts_lags", _feature_sql(LAGS))
def ts_lags(spark, sf):
    """Lag by 1, 3, 6, 24 rows per station."""
    return features(spark, sf).select(*KEYS, "PM25", *LAGS)


@register("ts_rolling_mean", _feature_sql(MEANS))
def ts_rolling_mean(spark, sf):
    """Rolling mean over 3, 6, 24 rows including the current row."""
    return features(spark, sf).select(*KEYS, "PM25", *MEANS)


@register("ts_rolling_std", _feature_sql(STDS))
def ts_rolling_std(spark, sf):
    """Rolling sample stddev over 6, 24 rows (null on a series' first row)."""
    return features(spark, sf).select(*KEYS, "PM25", *STDS)


@register("ts_diffs", _feature_sql(DIFFS))
def ts_diffs(spark, sf):
    """Difference to the value 1 and 24 rows earlier."""
    return features(spark, sf).select(*KEYS, "PM25", *DIFFS)


@register("ts_percent_rank", f"WITH s AS ({STATION_SQL})\nSELECT station, ReadTime, "
          f"{r6(f'percent_rank() OVER ({W})')} AS rank FROM s")
def ts_percent_rank(spark, sf):
    """E5: relative position 0..1 of each row in its series."""
    return ts.relative_position(stations(spark, sf), SPEC).select(*KEYS, "rank")


@register("ts_split", f"WITH s AS ({STATION_SQL}), p AS (SELECT station, ReadTime, "
          f"percent_rank() OVER ({W}) AS rank FROM s)\nSELECT station, ReadTime, "
          "CASE WHEN rank <= 0.8 THEN 'train' ELSE 'test' END AS split FROM p")
def ts_split(spark, sf):
    """Time-ordered 80/20 split per station."""
    return ts.add_split(stations(spark, sf), SPEC).select(*KEYS, "split")


@register("safe_ratio", f"WITH s AS ({STATION_SQL})\nSELECT station, ReadTime, {_select(RATIO)} FROM s")
def safe_ratio_q(spark, sf):
    """Guarded ratio PM25 / PM10, 0 unless PM10 > 0."""
    return stations(spark, sf).select(*KEYS, safe_ratio(F.col("PM25"), F.col("PM10")).alias("pm25_to_pm10_ratio"))


ALL_FEATURES = {**LAGS, **MEANS, **STDS, **{k: v for k, v in CAL.items() if k != "season"}, **DIFFS, **RATIO}
FEATURE_NAMES = ["PM10", *ALL_FEATURES]

FRAME_SQL = f"""WITH s AS ({STATION_SQL}),
f AS (SELECT station, ReadTime, PM25, PM10, {_select(ALL_FEATURES, rounded=False)}, {CAL['season']} AS season FROM s),
g AS (SELECT avg(PM25) AS m, stddev_samp(PM25) AS sd FROM f),
z AS (SELECT f.* FROM f, g WHERE (PM25 - m) / sd BETWEEN -4 AND 4
      AND {' AND '.join(f'{c} IS NOT NULL' for c in ['PM25', *FEATURE_NAMES])}),
p AS (SELECT *, percent_rank() OVER ({W}) AS rank FROM z)"""


@register("ts_model_frame", FRAME_SQL + "\nSELECT station, ReadTime, season, "
          + ", ".join(f"{r6(c)} AS {c}" if c not in CAL else f"{c}" for c in ["PM25", *FEATURE_NAMES, "rank"])
          + ", CASE WHEN rank <= 0.8 THEN 'train' ELSE 'test' END AS split FROM p")
def ts_model_frame(spark, sf):
    """H7 + H6 + E5 + E6: all features, z-score filter, null drop, relative position, split."""
    return frame(spark, sf)


@register("regression_metrics", FRAME_SQL + """,
e AS (SELECT CASE WHEN rank <= 0.8 THEN 'train' ELSE 'test' END AS split, PM25 AS y, lag_1h AS yhat FROM p)
SELECT split, count(*) AS n, """ + r6("sqrt(avg((y - yhat) * (y - yhat)))") + """ AS rmse,
       """ + r6("avg(abs(y - yhat))") + """ AS mae,
       """ + r6("1 - sum((y - yhat) * (y - yhat)) / (var_pop(y) * count(*))") + """ AS r2
FROM e GROUP BY split""")
def regression_metrics(spark, sf):
    """RMSE, MAE, R2 per split in one aggregate; fixed predictor = previous value."""
    return forecast.regression_metrics(frame(spark, sf), "PM25", "lag_1h")


ORDERS_CAL = {
    "year": "CAST(year(o_orderdate) AS INTEGER)",
    "hour": "CAST(hour(o_orderdate) AS INTEGER)",
    "day_of_week": "CAST(dayofweek(o_orderdate) + 1 AS INTEGER)",
    "month": "CAST(month(o_orderdate) AS INTEGER)",
    "is_weekend": "CASE WHEN dayofweek(o_orderdate) IN (0, 6) THEN 1 ELSE 0 END",
    "season": CAL["season"].replace("ReadTime", "o_orderdate"),
}


@register("calendar_features", "SELECT o_orderkey, "
          + ", ".join(f"{e} AS {n}" for n, e in ORDERS_CAL.items()) + " FROM orders")
def calendar_features(spark, sf):
    """Year, hour, day of week (1 = Sunday), month, weekend flag, season."""
    return table(spark, sf, "orders").select("o_orderkey", *calendar_columns("o_orderdate", with_year=True))


@register("since_year", "SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00'")
def since_year(spark, sf):
    """Rows from 1998 on, as a pushable range predicate."""
    return clean.since(table(spark, sf, "orders"), "o_orderdate", 1998)


@register("season_index", f"""WITH s AS (SELECT o_orderkey, {ORDERS_CAL['season']} AS season FROM orders),
c AS (SELECT season, CAST(row_number() OVER (ORDER BY count(*) DESC, season) - 1 AS DOUBLE) AS season_index
      FROM s GROUP BY season)
SELECT s.o_orderkey, s.season, c.season_index FROM s JOIN c USING (season)""")
def season_index(spark, sf):
    """H3: season to index by falling frequency (ties alphabetical), unknown kept."""
    o = table(spark, sf, "orders").select("o_orderkey", *calendar_columns("o_orderdate")[-1:])
    return forecast.index_category(o, "season", "season_index")
