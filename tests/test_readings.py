import datetime as dt

import pytest
from pyspark.sql import functions as F

from zonelens.operators import clean, profile, sample, stats
from zonelens.sources.readings import conform_readings

M = ["pm25", "pm10", "no2", "so2", "o3", "co"]


@pytest.fixture()
def tiny(spark):
    t = dt.datetime(2024, 1, 1, 10)
    rows = [
        ("L1", "A", t, "pm25", 10.0), ("L1", "A", t, "co", 999.0), ("L1", "A", t, "co", 1000.0),
        ("L1", "A", t, "pm10", 0.0), ("L2", None, t, "pm25", 30.0), ("L2", "B", t, "pm25", 20.0),
        ("L2", "B", t, "pm25", 20.0), ("L3", "C", t, "no2", 50.0), ("L3", "C", t, "other", 5.0),
    ]
    df = spark.createDataFrame(rows, "location string, district string, datetime timestamp, parameter string, value double")
    return conform_readings(df)


def test_validity_before_unit_correction(tiny):
    out = clean.unit_correct(clean.clean_readings(tiny, M), {"co": 0.001})
    co = [r["value"] for r in out.filter("parameter = 'co'").collect()]
    assert co == [pytest.approx(0.999)]  # raw 1000 is dropped although it would be 1.0
    assert out.filter("value <= 0").count() == 0
    assert out.filter("parameter = 'other'").count() == 0


def test_narrow_bounds(tiny):
    assert clean.clean_readings(tiny, M, low=15, high=40).count() == 3


def test_profile_null_district_and_zero_fill(tiny):
    p = profile.district_profile(tiny, M, scale={"co": 0.001})
    rows = {r["district"]: r for r in p.collect()}
    assert None in rows  # the null district is its own group
    assert rows["A"]["co_avg"] == pytest.approx(0.999)
    assert rows["A"]["no2_avg"] == 0.0
    assert rows["B"]["pm25_avg"] == 20.0


def test_winsorize_caps_and_drops_null(spark, tiny):
    p = profile.district_profile(tiny, M)
    w = stats.winsorize(p, [f"{m}_avg" for m in M], 0.95, drop_null="district")
    assert w.filter("district IS NULL").count() == 0
    p95 = stats.percentiles(p, ["pm25_avg"], 0.95).first()[0]
    assert max(r["pm25_avg"] for r in w.collect()) <= p95


def test_pivot_matches_groupby_pivot(tiny):
    cleaned = clean.clean_readings(tiny, M)
    ours = {r["district"]: r for r in profile.pivot_mean(cleaned, ["district"], M).collect()}
    ref = {r["district"]: r for r in cleaned.groupBy("district").pivot("parameter", M).agg(F.avg("value")).collect()}
    for d, r in ref.items():
        for m in M:
            assert ours[d][m] == r[m]


def test_dominant_ties_first_listed(spark):
    df = spark.createDataFrame([("x", 3.0, 3.0, 1.0)], "k string, a double, b double, c double")
    r = profile.dominant_measure(df, ["a", "b", "c"], keys=["k"]).first()
    assert (r["dominant_measure"], r["dominant_value"]) == ("a", 3.0)


def test_concurrent_vectors_earliest_reading(spark):
    t = dt.datetime(2024, 1, 1, 10)
    rows = [("L", "D", t + dt.timedelta(minutes=5), "a", 2.0), ("L", "D", t, "a", 1.0), ("L", "D", t, "b", 3.0),
            ("M", "D", t, "a", 1.0)]
    df = conform_readings(spark.createDataFrame(rows, "location string, district string, datetime timestamp, "
                                                      "parameter string, value double"))
    out = profile.concurrent_vectors(df, ["a", "b"], grain="hour").collect()
    assert len(out) == 1 and out[0]["a"] == 1.0 and out[0]["b"] == 3.0


def test_hash_sample_is_layout_independent(spark):
    df = spark.range(0, 5000).withColumnRenamed("id", "k")
    a = {r.k for r in sample.hash_sample(df, ["k"], 0.1).collect()}
    b = {r.k for r in sample.hash_sample(df.repartition(7), ["k"], 0.1).collect()}
    assert a == b and 350 < len(a) < 650
    l1 = [r.k for r in sample.hash_limit(df, ["k"], 50).collect()]
    l2 = [r.k for r in sample.hash_limit(df.repartition(3), ["k"], 50).collect()]
    assert l1 == l2


def test_correlation_properties(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    x = rng.normal(size=300)
    rows = [(float(a), float(2 * a + rng.normal()), float(rng.normal()), 1.0) for a in x]
    df = spark.createDataFrame(rows, "a double, b double, c double, k double")
    m = {(r.p1, r.p2): r.r for r in stats.correlation_matrix(df, ["a", "b", "c", "k"]).collect()}
    for c in "abck":
        assert m[(c, c)] == 1.0
    assert m[("a", "b")] == pytest.approx(m[("b", "a")])
    assert abs(m[("a", "b")]) <= 1 and m[("a", "b")] > 0.8
    assert m[("a", "k")] is None or np.isnan(m[("a", "k")])  # constant column: undefined


def test_standardize_constant_column_is_zero(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "a double, b double")
    out = stats.standardize(df, ["a", "b"]).collect()
    assert [r.b for r in out] == [0.0, 0.0, 0.0]
    assert [round(r.a, 6) for r in out] == [-1.0, 0.0, 1.0]
