import os

import pytest
from pyspark.sql import functions as F

from zonelens.plans import analyses, q_chains, q_readings, q_series
from zonelens.plans.config import EVENT_MEASURES as M
from zonelens.plans.config import EVENT_SCALE

SF = "/root/testdata/sf0.001"


def test_drivers_use_every_vector_and_sample_readings_first(spark):
    readings = q_readings.readings(spark, SF)
    var = analyses.drivers(readings, M, scale=EVENT_SCALE).variance.orderBy("component").collect()
    assert len(var) == len(M) and var[-1]["cumulative_variance"] == pytest.approx(1.0)
    half = analyses.drivers(readings, M, scale=EVENT_SCALE, fraction=0.5, max_rows=50)
    again = analyses.drivers(readings.repartition(3), M, scale=EVENT_SCALE, fraction=0.5, max_rows=50)
    assert half.eigenvalues == pytest.approx(again.eigenvalues)


def test_correlations(spark):
    res = analyses.correlations(q_readings.readings(spark, SF), M, keys=("district", "year"), top=2)
    m = {(r.p1, r.p2): r.r for r in res.matrix.collect()}
    assert len(m) == len(M) ** 2 and all(m[a, b] == pytest.approx(m[b, a]) for a, b in m)
    assert res.top.count() == 2


def test_zones(spark):
    res = analyses.zones(q_readings.readings(spark, SF), M, scale=EVENT_SCALE, ks=(2, 3))
    assert res.best_k in (2, 3)
    assert res.members.count() == q_readings.profile_df(spark, SF).filter("district is not null").count()


def test_literature_with_text_ids(spark):
    docs = spark.read.parquet(os.path.join(SF, "documents.parquet")).select(F.concat(F.lit("W"), "doc_id").alias("doc_id"), "text")
    meta = docs.select("doc_id", F.length("text").alias("cited")).filter("doc_id <> 'W1'")
    res = analyses.literature(docs, meta, max_features=300, n_neighbors=5, n_topics=3, components=4)
    rows = res.report.collect()
    assert rows and all(r.doc_id.startswith("W") and r.doc_id != "W1" for r in rows)
    assert len({r.doc_id for r in rows}) == len(rows) == res.outliers.count()
    assert {"cited", "is_outlier", "map_x"} <= set(res.report.columns)
    assert {r.doc_id for r in res.neighbour_map.collect()} == {r.doc_id for r in rows}


def test_forecast_from_a_csv_folder(spark, tmp_path):
    """Files of two column orders and a value that is no number: the forecast of the same rows as a table."""
    rows = q_series.stations(spark, SF)
    text = rows.select(F.col("station").cast("string"), F.date_format("ReadTime", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ReadTime"), F.col("PM25").cast("string"),
                       F.coalesce(F.col("PM10").cast("string"), F.lit("n/a")).alias("PM10"))
    text.filter("station % 2 = 0").write.option("header", True).csv(f"file://{tmp_path}/all/a")
    text.filter("station % 2 = 1").select("PM10", "ReadTime", "PM25", "station").write.option("header", True).csv(f"file://{tmp_path}/all/b")
    got = analyses.forecast_csv(spark, f"file://{tmp_path}/all/*", num_trees=5, max_depth=4)
    want = analyses.forecast(rows.withColumn("station", F.col("station").cast("string")), num_trees=5, max_depth=4)
    pick = lambda f: sorted((r.station, r.ReadTime, r.split, round(r.PM25, 9)) for r in f.predictions.collect())
    assert pick(got) == pick(want)
    m, n = ({r.split: r.asDict() for r in f.metrics.collect()} for f in (got, want))
    assert set(m) == set(n) == {"train", "test"}
    for s in m:
        assert all(m[s][c] == pytest.approx(n[s][c], rel=0.2) for c in m[s] if c != "split")
