import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler

from zonelens.operators import drivers, embed, zones


def test_silhouette_chooses_planted_k(spark):
    rng = np.random.default_rng(1)
    rows = []
    for c, centre in enumerate([(0, 0, 0), (8, 0, 0), (0, 8, 0), (0, 0, 8)]):
        for i in range(30):
            rows.append((f"d{c}_{i}", *[float(v) for v in rng.normal(centre, 0.6)]))
    df = spark.createDataFrame(rows, "district string, a double, b double, c double")
    res = zones.zones(df, ["a", "b", "c"], ks=(3, 4, 5))
    assert res.best_k == 4
    assert res.members.count() == 120
    sizes = sorted(r["size"] for r in res.report.collect())
    assert sizes == [30, 30, 30, 30]


def test_pca_matches_spark_ml(spark):
    rng = np.random.default_rng(2)
    f = rng.normal(size=(400, 3))
    load = rng.normal(size=(3, 6))
    x = f @ load + 0.1 * rng.normal(size=(400, 6))
    cols = [f"c{i}" for i in range(6)]
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], ", ".join(f"{c} double" for c in cols))
    ours = drivers.pca(df, cols, k=4)
    pipe = Pipeline(stages=[VectorAssembler(inputCols=cols, outputCol="v"),
                            StandardScaler(inputCol="v", outputCol="s", withMean=True, withStd=True),
                            PCA(k=4, inputCol="s", outputCol="p")]).fit(df)
    ref = pipe.stages[-1]
    assert ours.eigenvalues is not None
    ratio = [r["explained_variance"] for r in ours.variance.orderBy("component").collect()]
    assert ratio == pytest.approx(list(ref.explainedVariance.toArray()), rel=1e-6)
    assert sum(ratio[:3]) > 0.95  # three planted factors
    pc = ref.pc.toArray()
    for j in range(4):
        assert abs(np.dot(pc[:, j], ours.components[:, j])) == pytest.approx(1.0, abs=1e-6)
    g = ours.components.T @ ours.components
    assert g == pytest.approx(np.eye(4), abs=1e-9)


def test_sparse_pca_matches_a_local_svd_and_moves_no_posting(spark):
    rng = np.random.default_rng(4)
    x = (rng.random((90, 5)) @ rng.random((5, 40))) * (rng.random((90, 40)) < 0.4)
    x[7] = 0
    rows = [(i, [int(t) for t in np.flatnonzero(r)], [float(v) for v in r[r > 0]]) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "id long, idx array<int>, w array<double>").repartition(3)
    res = embed.randomized_pca(df, 40, k=6, oversample=20, iters=8)
    c = x - x.mean(0)
    u, s, vt = np.linalg.svd(c, full_matrices=False)
    assert list(res.explained_variance_ratio) == pytest.approx(list((s ** 2 / (s ** 2).sum())[:6]), rel=1e-6)
    assert np.abs(np.diag(vt[:6] @ res.components)) == pytest.approx(np.ones(6), abs=1e-6)
    got = np.array([r.embedding for r in res.scores.orderBy("doc_id").collect()])
    assert got == pytest.approx(c @ res.components, abs=1e-9)
    assert "Exchange" not in res.scores._jdf.queryExecution().executedPlan().toString()
