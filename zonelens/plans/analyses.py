"""The analyses as parameterised functions, DataFrame in, results out.

``zones``         district profiles -> capping -> k-means with k chosen by silhouette
``drivers``       hourly vectors -> principal components (all rows: one covariance aggregate)
``correlations``  concurrent vectors -> Pearson matrix and the strongest pairs
``forecast``      station series -> features -> split -> random forest -> metrics, importances
``forecast_csv``  the same from a folder of station CSV files
``literature``    documents (+ metadata) -> TF-IDF -> maps, LOF, topics, enriched table
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from zonelens.operators import clean, drivers as drv
from zonelens.operators import embed, forecast as fc, layout, neighbours as nb, profile, sample, sparse, stats
from zonelens.operators import text as tx, timeseries as ts, zones as zn
from zonelens.session import release
from zonelens.sources import files


def zones(readings: DataFrame, measures: Sequence[str], *, key: str = "district",
          scale: Mapping[str, float] | None = None, ks: Sequence[int] = (3, 4, 5), cap: float = 0.95,
          seed: int = 42, low: float = 0.0, high: float = 1000.0) -> zn.ZonesResult:
    prof = profile.district_profile(readings, measures, key=key, scale=scale, low=low, high=high)
    cols = [f"{m}_avg" for m in measures]
    capped = stats.winsorize(prof, cols, cap, drop_null=key)
    extra = f"{next(iter(scale))}_avg" if scale else None
    return zn.zones(capped, cols, key=key, ks=ks, seed=seed, names=list(measures), extra_mean=extra)


def drivers(readings: DataFrame, measures: Sequence[str], *, keys: Sequence[str] = ("district", "year", "hour"),
            scale: Mapping[str, float] | None = None, fraction: float | None = None,
            max_rows: int | None = None, k: int | None = None) -> drv.PcaResult:
    """PCA of the hourly vectors.  ``fraction`` (of the readings, before the pivot) and
    ``max_rows`` (of the vectors) sample in the original's order, deterministically: by hash
    of the whole row, and by hash-ordered limit.  By default every reading is used, which
    costs one aggregate more, not more memory."""
    if fraction is not None:
        readings = sample.hash_sample(readings, readings.columns, fraction)
    vec = profile.hourly_vectors(readings, measures, keys=keys, scale=scale)
    if max_rows is not None:
        vec = sample.hash_limit(vec, list(keys), max_rows)
    return drv.pca(vec, list(measures), k=k)


@dataclass
class Correlations:
    matrix: DataFrame
    top: DataFrame


def correlations(readings: DataFrame, measures: Sequence[str], *, keys: Sequence[str] = ("location", "datetime"),
                 grain: str | None = None, required: Sequence[str] | None = None, top: int = 5) -> Correlations:
    vec = profile.concurrent_vectors(readings, measures, keys=keys, grain=grain, required=required)
    m = stats.correlation_matrix(vec, list(measures))
    return Correlations(m, stats.top_pairs(m, "r", list(measures), top))


@dataclass
class Forecast:
    metrics: DataFrame
    importances: DataFrame
    predictions: DataFrame
    model: fc.ForecastResult


def forecast(stations: DataFrame, spec: ts.SeriesSpec = ts.SeriesSpec(), *, split: float = 0.8,
             num_trees: int = 100, max_depth: int = 10, seed: int = 42) -> Forecast:
    """Reference form with ``spec.leak_free=False``; ``SeriesSpec(leak_free=True)`` gives
    features that never see the current target."""
    frame = ts.model_frame(stations, spec, train_fraction=split)
    names = ts.feature_names(frame, spec)
    res = fc.fit_forecast(frame, names, label=spec.target, num_trees=num_trees, max_depth=max_depth, seed=seed,
                          order=(spec.key, spec.time), fit_features_on_train=spec.leak_free)
    preds = res.predictions()
    return Forecast(fc.regression_metrics(preds, spec.target, "prediction"),
                    res.importances(stations.sparkSession), preds, res)


def forecast_csv(spark: SparkSession, path: str, spec: ts.SeriesSpec = ts.SeriesSpec(), *, sep: str = ",", **how) -> Forecast:
    """``forecast`` of a folder of station CSV files, columns matched by name whatever their order: all but the
    key and the time become numbers (bad text: null), the time is parsed (bad text: null)."""
    keys = [spec.key, spec.time]
    stations = clean.parse_time(clean.cast_measures(files.read_csv_dir(spark, path, keys, sep=sep), keys), spec.time)
    return forecast(zn.checkpointed(stations), spec, **how)


@dataclass
class Literature:
    vocabulary: DataFrame
    postings: DataFrame
    doc_map: DataFrame
    neighbour_map: DataFrame
    outliers: DataFrame
    topics: DataFrame
    topic_terms: DataFrame
    report: DataFrame


def literature(documents: DataFrame, metadata: DataFrame | None = None, *, lang: str | None = None,
               max_features: int = 5000, min_df: int = 3, max_df: float = 0.9, n_neighbors: int = 20,
               contamination: float = 0.1, n_topics: int = 5, components: int = 50, seed: int = 42,
               partitions: int | None = None) -> Literature:
    spark = documents.sparkSession
    docs = tx.corpus(documents, lang=lang, partitions=partitions)
    if metadata is not None:  # the corpus is the documents that have metadata
        docs = docs.join(metadata.select("doc_id").distinct(), "doc_id")
    enc = tx.encoded(docs)
    proc = enc.docs.select("doc_id")
    res = tx.tfidf(enc, min_df=min_df, max_df=max_df, max_features=max_features)
    vocab = res.vocabulary
    postings = zn.checkpointed(res.postings)
    rows = zn.checkpointed(tx.sparse_rows(postings, proc))
    release(spark)
    emb = embed.randomized_pca(rows, vocab.count(), k=components, seed=seed, written=True)
    dmap = emb.scores.selectExpr("doc_id", "embedding[0] AS map_x", "embedding[1] AS map_y")
    k = min(n_neighbors, proc.count() - 1)
    neigh = zn.checkpointed(sparse.sparse_knn(rows, k, vocab.count()))
    release(spark)
    at = layout.graph_layout(neigh, emb.scores.selectExpr("doc_id AS id", "embedding AS vec"))
    nmap = at.selectExpr("id AS doc_id", "xy[0] AS map_x", "xy[1] AS map_y")
    outliers = nb.flag_outliers(nb.lof(neigh, k).withColumnRenamed("id", "doc_id"), contamination)
    topics, model = zn.topics(rows, vocab.count(), k=n_topics, seed=seed)
    report = dmap.join(outliers, "doc_id").join(topics, "doc_id")
    if metadata is not None:
        report = tx.join_metadata(report, metadata)
    return Literature(vocab, postings, dmap, nmap, outliers, topics, zn.topic_terms(spark, model, vocab), report)
