"""Zone clustering: scaled profiles, k-means for several k, silhouette choice of k,
cluster report.  Also the k-means topics of a document collection.

Iterative fits read a checkpointed input: every k-means round and the silhouette
passes re-read the vectors, and the reliable checkpoint (in the shared checkpoint
folder) cuts the lineage so a lost executor does not replay the profile aggregation.
All k share the rounds (see ``lloyd``); the scaler is fitted once and the winning centres are kept, not refitted."""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonelens.operators.lloyd import Clusters, assigned, joint_kmeans, silhouettes
from zonelens.operators.profile import measure_argmax
from zonelens.session import shared_dir


def checkpointed(df: DataFrame, key: str | Sequence[str] | None = None, partitions: int | None = None) -> DataFrame:
    """A fixed layout (hash on the key, sorted) written as a reliable checkpoint: fits
    become reproducible run to run and the lineage is cut."""
    shared_dir(df.sparkSession)
    if key is not None:
        keys = [key] if isinstance(key, str) else list(key)
        n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        df = df.repartition(n, *keys).sortWithinPartitions(*keys)
    return df.checkpoint(eager=True)


@dataclass
class ZonesResult:
    scores: DataFrame    # k, silhouette, chosen
    members: DataFrame   # key, cluster
    report: DataFrame    # cluster, size, <feature> means, dominant_measure, dominant_value, <scaled> mean
    model: Clusters
    best_k: int


def zones(profile: DataFrame, features: Sequence[str], *, key: str = "district", ks: Sequence[int] = (3, 4, 5),
          seed: int = 42, names: Sequence[str] | None = None, extra_mean: str | None = None) -> ZonesResult:
    """K-means on standardised feature columns for each k; the k with the highest
    silhouette wins (ties: the smaller k, the first maximum)."""
    spark = profile.sparkSession
    vec = VectorAssembler(inputCols=list(features), outputCol="features").transform(profile)
    scaler = StandardScaler(inputCol="features", outputCol="scaled_features", withMean=True, withStd=True)
    scaled = scaler.fit(vec).transform(vec).select(key, *features, F.array(*[F.lit(i) for i in range(len(features))]).alias("idx"),
                                                   vector_to_array("scaled_features").alias("w"))
    scaled = checkpointed(scaled)
    fitted = joint_kmeans(scaled, len(features), ks, key=key, seed=seed)
    candidates = spark.createDataFrame([(int(k), s) for k, s in silhouettes(scaled, fitted).items()], "k int, silhouette double")
    best_k = candidates.orderBy(F.col("silhouette").desc(), "k").first()["k"]
    scores = candidates.withColumn("chosen", F.col("k") == best_k)
    clustered = assigned(scaled, fitted[best_k])
    members = clustered.select(key, "cluster")
    return ZonesResult(scores, members, cluster_report(clustered, features, names=names, extra_mean=extra_mean),
                       fitted[best_k], best_k)


def cluster_report(clustered: DataFrame, features: Sequence[str], *, names: Sequence[str] | None = None,
                   extra_mean: str | None = None) -> DataFrame:
    """Per cluster: size, mean of every feature, dominant feature (largest mean, ties:
    first listed) and its value, and optionally the mean of one more feature.  Member
    lists are not collected into one row (a cluster may hold a large share of all keys):
    they are the ``members`` table."""
    means = [F.avg(c).alias(f"avg_{c}") for c in features]
    rep = clustered.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"), *means)
    name, top = measure_argmax([f"avg_{c}" for c in features], names or list(features))
    cols = [F.col("cluster"), F.col("size"), *[F.col(f"avg_{c}") for c in features],
            name.alias("dominant_measure"), top.alias("dominant_value")]
    if extra_mean is not None:
        cols.append(F.col(f"avg_{extra_mean}").alias(f"mean_{extra_mean}"))
    return rep.select(*cols)


def topics(rows: DataFrame, n_terms: int, *, k: int = 5, seed: int = 42, key: str = "doc_id") -> tuple[DataFrame, Clusters]:
    """K-means topics on (unit-length) document vectors, as written sparse rows (id, idx, w): (doc_id, cluster) and the centres."""
    model = joint_kmeans(rows, n_terms, [k], seed=seed)[k]
    return assigned(rows.select("id", "idx", "w"), model).withColumnRenamed("id", key), model


def topic_terms(spark, model: Clusters, vocab: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` heaviest terms of every centroid (k x V centroid values and the
    vocabulary are bounded by k and ``max_features``)."""
    import numpy as np

    terms = [r["term"] for r in vocab.select("term").orderBy("term_index").collect()]
    rows = []
    for c, centre in enumerate(model.clusterCenters()):
        order = np.argsort(-np.asarray(centre), kind="stable")[:n]
        rows += [(c, r + 1, terms[i], float(centre[i])) for r, i in enumerate(order)]
    return spark.createDataFrame(rows, "cluster int, rank int, term string, weight double")
