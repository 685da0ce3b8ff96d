"""Session helpers: a local session for tests/bench, and the shared scratch folder."""
from __future__ import annotations

import gc
import os
import sys
import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "zonelens") -> SparkSession:
    """A local session configured like the tests and the bench (UI off, UTC, AQE on)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide scratch folder named by ``spark.checkpoint.dir``.

    On a cluster this must be a shared file system (HDFS, object store).  Only when it
    is unset *and* Spark runs in local mode (tests, bench) a local folder is created and
    registered as the checkpoint directory.
    """
    sc = spark.sparkContext
    path = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if path:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(path)
        return path.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="zonelens-ckpt-")
    sc.setCheckpointDir(path)
    return path


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared scratch folder."""
    base = shared_dir(spark)
    sep = "" if base.endswith("/") else "/"
    return f"{base}{sep}zonelens-staging/{name}-{uuid.uuid4().hex[:12]}"


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files (and checkpoints, where it is set to) that no frame refers to any more.

    Its cleaner, a thread of its own, acts on what the driver's JVM has collected, which a driver with free memory puts off while the disks fill: for
    between two steps that each write about as much as the input."""
    for _ in range(2):  # what Python gave up is known to the JVM by the second time
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.2)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A scope that owns what is made inside it: checkpoints and staging tables go to a folder of their own below
    the shared one, which is deleted at the end, after errors too.

    Write results inside the scope; frames made in it cannot be read after it.  Checkpoints made before stay,
    and later ones go to the shared folder again.  Scopes may be nested, and must not overlap on threads."""
    sc = spark.sparkContext
    outer = shared_dir(spark)
    folder = f"{outer}/scope-{uuid.uuid4().hex[:12]}"
    sc.setCheckpointDir(folder)
    try:
        yield folder
    finally:
        sc.setCheckpointDir(sc.getConf().get("spark.checkpoint.dir", None) or outer.rsplit("/", 1)[0])
        path = sc._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def send_by_value(module_name: str) -> None:
    """A module's Python functions reach the workers by value, so that workers need not have this
    package on their path."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])
