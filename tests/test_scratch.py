import os

import pytest

from zonelens.operators.neighbours import checkpointed
from zonelens.plans import q_io
from zonelens.session import scratch, shared_dir

SF = "/root/testdata/sf0.001"


def local(path):
    return path.removeprefix("file:")


def held(path):
    return sum(len(names) for _, _, names in os.walk(local(path)))


def test_scope_deletes_checkpoints_and_staging_tables(spark, tmp_path):
    before = checkpointed(spark.range(5))
    outer = shared_dir(spark)
    had = held(outer)
    with scratch(spark) as folder:
        assert shared_dir(spark).startswith(folder)
        checkpointed(spark.range(10)).write.parquet(f"file://{tmp_path}/ten")
        q_io.sink_csv_roundtrip(spark, SF).write.parquet(f"file://{tmp_path}/profile")
        assert held(folder) > 0
    assert not os.path.exists(local(folder)) and held(outer) == had
    assert spark.read.parquet(f"file://{tmp_path}/ten").count() == 10 and spark.read.parquet(f"file://{tmp_path}/profile").count() > 0
    assert before.count() == 5 and checkpointed(spark.range(3)).count() == 3


def test_scope_deletes_after_an_error_and_nests(spark):
    with pytest.raises(ValueError):
        with scratch(spark) as outer:
            with scratch(spark) as inner:
                checkpointed(spark.range(3))
            assert local(inner).startswith(local(outer)) and not os.path.exists(local(inner))
            checkpointed(spark.range(3))
            raise ValueError
    assert not os.path.exists(local(outer))


def test_shuffle_files_go_when_no_frame_refers_to_them(spark):
    """A driver with free memory collects nothing for long; what a step shuffled must not stay beside the next one's."""
    import glob
    import time

    from zonelens import session

    jc = spark.sparkContext._jsc.sc()
    dirs = [str(d) for d in jc.env().blockManager().diskBlockManager().localDirsString()]
    held = lambda: {f for d in dirs for f in glob.glob(f"{d}/**/shuffle_*.data", recursive=True)}
    session.release(spark)
    time.sleep(1)
    before = held()
    written = spark.range(20000).repartition(3, "id").checkpoint()
    assert held() - before
    for _ in range(10):  # the cleaner works on its own thread
        session.release(spark)
        time.sleep(0.5)
        if not held() - before:
            break
    assert not held() - before and written.count() == 20000
