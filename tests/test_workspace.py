from types import SimpleNamespace

import pytest

from recspark.sources.paths import exists
from recspark.workspace import discard, work_dir, written


def session(conf, master, checkpoint=None):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: checkpoint)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: conf.get(k, d)), sparkContext=context)


def test_folders_lie_under_the_shared_setting(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    a, b = work_dir(spark, "x"), work_dir(spark, "x")
    assert a != b and a.startswith(f"{base}/recspark/x-")


def test_a_cluster_needs_a_shared_folder():
    assert work_dir(session({"spark.checkpoint.dir": "hdfs://n/c/"}, "yarn"), "x").startswith("hdfs://n/c/recspark/x-")
    assert work_dir(session({}, "yarn", "hdfs://n/d"), "x").startswith("hdfs://n/d/recspark/x-")
    for local in ("/w", "file:/w"):
        with pytest.raises(RuntimeError):
            work_dir(session({"spark.sql.warehouse.dir": local}, "yarn"), "x")
        assert work_dir(session({"spark.sql.warehouse.dir": local}, "local[2]"), "x").startswith(f"{local}/recspark/x-")
    for shared in ("hdfs:/w", "s3a://b/w"):
        assert work_dir(session({"spark.sql.warehouse.dir": shared}, "yarn"), "x").startswith(f"{shared}/recspark/x-")


def test_a_written_table_reads_back(spark):
    df = spark.createDataFrame([(1, "a"), (None, None)], "n int, t string")
    assert sorted(map(str, written(df, "t").collect())) == sorted(map(str, df.collect()))
    assert written(df.limit(0), "t").schema == df.schema


def test_a_discarded_table_is_gone(spark):
    a, b = written(spark.range(3), "t"), written(spark.range(4), "t")
    discard(a)
    assert not exists(spark, a._written_at) and b.count() == 4
