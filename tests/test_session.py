import os
from types import SimpleNamespace

import pytest

from feedlens.session import checkpoint, discard, ensure_checkpoint_dir


def _session(master, folder=None):
    sc = SimpleNamespace(master=master, getCheckpointDir=lambda: None, getConf=lambda: SimpleNamespace(get=lambda k: folder),
                         set=[])
    sc.setCheckpointDir = sc.set.append
    return SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d=None: d))


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "k8s://x", "local-cluster[2,1,1024]"])
def test_cluster_without_a_shared_folder_is_an_error(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_session(master))


def test_the_named_folder_is_taken():
    s = _session("yarn", "hdfs://shared/x")
    ensure_checkpoint_dir(s)
    assert s.sparkContext.set == ["hdfs://shared/x"]


def test_discard_removes_the_table(spark):
    t = checkpoint(spark.range(10).toDF("x"), "test")
    path = t._feedlens_path.removeprefix("file:")
    assert t.count() == 10 and os.path.isdir(path)
    discard(t)
    assert not os.path.exists(path)


def test_checkpoint_leaves_settings_alone(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    checkpoint(spark.range(10).groupBy("id").count(), "test").collect()
    assert spark.conf.get(key) == before
