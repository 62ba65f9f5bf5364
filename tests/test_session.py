"""Session helpers: the shared working folder."""

import pytest

from logloom import session


class _FakeConf:
    def get(self, key, default=None):
        return "hdfs://store/warehouse/" if key == "spark.sql.warehouse.dir" else default


class _FakeContext:
    master = "yarn"
    applicationId = "app-x"

    def getCheckpointDir(self):
        return None


class _FakeSession:
    conf = _FakeConf()
    sparkContext = _FakeContext()


def test_without_checkpoint_dir_the_shared_warehouse_is_used():
    assert session.checkpoint_root(_FakeSession()) == "hdfs://store/warehouse/_work"


def test_a_local_warehouse_is_no_working_folder_of_a_cluster(monkeypatch):
    for path in ("file:/home/x/spark-warehouse", "/home/x/spark-warehouse"):
        monkeypatch.setattr(_FakeConf, "get", lambda self, key, default=None: (
            path if key == "spark.sql.warehouse.dir" else default))
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.checkpoint_root(_FakeSession())
        monkeypatch.setattr(_FakeContext, "master", "local[4]")
        assert session.checkpoint_root(_FakeSession()) == path + "/_work"
        monkeypatch.setattr(_FakeContext, "master", "local-cluster[3,2,1000]")
        with pytest.raises(RuntimeError):
            session.checkpoint_root(_FakeSession())


def test_work_dirs_are_fresh_and_under_the_root(spark):
    root = session.checkpoint_root(spark)
    a = session.work_dir(spark, "t", unique=True)
    b = session.work_dir(spark, "t", unique=True)
    assert a != b and a.startswith(root) and b.startswith(root)
