"""Checkpoint folder policy: the session's folder is used; a cluster without one is refused."""

import pytest

from basket.session import checkpoint_dir, ensure_checkpoint_dir


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Ctx:
    def getCheckpointDir(self):
        return None

    def setCheckpointDir(self, d):  # pragma: no cover - must not be reached
        raise AssertionError("a cluster must not get a local folder")


class _Session:
    def __init__(self, values):
        self.conf = _Conf(values)
        self.sparkContext = _Ctx()


def test_named_folder_is_used():
    s = _Session({"spark.checkpoint.dir": "hdfs://shared/ckpt", "spark.master": "yarn"})
    assert ensure_checkpoint_dir(s) == "hdfs://shared/ckpt"


def test_cluster_without_folder_is_refused():
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(_Session({"spark.master": "yarn"}))


def test_real_session_has_one(spark):
    assert checkpoint_dir(spark)
