"""Session helpers: shared checkpoint folder handling."""

import pytest

from kiln.session import ensure_checkpoint_dir


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value if key == "spark.checkpoint.dir" else default


class _Context:
    def __init__(self, master, conf_dir=None):
        self.master = master
        self._conf = _Conf(conf_dir)
        self.dir = None

    def getCheckpointDir(self):
        return self.dir

    def getConf(self):
        return self._conf

    def setCheckpointDir(self, d):
        self.dir = d


class _Session:
    def __init__(self, sc):
        self.sparkContext = sc


def test_cluster_session_without_shared_folder_is_refused():
    for master in ("yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            ensure_checkpoint_dir(_Session(_Context(master)))


def test_named_shared_folder_is_used_as_is():
    sc = _Context("yarn", conf_dir="s3a://bucket/checkpoints")
    assert ensure_checkpoint_dir(_Session(sc)) == "s3a://bucket/checkpoints"


def test_local_session_gets_scratch_only_when_unset():
    sc = _Context("local[2]")
    d = ensure_checkpoint_dir(_Session(sc))
    assert d and "kiln-ckpt-" in d
