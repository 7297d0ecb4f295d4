"""Where scratch data may go: the shared checkpoint folder, never a local one
on a cluster (stand-in session objects, no Spark needed)."""

from __future__ import annotations

import pytest

from tidyframe.session import checkpoint_root, scratch_path


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, ckpt=None):
        self.master, self.ckpt = master, ckpt

    def getCheckpointDir(self):
        return self.ckpt

    def setCheckpointDir(self, path):
        self.ckpt = "file:" + path


class _Session:
    def __init__(self, master="local[4]", ckpt=None, conf=None, connect=False):
        self._sc = None if connect else _Context(master, ckpt)
        self.conf = _Conf(conf or {})

    @property
    def sparkContext(self):
        if self._sc is None:
            raise RuntimeError("no SparkContext in Spark Connect")
        return self._sc


def test_uses_existing_checkpoint_dir():
    s = _Session(ckpt="hdfs://nn/ckpt/abc/")
    assert checkpoint_root(s) == "hdfs://nn/ckpt/abc"
    assert scratch_path(s, "x").startswith("hdfs://nn/ckpt/abc/tidyframe/x-")


def test_uses_conf_when_context_has_none():
    s = _Session(master="yarn", conf={"spark.checkpoint.dir": "s3a://bucket/ckpt"})
    assert checkpoint_root(s) == "file:s3a://bucket/ckpt"


def test_cluster_without_shared_folder_raises():
    with pytest.raises(RuntimeError, match="shared"):
        checkpoint_root(_Session(master="spark://host:7077"))


def test_local_mode_gets_a_fresh_local_folder():
    root = checkpoint_root(_Session(master="local[2]"))
    assert root.startswith("file:") and "tidyframe-ckpt-" in root


def test_spark_connect_reads_the_conf():
    s = _Session(connect=True, conf={"spark.checkpoint.dir": "/shared/ckpt/"})
    assert checkpoint_root(s) == "/shared/ckpt"
    with pytest.raises(RuntimeError):
        checkpoint_root(_Session(connect=True))
