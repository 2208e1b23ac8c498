"""Scratch-folder resolution: the session's checkpoint folder wins; a folder
of our own is registered only when none is configured."""

from __future__ import annotations

from aurum import session


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        assert key == "spark.checkpoint.dir"
        return self.value if self.value is not None else default

    def set(self, key, value):  # a running session rejects this
        raise AssertionError("must not set spark.checkpoint.dir at runtime")


class _Context:
    def __init__(self, current=None, master="local[*]"):
        self.current = current
        self.master = master

    def getCheckpointDir(self):
        return self.current

    def setCheckpointDir(self, d):
        self.current = d + "/uuid"


class _Spark:
    def __init__(self, conf, current=None, master="local[*]"):
        self.conf = _Conf(conf)
        self.sparkContext = _Context(current, master)


def test_configured_folder_is_used():
    assert session.checkpoint_root(_Spark("hdfs://nn/ckpt/")) == "hdfs://nn/ckpt"


def test_context_folder_is_used():
    assert session.checkpoint_root(_Spark(None, "file:/shared/x")) == "file:/shared/x"


def test_unset_registers_own_folder_once():
    s = _Spark(None)
    first = session.checkpoint_root(s)
    assert first.endswith("/uuid") and s.sparkContext.current == first
    assert session.checkpoint_root(s) == first
    assert session.scratch_path(s, "q").startswith(first + "/aurum-scratch/q-")


def test_unset_on_cluster_refuses_local_folder():
    import pytest
    with pytest.raises(ValueError, match="shared folder"):
        session.checkpoint_root(_Spark(None, master="yarn"))
