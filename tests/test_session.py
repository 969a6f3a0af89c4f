"""Checkpoint folders: shared on a cluster, own ones only in local sessions."""

import pytest

from pitlane.session import ensure_checkpoint_dir


class Conf(dict):
    pass


class Context:
    def __init__(self, master, path=None):
        self.master, self.path, self.set_to = master, path, None

    def getCheckpointDir(self):
        return self.set_to

    def getConf(self):
        return Conf({"spark.checkpoint.dir": self.path} if self.path else {})

    def setCheckpointDir(self, path):
        self.set_to = path


class Session:
    def __init__(self, *a):
        self.sparkContext = Context(*a)


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://host", "local-cluster[3,2,1024]"])
def test_cluster_without_a_folder_raises(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session(master))


def test_named_folder_is_used_and_local_sessions_get_one():
    assert ensure_checkpoint_dir(Session("yarn", "hdfs://shared/x")) == "hdfs://shared/x"
    for master in ("local", "local[*]", "local[8]", "local[4, 2]"):
        assert "pitlane-ckpt-" in ensure_checkpoint_dir(Session(master))
