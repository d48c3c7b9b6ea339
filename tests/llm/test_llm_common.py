"""Where stored steps lie."""

from types import SimpleNamespace

import pytest

from flightlake.llm import common


class Context:
    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def session(master, named=None):
    conf = SimpleNamespace(get=lambda key, default=None: named or default)
    return SimpleNamespace(sparkContext=Context(master), conf=conf)


@pytest.mark.parametrize("master", ["local-cluster[3,2,1024]", "yarn", "spark://host:7077"])
def test_a_cluster_needs_a_named_folder(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_folder(session(master))
    assert common.shared_folder(session(master, "s3a://bucket/shared")) == "s3a://bucket/shared"


@pytest.mark.parametrize("master", ["local", "local[8]", "local[*]"])
def test_one_machine_takes_a_temporary_one(master):
    assert common.shared_folder(session(master))
