"""The shared folder and what is kept there."""

import os

import pytest

from parcelflow import session


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Session:
    """Only what shared_dir asks of a session before it needs a file system."""

    def __init__(self, master):
        self.conf = _Conf({"spark.master": master})

    @property
    def sparkContext(self):
        raise RuntimeError("no context")


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[3,2,1024]", ""])
def test_cluster_without_shared_folder_is_refused(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(_Session(master))


def test_paths_carry_their_file_system_and_copies_are_discarded(spark):
    path = session.scratch_path(spark, "x")
    assert path.startswith("file:/")
    kept = session.materialised(spark.range(3), "kept")
    assert kept.count() == 3
    spark.range(2).write.parquet(path)
    local = path.replace("file:", "", 1)
    assert os.path.isdir(local)
    session.discard(spark, path)
    assert not os.path.exists(local)
    with pytest.raises(ValueError):
        session.discard(spark, "file:/tmp/elsewhere")
