from __future__ import annotations

import pytest

from assayer import session


class FakeContext:
    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class FakeSession:
    def __init__(self, master, folder=None):
        self.sparkContext, self.folder = FakeContext(master), folder

    @property
    def conf(self):
        return self

    def get(self, key, default=None):
        assert key == "spark.checkpoint.dir"
        return self.folder or default


def test_the_cluster_names_the_shared_folder():
    assert session.shared_dir(FakeSession("spark://h:1", "hdfs://n/shared/")) == "hdfs://n/shared"


def test_a_cluster_without_one_is_an_error():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(FakeSession("yarn"))


def test_a_local_master_gets_one_temporary_folder():
    local = FakeSession("local[2]")
    assert session.shared_dir(local) == session.shared_dir(local)


def test_paths_are_never_used_twice(spark):
    assert session.fresh_path(spark, "x") != session.fresh_path(spark, "x")
    assert session.fresh_path(spark, "x").startswith(session.shared_dir(spark))


def test_settings_of_a_session(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
