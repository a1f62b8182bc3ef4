from types import SimpleNamespace

import pytest

from relata import session


class Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def fake(master, named=None, folder=None):
    settings = {"spark.checkpoint.dir": named}
    conf = SimpleNamespace(get=lambda key, default=None: settings.get(key) or default)
    return SimpleNamespace(conf=conf, sparkContext=Context(master, folder))


def test_the_named_folder_is_used():
    spark = fake("yarn", "hdfs://shared/checkpoints/")
    assert session.shared_folder(spark) == "hdfs://shared/checkpoints"
    assert spark.sparkContext.folder == "hdfs://shared/checkpoints/"
    assert session.scratch_path(spark, "csv").startswith("hdfs://shared/checkpoints/csv-")


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(fake("spark://head:7077"))


def test_local_mode_makes_its_own():
    spark = fake("local[2]")
    assert session.shared_folder(spark) == spark.sparkContext.folder


def test_partitions_follow_the_input(spark):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    try:
        session.configure(spark, input_bytes=100 * 10**12)
        assert int(spark.conf.get(key)) == -(-100 * 10**12 // session.PARTITION_BYTES)
        session.configure(spark, input_bytes=1000)
        assert spark.conf.get(key) == "8"
    finally:
        spark.conf.unset(key)
