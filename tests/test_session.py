"""The shared folder for intermediate tables."""
import pytest

from rostrum.session import land, shared_folder


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value or default


class _Context:
    def __init__(self, master, folder):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class _Session:
    def __init__(self, conf, master="local[2]", folder=None):
        self.conf, self.sparkContext = _Conf(conf), _Context(master, folder)


def test_folder_by_setting_then_context_then_local():
    assert shared_folder(_Session("hdfs://x/a/", folder="/other")) == "hdfs://x/a"
    assert shared_folder(_Session(None, "spark://h:7077", "s3a://b/c")) == "s3a://b/c"
    local = _Session(None)
    first = shared_folder(local)
    assert first and shared_folder(local) == first
    with pytest.raises(RuntimeError):
        shared_folder(_Session(None, "spark://h:7077"))


def test_landed_table_keeps_rows_and_schema(spark):
    frame = spark.createDataFrame([(1, None), (None, "x")], "a long, b string")
    out = land(frame)
    assert out.schema == frame.schema and sorted(out.collect(), key=str) == sorted(frame.collect(), key=str)
