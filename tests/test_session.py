import pytest
from pyspark.sql import functions as F

from ratestar import session


class Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class Session:
    def __init__(self, master, conf=None, folder=None):
        self.sparkContext = Context(master, folder)
        self.conf = {"spark.checkpoint.dir": conf} if conf else {}


def test_named_folder_is_used():
    assert session.checkpoint_folder(Session("yarn", conf="hdfs://shared")) == "hdfs://shared"
    assert session.checkpoint_folder(Session("yarn", folder="hdfs://set")) == "hdfs://set"


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_folder(Session("spark://host"))


def test_local_runs_get_a_folder_of_their_own():
    local = Session("local[2]")
    assert session.checkpoint_folder(local) == local.sparkContext.folder


def test_settings(spark):
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"


def test_cut_lineage_reads_from_files(spark):
    df = session.cut_lineage(spark.range(5))
    assert df.count() == 5
    assert "ExistingRDD" in df._jdf.queryExecution().executedPlan().toString()


def test_estimates_of_frames_made_of_each_other_stay_small(spark):
    """That of a join is the product of both sides, so it would have 100 bits after four turns and twice as many after each more."""
    df = session.cut_lineage(spark.range(5))
    for _ in range(4):
        df = session.cut_lineage(df.join(df.withColumnRenamed("id", "other"), F.col("id") == F.col("other")).select("id"))
    assert df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() <= 2 ** 63 - 1
    assert sorted(r["id"] for r in df.collect()) == [0, 1, 2, 3, 4]
    assert "ExistingRDD" in df._jdf.queryExecution().executedPlan().toString()
