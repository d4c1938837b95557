import pytest
from pyspark.sql import functions as F

from sightline import session
from sightline.graph.links import Links


def test_cut_writes_to_the_checkpoint_folder(spark):
    frame = spark.range(5).select("id", F.lit(None).cast("string").alias("x"))
    again = session.cut(frame)
    assert again.count() == 5 and again.dtypes == frame.dtypes
    folder = session.ensure_checkpoint_dir(spark)
    assert all(folder.split(":")[-1] in f for f in again.inputFiles())
    assert session.cut(frame.where("id < 0")).count() == 0


def test_a_cluster_must_name_a_shared_folder():
    class Context:
        master = "spark://somewhere"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_edges_are_not_shuffled_again_in_a_round(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        links = Links(spark.createDataFrame([(1, 2), (2, 3)], "src long, dst long"))
        states = session.cut(spark.createDataFrame([(1, 0.5), (2, 1.5)], "id long, rank double"))
        met = links.meet(states)
        plan = met._jdf.queryExecution().executedPlan().toString()
        edges_side = plan[: plan.index("InMemoryTableScan")]
        assert "Exchange" not in edges_side, plan
        assert met.count() == 2
        links.close()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
