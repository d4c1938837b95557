"""Session settings and lineage cutting shared by all jobs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators count on. Sizes (shuffle partitions, memory, split
# size) belong to the cluster and are left to the caller.
_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators count on to a running session."""
    for key, value in _SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder of the session.

    A cluster names a shared folder in ``spark.checkpoint.dir``. Only a local
    master, where there is one machine, may fall back to a temporary folder.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get(
        "spark.checkpoint.dir"
    )
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError(
                "iterative jobs need spark.checkpoint.dir to name a shared folder"
            )
        folder = tempfile.mkdtemp(prefix="sightline-checkpoint-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def cut(frame: DataFrame) -> DataFrame:
    """Write ``frame`` as a table in the checkpoint folder and read it back.

    The loss of an executor then never sends a loop back to its first round.
    A table is used rather than an RDD checkpoint because that one keeps the
    size estimate of the plan it replaces: in a loop of joins the estimates
    multiply until planning itself does not end. A table has its true size,
    which is also what the choice of broadcast joins should go by.
    """
    spark = frame.sparkSession
    application = spark.sparkContext.applicationId
    path = f"{ensure_checkpoint_dir(spark)}/sightline-{application}/{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
