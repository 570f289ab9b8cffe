"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, **settings) -> SparkSession:
    """Session with the settings the package is tested with.

    On a cluster leave ``master`` unset and let spark-submit decide; any
    keyword (dots written as ``__``) is passed on as a Spark setting.
    """
    builder = (
        SparkSession.builder.appName("wardflow")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Call sites in error messages cost several milliseconds per column.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster.

    Only where it is unset and Spark runs on one machine (tests) a local folder
    is made and set as the checkpoint folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="wardflow-"))
        current = context.getCheckpointDir()
    return current


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return a scan of the files.

    For results with several consumers: it cuts the lineage, outlives lost
    executors, and unlike a checkpointed DataFrame later scans stay columnar.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/wardflow/{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
