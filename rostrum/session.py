"""SparkSession helpers.

The library never creates a session behind the caller's back; these helpers
are for tests, the bench and the command-line entry points.
"""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "rostrum") -> SparkSession:
    master = master or os.environ.get("ROSTRUM_MASTER", "local[*]")
    builder = (
        SparkSession.builder.master(master).appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("ROSTRUM_DRIVER_MEMORY", "8g"))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Per-call Python call-site capture costs several py4j round trips per
        # Column function; the rule sets build thousands of expressions.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share for intermediate tables.

    In this order: ``spark.checkpoint.dir`` of the session, then the folder
    that the user gave to ``sc.setCheckpointDir``. Neither is ever changed.
    Where both are unset, a local master (tests) gets one temporary folder for
    its life; on a cluster that is an error, because executors would not see
    a machine-local folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("set spark.checkpoint.dir (or call sc.setCheckpointDir) to a folder that "
                           "the driver and all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="rostrum-shared-"))
    return sc.getCheckpointDir().rstrip("/")


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def land(df: DataFrame, label: str = "t", tidy: bool = False) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage: the files outlive any executor, are compressed, and are
    read with column pruning and filter pushdown. With ``tidy`` Spark deletes
    the shuffle files of the write when it ends (``CLEANUP``, as the session
    has it again afterwards).
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/rostrum-{label}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    if tidy:
        spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if tidy:
            spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    landed = spark.read.schema(df.schema).parquet(path)
    landed._landed = path
    return landed


def forget(*tables: DataFrame) -> None:
    """Deletes tables that ``land`` returned (not frames made of them): when all that was made of them is written itself."""
    for table in tables:
        jvm = table.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(table._landed)
        path.getFileSystem(table.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
