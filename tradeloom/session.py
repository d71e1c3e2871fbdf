"""Session settings and the two helpers every job needs: written intermediates and checked broadcasts."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes, as the plan estimates them, up to which a table is sent to every executor.
BROADCAST_BYTES = 16 << 20


def build_session(app: str = "tradeloom", **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, for clusters on whose nodes it is not installed."""
    package = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="tradeloom-package-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/tradeloom", "zip", package.parent, package.name))


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, or the context's checkpoint folder.

    Only a local session without either gets a temporary folder of its own, which goes when Python ends.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="tradeloom-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def _scratch(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/tradeloom/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{_scratch(spark)}/{name}-{uuid.uuid4().hex}"


def release_scratch(spark: SparkSession) -> None:
    """Remove everything this application has materialized. Call it when the results are written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_scratch(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where two branches of a plan need the same expensive relation: it is computed once, survives
    the loss of executors, and both branches still prune columns and push filters into the files. What is
    written stays until ``release_scratch``, as nobody else can tell when the last reader is done.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_checked(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast only when the plan knows it to be small.

    The estimate is an upper bound that costs no job. Where it is too large, or unknown, the join stays an
    ordinary one, and Spark may still choose a broadcast from sizes it measures on the way.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return F.broadcast(df) if size <= max_bytes else df
