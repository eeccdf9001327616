"""Session settings and shared-storage helpers."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str = "local[*]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and benches; on a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(master)
        .appName("ledgerspark")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share. Only where there is none in local mode (tests) one of our own is made, and removed at exit."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if not re.match(r"local(\[|$)", master):
        raise ValueError(f"spark.checkpoint.dir must name a folder that the driver and all executors of {master} share")
    folder = tempfile.mkdtemp(prefix="ledgerspark-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` as Parquet into the shared folder and read it back.

    The files outlive executors, so a lost executor costs only the tasks that ran on it.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.materialized_at = path
    return back


def discard(*frames: DataFrame) -> None:
    """Delete the files of materialized frames that nothing reads any more; other frames are left alone."""
    for df in frames:
        path = getattr(df, "materialized_at", None)
        if path:
            jvm = df.sparkSession._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package wherever the driver found it: send it along, once per context."""
    context = spark.sparkContext
    root = Path(__file__).resolve().parent
    if getattr(context, "_ledgerspark_shipped", False) or not root.is_dir():
        return
    folder = tempfile.mkdtemp(prefix="ledgerspark-package-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.addPyFile(shutil.make_archive(f"{folder}/ledgerspark", "zip", root.parent, root.name))
    context._ledgerspark_shipped = True
