"""Session helpers: a local session for tests and the shared working folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", app: str = "riskweave") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def running_session() -> SparkSession:
    """The session at work. Threads that Python started have no active one of their own."""
    return SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()


#: Folders handed out in this process and not released yet.
_folders: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session without that setting gets a temporary folder of its own.
    """
    sc = spark.sparkContext
    configured = (
        spark.conf.get("spark.checkpoint.dir", None)
        or sc.getConf().get("spark.checkpoint.dir")
        or sc.getCheckpointDir()
    )
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="run-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one, there until it is released."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _folders.append(path)
    return path


def release(spark: SparkSession) -> int:
    """Delete all folders handed out so far; returns their number.

    For when the results that read them are written: derived tables are full copies, so a
    long-lived session calls this after each job.
    """
    n = len(_folders)
    while _folders:
        remove(spark, _folders.pop())
    return n


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder of the engine's own, if it is there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """Write a derived table to the shared folder once and read it from there.

    For tables that several passes need: later passes read only their columns, and a
    lost executor costs no recomputation of the lineage behind the table.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
