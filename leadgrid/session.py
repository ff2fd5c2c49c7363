"""Session settings and the shared folders that long jobs write to."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

# Folder of a local test run, and the folders written so far, per application.
_LOCAL_DIRS: dict[str, str] = {}
_WRITTEN: dict[str, list[str]] = {}


def build_session(app: str = "leadgrid", master: str | None = None,
                  shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Session for tests and the bench. What is set here comes before the submitter's settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's ``spark.checkpoint.dir``.

    Only when the setting is absent (a local test run) is a temporary folder made.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not configured:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        app = spark.sparkContext.applicationId
        configured = _LOCAL_DIRS.setdefault(app, "") or tempfile.mkdtemp(prefix="leadgrid-")
        _LOCAL_DIRS[app] = configured
    return configured


def fresh_path(spark: SparkSession, name: str) -> str:
    """New, never reused path under the shared folder."""
    path = os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether a path is a folder, in any store that Spark reads."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).isDirectory()


def remove_intermediate(spark: SparkSession) -> None:
    """Delete everything written under fresh paths so far; results that still read it must be done."""
    paths = _WRITTEN.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        store, folder = fs.FileSystem.from_uri(path)
        if store.get_file_info(folder).type == fs.FileType.Directory:
            store.delete_dir(folder)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder; survives the loss of any executor."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back.

    For results that several branches read: computed once, column-pruned by each reader, and
    still there when executors are lost.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
