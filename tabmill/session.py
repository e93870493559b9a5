"""Session construction and lineage cuts."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession


def get_session(master: str = "local[8]", shuffle_partitions: int = 8,
                app: str = "tabmill") -> SparkSession:
    """A session with AQE on, UTC time and no web UI.

    On a cluster the master, memory and checkpoint folder come from the
    submitter; this helper only fills in what is unset.
    """
    wanted = {
        "spark.master": master,
        "spark.app.name": app,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": "8g",
    }
    submitted = SparkConf()  # what spark-submit or spark-defaults gave
    builder = SparkSession.builder
    for key, value in wanted.items():
        if not submitted.contains(key):
            builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder for stage tables that driver and executors share:
    ``spark.checkpoint.dir``, else the folder given to
    ``setCheckpointDir``. A local master may go without (one temporary folder
    per session); anywhere else a missing folder is an error, as
    executors would each write to a disk of their own."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if path:
        return path
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = getattr(spark.sparkContext, "_tabmill_dir", None)
    if path is None:
        path = tempfile.mkdtemp(prefix="tabmill-ckpt-")
        spark.sparkContext._tabmill_dir = path
    return path


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut lineage by writing ``df`` as Parquet under the checkpoint folder
    and reading it back. Survives executor loss, unlike cache or local
    checkpoints, and later stages re-read only the columns they need."""
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/tabmill/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
