"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in spark.checkpoint.dir, deleted when the session ends; a local folder only where that is unset and Spark is one process."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _own:
            _own[app] = "file://" + tempfile.mkdtemp(prefix="spark-buzzmill-")
        shared = _own[app]
    path = f"{shared.rstrip('/')}/buzzmill/{label}-{uuid.uuid4().hex}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def stored(df: DataFrame, label: str) -> DataFrame:
    """df written as Parquet and read again: computed once, and safe when executors go."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
