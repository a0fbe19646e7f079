"""Where plans are cut: tables in the shared folder that the cluster names."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; a local one only where the setting is absent and all tasks run in this process, as in tests."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lectern-"))
        shared = spark.sparkContext.getCheckpointDir()
    return shared.rstrip("/")


def own_folder(spark: SparkSession) -> str:
    """What this application writes there."""
    return f"{folder(spark)}/lectern-{spark.sparkContext.applicationId}"


def cut(df: DataFrame, label: str) -> DataFrame:
    """df, written to the shared folder and read again."""
    path = f"{own_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """What runs inside drops its shuffle files when it ends, not when the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def clear(spark: SparkSession) -> None:
    """Deletes all that `cut` has written for this application. Results that are not written themselves are lost with it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(own_folder(spark))
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def kept(path: str) -> Callable[[DataFrame, str], DataFrame]:
    """`cut` for a run that may be broken off: what stands in the folder `path` under a label, written to its end, is read and not made again.

    Of what was written partly nothing is used. Another input needs another folder.
    """

    def cut_once(df: DataFrame, label: str) -> DataFrame:
        spark, place = df.sparkSession, f"{path.rstrip('/')}/{label}"
        done = spark._jvm.org.apache.hadoop.fs.Path(f"{place}/_SUCCESS")
        if not done.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(done):
            df.write.mode("overwrite").parquet(place)
        return spark.read.schema(df.schema).parquet(place)

    return cut_once
