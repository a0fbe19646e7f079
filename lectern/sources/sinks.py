"""Sinks: JSON lines as Spark writes them, one JSON array for small results, batches that a run can go on from."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines; nulls are written."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def export_array(df: DataFrame, path: str, indent: int = 4) -> int:
    """One UTF-8 file with a JSON array; rows come to the driver partition by partition. For results that are read as one file."""
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    n = 0
    with open(path, "w", encoding="utf-8") as out:
        out.write("[")
        for row in df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})).toLocalIterator():
            text = json.dumps(json.loads(row[0]), ensure_ascii=False, indent=indent)
            out.write((",\n" if n else "\n") + " " * indent + text.replace("\n", "\n" + " " * indent))
            n += 1
        out.write("\n]\n" if n else "]\n")
    return n


def write_batch(df: DataFrame, path: str, batch: str) -> None:
    """A batch of results beside those before it; a batch that is written again replaces itself only."""
    df.withColumn("batch", F.lit(batch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)
