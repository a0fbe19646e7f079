"""What the operators of this subpackage share."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.readers import spread
from ..sources.scratch import cut, freed_shuffles  # noqa: F401

#: White space of the contracts: space, tab, line feed, vertical tab, form feed, carriage return.
WHITE = r"[\x20\x09-\x0D]+"
NOT_WHITE = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(rows) if name == "documents" else rows


@contextlib.contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Arrow batches of at most `rows` rows for what runs inside.

    Rows are whole texts here. Spark passes a batch on in direct memory, which is freed with the garbage only, so batches of 10,000 texts can
    take as much beside the heap as the heap has.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """df, written to the shared folder and read back: lineage ends there, and a lost executor takes nothing with it."""
    with small_batches(df.sparkSession):
        return cut(df, label)


def delete(written: DataFrame) -> None:
    """Deletes the folder that `written` was read from, once all that reads it is written itself."""
    jvm = written.sparkSession._jvm
    for place in {f.rpartition("/")[0] for f in written.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(place)
        path.getFileSystem(written.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *carry: str) -> DataFrame:
    """(doc_id, text) and the columns of carry of every row, whatever else the table holds; a null text counts as empty."""
    return docs.select(*carry, F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def one_space(text: Column) -> Column:
    """Each run of white space becomes one space. Runs that are a single space already are not matched, which saves most of the work."""
    return F.regexp_replace(text, r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def lower_ascii(text: Column) -> Column:
    """A-Z only, so that every engine agrees on the result."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fence(value: Column) -> Column:
    """value, in a form that the optimiser computes once, where it stands.

    A filter above would otherwise move below a projection with the expressions put in for its columns, and a column that a
    lambda reads would be computed for each element. Spark moves nothing past what it holds not to be deterministic, as the number of
    a partition.
    """
    return F.when(F.spark_partition_id() >= 0, value)


def in_slices(column, rows: int = 512):
    """The values of an Arrow column as lists of at most `rows`, so that few long texts are Python strings at a time."""
    for at in range(0, len(column), rows):
        yield column.slice(at, rows).to_pylist()


def constant_array(values: list[float]) -> Column:
    """A literal array<double>: one string that the optimiser folds, in place of a call to the JVM for each element."""
    return F.split(F.lit(",".join(f"{x:.9g}" for x in values)), ",").cast("array<double>")


def public_vocabulary(name: str) -> str:
    """Path of a public vocabulary file on this machine; called on the worker that reads it."""
    import public_tokenizers

    return public_tokenizers.path(name)
