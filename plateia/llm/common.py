"""Shared folders and written intermediates."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_own_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    Only a local session, as in tests, may leave it unset; it gets a temporary
    folder, once.
    """
    folder, context = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext
    if folder:
        # With the scheme of its store, which file libraries of the workers need.
        place = context._jvm.org.apache.hadoop.fs.Path(folder)
        store = place.getFileSystem(context._jsc.hadoopConfiguration())
        return store.makeQualified(place).toString().rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    key = context.applicationId
    if key not in _own_folders:
        _own_folders[key] = "file://" + tempfile.mkdtemp(prefix="plateia-")
    return _own_folders[key]


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/plateia/{name}-{uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` as a table in the shared folder: evaluated once, lineage cut.

    Spark's commit protocol keeps the rows of one attempt per task, so lost
    executors and repeated tasks neither lose nor repeat rows.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.written_to = path
    return table


def discard(*tables: DataFrame) -> None:
    """Deletes tables of ``written`` that nothing reads any more: all that came of them is written too."""
    for table in tables:
        context = table.sparkSession.sparkContext
        place = context._jvm.org.apache.hadoop.fs.Path(table.written_to)
        place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


def only(df: DataFrame, **columns: str | Column) -> DataFrame:
    """Exactly the named columns, so that extra columns of an input cannot clash."""
    return df.select(*(F.col(c).alias(n) if isinstance(c, str) else c.alias(n) for n, c in columns.items()))
