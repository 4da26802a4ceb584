"""Run tables: one folder per layer, table and run, published by a pointer and listed in a manifest.

    <root>/<layer>/<table>/run_id=<run>/<attempt>/       the rows of one attempt
    <root>/published/<run>/<layer>.<table>/<attempt>     an empty file: this attempt is whole
    <root>/manifest/<run>/<layer>.<table>/               its row count, for complete runs

An attempt is written to a folder of its own, and then one empty file is created,
which stores do in one step. Readers follow the pointer with the highest number, so they
see the old table whole or the new one, never a mixture; those that planned on the
attempt before still find its files. One writer per run at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plateia import defaults, schemas
from plateia.functions.times import to_utc_lenient


def table_path(root: str, layer: str, name: str, run_id: str) -> str:
    return f"{root}/{layer}/{name}/run_id={run_id}"


def place_of(spark: SparkSession, path: str):
    """A path and the store it is in, whichever store that is."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _published(spark: SparkSession, root: str, run_id: str, layer: str, name: str) -> list[str]:
    """Attempts of a table that were published, in order."""
    place, store = place_of(spark, f"{root}/published/{run_id}/{layer}.{name}")
    return sorted(f.getPath().getName() for f in store.listStatus(place)) if store.exists(place) else []


def _publish(spark: SparkSession, root: str, run_id: str, layer: str, name: str, attempt: str) -> None:
    pointer, store = place_of(spark, f"{root}/published/{run_id}/{layer}.{name}/{attempt}")
    store.create(pointer, False).close()


def _sweep(spark: SparkSession, root: str, run_id: str, layer: str, name: str, kept: Sequence[str]) -> None:
    """Delete attempts, and their pointers, that are not kept: older ones and those that failed."""
    for folder in (table_path(root, layer, name, run_id), f"{root}/published/{run_id}/{layer}.{name}"):
        place, store = place_of(spark, folder)
        for found in store.listStatus(place):
            if found.getPath().getName() not in kept:
                store.delete(found.getPath(), True)


def _entry(root: str, run_id: str, layer: str, name: str) -> str:
    return f"{root}/manifest/{run_id}/{layer}.{name}"


def withdraw_run(spark: SparkSession, root: str, run_id: str) -> None:
    """Take every entry of a run out of the manifest, before the run is repeated.

    Until the repeat has listed every table again, the run is not complete. Its
    published tables stay readable until each is replaced.
    """
    place, store = place_of(spark, f"{root}/manifest/{run_id}")
    store.delete(place, True)


def record(spark: SparkSession, root: str, layer: str, name: str, run_id: str, rows: int) -> None:
    """List a finished table. A repeated run replaces its own entry only."""
    entry = spark.createDataFrame(
        [(layer, run_id, name, rows)], "layer STRING, run_id STRING, file STRING, row_count BIGINT"
    )
    entry.withColumn("written_at", F.current_timestamp()).coalesce(1).write.mode(
        "overwrite"
    ).json(_entry(root, run_id, layer, name))


def write_run(
    df: DataFrame,
    root: str,
    layer: str,
    name: str,
    run_id: str,
    schema: T.StructType,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Write one table of a run and return it as read back, which also cuts its lineage.

    A table without rows is written too, with its schema. The attempt before this one
    stays, for readers that began with it; older ones go. The recorded count reads
    Parquet footers only.
    """
    spark = df.sparkSession
    place, store = place_of(spark, _entry(root, run_id, layer, name))
    store.delete(place, True)
    before = _published(spark, root, run_id, layer, name)
    number = int(before[-1].split("-")[0]) + 1 if before else 1
    attempt = f"{number:08d}-{uuid4().hex}"
    path = f"{table_path(root, layer, name, run_id)}/{attempt}"
    schemas.conform(df, schema).write.partitionBy(*partition_by).parquet(path)
    written = spark.read.schema(schema).parquet(path)
    rows = written.count()
    _publish(spark, root, run_id, layer, name, attempt)
    record(spark, root, layer, name, run_id, rows)
    _sweep(spark, root, run_id, layer, name, [*before[-1:], attempt])
    return written.select(*schema.names)


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    return (
        spark.read.schema(schemas.MANIFEST)
        .option("recursiveFileLookup", "true")
        .json(f"{root}/manifest")
    )


def complete_runs(
    manifest: DataFrame, required: Sequence[str] = defaults.REQUIRED_GOLD
) -> DataFrame:
    """Sorted ids of runs that have every required gold table and a silver layer."""
    gold = (
        manifest.filter((F.col("layer") == "gold") & F.col("file").isin(*required))
        .groupBy("run_id")
        .agg(F.count_distinct("file").alias("_files"))
        .filter(F.col("_files") == len(set(required)))
    )
    silver = manifest.filter(F.col("layer") == "silver")
    return gold.join(silver, "run_id", "left_semi").select("run_id").orderBy("run_id")


def latest_run(manifest: DataFrame, required: Sequence[str] = defaults.REQUIRED_GOLD) -> str:
    """The default run of the reports."""
    newest = complete_runs(manifest, required).agg(F.max("run_id")).first()[0]
    if newest is None:
        raise FileNotFoundError("no complete run; run the pipeline first")
    return newest


def run_counts(manifest: DataFrame) -> DataFrame:
    """Tables and rows per run and layer."""
    return manifest.groupBy("run_id", "layer").agg(
        F.count(F.lit(1)).alias("tables"), F.sum("row_count").alias("row_count")
    )


def read_run(
    spark: SparkSession, root: str, layer: str, name: str, run_id: str, schema: T.StructType
) -> DataFrame:
    """The published table of one run; no other run is listed or read."""
    attempts = _published(spark, root, run_id, layer, name)
    if not attempts:
        raise FileNotFoundError(f"run {run_id} has no {layer} table {name}")
    return spark.read.schema(schema).parquet(f"{table_path(root, layer, name, run_id)}/{attempts[-1]}")


def with_lenient_times(
    df: DataFrame, columns: Sequence[str] = ("published_at", "updated_at")
) -> DataFrame:
    """Parse the time columns that exist; text that is not a time becomes NULL."""
    present = [name for name in columns if name in df.columns]
    return df.withColumns({name: to_utc_lenient(F.col(name)) for name in present})
