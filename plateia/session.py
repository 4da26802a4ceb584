"""Session settings the package relies on."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import SparkSession


#: What one Arrow batch may bring to a Python worker. Whole texts are long: by rows alone, or
#: Spark's 64 MB, a worker's memory grows with the table until its batches are full.
ARROW_BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}


def build_session(app: str = "plateia", master: str | None = None, **conf: object) -> SparkSession:
    """Session with UTC dates and adaptive planning.

    The shuffle partition count stays at Spark's or the cluster's choice unless
    given: adaptive planning merges small partitions, splits skewed join
    partitions and picks broadcast joins from measured sizes.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **ARROW_BATCHES,
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Dates, hours and weeks are UTC; a session of another owner may say otherwise."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def bound_batches(spark: SparkSession) -> SparkSession:
    """Batches of texts stay small in a session of another owner too; smaller ones are kept."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    # No limit is a number below 1.
    if not 0 < int(spark.conf.get(rows)) <= int(ARROW_BATCHES[rows]):
        for name, value in ARROW_BATCHES.items():
            spark.conf.set(name, value)
    return spark


#: What one task reads of narrow rows, compressed. Sorts and aggregates by nearly distinct keys
#: hold all of it at once, many times as large.
TASK_SIZES = {
    "spark.sql.files.maxPartitionBytes": "8m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
}


@contextmanager
def small_tasks(spark: SparkSession) -> Iterator[None]:
    """The jobs run within get more tasks as tables grow, not larger ones."""
    before = {name: spark.conf.get(name, None) for name in TASK_SIZES}
    for name, value in TASK_SIZES.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def new_shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which all executors reach.

    A local session may leave that unset and gets a temporary folder instead.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="plateia-")
    return f"{folder.rstrip('/')}/plateia/{name}-{uuid4().hex}"
