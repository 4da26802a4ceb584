"""Parquet tables in parts, of which a commit replaces some and leaves the rest as they are.

    <path>/data/<version>/part=<part>/   rows of the parts that this version replaced
    <path>/commits/<version>/            which version holds each part

A version exists once its commit folder has Spark's success marker; until then readers
see the version before, whole. Commits list parts, not rows, so what the driver reads
and lists is bounded by the number of parts. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plateia import schemas
from plateia.operators.latest import SNAPSHOT_ORDER, keep_latest
from plateia.session import small_tasks
from plateia.sources.runs import place_of


class PartTable:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path, schema

    def _names(self, folder: str) -> list[str]:
        place, store = place_of(self.spark, folder)
        return [found.getPath().getName() for found in store.listStatus(place)] if store.exists(place) else []

    def version(self) -> int:
        """The newest committed version, 0 before the first."""

        def done(name: str) -> bool:
            marker, store = place_of(self.spark, f"{self.path}/commits/{name}/_SUCCESS")
            return store.exists(marker)

        return max((int(name) for name in self._names(f"{self.path}/commits") if done(name)), default=0)

    def index(self, version: int | None = None) -> dict[str, int]:
        """The version that holds each part."""
        version = self.version() if version is None else version
        if not version:
            return {}
        listed = self.spark.read.schema("part STRING, version INT").json(f"{self.path}/commits/{version}")
        return {row.part: row.version for row in listed.collect()}

    def changed(self, old: int, new: int) -> set[str]:
        """Parts that differ between two versions."""
        before, after = self.index(old), self.index(new)
        return {part for part in before | after if before.get(part) != after.get(part)}

    def read(self, parts: Collection[str] | None = None, version: int | None = None) -> DataFrame:
        """Rows of all parts or some, now or at an earlier version."""
        folders = [
            f"{self.path}/data/{held}/part={part}"
            for part, held in self.index(version).items()
            if parts is None or part in parts
        ]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def commit(self, version: int, rows: DataFrame, part: Column, touched: Collection[str]) -> None:
        """Make ``rows`` the whole content of the touched parts; parts left without rows go.

        Large parts are split into several files by adaptive planning. Rows of a task are
        sorted by part, so tasks are kept small.
        """
        if version <= self.version():
            raise ValueError(f"version {version} of {self.path} is committed already")
        old = {p: held for p, held in self.index().items() if p not in touched}
        folder = f"{self.path}/data/{version}"
        placed = schemas.conform(rows, self.schema).withColumn("part", part)
        with small_tasks(self.spark):
            placed.hint("rebalance", "part").write.mode("overwrite").partitionBy("part").parquet(folder)
        new = {name.removeprefix("part="): version for name in self._names(folder) if name.startswith("part=")}
        listed = self.spark.createDataFrame(sorted((old | new).items()), "part STRING, version INT")
        listed.coalesce(1).write.mode("overwrite").json(f"{self.path}/commits/{version}")


class LatestState:
    """The latest record of every key over all collections so far, in buckets of the key.

    A collection rewrites only the buckets its keys fall into. A record whose ``deleted``
    column is true stays in the state, so an older record that lands later cannot
    bring the key back, but is in no rows that are read. Merging a collection again
    changes no row.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        keys: Sequence[str],
        order: Sequence[str] = SNAPSHOT_ORDER,
        buckets: int = 256,
        deleted: str | None = None,
    ):
        self.table = PartTable(spark, path, schema)
        self.keys, self.order, self.deleted = list(keys), list(order), deleted
        self.bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("string")

    def merge(self, collection: DataFrame) -> int:
        """Take a collection in and return the new version. It is read twice: pass a written table."""
        rows = schemas.conform(collection, self.table.schema)
        touched = [row.part for row in rows.select(self.bucket.alias("part")).distinct().collect()]
        version = self.table.version()
        if not touched:
            return version
        merged = keep_latest(self.table.read(touched).unionByName(rows), self.keys, self.order)
        self.table.commit(version + 1, merged, self.bucket, touched)
        return version + 1

    def rows(self, parts: Collection[str] | None = None, version: int | None = None) -> DataFrame:
        rows = self.table.read(parts, version)
        return rows.filter(~F.coalesce(self.deleted, F.lit(False))) if self.deleted else rows
