"""Channel and term settings. They are small by nature; shape is checked on read."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plateia import defaults, schemas
from plateia.functions.text import fold

Entries = Sequence[Mapping[str, str]]


def _read_entries(
    spark: SparkSession, path: str, schema: T.StructType, key: str
) -> list[dict[str, str]]:
    rows = (
        spark.read.schema(schema)
        .json(path, multiLine=True, mode="FAILFAST")
        .select(key)
        .collect()
    )
    if len(rows) != 1 or rows[0][key] is None:
        raise ValueError(f"{path} must hold one object with a list under '{key}'")
    return [entry.asDict() for entry in rows[0][key]]


def read_channels(spark: SparkSession, path: str) -> list[dict[str, str]]:
    return _read_entries(spark, path, schemas.CHANNELS_FILE, "channels")


def read_channels_if_any(spark: SparkSession, path: str) -> list[dict[str, str]]:
    """The channel settings, or none where the file is absent or unreadable.

    Without settings every source is of unknown category, so that every video is
    judged by its terms. Use it where a run must not stop for its settings.
    """
    try:
        return read_channels(spark, path)
    except (PySparkException, Py4JJavaError, ValueError):
        return []


def read_terms(spark: SparkSession, path: str) -> list[dict[str, str]]:
    return _read_entries(spark, path, schemas.TERMS_FILE, "relevance_terms")


def _local(spark: SparkSession, names: Sequence[str], rows: list[tuple]) -> DataFrame:
    """Text rows as a local relation, whose exact size the planner knows.

    It broadcasts them only below its size limit, and then a join on them
    shuffles nothing.
    """
    columns = {name: pa.array([row[i] for row in rows], pa.string()) for i, name in enumerate(names)}
    return spark.createDataFrame(pa.table(columns))


def channel_table(spark: SparkSession, channels: Entries) -> DataFrame:
    """One row per source; a later entry of the same source replaces an earlier one."""
    unique = {entry["source"]: entry for entry in channels}
    return _local(
        spark,
        ("source", "category", "identifier"),
        [(e["source"], e["category"], e.get("identifier")) for e in unique.values()],
    )


def term_table(spark: SparkSession, terms: Entries) -> DataFrame:
    """Configured terms as rows, with the term folded the way texts are."""
    rows = [(e["type"], e["label"], fold(e["term"])) for e in terms]
    return _local(spark, ("tipo", "rotulo", "termo"), rows)


def identifier_kind(identifier: Column) -> Column:
    """'id' for UC… channel ids, 'handle' for @… names, NULL for anything else."""
    return F.when(identifier.startswith("UC"), "id").when(identifier.startswith("@"), "handle")


def check_identifiers(channels: Entries) -> None:
    for entry in channels:
        if not str(entry["identifier"]).startswith(("UC", "@")):
            raise ValueError(f"invalid channel identifier {entry['identifier']!r}")


def write_run_settings(
    spark: SparkSession,
    root: str,
    run_id: str,
    channels: Entries | None = None,
    terms: Entries | None = None,
) -> tuple[Entries, Entries]:
    """Effective settings of a run, the overrides or else the defaults, kept with the run."""
    effective = (
        defaults.CHANNELS if channels is None else channels,
        defaults.RELEVANCE_TERMS if terms is None else terms,
    )
    check_identifiers(effective[0])
    for name, schema, entries in (
        ("channels", schemas.CHANNELS_FILE, effective[0]),
        ("relevance_terms", schemas.TERMS_FILE, effective[1]),
    ):
        fields = schema[name].dataType.elementType.names
        row = [tuple(entry.get(field) for field in fields) for entry in entries]
        spark.createDataFrame([(row,)], schema).coalesce(1).write.mode("overwrite").json(
            f"{root}/config/{name}/run_id={run_id}"
        )
    return effective
