"""A reader between two writes of a table sees the old one whole."""

import pytest
from pyspark.sql import functions as F

from plateia.sources import runs


def _rows(spark, count, value):
    return spark.range(0, count, 1, 4).select(F.lit(value).alias("v"))


def _failing(spark):
    """Some tasks write their rows, one fails."""
    value = F.when(F.col("id") == 999, F.raise_error(F.lit("lost")).cast("string")).otherwise("new")
    return spark.range(0, 1000, 1, 4).select(value.alias("v"))


def test_reader_between_two_writes(spark, tmp_path):
    root, schema = str(tmp_path), _rows(spark, 1, "x").schema
    write = lambda df: runs.write_run(df, root, "gold", "t", "R1", schema)
    read = lambda: runs.read_run(spark, root, "gold", "t", "R1", schema)
    write(_rows(spark, 10, "one"))
    planned = read()
    with pytest.raises(Exception, match="lost"):
        write(_failing(spark))
    assert {r.v for r in read().collect()} == {"one"} and read().count() == 10
    runs.withdraw_run(spark, root, "R1")
    assert read().count() == 10
    write(_rows(spark, 7, "two"))
    assert {r.v for r in read().collect()} == {"two"} and read().count() == 7
    assert [r.v for r in planned.collect()] == ["one"] * 10
    write(_rows(spark, 3, "three"))
    assert read().count() == 3
    # The newest attempt and the one before it are kept; the failed one is gone.
    assert len(list((tmp_path / "gold/t/run_id=R1").iterdir())) == 2
    manifest = runs.read_manifest(spark, root).collect()
    assert [(r.run_id, r.file, r.row_count) for r in manifest] == [("R1", "t", 3)]


def test_partitioned_tables_are_published_too(spark, tmp_path):
    df = spark.range(6).select(F.col("id").cast("string").alias("v"), (F.col("id") % 2).cast("string").alias("p"))
    for _ in range(2):
        runs.write_run(df, str(tmp_path), "silver", "t", "R", df.schema, partition_by=["p"])
    found = runs.read_run(spark, str(tmp_path), "silver", "t", "R", df.schema)
    assert sorted((r.v, r.p) for r in found.collect()) == [(str(i), str(i % 2)) for i in range(6)]
