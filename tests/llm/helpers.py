"""Small tables with every awkward row: NULLs, empty, repeated and long texts, extra columns."""

from pyspark.sql import functions as F

DOCS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


def documents(spark, texts, **extra):
    """One document per text, or per (id, text), in four partitions."""
    pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    rows = [(i, t, "en", f"s{(i or 0) % 3}", len(t or "")) for i, t in pairs]
    df = spark.createDataFrame(rows, DOCS).repartition(4)
    return df.withColumns({name: F.lit(value) for name, value in extra.items()})


def nothing(spark):
    return spark.createDataFrame([], DOCS)
