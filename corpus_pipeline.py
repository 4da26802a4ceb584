"""A training corpus from raw documents: five stages, each written and read again.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
keep the columns of ``docs``. A stage works on everything the one before it kept.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plateia.llm.common import written
from plateia.llm.line_dedup import dedup_lines
from plateia.llm.mixing import mix_sources
from plateia.llm.ngram_join import keep_one_of_each
from plateia.llm.packing import pack_documents
from plateia.llm.toxicity import fit_toxicity, score_toxicity

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go; the rest stays as it is."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit_toxicity(docs, labels)
    scored = score_toxicity(docs, model, *docs.columns, out="_toxicity")
    return scored.filter("_toxicity < 0.5").drop("_toxicity")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated runs of lines go; so does a document of which nothing else is left."""
    cut = dedup_lines(docs)
    emptied = (F.col("removed_lines") > 0) & (F.length(F.trim("text")) == 0)
    kept = cut.filter(~F.coalesce(emptied, F.lit(False))).select(*docs.columns)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        kept = kept.withColumn("n_chars", F.char_length("text").cast(kind))
    return kept


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word shingles link at 0.8 or more."""
    return keep_one_of_each(docs, words=5, percent=80)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once, those of rarer sources again, up to 1.25 passes of a source; in the order of the mix."""
    mixed = mix_sources(docs, repetition=1.25).repartitionByRange("mix_order", "doc_id")
    return mixed.sortWithinPartitions("mix_order", "doc_id").select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece in sequences of 2048 tokens."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=0, capacity=2048)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("mixing", mixing),
    ("packing", packing),
]

#: Compression lengths and tokenizers have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
