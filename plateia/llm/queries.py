"""The registered query of each operator, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plateia.llm.common import new_folder, written
from plateia.llm.fingerprints import fingerprint_edits
from plateia.llm.licenses import scan_licenses
from plateia.llm.line_dedup import dedup_lines
from plateia.llm.mixing import count_words, mix_sources
from plateia.llm.ngram_join import ngram_components
from plateia.llm.packing import pack_documents
from plateia.llm.periodic_runs import periodic_runs
from plateia.llm.prefix_trie import prefix_trie
from plateia.llm.rollups import TokenRollup, count_tokens, image
from plateia.llm.token_files import token_files
from plateia.llm.topk import top_inner_products
from plateia.llm.toxicity import classify_toxicity
from plateia.llm.warc import archive_pages

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op8_token_files(spark: SparkSession, folder: str) -> DataFrame:
    read = token_files(spark, table(spark, folder, "documents"), WORD_BPE, end_id=1)
    return read.select("doc_id", "start", "n_tokens", "ids_crc32")


@query
def op4_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(table(spark, folder, "documents"), WORD_BPE, end_id=0, capacity=2048)


@query
def op1_top_inner_products(spark: SparkSession, folder: str) -> DataFrame:
    asked = F.col("vec_id") % 50 == 0
    return top_inner_products(table(spark, folder, "embeddings"), asked, k=5, scale=256.0)


@query
def op6_warc_archives(spark: SparkSession, folder: str) -> DataFrame:
    return archive_pages(spark, table(spark, folder, "pages"), least_bytes=1000)


@query
def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return classify_toxicity(docs, labels, sample_docs=4000)


@query
def op2_temperature_mix(spark: SparkSession, folder: str) -> DataFrame:
    """The whole mix: every document at least once, no source passed over 1.25 times."""
    docs = table(spark, folder, "documents")
    mixed = mix_sources(docs, repetition=1.25, block_docs=64, seed=1)
    return mixed.select(
        "doc_id", "source", count_words(F.col("text")).alias("n_tokens"), "epoch", "mix_order"
    )


def _counted(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of every whole text under each tokenizer version, with the document's labels."""
    text = F.col("text")
    docs = table(spark, folder, "documents").select(
        "doc_id", "source", "lang", *(count_tokens(text, t).alias(t) for t in ("words-1", "words-2", "pieces-1"))
    )
    labels = table(spark, folder, "labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return docs.join(labels, "doc_id", "left").withColumn("labelled", F.col("toxic").isNotNull())


@query
def op10_token_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Totals after three batches and a replay.

    Batch 1 inserts every document under two tokenizers, batch 2 recounts the
    labelled ones with the next version of one, batch 3 deletes the toxic ones;
    batch 2 then arrives again.
    """
    counted = written(_counted(spark, folder), "token-counts")

    def of(tokenizer: str) -> Column:
        return image(F.col("source"), F.col("lang"), tokenizer, F.col(f"`{tokenizer}`"))

    def changes(rows: DataFrame, *sides: tuple[Column, Column]) -> DataFrame:
        pairs = F.array(*(F.struct(b.alias("before"), a.alias("after")) for b, a in sides))
        return rows.select(F.inline(pairs))

    none = F.when(F.lit(False), of("words-1"))
    inserts = changes(counted, (none, of("words-1")), (none, of("pieces-1")))
    recounts = changes(counted.filter("labelled"), (of("words-1"), of("words-2")))
    deletes = changes(counted.filter("toxic = 1"), (of("words-2"), none), (of("pieces-1"), none))
    rollup = TokenRollup(spark, new_folder(spark, "rollup"))
    for batch, rows in ((1, inserts), (2, recounts), (3, deletes), (2, recounts)):
        rollup.commit(batch, rows)
    return rollup.totals()


@query
def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = dedup_lines(table(spark, folder, "documents"), least_words=30, gram_words=15)
    return cut.select("doc_id", "n_lines", "removed_lines", "removed", "text")


@query
def op7_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return ngram_components(docs, words=4, percent=85).select("doc_id", "n_shingles", "component_id")


@query
def op3_iblt_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint_edits(table(spark, folder, "documents"))


@query
def op11_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    scanned = scan_licenses(table(spark, folder, "documents"), percent=80)
    return scanned.drop("blocks")


@query
def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return periodic_runs(table(spark, folder, "documents"), least=12, planted=True).drop("runs")


@query
def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie(table(spark, folder, "conversations"), group=100, shared=6)


@query
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)
