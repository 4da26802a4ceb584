import corpus_pipeline
import pytest
from plateia.llm.common import written
from plateia.llm.mixing import mix_sources
from plateia.llm.ngram_join import ngram_components
from plateia.llm.oracles import ORACLES
from plateia.llm.queries import QUERIES

from check_oracles import connect, differences

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_statement(spark, name):
    assert differences(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLES[name]) is None


def test_every_operator_has_a_query():
    assert {int(name[2:].split("_")[0]) for name in QUERIES if name != "pipeline"} == set(range(1, 11))


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, kept = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(written(stage(spark, kept[-1], FOLDER), f"test-{name}"))
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line_dedup", "near_duplicates", "mixing", "packing"]
    assert all(df.columns == columns and df.schema == docs.schema for df in kept[1:-1])
    clean, cut, unique, mixed, packed = kept[1:]
    assert unique.count() == unique.select("doc_id").distinct().count() <= cut.count() <= clean.count() <= docs.count()
    assert cut.filter("n_chars <> char_length(text)").count() == 0
    again = ngram_components(unique, 5, 80)
    assert again.filter("doc_id <> component_id").count() == 0
    assert mixed.select("doc_id").distinct().count() == unique.count()
    assert packed.select("doc_id").distinct().count() == unique.count()
    assert packed.groupBy("sequence_id").sum("length").filter("`sum(length)` > 2048").count() == 0
    assert corpus_pipeline.run(spark, FOLDER).count() == packed.count()


def test_an_empty_corpus_passes_every_stage(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, FOLDER), "test-empty")
    assert docs.count() == 0


def test_mixing_writes_the_order_of_the_mix(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    mixed = written(corpus_pipeline.mixing(spark, docs, FOLDER), "test-mixed")
    files = sorted(mixed.inputFiles())
    found = [r.doc_id for file in files for r in spark.read.parquet(file).select("doc_id").coalesce(1).collect()]
    order = mix_sources(docs, repetition=1.25).select("doc_id", "mix_order").collect()
    assert found == [r.doc_id for r in sorted(order, key=lambda r: (r.mix_order, r.doc_id))]
    assert mixed.columns == docs.columns
