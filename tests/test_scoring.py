"""The classifier sees each text as often as it must, in batches of similar lengths."""

import random

from pyspark.sql import functions as F

from plateia.operators import scoring
from plateia.operators.scoring import with_prediction, with_prediction_once

SCHEMA = "comment_id STRING, text_clean STRING, label STRING"


def _logging_factory(folder):
    """Notes every call in a file of its own and rates a text by its length."""

    def load():
        import uuid

        def predict(texts):
            with open(f"{folder}/{uuid.uuid4().hex}", "w", encoding="utf-8") as file:
                file.write("\n".join(texts))
            return [(f"{len(text) % 5 + 1} stars", len(text) / 1000) for text in texts]

        return predict

    return load


def _calls(folder):
    return [path.read_text(encoding="utf-8").split("\n") for path in folder.iterdir()]


def _comments(spark, texts):
    rows = [(f"c{i}", text) for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, "comment_id STRING, text_clean STRING").repartition(6)


def test_each_distinct_text_is_classified_once(spark, tmp_path):
    rng = random.Random(1)
    texts = ["bom"] * 700 + [f"texto {rng.randint(0, 150)}" for _ in range(1200)] + [None, "", " \t"] * 20
    answered = with_prediction_once(_comments(spark, texts), _logging_factory(tmp_path), tasks=4).collect()
    seen = [text for call in _calls(tmp_path) for text in call]
    assert sorted(seen) == sorted({text for text in texts if (text or "").strip()})
    assert len(answered) == len(texts)
    for row in answered:
        written = (row.text_clean or "").strip()
        expected = (f"{len(row.text_clean) % 5 + 1} stars", len(row.text_clean) / 1000) if written else (None, None)
        assert (row.label, row.confidence) == expected


def test_both_forms_score_alike(spark, tmp_path):
    texts = ["péssimo, que raiva", "excelente", None, "", "excelente", "x" * 500] * 30
    one = scoring.score_comments(_comments(spark, texts), _logging_factory(tmp_path), once=True)
    other = scoring.score_comments(_comments(spark, texts), _logging_factory(tmp_path))
    assert sorted(map(repr, one.collect())) == sorted(map(repr, other.collect()))


def test_batches_are_filled_by_length(spark, tmp_path):
    rng = random.Random(2)
    texts = [f"{i} " + "x" * rng.choice([1, 5, 30, 400, 3000]) for i in range(400)]
    comments = _comments(spark, texts).coalesce(1)
    with_prediction(comments, _logging_factory(tmp_path), batch_chars=2000).collect()
    calls = _calls(tmp_path)
    assert sorted(text for call in calls for text in call) == sorted(texts)
    for call in calls:
        assert len(call) == 1 or len(call) * max(map(len, call)) <= 2000
    assert max(map(len, calls)) > 32 and len(calls) < 200


def test_repeats_in_a_batch_are_classified_once_without_a_shuffle(spark, tmp_path):
    comments = _comments(spark, ["a", "b", "a", None] * 50).coalesce(1)
    predicted = with_prediction(comments, _logging_factory(tmp_path))
    assert [row.label for row in predicted.collect()].count(None) == 50
    assert sorted(text for call in _calls(tmp_path) for text in call) == ["a", "b"]


def test_a_text_that_a_third_shares_is_split(spark, tmp_path):
    before = {}
    conf = {
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for key, value in conf.items():
        before[key] = spark.conf.get(key, None)
        spark.conf.set(key, value)
    try:
        text = F.when(F.col("id") % 3 == 0, "bom").otherwise(F.concat(F.lit("t"), F.col("id") % 900))
        comments = spark.range(0, 60_000, 1, 16).select(
            F.concat(F.lit("c"), "id").alias("comment_id"), text.alias("text_clean"))
        answered = with_prediction_once(comments, _logging_factory(tmp_path))
        assert len(answered.collect()) == 60_000
        assert "skew=true" in answered._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
