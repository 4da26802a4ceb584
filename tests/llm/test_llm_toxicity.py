import math
import random
import zlib

import pytest
from helpers import documents, nothing
from plateia.llm import toxicity

LABELS = "doc_id BIGINT, toxic INT, quality INT, text STRING"
BAD = ["grumbly", "snarkish", "vilefoo", "scornbat"]


def prose(rng, n, bad=0):
    syllables = ["ka", "lo", "mi", "ter", "an", "ou", "sel", "dir", "po", "en"]
    words = ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(n)]
    for _ in range(bad):
        words[rng.randrange(n)] = rng.choice(BAD)
    return " ".join(words)


def labelled(spark, n=500, seed=3):
    rng = random.Random(seed)
    toxic = [rng.random() < 0.25 for _ in range(n)]
    texts = [prose(rng, rng.randint(10, 90), rng.randint(1, 4) if bad else 0) for bad in toxic]
    labels = spark.createDataFrame([(i, int(bad), 1, "no input") for i, bad in enumerate(toxic)], LABELS)
    return documents(spark, texts), labels, toxic


def test_held_out_documents_are_told_apart(spark):
    docs, labels, toxic = labelled(spark)
    rows = toxicity.classify_toxicity(docs, labels).collect()
    assert len(rows) == len(toxic)
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in range(len(toxic)) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    right = [r.predicted == toxic[r.doc_id] for r in held]
    assert sum(right) / len(right) > 0.95
    low = [r.score for r in held if not toxic[r.doc_id]]
    high = [r.score for r in held if toxic[r.doc_id]]
    auc = sum((x > y) + (x == y) / 2 for x in high for y in low) / len(high) / len(low)
    assert auc > 0.98


def test_labels_of_held_out_documents_are_never_seen(spark):
    docs, labels, _ = labelled(spark, 200)
    flipped = labels.withColumn("toxic", toxicity.F.expr("IF(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0, 1 - toxic, toxic)"))
    before, after = (
        {r.doc_id: r.score for r in toxicity.classify_toxicity(docs, x).collect()} for x in (labels, flipped))
    assert before == after


def test_only_the_text_counts(spark):
    docs, labels, _ = labelled(spark, 200)
    model = toxicity.fit_toxicity(docs, labels)
    scorer = model.scorer()
    assert model.scorer().score("same text") == scorer.score("same text")
    plain, filled = scorer.score(""), scorer.score(" ".join(BAD))
    assert scorer.score(None) == plain and plain < 0.5 < filled
    assert 0 <= scorer.score("ka" * 100_000) <= 1
    assert scorer.score(prose(random.Random(1), 3000) + " " + " ".join(BAD * 3)) > scorer.score(prose(random.Random(1), 3000))


@pytest.mark.parametrize("kinds, score", [((), 0.0), ((1,), 1.0), ((0,), 0.0)])
def test_one_kind_of_label_or_none_gives_a_constant(spark, kinds, score):
    docs = documents(spark, ["a b", None, "", (None, "c"), (0, "a b")], score="x", toxic=1, _text="y")
    rows = [(i, kind, 0, "") for kind in kinds for i in range(1, 60)]
    out = toxicity.classify_toxicity(docs, spark.createDataFrame(rows + [(2, None, 0, ""), (None, 1, 0, "")], LABELS))
    found = out.collect()
    assert len(found) == 5
    # document 1 and 2 alone have texts in the table; labels of ids that no document has do not count
    assert {r.score for r in found} == {score} and all(math.isfinite(r.score) for r in found)


def test_no_documents(spark):
    assert toxicity.classify_toxicity(nothing(spark), spark.createDataFrame([], LABELS)).count() == 0


def test_scores_come_next_to_any_columns(spark):
    docs = documents(spark, ["a", None], score="x")
    out = toxicity.score_toxicity(docs, toxicity.Model(constant=0.25), *docs.columns, out="_t")
    assert out.columns == [*docs.columns, "_t"]
    assert sorted((r.doc_id, r.text, r.score, r._t) for r in out.collect()) == [(0, "a", "x", 0.25), (1, None, "x", 0.25)]
