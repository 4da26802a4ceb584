import random
from collections import Counter

import pytest
from plateia.llm.common import new_folder
from plateia.llm.rollups import KEYS, TokenRollup

IMAGE = "STRUCT<source: STRING, lang: STRING, tokenizer: STRING, n_tokens: BIGINT>"
CHANGES = f"before {IMAGE}, after {IMAGE}, docs STRING, tokens STRING"


def table(df):
    return {tuple(r[k] for k in KEYS): (r.docs, r.tokens) for r in df.collect()}


def changes(spark, rows):
    return spark.createDataFrame([(*r, "a", "b") for r in rows], CHANGES)


def test_totals_equal_the_documents_left(spark):
    rng, rollup, documents = random.Random(4), TokenRollup(spark, new_folder(spark, "rollup")), {}
    for batch in range(1, 5):
        rows = []
        for _ in range(60):
            doc = rng.randint(0, 40)
            before = documents.pop(doc, None)
            after = None
            if rng.random() < 0.7:
                after = (rng.choice(["a", "a", "b", None]), rng.choice(["en", None]), rng.choice(["v1", "v2"]), rng.choice([0, 5, None, 70]))
                documents[doc] = after
            rows.append((before, after))
        assert rollup.commit(batch, changes(spark, rows))
        for again in (batch, 1):  # a batch that arrives again changes nothing
            assert not rollup.commit(again, changes(spark, rows))
        docs, tokens = Counter(), Counter()
        for source, lang, tokenizer, n in documents.values():
            docs[source, lang, tokenizer] += 1
            tokens[source, lang, tokenizer] += n or 0
        assert table(rollup.totals()) == {key: (docs[key], tokens[key]) for key in docs}


def test_empty_batches_and_no_batches(spark):
    rollup = TokenRollup(spark, new_folder(spark, "rollup"))
    assert rollup.version() is None and rollup.totals().count() == 0
    assert rollup.commit(1, changes(spark, []))
    assert rollup.version() == 1 and rollup.totals().count() == 0
    row = ("a", "en", "v1", 3)
    rollup.commit(2, changes(spark, [(None, row), (None, row), (None, None)]))  # repeated rows count twice
    assert table(rollup.totals()) == {("a", "en", "v1"): (2, 6)}
    rollup.commit(3, changes(spark, [(row, None), (row, None)]))
    assert rollup.totals().count() == 0


def test_a_failed_commit_leaves_the_totals(spark):
    from pyspark.sql import functions as F

    rollup = TokenRollup(spark, new_folder(spark, "rollup"))
    row = ("a", "en", "v1", 3)
    rollup.commit(1, changes(spark, [(None, row)]))
    bad = changes(spark, [(None, row)]).withColumn(
        "after", F.when(F.raise_error(F.lit("lost")).isNull(), F.col("after")))
    with pytest.raises(Exception, match="lost"):
        rollup.commit(2, bad)
    assert rollup.version() == 1
    assert rollup.commit(2, changes(spark, [(None, row)]))
    assert table(rollup.totals()) == {("a", "en", "v1"): (2, 6)}


def test_a_late_batch_counts_once(spark):
    rollup = TokenRollup(spark, new_folder(spark, "rollup"))
    rows = {batch: changes(spark, [(None, ("a", "en", "v1", 10 * batch))]) for batch in (1, 2, 3)}
    assert [rollup.commit(batch, rows[batch]) for batch in (1, 3, 2)] == [True, True, True]
    assert [rollup.commit(batch, rows[batch]) for batch in (2, 1, 3)] == [False, False, False]
    assert rollup.commits() == {1: 1, 2: 3, 3: 2}
    assert table(rollup.totals()) == {("a", "en", "v1"): (3, 60)}
    assert table(rollup.totals(2)) == {("a", "en", "v1"): (2, 40)}
