import math
import random
from collections import Counter, defaultdict

import pytest
from helpers import documents, nothing
from plateia.llm import mixing
from pyspark.sql import functions as F


def corpus(spark, sizes, seed=1):
    """Documents of random length per source, of about so many in all."""
    rng, rows = random.Random(seed), []
    for source, n in sizes.items():
        rows += [(len(rows) + i, "w " * rng.randint(0, 30), "en", source, 0) for i in range(n)]
    schema = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
    return spark.createDataFrame(rows, schema).repartition(5), rows


def weights(tokens, a):
    p = {s: t / sum(tokens.values()) for s, t in tokens.items() if t}
    norm = sum(x**a for x in p.values())
    return {s: x**a / norm for s, x in p.items()}


def bisected(keeps):
    low, high = 0.0, 1.0
    if keeps(0.0):
        return 0.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (low, middle) if keeps(middle) else (middle, high)
    return high


def check_mix(spark, rows, df, **options):
    """The mix against whole passes and a prefix of the drawn order, source by source."""
    plan = {r._source: r for r in mixing.plan_mix(df, **options).collect()}
    mixed = mixing.mix_sources(df, **options).collect()
    copies = defaultdict(list)
    for r in mixed:
        copies[r.doc_id].append(r.epoch)
    block = options.get("block_docs", 64)
    for source, p in plan.items():
        own = [(d, len(t.split())) for d, t, _, s, _ in rows if s == source]
        order = _orders(df, source, p.passes, block)
        total, rest = sum(n for _, n in own), 0
        if total:
            assert p.budget == p.passes * total + p.budget % total
            rest = p.budget % total
        wanted, used = set(), 0
        for doc, n in sorted(own, key=lambda x: (order[x[0]], x[0])) if rest else []:
            if used + n > rest:
                break
            used += n
            wanted.add(doc)
        for doc, _ in own:
            expected = list(range(p.passes + (doc in wanted)))
            assert sorted(copies[doc]) == expected, (source, doc)
    return plan, mixed


def _orders(df, source, passes, block):
    own = df.filter(F.col("source") == source).withColumn("_source", F.col("source"))
    return {r.doc_id: r.o for r in own.select("doc_id", mixing._order(1, F.lit(passes), mixing._block(block)).alias("o")).collect()}


SIZES = {"big": 400, "mid": 90, "small": 30, "tiny": 4}


def tokens_of(rows):
    counts = Counter()
    for _, text, _, source, _ in rows:
        counts[source] += len(text.split())
    return counts


@pytest.mark.parametrize("block_docs", [1, 16])
def test_repetition_limit_with_cover(spark, block_docs):
    df, rows = corpus(spark, SIZES)
    plan, mixed = check_mix(spark, rows, df, repetition=2.0, block_docs=block_docs)
    tokens = tokens_of(rows)
    share = {s: t / sum(tokens.values()) for s, t in tokens.items()}
    a = bisected(lambda x: max(share.values()) ** (1 - x) / min(share.values()) ** (1 - x) <= 2.0)
    for source, w in weights(tokens, a).items():
        assert math.isclose(plan[source].weight, w, rel_tol=1e-6)
    assert {r.doc_id for r in mixed} == {r[0] for r in rows}  # every document at least once
    assert max(p.budget / p._total for p in plan.values()) <= 2.001


def test_budget_and_target_entropy(spark):
    df, rows = corpus(spark, SIZES)
    tokens = tokens_of(rows)
    budget = sum(tokens.values())

    def entropy(a):
        return -sum(w * math.log(w) for w in weights(tokens, a).values())

    a = bisected(lambda x: entropy(x) <= 0.8 * math.log(len(tokens)))
    plan, mixed = check_mix(spark, rows, df, entropy=0.8, budget_tokens=budget, block_docs=4)
    for source, w in weights(tokens, a).items():
        assert math.isclose(plan[source].weight, w, rel_tol=1e-6)
        assert abs(plan[source].budget - w * budget) <= 1
    mixed_tokens = Counter()
    for r in mixed:
        mixed_tokens[r.source] += len(r.text.split())
    for source, p in plan.items():
        assert p.budget - 30 <= mixed_tokens[source] <= p.budget


def test_shuffled_sources_give_the_same_mix(spark):
    df, rows = corpus(spark, SIZES)
    before = sorted((r.doc_id, r.epoch) for r in mixing.mix_sources(df, repetition=1.5).collect())
    small = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert sorted((r.doc_id, r.epoch) for r in mixing.mix_sources(df, repetition=1.5).collect()) == before
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", small)


def test_rows_without_an_id_are_many_blocks(spark):
    df = documents(spark, [(None, f"w{i} x") for i in range(300)] + [(None, "a b")] * 40)
    df = df.withColumn("source", F.when(F.col("text") < "b", "few").otherwise("many"))
    plan = {r._source: r for r in mixing.plan_mix(df, repetition=1.3, block_docs=64).collect()}
    mixed = mixing.mix_sources(df, repetition=1.3, block_docs=64)
    assert mixed.filter("epoch = 0").count() == 340
    for source, p in plan.items():
        own = mixed.filter(F.col("source") == source)
        copies = 40 if source == "few" else 1  # taken together or not at all
        assert p.budget - 2 * copies < own.count() * 2 <= p.budget


def test_awkward_rows(spark):
    assert mixing.mix_sources(nothing(spark), repetition=2.0).count() == 0
    blank = documents(spark, [None, "", "  "], mix_order="x", epoch="y")
    out = mixing.mix_sources(blank, repetition=2.0)
    assert sorted(out.columns) == sorted(blank.columns) and out.count() == 3
    mixed = documents(spark, ["a b", None, "c", (None, "d e"), (0, "a b")], passes=1, share=2, _tokens=3)
    out = mixing.mix_sources(mixed.withColumn("source", F.when(F.col("doc_id") != 1, "s")), repetition=2.0)
    assert out.filter("epoch = 0").count() == 5
    with pytest.raises(ValueError):
        mixing.mix_sources(mixed)
