"""Temperature mixing of sources, realised as budgeted block permutations.

Source shares p of all tokens are raised to an exponent a and normalised to
weights w = p^a / sum p^a. The exponent is searched between 0 (uniform) and 1
(as found), 32 ways at a time; every round is one aggregate over the sources:

- ``entropy``: the exponent whose weights have this share of the largest entropy,
- ``repetition``: the least exponent at which no source is passed more often.

A budget of tokens is dealt by weight. Without ``budget_tokens`` it is the least
that passes every source once, so that no document is left out. A source gets
its whole passes, and of one more pass the prefix that its budget allows: blocks
of neighbouring documents in an order drawn anew for each pass, and of the last
block the documents in ascending doc_id. The cut is found by descending the
order ten bits at a time, so no task sees more than 1024 sums of a source.

Rows: a NULL source is the same as an empty one; NULL texts and texts without
words have no tokens and come with whole passes only; a source without tokens is
passed once. Rows without a doc_id are dealt over blocks of their own by a hash of
their texts. Rows that repeat a doc_id in the last block, and copies without one, are
taken together or not at all. An empty table gives
no rows. Extra columns are kept; ``epoch`` and ``mix_order`` replace such columns.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plateia.llm.common import written

WAYS = 32
ROUNDS = 7
LEAST = -(1 << 63)


def count_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t\n\x0B\f\r]+")), F.lit(0)).cast("bigint")


@dataclass(frozen=True)
class Point:
    """The weights at one exponent, summed up over all sources."""

    exponent: float
    norm: float  # sum of p^a
    entropy: float
    most: float  # largest and least p^(a-1): how often a source is passed, up to a factor
    least: float

    def budget(self, tokens: int, budget_tokens: int | None) -> float:
        return tokens * self.norm / self.least if budget_tokens is None else float(budget_tokens)

    def repetition(self, tokens: int, budget_tokens: int | None) -> float:
        return self.budget(tokens, budget_tokens) / tokens / self.norm * self.most


def _points(shares: DataFrame, exponents: list[float]) -> list[Point]:
    p = F.col("share")
    sums = []
    for i, a in enumerate(exponents):
        power = F.pow(p, F.lit(a))
        sums += [
            F.sum(power).alias(f"n{i}"), F.sum(power * F.log(p)).alias(f"l{i}"),
            F.max(power / p).alias(f"x{i}"), F.min(power / p).alias(f"y{i}"),
        ]
    row = shares.agg(*sums).first()
    return [
        Point(a, row[f"n{i}"], math.log(row[f"n{i}"]) - a * row[f"l{i}"] / row[f"n{i}"], row[f"x{i}"], row[f"y{i}"])
        for i, a in enumerate(exponents)
    ]


def find_exponent(
    shares: DataFrame, tokens: int, budget_tokens: int | None = None,
    entropy: float | None = None, repetition: float | None = None,
) -> Point:
    """The least exponent from 0 to 1 that keeps the target; 1 if none does."""
    if (entropy is None) == (repetition is None):
        raise ValueError("give a target entropy or a repetition limit")
    largest = math.log(max(1, shares.count()))

    def keeps(point: Point) -> bool:
        if entropy is not None:
            return point.entropy <= entropy * largest + 1e-12
        return point.repetition(tokens, budget_tokens) <= repetition * (1 + 1e-12)

    low, high = 0.0, 1.0
    for _ in range(ROUNDS):
        points = _points(shares, [low + (high - low) * i / WAYS for i in range(WAYS + 1)])
        first = next((i for i, point in enumerate(points) if keeps(point)), WAYS)
        best = points[first]
        if first == 0 or high - low < 1e-12:
            break
        low, high = points[first - 1].exponent, best.exponent
    return best


def _block(block_docs: int) -> Column:
    """Neighbouring ids; texts without an id are dealt over blocks below those of any id."""
    by_text = F.lit(LEAST) + F.pmod(F.xxhash64("text"), F.lit(1 << 56))
    return F.coalesce(F.floor(F.col("doc_id").cast("bigint") / block_docs).cast("bigint"), by_text)


def _order(seed: int, epoch: Column, block: Column) -> Column:
    return F.xxhash64(F.lit(seed), epoch.cast("bigint"), F.col("_source"), block)


def _source() -> Column:
    return F.coalesce(F.col("source"), F.lit(""))


def _of_source(rows: DataFrame, per_source: DataFrame) -> DataFrame:
    """Join rows with the one row of their source.

    The planner sends a table of sources that is small, as it was written, to every
    task; of a larger one it splits the partitions that a hot source fills.
    """
    return rows.join(per_source, "_source")


def plan_mix(
    docs: DataFrame, budget_tokens: int | None = None, entropy: float | None = None,
    repetition: float | None = None, block_docs: int = 64, seed: int = 1,
) -> DataFrame:
    """One row per source: share, weight, budget, whole passes, and where the last pass ends."""
    counted = written(
        docs.select(
            _source().alias("_source"), F.col("doc_id").cast("bigint").alias("doc_id"),
            count_words(F.col("text")).alias("_tokens"), _block(block_docs).alias("_block"),
        ),
        "mix-counts",
    )
    blocks = written(counted.groupBy("_source", "_block").agg(F.sum("_tokens").alias("_tokens")), "mix-blocks")
    sources = blocks.groupBy("_source").agg(F.sum("_tokens").alias("_total"))
    tokens = sources.agg(F.sum("_total")).first()[0] or 0
    if not tokens:
        return sources.selectExpr(
            "_source", "_total", "0D AS share", "0D AS weight", "0L AS budget", "1L AS passes",
            f"{LEAST}L AS cut_order", f"{LEAST}L AS cut_doc",
        )
    shares = written(sources.withColumn("share", F.col("_total") / F.lit(tokens)), "mix-shares")
    point = find_exponent(shares.filter("share > 0"), tokens, budget_tokens, entropy, repetition)
    budget = point.budget(tokens, budget_tokens)
    weight = F.when(F.col("share") > 0, F.pow("share", F.lit(point.exponent)) / point.norm).otherwise(0.0)
    wanted = F.round(F.col("weight") * F.lit(budget)).cast("bigint")
    plan = written(
        shares.withColumn("weight", weight)
        .withColumn("budget", wanted)
        .withColumn("passes", F.when(F.col("_total") > 0, F.expr("budget div _total")).otherwise(F.lit(1)))
        .withColumn("_rest", F.when(F.col("_total") > 0, F.expr("budget % _total")).otherwise(F.lit(0))),
        "mix-plan",
    )
    cuts = _cuts(counted, blocks, plan.select("_source", "passes", "_rest"), seed)
    return plan.join(cuts, "_source", "left").select(
        "_source", "_total", "share", "weight", "budget", "passes",
        F.coalesce("cut_order", F.lit(LEAST)).alias("cut_order"),
        F.coalesce("cut_doc", F.lit(LEAST)).alias("cut_doc"),
    )


def _cuts(counted: DataFrame, blocks: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """Where the unfinished pass of each source ends: the last order and doc_id within its rest."""
    left = _of_source(blocks, plan.filter("_rest > 0")).withColumn(
        "_at", _order(seed, F.col("passes"), F.col("_block"))
    )
    running = Window.partitionBy("_source").orderBy("_bin")
    low = F.lit(0).cast("bigint")
    for shift in (54, 44, 34):
        left = left.withColumn("_bin", F.shiftright("_at", shift))
        sums = left.groupBy("_source", "_bin").agg(F.sum("_tokens").alias("_in"), F.first("_rest").alias("_rest"))
        over = sums.withColumn("_to", F.sum("_in").over(running)).filter("_to > _rest")
        cut = over.groupBy("_source").agg(
            F.min("_bin").alias("_bin"), F.min_by(F.col("_rest") - F.col("_to") + F.col("_in"), "_bin").alias("_left")
        )
        left = left.drop("_rest").join(cut, ["_source", "_bin"]).withColumnRenamed("_left", "_rest")
    left = written(left.select("_source", "_block", "_at", "_bin", "_rest"), "mix-cuts")
    own = counted.join(left, ["_source", "_block"]).groupBy(
        "_source", "_at", "_rest", F.coalesce("doc_id", F.lit(LEAST)).alias("_doc")).agg(F.sum("_tokens").alias("_tokens"))
    to = F.sum("_tokens").over(Window.partitionBy("_source").orderBy("_at", "_doc"))
    fits = own.withColumn("_to", to).filter("_to <= _rest").groupBy("_source").agg(
        F.max(F.struct("_at", "_doc")).alias("_last")
    )
    floors = left.groupBy("_source").agg(F.shiftleft(F.min("_bin"), 34).alias("_floor"))
    return floors.join(fits, "_source", "left").select(
        "_source",
        F.coalesce("_last._at", F.col("_floor")).alias("cut_order"),
        F.coalesce("_last._doc", low + F.lit(LEAST)).alias("cut_doc"),
        F.col("_last").isNotNull().alias("_some"),
    ).select("_source", F.when(F.col("_some"), F.col("cut_order")).otherwise(F.col("cut_order") - 1).alias("cut_order"),
             F.when(F.col("_some"), F.col("cut_doc")).otherwise(F.lit((1 << 63) - 1)).alias("cut_doc"))


def mix_sources(
    docs: DataFrame, budget_tokens: int | None = None, entropy: float | None = None,
    repetition: float | None = None, block_docs: int = 64, seed: int = 1,
) -> DataFrame:
    """The documents of the mix, once per pass, with ``epoch`` and ``mix_order``.

    Read in the order of ``mix_order`` and doc_id, the passes of all sources are
    spread over the whole mix, block by block.
    """
    plan = written(plan_mix(docs, budget_tokens, entropy, repetition, block_docs, seed), "mix-cuts")
    columns = [name for name in docs.columns if name not in ("epoch", "mix_order")]
    own = docs.select(*columns).withColumn("_source", _source())
    ends = plan.select("_source", *(F.col(name).alias(f"_mix_{name}") for name in ("passes", "cut_order", "cut_doc")))
    joined = _of_source(own, ends)
    passes, cut_order = F.col("_mix_passes"), F.col("_mix_cut_order")
    at = _order(seed, passes, _block(block_docs))
    doc = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LEAST))
    more = (at < cut_order) | ((at == cut_order) & (doc <= F.col("_mix_cut_doc")))
    copies = passes + F.when(more & (cut_order > LEAST), 1).otherwise(0)
    return (
        joined.withColumn("_copies", copies)
        .filter("_copies > 0")
        .withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_copies") - 1)))
        .withColumn("mix_order", _order(seed, F.col("epoch"), _block(block_docs)))
        .select(*columns, "epoch", "mix_order")
    )
