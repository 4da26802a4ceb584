import math
import random

from pyspark.sql import functions as F

from plateia.llm.topk import _blocks_per_shelf, top_inner_products

SCHEMA = "vec_id BIGINT, embedding ARRAY<FLOAT>, score STRING, rank STRING"


def expected(rows, step, k):
    ints = {}
    for i, (vec_id, vector) in enumerate(rows):
        if vec_id is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        ints[i] = (vec_id, [math.floor(256 * x) for x in vector])
    out = []
    for _, (query, q) in ints.items():
        if query % step:
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, c)), name) for name, c in ints.values() if name != query)
        out += [(query, rank + 1, name, -score) for rank, (score, name) in enumerate(scored[:k])]
    return sorted(out)


def run(spark, rows, step=5, k=3, **options):
    df = spark.createDataFrame([(*r, "a", "b") for r in rows], SCHEMA).repartition(4)
    found = top_inner_products(df, F.col("vec_id") % step == 0, k=k, **options)
    assert found.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    return sorted(map(tuple, found.collect()))


def single(x):
    """As the column stores it."""
    import struct

    return struct.unpack("f", struct.pack("f", x))[0]


def test_equals_brute_force_over_blocks_ties_and_awkward_rows(spark):
    rng = random.Random(2)
    rows = []
    for i in range(300):
        length = rng.choice([0.1, 1, 8])
        rows.append((i, [single(rng.gauss(0, length)) for _ in range(12)]))
    rows += [(300 + i, rows[3][1]) for i in range(40)]  # many equal vectors: ties go to the smaller id
    rows += [(400, None), (405, [1.0, None]), (410, [float("nan")] * 12), (415, [float("inf")] * 12), (None, [1.0] * 12)]
    rows += [(420, []), (425, [0.0] * 12), (430, [1.0, 2.0])]
    assert run(spark, rows, block_rows=32, query_rows=16, fit_rows=64) == expected(rows, 5, 3)


def test_fewer_candidates_than_wanted(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0, 0.5])]
    assert run(spark, rows, k=5) == [(0, 1, 1, 256 * 256 + 512 * 128)]
    assert run(spark, [(0, [1.0])]) == []


def test_no_rows_and_no_queries(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, [1.0]), (2, [1.0])]) == []


def test_large_components_stay_exact(spark):
    rows = [(i, [single(90_000.0 + i * 17), single(-80_000.0 + i)]) for i in range(20)]
    assert run(spark, rows) == expected(rows, 5, 3)
    assert run(spark, [(0, [1e30]), (1, [1.0]), (5, [2.0])]) == [(5, 1, 1, 512 * 256)]


def test_every_vector_whose_scores_are_longs_takes_part(spark):
    pairs = [(1, 1), (2e5, 0), (131_072, -5), (3e6, 1), (-2e6, 7), (2.5e7, 2.5e7)]
    rows = [(i, [single(x) for x in pair]) for i, pair in enumerate(pairs)]
    found = run(spark, rows)
    assert found == expected(rows, 5, 3)
    assert (0, 1, 5, 2 * 256 * int(256 * 2.5e7)) in found


def test_scores_beyond_a_long_stop_at_its_ends(spark):
    rows = [(0, [2.0**50]), (1, [2.0**51]), (2, [2.0**-6]), (3, [-(2.0**50)])]
    found = {(q, v): score for q, _, v, score in run(spark, rows)}
    assert found[0, 1] == 2**63 - 1 and found[0, 3] == -(2**63 - 1) and found[0, 2] == 2**60


def test_copies_of_the_queries_are_not_broadcast(spark):
    rng = random.Random(4)
    rows = [(i, [single(rng.gauss(0, 1)) for _ in range(12)]) for i in range(300)]
    df = spark.createDataFrame([(*r, "a", "b") for r in rows], SCHEMA).repartition(4)
    found = top_inner_products(df, F.col("vec_id") % 5 == 0, k=3, block_rows=2, query_rows=8)
    assert sorted(map(tuple, found.collect())) == expected(rows, 5, 3)
    ran = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "isFinalPlan=true" in ran or "Final Plan" in ran
    assert "SortMergeJoin" in ran and "Broadcast" not in ran


def test_copies_of_the_queries_grow_as_the_queries_do():
    shelves = {n: -(-n // _blocks_per_shelf(n)) for n in (1, 64, 65, 293, 1500, 4096)}
    assert shelves[1] == 1 and shelves[64] == 64 and max(shelves.values()) <= 64
    assert max(_blocks_per_shelf(n) for n in (4097, 30_000, 65_536)) == 64
    assert all(-(-n // _blocks_per_shelf(n)) <= 1024 for n in (65_536, 65_537, 10**6, 10**8))
