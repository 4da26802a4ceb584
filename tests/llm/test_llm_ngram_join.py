import random
from pathlib import Path

import numpy as np
import pytest
from helpers import documents, nothing
from plateia.llm import ngram_join
from plateia.llm.common import shared_folder
from plateia.llm.components import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, width):
    words = [w for w in (text or "").translate(LOWER).translate({c: 32 for c in range(9, 14)}).split(" ") if w]
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def brute_force(rows, width, percent):
    sets = [(i, shingle_set(t, width)) for i, t in rows]
    root = {n: n for n in range(len(sets))}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                root[max(find(a), find(b))] = min(find(a), find(b))
    groups = {}
    for n, (i, _) in enumerate(sets):
        groups.setdefault(find(n), []).append(i)
    least = {r: min((i for i in ids if i is not None), default=None) for r, ids in groups.items()}
    return sorted(((i, len(s), least[find(n)] if s else i) for n, (i, s) in enumerate(sets)), key=repr)


def edited(rng, text, n):
    words = text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = f"e{rng.randint(0, 10**6)}"
    return " ".join(words)


def corpus(seed, width):
    rng = random.Random(seed)

    def text(n):
        return " ".join(f"w{rng.randint(0, 400)}" for _ in range(n))

    texts = [text(rng.randint(1, 60)) for _ in range(60)]
    texts += [edited(rng, rng.choice(texts), rng.randint(0, 3)) for _ in range(60)]
    base = text(120)
    texts += [edited(rng, base, rng.randint(1, 2)) for _ in range(60)]  # a group of near copies
    texts += [base] * 25 + [text(40) + " " + " ".join(base.split()[:60]) for _ in range(15)]  # copies, a shared passage
    chain = text(100).split()
    texts += [" ".join(chain[k * 3 : k * 3 + 70]) for k in range(8)]  # links that only chains connect
    texts += ["A b C d", "a B c D", "a b", "A B", "", " \t\n", None, "É é É é", "é É é É", "x" * 50_000]
    return texts


@pytest.mark.parametrize("width, percent, seed", [(4, 85, 1), (5, 80, 2), (3, 60, 3)])
def test_components_equal_brute_force(spark, width, percent, seed):
    rows = [*enumerate(corpus(seed, width)), (None, "a b C d"), (None, ""), (3, "repeated id with another text")]
    df = documents(spark, rows, n=1, node="x", root="y", shingle="z")
    found = ngram_join.ngram_components(df, width, percent)
    assert sorted(map(tuple, found.collect()), key=repr) == brute_force(rows, width, percent)


def test_one_document_of_each_group_stays(spark):
    texts = corpus(5, 5)
    df = documents(spark, [*enumerate(texts), (None, texts[0])], component_id=1)
    kept = ngram_join.keep_one_of_each(df, 5, 80)
    assert kept.columns == df.columns
    expected = {i for i, _, root in brute_force(list(enumerate(texts)), 5, 80) if i == root}
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(expected)
    assert kept.filter("doc_id IS NULL").count() == 0  # its copy with an id stays


def test_one_row_of_repeated_and_missing_ids_stays(spark):
    a, b, c = ("one two three four five six", "ten nine eight seven six five", "x y z u v w")
    rows = [(1, a), (1, a), (2, a), (1, b), (None, b), (None, c), (None, c), (5, ""), (5, ""), (None, None), (None, None)]
    df = documents(spark, rows, _mark="x", kept="y", rows="z")
    kept = ngram_join.keep_one_of_each(df, 5, 80)
    assert kept.columns == df.columns and {(r["_mark"], r.kept, r.rows) for r in kept.collect()} == {("x", "y", "z")}
    expected = [(1, a), (1, b), (None, c), (5, ""), (5, ""), (None, None), (None, None)]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(expected, key=repr)
    assert ngram_join.keep_one_of_each(df.limit(0), 5, 80).count() == 0


def test_nothing_and_nothing_alike(spark):
    assert ngram_join.ngram_components(nothing(spark), 4, 85).count() == 0
    rows = [(0, "a b c d e"), (1, ""), (2, "f g h i j")]
    found = ngram_join.ngram_components(documents(spark, rows), 4, 85)
    assert sorted(map(tuple, found.collect())) == [(0, 2, 0), (1, 0, 1), (2, 2, 2)]


def test_prefixes_of_linked_sets_meet():
    for percent in (60, 80, 85, 100):
        for n in range(1, 80):
            length = ngram_join.prefix_length(n, percent)
            assert 1 <= length <= n
            least_common = -(-percent * n // 100)  # of a set of n, in a link with any other
            assert length + least_common == n + 1


def test_components_of_hubs_chains_and_loops(spark):
    rng = random.Random(9)
    links = [(0, i) for i in range(1, 300)] + [(i, i + 1) for i in range(1000, 1060)] + [(5000, 5000)]
    links += [(rng.randint(2000, 2040), rng.randint(2000, 2040)) for _ in range(30)]
    root = {}

    def find(n):
        while root.setdefault(n, n) != n:
            n = root[n]
        return n

    for a, b in links:
        if a != b:
            root[max(find(a), find(b))] = min(find(a), find(b))
    df = spark.createDataFrame(links * 2, "a BIGINT, b BIGINT").repartition(4)
    assert {r.node: r.root for r in components(df).collect()} == {n: find(n) for n in list(root)}
    assert components(df.limit(0)).count() == 0


def test_long_sets_link_as_brute_force(spark):
    rng = random.Random(11)
    base = " ".join(f"w{rng.randint(0, 300)}" for _ in range(2600))
    other = " ".join(f"w{rng.randint(0, 300)}" for _ in range(2200))
    texts = [base, other, base + " " + " ".join(base.split()[:50]), " ".join(base.split()[:2000]) + " " + other]
    texts += [edited(rng, base, n) for n in (5, 40, 60, 70, 80, 100, 140, 400)]
    texts += [edited(rng, other, n) for n in (10, 60, 90, 300)] + [" ".join(other.split()[:n]) for n in (1026, 1030, 1900)]
    rows = [*enumerate(texts), (None, base), (None, other)]
    for percent in (60, 85):
        found = ngram_join.ngram_components(documents(spark, rows), 4, percent)
        assert sorted(map(tuple, found.collect()), key=repr) == brute_force(rows, 4, percent)


def test_folded_parities_differ_at_most_where_sets_do():
    draw = np.random.default_rng(3)
    for n, m in ((1025, 1025), (1100, 2047), (2049, 5000), (9000, 9001)):
        common = draw.integers(0, 2**64, min(n, m) // 2, np.uint64)
        x, y = (np.concatenate([common, draw.integers(0, 2**64, k - len(common), np.uint64)]) for k in (n, m))
        bound = n + m - 2 * len(common)
        seen = ngram_join._differing(ngram_join._wide(x), ngram_join._wide(y))
        assert seen <= bound and (seen - bound) % 2 == 0 and seen > 0.1 * bound
        assert ngram_join._differing(ngram_join._wide(x), ngram_join._wide(x)) == 0
    assert ngram_join._wide(draw.integers(0, 2**64, 1024, np.uint64)) is None


def test_intermediate_tables_go(spark):
    before = set(Path(shared_folder(spark).removeprefix("file:")).glob("plateia/*"))
    ngram_join.ngram_components(documents(spark, [*enumerate(corpus(4, 4))]), 4, 85).collect()
    left = set(Path(shared_folder(spark).removeprefix("file:")).glob("plateia/*")) - before
    assert {path.name.rsplit("-", 1)[0] for path in left} <= {"profiles", "links"}
