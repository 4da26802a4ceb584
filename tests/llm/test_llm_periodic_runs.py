"""Runs against a brute force over all periods, and the query against its contract."""

import hashlib
import random
from zlib import crc32

import numpy as np
import pytest
from helpers import documents, nothing
from pyspark.sql import functions as F

from plateia.llm import periodic_runs as pr
from plateia.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def brute_force(words, least):
    """Every maximal stretch of every period, kept where no lesser period fits it."""
    n, found = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, 2 * q):
                seg = words[i : i + length]
                if not any(seg[p:] == seg[:-p] for p in range(1, q)):
                    found.append((i, length, q))
            i = j + 1
    return sorted(found, key=lambda run: (run[0], run[2]))


def random_words(rng):
    size, kinds = rng.randint(0, 70), rng.choice([1, 2, 3, 6, 30])
    words = [b"%d" % rng.randrange(kinds) for _ in range(size)]
    if size and rng.random() < 0.5:
        a, p = rng.randrange(size), rng.randint(1, 9)
        words = words[:a] + [words[min(a + (i - a) % p, size - 1)] for i in range(a, size)]
    return words


def test_equals_brute_force_on_random_words():
    rng = random.Random(1)
    for _ in range(1500):
        words = random_words(rng)
        for least in (2, 5, 12):
            assert pr.document_runs(words, least) == brute_force(words, least), words


def test_fibonacci_words_and_one_repeated_word():
    a, b = [b"a"], [b"a", b"b"]
    while len(b) < 400:
        a, b = b, b + a
    assert pr.document_runs(b, 2) == brute_force(b, 2)
    assert pr.document_runs([b"x"] * 5000, 12) == [(0, 5000, 1)]


def test_suffix_tree_orders_suffixes_and_extends_in_constant_time():
    rng = random.Random(2)
    letters = [rng.randint(1, 3) for _ in range(300)]
    tree = pr.SuffixTree([*letters, 0])
    order, _ = tree.walk()
    assert order.tolist() == sorted(range(301), key=lambda i: [*letters, 0][i:])
    falling, _ = tree.walk(falling=True)
    assert falling.tolist() == sorted(range(301), key=lambda i: [-x for x in letters[i:]] + [-9])
    left, right = np.array([(i, j) for i in range(300) for j in range(300) if i != j]).T
    for i, j, found in zip(left, right, pr.Extensions(tree).of(left, right)):
        common = 0
        while max(i, j) + common < 300 and letters[i + common] == letters[j + common]:
            common += 1
        assert found == common


def expected(doc_id, text, least=12):
    words = (text or "").encode().split()
    h = crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a, own = g % n, list(words)
        p = 1 + (n - a) // (3 + g % 8)
        words = [own[i] if i < a else own[a + (i - a) % p] for i in range(n)]
    runs = brute_force(words, least)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    listing = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    exponent = 1000 * best[1] // best[2] if runs else None
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(runs), *best, exponent, sha(listing.encode()), sha(kept))


def test_awkward_rows(spark):
    rng = random.Random(4)
    texts = [None, "", " \t\n", "a " * 40, "a b\nc\td " * 9, "word", "x\x0by\x0cz " * 20, "a\xa0b " * 12, "ß " * 13]
    texts += [" ".join(w.decode() for w in random_words(rng)) for _ in range(80)]
    texts += [(None, "a " * 30), (7, "a " * 30), (7, "a " * 30), (-5, "q r " * 30)]
    df = documents(spark, texts, runs="own", start=1)
    rows = pr.periodic_runs(df, planted=True).drop("runs").collect()
    pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    assert sorted(map(repr, map(tuple, rows))) == sorted(repr(expected(*pair)) for pair in pairs)


def test_runs_are_listed_and_unplanted_texts_stay(spark):
    row = pr.periodic_runs(documents(spark, ["so " + "a b c " * 5 + "x"])).first()
    assert [tuple(r) for r in row.runs] == [(1, 15, 3)]
    assert (row.start, row.length, row.period, row.exponent_milli) == (1, 15, 3, 5000)
    assert row.collapsed_sha256 == hashlib.sha256(b"so a b c x").hexdigest()


def test_empty_table(spark):
    assert pr.periodic_runs(nothing(spark)).collect() == []


@pytest.fixture(scope="module")
def given(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    return {row.doc_id: row.text for row in docs}


def test_query_on_documents(spark, given):
    rows = QUERIES["op12_periodic_runs"](spark, FOLDER).collect()
    short = [r for r in rows if len((given[r.doc_id] or "").split()) < 1500]
    assert len(rows) == len(given) and len(short) > 100 and any(r.n_runs for r in short)
    assert [tuple(r) for r in short] == [expected(r.doc_id, given[r.doc_id]) for r in short]
