import hashlib
import random

from helpers import documents, nothing
from plateia.llm import fingerprints as fp
from pyspark.sql import functions as F


def text_of(rng, sentences):
    return " ".join(
        " ".join(f"w{rng.randint(0, 5000)}" for _ in range(rng.randint(1, 20))) + rng.choice(".,;\n") for _ in range(sentences))


def cells_of(fingerprint):
    """Number of keys and the (count, key, check) of every cell of a stored fingerprint."""
    n, cells = fingerprint.split(".")
    cells = [cells[at : at + 32] for at in range(0, len(cells), 32)]
    return int(n), [(int(c[:8], 16), int(c[8:24], 16), int(c[24:], 16)) for c in cells]


def key_hashes(spark):
    """The three places and the check of a key, by the hash of the sketches."""
    def signed(key):
        return key - (1 << 64) if key >> 63 else key

    known = {}

    def hashed(key):
        if key not in known:
            row = spark.range(1).select(
                *(F.expr(f"pmod(xxhash64({signed(key)}L, {r}, 0), {fp.CELLS // 3})") for r in range(3)),
                F.expr(f"xxhash64({signed(key)}L, 99) & 4294967295L")).first()
            known[key] = tuple(row)
        return known[key]

    return hashed


def peeled(a, b, hashed):
    """Common keys over all keys by peeling two stored fingerprints alone; None if that gets stuck."""
    (n, x), (m, y) = cells_of(a), cells_of(b)
    left = [(c - d, k ^ l, p ^ q) for (c, k, p), (d, l, q) in zip(x, y)]
    found = set()
    while True:
        pure = next(((c, k, p) for c, k, p in left if abs(c) == 1 and hashed(k)[3] == p), None)
        if pure is None or pure[1] in found:
            break
        found.add(pure[1])
        for third, place in enumerate(hashed(pure[1])[:3]):
            at = third * fp.CELLS // 3 + place
            left[at] = (left[at][0] - pure[0], left[at][1] ^ pure[1], left[at][2] ^ pure[2])
    if any(any(cell) for cell in left):
        return None
    return (n + m - len(found)) / (n + m + len(found)) if n + m else 1.0


def test_peeling_recovers_every_difference(spark):
    rng = random.Random(2)
    rows = []
    for size in [*range(60), 500, 3000]:
        common = [rng.getrandbits(62) for _ in range(rng.randint(0, size))]
        left = [rng.getrandbits(62) for _ in range(rng.randint(0, size // 2))]
        right = [rng.getrandbits(62) for _ in range(rng.randint(0, size // 2))]
        rows.append((common + left, right + common, len(left) + len(right)))
    df = spark.createDataFrame(rows, "a ARRAY<BIGINT>, b ARRAY<BIGINT>, n INT")
    found = df.select("n", F.size("a").alias("most"), fp.tries(
        F.col("a"), F.col("b"), fp.whole_sketch(F.col("a")), fp.whole_sketch(F.col("b"))).alias("t")).collect()
    for row in found:
        assert row.t.found == row.n and row.t.left == []  # at every size, however many differ
    assert all(row.t.sizes <= 2 for row in found if 0 < row.n <= 8)
    assert any(row.t.sizes >= 3 for row in found if row.most > 100)  # more keys than 16 blocks hold: retried larger


def test_the_first_retry_suits_the_difference(spark):
    rng = random.Random(8)
    rows = []
    for common, differing in ((0, 2000), (3000, 2000), (0, 300), (2000, 40)):
        keys = [rng.getrandbits(62) for _ in range(common + differing)]
        rows += [(keys[: common + cut], keys[:common] + keys[common + cut :], differing) for cut in (differing // 2, 0)]
    df = spark.createDataFrame(rows, "a ARRAY<BIGINT>, b ARRAY<BIGINT>, n INT")
    a_cells, b_cells = fp.whole_sketch(F.col("a")), fp.whole_sketch(F.col("b"))
    for row in df.select("n", fp.tries(F.col("a"), F.col("b"), a_cells, b_cells).alias("t")).collect():
        assert row.t.found == row.n and row.t.left == []
        assert row.t.sizes <= 4  # the stored sketch, and three more even where the estimate is half the difference


def test_likeness_is_the_share_of_common_paragraphs(spark):
    rng = random.Random(3)
    texts = [text_of(rng, rng.randint(1, 120)) for _ in range(40)]
    texts += [None, "", "  ", texts[0], "x" * 30_000, "word " * 9000, "...,,,", text_of(rng, 2500)]
    rows = {r.doc_id: r for r in fp.fingerprint_edits(documents(spark, texts, id=1, head="x", own="y")).collect()}
    edits = {}
    for i, text in enumerate(texts):
        own, after = text or "", texts[(i + 1) % len(texts)] or ""
        q = len(own) // 4
        edits[i] = own[: len(own) - q] + after[:q]
        assert rows[i].n_chars == len(own)
        assert rows[i].edited_sha256 == hashlib.sha256(edits[i].encode()).hexdigest()
    assert rows[0].fingerprint == rows[43].fingerprint != rows[1].fingerprint
    digests = documents(spark, [t or "" for t in texts] + list(edits.values())).select(
        "doc_id", fp.paragraph_digests(F.col("text")).alias("d"))
    pairs = digests.filter(F.col("doc_id") < len(texts)).join(
        digests.select((F.col("doc_id") - len(texts)).alias("doc_id"), F.col("d").alias("e")), "doc_id")
    for r in pairs.collect():
        a, b = set(r.d), set(r.e)
        assert abs(rows[r.doc_id].near_edited - (len(a & b) / len(a | b) if a | b else 1.0)) < 1e-12
    assert all(0 <= r.near_next <= 1 for r in rows.values())
    long = [i for i in range(40) if len(texts[i]) > 2000]
    assert sum(rows[i].near_edited > rows[i].near_next for i in long) == len(long)


def test_likeness_follows_from_the_stored_fingerprints(spark):
    rng = random.Random(6)
    texts = [text_of(rng, n) for n in (3, 6, 9, 12, 60)] + ["", None]
    rows = {r.doc_id: r for r in fp.fingerprint_edits(documents(spark, texts)).collect()}
    hashed, told = key_hashes(spark), 0
    for i, row in rows.items():
        after = rows[(i + 1) % len(texts)].fingerprint
        for other, like in ((row.edited_fingerprint, row.near_edited), (after, row.near_next)):
            own = peeled(row.fingerprint, other, hashed)
            told += own is not None
            assert own is None or abs(own - like) < 1e-12
    assert told >= 7
    empty, none = cells_of(rows[5].fingerprint), cells_of(rows[6].fingerprint)
    assert empty == none == (0, [(0, 0, 0)] * fp.CELLS) and rows[5].near_next == 1.0


def test_next_ids_over_partitions(spark):
    ids = [5, -3, 1 << 62, 9, 0, *range(100, 400, 3)]
    df = spark.createDataFrame([(i,) for i in ids * 2], "id BIGINT").repartition(6)
    order = sorted(ids)
    assert {r.id: r.next_id for r in fp.next_ids(df).collect()} == dict(zip(order, order[1:] + order[:1]))


def test_awkward_rows(spark):
    assert fp.fingerprint_edits(nothing(spark)).count() == 0
    alone = fp.fingerprint_edits(documents(spark, ["abcdefgh"])).first()
    assert alone.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest()
    rows = fp.fingerprint_edits(documents(spark, [(1, "one two. three"), (1, "one two. three"), (None, "a. b. c"), (1, "b"), (-(1 << 63), "x")])).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows) == [(False, -(1 << 63)), *[(False, 1)] * 3, (True, 0)]


def test_likeness_is_that_of_all_paragraphs_at_every_length(spark):
    rng = random.Random(5)
    texts = []
    for n in (30, 100, 400, 3200):
        lines = [" ".join(f"w{rng.randint(0, 5000)}" for _ in range(9)) + "." for _ in range(n)]
        copy = list(lines)
        for at in range(25, n, 50):  # scattered
            copy[at] = f"changed {at} " + copy[at]
        texts += ["\n".join(lines), "\n".join(copy)]
    df = documents(spark, texts)
    found = {r.doc_id: r for r in fp.fingerprint_edits(df).collect()}
    edits = [t[: len(t) - len(t) // 4] + texts[(i + 1) % len(texts)][: len(t) // 4] for i, t in enumerate(texts)]
    digests = [set(r.d) for r in documents(spark, texts + edits).orderBy("doc_id").select(
        fp.paragraph_digests(F.col("text")).alias("d")).collect()]
    for i in range(len(texts)):
        for like, other in ((found[i].near_next, digests[(i + 1) % len(texts)]), (found[i].near_edited, digests[len(texts) + i])):
            assert abs(like - len(digests[i] & other) / len(digests[i] | other)) < 1e-12, i
        assert i % 2 or found[i].near_next > 0.9


def test_paragraphs_find_back_after_an_inserted_word(spark):
    rng = random.Random(7)
    words = [f"w{rng.randint(0, 5000)}" for _ in range(2000)]
    texts = [" ".join(words), " ".join(words[:3] + ["new"] + words[3:]), " ".join(words[:2] + words[3:])]
    plain, *changed = (r.d for r in documents(spark, texts).orderBy("doc_id").select(
        fp.paragraph_digests(F.col("text")).alias("d")).collect())
    for other in changed:
        assert len(set(plain) & set(other)) > 0.9 * len(plain)
    assert 2000 / 17 <= len(plain) <= 2000 / 9 + 1
    lines = documents(spark, ["a b\n\nc d e", "a  b\nc d\te"]).orderBy("doc_id").select(
        fp.paragraph_digests(F.col("text")).alias("d")).collect()
    assert lines[0].d == lines[1].d and len(lines[0].d) == 2
