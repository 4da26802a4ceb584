"""The prefix trie against one built turn by turn in memory."""

import hashlib
import random
from collections import defaultdict
from zlib import crc32

from pyspark.sql import functions as F

from plateia.llm.prefix_trie import prefix_trie

SCHEMA = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"


def brute_force(rows, group=100, shared=6):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(found)] for c, found in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in turns:
        h = crc32(str(c).encode()) % shared
        first = c - (abs(c) % group) * (1 if c >= 0 else -1)
        rebuilt = tuple(turns.get(first, [])[:h] + turns[c][h:])
        for d in range(len(rebuilt) + 1):
            members[rebuilt[:d]].append(c)
        ends[rebuilt].append(c)
    out = []
    for node, found in members.items():
        below = [other for other in members if other[: len(node)] == node]
        children = [other for other in below if len(other) == len(node) + 1]
        leaves = [other for other in below if not any(o[: len(other)] == other and o != other for o in below)]
        saved = sum((len(members[o]) - 1) * (len(o[-1][1]) if o else 0) for o in below)
        listing = ",".join(map(str, sorted(ends[node])))
        out.append((
            min(found), len(node), min(members[node[:-1]]) if node else None, len(found), len(children),
            len(leaves), saved, hashlib.sha256(listing.encode()).hexdigest(),
        ))
    return sorted(map(repr, out))


def found(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    df = df.withColumns({"depth": F.lit("own"), "a": F.lit(1), "place": F.lit(2)})
    return sorted(repr(tuple(r)) for r in prefix_trie(df, **options).collect())


def random_rows(rng, convs):
    rows = []
    for c in convs:
        for turn in rng.sample([None, *range(8)], rng.randint(1, 8)):
            rows.append((c, turn, rng.choice(["user", "", None, "assistant"]), rng.choice(["é", "bb", "", None])))
    return rows


def test_equals_brute_force_on_random_conversations(spark):
    rng = random.Random(3)
    rows = random_rows(rng, [*range(0, 60), *range(99, 240), -1, -7, -100, -130, 4095, 4096, 8192])
    rows += rows[:40]
    rows += [(None, 0, "user", "lost"), (500, 5000, "user", "far"), (500, 0, "user", "near"), (500, 2048, None, "mid")]
    rows += [(777, 3, "user", "tie b"), (777, 3, "user", "tie a"), (777, 3, "assistant", "tie c")]
    assert found(spark, rows) == brute_force(rows)
    assert found(spark, rows, group=10, shared=3) == brute_force(rows, 10, 3)


def test_many_copies_and_a_long_conversation(spark):
    rows = [(c, t, "user", f"hello {t}") for c in range(1000, 3000) for t in range(3)]
    rows += [(7, t, "user", str(t % 5)) for t in range(2600)]
    nodes = {
        (r.conv_id, r.depth): r for r in prefix_trie(spark.createDataFrame(rows, SCHEMA)).collect()
    }
    assert len(nodes) > 2600 and nodes[(7, 0)].n_convs == 2001
    assert nodes[(1000, 3)].n_convs == 2000 and nodes[(1000, 3)].n_leaves == 1
    listing = ",".join(map(str, range(1000, 3000)))
    assert nodes[(1000, 3)].ends_sha256 == hashlib.sha256(listing.encode()).hexdigest()
    assert nodes[(1000, 1)].saved_tokens == 3 * 1999 * len("hello 0")


def test_turnless_and_prefix_conversations(spark):
    rows = [(c, t, "user", f"{t}") for c in (200, 203, 207) for t in range(c - 199)]
    rows += [(c, 0, "user", "only") for c in range(300 + 1, 330)]
    assert found(spark, rows) == brute_force(rows)


def test_empty_table(spark):
    assert prefix_trie(spark.createDataFrame([], SCHEMA)).collect() == []
