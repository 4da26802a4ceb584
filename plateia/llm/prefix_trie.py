"""The trie of conversation prefixes, with its weights, from collapsed whole sequences.

A node stands for a distinct sequence of first turns. The trie is never walked:

1. Conversations are rebuilt and every turn becomes a digest. A prefix of d turns is
   named by d and the exclusive or, over its places, of 128 bits hashed from place and
   digest; that takes no order of evaluation, so long conversations are cut into blocks.
2. Identical conversations collapse into one weighted sequence, kept by its smallest
   member, with the ids that end there in blocks of 4,096 consecutive ids.
3. A sequence that is a proper prefix of another goes out by an anti-join; the rest are
   the leaves.
4. Weighted prefixes of the sequences are added up per node.

Sums over a subtree are sums over the sequences that pass its top. Every node counts
once in them through its owner, the sequence with its smallest member: a sequence owns
all its nodes from some depth on. With T the length of a sequence's text, c(d) that of
its first d turns, w its weight and k its first owned depth, a node of depth d has

    saved = sum of w * (T - c(d - 1)) - (T - c(max(d, k) - 1)) over its sequences,

without the second part for sequences that own nothing.

Aggregates combine on the map side, so a very common first turn or conversation costs
one row per map task. A copied conversation is expanded once, whatever its weight.
Windows see one block: 1,024 places, or the rows of one conversation with 1,024
consecutive turn numbers. SHA-256 reads the ids of a node in order and cannot be split;
it gets them as joined strings, one for 4,096 ids, in a stream, and keeps its state only.
Nothing is collected or broadcast by hint.

Ties of a turn number go by role, then text, and equal rows are interchangeable. Rows
without conv_id belong to no conversation and are left out. An empty table has no
conversation and so no node, not even the root. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plateia.llm.common import written

_BLOCK = 10  # binary digits of a place or turn number within a block
_IDS = 12  # binary digits of a conv_id within a block of ends

NOTHING = hashlib.sha256().hexdigest()


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, digest, chars) of every turn, places from 0 without gaps."""
    block = F.shiftright(F.col("turn"), _BLOCK)
    turns = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("block", block)
    within = Window.partitionBy("conv_id", "block").orderBy(F.asc_nulls_first("turn"), "role", "text")
    before = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("block")).rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = turns.groupBy("conv_id", "block").agg(F.count(F.lit(1)).alias("n")).select(
        "conv_id", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    # A role cannot run into a text: its length goes first.
    content = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    placed = turns.select(
        "conv_id", "block", (F.row_number().over(within) - 1).alias("at"),
        F.sha2(content, 256).alias("digest"), F.char_length("text").cast("bigint").alias("chars"),
    )
    same = (placed.conv_id == starts.conv_id) & placed.block.eqNullSafe(starts.block)
    return placed.join(starts, same).select(
        placed.conv_id, (F.col("start") + F.col("at")).alias("place"), "digest", "chars"
    )


def rebuilt_turns(turns: DataFrame, group: int, shared: int) -> tuple[DataFrame, DataFrame]:
    """All conversations, and their rebuilt turns.

    Conversation c takes the first h turns of c - c % group, then its own after its
    first h, where h = crc32 of c in decimal digits, modulo ``shared``. A group has one
    first conversation of which fewer than ``shared`` turns are taken, so this join
    has bounded fan-out.
    """
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared
    conversations = turns.select("conv_id").distinct().select(
        "conv_id", (F.col("conv_id") - F.col("conv_id") % group).alias("first"), taken.alias("h")
    )
    heads = turns.filter((F.col("conv_id") % group == 0) & (F.col("place") < shared)).select(
        F.col("conv_id").alias("first"), "place", "digest", "chars"
    )
    own = turns.select("conv_id", "place", "digest", "chars", taken.alias("h"),
                       (F.col("conv_id") - F.col("conv_id") % group).alias("first"))
    lengths = heads.groupBy("first").agg((F.max("place") + 1).alias("n"))
    kept = own.filter("place >= h").join(lengths, "first", "left").select(
        "conv_id",
        (F.col("place") - F.col("h") + F.least("h", F.coalesce("n", F.lit(0)))).alias("place"),
        "digest",
        "chars",
    )
    borrowed = conversations.join(heads, "first").filter("place < h").select("conv_id", "place", "digest", "chars")
    return conversations.select("conv_id"), kept.unionByName(borrowed)


def _half(digest: Column, start: int) -> Column:
    """60 bits of a hexadecimal digest."""
    return F.conv(F.substring(digest, start, 15), 16, 10).cast("bigint")


def prefixes(turns: DataFrame) -> DataFrame:
    """For every turn the names of the prefix that ends there and of the one before, with text lengths."""
    name = F.sha2(F.concat(F.col("place").cast("string"), F.lit(":"), "digest"), 256)
    marked = turns.select(
        "conv_id", "place", F.shiftright("place", _BLOCK).alias("block"), "chars",
        _half(name, 1).alias("a"), _half(name, 16).alias("b"),
    )
    within = Window.partitionBy("conv_id", "block").orderBy("place")
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = marked.groupBy("conv_id", "block").agg(
        F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"), F.sum("chars").alias("chars")
    )
    zero = F.lit(0).cast("bigint")
    starts = whole.select(
        "conv_id", "block",
        F.coalesce(F.bit_xor("a").over(before), zero).alias("start_a"),
        F.coalesce(F.bit_xor("b").over(before), zero).alias("start_b"),
        F.coalesce(F.sum("chars").over(before), zero).alias("start_chars"),
    )
    local = marked.select(
        "conv_id", "block", "place", "chars", F.col("a").alias("own_a"), F.col("b").alias("own_b"),
        F.bit_xor("a").over(within).alias("a"),
        F.bit_xor("b").over(within).alias("b"),
        F.sum("chars").over(within).alias("until"),
    )
    a, b = (F.col(f"start_{x}").bitwiseXOR(F.col(x)) for x in "ab")
    return local.join(starts, ["conv_id", "block"]).select(
        "conv_id",
        (F.col("place") + 1).alias("depth"),
        a.alias("a"),
        b.alias("b"),
        a.bitwiseXOR(F.col("own_a")).alias("up_a"),
        b.bitwiseXOR(F.col("own_b")).alias("up_b"),
        "chars",
        (F.col("start_chars") + F.col("until") - F.col("chars")).alias("before"),
    )


def end_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the joined ids of each (depth, a, b), from its conversations."""
    parts = (
        ends.withColumn("part", F.shiftright("conv_id", _IDS))
        .groupBy("depth", "a", "b", "part")
        .agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
        .select("depth", "a", "b", "part", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))
    )

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None

        def finished(rows: list) -> pa.RecordBatch:
            columns = list(zip(*rows)) or [[], [], [], []]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            return pa.RecordBatch.from_arrays(arrays, ["depth", "a", "b", "ends_sha256"])

        for batch in batches:
            done = []
            columns = [batch.column(name).to_pylist() for name in ("depth", "a", "b", "ids")]
            for *key, ids in zip(*columns):
                if key != node:
                    if node is not None:
                        done.append((*node, state.hexdigest()))
                    node, state = key, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield finished(done)
        if node is not None:
            yield finished([(*node, state.hexdigest())])

    sorted_parts = parts.repartition("depth", "a", "b").sortWithinPartitions("depth", "a", "b", "part")
    return sorted_parts.select("depth", "a", "b", "ids").mapInArrow(
        digests, "depth BIGINT, a BIGINT, b BIGINT, ends_sha256 STRING"
    )


def prefix_trie(conversations: DataFrame, group: int = 100, shared: int = 6) -> DataFrame:
    """One row per node of the trie of rebuilt conversations."""
    key = ["depth", "a", "b"]
    turns = written(ordered_turns(conversations), "trie-turns")
    everyone, rebuilt = rebuilt_turns(turns, group, shared)
    rows = written(prefixes(rebuilt), "trie-prefixes")
    zero = F.lit(0).cast("bigint")

    # Whole sequences: each conversation by the name of all its turns, then collapsed.
    last = rows.groupBy("conv_id").agg(
        F.max_by(F.struct("depth", "a", "b", (F.col("before") + F.col("chars")).alias("total")), "depth").alias("end")
    )
    whole = everyone.join(last, "conv_id", "left").select(
        "conv_id", *(F.coalesce(F.col(f"end.{name}"), zero).alias(name) for name in (*key, "total"))
    )
    whole = written(whole, "trie-whole")
    sequences = written(
        whole.groupBy(*key).agg(
            F.count(F.lit(1)).alias("weight"), F.min("conv_id").alias("conv_id"), F.first("total").alias("total")
        ),
        "trie-sequences",
    )

    # Their prefixes, the root included, and the nodes these make.
    kept = sequences.select("conv_id", F.col("depth").alias("length"), "weight", "total")
    passed = rows.join(kept, "conv_id").unionByName(
        kept.select(
            "conv_id", *(zero.alias(name) for name in key),
            *(F.lit(None).cast("bigint").alias(name) for name in ("up_a", "up_b")),
            zero.alias("chars"), zero.alias("before"), "length", "weight", "total",
        )
    )
    passed = written(passed, "trie-passed")
    nodes = written(
        passed.groupBy(*key).agg(
            F.min("conv_id").alias("conv_id"), F.sum("weight").alias("n_convs"),
            F.first("up_a").alias("up_a"), F.first("up_b").alias("up_b"), F.first("before").alias("before"),
        ),
        "trie-nodes",
    )
    # What a sequence owns starts at the least depth of the nodes it is the smallest of.
    owned = nodes.groupBy("conv_id").agg(
        F.min("depth").alias("own_depth"), F.min_by("before", "depth").alias("own_before")
    )
    proper = passed.filter("depth < length").select(*key).distinct()
    leaves = sequences.join(proper, key, "left_anti").select("conv_id", F.lit(1).cast("bigint").alias("leaf"))
    known = kept.select("conv_id").join(owned, "conv_id", "left").join(leaves, "conv_id", "left")
    once = F.when(F.col("own_depth").isNull(), zero).otherwise(
        F.col("total") - F.when(F.col("own_depth") > F.col("depth"), F.col("own_before")).otherwise(F.col("before"))
    )
    sums = passed.join(known, "conv_id").groupBy(*key).agg(
        F.sum(F.coalesce("leaf", zero)).alias("n_leaves"),
        F.sum(F.col("weight") * (F.col("total") - F.col("before")) - once).alias("saved_tokens"),
    )
    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("up_a").alias("a"),
                                                 F.col("up_b").alias("b")).agg(F.count(F.lit(1)).alias("n_children"))
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("a").alias("up_a"), F.col("b").alias("up_b"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    return (
        nodes.join(parents, ["depth", "up_a", "up_b"], "left")
        .join(sums, key)
        .join(children, key, "left")
        .join(end_digests(whole.select(*key, "conv_id")), key, "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs",
            F.coalesce("n_children", zero).alias("n_children"), "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"),
        )
    )
