"""Document fingerprints: invertible Bloom lookup sketches over paragraph digests.

A paragraph is a run of words of one line: eight, and then those up to a word whose
hash is divisible by six, nine more at most. What a line has left at its end is one
too. The cuts after an inserted word soon fall where they fell before. The keys of a
text are the distinct digests of all its paragraphs.

A sketch hashes each key to three of its cells; a cell holds a count, the exclusive or
of its keys and that of their checks. The fingerprint of a text is its number of keys
and a sketch of 24 cells of them all. Subtracting the sketches of two versions leaves
the keys that differ; peeling recovers them from cells that hold one key, which takes
them out of their other cells, until nothing is left. If peeling gets stuck, it is
retried with a larger sketch, in blocks of 24 cells: as many as suit the number of
differing keys, which the counts of the stuck sketch tell roughly, then eight times as
many. A new hash deals the keys to the blocks, blocks that peel are done, and the keys
of those that don't go on to the next size. So a wrong estimate costs a retry and no
key, a retry costs in proportion to its keys, every difference is peeled, and no two
sets are compared directly. Likeness is common keys over all keys of both.

Everything is a Column function; no Python runs on executors.

Rows: a NULL text is empty, an empty text has no keys, two of them are alike (1). A
word that ends in U+0001 counts as one with a hash divisible by six. The next document
is that of the next greater id, after the last the first; a NULL id counts as
less than any. Of rows that share an id, the one with the least text is the next of its
predecessor. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plateia.llm.common import written

# Eight words and those to a marked one, or the last words of a line; possessive, so linear.
MARK = "\x01"
PARAGRAPH = (
    r"(?:\S++[^\S\n]*+){8}+(?:[^\s\x01]++[^\S\n]++){0,8}+\S*+"
    r"|(?:\S++[^\S\n]*+){1,7}+"
)
NO_ID = -(1 << 63) - 1
CELLS = 24  # of a fingerprint
BLOCK = 24  # of a block of a larger sketch
LOAD = 7  # keys that a block is meant for
HASHES = 3
# The largest size has 2^30 blocks for each of the first retry.
SIZES = 12
ROUNDS = 14
ITEM = "struct<c:int,k:bigint>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    # An aggregate hands its value on as it is; a transform would copy what the body returns.
    return F.aggregate(F.array(F.lit(0)), value, lambda same, _: same, body)


def paragraph_digests(text: Column) -> Column:
    """Digests of the paragraphs of a text, in order."""
    words = F.regexp_extract_all(text, F.lit(r"\S++|\n"), F.lit(0))
    marked = F.transform(words, lambda word: F.when(
        (F.pmod(F.xxhash64(word), F.lit(6)) == 0) & (word != "\n"), F.concat(word, F.lit(MARK))).otherwise(word))
    found = F.regexp_extract_all(F.array_join(marked, " "), F.lit(PARAGRAPH), F.lit(0))
    return F.transform(found, lambda paragraph: F.xxhash64(F.trim(paragraph)))


def _check(key: Column) -> Column:
    return F.xxhash64(key, F.lit(99)).bitwiseAND(F.lit(0xFFFFFFFF))


def _placed(key: Column, sign: Column, block: Column, size: Column, cells: int) -> Column:
    """A signed key with its block and, as bits, the cells it has there: one in each third."""
    third = cells // HASHES
    bits = [
        F.call_function("shiftleft", F.lit(1 << r * third), F.pmod(F.xxhash64(key, F.lit(r), size), F.lit(third)).cast("int"))
        for r in range(HASHES)
    ]
    return F.struct(
        block.alias("b"), sign.alias("c"), key.alias("k"), _check(key).alias("x"),
        reduce(Column.bitwiseOR, bits).alias("at"))


def _bits(cells: int) -> Column:
    return F.array(*(F.lit(1 << place) for place in range(cells)))


def _in_cell(items: Column, bit: Column) -> Column:
    return F.filter(items, lambda t: t["at"].bitwiseAND(bit) > 0)


def _add(cell: Column, c: Column, item: Column) -> Column:
    return F.struct(
        (cell["c"] + c).alias("c"), cell["k"].bitwiseXOR(item["k"]).alias("k"),
        cell["x"].bitwiseXOR(item["x"]).alias("x"),
    )


def sketch(items: Column, cells: int) -> Column:
    """The cells of placed keys; those of signed keys are a difference of sketches."""
    zero = F.lit(0).cast("bigint")
    empty = F.struct(F.lit(0).alias("c"), zero.alias("k"), zero.alias("x"))

    return F.transform(_bits(cells), lambda bit: F.aggregate(
        _in_cell(items, bit), empty, lambda cell, t: _add(cell, t["c"], t)))


def subtract(a: Column, b: Column) -> Column:
    """Cells of the keys in which two sketches differ: count 1 for a's, -1 for b's."""
    return F.zip_with(a, b, lambda x, y: _add(x, -y["c"], y))


def peel(cells: Column, size: Column, n: int) -> Column:
    """(cells, found, on): what is left, and how many keys were recovered."""

    def taken(state: Column, items: Column) -> Column:
        cells = F.zip_with(state["cells"], _bits(n), lambda cell, bit: F.aggregate(
            _in_cell(items, bit), cell, lambda c, t: _add(c, -t["c"], t)))
        more = F.struct(
            cells.alias("cells"), (state["found"] + F.size(items)).alias("found"), F.lit(True).alias("on"))
        return F.when(F.size(items) > 0, more).otherwise(state.withField("on", F.lit(False)))

    def step(state: Column, _: Column) -> Column:
        pure = F.filter(state["cells"], lambda c: (F.abs(c["c"]) == 1) & (_check(c["k"]) == c["x"]))
        keys = F.array_distinct(F.transform(pure, lambda c: F.struct(c["c"].alias("c"), c["k"].alias("k"))))
        found = F.transform(keys, lambda t: _placed(t["k"], t["c"], F.lit(0).cast("bigint"), size, n))
        return F.when(state["on"], let(found, lambda items: taken(state, items))).otherwise(state)

    start = F.struct(cells.alias("cells"), F.lit(0).alias("found"), F.lit(True).alias("on"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step)


def _resolved(cells: Column, size: Column, n: int) -> Column:
    """How many keys a difference of sketches holds; NULL if peeling gets stuck."""
    def counted(state: Column) -> Column:
        clean = F.forall(state["cells"], lambda c: (c["c"] == 0) & (c["k"] == 0) & (c["x"] == 0))
        return F.when(clean, state["found"])

    return let(peel(cells, size, n), counted)


def _per_block(items: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of the items of each block, from items sorted by block."""
    n = F.size(items)
    starts = F.filter(F.sequence(F.lit(1), n), lambda i: (i == 1) | (
        F.element_at(items, i)["b"] != F.element_at(items, F.greatest(i - 1, F.lit(1)))["b"]))
    return let(starts, lambda at: F.transform(at, lambda start, i: let(
        F.slice(items, start, F.coalesce(F.get(at, i + 1), n + 1) - start), body)))


def whole_sketch(key_set: Column) -> Column:
    """The sketch of size 0, one block of all keys, which the fingerprint stores."""
    items = F.transform(key_set, lambda key: _placed(key, F.lit(1), F.lit(0).cast("bigint"), F.lit(0), CELLS))
    return let(items, lambda own: sketch(own, CELLS))


def estimated(cells: Column, n_a: Column, n_b: Column) -> Column:
    """About how many keys the difference of two whole sketches holds, 1 at least, from its counts.

    In a third of p cells the squared counts of d keys, of which one side has s
    more, add up to d + (s * s - d) / p on average.
    """
    third = CELLS // HASHES
    squares = F.aggregate(cells, F.lit(0).cast("bigint"), lambda n, cell: n + cell["c"].cast("bigint") * cell["c"]) / HASHES
    surplus = (n_a - n_b).cast("double")
    about = (third * squares - surplus * surplus) / (third - 1)
    return F.greatest(F.least(about, (n_a + n_b).cast("double")), F.abs(surplus), F.lit(1.0))


def tries(a: Column, b: Column, a_cells: Column, b_cells: Column) -> Column:
    """(found, left, sizes): differing keys peeled, items that no size resolved, sizes tried.

    ``a_cells`` and ``b_cells`` are the whole sketches of the sets, tried first.
    """
    def signed(key_set: Column, sign: int) -> Column:
        return F.transform(key_set, lambda key: F.struct(F.lit(sign).alias("c"), key.alias("k")))

    def retried(state: Column, size: Column) -> Column:
        blocks = F.call_function("shiftleft", state["blocks"], 3 * (size - 1))
        dealt = F.sort_array(F.transform(state["left"], lambda t: _placed(
            t["k"], t["c"], F.pmod(F.xxhash64(t["k"], F.lit(HASHES), size), blocks), size, BLOCK)))

        def outcome(block: Column) -> Column:
            return let(_resolved(sketch(block, BLOCK), size, BLOCK), lambda found: F.struct(
                found.alias("found"), F.when(found.isNull(), block).alias("stuck")))

        peeled = let(dealt, lambda items: _per_block(items, outcome))

        def after(done: Column) -> Column:
            stuck = F.flatten(F.transform(F.filter(done, lambda d: d["found"].isNull()), lambda d: d["stuck"]))
            return F.struct(
                F.aggregate(done, state["found"], lambda n, d: n + F.coalesce(d["found"], F.lit(0))).alias("found"),
                F.transform(stuck, lambda t: F.struct(t["c"].alias("c"), t["k"].alias("k"))).alias("left"),
                state["blocks"].alias("blocks"), (state["sizes"] + 1).alias("sizes"))

        return F.when(F.size(state["left"]) == 0, state).otherwise(let(peeled, after))

    def first(cells: Column) -> Column:
        def rest(found: Column) -> Column:
            everything = F.concat(signed(a, 1), signed(b, -1))
            left = F.when(found.isNull(), everything).otherwise(F.array().cast(f"array<{ITEM}>"))
            blocks = F.ceil(estimated(cells, F.size(a), F.size(b)) / LOAD)
            start = F.struct(
                F.coalesce(found, F.lit(0)).alias("found"), left.alias("left"), blocks.alias("blocks"),
                F.lit(1).alias("sizes"))
            return F.aggregate(F.sequence(F.lit(1), F.lit(SIZES - 1)), start, retried)

        return let(_resolved(cells, F.lit(0), CELLS), rest)

    return let(subtract(a_cells, b_cells), first)


def likeness(a: Column, b: Column, a_cells: Column, b_cells: Column) -> Column:
    """Common keys over all keys of both, from the number of differing ones."""
    def share(differing: Column) -> Column:
        everything = (F.size(a) + F.size(b) + differing) / 2
        return F.when(everything == 0, 1.0).otherwise((everything - differing) / everything)

    return let(tries(a, b, a_cells, b_cells)["found"], share)


def encode(key_set: Column, cells: Column) -> Column:
    """The fingerprint: the number of keys, then count, keys and checks of each cell of the whole sketch."""
    return F.concat_ws(".", F.size(key_set).cast("string"), F.array_join(F.transform(cells, lambda c: F.concat(
        F.lpad(F.hex(c["c"]), 8, "0"), F.lpad(F.hex(c["k"]), 16, "0"), F.lpad(F.hex(c["x"]), 8, "0"))), ""))


def next_ids(ids: DataFrame) -> DataFrame:
    """(id, next_id) of distinct ids: the next greater one, after the greatest the least.

    Ids are range-partitioned; only the first of each partition meets the others.
    """
    parts = written(
        ids.select("id").distinct().repartitionByRange("id").select("id", F.spark_partition_id().alias("part")),
        "sorted-ids",
    )
    firsts = parts.groupBy("part").agg(F.min("id").alias("first"))
    every = Window.orderBy("part")
    after = firsts.select(
        "part",
        F.coalesce(
            F.lead("first").over(every),
            F.min("first").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
        ).alias("follower"),
    )
    inside = F.lead("id").over(Window.partitionBy("part").orderBy("id"))
    return parts.withColumn("next_id", inside).join(after, "part").select(
        "id", F.coalesce("next_id", "follower").alias("next_id"))


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited version, and how alike they are.

    The edited text has its last quarter of code points replaced by the first as
    many of the next document.
    """
    no_id = F.lit(str(NO_ID)).cast("decimal(20,0)")
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint").cast("decimal(20,0)"), no_id).alias("id"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    quarter = F.floor(F.char_length("text") / 4).cast("int")
    wanted = rows.groupBy("id").agg(F.max(quarter).alias("wanted"))
    follows = next_ids(rows.select("id")).join(wanted, "id").select(
        F.col("next_id").alias("id"), F.col("id").alias("before"), "wanted")
    heads = (
        rows.join(follows, "id")
        .select(F.col("before").alias("id"), F.struct(
            F.expr("left(text, wanted)").alias("head"), paragraph_digests(F.col("text")).alias("digests")).alias("next"))
        .groupBy("id")
        .agg(F.min("next").alias("next"))
    )
    edited = F.concat(F.expr("left(text, n_chars - quarter)"), F.expr("left(next.head, quarter)"))
    digested = written(
        rows.join(heads, "id")
        .withColumn("n_chars", F.char_length("text"))
        .withColumn("quarter", F.floor(F.col("n_chars") / 4).cast("int"))
        .withColumn("edited", edited)
        .select(
            "id", F.col("n_chars").cast("bigint").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
            F.array_distinct(paragraph_digests(F.col("text"))).alias("own"),
            F.array_distinct(paragraph_digests(F.col("edited"))).alias("new"),
            F.array_distinct("next.digests").alias("follower"),
        ),
        "paragraph-digests",
    )
    cells = digested.withColumns({f"{name}_cells": whole_sketch(F.col(name)) for name in ("own", "new", "follower")})

    def like(a: str, b: str) -> Column:
        return likeness(*map(F.col, (a, b, f"{a}_cells", f"{b}_cells")))

    return cells.select(
        F.nullif("id", no_id).cast("bigint").alias("doc_id"), "n_chars", "edited_sha256",
        encode(F.col("own"), F.col("own_cells")).alias("fingerprint"),
        encode(F.col("new"), F.col("new_cells")).alias("edited_fingerprint"),
        like("own", "new").alias("near_edited"), like("own", "follower").alias("near_next"),
    )
