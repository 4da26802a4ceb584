"""Similarity self-join of word n-gram sets with grouped prefixes, and its components.

Two sets link when 100 * intersection >= percent * union. Texts of one set form a
class, so copies are compared once. Shingles are ordered rarest first; two linked
sets share one of the first n - ceil(t n) + 1, their prefix.

1. Classes with the same size and prefix are collapsed into one group.
2. Groups meet through the prefix shingles they share. First each group meets
   three pivots of every such list: the least, the greatest, and the one with the
   fewest rarer shingles, which is the least edited of near copies. Each member
   meets its group's representative. Pairs of fitting sizes, less those that a
   bitmap of parities rules out, are verified on whole sets; links give components.
3. Lists whose members are all of one component are closed: nothing in them could
   change a component. In the others, members meet a few drawn pivots of other
   components, and links give components anew.
4. In lists still open, every pair of members from different components that sizes,
   prefix places and parities do not rule out is verified. None is left out.

So near copies of one text mostly cost as many pairs as there are copies; the last
step compares bitmaps of open lists within the join and emits what may link.

Rarity is counted in a fixed number of hash cells over all shingles of all
documents. It only orders shingles: any order gives the same links, and a frequent
shingle raises its cell however large the corpus. Shingles are 64-bit hashes.

Parities of long sets are kept in as many bits as the sets have shingles, so they
rule out unrelated pairs at every length; whole sets are sent for the rest only.
Tables that no later step reads are deleted.

Rows: texts without words, empty and NULL ones have no shingles, link with nothing
and are their own component. Texts with fewer words than n have one shingle, the
whole sequence. NULL and repeated ids are rows of their own; the component of rows
without any id is NULL. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plateia.llm.common import discard, only, written
from plateia.llm.components import components

CELL_BITS = 18
FILTER_BITS = 25
PARITY_BITS = 1024
DRAWN = 8


def shingles(text: str | None, words: int) -> np.ndarray:
    """Distinct hashes of the word n-grams; A-Z are lower-cased, blanks are ASCII ones."""
    parts = (text or "").encode().lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    hashed = pd.util.hash_array(np.array(parts, dtype=object), categorize=False)
    width = min(words, len(parts))
    mixed = np.full(len(parts) - width + 1, np.uint64(width), np.uint64)
    for i in range(width):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + hashed[i : len(parts) - width + 1 + i]
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _cells(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def rarity(docs: DataFrame, words: int) -> np.ndarray:
    """The rank of every cell, by the shingles of all documents in it: a fixed size."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << CELL_BITS, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                cells = [_cells(shingles(text.as_py(), words)) for text in batch["text"].slice(at, 200)]
                counts += np.bincount(np.concatenate(cells), minlength=len(counts))
        cells = np.flatnonzero(counts)
        for at in range(0, len(cells), 50_000):
            some = cells[at : at + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], ["cell", "n"])

    cells = docs.mapInArrow(counted, "cell BIGINT, n BIGINT").groupBy("cell").agg(F.sum("n").alias("n"))
    totals = np.zeros(1 << CELL_BITS, np.int64)
    found = cells.toArrow()
    totals[found["cell"].to_numpy()] = found["n"].to_numpy()
    ranks = np.empty(len(totals), np.int32)
    ranks[np.argsort(totals, kind="stable")] = np.arange(len(totals), dtype=np.int32)
    return ranks


def _digest(hashes: np.ndarray) -> tuple[int, int]:
    raw = hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()
    return tuple(np.frombuffer(raw, "<i8").tolist())


def _parity(hashes: np.ndarray, bits: int = PARITY_BITS) -> np.ndarray:
    """Whether each of a fixed number of buckets holds an odd number of the hashes.

    The buckets in which two sets differ are at most the hashes in which they do.
    """
    counts = np.bincount((hashes & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits(counts & 1).view(np.int64)


def _wide(hashes: np.ndarray) -> bytes | None:
    """Parities in as many buckets as a long set has hashes or more, a power of two.

    In few buckets the parities of any two long sets differ by half of the buckets,
    which says nothing; in these, unrelated sets differ by about as much as they hold.
    """
    if len(hashes) <= PARITY_BITS:
        return None
    return _parity(hashes, 1 << (len(hashes) - 1).bit_length()).tobytes()


def _differing(x: bytes, y: bytes) -> int:
    """Buckets in which two parities differ, the wider folded to the narrower: parities add."""
    wide, narrow = sorted((np.frombuffer(side, np.uint64) for side in (x, y)), key=len, reverse=True)
    folded = np.bitwise_xor.reduce(wide.reshape(-1, len(narrow)), axis=0)
    return int(np.bitwise_count(folded ^ narrow).sum())


def profiles(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """doc_id, mark, n, the class (node, check), parities, the prefix and its group, of every document."""
    ranks = rarity(docs, words)

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                rows = []
                part = batch.slice(at, 2000)
                for doc_id, mark, text in zip(part["doc_id"].to_pylist(), part["mark"].to_pylist(), part["text"]):
                    own = shingles(text.as_py(), words)
                    if not len(own):
                        rows.append((doc_id, mark, 0, *[None] * 6))
                        continue
                    order = np.lexsort((own, ranks[_cells(own)]))
                    prefix = own[order[: prefix_length(len(own), percent)]].view(np.int64)
                    group = _digest(np.append(prefix, len(own)))[0]
                    rows.append((doc_id, mark, len(own), *_digest(own), _parity(own), _wide(own), group, prefix))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    names = ["doc_id", "mark", "n", "node", "check", "parity", "wide", "group", "prefix"]
    kinds = [pa.int64(), pa.string(), *[pa.int64()] * 3, pa.list_(pa.int64()), pa.binary(), pa.int64(), pa.list_(pa.int64())]
    return docs.mapInArrow(
        profile,
        "doc_id BIGINT, mark STRING, n BIGINT, node BIGINT, check BIGINT, parity ARRAY<BIGINT>, wide BINARY, "
        "group BIGINT, prefix ARRAY<BIGINT>",
    )


def _fits(a: Column, b: Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _pairs(df: DataFrame, a: Column, b: Column) -> DataFrame:
    return df.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).filter("a <> b").distinct()


def _bitmap(bits: DataFrame) -> np.ndarray:
    """The set bits of ``bits`` (bit) as masks of 63: a fixed number, whatever the corpus."""
    marked = bits.groupBy(F.floor(F.col("bit") / 63).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod("bit", F.lit(63)).cast("int"))).alias("mask")
    ).toArrow()
    masks = np.zeros((1 << FILTER_BITS) // 63 + 1, np.int64)
    masks[marked["word"].to_numpy()] = marked["mask"].to_numpy()
    return masks


def _marked(masks: np.ndarray, bit: np.ndarray) -> np.ndarray:
    return np.flatnonzero(masks[bit // 63] >> (bit % 63) & 1)


def _bits(parity: str, name: str) -> list[Column]:
    return [F.get(parity, F.lit(i)).alias(f"{name}{i}") for i in range(PARITY_BITS // 64)]


def _few_differ(m: str, x: str, n: str, y: str, percent: int) -> Column:
    """Whether two sets may link: 100 common >= percent * union, and union = common + differing."""
    differing = sum(
        (F.bit_count(F.col(f"{x}{i}").bitwiseXOR(F.col(f"{y}{i}"))) for i in range(PARITY_BITS // 64)), F.lit(0)
    )
    return differing * (100 + percent) <= (F.col(m) + F.col(n)) * (100 - percent)


def _reach(n: Column, place: Column, m: Column, other: Column, percent: int) -> Column:
    """Whether sets with a common shingle at these places may link; groups' own lists have no places.

    They share at most what lies on the same side of the shingle in both.
    """
    most = 1 + F.least(n - place - 1, m - other - 1) + F.least(place, other)
    return (place < 0) | (most * 100 >= percent * (n + m - most))


class _Verifier:
    """Exact checks of pairs of classes, on whole shingle sets."""

    def __init__(self, docs: DataFrame, classes: DataFrame, words: int, percent: int):
        self.docs, self.classes, self.words, self.percent = docs, classes, words, percent

    def sifted(self, pairs: DataFrame) -> DataFrame:
        """Pairs that their parities do not rule out: linked sets differ in few hashes.

        The parities of a fixed size come first. Pairs of two long sets, of which
        these rule out few, then meet by parities that are as wide as the sets.
        """
        known = self.classes.groupBy("node").agg(F.min("parity").alias("parity"), F.min("n").alias("n"))
        x = known.select(F.col("node").alias("a"), F.col("n").alias("m"), *_bits("parity", "x"))
        y = known.select(F.col("node").alias("b"), "n", *_bits("parity", "y"))
        both = pairs.join(x, "a").join(y, "b").filter(_few_differ("m", "x", "n", "y", self.percent))
        rough = written(both.select("a", "b", "m", "n"), "rough-pairs")
        percent = self.percent

        def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sizes = batch["m"].to_numpy() + batch["n"].to_numpy()
                kept = [
                    i for i, size in enumerate(sizes.tolist())
                    if _differing(batch["x"][i].as_py(), batch["y"][i].as_py()) * (100 + percent)
                    <= size * (100 - percent)
                ]
                yield batch.select(["a", "b"]).take(pa.array(kept, pa.int64()))

        long = F.least("m", "n") > PARITY_BITS
        wide = self.classes.filter(F.col("n") > PARITY_BITS).groupBy("node").agg(F.min("wide").alias("wide"))
        x = wide.select(F.col("node").alias("a"), F.col("wide").alias("x"))
        y = wide.select(F.col("node").alias("b"), F.col("wide").alias("y"))
        tested = rough.filter(long).join(x, "a").join(y, "b").select("a", "b", "m", "n", "x", "y")
        rest = rough.filter(~long).select("a", "b")
        sifted = written(tested.mapInArrow(near, "a BIGINT, b BIGINT").unionByName(rest), "sifted-pairs")
        discard(rough)
        return sifted

    def _sets(self, nodes: DataFrame) -> DataFrame:
        """The hashes of the classes in ``nodes``, from the whole text of the least id of each.

        Rows of one id are all read, as are those without an id if a class has no other.
        """
        words = self.words
        needed = self.classes.join(nodes, "node", "left_semi").select(F.xxhash64("least_id").alias("key")).distinct()

        def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, 500):
                    sets = [shingles(text.as_py(), words) for text in batch["text"].slice(at, 500)]
                    rows = [(_digest(own)[0], own.tobytes()) for own in sets if len(own)]
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["node", "hashes"])

        texts = self.docs.select("text", F.xxhash64("doc_id").alias("key")).join(needed, "key", "left_semi")
        return written(texts.select("text").mapInArrow(whole, "node BIGINT, hashes BINARY"), "shingle-sets")

    def links(self, pairs: DataFrame) -> DataFrame:
        percent = self.percent

        def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                kept = []
                for i in range(batch.num_rows):
                    x = np.frombuffer(batch["x"][i].as_buffer(), np.uint64)
                    y = np.frombuffer(batch["y"][i].as_buffer(), np.uint64)
                    if len(x) > len(y):
                        x, y = y, x
                    place = np.searchsorted(y, x)
                    place[place == len(y)] = 0
                    common = int((y[place] == x).sum())
                    if 100 * common >= percent * (len(x) + len(y) - common):
                        kept.append(i)
                if kept:
                    yield batch.select(["a", "b"]).take(pa.array(kept))

        near = self.sifted(pairs)
        sets = self._sets(near.select(F.explode(F.array("a", "b")).alias("node")).distinct())
        x = sets.select(F.col("node").alias("a"), F.col("hashes").alias("x"))
        y = sets.select(F.col("node").alias("b"), F.col("hashes").alias("y"))
        both = near.join(x, "a").join(y, "b").select("a", "b", "x", "y")
        found = written(both.mapInArrow(linked, "a BIGINT, b BIGINT").distinct(), "similar-pairs")
        discard(near, sets)
        return found


def _postings(heads: DataFrame, shared: DataFrame) -> DataFrame:
    """Prefix entries of the groups; most shingles of one group alone are left out at once."""
    masks = _bitmap(shared.select(F.col("shingle").bitwiseAND(F.lit((1 << FILTER_BITS) - 1)).alias("bit")))

    def posted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prefix = batch["prefix"]
            sizes = np.asarray(prefix.value_lengths())
            values = prefix.flatten().to_numpy()
            owner = np.repeat(np.arange(len(sizes)), sizes)
            place = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            hit = _marked(masks, values & ((1 << FILTER_BITS) - 1))
            for at in range(0, len(hit), 50_000):
                some = hit[at : at + 50_000]
                own = pa.array(owner[some])
                yield pa.RecordBatch.from_arrays(
                    [batch[name].take(own) for name in ("group", "node", "n")]
                    + [pa.array(place[some]), pa.array(values[some])],
                    ["group", "node", "n", "place", "shingle"],
                )

    return heads.mapInArrow(posted, "group BIGINT, node BIGINT, n BIGINT, place BIGINT, shingle BIGINT")


def _open(lists: DataFrame, classes: DataFrame, crowd: DataFrame, links: DataFrame) -> DataFrame:
    """Entries (key, node, n, place, root) of prefix lists and of groups in several components.

    Every member of a group stands in the lists of its group. Groups are lists of
    their own, without places (-1). A list whose members are all of one component
    is closed: nothing in it could change a component.
    """
    rooted = components(links)
    members = classes.join(lists.select("group").distinct().unionByName(
        crowd.select("group")).distinct(), "group", "left_semi").join(rooted, "node", "left").select(
        "group", "node", "n", F.coalesce("root", "node").alias("root"))
    members = written(members, "rooted-classes")
    listed = lists.select("group", F.col("shingle").alias("key"), "place").join(members, "group")
    own = members.join(crowd.select("group").distinct(), "group", "left_semi").withColumns({
        "key": F.col("group"), "place": F.lit(-1).cast("bigint")})
    names = ["key", "node", "n", "place", "root"]
    entries = listed.select(*names).unionByName(own.select(*names))
    mixed = entries.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high")
    opened = written(entries.join(mixed.select("key"), "key", "left_semi"), "open-lists")
    discard(members)
    return opened


def similarity_classes(docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Profiles of all documents, and the (node, root) of every class that links with another."""
    rows = only(docs, doc_id=F.col("doc_id").cast("bigint"), mark=F.md5("text"), text="text")
    profile = written(profiles(rows, words, percent), "profiles")
    known = profile.filter("n > 0")
    classes = written(
        known.groupBy("node", "check", "group", "n", "parity", "wide").agg(F.min("doc_id").alias("least_id")), "classes"
    )
    crowded = classes.groupBy("group").agg(F.count(F.lit(1)).alias("members"), F.min("node").alias("head")).filter(
        "members > 1")
    crowd = written(classes.select("group", "node").join(crowded, "group"), "prefix-groups")

    # Prefix lists of groups, of the shingles that two groups at least share.
    heads = known.dropDuplicates(["group"]).select("group", "node", "n", "prefix")
    shared = heads.select(F.explode("prefix").alias("shingle")).groupBy("shingle").agg(
        F.count(F.lit(1)).alias("lists")).filter("lists > 1")
    shared = written(shared.select("shingle"), "shared-shingles")
    lists = written(_postings(heads, shared).join(shared, "shingle", "left_semi"), "prefix-lists")

    verifier = _Verifier(rows, classes, words, percent)

    # First round: the least, the greatest and the most central group of each list.
    entry = F.struct("n", "node", "place")
    pivots = lists.groupBy("shingle").agg(F.array_distinct(F.array(
        F.min(entry), F.max(entry), F.min_by(entry, F.struct("place", "node")))).alias("pivots"))
    starred = lists.join(pivots.select("shingle", F.explode("pivots").alias("pivot")), "shingle").filter(
        _fits(F.col("n"), F.col("pivot.n"), percent)
        & _reach(F.col("n"), F.col("place"), F.col("pivot.n"), F.col("pivot.place"), percent))
    star = starred.select("node", F.col("pivot.node").alias("other")).unionByName(
        crowd.select("node", F.col("head").alias("other")))
    found = verifier.links(_pairs(star, F.col("node"), F.col("other")))

    # Second round: drawn groups of the lists that are still of several components.
    entries = _open(lists, classes, crowd, found)
    entry = F.struct("n", "node", "root", "place")
    drawn = [F.min_by(entry, F.xxhash64("node", F.lit(i))) for i in range(DRAWN)]
    pivots = entries.groupBy("key").agg(F.array_distinct(F.array(*drawn)).alias("pivots"))
    starred = entries.join(pivots.select("key", F.explode("pivots").alias("pivot")), "key").filter(
        (F.col("root") != F.col("pivot.root")) & _fits(F.col("n"), F.col("pivot.n"), percent)
        & _reach(F.col("n"), F.col("place"), F.col("pivot.n"), F.col("pivot.place"), percent))
    more = verifier.links(_pairs(starred, F.col("node"), F.col("pivot.node")))
    first, found = found, written(found.unionByName(more), "found-links")
    discard(entries, first, more)

    # Last: every pair from different components that sizes, places and parities do not rule out.
    entries = _open(lists, classes, crowd, found)
    bits = classes.groupBy("node").agg(F.min("parity").alias("parity"))
    bare, entries = entries, written(entries.join(bits, "node").select(
        "key", "node", "n", "place", "root", *_bits("parity", "x")), "open-lists")
    discard(bare)
    other = entries.select("key", *(
        F.col(name).alias(f"other_{name}") for name in ("node", "n", "place", "root")),
        *(F.col(f"x{i}").alias(f"y{i}") for i in range(PARITY_BITS // 64)))
    size, other_size = F.col("n"), F.col("other_n")
    rest = (
        entries.join(other, "key")
        .filter(F.col("root") < F.col("other_root"))
        .filter(_fits(size, other_size, percent))
        .filter(_reach(size, F.col("place"), other_size, F.col("other_place"), percent))
        .filter(_few_differ("n", "x", "other_n", "y", percent))
    )
    rest = verifier.links(_pairs(rest, F.col("node"), F.col("other_node")))
    rooted = components(found.unionByName(rest))
    discard(entries, found, rest, lists, shared, crowd, classes)
    return profile, rooted


def ngram_components(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles and component_id, the least doc_id reachable by links, of every document."""
    profile, rooted = similarity_classes(docs, words, percent)
    keyed = profile.join(rooted, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("root", "node").alias("root")
    )
    least = keyed.filter("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return keyed.join(least, "root", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def keep_one_of_each(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component, and all rows that link with nothing.

    The row kept has the component's least id, NULL last, and of such rows the least
    digest of its text; of rows equal in both one stays. Rows without words stay all.
    """
    profile, rooted = similarity_classes(docs, words, percent)
    keyed = profile.filter("n > 0").join(rooted, "node", "left").select(
        "doc_id", "mark", F.coalesce("root", "node").alias("root"))
    least = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "mark")
    best = keyed.groupBy("root").agg(F.min(least).alias("best")).select("best.doc_id", "best.mark", F.lit(True).alias("kept"))
    counted = keyed.groupBy("doc_id", "mark").agg(F.count(F.lit(1)).alias("rows")).alias("c")
    same = F.col("c.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("c.mark") == F.col("b.mark"))
    fates = written(counted.join(best.alias("b"), same, "left").select(
        "c.doc_id", "c.mark", "rows", F.coalesce("kept", F.lit(False)).alias("kept")).filter("rows > 1 OR NOT kept"), "fates")

    mark = "_mark"
    while mark in (name.lower() for name in docs.columns):
        mark += "_"
    marked = docs.withColumn(mark, F.md5("text")).alias("d")
    fates = fates.alias("f")
    this = F.col("d.doc_id").cast("bigint").eqNullSafe(F.col("f.doc_id")) & (F.col(f"d.{mark}") == F.col("f.mark"))
    single = marked.join(fates, this, "left_anti")
    repeated = marked.join(fates.filter("kept"), this, "left_semi").dropDuplicates(["doc_id", mark])
    return single.unionByName(repeated).select(*docs.columns)
