"""Repeated runs of lines, found by winnowing over line hashes.

A window is the shortest run of lines from a given line, or up to a given line,
that weighs ``least_words`` words; a line weighs its words, or a sixteenth of its
characters if that is more. Within a window, the runs from each of its lines that weigh
``gram_words`` have a hash; the least of them is the window's fingerprint. A run
of lines that weighs ``least_words`` and occurs twice holds the same windows in
both places, with the same fingerprints: those from its lines and the one up to
its end cover every line of it, so no such run is missed.

Only windows whose fingerprint occurs at two places go on. Windows of equal
content are joined to their first position in the order of doc_id and line;
every later one is a match, and matches of neighbouring windows extend each other
both ways to whole runs. Runs are deleted, first occurrences stay. A line goes if
and only if a run of ``least_words`` around it occurs earlier, also earlier in
the same document.

No step forms pairs: a passage in a third of all documents is one minimum,
combined before the shuffle, and one join whose large side can be split.

Rows: NULL texts stay NULL, texts lighter than a window and empty ones stay as
they are. Lines are compared without blanks at their ends. NULL ids come first,
equal ids are ordered by a hash of the text; repeated rows are one document and
share its result. An empty table gives no rows. Extra columns are kept; the
columns the operator adds replace columns of their names.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plateia.llm.common import written

BASE_1, BASE_2 = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
WORD = (1 << 64) - 1
WINDOWS = "_ld_doc BIGINT, _ld_text BIGINT, first INT, last INT, gram INT, fingerprint BIGINT, content BIGINT"


def weigh(line: str) -> int:
    return max(len(line.split()), len(line) // 16)


def _prefix_hashes(hashes: list[int], base: int) -> tuple[list[int], list[int]]:
    sums, powers = [0], [1]
    for h in hashes:
        sums.append((sums[-1] * base + h) & WORD)
        powers.append(powers[-1] * base & WORD)
    return sums, powers


def _run_hash(sums: list[int], powers: list[int], first: int, last: int) -> int:
    value = (sums[last + 1] - sums[first] * powers[last + 1 - first]) & WORD
    value = (value ^ (value >> 31)) * 0xBF58476D1CE4E5B9 & WORD
    return (value ^ (value >> 29)) - (1 << 63)


def windows(text: str, least_words: int, gram_words: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(first line, last line, line of the gram, fingerprint, content hash) of every window."""
    lines = [line.strip() for line in text.split("\n")]
    total = np.concatenate([[0], np.cumsum([weigh(line) for line in lines])])
    if total[-1] < least_words:
        return
    hashes = [xxhash.xxh64_intdigest(line) for line in lines]
    grams = _prefix_hashes(hashes, BASE_1)
    contents = _prefix_hashes(hashes, BASE_2)
    starts = total[:-1]
    ends = np.searchsorted(total, starts + least_words).tolist() + [len(lines) + 1]
    gram_ends = np.searchsorted(total, starts + gram_words).tolist()
    known: dict[int, int] = {}
    least: deque[int] = deque()  # lines whose grams can still be the least, in order
    line = 0
    for first, shortest in enumerate(ends[:-1]):
        if shortest > len(lines):
            break
        # The shortest window from this line, and those from it that are the shortest to their ends.
        for end in range(shortest, max(shortest + 1, min(ends[first + 1], len(lines) + 1))):
            while line < end and gram_ends[line] <= end:
                known[line] = _run_hash(*grams, line, gram_ends[line] - 1)
                while least and known[line] <= known[least[-1]]:
                    least.pop()
                least.append(line)
                line += 1
            while least[0] < first:
                least.popleft()
            yield first, end - 1, least[0], known[least[0]], _run_hash(*contents, first, end - 1)


def _key() -> list[Column]:
    return [
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63))).alias("_ld_doc"),
        F.xxhash64("text").alias("_ld_text"),
    ]


def repeated_runs(docs: DataFrame, least_words: int = 30, gram_words: int = 15) -> DataFrame:
    """``_ld_runs`` (first and last line) to delete of every document that has some."""

    def selected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, key, text in zip(batch["_ld_doc"].to_pylist(), batch["_ld_text"].to_pylist(), batch["text"]):
                rows += [(doc, key, *w) for w in windows(text.as_py() or "", least_words, gram_words)]
            for at in range(0, len(rows), 20_000):
                columns = zip(*rows[at : at + 20_000])
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    names = ["_ld_doc", "_ld_text", "first", "last", "gram", "fingerprint", "content"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
    found = written(docs.select(*_key(), "text").mapInArrow(selected, WINDOWS), "line-windows")
    gram_place = F.struct("_ld_doc", "_ld_text", "gram")
    repeated = (
        found.groupBy("fingerprint")
        .agg(F.min(gram_place).alias("low"), F.max(gram_place).alias("high"))
        .filter("low <> high")
    )
    candidates = found.join(repeated, "fingerprint", "left_semi")
    place = F.struct("_ld_doc", "_ld_text", "first")
    firsts = (
        candidates.groupBy("fingerprint", "content")
        .agg(F.min(place).alias("low"), F.max(place).alias("high"))
        .filter("low <> high")
        .select("fingerprint", "content", "low")
    )
    matches = candidates.join(firsts, ["fingerprint", "content"]).filter(place > F.col("low"))
    return (
        matches.groupBy("_ld_doc", "_ld_text")
        .agg(F.array_sort(F.collect_set(F.struct("first", "last"))).alias("matches"))
        .select("_ld_doc", "_ld_text", _extended(F.col("matches")).alias("_ld_runs"))
    )


def _extended(matches: Column) -> Column:
    """Overlapping matches as whole runs; matches are sorted and of one document."""

    def extend(runs: Column, match: Column) -> Column:
        last = F.try_element_at(runs, F.lit(-1))
        grown = F.struct(last["first"].alias("first"), F.greatest(last["last"], match["last"]).alias("last"))
        return F.when(
            (F.size(runs) > 0) & (last["last"] + 1 >= match["first"]),
            F.concat(F.slice(runs, 1, F.greatest(F.size(runs) - 1, F.lit(0))), F.array(grown)),
        ).otherwise(F.concat(runs, F.array(match)))

    none = F.array().cast("array<struct<first:int,last:int>>")
    return F.aggregate(matches, none, extend)


def dedup_lines(docs: DataFrame, least_words: int = 30, gram_words: int = 15) -> DataFrame:
    """All documents, with the repeated runs taken out of ``text``.

    Adds ``n_lines`` of the text as it was, ``removed_lines`` and ``removed``,
    the runs of lines that went, numbered from 0.
    """
    added = ("n_lines", "removed_lines", "removed")
    columns = [name for name in docs.columns if name not in added]
    runs = repeated_runs(docs, least_words, gram_words)
    keyed = docs.select(*columns, *_key())
    lines = F.split("text", "\n")
    kept = F.filter(
        lines, lambda _, i: ~F.exists("_ld_runs", lambda r: (r["first"] <= i) & (i <= r["last"]))
    )
    removed = F.aggregate(
        "_ld_runs", F.lit(0), lambda total, r: total + r["last"] - r["first"] + 1
    )
    return keyed.join(runs, ["_ld_doc", "_ld_text"], "left").select(
        *(
            F.when(F.col("_ld_runs").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text")
            if name == "text" else F.col(name)
            for name in columns
        ),
        F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).alias("n_lines"),
        F.coalesce(removed, F.lit(0)).alias("removed_lines"),
        F.coalesce("_ld_runs", F.array().cast("array<struct<first:int,last:int>>")).alias("removed"),
    )
