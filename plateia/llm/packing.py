"""Bulk-synchronous best-fit packing of documents into sequences of bounded length.

Pieces and gaps are held range-sorted by their size, in run-length form: pieces
of one length are interchangeable and so are sequences with one gap, so there
are at most ``capacity`` runs of either, whatever the corpus. Each round

1. opens sequences for pieces longer than every gap, as many as their tokens need,
2. sweeps both sorted lists, longest pieces first, and matches each run with its
   successor among the gaps: the smallest gap that holds it,
3. resolves conflicts by rank: the first pieces of a run get the first sequences
   of the gap's run, the rest go on to the next gap or the next round,
4. moves the used sequences to the runs of their smaller gaps, and repeats.

The sweep's state is bounded by the capacity, so it needs no cluster. The pieces
themselves never leave Spark: each gets its rank within its length from counts
per task, and finds its sequence in the rounds' list of rank ranges.

Rows: documents with a NULL text hold the end id alone; NULL and repeated ids
are packed like any other row; an empty table gives no rows. Columns besides the
named two are ignored.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plateia.llm.common import only, written
from plateia.llm.tokens import encoder

Placement = tuple[int, int, int, int, int]  # length, first rank, pieces, first sequence, offset

_BATCH = 1024  # pieces in one Arrow batch


def cut_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, keep_ids: bool) -> DataFrame:
    """Token pieces of each document, with their place among pieces of their length in the task."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end, task = encoder(tokenizer), struct.pack("<I", end_id), TaskContext.get().partitionId()
        seen: Counter[int] = Counter()
        rows = []

        def batch_of(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)], names)

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                ids = encode.encode(text.as_py() or "") + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at : at + 4 * capacity]
                    length = len(own) // 4
                    rows.append((task, doc_id, piece, at // 4, length, zlib.crc32(own), seen[length],
                                 own if keep_ids else None))
                    seen[length] += 1
                    if len(rows) == _BATCH:
                        yield batch_of(rows)
                        rows = []
        if rows:
            yield batch_of(rows)
        # The worker lives on, for other stages.
        encode.forget()

    names = ["task", "doc_id", "piece", "start", "length", "ids_crc32", "place", "ids"]
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    rows = only(docs, doc_id=F.col("doc_id").cast("bigint"), text="text")
    return rows.mapInArrow(
        pieces,
        "task INT, doc_id BIGINT, piece INT, start BIGINT, length BIGINT, ids_crc32 BIGINT, "
        "place BIGINT, ids BINARY",
    )


def plan_sequences(counts: dict[int, int], capacity: int) -> tuple[list[Placement], int]:
    """Rank ranges of every length with their sequences and offsets, and the sequences opened."""
    left = {length: n for length, n in counts.items() if n}
    rank = dict.fromkeys(left, 0)
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap: runs of (first sequence, sequences)
    plan: list[Placement] = []
    opened = 0

    def place(length: int, first: int, n: int, gap: int, into: dict[int, list[tuple[int, int]]]) -> None:
        plan.append((length, rank[length], n, first, capacity - gap))
        rank[length] += n
        left[length] -= n
        if not left[length]:
            del left[length]
        if gap > length:
            into.setdefault(gap - length, []).append((first, n))

    while left:
        widest = max(gaps, default=0)
        stuck = sorted((length for length in left if length > widest), reverse=True)
        if stuck:
            tokens = sum(length * left[length] for length in stuck)
            alone = sum(left[length] for length in stuck if 2 * length > capacity)
            wanted = max(-(-tokens // capacity), alone)
            for length in stuck:
                n = min(wanted, left[length])
                if n:
                    place(length, opened, n, capacity, gaps)
                    opened, wanted = opened + n, wanted - n
        after: dict[int, list[tuple[int, int]]] = {}
        open_gaps = sorted(gaps)
        for length in sorted(left, reverse=True):
            at = bisect_left(open_gaps, length)
            while at < len(open_gaps) and length in left:
                gap = open_gaps[at]
                first, n = gaps[gap].pop()
                used = min(n, left[length])
                if used < n:
                    gaps[gap].append((first + used, n - used))
                place(length, first, used, gap, after)
                if not gaps[gap]:
                    del gaps[gap], open_gaps[at]
        for gap, runs in after.items():
            gaps.setdefault(gap, []).extend(runs)
    return plan, opened


def pack_documents(
    docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = 2048, keep_ids: bool = False
) -> DataFrame:
    """Place every piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Documents longer than ``capacity`` tokens are cut, no others. ``keep_ids``
    adds the ids of each piece as unsigned little-endian 32-bit integers.
    """
    spark = docs.sparkSession
    pieces = written(cut_pieces(docs, tokenizer, end_id, capacity, keep_ids), "pieces")
    tasks = pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["length"]: r["n"] for r in tasks.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan, _ = plan_sequences(counts, capacity)
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = tasks.select(
        "task", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).cast("bigint").alias("before")
    )
    places = spark.createDataFrame(
        plan, "_length BIGINT, _rank BIGINT, _pieces BIGINT, _sequence BIGINT, offset BIGINT"
    )
    rank = F.col("before") + F.col("place")
    here = (F.col("length") == F.col("_length")) & (rank >= F.col("_rank")) & (
        rank < F.col("_rank") + F.col("_pieces")
    )
    # As many rows as the rounds matched runs: bounded by the capacity, not by the corpus.
    placed = pieces.join(offsets, ["task", "length"]).join(F.broadcast(places), here)
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("_sequence") + rank - F.col("_rank")).alias("sequence_id"),
        "offset", *(["ids"] if keep_ids else []),
    )
