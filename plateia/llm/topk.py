"""Exact top-k inner products over norm-sorted blocks with rotated partial sums.

Vectors are scaled to integers. Candidates are range-sorted by descending length
and cut into blocks. The queries first meet the block of the longest vectors,
which gives each a threshold. By Cauchy-Schwarz a block whose longest vector
times the query's length stays below the threshold holds no result; the blocks
are sorted, so each group of queries needs a leading run of them only. Within a
pair of blocks, the first components of an SVD rotation give partial sums; adding
the product of the residual lengths bounds every score, and only pairs whose
bound reaches the threshold are scored, in exact integers.

The rotation is fitted to a bounded sample (``fit_rows``); it is orthogonal, so
it changes how much is pruned and never a result.

Rows: vectors that are NULL or hold NULL or non-finite components take no part,
nor do rows with a NULL id or with a scaled component of 2^62 or more in size, which
has hardly a product that is a long. A product beyond a long becomes the largest or
least one.
Vectors of different lengths are compared as if padded with zeros; an empty
vector scores 0. Repeated ids are rows of their own; rows that share a query's id
are not its candidates. Ties go to the smaller id. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plateia.llm.common import only, written
from plateia.session import bound_batches

# Larger components leave nearly no product that is a long.
LIMIT = 1 << 62
LONGEST = (1 << 63) - 1
ROWS = "part INT, place BIGINT, vec_id BIGINT, norm DOUBLE, vector BINARY"


def _vectors(column: pa.Array, scale: float) -> Iterator[np.ndarray | None]:
    """The scaled vectors of a batch; None where a vector takes no part."""
    kinds = column.type.value_type
    for start in range(0, len(column), 4096):
        rows = column.slice(start, 4096)
        lengths = np.asarray(rows.value_lengths().fill_null(-1))
        values = rows.flatten()
        if len(lengths) and lengths.min() == lengths.max() > 0 and not values.null_count and pa.types.is_floating(kinds):
            blocks = values.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), -1)
        else:
            blocks = [None if v is None or None in v else np.array(v, np.float64) for v in rows.to_pylist()]
        for vector in blocks:
            if vector is None or not np.isfinite(vector).all():
                yield None
                continue
            scaled = np.floor(scale * vector)
            yield None if (np.abs(scaled) >= LIMIT).any() else scaled.astype(np.int64)


def scaled_vectors(vectors: DataFrame, scale: float) -> DataFrame:
    """vec_id, norm and the integers of every vector that takes part."""

    def scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (vec_id, float(np.linalg.norm(v.astype(np.float64))), v.astype("<i8").tobytes())
                for vec_id, v in zip(batch["vec_id"].to_pylist(), _vectors(batch["embedding"], scale))
                if v is not None and vec_id is not None
            ]
            if rows:
                ids, norms, data = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(norms, pa.float64()), pa.array(data, pa.binary())],
                    ["vec_id", "norm", "vector"],
                )

    rows = only(vectors, vec_id=F.col("vec_id").cast("bigint"), embedding="embedding")
    return rows.mapInArrow(scaled, "vec_id BIGINT, norm DOUBLE, vector BINARY")


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, place = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, part, np.int32)), pa.array(np.arange(place, place + n))] + batch.columns,
            ["part", "place", "vec_id", "norm", "vector"],
        )
        place += n


def _matrix(data: list[bytes], width: int) -> np.ndarray:
    out = np.zeros((len(data), width), np.int64)
    for row, vector in enumerate(data):
        ints = np.frombuffer(vector, "<i8")
        out[row, : len(ints)] = ints
    return out


def _blocks(rows: DataFrame, key: str, width: int) -> DataFrame:
    """One row per block: its vectors as one matrix, longest first."""

    def block(group: pa.Table) -> pa.Table:
        group = group.sort_by([("norm", "descending"), ("part", "ascending"), ("place", "ascending")])
        matrix = _matrix(group["vector"].to_pylist(), width)
        row = (
            group[key][0].as_py(),
            group["norm"][0].as_py(),
            np.asarray(group["vec_id"]).astype("<i8").tobytes(),
            (np.asarray(group["part"]).astype("<i8") << 40 | np.asarray(group["place"])).tobytes(),
            matrix.astype("<i8").tobytes(),
        )
        return pa.table([pa.array([v]) for v in row], ["block", "top", "ids", "rows", "matrix"])

    return rows.groupBy(key).applyInArrow(
        block, "block BIGINT, top DOUBLE, ids BINARY, rows BINARY, matrix BINARY"
    )


def _blocks_per_shelf(n_blocks: int) -> int:
    """How many blocks meet one copy of the queries.

    64 shelves, so that the copies grow as the queries do, until a shelf has the 64 blocks
    that a join task may hold; more of them only where 1024 shelves, whose longest vectors
    the driver takes, are not enough.
    """
    return max(1, min(64, -(-n_blocks // 64)), -(-n_blocks // 1024))


def _fit_rotation(rows: DataFrame, total: int, width: int, fit_rows: int) -> np.ndarray:
    """The SVD rotation of about ``fit_rows`` vectors, drawn by a digest; at most twice as many."""
    drawn = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(total)) < fit_rows
    sample = rows.filter(drawn).select("vector").limit(2 * fit_rows).collect()
    matrix = _matrix([r.vector for r in sample], width).astype(np.float64)
    return np.linalg.svd(matrix.T @ matrix)[0] if width else np.zeros((0, 0))


def _exact(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Integer products of all rows; through doubles where those are exact.

    Pairs long enough for a product beyond 64 bits are multiplied as Python's integers,
    and a product beyond a long becomes the largest or least one.
    """
    largest = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(1, q.shape[1])
    if largest < 2.0**53:
        return (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    scores = q @ c.T
    lengths = [np.linalg.norm(rows.astype(np.float64), axis=1) for rows in (q, c)]
    for i, j in np.argwhere(np.outer(*lengths) >= 2.0**62):
        exact = sum(a * b for a, b in zip(q[i].tolist(), c[j].tolist()))
        scores[i, j] = max(-LONGEST, min(LONGEST, exact))
    return scores


def best_in_block(
    q: np.ndarray, q_ids: np.ndarray, c: np.ndarray, c_ids: np.ndarray,
    threshold: np.ndarray, rotation: np.ndarray, k: int, steps: int = 4,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The k best of a block for each query, of scores that reach the threshold.

    Returns query rows, candidate ids, scores, and how many pairs were scored.
    The block is sorted by length, and thresholds rise from slice to slice.
    """
    head = max(1, q.shape[1] // steps) if q.shape[1] else 0
    qr = q.astype(np.float64) @ rotation
    qr, q_rest, q_norm = qr[:, :head], np.linalg.norm(qr[:, head:], axis=1), np.linalg.norm(qr, axis=1)
    # At the least long there is no threshold: products below it end there too.
    limit = np.where(threshold <= -LONGEST, -np.inf, threshold.astype(np.float64))
    kept_score = [np.empty(0, np.int64)] * len(q)
    kept_id = [np.empty(0, np.int64)] * len(q)
    scored = 0
    for at in range(0, len(c), 512):
        part, ids = c[at : at + 512], c_ids[at : at + 512]
        cr = part.astype(np.float64) @ rotation
        c_rest = np.linalg.norm(cr[:, head:], axis=1)
        longest = np.linalg.norm(cr[0])
        slack = 1e-6 * (1 + q_norm * longest)
        live = np.flatnonzero(q_norm * longest + slack >= limit)
        if not len(live):
            break
        bound = qr[live] @ cr[:, :head].T + np.outer(q_rest[live], c_rest) + slack[live, None]
        reach = (bound >= limit[live, None]) & (q_ids[live, None] != ids[None])
        scored += int(reach.sum())
        some = np.flatnonzero(reach.any(axis=1))
        if not len(some):
            continue
        columns = np.flatnonzero(reach[some].any(axis=0))
        scores = _exact(q[live[some]], part[columns])
        for row, place in enumerate(some):
            mine = reach[place, columns]
            query = live[place]
            score = np.append(kept_score[query], scores[row, mine])
            name = np.append(kept_id[query], ids[columns[mine]])
            best = np.lexsort((name, -score))[:k]
            kept_score[query], kept_id[query] = score[best], name[best]
            if len(best) == k and kept_score[query][-1] > -LONGEST:
                limit[query] = max(limit[query], float(kept_score[query][-1]))
    sizes = [len(s) for s in kept_score]
    return np.repeat(np.arange(len(q)), sizes), np.concatenate(kept_id), np.concatenate(kept_score), scored


def top_inner_products(
    vectors: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0,
    block_rows: int = 2048, query_rows: int = 512, fit_rows: int = 8192,
) -> DataFrame:
    """The k highest integer products of each query: query_id, rank, vec_id, score.

    ``is_query`` picks the query rows by ``vec_id``; candidates are all other rows.
    """
    # A pair of blocks is a row of over 1 MB.
    spark = bound_batches(vectors.sparkSession)
    spread = scaled_vectors(vectors, scale).repartitionByRange(F.desc("norm"), "vec_id", F.xxhash64("vector"))
    rows = written(
        spread.sortWithinPartitions(F.desc("norm"), "vec_id", F.xxhash64("vector")).mapInArrow(_numbered, ROWS),
        "sorted-vectors",
    )
    parts = rows.groupBy("part").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.length("vector")).alias("bytes"),
        F.count_if(is_query).alias("queries"),
    )
    known = parts.agg(F.sum("n"), F.max("bytes"), F.sum("queries")).first()
    total, width, queries = known[0] or 0, (known[1] or 0) // 8, known[2] or 0
    result = "query_id BIGINT, row BIGINT, vec_id BIGINT, score BIGINT"
    if not total or not queries:
        return spark.createDataFrame([], "query_id BIGINT, rank INT, vec_id BIGINT, score BIGINT")
    rotation = _fit_rotation(rows, total, width, fit_rows)

    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    # One row per part: without the hint an estimate could shuffle the vectors for it.
    ranked = rows.join(F.broadcast(before), "part").withColumn(
        "block", F.floor((F.col("before") + F.col("place")) / block_rows)
    )
    blocks = written(_blocks(ranked, "block", width), "vector-blocks")
    groups = -(-queries // query_rows)
    asked = rows.filter(is_query).withColumn("block", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(groups)))
    query_blocks = _blocks(asked, "block", width)

    n_blocks = -(-total // block_rows)
    per_shelf = _blocks_per_shelf(n_blocks)
    shelved = blocks.withColumn("shelf", F.floor(F.col("block") / per_shelf))
    tops = [r.top for r in shelved.groupBy("shelf").agg(F.max("top").alias("top")).orderBy("shelf").collect()]
    longest = blocks.filter("block = 0").first()
    first_c = np.frombuffer(longest["matrix"], "<i8").reshape(-1, width)
    first_ids = np.frombuffer(longest["ids"], "<i8")

    def thresholds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = -np.array(tops)
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], "<i8")
                q = np.frombuffer(row["matrix"], "<i8").reshape(len(ids), width)
                floor = np.full(len(ids), np.iinfo(np.int64).min)
                which, _, score, _ = best_in_block(q, ids, first_c, first_ids, floor, rotation, k)
                for query in range(len(ids)):
                    mine = score[which == query]
                    if len(mine) == k:
                        floor[query] = mine.min()
                norms = np.sqrt((q.astype(np.float64) ** 2).sum(axis=1))
                with np.errstate(divide="ignore", invalid="ignore"):
                    needed = np.where(norms > 0, floor / norms, np.where(floor > 0, np.inf, -np.inf))
                last = int(np.searchsorted(edges, -needed.min() * (1 - 1e-9) + 1e-6, side="right")) - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["block"]]), pa.array([row["ids"]]), pa.array([row["rows"]]),
                     pa.array([row["matrix"]]), pa.array([floor.astype("<i8").tobytes()]),
                     pa.array([max(last, 0)])],
                    ["query_block", "query_ids", "query_rows", "query_matrix", "floor", "last"],
                )

    pruned = query_blocks.mapInArrow(
        thresholds,
        "query_block BIGINT, query_ids BINARY, query_rows BINARY, query_matrix BINARY, floor BINARY, last BIGINT",
    )
    # The planner knows the size of the queries before they are copied to their shelves, not
    # after: without the hint it collects the copies to broadcast them.
    pairs = pruned.withColumn("shelf", F.explode(F.sequence(F.lit(0).cast("bigint"), "last"))).join(
        shelved.select("shelf", "block", "ids", "matrix").hint("merge"), "shelf"
    )

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch[name][i].as_py() for name in batch.schema.names}
                q_ids, q_rows = np.frombuffer(row["query_ids"], "<i8"), np.frombuffer(row["query_rows"], "<i8")
                ids = np.frombuffer(row["ids"], "<i8")
                which, name, score, _ = best_in_block(
                    np.frombuffer(row["query_matrix"], "<i8").reshape(len(q_ids), width), q_ids,
                    np.frombuffer(row["matrix"], "<i8").reshape(len(ids), width), ids,
                    np.frombuffer(row["floor"], "<i8"), rotation, k,
                )
                if len(which):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(q_ids[which]), pa.array(q_rows[which]), pa.array(name), pa.array(score)],
                        ["query_id", "row", "vec_id", "score"],
                    )

    found = pairs.drop("shelf", "query_block", "block", "last").mapInArrow(best, result)
    order = Window.partitionBy("query_id", "row").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


