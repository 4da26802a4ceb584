"""Toxicity by compression distance: which of two Zstandard dictionaries shortens a window more.

One dictionary is trained on windows of toxic text, one on windows of ordinary
text. A window is a lower-cased word between blanks, closed by a fixed tail that
both dictionaries hold, so that even a short window is long enough to compress.
Its length and its two compressed lengths name a cell; calibration gives every
cell the log odds of its windows in toxic against ordinary text. A document's
highest cell, the sums over its distinct windows and their number go through a
logistic curve, whose 0.5 is the threshold.

Most windows of a toxic document are ordinary prose. Dictionary samples of toxic
text are the windows with a character gram far commoner in toxic documents.

Fitting takes at most ``sample_docs`` labelled documents of either kind, whole: tasks
send their distinct windows to the driver. Scoring covers every window of whole
texts. With labels of one kind only, or none, all documents get the share of
toxic labels, or 0, as their score.

Rows: a NULL or empty text has no windows and gets the score of none; NULL and
repeated ids are scored like any other row; among several labels of an id the
highest counts, a NULL label does not. An empty table gives no rows. Columns
besides the named ones are never read.
"""

from __future__ import annotations

import math
import re
import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plateia.llm.common import only

WORD = re.compile(r"[^\W_]{1,24}")
TAIL = bytes(range(1, 9)) + bytes(range(14, 30))  # control characters: never part of a word
KEPT_WINDOWS = 1 << 18


def windows(text: str | None) -> set[str]:
    """The distinct windows of a text; words over 24 letters give several."""
    return set(WORD.findall(text.lower())) if text else set()


def _bytes(window: str) -> bytes:
    return f" {window} ".encode()


def _grams(window: str) -> set[str]:
    padded = f" {window} "
    return {padded[i : i + n] for n in (4, 5, 6) for i in range(len(padded) - n + 1)}


def _dictionary(counts: Counter[str], size: int) -> bytes:
    samples = [_bytes(w) for w, n in sorted(counts.items()) for _ in range(min(n, 8))]
    np.random.default_rng(7).shuffle(samples)
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: its plain windows, commonest last
        return b"".join(_bytes(w) for w, _ in reversed(counts.most_common()))[-size:]


def _compressor(content: bytes, least_match: int) -> zstandard.ZstdCompressor:
    shared = zstandard.ZstdCompressionDict(content + TAIL, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    settings = zstandard.ZstdCompressionParameters.from_level(
        3, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_dict_id=0,
        write_checksum=0, window_log=17, min_match=least_match, strategy=zstandard.STRATEGY_LAZY2,
    )
    shared.precompute_compress(compression_params=settings)
    return zstandard.ZstdCompressor(dict_data=shared, compression_params=settings)


Cell = tuple[int, int, int]


@dataclass
class Model:
    """Dictionaries, cell weights and the logistic curve; or a constant score."""

    constant: float | None = None
    toxic: bytes = b""
    ordinary: bytes = b""
    weights: dict[Cell, float] = field(default_factory=dict)
    curve: list[float] = field(default_factory=list)

    def scorer(self) -> Scorer:
        return Scorer(self)


class Scorer:
    """Scores texts in one process; windows met before are looked up."""

    def __init__(self, model: Model):
        self.model = model
        self.kept: dict[str, Cell] = {}
        if model.constant is None:
            self.toxic = _compressor(model.toxic, 6)
            self.ordinary = _compressor(model.ordinary, 5)

    def cell(self, window: str) -> Cell:
        found = self.kept.get(window)
        if found is None:
            if len(self.kept) >= KEPT_WINDOWS:
                self.kept.clear()
            raw = _bytes(window)
            tailed = raw + TAIL
            found = self.kept[window] = (
                len(raw), len(self.toxic.compress(tailed)), len(self.ordinary.compress(tailed))
            )
        return found

    def features(self, text: str | None) -> list[float]:
        own = windows(text)
        weights = self.model.weights
        odds = [weights.get(self.cell(w), 0.0) for w in own] or [0.0]
        return [max(odds), sum(x for x in odds if x > 1), sum(odds), math.log1p(len(own))]

    def score(self, text: str | None) -> float:
        if self.model.constant is not None:
            return self.model.constant
        *slopes, bias = self.model.curve
        z = bias + sum(a * x for a, x in zip(slopes, self.features(text)))
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, z))))


def fit_windows(toxic: list[str], ordinary: list[str], toxic_share: float) -> Model:
    """Fit on sample texts: two fifths for the dictionaries, two for the cells, one for the curve."""
    if not toxic or not ordinary:
        return Model(constant=1.0 if toxic else 0.0)

    def part(texts: list[str], of: tuple[int, ...]) -> list[tuple[str, ...]]:
        chosen = [t for i, t in enumerate(texts) if i % 5 in of] or texts
        # One string per distinct window, however many texts hold it.
        return [tuple(map(sys.intern, windows(t))) for t in chosen]

    def grams_of(own: tuple[str, ...]) -> set[str]:
        return set().union(*map(_grams, own))

    bad, good = part(toxic, (0, 1)), part(ordinary, (0, 1))
    in_bad, in_good = Counter(), Counter()
    for own in bad:
        in_bad.update(grams_of(own))
    often = {gram: n for gram, n in in_bad.items() if n >= max(2, 0.01 * len(bad))}
    del in_bad
    for own in good:
        in_good.update(often.keys() & grams_of(own))
    telling = {gram for gram, n in often.items() if n / len(bad) >= 20 * (in_good[gram] + 0.5) / len(good)}
    bad_windows = Counter(w for own in bad for w in own if telling & _grams(w))
    model = Model(
        toxic=_dictionary(bad_windows or Counter(w for own in bad for w in own), 1 << 14),
        ordinary=_dictionary(Counter(w for own in good for w in own), 1 << 16),
    )
    scorer = model.scorer()
    seen = []
    for texts in (part(toxic, (2, 3)), part(ordinary, (2, 3))):
        seen.append(Counter(scorer.cell(w) for own in texts for w in own))
    sums = [sum(c.values()) or 1 for c in seen]
    model.weights = {
        cell: math.log((seen[0][cell] + 0.5) / sums[0] * sums[1] / (seen[1][cell] + 0.5))
        for cell in seen[0].keys() | seen[1].keys()
    }
    curve_bad = [t for i, t in enumerate(toxic) if i % 5 == 4] or toxic
    curve_good = [t for i, t in enumerate(ordinary) if i % 5 == 4] or ordinary
    x = np.array([scorer.features(t) for t in curve_bad + curve_good])
    y = np.array([1.0] * len(curve_bad) + [0.0] * len(curve_good))
    slopes = _logistic(x, y, np.array([toxic_share / len(curve_bad)] * len(curve_bad)
                                      + [(1 - toxic_share) / len(curve_good)] * len(curve_good)))
    model.curve = [*slopes[:-1], slopes[-1] - _threshold(x @ slopes[:-1] + slopes[-1], y)]
    return model


def _threshold(z: np.ndarray, y: np.ndarray, false_alarm: float = 3.0) -> float:
    """The cut with the least loss; a share of ordinary texts above it costs three of toxic ones below."""
    values = np.unique(z)
    cuts = np.concatenate([[values[0] - 1], (values[1:] + values[:-1]) / 2, [values[-1] + 1]])
    bad, good = np.sort(z[y > 0]), np.sort(z[y == 0])
    loss = np.searchsorted(bad, cuts) / len(bad) + false_alarm * (1 - np.searchsorted(good, cuts) / len(good))
    best = cuts[np.isclose(loss, loss.min())]
    return float(best[len(best) // 2])


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> list[float]:
    """Slopes and bias by Newton steps, each sample weighted, slightly shrunk."""
    middle, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([(x - middle) / spread, np.ones(len(x))])
    w = weight / weight.sum() * len(x)
    b = np.zeros(z.shape[1])
    shrink = ridge * len(x) * np.append(np.ones(x.shape[1]), 1e-6)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
        step = np.linalg.solve((z * (w * (p * (1 - p) + 1e-9))[:, None]).T @ z + np.diag(shrink),
                               z.T @ (w * (y - p)) - shrink * b)
        b += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    slopes = b[:-1] / spread
    return [*slopes.tolist(), float(b[-1] - slopes @ middle)]


def is_held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def _distinct_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [" ".join(sorted(windows(text.as_py()))) for text in batch["text"]]
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["toxic"], pa.array(found, pa.string())], ["doc_id", "toxic", "windows"]
        )


def fit_toxicity(docs: DataFrame, labels: DataFrame, sample_docs: int = 4000) -> Model:
    """Fit on a digest-ordered sample of the labelled documents that are not held out."""
    marked = (
        only(labels, doc_id=F.col("doc_id").cast("bigint"), toxic="toxic")
        .filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .filter(~is_held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg((F.max("toxic") > 0).alias("toxic"))
    )
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = [marked.filter(F.col("toxic") == kind).orderBy(*order).limit(sample_docs) for kind in (True, False)]
    # At most 2 * sample_docs rows: small enough to send to every task.
    texts = only(docs, doc_id=F.col("doc_id").cast("bigint"), text="text").join(
        F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id"
    )
    seen = texts.mapInArrow(_distinct_windows, "doc_id BIGINT, toxic BOOLEAN, windows STRING").toArrow()
    sample = sorted(zip(*(seen[name].to_pylist() for name in ("doc_id", "toxic", "windows"))))
    del seen
    counts = {r.toxic: r["n"] for r in marked.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = counts.get(True, 0) / max(1, sum(counts.values()))
    return fit_windows(
        [t for _, toxic, t in sample if toxic], [t for _, toxic, t in sample if not toxic], share
    )


def score_toxicity(docs: DataFrame, model: Model, *kept: str, out: str = "score") -> DataFrame:
    """The score of every document as ``out``, next to the columns ``kept``."""
    text = "text" if "text" in kept else "_text"

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = model.scorer()
        for batch in batches:
            values = [scorer.score(one.as_py()) for one in batch[text]]
            columns = [batch[name] for name in kept] + [pa.array(values, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*kept, out])

    rows = docs.select(*kept) if text == "text" else docs.select(*kept, F.col("text").alias(text))
    fields = [docs.schema[name] for name in kept] + [T.StructField(out, T.DoubleType())]
    return rows.mapInArrow(scores, T.StructType(fields))


def classify_toxicity(docs: DataFrame, labels: DataFrame, sample_docs: int = 4000) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    rows = only(docs, doc_id=F.col("doc_id").cast("bigint"), text="text")
    scored = score_toxicity(rows, fit_toxicity(docs, labels, sample_docs), "doc_id")
    return scored.select(
        "doc_id",
        F.coalesce(is_held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
