"""Periodic runs of words: maximal repetitions, found through suffix trees.

A run is a stretch of words with smallest period q and length >= max(least, 2 * q)
that no neighbouring word extends. By the runs theorem each run holds its Lyndon
root: for one of the two orders of the words, the longest Lyndon word that starts
at some place has length q, and the run is that word extended both ways. So

1. Ukkonen's algorithm builds the suffix tree of the document and that of its
   reversal, in time linear in their words;
2. a walk of each tree in the order of words, and again in reverse order, lists the
   leaves; the next smaller suffix of each place ends its longest Lyndon word;
3. the longest common extension of two places, forward in the one tree and backward
   in the other, is the least depth between two leaves of the Euler tour, answered in
   constant time from block minima;
4. candidates whose extensions reach the length are runs; equal ones are listed once.

Every word of a run stands in it twice, since it holds two periods. A word that occurs
once in its document is therefore in no run, nor is one whose stretch between such
words is shorter than ``least``: these are left out before the trees are built, and
what is left of a document is joined by separators, each a letter of its own. This
loses no run (a separator can be in none) and leaves few words of ordinary prose.

Arrow batches, without shuffles: a document is a row, and its trees take memory in
proportion to its words. NULL and empty texts have no words and no runs. Every row
gives one row, repeated and NULL ids too. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from itertools import groupby
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_BLOCK = 16


class SuffixTree:
    """Ukkonen's suffix tree of a sequence of integers whose last stands nowhere else.

    Nodes are numbers, the root is 0. ``parent``, ``first`` (the first letter of the
    edge to a node), ``depth`` (of inner nodes) and ``suffix`` (of leaves, else -1).
    """

    def __init__(self, letters: list[int]):
        size = max(letters) + 1
        begin, stop, link, parent, depth, suffix = [0], [0], [0], [0], [0], [-1]
        child: dict[int, int] = {}
        endless = len(letters)
        node = edge = length = pending = 0
        for i, letter in enumerate(letters):
            unlinked = 0
            pending += 1
            while pending:
                if not length:
                    edge = i
                key = node * size + letters[edge]
                below = child.get(key)
                if below is None:
                    child[key] = len(begin)
                    begin.append(i)
                    stop.append(endless)
                    link.append(0)
                    parent.append(node)
                    depth.append(0)
                    suffix.append(i - pending + 1)
                    if unlinked:
                        link[unlinked] = node
                        unlinked = 0
                else:
                    start = begin[below]
                    span = stop[below] - start
                    if length >= span:
                        edge += span
                        length -= span
                        node = below
                        continue
                    if letters[start + length] == letter:
                        length += 1
                        if unlinked:
                            link[unlinked] = node
                        break
                    split = len(begin)
                    begin += (start, i)
                    stop += (start + length, endless)
                    link += (0, 0)
                    parent += (node, split)
                    depth += (pending - 1, 0)
                    suffix += (-1, i - pending + 1)
                    child[key] = split
                    child[split * size + letter] = split + 1
                    child[split * size + letters[start + length]] = below
                    begin[below] = start + length
                    parent[below] = split
                    if unlinked:
                        link[unlinked] = split
                    unlinked = split
                pending -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - pending + 1
        text = np.asarray(letters)
        self.parent = np.asarray(parent)
        self.first = text[np.asarray(begin)]
        self.depth = np.asarray(depth)
        self.suffix = np.asarray(suffix)

    def walk(self, falling: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes in the order of the letters, and the depth where each parts from the one before.

        A falling order turns the letters round, all but 0, which ends the text and comes first.
        """
        letter, above = self.first[1:], self.parent[1:]
        # Children of a node in a row, the last first: the stack hands out the first.
        turned = np.where(letter == 0, letter.max() + 1, letter) if falling else -letter
        nodes = np.lexsort((turned, above)) + 1
        bounds = np.searchsorted(self.parent[nodes], np.arange(len(self.parent) + 1)).tolist()
        children, suffix = nodes.tolist(), self.suffix.tolist()
        depth, parent = self.depth.tolist(), self.parent.tolist()
        leaves, parted = [], []
        stack = [0]
        met = 0
        while stack:
            node = stack.pop()
            if suffix[node] >= 0:
                leaves.append(suffix[node])
                parted.append(met)
                # The next leaf hangs from the parent of what is on top of the stack.
                met = depth[parent[stack[-1]]] if stack else 0
            else:
                stack += children[bounds[node] : bounds[node + 1]]
        return np.asarray(leaves), np.asarray(parted)


class Extensions:
    """Longest common extensions of pairs of places, each in constant time."""

    def __init__(self, tree: SuffixTree):
        self.order, parted = tree.walk()
        self.rank = np.empty_like(self.order)
        self.rank[self.order] = np.arange(len(self.order))
        whole = -(-len(parted) // _BLOCK) * _BLOCK
        cells = np.full(whole, np.iinfo(np.int64).max)
        cells[: len(parted)] = parted
        rows = cells.reshape(-1, _BLOCK)
        self.cells = cells
        self.up_to = np.minimum.accumulate(rows, axis=1).ravel()
        self.down_to = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        self.levels = [rows.min(axis=1)]
        step = 1
        while 2 * step <= len(rows):
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-step], last[step:]))
            step *= 2

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """How many letters agree from ``left`` and from ``right`` on; the places differ."""
        a, b = self.rank[left], self.rank[right]
        low, high = np.minimum(a, b) + 1, np.maximum(a, b)
        first, last = low // _BLOCK, high // _BLOCK
        least = np.minimum(self.down_to[low], self.up_to[high])
        near = np.flatnonzero(first == last)
        if len(near):
            found = self.cells[low[near]]
            for ahead in range(1, _BLOCK):
                found = np.minimum(found, self.cells[np.minimum(low[near] + ahead, high[near])])
            least[near] = found
        far = np.flatnonzero(last - first > 1)
        if len(far):
            begin, count = first[far] + 1, last[far] - first[far] - 1
            level = np.frexp(count.astype(float))[1] - 1
            for this in np.unique(level):
                at = level == this
                row, end = self.levels[this], begin[at] + count[at] - (1 << int(this))
                least[far[at]] = np.minimum(least[far[at]], np.minimum(row[begin[at]], row[end]))
        return least


def _next_smaller(rank: list[int]) -> list[int]:
    """For every place the next with a lower rank, or the end."""
    after, stack = [len(rank)] * len(rank), []
    for place, value in enumerate(rank):
        while stack and rank[stack[-1]] > value:
            after[stack.pop()] = place
        stack.append(place)
    return after


def runs_of(letters: list[int], least: int, walls: list[bool] | None = None) -> list[tuple[int, int, int]]:
    """Every run of a sequence of positive integers as (start, length, period), in that order.

    ``walls`` marks letters that stand once.
    """
    n = len(letters)
    if n < least:
        return []
    # 0 ends the sequence and is below every letter; reversing the order must keep it lowest.
    tree = SuffixTree([*letters, 0])
    ahead = Extensions(tree)
    back = Extensions(SuffixTree([*letters[::-1], 0]))
    place = np.arange(n)
    wall = np.zeros(n, bool) if walls is None else np.asarray(walls)
    # The first wall at or after each place.
    until = np.minimum.accumulate(np.where(wall, place, n)[::-1])[::-1]
    text = np.asarray(letters)
    found: set[tuple[int, int, int]] = set()
    for order in (ahead.order, tree.walk(falling=True)[0]):
        rank = np.empty(n + 1, np.int64)
        rank[order] = np.arange(n + 1)
        period = np.asarray(_next_smaller(rank[:n].tolist())) - place
        # Some root of a run starts in its first period: the letter after it is in the run.
        start = np.flatnonzero(place + period < until)
        start = start[text[start] == text[start + period[start]]]
        period = period[start]
        more = ahead.of(start, start + period)
        # Backward, place x of the text is n - 1 - x; nothing stands before the first.
        less = np.zeros_like(more)
        inner = np.flatnonzero(start > 0)
        less[inner] = back.of(n - start[inner], n - start[inner] - period[inner])
        length = less + period + more
        good = length >= np.maximum(least, 2 * period)
        found.update(zip((start - less)[good].tolist(), length[good].tolist(), period[good].tolist()))
    return sorted(found, key=lambda run: (run[0], run[2]))


def stretches(words: list[bytes], least: int) -> list[tuple[int, int]]:
    """Stretches (start, end) of at least ``least`` words that all occur again in the document."""
    often = Counter(words)
    found, place = [], 0
    for again, group in groupby(often[word] > 1 for word in words):
        end = place + sum(1 for _ in group)
        if again and end - place >= least:
            found.append((place, end))
        place = end
    return found


def document_runs(words: list[bytes], least: int) -> list[tuple[int, int, int]]:
    """Runs of a whole document by start, then period."""
    kept = stretches(words, least)
    if not kept:
        return []
    number: dict[bytes, int] = {}
    letters, walls, home = [], [], []
    for start, end in kept:
        letters += [number.setdefault(word, len(number) + 1) for word in words[start:end]]
        letters.append(0)
        home += range(start, end + 1)
    separator = len(number)
    for place, letter in enumerate(letters):
        walls.append(letter == 0)
        if letter == 0:
            separator += 1
            letters[place] = separator
    return [(home[start], length, period) for start, length, period in runs_of(letters, least, walls)]


def plant_period(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The edited text of documents whose hash ends in 0: from some word on, its first p words repeat."""
    if doc_id is None or not words:
        return words
    h = crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def _digest(text: bytes) -> str:
    return hashlib.sha256(text).hexdigest()


def _report(words: list[bytes], least: int) -> tuple:
    runs = document_runs(words, least)
    listing = b"".join(b"%d,%d,%d\n" % run for run in runs)
    if not runs:
        return 0, None, None, None, None, _digest(listing), _digest(b" ".join(words)), ()
    dropped = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        dropped[start + period] += 1
        dropped[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(dropped[:-1]) == 0).tolist()
    start, length, period = min(runs, key=lambda run: (-run[1], run[0], run[2]))
    collapsed = _digest(b" ".join([words[place] for place in kept]))
    named = [dict(zip(("start", "length", "period"), run)) for run in runs]
    return len(runs), start, length, period, 1000 * length // period, _digest(listing), collapsed, named


_COLUMNS = (
    "doc_id BIGINT, n_runs BIGINT, start BIGINT, length BIGINT, period BIGINT, exponent_milli BIGINT, "
    "runs_sha256 STRING, collapsed_sha256 STRING, runs ARRAY<STRUCT<start: BIGINT, length: BIGINT, period: BIGINT>>"
)
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_REPORT = pa.schema([
    ("doc_id", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
    ("period", pa.int64()), ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()),
    ("collapsed_sha256", pa.string()), ("runs", pa.list_(_RUN)),
])


def periodic_runs(docs: DataFrame, least: int = 12, planted: bool = False) -> DataFrame:
    """The runs of every document, the longest, and digests of all and of the text without repeats.

    With ``planted``, some documents are first made periodic by ``plant_period``.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = (text.as_py() or "").encode().split()
                rows.append((doc_id, *_report(plant_period(words, doc_id) if planted else words, least)))
            columns = list(zip(*rows)) or [()] * len(_REPORT)
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, field.type) for column, field in zip(columns, _REPORT)], schema=_REPORT
            )

    asked = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return asked.mapInArrow(find, _COLUMNS)
