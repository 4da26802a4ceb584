import random
import zlib
from array import array
from bisect import bisect_left, insort
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from helpers import documents, nothing
from tokenizers import Tokenizer

from plateia.llm.packing import pack_documents, plan_sequences

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
WHOLE = Tokenizer.from_file(WORD_BPE)


def best_fit_decreasing(lengths, capacity):
    gaps, opened = [], 0
    for length in sorted(lengths, reverse=True):
        at = bisect_left(gaps, length)
        gap = gaps.pop(at) if at < len(gaps) else capacity
        opened += at == len(gaps) and gap == capacity
        if gap > length:
            insort(gaps, gap - length)
    return opened


@pytest.mark.parametrize("capacity, draw", [
    (2048, lambda rng: min(2048, int(rng.lognormvariate(6, 1.2)) + 1)),
    (2048, lambda rng: rng.choice([700, 690, 1300, 1350, 5, 1024, 2048])),
    (16, lambda rng: rng.choice([5, 6, 11, 16])),
    (8, lambda rng: 8),
])
def test_plans_are_full_gapless_and_near_best_fit(capacity, draw):
    rng = random.Random(3)
    lengths = [draw(rng) for _ in range(8000)]
    plan, opened = plan_sequences(Counter(lengths), capacity)
    placed, inside = Counter(), defaultdict(list)
    for length, rank, n, first, offset in plan:
        assert rank == placed[length]
        placed[length] += n
        for sequence in range(first, first + n):
            inside[sequence].append((offset, length))
    assert placed == Counter(lengths) and len(inside) == opened
    for pieces in inside.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    assert opened <= best_fit_decreasing(lengths, capacity) * 1.01 + 1
    assert plan_sequences({}, capacity) == ([], 0)


def test_documents_are_cut_and_placed(spark):
    rng = random.Random(1)
    texts = [" ".join(rng.choices(["alpha", "beta", "gamma"], k=rng.randint(0, 90))) for _ in range(60)]
    texts += [None, "", (7, texts[0]), (None, "no id"), (7, texts[0])]
    docs = documents(spark, texts, piece=9, offset="x", place=1)
    rows = pack_documents(docs, WORD_BPE, end_id=0, capacity=32, keep_ids=True).collect()
    pieces = defaultdict(list)
    for row in rows:
        assert zlib.crc32(row.ids) == row.ids_crc32 and len(row.ids) == 4 * row.length
        pieces[row.doc_id].append(row)
    for doc_id, text in [(i, t) for i, t in enumerate(texts) if not isinstance(t, tuple) and i != 7] + [(None, "no id")]:
        own = sorted(pieces[doc_id], key=lambda r: r.piece)
        ids = WHOLE.encode(text or "", add_special_tokens=False).ids + [0]
        assert b"".join(r.ids for r in own) == array("I", ids).tobytes()
        assert [r.start for r in own] == list(range(0, len(ids), 32))
    sequences = defaultdict(list)
    for row in rows:
        sequences[row.sequence_id].append((row.offset, row.length))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 32
    assert len(sequences) <= best_fit_decreasing([r.length for r in rows], 32) + 1


def test_nothing_to_pack(spark):
    assert pack_documents(nothing(spark), WORD_BPE).count() == 0
