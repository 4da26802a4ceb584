import random
import zlib
from array import array

import numpy as np
import public_tokenizers
import pytest
from helpers import documents, nothing
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from plateia.llm import token_files
from plateia.llm.common import new_folder
from plateia.llm.tokens import Encoder

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
WHOLE = Tokenizer.from_file(WORD_BPE)
TEXTS = ["Hello, world's", None, "", "a  b\n\tc", "x" * 40_000, "Ünïcode 中文 <|endoftext|> ok", "same", "same"]


def ids_of(text):
    return WHOLE.encode(text or "", add_special_tokens=False).ids


def test_chunks_give_the_ids_of_whole_texts():
    encoder, rng = Encoder(WORD_BPE, kept_chunks=60), random.Random(5)
    letters = "aZ'sİΣςé́ß\x1c\xa0  .1½²ˇ\n\tmœŒǅﬁ中日ñÑx'rE'Ll\xad\x85|<>"
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 25))) for _ in range(4000)]
    for text in [*texts, *(t or "" for t in TEXTS)]:
        assert encoder.encode(text) == array("I", ids_of(text)).tobytes(), text


def test_other_tokenizers_encode_texts_whole():
    path = public_tokenizers.path("byte_bpe_50k.json")
    whole = Tokenizer.from_file(path).encode("a  b\n'c", add_special_tokens=False).ids
    assert Encoder(path).encode("a  b\n'c") == array("I", whole).tobytes()


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 32), st.integers(0, 200), st.integers(0, 2**32 - 1))
def test_packing_is_a_round_trip_at_every_width(bits, count, seed):
    ids = np.random.default_rng(seed).integers(0, 1 << bits, count, dtype=np.uint64).astype(np.uint32)
    packed = token_files.pack(ids, bits)
    assert len(packed) == -(-count // 8) * bits
    assert (token_files.unpack(packed, bits, count) == ids).all()


def test_widths():
    assert [token_files.bits_for(n) for n in (1, 2, 3, 256, 257, 49408)] == [1, 1, 2, 8, 9, 16]
    with pytest.raises(ValueError):
        token_files.pack(np.array([8]), 3)


def test_files_hold_every_document_in_order(spark):
    docs = documents(spark, [*TEXTS, (None, "no id")], start=5, shard="x", n_tokens=1)
    folder = new_folder(spark, "test")
    manifest = token_files.write_token_files(docs, WORD_BPE, 1, folder, block_ids=64)
    rows = token_files.read_token_files(manifest).orderBy("start").collect()
    expected, at = [], 0
    for doc_id, text in [(None, "no id"), *enumerate(TEXTS)]:
        ids = ids_of(text) + [1]
        expected.append((doc_id, at, len(ids), zlib.crc32(array("I", ids).tobytes())))
        at += len(ids)
    assert [tuple(r)[:4] for r in rows] == expected

    every = [i for d in [(None, "no id"), *enumerate(TEXTS)] for i in ids_of(d[1]) + [1]]
    at = 0
    for row in manifest.orderBy("shard").collect():
        reader = token_files.ShardReader(row.path)
        assert reader.bits == 16
        rng = random.Random(row.shard)
        for _ in range(30):
            start = rng.randint(0, row.ids)
            stop = start + rng.randint(0, 300)
            assert reader.read(start, stop).tolist() == every[at + start : at + min(stop, row.ids)]
        reader.close()
        at += row.ids


def test_no_documents_give_no_files(spark):
    assert token_files.token_files(spark, nothing(spark), WORD_BPE, 1).count() == 0


def test_a_cut_file_is_refused(tmp_path):
    writer = token_files.ShardWriter(f"file://{tmp_path}/a.ids", 16, 64)
    writer.add(1, array("I", range(500)).tobytes())
    writer.close()
    data = (tmp_path / "a.ids").read_bytes()
    (tmp_path / "b.ids").write_bytes(data[:-3])
    with pytest.raises(ValueError, match="whole token file"):
        token_files.ShardReader(f"file://{tmp_path}/b.ids")
