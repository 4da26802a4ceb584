"""License scans against windows counted one by one."""

import random
import re

import pytest
from helpers import documents, nothing

from check_oracles import connect, differences
from plateia.llm import licenses
from plateia.llm.oracles import ORACLES
from plateia.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
NOTICES = [("one", "a b c d"), ("two", "b c d e f g h i j"), ("two", "k a"), ("none", "zz yy"), ("empty", "--")]
PHRASES = [("a b", "ab"), ("a a", "aa"), ("c d e", "cde")]


def words_of(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute_force(text, notices, phrases, percent):
    words = words_of(text)
    places, base, labels, best = [], set(), set(), 0.0
    for phrase, label in phrases:
        own = words_of(phrase)
        found = [i for i in range(len(words)) if words[i : i + len(own)] == own]
        places += found
        base |= {label} if found else set()
    for label, notice in notices:
        own = words_of(notice)
        if not own:
            continue
        stride = 1
        while stride < len(own):
            stride *= 2
        needed = -(-percent * len(set(own)) // 100)
        for start in range(0, max(1, len(words)), stride):
            common = len(set(words[start : start + 2 * stride]) & set(own))
            if common >= needed:
                labels.add(label)
                best = max(best, common / len(set(own)))
    listed = lambda names: ",".join(sorted(names))
    return (
        len(words), len(places), min(places, default=None), max(places, default=None),
        listed(base), listed(base | labels), 1.0 if places else best,
    )


def test_equals_brute_force(spark):
    rng = random.Random(1)
    texts = [None, "", "...", "A B", "a-b. C/D", "É é É", "K a b c", "kİ a", "a a a a", "x\x00y a\x7fb"]
    texts += [" ".join(rng.choices("abcdefghijkxyz", k=rng.randint(0, 60))) for _ in range(150)]
    texts += ["a b c d " * 3000, "lorem " * 4000 + "b c d e f g h i " + "ipsum " * 4000]
    for percent in (60, 80, 100):
        found = licenses.scan_licenses(documents(spark, texts, word="x", row=3), NOTICES, PHRASES, percent)
        rows = {r.doc_id: tuple(r)[1:-1] for r in found.collect()}
        for i, text in enumerate(texts):
            assert rows[i] == brute_force(text, NOTICES, PHRASES, percent), (percent, text)


def test_blocks_name_where_a_notice_stands(spark):
    text = "lorem " * 100 + "Released under the MIT License. " + "ipsum " * 100
    row = licenses.scan_licenses(documents(spark, [text])).first()
    assert row.labels == "mit" and row.base_labels == "mit" and (row.first_word, row.last_word) == (103, 103)
    # The block of words 88 to 103 ends before "License", which leaves four of five words.
    assert [(b.block_start, b.label, b.containment) for b in row.blocks] == [(88, "mit", 0.8), (96, "mit", 1.0)]
    near = licenses.scan_licenses(documents(spark, [text.replace("MIT", "M.I.T.")])).first()
    assert (near.labels, near.n_base, near.score) == ("mit", 0, 0.8)


def test_repeated_and_null_ids_and_empty_table(spark):
    texts = [(None, "mit license"), (None, "none"), (4, "mit license"), (4, "mit license"), (4, None)]
    rows = licenses.scan_licenses(documents(spark, texts)).collect()
    assert sorted((str(r.doc_id), r.n_base, r.base_labels) for r in rows) == [
        ("4", 0, ""), ("4", 1, "mit"), ("4", 1, "mit"), ("None", 0, ""), ("None", 1, "mit")
    ]
    assert licenses.scan_licenses(nothing(spark)).collect() == []


def test_no_python_in_the_plan(spark):
    plan = QUERIES["op11_license_scan"](spark, FOLDER)._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize("name", ["op11_license_scan", "op13_prefix_trie"])
def test_query_equals_its_statement(spark, name):
    assert differences(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLES[name]) is None
