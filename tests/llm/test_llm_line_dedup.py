import random

from helpers import documents, nothing
from plateia.llm.line_dedup import dedup_lines, weigh


def run(spark, texts, least=6, gram=3):
    df = documents(spark, texts, runs="x", removed="y", n_lines=7, first=1)
    return {r.doc_id: r for r in dedup_lines(df, least, gram).collect()}


def test_equals_brute_force_on_random_texts(spark):
    rng = random.Random(6)
    lines = [" ".join(rng.choices("abcdefgh", k=rng.randint(0, 5))) for _ in range(12)]
    texts = ["\n".join(rng.choices(lines, k=rng.randint(1, 14))) for _ in range(120)]
    texts += [texts[3]] * 30 + ["\n".join([lines[0]] * 40), "\n".join(["p q r", "s t u"] * 20)]
    found = run(spark, texts)
    for doc_id, gone in every_run(list(enumerate(texts)), 6).items():
        row = found[doc_id]
        listed = {i for r in row.removed for i in range(r.first, r.last + 1)}
        assert listed == gone, doc_id
        kept = [line for i, line in enumerate(texts[doc_id].split("\n")) if i not in gone]
        assert row.text == "\n".join(kept)
        assert (row.n_lines, row.removed_lines) == (texts[doc_id].count("\n") + 1, len(gone))


def test_a_passage_keeps_its_first_occurrence_only(spark):
    passage = "\n".join(f"line {i} of a passage that many documents share with others" for i in range(6))
    texts = [f"own words {i} here\n{passage}\nand the end {i}" for i in range(40)]
    found = run(spark, texts, least=30, gram=15)
    assert found[0].removed_lines == 0
    assert {found[i].removed_lines for i in range(1, 40)} == {6}
    assert found[7].text == "own words 7 here\nand the end 7"


def test_short_repeated_lines_stay(spark):
    found = run(spark, [f"All rights reserved.\nown text {i}" for i in range(20)], least=30, gram=15)
    assert {r.removed_lines for r in found.values()} == {0}


def test_awkward_rows(spark):
    long = "\n".join(f"word{i} and some more of them" for i in range(30_000))
    found = run(spark, [None, "", "\n\n", long, long, "x"], least=30, gram=15)
    assert (found[0].text, found[0].n_lines) == (None, 0)
    assert [found[i].text for i in (1, 2, 5)] == ["", "\n\n", "x"]
    assert found[3].removed_lines == 0 and found[4].text == ""
    assert dedup_lines(nothing(spark)).count() == 0


def test_repeated_rows_are_one_document(spark):
    text = "\n".join(f"word{i} and some more of them" for i in range(20))
    df = documents(spark, [(4, text), (4, text), (None, text)])
    rows = dedup_lines(df, 30, 15).collect()
    assert {(r.doc_id, r.removed_lines) for r in rows} == {(None, 0), (4, 20)} and len(rows) == 3


def every_run(texts, least):
    """Lines of every run, however long, that weighs enough and occurred before, in document order."""
    seen, removed = set(), {}
    for doc_id, text in texts:
        lines, gone = [line.strip() for line in text.split("\n")], set()
        for first in range(len(lines)):
            for last in range(first, len(lines)):
                run = tuple(lines[first : last + 1])
                if sum(map(weigh, run)) >= least:
                    gone |= set(range(first, last + 1)) if run in seen else set()
                    seen.add(run)
        removed[doc_id] = gone
    return removed


def test_equals_every_repeated_run_on_random_texts(spark):
    rng = random.Random(8)
    lines = [" ".join(rng.choices("abcdefgh", k=rng.choice([0, 1, 2, 3, 9, 14]))) for _ in range(14)]
    texts = ["\n".join(rng.choices(lines, k=rng.randint(1, 14))) for _ in range(120)]
    texts += [texts[3]] * 3 + ["\n".join([lines[0]] * 40), "\n".join(["p q r", "s t u"] * 20), "a b c d e f g" + "\n" * 9]
    texts.append(texts[-1])
    found = run(spark, texts)
    for doc_id, gone in every_run(list(enumerate(texts)), 6).items():
        listed = {i for r in found[doc_id].removed for i in range(r.first, r.last + 1)}
        assert listed == gone, doc_id


def test_the_tail_of_a_passage_goes_too(spark):
    for weights in ([60, 20], [40, 15], [80, 28], [25, 10, 12]):
        passage = "\n".join(" ".join(f"w{at}x{i}" for i in range(n)) for at, n in enumerate(weights))
        found = run(spark, [f"own words {i} here\n{passage}\nand the end {i}" for i in range(5)], least=30, gram=15)
        assert found[0].removed_lines == 0
        assert {found[i].text for i in range(1, 5)} == {f"own words {i} here\nand the end {i}" for i in range(1, 5)}
