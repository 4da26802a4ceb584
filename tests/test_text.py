import random
import re
import unicodedata

import pytest

from plateia.functions import privacy, text


def test_clean_text(column):
    values = [None, "a   b\n", "é", "\x1c x  　y ​", "", " \t", "ok"]
    expected = ["", "a b", "é", "x y ​", "", "", "ok"]
    assert column(text.clean_text, values) == expected


def test_clean_text_leaves_single_spaces_and_composed_characters(column):
    spaces = [chr(p) for p in range(0x3100) if chr(p).isspace()]
    rng = random.Random(1)
    alphabet = spaces + list("ab ȩ́́가ﬁ😀")
    values = ["".join(rng.choices(alphabet, k=40)) for _ in range(300)]
    cleaned = column(text.clean_text, values)
    assert column(text.clean_text, cleaned) == cleaned
    for value, result in zip(values, cleaned):
        assert unicodedata.is_normalized("NFC", result)
        assert [c for c in result if c.isspace()] == [" "] * result.count(" ")
        assert "  " not in result and result == result.strip(" ")
        visible = "".join(value.split())
        assert unicodedata.normalize("NFD", result.replace(" ", "")) == unicodedata.normalize("NFD", visible)


def test_fold_text(column):
    values = [None, "Comitê STRAẞE", "AÇÃO", "plain ASCII", "ΣΊΣΥΦΟΣ", "İ"]
    expected = [None, "comite strasse", "acao", "plain ascii", "σισυφοσ", "i"]
    assert column(text.fold_text, values) == expected


def test_fold_leaves_no_mark_on_any_character_and_is_stable(column):
    points = [p for p in range(1, 0x20000) if not 0xD800 <= p < 0xE000]
    values = ["".join(map(chr, points[i : i + 64])) for i in range(0, len(points), 64)]

    folded = column(text.fold_text, values)
    assert folded[0] == values[0].lower()  # ASCII loses its case alone
    for result in folded:
        assert not any(map(unicodedata.combining, result))
    assert column(text.fold_text, folded) == folded


def test_fold_for_emotion_knows_only_its_accents(column):
    assert column(text.fold_for_emotion, ["ÓTIMO Ação", "Ñandú è", None]) == [
        "otimo acao",
        "ñandu è",
        None,
    ]


def test_is_blank(column):
    assert column(text.is_blank, [None, "", "  \n", "\x1f", "x"]) == [True] * 4 + [False]


SAMPLE = "veja https://x.y/a?b=1 a@b.com @joao (85) 99999-1234 123.456.789-01"


def test_anonymize_strict(column):
    values = [SAMPLE, "85 99999-1234", None, "sem dados", "１２3456-7890"]
    assert column(privacy.anonymize_strict, values) == [
        "veja [URL] [EMAIL] [MENÇÃO] [TELEFONE] [CPF]",
        "[TELEFONE]",
        "",
        "sem dados",
        "[TELEFONE]",
    ]


def test_anonymize_loose_keeps_tax_ids(column):
    values = ["85 99999-1234 123.456.789-01", "tel 12345678", "x@y", None]
    masked = column(privacy.anonymize_loose, values)
    assert masked[0].startswith("[TELEFONE]") and masked[0].endswith("123.456.789-01")
    assert masked[1:] == ["tel[TELEFONE]", "x[MENÇÃO]", ""]


@pytest.mark.parametrize("strict", [True, False])
def test_masks_equal_plain_python_regexes(column, strict):
    # What the masks match, as plain patterns.
    url = r"https?://[!$-_a-z]+"
    rules = [
        (url, "[URL]"),
        (r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}", "[EMAIL]"),
        (r"@[a-zA-Z0-9_]+", "[MENÇÃO]"),
    ]
    if strict:
        rules += [
            (r"\(\d{2}\)\s*\d{4,5}-\d{4}", "[TELEFONE]"),
            (r"\d{2}\s*\d{4,5}-\d{4}", "[TELEFONE]"),
            (r"\d{3}\.\d{3}\.\d{3}-\d{2}", "[CPF]"),
        ]
    else:
        rules.append((r"\(?(?:\d{2})?\s?9?\d{4}-?\d{4}", "[TELEFONE]"))

    def plain(value):
        for pattern, tag in rules:
            value = re.sub(pattern, tag, value)
        return value

    rng = random.Random(7)
    pieces = ["a@b.co1x", "@", ".", "-", "(85)", " ", "9", "1234", "12345", "99", "x", "é", "_",
              "http://", "https://a", "123.456.789-01", "@ab", "co.br", "%", " ", "+"]
    values = ["".join(rng.choices(pieces, k=rng.randint(1, 14))) for _ in range(3000)]
    mask = privacy.anonymize_strict if strict else privacy.anonymize_loose
    assert column(mask, values) == [plain(value) for value in values]


def test_masks_are_linear_on_long_runs(column):
    long = "a" * 300_000
    values = ["http://" + long, long + " @", "@" + long, "1" * 3 + " " * 100_000 + "-"]
    assert column(privacy.anonymize_strict, values) == ["[URL]", long + " @", "[MENÇÃO]", values[3]]
