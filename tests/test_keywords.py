"""Keywords found in one pass, against one search per keyword."""

import random
import time

import pyarrow as pa
import pytest

from plateia import defaults
from plateia.functions.emotion import keyword_hits
from plateia.functions.keywords import contained, contained_counts, keyword_finder
from plateia.functions.text import emotion_folder, fold


def _random_texts(rng, alphabet, count, longest):
    return ["".join(rng.choices(alphabet, k=rng.randint(0, longest))) for _ in range(count)]


@pytest.mark.parametrize("alphabet", ["ab", "abcdé ", "aáãç\U0001f600ﬁ"])
def test_equals_one_search_per_keyword(alphabet):
    rng = random.Random(1)
    texts = [None, "", *_random_texts(rng, alphabet, 300, 40)] * 2
    words = ["", *map(fold, _random_texts(rng, alphabet, 40, 4))]
    found = keyword_finder(words, fold)(pa.array(texts, pa.string()))
    assert found == [
        [] if text is None else [i for i, word in enumerate(words) if word in fold(text)] for text in texts
    ]


def test_order_and_repeats_of_the_settings_are_kept(column):
    words = ["reaux", "aux", "reaux", "x"]
    assert column(lambda c: contained(c, words, fold), ["RÉAUX aux", "aux", None, ""]) == [
        words, ["aux", "x"], [], []
    ]
    assert column(lambda c: contained(c, [], fold), ["a", None]) == [[], []]


def test_counts_per_group(column):
    groups = {"A": ["bom", "bom", "om"], "B": [], "C": ["bom", "z"]}
    rows = column(lambda c: contained_counts(c, groups, fold), ["Bom", "om z", None])
    assert [tuple(row) for row in rows] == [(2, 0, 1), (1, 0, 1), (0, 0, 0)]


def test_lexicon_hits_equal_one_search_per_keyword(column):
    rng = random.Random(2)
    words = [word for words in defaults.EMOTION_LEXICON.values() for word in words]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 9))).upper() for _ in range(200)]
    folded = emotion_folder()
    rows = column(lambda c: keyword_hits(c, defaults.EMOTION_LEXICON), texts)
    for text, row in zip(texts, rows):
        assert row.asDict() == {
            name: sum(word in folded(text) for word in words) for name, words in defaults.EMOTION_LEXICON.items()
        }


def test_many_keywords_cost_about_what_few_do():
    rng = random.Random(3)
    texts = pa.array(_random_texts(rng, "abcdefghijklmnopqrstuvwxyz ", 400, 4000))

    def seconds(count):
        find = keyword_finder(_random_texts(rng, "abcdefghijklmnopqrstuvwxyz", count, 14), fold)
        find(pa.array(["build"]))
        best = []
        for _ in range(3):
            started = time.perf_counter()
            find(texts)
            best.append(time.perf_counter() - started)
        return min(best)

    assert seconds(10_000) < 20 * seconds(10)


def test_fold_letter_by_letter_equals_whole_texts():
    import unicodedata

    rng = random.Random(4)
    letters = [chr(p) for p in [*range(0x20, 0x600), *range(0x1E00, 0x2000), 0xAC01, 0x1F600, 0x1E9E, 0x3B1, 0x345]]
    for _ in range(300):
        text = "".join(rng.choices(letters, k=rng.randint(0, 60)))
        whole = unicodedata.normalize("NFD", text.casefold())
        assert fold(text) == "".join(c for c in whole if not unicodedata.combining(c))
