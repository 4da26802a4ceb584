"""Which of many keywords a text contains, in one pass over the folded text.

An Aho-Corasick automaton finds the occurrences of all keywords at once, so a pass
costs about the same for ten keywords and for ten thousand. Each worker builds it
once per task from the keywords, which travel with the function; executors need
pyarrow and pyahocorasick but not this package.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from plateia.functions.text import evaluated_once

Fold = Callable[[str], str]


def keyword_finder(keywords: Sequence[str], fold: Fold) -> Callable[[pa.Array], list[list[int]]]:
    """A function from texts to the ascending places of the keywords that each text's fold contains.

    Keywords are compared as they are given. An empty one is in every text, a NULL
    text contains none. Texts that repeat within a batch are searched once.
    """
    places: dict[str, list[int]] = {}
    for place, keyword in enumerate(keywords):
        places.setdefault(keyword, []).append(place)
    always = places.pop("", [])
    built = []

    def automaton():
        if not built:
            import ahocorasick

            built.append(ahocorasick.Automaton())
            for keyword in places:
                built[0].add_word(keyword, keyword)
            built[0].make_automaton()
        return built[0]

    def find(text: str) -> list[int]:
        found = {keyword for _, keyword in automaton().iter(fold(text))} if places else ()
        return sorted([*always, *(place for keyword in found for place in places[keyword])])

    def find_all(texts: pa.Array) -> list[list[int]]:
        distinct = texts.dictionary_encode()
        answers = [find(text) for text in distinct.dictionary.to_pylist()]
        return [[] if number is None else answers[number] for number in distinct.indices.to_pylist()]

    return find_all


def contained(text: Column, keywords: Sequence[str], fold: Fold) -> Column:
    """Array of the keywords that the folded text contains, in their order, repeats kept."""
    find, words = keyword_finder(keywords, fold), list(keywords)

    @evaluated_once
    @F.arrow_udf(ArrayType(StringType()))
    def search(texts: pa.Array) -> pa.Array:
        return pa.array([[words[place] for place in row] for row in find(texts)], pa.list_(pa.string()))

    return search(text)


def contained_counts(text: Column, groups: Mapping[str, Sequence[str]], fold: Fold) -> Column:
    """Struct with, for every group, how many of its distinct keywords the text contains."""
    members = [(name, word) for name, words in groups.items() for word in dict.fromkeys(words)]
    find = keyword_finder([word for _, word in members], fold)
    names = list(groups)
    group_of = [names.index(name) for name, _ in members]

    @evaluated_once
    @F.arrow_udf(StructType([StructField(name, IntegerType()) for name in names]))
    def count(texts: pa.Array) -> pa.Array:
        hits = [[0] * len(texts) for _ in names]
        for row, found in enumerate(find(texts)):
            for place in found:
                hits[group_of[place]][row] += 1
        return pa.StructArray.from_arrays([pa.array(column, pa.int32()) for column in hits], names)

    return count(text)
