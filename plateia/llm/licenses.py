"""License scans: an exact set-similarity join of text blocks with license notices.

Words are runs of digits, letters and characters beyond ASCII, with A-Z in lower
case. A notice of m distinct words is held against blocks of the text: windows of
2S words at every S words, where S is the least power of two that takes the whole
notice, so any passage no longer than the notice lies whole in some block. A block
meets a notice when it holds at least ``percent`` of the notice's distinct words.

The join is exact. Only words of some notice matter, so blocks are reduced to them
first. Words are ordered by how often they stand in the whole corpus, rarest first;
with o = ceil(percent * m / 100) words required,

- prefix: a block that meets the notice shares one of the notice's first m - o + 1
  words, and that word is among the block's first |block| - o + 1;
- length: the block has at least o words;
- position: one common word at places i and j leaves at most
  1 + min(m - i - 1, |block| - j - 1) common words, which must reach o.

What passes is verified by intersecting the two sets. Column functions only. Texts
are read once, in a map; what is shuffled are the words of notices in documents that
hold a prefix word. Nothing is shuffled by word or notice, so frequent ones meet no
single task. Collected and broadcast: one count per word of the notices, and the
notices themselves, both bounded by the list that the caller passes.

Phrases are exact: their words must stand consecutively anywhere in the text. They
name the base labels, which blocks never take away.

NULL and empty texts have no words and no labels; their score is 0. Every row gives
one row, repeated and NULL ids too. Extra columns of the input are left out.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plateia.llm.common import written

_SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# Phrases and the labels they name.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Notices of public licenses, as they ask to be cited.
NOTICES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    (
        "apache-2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of the "
        "License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the "
        "GNU General Public License as published by the Free Software Foundation",
    ),
    ("mit", "Released under the MIT License"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction",
    ),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met",
    ),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
)


@dataclass(frozen=True)
class Notice:
    """A notice as the join sees it: its distinct words, how many must be found, its stride."""

    label: str
    words: tuple[str, ...]
    needed: int
    stride: int


def words_of(text: str) -> list[str]:
    """The words of a notice or phrase, by the rule for texts."""
    lowered = re.sub("[A-Z]", lambda letter: letter.group().lower(), text)
    return [word for word in re.split(_SEPARATORS, lowered) if word]


def prepare(notices: Sequence[tuple[str, str]], percent: int) -> list[Notice]:
    prepared = []
    for label, text in notices:
        words = words_of(text)
        distinct = tuple(dict.fromkeys(words))
        needed = max(1, -(-percent * len(distinct) // 100))
        if words:
            prepared.append(Notice(label, distinct, needed, 1 << (len(words) - 1).bit_length()))
    return prepared


def hits_of(text: Column, vocabulary: Sequence[str]) -> Column:
    """Struct of the word count and the place and form of every word of the vocabulary, in order.

    A word in upper case is lowered on its own. The Kelvin sign, whose lower case is an
    ASCII letter, is no A-Z: such words differ in bytes and are left out.
    """

    def placed(word: Column, place: Column) -> Column:
        whole = F.octet_length(word).alias("bytes")
        return F.struct(place.alias("place"), F.lower(word).alias("word"), whole)

    def known(hit: Column) -> Column:
        return hit.word.isin(*vocabulary) & (F.octet_length(hit.word) == hit.bytes)

    def hits(words: Column) -> Column:
        kept = F.filter(F.transform(words, placed), known)
        return F.transform(kept, lambda hit: F.struct(hit.place.alias("place"), hit.word.alias("word")))

    words = F.filter(F.split(F.coalesce(text, F.lit("")), _SEPARATORS), lambda word: word != "")
    # Within a lambda, so that the text is split once for both fields.
    both = F.transform(
        F.array(words),
        lambda found: F.struct(F.size(found).cast("bigint").alias("n_words"), hits(found).alias("hits")),
    )
    return F.get(both, F.lit(0))


def phrase_places(hits: Column, phrase: Sequence[str]) -> Column:
    """Every place where the words of the phrase stand consecutively.

    All its words are in the vocabulary, so consecutive words are consecutive hits.
    """

    def starts(hit: Column, at: Column) -> Column:
        found = hit.word == phrase[0]
        for ahead, word in enumerate(phrase[1:], 1):
            later = F.get(hits, at + ahead)
            found = found & F.coalesce((later.place == hit.place + ahead) & (later.word == word), F.lit(False))
        return found

    return F.transform(F.filter(hits, starts), lambda hit: hit.place.cast("bigint"))


def word_counts(landed: DataFrame, vocabulary: Sequence[str]) -> dict[str, int]:
    """How often each word of the vocabulary stands in the whole corpus; one row per word comes back."""
    rows = landed.select(F.explode("hits.word").alias("word")).groupBy("word").count().collect()
    return dict.fromkeys(vocabulary, 0) | {row["word"]: row["count"] for row in rows}


def block_matches(
    spark: SparkSession, landed: DataFrame, notices: Sequence[Notice], counts: dict[str, int]
) -> DataFrame:
    """Every (row, block, notice) that meets: label, first word of the block, containment."""
    rank = {word: place for place, word in enumerate(sorted(counts, key=lambda word: (counts[word], word)))}
    sets = [sorted(rank[word] for word in notice.words) for notice in notices]
    prefixes = [ranks[: len(ranks) - n.needed + 1] for n, ranks in zip(notices, sets)]
    starters = sorted({word for word in rank if any(rank[word] in prefix for prefix in prefixes)})
    strides = sorted({notice.stride for notice in notices})
    least = {s: min(n.needed for n in notices if n.stride == s) for s in strides}

    # Both tables have a row per word of a notice at most, so their size is the caller's list.
    vocabulary = {(w, n.stride, rank[w], least[n.stride]) for n in notices for w in n.words}
    words = spark.createDataFrame(sorted(vocabulary), "word STRING, stride INT, rank INT, least INT")
    entries = spark.createDataFrame(
        [
            (number, n.label, n.stride, prefix_rank, place, n.needed, ranks)
            for number, (n, ranks, prefix) in enumerate(zip(notices, sets, prefixes))
            for place, prefix_rank in enumerate(prefix)
        ],
        "notice INT, label STRING, stride INT, rank INT, i INT, needed INT, ranks ARRAY<INT>",
    )

    blocks = (
        landed.filter(F.exists("hits", lambda hit: hit.word.isin(*starters)))
        .select("row", F.explode("hits").alias("hit"))
        .select("row", "hit.place", "hit.word")
        .join(F.broadcast(words), "word")
        .withColumn("last", F.expr("place div stride"))
        .select("row", "stride", "least", "rank", F.explode(F.array("last", F.col("last") - 1)).alias("block"))
        .filter("block >= 0")
        .groupBy("row", "stride", "block")
        .agg(F.sort_array(F.collect_set("rank")).alias("block_ranks"), F.first("least").alias("least"))
        .withColumn("n", F.size("block_ranks"))
        .filter("n >= least")
    )
    prefix = F.slice("block_ranks", F.lit(1), F.col("n") - F.col("least") + 1)
    candidates = (
        blocks.select("row", "stride", "block", "block_ranks", "n", F.posexplode(prefix).alias("j", "rank"))
        .join(F.broadcast(entries), ["stride", "rank"])
        .filter("n >= needed AND 1 + least(size(ranks) - i - 1, n - j - 1) >= needed")
    )
    common = F.size(F.array_intersect("block_ranks", "ranks"))
    return (
        candidates.withColumn("common", common)
        .filter("common >= needed")
        .select(
            "row",
            "label",
            (F.col("block") * F.col("stride")).cast("bigint").alias("block_start"),
            (F.col("common") / F.size("ranks")).alias("containment"),
        )
        .distinct()
    )


def scan_licenses(
    docs: DataFrame,
    notices: Sequence[tuple[str, str]] = NOTICES,
    phrases: Sequence[tuple[str, str]] = PHRASES,
    percent: int = 80,
) -> DataFrame:
    """Base places and labels of every document, and the labels of all blocks that meet a notice.

    ``blocks`` lists the matches by start, label and containment. ``score`` is the
    best containment of a notice, and 1 where a phrase stands whole.
    """
    spark = docs.sparkSession
    prepared = prepare(notices, percent)
    searched = [(words_of(phrase), label) for phrase, label in phrases]
    vocabulary = sorted({w for n in prepared for w in n.words} | {w for words, _ in searched for w in words})
    landed = written(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col("doc_id"),
            hits_of(F.col("text"), vocabulary).alias("found"),
        ).select("row", "doc_id", "found.*"),
        "license-hits",
    )
    matches = (
        block_matches(spark, landed, prepared, word_counts(landed, vocabulary))
        .groupBy("row")
        .agg(
            F.max("containment").alias("best"),
            F.collect_set("label").alias("found_labels"),
            F.sort_array(F.collect_list(F.struct("block_start", "label", "containment"))).alias("blocks"),
        )
    )
    nothing = F.array().cast("array<string>")
    places = [phrase_places(F.col("hits"), words) for words, _ in searched]
    based = landed.select(
        "row", "doc_id", "n_words", *(p.alias(f"p{i}") for i, p in enumerate(places))
    ).select(
        "row",
        "doc_id",
        "n_words",
        F.concat(F.array().cast("array<bigint>"), *(f"p{i}" for i in range(len(places)))).alias("places"),
        F.concat(
            nothing, *(F.when(F.size(f"p{i}") > 0, F.array(F.lit(label))).otherwise(nothing) for i, (_, label) in enumerate(searched))
        ).alias("named"),
    )
    joined = based.join(matches, "row", "left")

    def listed(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    return joined.select(
        "doc_id",
        "n_words",
        F.size("places").cast("bigint").alias("n_base"),
        F.array_min("places").alias("first_word"),
        F.array_max("places").alias("last_word"),
        listed(F.col("named")).alias("base_labels"),
        listed(F.concat("named", F.coalesce("found_labels", nothing))).alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
        F.coalesce(
            "blocks", F.array().cast("array<struct<block_start:bigint,label:string,containment:double>>")
        ).alias("blocks"),
    )
