"""Topic relevance: which videos match the configured terms, and whom they mention."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plateia import defaults
from plateia.functions.keywords import contained
from plateia.functions.text import fold

Terms = Sequence[Mapping[str, str]]


def matched_terms(text: Column, terms: Terms) -> Column:
    """Every configured term, folded, that the text contains; config order, repeats kept.

    The text is folded and searched for all terms in one pass. NULL matches none.
    """
    return contained(text, [fold(entry["term"]) for entry in terms], fold)


def with_source_category(videos: DataFrame, channels: DataFrame) -> DataFrame:
    """Adds ``config_category``: the configured category of the source, else unknown.

    ``channels`` holds one row per source. Its join strategy is left to the
    planner, which broadcasts it only while its measured size allows.
    """
    lookup = channels.select("source", F.col("category").alias("config_category"))
    return videos.join(lookup, "source", "left").withColumn(
        "config_category", F.coalesce("config_category", F.lit(defaults.UNKNOWN_CATEGORY))
    )


def mark_relevance(
    videos: DataFrame,
    terms: Terms,
    channels: DataFrame,
    bypass: Collection[str] = (defaults.CANDIDATE_CATEGORY,),
) -> DataFrame:
    """Adds ``matched_terms``; a video is relevant when it is not empty.

    Videos of channels whose configured category is in ``bypass`` are accepted
    unread and carry a marker instead of terms. An empty ``bypass`` filters all.
    """
    bypassed = F.col("config_category").isin(*bypass) if bypass else F.lit(False)
    searched = F.concat_ws(
        " ", F.coalesce("title", F.lit("")), F.coalesce("description", F.lit(""))
    )
    return (
        with_source_category(videos, channels)
        .withColumn("_found", matched_terms(F.when(~bypassed, searched), terms))
        .withColumn(
            "matched_terms",
            F.when(bypassed, F.array(F.lit(defaults.BYPASS_MARKER))).otherwise(F.col("_found")),
        )
        .select(*videos.columns, "matched_terms")
    )


def is_relevant() -> Column:
    return F.size("matched_terms") > 0


def relevant(marked: DataFrame) -> DataFrame:
    return marked.filter(is_relevant())


def discarded(marked: DataFrame) -> DataFrame:
    return marked.filter(~is_relevant())


def selection_counts() -> list[Column]:
    """Aggregates of a selection: evaluated, relevant and discarded videos."""
    return [
        F.count(F.lit(1)).alias("avaliados"),
        F.count_if(is_relevant()).alias("relevantes"),
        F.count_if(~is_relevant()).alias("descartados"),
    ]


def selection_summary(marked: DataFrame) -> DataFrame:
    return marked.agg(*selection_counts())


def mentioned_candidates(terms_column: Column, terms: Terms) -> Column:
    """Distinct sorted labels of matched candidate and running-mate terms."""
    labels = {
        fold(entry["term"]): entry["label"]
        for entry in terms
        if entry["type"] in defaults.MENTION_TYPES
    }
    if not labels:
        return F.array().cast("array<string>")
    lookup = F.create_map(*(F.lit(text) for pair in labels.items() for text in pair))
    named = F.transform(terms_column, lambda term: F.try_element_at(lookup, term))
    return F.array_sort(F.array_distinct(F.array_compact(named)))
