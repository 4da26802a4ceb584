"""Star labels to sentiment, and keyword hits to emotion, as plain columns."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from plateia import defaults
from plateia.functions.keywords import contained_counts
from plateia.functions.text import emotion_folder


def stars_of(label: Column) -> Column:
    """Rating named by a classifier label; anything but 5, 4, 2 or 1 is 3."""
    lowered = F.lower(label)
    rating = F.lit(3)
    for stars in (1, 2, 4, 5):
        rating = F.when(lowered.contains(f"{stars} star"), stars).otherwise(rating)
    return rating


def sentiment_of(stars: Column) -> Column:
    return F.when(stars > 3, "POSITIVO").when(stars < 3, "NEGATIVO").otherwise("NEUTRO")


def signed_score(sentiment: Column, confidence: Column) -> Column:
    return (
        F.when(sentiment == "POSITIVO", confidence)
        .when(sentiment == "NEGATIVO", -confidence)
        .otherwise(F.lit(0.0))
    )


def keyword_hits(text: Column, lexicon: Mapping[str, Sequence[str]]) -> Column:
    """Struct of hits per emotion: how many distinct keywords occur in the folded text.

    All keywords are found in one pass. NULL has no hits.
    """
    return contained_counts(text, lexicon, emotion_folder())


def emotion_scores(sentiment: Column, stars: Column, hits: Column) -> Column:
    """Struct of scores: hits relative to the best allowed emotion, or the star fallback."""

    def side(names: Sequence[str], polarity: str) -> list[Column]:
        best = F.greatest(*(hits[name] for name in names))
        fields = []
        for name in names:
            by_stars = F.lit(0.0)
            for rating, fallback in defaults.EMOTION_FALLBACK.items():
                if name in fallback:
                    by_stars = F.when(stars == rating, fallback[name]).otherwise(by_stars)
            fields.append(
                F.when(sentiment != polarity, 0.0)
                .when(best > 0, hits[name] / best)
                .otherwise(by_stars)
                .alias(name)
            )
        return fields

    return F.struct(
        *side(defaults.POSITIVE_EMOTIONS, "POSITIVO"),
        F.when(sentiment == "NEUTRO", 1.0).otherwise(0.0).alias("NEUTRO"),
        *side(defaults.NEGATIVE_EMOTIONS, "NEGATIVO"),
    )


def dominant_emotion(sentiment: Column, scores: Column) -> Column:
    """Best-scored emotion the sentiment allows; ties fall to the fixed emotion order."""

    def first_best(names: Sequence[str]) -> Column:
        top = F.greatest(*(scores[name] for name in names))
        return F.coalesce(*(F.when(scores[name] == top, name) for name in names))

    return (
        F.when(sentiment == "POSITIVO", first_best(defaults.POSITIVE_EMOTIONS))
        .when(sentiment == "NEGATIVO", first_best(defaults.NEGATIVE_EMOTIONS))
        .otherwise("NEUTRO")
    )


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it.

    Without it every comparison would repeat the text checks and scores. The
    keyword search below it is protected by ``evaluated_once``.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def emotion_of(sentiment: Column, stars: Column, hits: Column) -> Column:
    """Struct of ``emocao``, ``score_emocao`` and a score per emotion."""

    def result(sentiment: Column, scores: Column) -> Column:
        return _bind(
            dominant_emotion(sentiment, scores),
            lambda emotion: F.struct(
                emotion.alias("emocao"),
                F.coalesce(
                    *(F.when(emotion == name, scores[name]) for name in defaults.EMOTIONS)
                ).alias("score_emocao"),
                *(scores[name].alias(f"score_{name.lower()}") for name in defaults.EMOTIONS),
            ),
        )

    return _bind(
        F.struct(sentiment.alias("sentiment"), stars.alias("stars"), hits.alias("hits")),
        lambda row: _bind(
            emotion_scores(row["sentiment"], row["stars"], row["hits"]),
            lambda scores: result(row["sentiment"], scores),
        ),
    )
