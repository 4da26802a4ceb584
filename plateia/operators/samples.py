"""Anonymised comment samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plateia.functions.privacy import anonymize_loose, anonymize_strict


def _matching(comments: DataFrame, **equal_to: str | None) -> DataFrame:
    """Rows equal to every given value; None switches a filter off."""
    for column, value in equal_to.items():
        if value is not None:
            comments = comments.filter(F.col(column) == value)
    return comments


def sample_by_emotion(comments: DataFrame, emotion: str | None = None, size: int = 15) -> DataFrame:
    """The first comments by id, optionally of one emotion, with personal data masked."""
    return (
        _matching(comments, emocao=emotion)
        .orderBy("comment_id")
        .limit(size)
        .select(
            "comment_id",
            anonymize_strict(F.col("text_clean")).alias("text_anonimizado"),
            "emocao",
            "score_emocao",
            "sentimento",
            "score_sentimento",
            "like_count",
        )
    )


def sample_by_candidate(
    enriched: DataFrame,
    candidate: str | None = None,
    sentiment: str | None = None,
    size: int = 10,
    seed: int = 42,
) -> DataFrame:
    """A reproducible random sample, optionally of one candidate and sentiment, masked.

    Rows are ranked by a digest of the seed and the comment id, so the sample
    depends neither on partitioning nor on row order.
    """
    if not 5 <= size <= 100:
        raise ValueError("the sample size must be between 5 and 100")
    return (
        _matching(enriched, candidato=candidate, sentimento=sentiment)
        .orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col("comment_id"))), "comment_id")
        .limit(size)
        .select(
            "comment_id",
            anonymize_loose(F.col("text_clean")).alias("text_anonimizado"),
            "candidato",
            "sentimento",
            "channel_title",
        )
    )


def sample_size(comments: DataFrame, size: int, **equal_to: str | None) -> DataFrame:
    """One row: comments that match and how many of them a sample shows."""
    found = F.count(F.lit(1))
    return _matching(comments, **equal_to).agg(
        found.alias("encontrados"), F.least(found, F.lit(size).cast("bigint")).alias("mostrando")
    )
