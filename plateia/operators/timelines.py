"""Daily sentiment timelines per candidate and per press channel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plateia import defaults
from plateia.functions.numeric import percent, sentiment_counts, total


def timeline(comments: DataFrame, group: str) -> DataFrame:
    """Per group and publication day: counts, means, likes and two sentiment shares."""
    return (
        comments.withColumn("data", F.to_date("published_at"))
        .filter(F.col(group).isNotNull() & F.col("data").isNotNull())
        .groupBy(group, "data")
        .agg(
            *sentiment_counts(F.col("sentimento")),
            F.count("comment_id").alias("total_comentarios"),
            F.avg("score_sentimento").alias("score_sentimento_medio"),
            F.avg("score_emocao").alias("score_emocao_medio"),
            total(F.col("like_count")).alias("likes_total"),
            F.avg("like_count").alias("likes_media"),
        )
        .withColumns(
            {
                f"sentimento_{side}_pct": percent(
                    F.col(f"sentimento_{side}"), F.col("total_comentarios")
                )
                for side in ("positivo", "negativo")
            }
        )
        .orderBy(group, "data")
    )


def candidate_timeline(enriched: DataFrame) -> DataFrame:
    """Timeline of comments on candidates' own channels."""
    return timeline(
        enriched.filter(F.col("category") == defaults.CANDIDATE_CATEGORY), "candidato"
    )


def channel_timeline(enriched: DataFrame) -> DataFrame:
    """Timeline of comments on press channels; the channel title is the theme."""
    press = enriched.filter(F.col("category") == defaults.PRESS_CATEGORY)
    return timeline(press.withColumnRenamed("channel_title", "tema"), "tema")
