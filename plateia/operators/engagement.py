"""Engagement per candidate and per channel, and the daily volume series.

Comments are first reduced to one row per video. That reduction combines on the
map side, so a video with a third of all comments costs one row per map task,
and joins and mention explosion only ever see one row per video.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plateia import defaults
from plateia.functions.numeric import percent, ratio_or_zero, sentiment_counts, total

SENTIMENT_TOTALS = [f"sentimento_{name.lower()}" for name in defaults.SENTIMENTS]


def per_video(comments: DataFrame) -> DataFrame:
    """Additive comment measures per video; means come later from sums and counts."""
    return comments.groupBy("video_id").agg(*measures())


def measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("_rows"),
        F.count("comment_id").alias("_comments"),
        F.sum("like_count").alias("_likes"),
        F.count("like_count").alias("_liked"),
        F.sum("score_sentimento").alias("_score"),
        F.count("score_sentimento").alias("_scored"),
        *sentiment_counts(F.col("sentimento")),
    ]


def _sentiment_shares(table: DataFrame) -> DataFrame:
    return table.withColumns(
        {
            f"{name}_pct": F.coalesce(percent(F.col(name), F.col("comentarios_total")), F.lit(0.0))
            for name in SENTIMENT_TOTALS
        }
    )


def _summed_counts() -> list[Column]:
    return [total(F.col(name)).alias(name) for name in SENTIMENT_TOTALS]


def candidate_engagement(videos: DataFrame, comments: DataFrame) -> DataFrame:
    """Videos, likes, comments and sentiment per mentioned candidate."""
    return candidates_of(videos, per_video(comments))


def candidates_of(videos: DataFrame, summary: DataFrame) -> DataFrame:
    """The same from comment measures per video.

    The two sides of the outer merge of video and comment summaries have the
    same candidates, so one aggregate over mentioned videos yields both.
    """
    mentions = videos.select(
        "video_id", "like_count", F.explode("candidatos_mencionados").alias("candidato")
    ).filter("candidato IS NOT NULL")
    table = (
        mentions.join(summary, "video_id", "left")
        .groupBy("candidato")
        .agg(
            F.count("video_id").alias("videos_total"),
            total(F.col("like_count")).alias("likes_videos_total"),
            total(F.col("_comments")).alias("comentarios_total"),
            total(F.col("_likes")).alias("likes_comentarios_total"),
            *_summed_counts(),
            ratio_or_zero(F.sum("_score"), F.sum("_scored")).alias("score_sentimento_medio"),
        )
    )
    return _sentiment_shares(table).orderBy(F.desc("comentarios_total"), "candidato")


def channel_engagement(videos: DataFrame, comments: DataFrame) -> DataFrame:
    """Videos, comments, mean likes and sentiment per channel title."""
    return channels_of(videos, per_video(comments))


def channels_of(videos: DataFrame, summary: DataFrame) -> DataFrame:
    """The same from comment measures per video."""
    table = (
        videos.select("video_id", F.col("channel_title").alias("tema"))
        .filter("tema IS NOT NULL")
        .join(summary, "video_id", "left")
        .groupBy("tema")
        .agg(
            F.count_distinct("video_id").alias("videos_total"),
            total(F.col("_comments")).alias("comentarios_total"),
            ratio_or_zero(F.sum("_likes"), F.sum("_liked")).alias("likes_media"),
            *_summed_counts(),
            ratio_or_zero(F.sum("_score"), F.sum("_scored")).alias("score_sentimento_medio"),
        )
    )
    return _sentiment_shares(table).orderBy(F.desc("comentarios_total"), "tema")


def daily_volume(videos: DataFrame, comments: DataFrame) -> DataFrame:
    """New videos, new comments, likes, mean sentiment and comments per video, by day."""
    new_comments = (
        comments.select(_day(), "comment_id", "like_count", "score_sentimento")
        .filter("data IS NOT NULL")
        .groupBy("data")
        .agg(
            F.count("comment_id").alias("_c"),
            F.sum("like_count").alias("_likes"),
            F.avg("score_sentimento").alias("_score"),
        )
    )
    return volume_of_days(videos, new_comments)


def _day() -> Column:
    return F.to_date("published_at").alias("data")


def volume_of_days(videos: DataFrame, new_comments: DataFrame) -> DataFrame:
    """The same from comments, likes and mean sentiment per day (``_c``, ``_likes``, ``_score``)."""
    new_videos = (
        videos.select(_day()).filter("data IS NOT NULL").groupBy("data").agg(F.count("data").alias("_v"))
    )
    nothing = F.lit(0).cast("bigint")
    return (
        new_videos.join(new_comments, "data", "full_outer")
        .select(
            "data",
            F.coalesce("_v", nothing).alias("videos_novos"),
            F.coalesce("_c", nothing).alias("comentarios_novos"),
            F.coalesce("_likes", nothing).alias("likes_total"),
            F.coalesce("_score", F.lit(0.0)).alias("sentimento_medio"),
        )
        .withColumn(
            "engajamento_medio", ratio_or_zero(F.col("comentarios_novos"), F.col("videos_novos"))
        )
        .orderBy("data")
    )
