"""Report aggregates over scored or enriched comments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plateia import defaults
from plateia.functions.numeric import ratio_or_zero, total
from plateia.operators.engagement import SENTIMENT_TOTALS, measures, per_video

_CHANNEL = ["channel_title", "category"]


def _press(enriched: DataFrame) -> DataFrame:
    return enriched.filter(
        (F.col("category") == defaults.PRESS_CATEGORY) & F.col("channel_title").isNotNull()
    )


def _plain_counts() -> list[Column]:
    return [
        F.count_if(F.col("sentimento") == name).alias(name.lower())
        for name in defaults.SENTIMENTS
    ]


def sentiment_summary(comments: DataFrame) -> DataFrame:
    """One row: comments per sentiment."""
    return comments.agg(*_plain_counts())


def sentiment_share(comments: DataFrame) -> DataFrame:
    """One row: comments per sentiment and their percent of all three, 0 without comments."""
    names = [name.lower() for name in defaults.SENTIMENTS]
    everything = sum((F.col(name) for name in names[1:]), F.col(names[0]))
    return sentiment_summary(comments).withColumns(
        {f"{name}_pct": ratio_or_zero(F.col(name), everything) * 100 for name in names}
    )


def video_totals(enriched: DataFrame) -> DataFrame:
    """Comment measures per video, with its channel, of a written table of enriched comments."""
    return enriched.groupBy("video_id", *_CHANNEL).agg(*measures())


def joined_totals(comments: DataFrame, videos: DataFrame) -> DataFrame:
    """The same of comments not yet enriched: reduced first, so the join meets no hot video."""
    return per_video(comments).join(videos.select("video_id", *_CHANNEL), "video_id", "left")


def home_kpis(totals: DataFrame, candidates: DataFrame) -> DataFrame:
    """One row: candidates, comments, distinct videos, distinct press channels, likes.

    ``totals`` has one row per video, so the two distinct counts double no comments.
    """
    press_title = F.when(F.col("category") == defaults.PRESS_CATEGORY, F.col("channel_title"))
    return totals.agg(
        total(F.col("_rows")).alias("comentarios"),
        F.count_distinct("video_id").alias("videos"),
        F.count_distinct(press_title).alias("canais_midia"),
        total(F.col("_likes")).alias("likes_total"),
    ).select(candidates.select(F.count(F.lit(1))).scalar().alias("candidatos"), "*")


def press_channel_ranking(enriched: DataFrame) -> DataFrame:
    """Comment rows and likes per press channel, most commented first."""
    return (
        _press(enriched)
        .groupBy("channel_title")
        .agg(
            F.count("video_id").alias("comentarios_total"),
            total(F.col("like_count")).alias("likes_total"),
        )
        .orderBy(F.desc("comentarios_total"), "channel_title")
    )


def channel_summary(totals: DataFrame) -> DataFrame:
    """Videos, comments, likes and sentiment counts per press channel."""
    return (
        _press(totals)
        .groupBy(F.col("channel_title").alias("canal"))
        .agg(
            F.count_distinct("video_id").alias("videos_total"),
            total(F.col("_comments")).alias("comentarios_total"),
            total(F.col("_likes")).alias("likes_total"),
            *(total(F.col(name)).alias(name) for name in SENTIMENT_TOTALS),
        )
        .orderBy(F.desc("comentarios_total"), "canal")
    )


def _sentiment_pivot(comments: DataFrame, key: Column, name: str) -> DataFrame:
    # The pivot values are fixed, so the pivot is one aggregate of conditional counts.
    return (
        comments.select(key.alias(name), "sentimento")
        .filter(F.col(name).isNotNull() & F.col("sentimento").isNotNull())
        .groupBy(name)
        .agg(*_plain_counts())
        .orderBy(name)
    )


def sentiment_by_day(comments: DataFrame, when: str = "updated_at") -> DataFrame:
    return _sentiment_pivot(comments, F.to_date(when), "data")


def sentiment_by_hour(comments: DataFrame, when: str = "updated_at") -> DataFrame:
    return _sentiment_pivot(comments, F.hour(when).cast("bigint"), "hora")


def emotion_histogram(comments: DataFrame) -> DataFrame:
    return (
        comments.filter("emocao IS NOT NULL")
        .groupBy("emocao")
        .agg(F.count(F.lit(1)).alias("comentarios"))
        .orderBy(F.desc("comentarios"), "emocao")
    )


def distinct_values(df: DataFrame, column: str, exclude: str | None = None) -> DataFrame:
    """Sorted distinct values of a column, for a filter list."""
    values = df.select(column).filter(F.col(column).isNotNull())
    if exclude is not None:
        values = values.filter(F.col(column) != exclude)
    return values.distinct().orderBy(column)


def comments_per_video_week(comments: DataFrame, videos: DataFrame) -> DataFrame:
    """Comments per title and week (from Monday) of the video's publication."""
    counts = comments.groupBy("video_id").agg(F.count(F.lit(1)).alias("_comments"))
    return (
        videos.select(
            "video_id", "title_clean", F.to_date(F.date_trunc("week", "published_at")).alias("semana")
        )
        .filter("semana IS NOT NULL AND title_clean IS NOT NULL")
        .join(counts, "video_id")
        .groupBy("semana", "title_clean")
        .agg(F.sum("_comments").alias("comentarios"))
    )


def weekly_top_videos(comments: DataFrame, videos: DataFrame, top: int = 5) -> DataFrame:
    """Most commented titles of the latest week; ties by title, least commented last.

    Ordering by week first makes the latest week lead the top rows, so one pass
    finds both the week and its titles; the window sees only those few rows.
    """
    leading = (
        comments_per_video_week(comments, videos)
        .orderBy(F.desc("semana"), F.desc("comentarios"), "title_clean")
        .limit(top)
    )
    latest = F.max("semana").over(Window.partitionBy())
    return (
        leading.withColumn("_latest", latest)
        .filter("semana = _latest")
        .drop("_latest")
        .orderBy("comentarios", F.desc("title_clean"))
    )


def top_candidates(candidates: DataFrame, top: int = 5) -> DataFrame:
    return (
        candidates.select(
            "candidato",
            "comentarios_total",
            "score_sentimento_medio",
            "sentimento_positivo",
            "sentimento_negativo",
            "sentimento_neutro",
        )
        .orderBy(F.desc("comentarios_total"), "candidato")
        .limit(top)
    )


def candidate_table(candidates: DataFrame) -> DataFrame:
    return candidates.select(
        "candidato", "videos_total", "comentarios_total", "score_sentimento_medio"
    ).orderBy(F.desc("comentarios_total"), "candidato")


def timeline_of(timeline: DataFrame, group: str, value: str | None = None) -> DataFrame:
    """A timeline in day order, of one group or of all."""
    chosen = timeline if value is None else timeline.filter(F.col(group) == value)
    return chosen.orderBy(group, "data")


def detail(table: DataFrame, key: str, value: str) -> DataFrame:
    """The metrics of one candidate or channel."""
    return table.filter(F.col(key) == value)
