"""The four report pages, each a set of small DataFrames over one run's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plateia import defaults, schemas
from plateia.operators import overview, samples
from plateia.sources.runs import read_run

Report = dict[str, DataFrame]


def home(enriched: DataFrame, candidates: DataFrame) -> Report:
    return {
        "kpis": overview.home_kpis(overview.video_totals(enriched), candidates),
        "sentiments": overview.sentiment_share(enriched),
        "top_candidates": overview.top_candidates(candidates),
        "press_channels": overview.press_channel_ranking(enriched),
    }


def sentiments(scored: DataFrame, videos: DataFrame, emotion: str | None = None) -> Report:
    return {
        "share": overview.sentiment_share(scored),
        "by_day": overview.sentiment_by_day(scored),
        "by_hour": overview.sentiment_by_hour(scored),
        "weekly_videos": overview.weekly_top_videos(scored, videos),
        "emotions": overview.emotion_histogram(scored),
        "emotion_names": overview.distinct_values(scored, "emocao"),
        "sample": samples.sample_by_emotion(scored, emotion),
        "sample_size": samples.sample_size(scored, 15, emocao=emotion),
    }


def candidates(
    table: DataFrame,
    timeline: DataFrame,
    enriched: DataFrame,
    candidate: str | None = None,
    sentiment: str | None = None,
    size: int = 10,
) -> Report:
    page = {
        "top": overview.top_candidates(table),
        "timeline_names": overview.distinct_values(timeline, "candidato"),
        "timeline": overview.timeline_of(timeline, "candidato", candidate),
        "table": overview.candidate_table(table),
        "names": overview.distinct_values(enriched, "candidato", defaults.NOT_MENTIONED),
        "sample": samples.sample_by_candidate(enriched, candidate, sentiment, size),
        "sample_size": samples.sample_size(
            enriched, size, candidato=candidate, sentimento=sentiment
        ),
    }
    if candidate is not None:
        page["detail"] = overview.detail(table, "candidato", candidate)
    return page


def channels(enriched: DataFrame, timeline: DataFrame, channel: str | None = None) -> Report:
    summary = overview.channel_summary(overview.video_totals(enriched))
    page = {
        "summary": summary,
        "names": overview.distinct_values(timeline, "tema"),
        "timeline": overview.timeline_of(timeline, "tema", channel),
    }
    if channel is not None:
        page["detail"] = overview.detail(summary, "canal", channel)
    return page


def load_report(spark: SparkSession, root: str, run_id: str, page: str, **choices) -> Report:
    """A page of one run, from the tables that run wrote."""

    def gold(name: str, schema) -> DataFrame:
        return read_run(spark, root, "gold", name, run_id, schema)

    enriched = ("comentarios_gold_enriched", schemas.ENRICHED_COMMENTS)
    table = ("candidatos_manifestacoes", schemas.CANDIDATE_ENGAGEMENT)
    if page == "home":
        return home(gold(*enriched), gold(*table))
    if page == "sentiments":
        return sentiments(
            gold("comments_with_sentiment", schemas.COMMENTS_WITH_SENTIMENT),
            read_run(spark, root, "silver", "videos_silver", run_id, schemas.VIDEOS_SILVER),
            **choices,
        )
    if page == "candidates":
        return candidates(
            gold(*table),
            gold("candidatos_timeline", schemas.CANDIDATE_TIMELINE),
            gold(*enriched),
            **choices,
        )
    if page == "channels":
        return channels(
            gold(*enriched), gold("canais_timeline", schemas.CHANNEL_TIMELINE), **choices
        )
    raise ValueError(f"unknown report page {page!r}")
