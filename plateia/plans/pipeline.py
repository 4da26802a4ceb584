"""One full run: bronze rows to silver and gold tables."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plateia import schemas
from plateia.operators.engagement import candidate_engagement, channel_engagement, daily_volume
from plateia.operators.enrichment import enrich_comments
from plateia.operators.latest import keep_latest
from plateia.operators.relevance import is_relevant, mark_relevance
from plateia.operators.scoring import PredictorFactory, score_comments
from plateia.operators.silver import silver_comments, silver_videos
from plateia.operators.timelines import candidate_timeline, channel_timeline
from plateia.session import bound_batches, pin_utc
from plateia.sources.runs import record, withdraw_run, write_run
from plateia.sources.settings import Entries, channel_table, write_run_settings

_SELECTION = T.StructType(
    schemas.SELECTED_VIDEOS.fields + [T.StructField("selecao", T.StringType())]
)


def select_videos(
    videos: DataFrame, terms: Entries, channels: DataFrame, root: str, run_id: str
) -> DataFrame:
    """Judge the latest snapshot of every video; relevant and discarded land in one pass."""
    marked = mark_relevance(keep_latest(videos, ["video_id"]), terms, channels)
    selection = write_run(
        marked.withColumn("selecao", F.when(is_relevant(), "relevantes").otherwise("descartados")),
        root,
        "silver",
        "videos_selecao",
        run_id,
        _SELECTION,
        partition_by=["selecao"],
    )
    for part in ("relevantes", "descartados"):
        rows = selection.filter(F.col("selecao") == part).count()
        record(videos.sparkSession, root, "silver", f"videos_{part}", run_id, rows)
    return selection.filter("selecao = 'relevantes'").drop("selecao")


def run_pipeline(
    spark: SparkSession,
    root: str,
    run_id: str,
    videos: DataFrame,
    comments: DataFrame,
    factory: PredictorFactory,
    channels: Entries | None = None,
    terms: Entries | None = None,
    processed_at: datetime | None = None,
    model_tasks: int | None = None,
) -> dict[str, DataFrame]:
    """Run every stage on bronze rows and return the written tables.

    Each stage reads what the stage before wrote, so a lost executor or a
    failed stage repeats that stage alone, and scoring runs once although
    three gold branches use it.
    """
    pin_utc(spark)
    bound_batches(spark)
    withdraw_run(spark, root, run_id)
    processed_at = processed_at or datetime.now(UTC)
    channels, terms = write_run_settings(spark, root, run_id, channels, terms)
    tables: dict[str, DataFrame] = {}

    def write(layer: str, name: str, df: DataFrame, schema: T.StructType) -> DataFrame:
        tables[name] = write_run(df, root, layer, name, run_id, schema)
        return tables[name]

    selected = select_videos(videos, terms, channel_table(spark, channels), root, run_id)
    silver_v = write(
        "silver", "videos_silver", silver_videos(selected, terms, processed_at), schemas.VIDEOS_SILVER
    )
    silver_c = write(
        "silver",
        "comments_silver",
        silver_comments(comments, silver_v, processed_at),
        schemas.COMMENTS_SILVER,
    )
    scored = write(
        "gold",
        "comments_with_sentiment",
        score_comments(silver_c, factory, tasks=model_tasks, once=True),
        schemas.COMMENTS_WITH_SENTIMENT,
    )
    write("gold", "serie_temporal_volume", daily_volume(silver_v, scored), schemas.DAILY_VOLUME)
    write(
        "gold",
        "candidatos_manifestacoes",
        candidate_engagement(silver_v, scored),
        schemas.CANDIDATE_ENGAGEMENT,
    )
    write(
        "gold", "temas_engajamento", channel_engagement(silver_v, scored), schemas.CHANNEL_ENGAGEMENT
    )
    enriched = write(
        "gold",
        "comentarios_gold_enriched",
        enrich_comments(scored, silver_v),
        schemas.ENRICHED_COMMENTS,
    )
    write("gold", "candidatos_timeline", candidate_timeline(enriched), schemas.CANDIDATE_TIMELINE)
    write("gold", "canais_timeline", channel_timeline(enriched), schemas.CHANNEL_TIMELINE)
    return tables
