"""From landed API pages to the bronze tables of a run."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession

from plateia import schemas
from plateia.session import pin_utc
from plateia.sources import bronze
from plateia.sources.settings import Entries, channel_table

Window = tuple[str | datetime, str | datetime]


@dataclass(frozen=True)
class LandedPages:
    """Pages of one collection, as they landed, and the videos whose comments failed."""

    channels: DataFrame
    playlist: DataFrame
    videos: DataFrame
    threads: DataFrame
    replies: DataFrame
    errors: DataFrame

    @staticmethod
    def read(spark: SparkSession, folder: str) -> LandedPages:
        """JSON lines in one folder per kind of page."""
        kinds = {
            "channels": schemas.CHANNEL_PAGE,
            "playlist": schemas.PLAYLIST_PAGE,
            "videos": schemas.VIDEO_PAGE,
            "threads": schemas.THREAD_PAGE,
            "replies": schemas.REPLY_PAGE,
            "errors": schemas.COLLECTION_ERROR,
        }
        return LandedPages(
            **{name: bronze.read_pages(spark, f"{folder}/{name}", kind) for name, kind in kinds.items()}
        )


def collect_videos(
    spark: SparkSession,
    root: str,
    run_id: str,
    pages: LandedPages,
    channels: Entries,
    window: Window,
    collected_at: datetime,
) -> DataFrame:
    """Write and return the bronze videos; items of other sources or times are counted."""
    landed = Observation()
    resolved = bronze.resolved_channels(pages.channels, channel_table(spark, channels))
    rows = bronze.flatten_videos(pages.videos, pages.playlist, resolved, *window, landed=landed)
    bronze.write_bronze(rows, root, "videos", run_id, collected_at, window, landed)
    return bronze.read_bronze_table(spark, root, "videos", schemas.BRONZE_VIDEOS, run_id)


def collect_comments(
    spark: SparkSession,
    root: str,
    run_id: str,
    pages: LandedPages,
    videos: DataFrame,
    window: Window,
    collected_at: datetime,
) -> DataFrame:
    """Write and return the bronze comments of the collected videos, with their ledger.

    The ledger has a row per video: completed with its comments, or its error. The
    header names the videos file and sums up the ledger.
    """
    landed = Observation()
    unique = bronze.unique_comments(pages.threads, pages.replies)
    rows = bronze.flatten_comments(unique, videos, pages.errors, landed)
    source = f"videos_{run_id}.json"
    bronze.write_bronze(rows, root, "comments", run_id, collected_at, window, landed)
    comments = bronze.read_bronze_table(spark, root, "comments", schemas.BRONZE_COMMENTS, run_id)

    path = f"{root}/bronze/comments_status/run_id={run_id}"
    bronze.collection_status(videos, comments, pages.errors).write.mode("overwrite").json(path)
    ledger = spark.read.schema(schemas.VIDEO_STATUS).json(path)
    counts = bronze.comment_header(ledger).first().asDict()
    header = spark.read.json(f"{root}/bronze/comments_header/run_id={run_id}").drop("run_id").first().asDict()
    bronze.write_header(
        spark, root, "comments", run_id, {**header, "source_videos_file": source, **counts}
    )
    return comments


def collect(
    spark: SparkSession,
    root: str,
    run_id: str,
    pages: LandedPages,
    channels: Entries,
    window: Window,
    collected_at: datetime,
) -> tuple[DataFrame, DataFrame]:
    """Bronze videos and comments of a run, ready for ``run_pipeline``."""
    pin_utc(spark)
    videos = collect_videos(spark, root, run_id, pages, channels, window, collected_at)
    return videos, collect_comments(spark, root, run_id, pages, videos, window, collected_at)
