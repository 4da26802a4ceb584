"""Landed JSON: collection envelopes, and raw API pages flattened to bronze rows.

Envelopes hold a whole collection in one JSON object, so one file is one task:
they are read for compatibility. Bronze tables are written as JSON lines, which
split, with the header of the collection in a row of its own.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plateia import schemas
from plateia.functions.times import in_window, iso_utc, to_utc, window_bounds
from plateia.operators.latest import keep_latest

Paths = str | list[str]


# --- envelopes ---------------------------------------------------------------


def read_envelopes(spark: SparkSession, paths: Paths, schema: T.StructType) -> DataFrame:
    """Envelopes of any number of files or globs; text of another shape fails the job."""
    return (
        spark.read.schema(schema)
        .json(paths, multiLine=True, mode="FAILFAST")
        .select(*schema.names, F.col("_metadata.file_name").alias("source_file"))
    )


def envelope_rows(envelopes: DataFrame, field: str, required: bool = False) -> DataFrame:
    """The records under ``field`` with their file, collection time and position.

    An absent list gives no rows, or fails the job when it is ``required``.
    """
    records = F.col(field)
    if required:
        records = F.coalesce(
            records,
            F.raise_error(F.concat("source_file", F.lit(f" has no list '{field}'"))).cast(
                envelopes.schema[field].dataType
            ),
        )
    landed = envelopes.select(
        "source_file", "collected_at", F.posexplode(records).alias("position", "_record")
    )
    return landed.select(
        "_record.*", "source_file", "collected_at", F.col("position").cast("bigint")
    )


def read_bronze_videos(spark: SparkSession, paths: Paths, required: bool = False) -> DataFrame:
    return envelope_rows(
        read_envelopes(spark, paths, schemas.VIDEO_ENVELOPE), "videos", required
    )


def read_bronze_comments(spark: SparkSession, paths: Paths) -> DataFrame:
    return envelope_rows(read_envelopes(spark, paths, schemas.COMMENT_ENVELOPE), "comments")


def read_pages(spark: SparkSession, paths: Paths, schema: T.StructType) -> DataFrame:
    """Landed API pages, one JSON object a line, of any number of files or globs."""
    return spark.read.schema(schema).json(paths, mode="FAILFAST")


def read_video_status(spark: SparkSession, paths: Paths) -> DataFrame:
    return envelope_rows(read_envelopes(spark, paths, schemas.COMMENT_ENVELOPE), "video_status")


# --- API pages ---------------------------------------------------------------


def _items(pages: DataFrame, *keys: str) -> DataFrame:
    """One row per item, with a position that grows by page and then by place."""
    placed = pages.select(*keys, "page", F.posexplode("items").alias("_place", "item"))
    position = F.shiftleft(F.col("page"), 32) + F.col("_place")
    return placed.select(*keys, position.alias("position"), "item")


def _count(value: Column) -> Column:
    return F.coalesce(value.cast("bigint"), F.lit(0).cast("bigint"))


def _known_rows(
    rows: DataFrame, known: DataFrame, keys: list[str], landed: Observation | None
) -> DataFrame:
    """The rows that ``known`` has, with its columns; ``landed`` observes how many there were.

    Rows are counted above an outer join. Below an inner one, adaptive planning
    drops rows and count alike as soon as it sees that nothing is known.
    """
    if landed is None:
        return rows.join(known, keys)
    outer = rows.join(known.withColumn("_known", F.lit(True)), keys, "left")
    return outer.observe(landed, F.count(F.lit(1)).alias("landed")).filter("_known").drop("_known")


def resolved_channels(pages: DataFrame, channels: DataFrame) -> DataFrame:
    """Configured channels with the id and title that their landed channel page names.

    Channels without a page keep neither and collect no videos.
    """
    found = _items(pages, "source").groupBy("source").agg(F.min_by("item", "position").alias("item"))
    return channels.join(found, "source").select(
        "source",
        "category",
        F.col("item.id").alias("channel_id"),
        F.col("item.snippet.title").alias("channel_title"),
    )


def playlist_videos(playlist: DataFrame, start: str | datetime, end: str | datetime) -> DataFrame:
    """Published videos of each source inside the inclusive window, once per video.

    Items without a publication time are outside every window.
    """
    listed = _items(playlist, "source").select(
        "source",
        "position",
        F.col("item.contentDetails.videoId").alias("video_id"),
        to_utc(F.col("item.contentDetails.videoPublishedAt")).alias("published_at"),
    )
    return keep_latest(
        listed.filter(in_window(F.col("published_at"), start, end)),
        ["source", "video_id"],
        ["position"],
    ).drop("position")


def flatten_videos(
    pages: DataFrame,
    playlist: DataFrame,
    channels: DataFrame,
    start: str | datetime,
    end: str | datetime,
    landed: Observation | None = None,
) -> DataFrame:
    """Bronze rows of landed video pages, once per video of a source: the last that landed.

    Items of unknown sources or outside the window give no row; ``landed``
    observes how many videos there were, and so how many were left out.

    ``channels`` gives each source its category, channel id and title. The
    publication time is the playlist's; absent counts are 0, an absent
    description is ''.
    """
    keys = ["source", "video_id"]
    items = _items(pages, "source").withColumn("video_id", F.col("item.id"))
    known = playlist_videos(playlist, start, end).join(
        channels.select("source", "category", "channel_id", "channel_title"), "source"
    )
    return (
        _known_rows(keep_latest(items, keys, ["position"]), known, keys, landed)
        .select(
            "source",
            "category",
            "channel_id",
            "channel_title",
            "video_id",
            F.col("item.snippet.title").alias("title"),
            iso_utc(F.col("published_at")).alias("published_at"),
            F.coalesce("item.snippet.description", F.lit("")).alias("description"),
            _count(F.col("item.statistics.viewCount")).alias("view_count"),
            _count(F.col("item.statistics.likeCount")).alias("like_count"),
            _count(F.col("item.statistics.commentCount")).alias("comment_count"),
            F.col("item.status.privacyStatus").alias("privacy_status"),
            "position",
        )
    )


def _comment(api: str) -> list[Column]:
    return [
        F.col(f"{api}.id").alias("comment_id"),
        F.col(f"{api}.snippet.publishedAt").alias("published_at"),
        F.col(f"{api}.snippet.updatedAt").alias("updated_at"),
        F.col(f"{api}.snippet.textDisplay").alias("text"),
        _count(F.col(f"{api}.snippet.likeCount")).alias("like_count"),
    ]


def unique_comments(threads: DataFrame, replies: DataFrame) -> DataFrame:
    """Each comment of a video once, from landed thread and reply pages.

    Top-level comments have no parent. Reply text is kept as landed and may hold
    markup.
    """
    top_level = _items(threads, "video_id").select(
        "video_id",
        F.lit(None).cast("string").alias("parent_id"),
        "position",
        *_comment("item.snippet.topLevelComment"),
    )
    answers = _items(replies, "video_id", "parent_id").select(
        "video_id", "parent_id", "position", *_comment("item")
    )
    return keep_latest(top_level.unionByName(answers), ["video_id", "comment_id"], ["position"])


def flatten_comments(
    unique: DataFrame,
    videos: DataFrame,
    errors: DataFrame | None = None,
    landed: Observation | None = None,
) -> DataFrame:
    """Bronze rows of ``unique_comments``, with the source and category of their video.

    Videos in ``errors`` contribute nothing, however many pages had landed. What
    is known of a video is put together first, so comments meet it in one join on
    ``video_id`` alone, whose large side adaptive planning can split. Comments of
    other videos give no row; ``landed`` observes how many comments there were.
    """
    known = videos.select("video_id", "source", "category")
    if errors is not None:
        known = known.join(errors.select("video_id"), "video_id", "left_anti")
    return _known_rows(unique, known, ["video_id"], landed).select(
        "comment_id",
        "video_id",
        "source",
        "category",
        "parent_id",
        "published_at",
        "updated_at",
        "text",
        "like_count",
        "position",
    )


def collection_status(
    videos: DataFrame, comments: DataFrame, errors: DataFrame | None = None
) -> DataFrame:
    """Ledger of a collection: completed with a comment count, or error with a reason.

    ``comments`` are ``unique_comments`` before any join, so a hot video is
    counted with map-side combination.
    """
    counts = comments.groupBy("video_id").agg(F.count(F.lit(1)).alias("_comments"))
    ledger = videos.select("video_id").join(counts, "video_id", "left")
    if errors is None:
        ledger = ledger.withColumn("reason", F.lit(None).cast("string"))
    else:
        ledger = ledger.join(errors.select("video_id", "reason"), "video_id", "left")
    failed = F.col("reason").isNotNull()
    return ledger.select(
        "video_id",
        F.when(failed, "error").otherwise("completed").alias("status"),
        F.when(~failed, F.coalesce("_comments", F.lit(0).cast("bigint"))).alias("comment_count"),
        "reason",
    )


def comment_header(ledger: DataFrame) -> DataFrame:
    """Counts of a comment collection: videos, comments, and videos that failed."""
    return ledger.agg(
        F.count(F.lit(1)).alias("video_count"),
        F.coalesce(F.sum("comment_count"), F.lit(0)).cast("bigint").alias("comment_count"),
        F.count_if(F.col("status") == "error").alias("error_count"),
    )


# --- bronze tables -----------------------------------------------------------


def write_bronze(
    rows: DataFrame,
    root: str,
    name: str,
    run_id: str,
    collected_at: datetime,
    window: tuple[str | datetime, str | datetime],
    landed: Observation | None = None,
    **header: str | int | None,
) -> str:
    """Write bronze rows as JSON lines, and then their header.

    The rows are counted while they are written. With ``landed``, observed on the
    same query, the header also has the ``rejected_count`` of rows left out.
    """
    start, end = window_bounds(*window)
    path = f"{root}/bronze/{name}/run_id={run_id}"
    stamped = rows.withColumn("source_file", F.lit(f"{name}_{run_id}.json")).withColumn(
        "collected_at", F.lit(collected_at.isoformat())
    )
    written = Observation()
    stamped.observe(written, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").json(path)
    fields = {
        "collected_at": collected_at.isoformat(),
        "collection_start": start.isoformat(),
        "collection_end": end.isoformat(),
        "row_count": written.get["rows"],
        **header,
    }
    if landed is not None:
        fields["rejected_count"] = landed.get["landed"] - fields["row_count"]
    write_header(rows.sparkSession, root, name, run_id, fields)
    return path


def write_header(
    spark: SparkSession, root: str, name: str, run_id: str, fields: dict[str, str | int | None]
) -> None:
    values = {key: value for key, value in fields.items() if value is not None}
    spark.range(1, numPartitions=1).select(
        *(F.lit(value).alias(key) for key, value in values.items())
    ).write.mode("overwrite").json(f"{root}/bronze/{name}_header/run_id={run_id}")


def read_bronze_table(
    spark: SparkSession, root: str, name: str, schema: T.StructType, run_id: str | None = None
) -> DataFrame:
    """Bronze rows of one run, or of every run."""
    path = f"{root}/bronze/{name}" + (f"/run_id={run_id}" if run_id else "")
    return spark.read.schema(schema).json(path, mode="FAILFAST").select(*schema.names)
