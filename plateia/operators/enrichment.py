"""Comments with the context of their video."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plateia import defaults

_CONTEXT = ["channel_title", "source", "category", "candidatos_mencionados"]


def one_row_per_video(videos: DataFrame) -> DataFrame:
    """The videos unchanged; the job fails if a ``video_id`` repeats.

    The check is a scalar subquery, so it needs no separate job and leaves the
    video side a plain shuffle input: adaptive planning can still split the
    partitions of a video with very many comments.
    """
    most = videos.groupBy("video_id").count().select(F.max("count")).scalar()
    single = F.when(F.coalesce(most, F.lit(1)) == 1, F.lit(True)).otherwise(
        F.raise_error(F.lit("a video_id repeats on the video side of a join")).cast("boolean")
    )
    return videos.filter(single)


def candidate_of(attribute_mentions: bool = True) -> Column:
    """Whom a comment is about.

    Comments on a candidate's channel belong to its source. Others go to the
    first candidate the video mentions; with ``attribute_mentions`` off, to none.
    """
    first = F.get("candidatos_mencionados", F.lit(0)) if attribute_mentions else F.lit(None)
    return F.when(F.col("category") == defaults.CANDIDATE_CATEGORY, F.col("source")).otherwise(
        F.coalesce(first, F.lit(defaults.NOT_MENTIONED))
    )


def enrich_comments(
    comments: DataFrame,
    videos: DataFrame,
    attribute_mentions: bool = True,
    check_repeats: bool = True,
) -> DataFrame:
    """Every comment with its video's channel, category and mentions, and a candidate.

    The check for repeated videos evaluates ``videos`` a second time. Leave it out
    where that is a plan of its own that ends in ``keep_latest`` by ``video_id``.
    """
    context = videos.select("video_id", *_CONTEXT)
    if check_repeats:
        context = one_row_per_video(context)
    own = comments.drop("source", "category")
    return (
        own.join(context, "video_id", "left")
        .select(*own.columns, *_CONTEXT)
        .withColumn("candidato", candidate_of(attribute_mentions))
    )
