"""Comment totals that can be added and taken back: a cube per day, hour and video.

Every measure is a sum or a count, so the totals after an edit or a deletion are the
totals before, less what the old rows gave, plus what the new ones give. Scores are
added as decimals: the differences are exact in any order, where binary fractions
would leave rests. The reports of all comments follow from the cube alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plateia import defaults
from plateia.functions.numeric import percent, total
from plateia.operators import engagement
from plateia.session import small_tasks
from plateia.sources.parts import LatestState, PartTable

_SCORE = T.DecimalType(38, 12)
KEYS = ["data", "atualizado", "video_id"]
_COUNTS = ["_rows", "_comments", "_likes", "_liked", "_scored", "_felt", *engagement.SENTIMENT_TOTALS]
_SUMS = ["_score", "_emotion"]
SCHEMA = T.StructType(
    [T.StructField("data", T.DateType()), T.StructField("atualizado", T.TimestampType()),
     T.StructField("video_id", T.StringType())]
    + [T.StructField(name, T.LongType()) for name in _COUNTS]
    + [T.StructField(name, _SCORE) for name in _SUMS]
)

NO_DAY = "none"


def day_part() -> Column:
    """The part of a cube row: its day of publication."""
    return F.coalesce(F.date_format("data", "yyyy-MM-dd"), F.lit(NO_DAY))


def _summed() -> list[Column]:
    return [F.sum(name).alias(name) for name in _COUNTS] + [
        F.sum(name).cast(_SCORE).alias(name) for name in _SUMS
    ]


def signed(comments: DataFrame, sign: int) -> DataFrame:
    """A cube row per comment that comes (1) or goes (-1); comments without a time have no day."""

    def times(condition: Column) -> Column:
        return F.when(condition, F.lit(sign)).otherwise(0).cast("bigint")

    def turned(amount: Column) -> Column:
        # A product of decimals would be slower and lose the last digits.
        return amount if sign > 0 else -amount

    scores = {"_score": "score_sentimento", "_emotion": "score_emocao"}
    return comments.select(
        F.to_date("published_at").alias("data"),
        F.date_trunc("hour", "updated_at").alias("atualizado"),
        "video_id",
        F.lit(sign).cast("bigint").alias("_rows"),
        times(F.col("comment_id").isNotNull()).alias("_comments"),
        (F.coalesce("like_count", F.lit(0)) * sign).cast("bigint").alias("_likes"),
        times(F.col("like_count").isNotNull()).alias("_liked"),
        times(F.col("score_sentimento").isNotNull()).alias("_scored"),
        times(F.col("score_emocao").isNotNull()).alias("_felt"),
        *(
            times(F.coalesce(F.col("sentimento") == name, F.lit(False))).alias(f"sentimento_{name.lower()}")
            for name in defaults.SENTIMENTS
        ),
        *(
            turned(F.coalesce(F.col(column).cast(_SCORE), F.lit(0).cast(_SCORE))).alias(name)
            for name, column in scores.items()
        ),
    )


def added(left: DataFrame, right: DataFrame) -> DataFrame:
    """The sum of two cubes, of a cube and changes to it, or of signed comments."""
    return left.unionByName(right).groupBy(*KEYS).agg(*_summed())


def changes(after: DataFrame, before: DataFrame) -> DataFrame:
    """What has to be added to the cube of ``before`` for that of ``after``."""
    differs = F.greatest(*(F.abs(F.col(name)) for name in (*_COUNTS, *_SUMS))) > 0
    return added(signed(after, 1), signed(before, -1)).filter(differs)


class CommentCube:
    """The cube of a state of comments, kept up to date by the days that change.

    A version of the cube has the number of the state's version it stands for. Catching
    up compares the two versions of the state bucket by bucket, so it may run after any
    number of merges, and again after a failure.
    """

    def __init__(self, spark: SparkSession, path: str, state: LatestState):
        self.table, self.state = PartTable(spark, path, SCHEMA), state

    def catch_up(self) -> list[str]:
        """Bring the cube to the state's version; the days it rewrote come back."""
        old, new = self.table.version(), self.state.table.version()
        if old == new:
            return []
        buckets = self.state.table.changed(old, new)
        change = changes(self.state.rows(buckets, new), self.state.rows(buckets, old))
        path = f"{self.table.path}/changes/{new}"
        with small_tasks(self.table.spark):
            change.write.mode("overwrite").parquet(path)
        change = self.table.spark.read.schema(SCHEMA).parquet(path)
        # One row per day comes back.
        touched = sorted(row.part for row in change.select(day_part().alias("part")).distinct().collect())
        merged = added(self.table.read(touched), change).filter("_rows <> 0")
        self.table.commit(new, merged, day_part(), touched)
        return touched

    def rows(self) -> DataFrame:
        return self.table.read()


# --- reports -----------------------------------------------------------------


def _mean(value: str, count: str) -> Column:
    return F.try_divide(F.sum(value).cast("double"), F.sum(count))


def daily_volume(videos: DataFrame, cube: DataFrame) -> DataFrame:
    """As ``engagement.daily_volume`` over the comments of the cube."""
    new_comments = (
        cube.filter("data IS NOT NULL")
        .groupBy("data")
        .agg(F.sum("_comments").alias("_c"), F.sum("_likes").alias("_likes"), _mean("_score", "_scored").alias("_score"))
    )
    return engagement.volume_of_days(videos, new_comments)


def per_video(cube: DataFrame) -> DataFrame:
    """As ``engagement.per_video`` over the comments of the cube."""
    sums = [F.sum(name).alias(name) for name in _COUNTS if name != "_felt"]
    return cube.groupBy("video_id").agg(*sums, F.sum("_score").cast("double").alias("_score"))


def sentiment_by(cube: DataFrame, key: Column, name: str) -> DataFrame:
    """Comments by sentiment and a key of their update time, as ``overview.sentiment_by_day``."""
    plain = [F.sum(column).alias(column.removeprefix("sentimento_")) for column in engagement.SENTIMENT_TOTALS]
    any_sentiment = sum((F.col(column) for column in engagement.SENTIMENT_TOTALS), F.lit(0))
    rows = cube.withColumn(name, key).filter(F.col(name).isNotNull() & (any_sentiment != 0))
    return rows.groupBy(name).agg(*plain).orderBy(name)


def timeline(cube: DataFrame, context: DataFrame, group: str) -> DataFrame:
    """As ``timelines.timeline`` by a column that ``context`` gives each video once."""
    known = cube.join(context.select("video_id", group), "video_id")
    return (
        known.filter(F.col(group).isNotNull() & F.col("data").isNotNull())
        .groupBy(group, "data")
        .agg(
            *(F.sum(name).alias(name) for name in engagement.SENTIMENT_TOTALS),
            F.sum("_comments").alias("total_comentarios"),
            _mean("_score", "_scored").alias("score_sentimento_medio"),
            _mean("_emotion", "_felt").alias("score_emocao_medio"),
            total(F.col("_likes")).alias("likes_total"),
            _mean("_likes", "_liked").alias("likes_media"),
        )
        .withColumns(
            {
                f"sentimento_{side}_pct": percent(F.col(f"sentimento_{side}"), F.col("total_comentarios"))
                for side in ("positivo", "negativo")
            }
        )
        .orderBy(group, "data")
    )
