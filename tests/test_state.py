"""State across collections against one computation over everything."""

import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plateia.catalog.views import COLLECTED
from plateia.operators import cube, engagement, overview, timelines
from plateia.operators.latest import keep_latest
from plateia.sources.parts import LatestState, PartTable

SMALL = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("v", T.LongType()), T.StructField("gone", T.BooleanType()),
    T.StructField("collected_at", T.StringType()), T.StructField("source_file", T.StringType()),
    T.StructField("position", T.LongType()),
])
PLAIN = T.StructType([T.StructField("p", T.StringType()), T.StructField("v", T.IntegerType())])


def _rows(spark, rows, schema=SMALL):
    return spark.createDataFrame(rows, schema)


def _files(path):
    return {p: (p.stat().st_mtime_ns, p.stat().st_size) for p in Path(path).rglob("*.parquet")}


def _sorted(df):
    return sorted(map(repr, map(tuple, df.collect())))


@pytest.fixture
def state(spark, tmp_path):
    return LatestState(spark, f"{tmp_path}/latest", SMALL, ["id"], buckets=8, deleted="gone")


def test_three_collections_equal_one_computation(spark, state):
    rng = random.Random(1)
    collections = [
        [(f"k{rng.randint(0, 60)}", rng.randint(0, 9), rng.random() < 0.2, f"2026-01-0{day}", "f", i) for i in range(150)]
        for day in (2, 1, 3)
    ]
    for rows in collections:
        state.merge(_rows(spark, rows))
    everything = keep_latest(_rows(spark, sum(collections, [])), ["id"])
    assert _sorted(state.table.read()) == _sorted(everything)
    assert _sorted(state.rows()) == _sorted(everything.filter("NOT gone"))
    before = _sorted(state.rows())
    state.merge(_rows(spark, collections[1]))
    assert _sorted(state.rows()) == before


def test_only_touched_buckets_are_rewritten(spark, state, tmp_path):
    state.merge(_rows(spark, [(f"k{i}", i, False, "2026-01-01", "f", i) for i in range(200)]))
    first = _files(tmp_path)
    assert len(state.table.index()) == 8
    state.merge(_rows(spark, [("k7", 700, False, "2026-01-02", "f", 0)]))
    after = _files(tmp_path)
    assert first.items() <= after.items()
    assert len(state.table.changed(1, 2)) == 1
    assert {r.id: r.v for r in state.rows().collect()} == {f"k{i}": 700 if i == 7 else i for i in range(200)}
    assert state.rows(version=1).filter("v = 700").count() == 0


def test_a_deletion_outlives_an_older_record(spark, state):
    state.merge(_rows(spark, [("a", 1, False, "2026-01-01", "f", 0)]))
    state.merge(_rows(spark, [("a", 1, True, "2026-01-03", "f", 0)]))
    state.merge(_rows(spark, [("a", 2, False, "2026-01-02", "f", 0)]))
    assert state.rows().count() == 0
    assert state.merge(_rows(spark, [])) == 3


def test_a_reader_between_two_commits_sees_the_old_table_whole(spark, tmp_path):
    table = PartTable(spark, str(tmp_path), PLAIN)
    table.commit(1, spark.createDataFrame([("a", 1), ("b", 1)], "p STRING, v INT"), F.col("p"), ["a", "b"])
    old = table.read()
    # A second version whose commit failed: data are written, the marker is not.
    spark.createDataFrame([("a", 2)], "p STRING, v INT").withColumn("part", F.col("p")).write.partitionBy("part").parquet(
        f"{tmp_path}/data/2")
    spark.createDataFrame([("a", 2)], "part STRING, version INT").write.json(f"{tmp_path}/commits/2")
    (tmp_path / "commits/2/_SUCCESS").unlink()
    assert table.version() == 1 and _sorted(table.read()) == _sorted(old) == ["('a', 1)", "('b', 1)"]
    table.commit(2, spark.createDataFrame([], "p STRING, v INT"), F.col("p"), ["b"])
    assert _sorted(table.read()) == ["('a', 1)"] and len(old.collect()) == 2
    with pytest.raises(ValueError, match="committed"):
        table.commit(2, old, F.col("p"), ["a"])


def _comments(rng, day, count, deleted=False):
    rows = []
    for i in range(count):
        when = datetime(2026, 1, 1) + timedelta(hours=rng.randint(0, 80))
        feeling = rng.choice(["POSITIVO", "NEGATIVO", "NEUTRO", None])
        rows.append((
            f"c{rng.randint(0, 90)}", f"v{rng.randint(0, 6)}", rng.choice([when, when, None]),
            rng.choice([when + timedelta(hours=1), None]), rng.choice([None, 0, 5]), feeling,
            rng.choice([None, 0.1, -0.2, 0.7]), rng.choice([None, 0.3]), deleted, f"2026-02-0{day}", "f", i,
        ))
    return rows


def test_cube_equals_recomputation_after_edits_and_deletions(spark, tmp_path):
    rng = random.Random(5)
    state = LatestState(spark, f"{tmp_path}/latest", COLLECTED, ["comment_id"], buckets=4, deleted="deleted")
    totals = cube.CommentCube(spark, f"{tmp_path}/cube", state)
    videos = spark.createDataFrame(
        [(f"v{i}", datetime(2026, 1, 1 + i % 3), 10 * i, f"T{i % 2}", ["Ana"] if i % 2 else ["Ana", "Bia"]) for i in range(8)],
        "video_id STRING, published_at TIMESTAMP, like_count BIGINT, channel_title STRING, candidatos_mencionados ARRAY<STRING>",
    )
    state.merge(_rows(spark, _comments(rng, 1, 120), COLLECTED))
    totals.catch_up()
    # Two merges before the cube catches up, as after a failure between the two.
    state.merge(_rows(spark, _comments(rng, 2, 40), COLLECTED))
    state.merge(_rows(spark, _comments(rng, 3, 15, deleted=True), COLLECTED))
    totals.catch_up()
    assert totals.catch_up() == []
    now, summed = state.rows().cache(), totals.rows().cache()
    nothing = cube.changes(now, spark.createDataFrame([], COLLECTED))
    assert _sorted(summed) == _sorted(nothing)

    def same(ours, theirs, *means):
        rounded = [df.withColumns({m: F.round(m, 9) for m in means}).select(*theirs.columns) for df in (ours, theirs)]
        assert _sorted(rounded[0]) == _sorted(rounded[1])

    same(cube.daily_volume(videos, summed), engagement.daily_volume(videos, now), "sentimento_medio")
    same(engagement.candidates_of(videos, cube.per_video(summed)), engagement.candidate_engagement(videos, now),
         "score_sentimento_medio")
    same(engagement.channels_of(videos, cube.per_video(summed)), engagement.channel_engagement(videos, now),
         "score_sentimento_medio", "likes_media")
    same(cube.sentiment_by(summed, F.to_date("atualizado"), "data"), overview.sentiment_by_day(now))
    same(cube.sentiment_by(summed, F.hour("atualizado").cast("bigint"), "hora"), overview.sentiment_by_hour(now))
    context = videos.select("video_id", F.col("channel_title").alias("tema"))
    same(cube.timeline(summed, context, "tema"), timelines.timeline(now.join(context, "video_id"), "tema"),
         "score_sentimento_medio", "score_emocao_medio", "likes_media")


def test_only_days_that_change_are_rewritten(spark, tmp_path):
    state = LatestState(spark, f"{tmp_path}/latest", COLLECTED, ["comment_id"], buckets=4, deleted="deleted")
    totals = cube.CommentCube(spark, f"{tmp_path}/cube", state)

    def row(name, day, likes, collected):
        when = datetime(2026, 1, day)
        return (name, "v1", when, when, likes, "NEUTRO", 0.1, None, False, collected, "f", 0)

    state.merge(_rows(spark, [row("a", 1, 1, "2026-02-01"), row("b", 2, 1, "2026-02-01"), row("c", 3, 1, "2026-02-01")], COLLECTED))
    assert totals.catch_up() == ["2026-01-01", "2026-01-02", "2026-01-03"]
    files = _files(tmp_path / "cube/data")
    state.merge(_rows(spark, [row("b", 2, 8, "2026-02-02"), row("c", 3, 1, "2026-02-02")], COLLECTED))
    assert totals.catch_up() == ["2026-01-02"]
    assert files.items() <= _files(tmp_path / "cube/data").items()
    assert {str(r.data): r._likes for r in totals.rows().collect()} == {"2026-01-01": 1, "2026-01-02": 8, "2026-01-03": 1}


def test_small_differences_of_scores_are_taken_back_whole(spark):
    when = datetime(2026, 1, 1)
    rows = [("c", "v", when, when, 1, "POSITIVO", 0.123456789012, None, False, "2026-02-01", "f", 0)]
    comments = _rows(spark, rows, COLLECTED)
    gone = cube.changes(comments.limit(0), comments).first()
    assert str(gone._score) == "-0.123456789012" and gone._rows == -1
    assert cube.changes(comments, comments).count() == 0


def test_changes_are_added_up_once(spark, tmp_path):
    _rows(spark, _comments(random.Random(2), 1, 50), COLLECTED).write.parquet(str(tmp_path / "rows"))
    rows = spark.read.schema(COLLECTED).parquet(str(tmp_path / "rows"))
    plan = cube.changes(rows, rows)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 1


def test_tasks_of_a_commit_stay_small(spark, tmp_path):
    """A commit splits its rows by 8 MB, whatever the session says, and leaves the session as it was."""
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    table = PartTable(spark, str(tmp_path), PLAIN)
    rows = spark.range(0, 4_000_000, 1, 8).select(F.lit("a").alias("p"), (F.xxhash64("id") % 1_000_000_007).cast("int").alias("v"))
    table.commit(1, rows, F.col("p"), ["a"])
    assert len(_files(tmp_path)) > 1 and table.read().count() == 4_000_000
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == before
