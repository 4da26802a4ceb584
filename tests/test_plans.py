"""Plan shapes the scale behaviour depends on."""

import hashlib
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plateia.catalog import views
from plateia.catalog.entries import QUERIES
from plateia.operators import overview, relevance, silver
from plateia.operators.enrichment import enrich_comments
from plateia.operators.latest import keep_latest
from plateia.sources import bronze

FOLDER = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def conf(spark):
    before = {}

    def set_all(**values):
        for key, value in values.items():
            before[key] = spark.conf.get(key, None)
            spark.conf.set(key, value)

    yield lambda values: set_all(**values)
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("name", ["channel_engagement", "daily_volume", "channel_summary"])
def test_queries_without_text_read_none(spark, name):
    df = QUERIES[name](spark, FOLDER)
    plan = _plan(df)
    assert "text:string" not in plan
    assert "EvalPython" not in plan


def test_channel_settings_join_shuffles_nothing(spark):
    raw = views.raw_videos(spark, FOLDER).select("video_id", "source")
    plan = _plan(relevance.with_source_category(raw, views.channels(spark)))
    assert "BroadcastHashJoin" in plan and "LocalTableScan" in plan and "hashpartitioning" not in plan


def test_relevance_folds_texts_once(spark):
    marked = views.marked_videos(spark, FOLDER)
    assert _plan(relevance.relevant(marked)).count("ArrowEvalPython") == 1
    assert _plan(relevance.discarded(marked)).count("ArrowEvalPython") == 1


def test_latest_per_key_combines_before_the_shuffle(spark):
    plan = _plan(QUERIES["dedupe_latest_per_user_event"](spark, FOLDER))
    assert "partial_max_by" in plan and "Window" not in plan


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_text_functions_run_once_per_input(spark, name):
    """No function of texts is evaluated again below a filter or in a second copy of its input."""
    plan = _plan(QUERIES[name](spark, FOLDER))
    nodes = re.findall(r"EvalPython \[(.*?)\], \[", plan)
    calls = [re.sub(r"#\d+L?", "", call) for node in nodes for call in node.split("), ")]
    assert len(calls) == len(set(calls)), calls
    # Nor does the JVM fold or search a text: one function returns what was found.
    assert "lower(concat_ws" not in plan
    assert len(re.findall(r"concat_ws\( , coalesce\(title", plan)) <= 1


SMALL_SKEW = {
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


def _hot(spark):
    """60,000 comments, of which one video has a third."""
    ids = spark.range(0, 60_000, 1, 16)
    video = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 997)
    return ids.select(
        F.concat(F.lit("c"), "id").alias("comment_id"), F.concat(F.lit("v"), video).alias("video_id"),
        F.lit(1).cast("bigint").alias("like_count"), F.lit("POSITIVO").alias("sentimento"),
        F.lit(0.5).alias("score_sentimento"),
    )


def _videos(spark):
    return spark.range(997).select(
        F.concat(F.lit("v"), "id").alias("video_id"), F.lit("T").alias("channel_title"),
        F.lit("S").alias("source"), F.lit("imprensa").alias("category"),
    )


def test_a_hot_video_is_split_when_comments_are_flattened(spark, conf):
    conf(SMALL_SKEW)
    landed = _hot(spark).withColumns({
        "position": F.lit(0).cast("bigint"), "parent_id": F.lit(None).cast("string"),
        "published_at": F.lit(""), "updated_at": F.lit(""), "text": F.col("comment_id"),
    })
    unique = keep_latest(landed, ["video_id", "comment_id"], ["position"])
    flat = bronze.flatten_comments(unique, _videos(spark), _videos(spark).limit(0))
    assert len(flat.collect()) == 60_000
    assert "skew=true" in _plan(flat)
    counts = bronze.collection_status(_videos(spark), unique)
    assert max(r.comment_count for r in counts.collect()) >= 20_000
    assert "partial_count" in _plan(counts)


def test_a_hot_video_is_reduced_before_the_report_joins(spark):
    totals = overview.joined_totals(_hot(spark), _videos(spark))
    assert overview.channel_summary(totals).first().comentarios_total == 60_000
    plan = totals._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("Aggregate [video_id")


def test_top_rows_need_no_global_sort(spark):
    assert "TakeOrderedAndProject" in _plan(QUERIES["sample_by_candidate"](spark, FOLDER))


def test_a_hot_video_is_split_in_the_enriching_join(spark, conf):
    conf({
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    })
    rows = spark.range(0, 60_000, 1, 16)
    video = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 997)
    comments = rows.select(
        F.concat(F.lit("c"), "id").alias("comment_id"), F.concat(F.lit("v"), video).alias("video_id")
    )
    videos = spark.range(997).select(
        F.concat(F.lit("v"), "id").alias("video_id"), F.lit("T").alias("channel_title"),
        F.lit("S").alias("source"), F.lit("imprensa").alias("category"),
        F.array(F.lit("Ana")).alias("candidatos_mencionados"),
    )
    enriched = enrich_comments(comments, videos)
    assert len(enriched.collect()) == 60_000
    assert "skew=true" in _plan(enriched)


@pytest.mark.parametrize("name", ["silver_comments", "channel_engagement_from_bronze"])
def test_no_comment_takes_its_text_through_the_shuffle_by_key(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    latest = next(line for line in plan.splitlines() if "Aggregate [comment_id" in line)
    assert "text_id" in latest and not re.search(r"\btext(_clean)?#", latest)


def test_no_comment_takes_its_text_through_the_shuffle_by_video(spark):
    """Whole texts are scored and digested below the enriching join, and only digests cross it."""
    plan = QUERIES["enriched_comments"](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    comments = lines[next(i for i, line in enumerate(lines) if "Join LeftOuter, (video_id" in line) + 1]
    assert re.search(r"md5\(.*?\) AS text_clean#", comments)
    assert not re.search(r"(?<!AS )\btext_clean#\d+(?=[,\]])", comments)


def test_digests_taken_before_enriching_are_those_taken_after(spark):
    before = QUERIES["enriched_comments"](spark, FOLDER)
    whole = enrich_comments(views.scored(spark, FOLDER), views.videos(spark, FOLDER))
    texts = {r.comment_id: r.text_clean for r in whole.select("comment_id", "text_clean").collect()}
    digests = {r.comment_id: r.text_clean for r in before.select("comment_id", "text_clean").collect()}
    assert max(map(len, texts.values())) > 1000 and "" in texts.values()
    assert digests == {name: hashlib.md5(text.encode()).hexdigest() for name, text in texts.items()}


def test_the_latest_snapshots_shuffle_texts_by_video_once(spark, conf):
    conf({"spark.sql.autoBroadcastJoinThreshold": "-1"})
    plan = _plan(keep_latest(views.video_snapshots(spark, FOLDER), ["video_id"]))
    assert len(re.findall(r"Exchange hashpartitioning\(video_id#", plan)) == 1
    assert len(re.findall(r"FileScan parquet \[[^\]]*text#", plan)) == 1


def test_snapshots_of_repeated_and_unlabelled_documents(spark, tmp_path):
    docs = [(n, f"t{n}\nx", "en", "src1", 97 + i) for i, n in enumerate([0, 1, 1, 2, 3, None])]
    spark.createDataFrame(docs, "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    labels = [(1, 1, 0), (1, 0, 0), (2, None, 0), (3, 0, 1), (9, 1, 0), (None, 1, 0)]
    spark.createDataFrame(labels, "doc_id BIGINT, quality INT, toxic INT").write.parquet(f"{tmp_path}/labels.parquet")
    rows = views.video_snapshots(spark, str(tmp_path)).collect()
    first, second = "2024-02-01T00:00:00+00:00", "2024-02-02T00:00:00+00:00"
    one, two = "videos_1.json", "videos_2.json"
    expected = [("v0", 0, one, first), ("v1", 1, one, first), ("v1", 2, one, first), ("v2", 3, one, first), ("v3", 4, one, first)]
    expected += [("v1", 1001, two, second), ("v1", 1001, two, first), ("v1", 1002, two, second), ("v1", 1002, two, first)]
    expected += [("v2", 1003, two, first), ("v3", 1004, two, first), (None, 5, one, first)]
    found = [(r.video_id, r.like_count, r.source_file, r.collected_at) for r in rows]
    assert sorted(map(str, found)) == sorted(map(str, expected))
    assert all(r.description == f"t{r.position}\nx" and r.title == f"t{r.position}" for r in rows if r.video_id)


def test_texts_named_by_id_give_what_texts_in_the_rows_give(spark):
    rows = [
        ("c1", "v", 0, "2026-01-01", "f", 0), ("c1", "v", 1, "2026-01-02", "f", 0), ("c2", "v", None, "2026-01-01", "f", 1),
        ("c3", "v", 1, "2026-01-01", "f", 2), ("c4", "v", 9, "2026-01-01", "f", 3), ("c5", "w", 0, "2026-01-01", "f", 4),
    ]
    named = spark.createDataFrame(
        rows, "comment_id STRING, video_id STRING, text_id BIGINT, collected_at STRING, source_file STRING, position BIGINT"
    ).withColumns({
        "source": F.lit("s"), "category": F.lit("imprensa"), "parent_id": F.lit(None).cast("string"),
        "published_at": F.lit("2026-01-01T00:00:00Z"), "updated_at": F.lit("2026-01-01T00:00:00Z"),
        "like_count": F.lit(1).cast("bigint"),
    })
    texts = spark.createDataFrame([(0, " a\n b "), (1, "é"), (2, None)], "text_id BIGINT, text STRING")
    videos = spark.createDataFrame([("v",)], "video_id STRING")
    apart = silver.silver_comments(named, videos, views.PROCESSED_AT, texts=texts)
    inside = silver.silver_comments(named.join(texts, "text_id", "left"), videos, views.PROCESSED_AT)
    assert apart.schema.simpleString() == inside.schema.simpleString()
    assert sorted(map(repr, apart.collect())) == sorted(map(repr, inside.collect()))
    assert {r.comment_id: r.text_clean for r in apart.collect()} == {"c1": "é", "c2": "", "c3": "é", "c4": ""}


@pytest.mark.parametrize("owned, most", [("10000", 512), ("0", 512), ("100", 100)])
def test_workers_get_small_batches_of_texts(spark, conf, owned, most):
    conf({"spark.sql.execution.arrow.maxRecordsPerBatch": owned, "spark.sql.execution.arrow.maxBytesPerBatch": "64m"})
    views.documents(spark, FOLDER)

    def rows(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["rows"])

    seen = [r.rows for r in spark.range(0, 2000, 1, 1).mapInArrow(rows, "rows BIGINT").collect()]
    assert max(seen) == most and sum(seen) == 2000
    if owned != "100":
        long = spark.range(0, 500, 1, 1).select(F.repeat(F.lit("x"), 100_000))
        assert len(long.mapInArrow(rows, "rows BIGINT").collect()) > 10
