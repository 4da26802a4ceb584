import json
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from plateia import defaults, schemas
from plateia.operators.latest import keep_latest
from plateia.sources import bronze, runs, settings


def _write(path, content):
    path.write_text(json.dumps(content, ensure_ascii=False, indent=2), encoding="utf-8")
    return str(path)


def _video(video_id, **fields):
    return {"source": "S", "category": "imprensa", "channel_id": "C", "channel_title": "T",
            "video_id": video_id, "title": "t", "published_at": "2026-09-01T00:00:00+00:00",
            "description": "", "view_count": 1, "like_count": 2, "comment_count": 3,
            "privacy_status": "public", **fields}


def test_envelopes_of_several_files(spark, tmp_path):
    _write(tmp_path / "videos_1.json", {"collected_at": "2026-09-01", "videos": [
        _video("a", like_count=1), _video("b"), _video("b", like_count=9)]})
    _write(tmp_path / "videos_2.json", {"collected_at": "2026-09-01", "videos": [_video("a", like_count=5)]})
    _write(tmp_path / "videos_3.json", {"collected_at": "2026-08-01", "videos": [_video("a", like_count=7)]})
    _write(tmp_path / "videos_4.json", {"collected_at": "2026-08-01", "videos": []})
    rows = bronze.read_bronze_videos(spark, f"{tmp_path}/videos_*.json")
    assert rows.columns == schemas.BRONZE_VIDEOS.names[:-3] + ["source_file", "collected_at", "position"]
    assert rows.count() == 5
    latest = {r.video_id: r for r in keep_latest(rows, ["video_id"]).collect()}
    assert (latest["a"].like_count, latest["a"].source_file) == (5, "videos_2.json")
    assert latest["b"].like_count == 9


def test_envelope_shape_is_enforced(spark, tmp_path):
    absent = _write(tmp_path / "absent.json", {"collected_at": "2026-09-01"})
    assert bronze.read_bronze_videos(spark, absent).count() == 0
    with pytest.raises(Exception, match="has no list 'videos'"):
        bronze.read_bronze_videos(spark, absent, required=True).collect()
    wrong = _write(tmp_path / "wrong.json", {"collected_at": "x", "videos": "none"})
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|[Mm]alformed"):
        bronze.read_bronze_videos(spark, wrong).collect()


def test_comment_envelope(spark, tmp_path):
    path = _write(tmp_path / "comments_1.json", {
        "collected_at": "2026-09-02", "video_status": [
            {"video_id": "a", "status": "completed", "comment_count": 2},
            {"video_id": "b", "status": "error", "reason": "commentsDisabled"}],
        "comments": [
            {"comment_id": "c1", "video_id": "a", "source": "S", "category": "imprensa", "parent_id": None,
             "published_at": "2026-09-01T00:00:00Z", "updated_at": "2026-09-01T00:00:00Z", "text": "oi",
             "like_count": 0},
            {"comment_id": "c2", "video_id": "a", "source": "S", "category": "imprensa", "parent_id": "c1",
             "published_at": "2026-09-01T00:00:00Z", "updated_at": "2026-09-01T00:00:00Z", "text": "olá",
             "like_count": 4}]})
    assert [r.parent_id for r in bronze.read_bronze_comments(spark, path).orderBy("position").collect()] == [
        None, "c1"]
    status = bronze.read_video_status(spark, path).orderBy("video_id").collect()
    assert [(r.status, r.comment_count, r.reason) for r in status] == [
        ("completed", 2, None), ("error", None, "commentsDisabled")]


def _channels(spark):
    return spark.createDataFrame(
        [("S", "imprensa", "UC1", "Canal S")],
        "source STRING, category STRING, channel_id STRING, channel_title STRING",
    )


def test_flatten_landed_video_pages(spark, tmp_path):
    pages = _write(tmp_path / "pages.json", {"source": "S", "page": 0, "items": [
        {"id": "a", "snippet": {"title": "A", "description": "d", "publishedAt": "2020-01-01T00:00:00Z"},
         "statistics": {"viewCount": "10", "likeCount": "3"}, "status": {"privacyStatus": "public"}},
        {"id": "b", "snippet": {"title": "B"}, "status": {"privacyStatus": "unlisted"}},
        {"id": "late", "snippet": {"title": "L"}, "status": {"privacyStatus": "public"}}]})
    playlist = _write(tmp_path / "playlist.json", {"source": "S", "page": 0, "items": [
        {"contentDetails": {"videoId": "a", "videoPublishedAt": "2026-09-01T00:00:00Z"}},
        {"contentDetails": {"videoId": "b", "videoPublishedAt": "2026-09-02T23:59:59Z"}},
        {"contentDetails": {"videoId": "late", "videoPublishedAt": "2026-09-03T00:00:00Z"}},
        {"contentDetails": {"videoId": "none"}}]})
    read = lambda schema, path: spark.read.schema(schema).json(path, multiLine=True)
    rows = bronze.flatten_videos(
        read(schemas.VIDEO_PAGE, pages), read(schemas.PLAYLIST_PAGE, playlist), _channels(spark),
        "2026-09-01", "2026-09-02",
    ).orderBy("video_id").collect()
    assert [r.video_id for r in rows] == ["a", "b"]
    a, b = rows
    assert (a.published_at, a.view_count, a.like_count, a.comment_count) == (
        "2026-09-01T00:00:00+00:00", 10, 3, 0)
    assert (b.description, b.view_count, b.privacy_status, b.channel_title) == (
        "", 0, "unlisted", "Canal S")


def test_flatten_landed_comment_pages(spark):
    def comment(name, text, likes=None):
        return (name, ("2026-09-01T00:00:00Z", "2026-09-01T00:00:00Z", text, likes))

    threads = spark.createDataFrame(
        [("a", 0, [((comment("c1", "first"), 1),), ((comment("c2", "x", 5), 0),)]),
         ("a", 1, [((comment("c1", "again"), 1),)]), ("bad", 0, [((comment("c9", "z"), 0),)])],
        schemas.THREAD_PAGE,
    )
    replies = spark.createDataFrame([("a", "c1", 0, [comment("c1.r", "re")])], schemas.REPLY_PAGE)
    videos = spark.createDataFrame(
        [("a", "S", "imprensa"), ("bad", "S", "imprensa"), ("quiet", "S", "imprensa")],
        "video_id STRING, source STRING, category STRING",
    )
    errors = spark.createDataFrame([("bad", "commentsDisabled")], "video_id STRING, reason STRING")
    unique = bronze.unique_comments(threads, replies)
    comments = bronze.flatten_comments(unique, videos, errors)
    rows = {r.comment_id: r for r in comments.collect()}
    assert {name: (r.parent_id, r.text, r.like_count) for name, r in rows.items()} == {
        "c1": (None, "again", 0), "c2": (None, "x", 5), "c1.r": ("c1", "re", 0)}
    status = bronze.collection_status(videos, unique, errors)
    ledger = {r.video_id: (r.status, r.comment_count, r.reason) for r in status.collect()}
    assert tuple(bronze.comment_header(status).first()) == (3, 3, 1)
    assert ledger == {"a": ("completed", 3, None), "bad": ("error", None, "commentsDisabled"),
                      "quiet": ("completed", 0, None)}
    assert bronze.collection_status(videos, comments).filter("status = 'error'").count() == 0


def test_bronze_table_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([tuple(_video("a").values()) + (0,)], "source STRING, category STRING, channel_id STRING, channel_title STRING, video_id STRING, title STRING, published_at STRING, description STRING, view_count LONG, like_count LONG, comment_count LONG, privacy_status STRING, position LONG")
    when = datetime(2026, 9, 19, tzinfo=UTC)
    bronze.write_bronze(rows, str(tmp_path), "videos", "R1", when, ("2026-09-01", "2026-09-20"))
    back = bronze.read_bronze_table(spark, str(tmp_path), "videos", schemas.BRONZE_VIDEOS, "R1").first()
    assert (back.video_id, back.source_file, back.collected_at) == (
        "a", "videos_R1.json", "2026-09-19T00:00:00+00:00")
    header = spark.read.json(f"{tmp_path}/bronze/videos_header/run_id=R1").first()
    assert (header.row_count, header.collection_end) == (1, "2026-09-20T23:59:59.999999+00:00")
    assert bronze.read_bronze_table(spark, str(tmp_path), "videos", schemas.BRONZE_VIDEOS).count() == 1


def test_settings_files(spark, tmp_path):
    path = _write(tmp_path / "channels.json", {"channels": defaults.CHANNELS})
    assert settings.read_channels(spark, path) == defaults.CHANNELS
    path = _write(tmp_path / "terms.json", {"relevance_terms": defaults.RELEVANCE_TERMS})
    assert settings.read_terms(spark, path) == defaults.RELEVANCE_TERMS
    bad = _write(tmp_path / "bad.json", {"other": []})
    with pytest.raises(ValueError, match="relevance_terms"):
        settings.read_terms(spark, bad)


def test_channel_settings_that_cannot_be_read(spark, tmp_path):
    good = _write(tmp_path / "channels.json", {"channels": defaults.CHANNELS})
    assert settings.read_channels_if_any(spark, good) == defaults.CHANNELS
    wrong = _write(tmp_path / "wrong.json", {"channels": "none"})
    for path in (wrong, _write(tmp_path / "other.json", {"a": 1}), str(tmp_path / "absent.json")):
        assert settings.read_channels_if_any(spark, path) == []
    assert settings.channel_table(spark, []).count() == 0


def test_default_terms(spark):
    table = settings.term_table(spark, defaults.RELEVANCE_TERMS)
    assert table.count() == 43
    assert table.select("termo").distinct().count() == 40
    kinds = {r.tipo: r["count"] for r in table.groupBy("tipo").count().collect()}
    assert kinds == {"candidato": 15, "vice": 8, "termo_eleicao": 20}
    assert sum(map(len, defaults.EMOTION_LEXICON.values())) == 53


def test_run_settings_keep_overrides(spark, tmp_path):
    channels = [{"source": "Z", "category": "imprensa", "identifier": "UCz"}]
    used = settings.write_run_settings(spark, str(tmp_path), "R1", channels=channels)
    assert used == (channels, defaults.RELEVANCE_TERMS)
    assert settings.read_channels(spark, f"{tmp_path}/config/channels/run_id=R1") == channels
    assert len(settings.read_terms(spark, f"{tmp_path}/config/relevance_terms/run_id=R1")) == 43
    with pytest.raises(ValueError, match="identifier"):
        settings.write_run_settings(
            spark, str(tmp_path), "R2", channels=[{"source": "Z", "category": "x", "identifier": "z"}])


def test_identifier_kind(column):
    assert column(settings.identifier_kind, ["UCabc", "@name", "name", None]) == ["id", "handle", None, None]


def test_run_tables(spark, tmp_path):
    root = str(tmp_path)
    df = spark.range(3).select(F.col("id").cast("string").alias("v"))
    schema = df.schema
    assert runs.write_run(df, root, "gold", "t", "R1", schema).count() == 3
    runs.write_run(df.limit(0), root, "gold", "t", "R2", schema)
    runs.write_run(df.limit(1), root, "gold", "t", "R1", schema)  # a repeated run replaces itself
    assert runs.read_run(spark, root, "gold", "t", "R1", schema).count() == 1
    assert runs.read_run(spark, root, "gold", "t", "R2", schema).count() == 0
    with pytest.raises(FileNotFoundError):
        runs.read_run(spark, root, "gold", "t", "R3", schema)
    counts = {r.run_id: (r.tables, r.row_count)
              for r in runs.run_counts(runs.read_manifest(spark, root)).collect()}
    assert counts == {"R1": (1, 1), "R2": (1, 0)}
    with pytest.raises(FileNotFoundError):
        runs.latest_run(runs.read_manifest(spark, root))


def test_complete_runs(spark):
    rows = [("gold", run, name, 1) for run in ("R1", "R2", "R3") for name in defaults.REQUIRED_GOLD]
    rows += [("silver", "R1", "videos_silver", 1), ("silver", "R2", "videos_silver", 1)]
    rows.remove(("gold", "R2", "canais_timeline", 1))
    manifest = spark.createDataFrame(rows, "layer STRING, run_id STRING, file STRING, row_count LONG")
    assert [r.run_id for r in runs.complete_runs(manifest).collect()] == ["R1"]
    assert runs.latest_run(manifest) == "R1"


def test_lenient_times(spark):
    df = spark.sql("SELECT '2026-09-01T00:00:00Z' AS published_at, 'soon' AS updated_at, 1 AS n")
    row = runs.with_lenient_times(df).first()
    assert row.published_at is not None and row.updated_at is None
