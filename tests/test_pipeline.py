import json
from datetime import UTC, datetime

import pytest

from plateia import defaults, schemas
from plateia.plans import reports
from plateia.plans.collection import LandedPages, collect
from plateia.plans.pipeline import run_pipeline
from plateia.sources import runs


def _factory():
    def load():
        def predict(texts):
            return [("5 stars", 0.75) if "bom" in text else ("1 star", 0.5) for text in texts]

        return predict

    return load


def _bronze(spark, empty=False):
    videos = [
        ("Ciro Gomes", "candidato", "UC1", "Ciro", "v1", "Ao  vivo", "2026-09-01T10:00:00Z", "", 1, 2, 3, "public"),
        ("O POVO", "imprensa", "UC2", "O POVO", "v2", "Debate com Elmano", "2026-09-02T10:00:00Z", "d", 1, 2, 3, "public"),
        ("O POVO", "imprensa", "UC2", "O POVO", "v3", "Receita", "2026-09-02T10:00:00Z", "bolo", 1, 2, 3, "public"),
    ]
    comments = [
        (f"c{i}", video, "x", "y", None, "2026-09-03T10:00:00Z", updated, text, 1)
        for i, (video, text, updated) in enumerate([
            ("v1", "muito  bom", "2026-09-03T10:00:00Z"), ("v2", "péssimo", "2026-09-04T10:00:00Z"),
            ("v2", None, "2026-09-03T10:00:00Z"), ("v3", "bom", "2026-09-03T10:00:00Z"),
        ])
    ]
    rows = [] if empty else [v + ("f1", "2026-09-05", i) for i, v in enumerate(videos)]
    rows += [] if empty else [videos[1][:9] + (50, 3, "public", "f2", "2026-09-06", 0)]
    landed = [] if empty else [c + ("f1", "2026-09-05", i) for i, c in enumerate(comments)]
    return (spark.createDataFrame(rows, schemas.BRONZE_VIDEOS),
            spark.createDataFrame(landed, schemas.BRONZE_COMMENTS))


def test_full_run_and_reports(spark, tmp_path):
    root = str(tmp_path)
    when = datetime(2026, 9, 7, tzinfo=UTC)
    tables = run_pipeline(spark, root, "R1", *_bronze(spark), _factory(), processed_at=when)
    manifest = runs.read_manifest(spark, root)
    counts = {(r.layer, r.file): r.row_count for r in manifest.collect()}
    assert counts[("silver", "videos_relevantes")] == 2
    assert counts[("silver", "videos_descartados")] == 1
    assert counts[("silver", "comments_silver")] == 3
    assert counts[("gold", "comentarios_gold_enriched")] == 3
    assert {name for layer, name in counts if layer == "gold"} == {
        *defaults.REQUIRED_GOLD, "serie_temporal_volume"}
    assert runs.latest_run(manifest) == "R1"

    silver = {r.video_id: r for r in tables["videos_silver"].collect()}
    assert silver["v2"].like_count == 50 and silver["v2"].candidatos_mencionados == ["Elmano de Freitas"]
    assert silver["v1"].title_clean == "Ao vivo" and silver["v1"].candidatos_mencionados == []
    scored = {r.comment_id: r for r in tables["comments_with_sentiment"].collect()}
    assert (scored["c0"].sentimento, scored["c0"].emocao, scored["c0"].text_clean) == (
        "POSITIVO", "ENTUSIASMO", "muito bom")
    assert (scored["c1"].emocao, scored["c1"].is_edited) == ("RAIVA", True)
    assert (scored["c2"].sentimento, scored["c2"].text_clean) == ("NEUTRO", "")

    home = reports.load_report(spark, root, "R1", "home")
    assert tuple(home["kpis"].first()) == (1, 3, 2, 1, 3)
    page = reports.load_report(spark, root, "R1", "sentiments", emotion="RAIVA")
    assert [r.comment_id for r in page["sample"].collect()] == ["c1"]
    page = reports.load_report(spark, root, "R1", "candidates", candidate="Elmano de Freitas")
    assert page["detail"].first().comentarios_total == 2
    assert [r.candidato for r in page["names"].collect()] == ["Ciro Gomes", "Elmano de Freitas"]
    page = reports.load_report(spark, root, "R1", "channels", channel="O POVO")
    assert page["detail"].first().comentarios_total == 2
    assert page["timeline"].count() == 1
    for name in ("home", "sentiments", "candidates", "channels"):
        for df in reports.load_report(spark, root, "R1", name).values():
            df.collect()
    with pytest.raises(ValueError):
        reports.load_report(spark, root, "R1", "other")


def test_a_run_without_rows_writes_typed_tables(spark, tmp_path):
    tables = run_pipeline(spark, str(tmp_path), "R0", *_bronze(spark, empty=True), _factory())
    assert {df.count() for df in tables.values()} == {0}
    assert tables["canais_timeline"].columns == schemas.CHANNEL_TIMELINE.names


def test_a_failed_repeat_is_not_complete(spark, tmp_path):
    root = str(tmp_path)
    run_pipeline(spark, root, "R1", *_bronze(spark), _factory())
    assert runs.latest_run(runs.read_manifest(spark, root)) == "R1"

    def broken():
        def predict(texts):
            raise RuntimeError("no model")
        return predict

    with pytest.raises(Exception, match="no model"):
        run_pipeline(spark, root, "R1", *_bronze(spark), broken)
    manifest = runs.read_manifest(spark, root)
    assert runs.complete_runs(manifest).count() == 0
    assert {r.layer for r in manifest.collect()} == {"silver"}


def _pages(folder, **kinds):
    for kind, rows in kinds.items():
        (folder / kind).mkdir()
        text = "\n".join(json.dumps(row, ensure_ascii=False) for row in rows)
        (folder / kind / "pages.json").write_text(text, encoding="utf-8")
    return str(folder)


def test_from_landed_pages_to_gold(spark, tmp_path):
    def comment(name, text):
        return {"id": name, "snippet": {"publishedAt": "2026-09-03T10:00:00Z", "updatedAt": "2026-09-03T10:00:00Z",
                                        "textDisplay": text, "likeCount": 1}}

    def video(name, title):
        return {"id": name, "snippet": {"title": title, "description": ""}, "statistics": {"viewCount": "7"},
                "status": {"privacyStatus": "public"}}

    def listed(name, day):
        return {"contentDetails": {"videoId": name, "videoPublishedAt": f"2026-09-{day}T10:00:00Z"}}

    def thread(name, text):
        return {"snippet": {"topLevelComment": comment(name, text), "totalReplyCount": 0}}

    (tmp_path / "landing").mkdir()
    landing = _pages(
        tmp_path / "landing",
        channels=[{"source": "O POVO", "page": 0, "items": [{"id": "UC2", "snippet": {"title": "O POVO"}}]}],
        playlist=[{"source": "O POVO", "page": 0, "items": [listed("v1", "01"), listed("v2", "02"), listed("late", "28")]}],
        videos=[{"source": "O POVO", "page": 0, "items": [video("v1", "Debate com Elmano"), video("v2", "Debate"), video("late", "Debate")]},
                {"source": "unknown", "page": 0, "items": [video("v9", "Debate")]}],
        threads=[{"video_id": "v1", "page": 0, "items": [thread("c1", "bom"), thread("c2", "ruim")]},
                 {"video_id": "v2", "page": 0, "items": [thread("c3", "bom")]},
                 {"video_id": "gone", "page": 0, "items": [thread("c4", "bom")]}],
        replies=[{"video_id": "v1", "parent_id": "c1", "page": 0, "items": [comment("c1.r", "bom")]}],
        errors=[{"video_id": "v2", "reason": "commentsDisabled"}],
    )
    root, when = str(tmp_path / "root"), datetime(2026, 9, 7, tzinfo=UTC)
    channels = [{"source": "O POVO", "category": "imprensa", "identifier": "UC2"}]
    bronze = collect(spark, root, "R1", LandedPages.read(spark, landing), channels, ("2026-09-01", "2026-09-05"), when)
    assert [df.count() for df in bronze] == [2, 3]
    header = spark.read.json(f"{root}/bronze/videos_header/run_id=R1").first()
    assert (header.row_count, header.rejected_count) == (2, 2)
    header = spark.read.json(f"{root}/bronze/comments_header/run_id=R1").first()
    assert (header.video_count, header.comment_count, header.error_count, header.rejected_count) == (2, 3, 1, 2)
    assert header.source_videos_file == "videos_R1.json"
    ledger = spark.read.json(f"{root}/bronze/comments_status/run_id=R1")
    assert {r.video_id: r.status for r in ledger.collect()} == {"v1": "completed", "v2": "error"}
    tables = run_pipeline(spark, root, "R1", *bronze, _factory(), channels=channels, processed_at=when)
    assert tables["comentarios_gold_enriched"].count() == 3
    assert runs.latest_run(runs.read_manifest(spark, root)) == "R1"


def test_a_run_can_be_repeated(spark, tmp_path):
    root = str(tmp_path)
    for _ in range(2):
        tables = run_pipeline(spark, root, "R1", *_bronze(spark), _factory(), channels=[], terms=[])
    assert tables["videos_silver"].count() == 0
    assert runs.read_manifest(spark, root).count() == 12
