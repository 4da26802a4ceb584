import random

import pytest
from pyspark.sql import functions as F

from plateia import defaults
from plateia.operators import engagement, enrichment, overview, relevance, samples, scoring, timelines
from plateia.operators.latest import keep_latest
from plateia.sources.settings import channel_table


def test_keep_latest_against_brute_force(spark):
    rng = random.Random(5)
    rows = [
        (rng.choice("aab") if rng.random() < 0.5 else f"k{rng.randint(0, 40)}",
         rng.choice([None, "2026-01-01", "2026-01-02"]), rng.choice(["f1", "f2"]), place, rng.random())
        for place in range(2000)
    ]
    df = spark.createDataFrame(
        rows, "id STRING, collected_at STRING, source_file STRING, position LONG, v DOUBLE"
    ).repartition(8)
    best = {}
    for row in sorted(rows, key=lambda r: (r[1] or "", r[2], r[3])):
        best[row[0]] = row
    assert sorted(map(tuple, keep_latest(df, ["id"]).collect())) == sorted(best.values())


CHANNELS = [
    {"source": "Cand", "category": "imprensa", "identifier": "@x"},
    {"source": "Cand", "category": "candidato", "identifier": "@x"},
    {"source": "Press", "category": "imprensa", "identifier": "UC1"},
]


def _videos(spark, rows):
    return spark.createDataFrame(rows, "video_id STRING, source STRING, title STRING, description STRING")


def test_relevance_with_default_terms(spark):
    videos = _videos(
        spark,
        [
            ("1", "Press", "Debate no Ceará", None),
            ("2", "Cand", "sem termo", ""),
            ("3", "Press", "receita de bolo", "nada"),
            ("4", "Other", None, "COMITÊ do Ciro Gomes e Elmano"),
        ],
    )
    marked = relevance.mark_relevance(videos, defaults.RELEVANCE_TERMS, channel_table(spark, CHANNELS))
    terms = {row.video_id: row.matched_terms for row in marked.collect()}
    assert terms == {
        "1": ["debate"],
        "2": ["[todos_vídeos_candidato]"],
        "3": [],
        "4": ["ciro gomes", "ciro", "elmano", "comite", "comite"],
    }
    assert {r.video_id for r in relevance.discarded(marked).collect()} == {"3"}
    assert tuple(relevance.selection_summary(marked).first()) == (4, 3, 1)
    named = marked.select(
        "video_id",
        relevance.mentioned_candidates(F.col("matched_terms"), defaults.RELEVANCE_TERMS).alias("m"),
    )
    mentions = {row.video_id: row.m for row in named.collect()}
    assert mentions == {"1": [], "2": [], "3": [], "4": ["Ciro Gomes", "Elmano de Freitas"]}


def test_relevance_without_bypass_or_terms(spark):
    videos = _videos(spark, [("2", "Cand", "sem termo", "")])
    channels = channel_table(spark, CHANNELS)
    marked = relevance.mark_relevance(videos, defaults.RELEVANCE_TERMS, channels, bypass=())
    assert marked.first().matched_terms == []
    assert relevance.mark_relevance(videos, [], channels, bypass=()).first().matched_terms == []


def _score(spark, text, label, confidence=0.9):
    df = spark.createDataFrame(
        [("c", text, label, confidence)],
        "comment_id STRING, text_clean STRING, label STRING, confidence DOUBLE",
    )
    return scoring.score_comments(df).first()


def test_lexicon_hits(spark):
    row = _score(spark, "excelente, melhor, espero", "5 stars")
    assert (row.emocao, row.score_emocao) == ("ENTUSIASMO", 1.0)
    assert (row.score_entusiasmo, row.score_esperanca, row.score_sentimento) == (1.0, 0.5, 0.9)


def test_hits_of_the_other_polarity_do_not_count(spark):
    row = _score(spark, "ótimo, show", "1 star")
    assert (row.emocao, row.score_raiva, row.score_tristeza, row.score_decepcao) == (
        "RAIVA", 0.5, 0.3, 0.2,
    )
    assert row.score_sentimento == -0.9


def test_ties_follow_the_emotion_order(spark):
    row = _score(spark, "raiva e infeliz", "1 star")
    assert (row.emocao, row.score_raiva, row.score_tristeza) == ("RAIVA", 1.0, 1.0)


@pytest.mark.parametrize(
    "label, emocao, score",
    [("5 stars", "ENTUSIASMO", 0.8), ("4 stars", "ESPERANCA", 0.7), ("2 stars", "DECEPCAO", 0.5),
     ("1 star", "RAIVA", 0.5), ("3 stars", "NEUTRO", 1.0)],
)
def test_fallback(spark, label, emocao, score):
    row = _score(spark, "xyz", label)
    assert (row.emocao, row.score_emocao) == (emocao, score)


@pytest.mark.parametrize("text", [None, "", "   "])
def test_blank_text_is_neutral(spark, text):
    row = _score(spark, text, "1 star")
    assert (row.sentimento, row.emocao, row.score_sentimento, row.score_neutro) == (
        "NEUTRO", "NEUTRO", 0.0, 1.0,
    )


def test_predictor_sees_batches_of_written_texts_only(spark):
    def factory():
        def predict(texts):
            assert 0 < len(texts) <= 32 and all(text.strip() for text in texts)
            return [("5 stars" if text.startswith("+") else "1 star", 0.5) for text in texts]

        return predict

    rows = [(f"c{i}", None if i % 7 == 0 else "  " if i % 7 == 1 else ("+" if i % 2 else "-") + str(i))
            for i in range(500)]
    df = spark.createDataFrame(rows, "comment_id STRING, text_clean STRING")
    for tasks in (None, 3):
        scored = {r.comment_id: r for r in scoring.score_comments(df, factory, tasks=tasks).collect()}
        assert len(scored) == 500
        for name, text in rows:
            expected = "NEUTRO" if not (text or "").strip() else (
                "POSITIVO" if text.startswith("+") else "NEGATIVO")
            assert scored[name].sentimento == expected


def test_predictor_must_answer_every_text(spark):
    df = spark.createDataFrame([("c", "x")], "comment_id STRING, text_clean STRING")
    with pytest.raises(Exception, match="shorter"):
        scoring.score_comments(df, lambda: lambda texts: []).collect()


def test_scoring_needs_text(spark):
    with pytest.raises(ValueError, match="text_clean"):
        scoring.score_comments(spark.range(1))


def _silver(spark):
    videos = spark.sql("""
        SELECT * FROM VALUES
          ('v1', 'Canal A', 'Ana', 'candidato', array(), 5L, TIMESTAMP '2026-09-01 10:00:00', 't1'),
          ('v2', 'Canal B', 'Jornal', 'imprensa', array('Ana', 'Bia'), 7L, TIMESTAMP '2026-09-02 10:00:00', 't2'),
          ('v3', 'Canal B', 'Jornal', 'imprensa', array(), 1L, TIMESTAMP '2026-09-08 10:00:00', 't3'),
          ('v4', 'Canal C', 'Rádio', 'imprensa', array('Bia'), 0L, TIMESTAMP '2026-09-09 10:00:00', 't4')
        AS t(video_id, channel_title, source, category, candidatos_mencionados, like_count,
             published_at, title_clean)""")
    comments = spark.sql("""
        SELECT * FROM VALUES
          ('c1', 'v1', 'POSITIVO', 0.5D, 1.0D, 1L, TIMESTAMP '2026-09-02 23:59:59', 'ENTUSIASMO'),
          ('c2', 'v2', 'NEGATIVO', -1.0D, 0.5D, 2L, TIMESTAMP '2026-09-03 01:00:00', 'RAIVA'),
          ('c3', 'v2', 'NEUTRO', 0.0D, 1.0D, 4L, TIMESTAMP '2026-09-03 02:00:00', 'NEUTRO'),
          ('c4', 'v3', 'POSITIVO', 1.0D, 1.0D, NULL, TIMESTAMP '2026-09-10 02:00:00', 'ESPERANCA'),
          ('c5', 'vX', 'POSITIVO', 1.0D, 1.0D, 9L, TIMESTAMP '2026-09-10 02:00:00', 'ESPERANCA')
        AS t(comment_id, video_id, sentimento, score_sentimento, score_emocao, like_count,
             published_at, emocao)""").withColumns(
        {"source": F.lit("x"), "category": F.lit("y"), "text_clean": F.lit("mail a@b.co"),
         "updated_at": F.col("published_at")})
    return videos, comments


def test_enrichment_keeps_every_comment(spark):
    videos, comments = _silver(spark)
    rows = {r.comment_id: r for r in enrichment.enrich_comments(comments, videos).collect()}
    assert {name: row.candidato for name, row in rows.items()} == {
        "c1": "Ana", "c2": "Ana", "c3": "Ana", "c4": "Não Mencionado", "c5": "Não Mencionado",
    }
    assert rows["c5"].category is None and rows["c2"].source == "Jornal"
    plain = enrichment.enrich_comments(comments, videos, attribute_mentions=False)
    assert plain.filter("candidato = 'Não Mencionado'").count() == 4


def test_repeated_video_fails_the_enrichment(spark):
    videos, comments = _silver(spark)
    with pytest.raises(Exception, match="video_id repeats"):
        enrichment.enrich_comments(comments, videos.union(videos)).collect()
    empty = enrichment.enrich_comments(comments, videos.limit(0))
    assert empty.count() == 5


def test_candidate_engagement(spark):
    videos, comments = _silver(spark)
    rows = engagement.candidate_engagement(videos, comments).collect()
    assert [r.candidato for r in rows] == ["Ana", "Bia"]
    ana, bia = rows
    assert (ana.videos_total, ana.likes_videos_total, ana.comentarios_total) == (1, 7, 2)
    assert (bia.videos_total, bia.likes_videos_total, bia.likes_comentarios_total) == (2, 7, 6)
    assert (bia.score_sentimento_medio, bia.sentimento_negativo_pct) == (-0.5, 50.0)


def test_channel_engagement_counts_channels_without_comments(spark):
    videos, comments = _silver(spark)
    rows = {r.tema: r for r in engagement.channel_engagement(videos, comments).collect()}
    assert (rows["Canal B"].videos_total, rows["Canal B"].comentarios_total) == (2, 3)
    assert rows["Canal B"].likes_media == 3.0  # the missing like count is not a zero
    c = rows["Canal C"]
    assert (c.videos_total, c.comentarios_total, c.likes_media, c.sentimento_neutro_pct) == (1, 0, 0.0, 0.0)


def test_daily_volume_covers_days_of_either_side(spark):
    videos, comments = _silver(spark)
    rows = {str(r.data): r for r in engagement.daily_volume(videos, comments).collect()}
    assert list(rows) == ["2026-09-01", "2026-09-02", "2026-09-03", "2026-09-08", "2026-09-09", "2026-09-10"]
    assert rows["2026-09-03"].engajamento_medio == 0.0
    assert (rows["2026-09-02"].videos_novos, rows["2026-09-02"].engajamento_medio) == (1, 1.0)
    assert (rows["2026-09-01"].comentarios_novos, rows["2026-09-01"].sentimento_medio) == (0, 0.0)


def test_timelines_total_their_filter(spark):
    videos, comments = _silver(spark)
    enriched = enrichment.enrich_comments(comments, videos)
    press = timelines.channel_timeline(enriched).collect()
    assert sum(r.total_comentarios for r in press) == enriched.filter("category = 'imprensa'").count()
    assert [(r.tema, str(r.data)) for r in press] == [("Canal B", "2026-09-03"), ("Canal B", "2026-09-10")]
    assert timelines.candidate_timeline(enriched).first().candidato == "Ana"


def test_weekly_top_videos_uses_the_latest_commented_week(spark):
    videos, comments = _silver(spark)
    rows = overview.weekly_top_videos(comments, videos).collect()
    assert [(str(r.semana), r.title_clean, r.comentarios) for r in rows] == [("2026-09-07", "t3", 1)]


def test_reports_on_nothing(spark):
    videos, comments = _silver(spark)
    none = comments.limit(0)
    assert tuple(overview.sentiment_share(none).first()) == (0, 0, 0, 0.0, 0.0, 0.0)
    enriched = enrichment.enrich_comments(none, videos)
    table = engagement.candidate_engagement(videos.limit(0), none)
    assert tuple(overview.home_kpis(overview.video_totals(enriched), table).first()) == (0, 0, 0, 0, 0)
    assert overview.weekly_top_videos(none, videos).count() == 0


def test_samples(spark):
    videos, comments = _silver(spark)
    enriched = enrichment.enrich_comments(comments, videos)
    first = samples.sample_by_emotion(enriched, size=2).collect()
    assert [r.comment_id for r in first] == ["c1", "c2"]
    assert first[0].text_anonimizado == "mail [EMAIL]"
    chosen = samples.sample_by_candidate(enriched, "Ana", size=5)
    again = samples.sample_by_candidate(enriched.repartition(5), "Ana", size=5)
    assert [r.comment_id for r in chosen.collect()] == [r.comment_id for r in again.collect()]
    assert chosen.count() == 3
    assert tuple(samples.sample_size(enriched, 2, candidato="Ana").first()) == (3, 2)
    with pytest.raises(ValueError):
        samples.sample_by_candidate(enriched, size=101)
