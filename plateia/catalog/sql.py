"""DuckDB statements that state each registered query independently."""

from __future__ import annotations

from plateia import defaults
from plateia.catalog import views
from plateia.functions.text import fold

_SPACES = (
    r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values: list[str]) -> str:
    return "[" + ", ".join(_text(value) for value in values) + "]"


def _clean(column: str) -> str:
    return (
        f"trim(regexp_replace(nfc_normalize(coalesce({column}, '')), '{_SPACES}+', ' ', 'g'))"
    )


def _fold(column: str) -> str:
    return f"replace(strip_accents(lower({column})), 'ß', 'ss')"


def _emotion_fold(column: str) -> str:
    return (
        f"translate(lower({column}), '{defaults.EMOTION_ACCENTED}', '{defaults.EMOTION_PLAIN}')"
    )


def _even(value: str) -> str:
    return f"round_even(({value}) * 100, 0) / 100"


def _percent(part: str, whole: str) -> str:
    return _even(f"{part}::DOUBLE / {whole} * 100")


def _masked(column: str, strict: bool) -> str:
    digit, area = r"\p{Nd}", rf"\(\p{{Nd}}{{2}}\){_SPACES}*\p{{Nd}}{{4,5}}-\p{{Nd}}{{4}}"
    rules = [
        ("https?://[!$-_a-z]+", "[URL]"),
        (r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}", "[EMAIL]"),
        ("@[a-zA-Z0-9_]+", "[MENÇÃO]"),
    ]
    if strict:
        rules += [
            (area, "[TELEFONE]"),
            (rf"{digit}{{2}}{_SPACES}*{digit}{{4,5}}-{digit}{{4}}", "[TELEFONE]"),
            (rf"{digit}{{3}}\.{digit}{{3}}\.{digit}{{3}}-{digit}{{2}}", "[CPF]"),
        ]
    else:
        rules.append(
            (rf"\(?(?:{digit}{{2}})?{_SPACES}?9?{digit}{{4}}-?{digit}{{4}}", "[TELEFONE]")
        )
    masked = f"coalesce({column}, '')"
    for pattern, tag in rules:
        masked = f"regexp_replace({masked}, '{pattern}', '{tag}', 'g')"
    return masked


def _hits(column: str, words: list[str]) -> str:
    if not words:
        return "0::BIGINT"
    return "(" + " + ".join(f"contains({column}, {_text(w)})::BIGINT" for w in words) + ")"


# --- shared views ------------------------------------------------------------

_CATEGORY = "CASE WHEN substr(source, 4)::INT % 4 = 0 THEN 'candidato' ELSE 'imprensa' END"
_CONFIGURED = "CASE WHEN source = 'src19' THEN 'desconhecido' ELSE category END"
_NEEDLES = _list([fold(term["term"]) for term in views.TERMS])
_LABEL = (
    "CASE t "
    + " ".join(
        f"WHEN {_text(fold(term['term']))} THEN {_text(term['label'])}"
        for term in views.TERMS
        if term["type"] in ("candidato", "vice")
    )
    + " END"
)

_VIDEOS = f"""
fx_docs AS (
  SELECT *, TIMESTAMP '2024-01-01 00:00:00' + to_hours((doc_id % 720)::INT) AS hour
  FROM documents
), fx_raw AS (
  SELECT source, {_CATEGORY} AS category, 'ch_' || source AS channel_id,
    upper(source) AS channel_title, 'v' || doc_id AS video_id,
    split_part(text, chr(10), 1) AS title, hour AS published_at, text AS description,
    n_chars * 3 AS view_count, n_chars % 97 AS like_count, n_chars % 11 AS comment_count,
    'public' AS privacy_status, 'videos_1.json' AS source_file,
    '2024-02-01T00:00:00+00:00' AS collected_at, doc_id AS position
  FROM fx_docs
), fx_snapshots AS (
  SELECT * FROM fx_raw
  UNION ALL
  SELECT r.* REPLACE (like_count + 1000 AS like_count, 'videos_2.json' AS source_file,
    CASE WHEN l.quality = 1 THEN '2024-02-02T00:00:00+00:00' ELSE collected_at END AS collected_at)
  FROM fx_raw r JOIN labels l ON r.video_id = 'v' || l.doc_id
), fx_latest AS (
  SELECT * FROM fx_snapshots
  QUALIFY row_number() OVER (PARTITION BY video_id
    ORDER BY collected_at DESC, source_file DESC, position DESC) = 1
)"""


def _marked(name: str, source: str, bypass: bool = True) -> str:
    matched = f"list_filter({_NEEDLES}, lambda t: contains(folded, t))"
    if bypass:
        matched = (
            f"CASE WHEN config_category = 'candidato' "
            f"THEN [{_text(defaults.BYPASS_MARKER)}] ELSE {matched} END"
        )
    return f"""{name} AS (
  SELECT * EXCLUDE (folded, config_category), {matched} AS matched_terms
  FROM (SELECT *, {_CONFIGURED} AS config_category,
      {_fold("title || ' ' || description")} AS folded FROM {source})
)"""


def _silver(name: str, source: str, condition: str = "true") -> str:
    return f"""{name} AS (
  SELECT video_id, channel_id, channel_title, source, category, {_clean("title")} AS title_clean,
    {_clean("description")} AS description_clean, published_at, view_count, like_count,
    comment_count, privacy_status,
    list_sort(list_distinct(list_filter(list_transform(matched_terms, lambda t: {_LABEL}),
      lambda x: x IS NOT NULL))) AS candidatos_mencionados,
    source_file, TIMESTAMP '2024-03-01 00:00:00' AS processed_at
  FROM {source} WHERE {condition}
)"""


_SILVER = f"""{_VIDEOS}, {_marked("fx_marked", "fx_raw")}, {_silver("fx_videos", "fx_marked")},
{_marked("fx_judged", "fx_latest")},
{_silver("fx_relevant", "fx_judged", "len(matched_terms) > 0")}"""

_COMMENTS = f"""
fx_events AS (
  SELECT event_id, 'c' || event_id AS comment_id, 'v' || user_id AS video_id,
    'src' || (user_id % 20) AS source, 'imprensa' AS category,
    CASE WHEN event_id % 3 = 0 AND event_id > 0 THEN 'c' || (event_id - 1) END AS parent_id,
    ts AS published_at,
    CASE WHEN event_id % 5 = 0 THEN ts + INTERVAL 1 DAY ELSE ts END AS updated_at,
    floor(value)::BIGINT AS like_count,
    CASE WHEN value >= 1 THEN CASE event_type WHEN 'purchase' THEN 5 WHEN 'click' THEN 4
      WHEN 'view' THEN 3 WHEN 'signup' THEN 2 ELSE 1 END ELSE 3 END AS stars,
    value >= 1 AS written,
    CASE WHEN value >= 1 THEN least(floor(value)::DOUBLE / 512, 1.0) END AS confidence
  FROM events
), fx_rated AS (
  SELECT *, CASE WHEN stars > 3 THEN 'POSITIVO' WHEN stars < 3 THEN 'NEGATIVO' ELSE 'NEUTRO' END
      AS sentimento,
    CASE WHEN stars > 3 THEN confidence WHEN stars < 3 THEN -confidence ELSE 0.0::DOUBLE END
      AS score_sentimento
  FROM fx_events
), fx_comments AS (
  SELECT r.*, d.text, CASE WHEN written THEN {_clean("d.text")} ELSE '' END AS text_clean
  FROM fx_rated r
  LEFT JOIN documents d ON d.doc_id = r.event_id % (SELECT count(*) FROM documents)
)"""


# Comments after three collections, under the name that the report statements read.
_COLLECTED = _COMMENTS.replace("fx_rated AS (", "fx_first AS (", 1).replace("FROM fx_rated r", "FROM fx_first r") + """,
fx_rated AS (
  SELECT * REPLACE (like_count + CASE WHEN event_id % 5 = 0 AND event_id % 3 <> 2 THEN 10 ELSE 0 END AS like_count)
  FROM fx_first WHERE event_id % 7 <> 0
)"""


def _scored(name: str, source: str, lexicon: dict[str, list[str]]) -> str:
    """Emotion columns for rows with text_clean, stars, sentimento and score_sentimento."""
    hits = ",\n    ".join(
        f"{_hits('folded', words)} AS h_{name.lower()}" for name, words in lexicon.items()
    )
    return f"""{name}_hits AS MATERIALIZED (
  SELECT *, {hits}
  FROM (SELECT *, {_emotion_fold("text_clean")} AS folded FROM {source})
), {name}_best AS (
  SELECT *, CASE sentimento WHEN 'POSITIVO' THEN greatest(h_entusiasmo, h_esperanca)
    WHEN 'NEGATIVO' THEN greatest(h_raiva, h_tristeza, h_decepcao) ELSE 0 END AS best
  FROM {name}_hits
), {name}_scores AS (
  SELECT *,
    CASE WHEN sentimento <> 'POSITIVO' THEN 0.0 WHEN best > 0 THEN h_entusiasmo::DOUBLE / best
      WHEN stars = 5 THEN 0.8 ELSE 0.3 END::DOUBLE AS score_entusiasmo,
    CASE WHEN sentimento <> 'POSITIVO' THEN 0.0 WHEN best > 0 THEN h_esperanca::DOUBLE / best
      WHEN stars = 5 THEN 0.2 ELSE 0.7 END::DOUBLE AS score_esperanca,
    CASE WHEN sentimento = 'NEUTRO' THEN 1.0 ELSE 0.0 END::DOUBLE AS score_neutro,
    CASE WHEN sentimento <> 'NEGATIVO' THEN 0.0 WHEN best > 0 THEN h_raiva::DOUBLE / best
      WHEN stars = 1 THEN 0.5 ELSE 0.2 END::DOUBLE AS score_raiva,
    CASE WHEN sentimento <> 'NEGATIVO' THEN 0.0 WHEN best > 0 THEN h_tristeza::DOUBLE / best
      ELSE 0.3 END::DOUBLE AS score_tristeza,
    CASE WHEN sentimento <> 'NEGATIVO' THEN 0.0 WHEN best > 0 THEN h_decepcao::DOUBLE / best
      WHEN stars = 1 THEN 0.2 ELSE 0.5 END::DOUBLE AS score_decepcao
  FROM {name}_best
), {name} AS (
  SELECT *, CASE emocao WHEN 'ENTUSIASMO' THEN score_entusiasmo WHEN 'ESPERANCA' THEN score_esperanca
    WHEN 'RAIVA' THEN score_raiva WHEN 'TRISTEZA' THEN score_tristeza
    WHEN 'DECEPCAO' THEN score_decepcao ELSE score_neutro END AS score_emocao
  FROM (SELECT *, CASE
      WHEN sentimento = 'NEUTRO' THEN 'NEUTRO'
      WHEN sentimento = 'POSITIVO' AND score_entusiasmo >= score_esperanca THEN 'ENTUSIASMO'
      WHEN sentimento = 'POSITIVO' THEN 'ESPERANCA'
      WHEN score_raiva >= score_tristeza AND score_raiva >= score_decepcao THEN 'RAIVA'
      WHEN score_tristeza >= score_decepcao THEN 'TRISTEZA'
      ELSE 'DECEPCAO' END AS emocao
    FROM {name}_scores)
)"""


_SCORED = f"{_COMMENTS}, {_scored('fx_scored', 'fx_comments', views.LEXICON)}"
_SCORE_LIST = (
    "sentimento, emocao, score_sentimento, score_emocao, score_entusiasmo, score_esperanca, "
    "score_neutro, score_raiva, score_tristeza, score_decepcao"
)


def _enriched(name: str, source: str, videos: str = "fx_videos") -> str:
    return f"""{name} AS (
  SELECT c.* EXCLUDE (source, category), v.channel_title, v.source, v.category,
    v.candidatos_mencionados,
    CASE WHEN v.category = 'candidato' THEN v.source
      ELSE coalesce(v.candidatos_mencionados[1], 'Não Mencionado') END AS candidato
  FROM {source} c LEFT JOIN {videos} v USING (video_id)
)"""


_FULL = f"{_SILVER}, {_SCORED}, {_enriched('fx_enriched', 'fx_scored')}"
_LIGHT = f"{_SILVER}, {_COMMENTS}, {_enriched('fx_enriched', 'fx_rated')}"


def _counts(prefix: str = "sentimento_") -> str:
    return ", ".join(
        f"count(*) FILTER (WHERE sentimento = '{name}') AS {prefix}{name.lower()}"
        for name in defaults.SENTIMENTS
    )


def _shares(total: str) -> str:
    return ", ".join(
        f"CASE WHEN {total} = 0 THEN 0.0 ELSE "
        f"{_percent(f'sentimento_{name.lower()}', total)} END AS sentimento_{name.lower()}_pct"
        for name in defaults.SENTIMENTS
    )


def _channel_engagement(videos: str, comments: str) -> str:
    return f"""SELECT *, {_shares("comentarios_total")} FROM (
  SELECT v.channel_title AS tema, count(DISTINCT v.video_id) AS videos_total,
    count(c.comment_id) AS comentarios_total, coalesce(avg(c.like_count), 0.0) AS likes_media,
    {_counts()}, coalesce(avg(c.score_sentimento), 0.0) AS score_sentimento_medio
  FROM {videos} v LEFT JOIN {comments} c USING (video_id) GROUP BY 1)"""


_CANDIDATES = f"""fx_mentions AS (
  SELECT video_id, like_count, unnest(candidatos_mencionados) AS candidato FROM fx_videos
), fx_candidates AS (
  SELECT *, {_shares("comentarios_total")}
  FROM (SELECT candidato, count(*) AS videos_total, sum(like_count)::BIGINT AS likes_videos_total
    FROM fx_mentions GROUP BY 1)
  FULL JOIN (SELECT candidato, count(c.comment_id) AS comentarios_total,
      coalesce(sum(c.like_count), 0)::BIGINT AS likes_comentarios_total, {_counts()},
      coalesce(avg(c.score_sentimento), 0.0) AS score_sentimento_medio
    FROM fx_mentions m LEFT JOIN fx_rated c USING (video_id) GROUP BY 1) USING (candidato)
)"""


def _timeline(group: str, key: str, category: str) -> str:
    return f"""SELECT *, {_percent("sentimento_positivo", "total_comentarios")} AS sentimento_positivo_pct,
  {_percent("sentimento_negativo", "total_comentarios")} AS sentimento_negativo_pct
FROM (SELECT {group} AS {key}, published_at::DATE AS data, {_counts()},
    count(comment_id) AS total_comentarios, avg(score_sentimento) AS score_sentimento_medio,
    round(avg(score_emocao), 9) AS score_emocao_medio, sum(like_count)::BIGINT AS likes_total,
    avg(like_count) AS likes_media
  FROM fx_enriched WHERE category = '{category}' GROUP BY 1, 2)"""


def _pivot(key: str, name: str, comments: str = _COMMENTS) -> str:
    return f"""WITH {comments}
SELECT {key} AS {name}, {_counts("")} FROM fx_rated GROUP BY 1"""


def _selected(condition: str) -> str:
    return f"""WITH {_SILVER}
SELECT * REPLACE (strftime(published_at, '%Y-%m-%dT%H:%M:%S.%fZ') AS published_at,
  md5(description) AS description)
FROM fx_judged WHERE {condition}"""


def _daily_volume(comments: str) -> str:
    return f"""WITH {_VIDEOS}, {comments}
SELECT data, coalesce(v, 0) AS videos_novos, coalesce(c, 0) AS comentarios_novos,
  coalesce(likes, 0)::BIGINT AS likes_total, coalesce(score, 0.0) AS sentimento_medio,
  CASE WHEN coalesce(v, 0) = 0 THEN 0.0 ELSE coalesce(c, 0)::DOUBLE / v END AS engajamento_medio
FROM (SELECT published_at::DATE AS data, count(*) AS v FROM fx_raw GROUP BY 1)
FULL JOIN (SELECT published_at::DATE AS data, count(*) AS c, sum(like_count) AS likes,
    avg(score_sentimento) AS score FROM fx_rated GROUP BY 1) USING (data)"""


_WEEKS = f"""WITH {_SILVER}, {_COMMENTS}, fx_weeks AS (
  SELECT date_trunc('week', v.published_at)::DATE AS semana, v.title_clean, count(*) AS comentarios
  FROM fx_rated c JOIN fx_videos v USING (video_id) GROUP BY 1, 2)"""

_THREADS = """fx_thread AS (
  SELECT 'v' || conv_id AS video_id, 't' || conv_id AS thread, turn, text,
    strftime(TIMESTAMP '2024-01-01 00:00:00' + to_hours((conv_id % 720)::INT),
      '%Y-%m-%dT%H:%M:%S.%fZ') AS hour
  FROM conversations
), fx_failed AS (
  SELECT 'v' || doc_id AS video_id FROM labels WHERE toxic = 1
), fx_landed AS (
  SELECT CASE WHEN turn = 0 THEN thread ELSE thread || '.' || turn END AS comment_id, video_id,
    v.source, v.category, CASE WHEN turn > 0 THEN thread END AS parent_id,
    hour AS published_at, hour AS updated_at,
    CASE WHEN turn = 0 THEN text || ' (editado)' ELSE text END AS text,
    CASE WHEN turn % 4 = 3 THEN 0 ELSE length(text) END AS like_count
  FROM fx_thread JOIN fx_raw v USING (video_id)
  WHERE video_id NOT IN (SELECT video_id FROM fx_failed)
)"""

_MANIFEST = """fx_manifest AS (
  SELECT CASE WHEN event_type = 'signup' THEN 'silver' ELSE 'gold' END AS layer,
    'run' || user_id AS run_id, event_type AS file, floor(value)::BIGINT AS row_count
  FROM events)"""

_LENGTH_RATED = """
  SELECT *, CASE WHEN stars > 3 THEN 'POSITIVO' WHEN stars < 3 THEN 'NEGATIVO' ELSE 'NEUTRO' END
      AS sentimento,
    CASE WHEN stars > 3 THEN confidence WHEN stars < 3 THEN -confidence ELSE 0.0::DOUBLE END
      AS score_sentimento
  FROM (SELECT *, CASE WHEN text_clean = '' THEN 3 ELSE length(text_clean) % 5 + 1 END AS stars,
      (length(text_clean) % 64 + 1)::DOUBLE / 64 AS confidence FROM """

_SILVER_COMMENTS = f"""fx_clean AS (
  SELECT comment_id, video_id, source, category, parent_id, text_clean, published_at,
    updated_at, published_at <> updated_at AS is_edited, like_count,
    'comments_1.json' AS source_file, TIMESTAMP '2024-03-01 00:00:00' AS processed_at
  FROM fx_comments WHERE video_id IN (SELECT video_id FROM fx_relevant))"""

_URL_TEXT = "'veja ' || url || ' @joao (85) 99999-1234 123.456.789-01'"

ORACLES: dict[str, str] = {
    "bronze_flatten_videos": f"""WITH {_VIDEOS}
SELECT source, category, channel_id, channel_title, video_id, title,
  strftime(published_at, '%Y-%m-%dT%H:%M:%S+00:00') AS published_at,
  md5(CASE WHEN lang = 'es' THEN '' ELSE description END) AS description,
  CASE WHEN lang = 'de' THEN 0 ELSE view_count END AS view_count,
  CASE WHEN lang = 'de' THEN 0 ELSE like_count END AS like_count,
  0::BIGINT AS comment_count, privacy_status
FROM fx_raw JOIN (SELECT doc_id AS position, lang FROM documents) USING (position)
WHERE source <> 'src19' AND lang <> 'fr'
  AND published_at >= TIMESTAMP '2024-01-05' AND published_at < TIMESTAMP '2024-01-26'""",
    "bronze_flatten_comments": f"WITH {_VIDEOS}, {_THREADS} SELECT * FROM fx_landed",
    "bronze_envelope_rows": f"""WITH {_VIDEOS}
SELECT source, category, channel_id, channel_title, video_id, title,
  strftime(published_at, '%Y-%m-%dT%H:%M:%S.%fZ') AS published_at, md5(description) AS description,
  view_count, like_count, comment_count, privacy_status,
  'videos_' || source || '_' || (position // 50) AS source_file, collected_at
FROM fx_raw""",
    "collection_window": f"""WITH {_VIDEOS}
SELECT video_id, published_at FROM fx_raw
WHERE published_at >= TIMESTAMP '2024-01-05' AND published_at < TIMESTAMP '2024-01-26'""",
    "collection_status": f"""WITH {_VIDEOS}, {_THREADS}
SELECT video_id, CASE WHEN failed THEN 'error' ELSE 'completed' END AS status,
  CASE WHEN NOT failed THEN n END AS comment_count,
  CASE WHEN failed THEN 'commentsDisabled' END AS reason
FROM (SELECT r.video_id, r.video_id IN (SELECT video_id FROM fx_failed) AS failed,
    count(l.comment_id) AS n
  FROM fx_raw r LEFT JOIN fx_landed l USING (video_id) GROUP BY 1)""",
    "collection_header": f"""WITH {_VIDEOS}, {_THREADS}
SELECT count(*) AS video_count, sum(comment_count)::BIGINT AS comment_count,
  count(*) FILTER (WHERE status = 'error') AS error_count FROM (SELECT video_id, CASE WHEN failed THEN 'error' ELSE 'completed' END AS status,
  CASE WHEN NOT failed THEN n END AS comment_count,
  CASE WHEN failed THEN 'commentsDisabled' END AS reason
FROM (SELECT r.video_id, r.video_id IN (SELECT video_id FROM fx_failed) AS failed,
    count(l.comment_id) AS n
  FROM fx_raw r LEFT JOIN fx_landed l USING (video_id) GROUP BY 1))""",
    "channel_identifier_kind": """
SELECT doc_id, p || source AS identifier,
  CASE p WHEN 'UC' THEN 'id' WHEN '@' THEN 'handle' END AS kind
FROM (SELECT *, CASE lang WHEN 'fr' THEN 'UC' WHEN 'de' THEN '@' ELSE '' END AS p FROM documents)""",
    "lenient_timestamps": """
SELECT event_id, CASE WHEN event_type <> 'error' THEN ts END AS published_at,
  TRY_CAST(props AS TIMESTAMP) AS updated_at FROM events""",
    "complete_runs": f"""WITH {_MANIFEST}
SELECT run_id FROM fx_manifest GROUP BY 1
HAVING count(DISTINCT file) FILTER (WHERE layer = 'gold') = 4
  AND count(*) FILTER (WHERE layer = 'silver') > 0""",
    "run_counts": f"WITH {_MANIFEST} SELECT run_id, layer, count(*) AS tables, sum(row_count)::BIGINT AS row_count FROM fx_manifest GROUP BY 1, 2",
    "source_category": f"""WITH {_VIDEOS}
SELECT video_id, source, category, {_CONFIGURED} AS config_category FROM fx_raw""",
    "dedupe_latest": f"""WITH {_VIDEOS}
SELECT * REPLACE (strftime(published_at, '%Y-%m-%dT%H:%M:%S.%fZ') AS published_at,
  md5(description) AS description) FROM fx_latest""",
    "dedupe_latest_per_user_event": """
SELECT * FROM events QUALIFY row_number() OVER (
  PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
    "drop_duplicates_last": """
SELECT md5(text) AS text, lang, source, doc_id FROM documents
QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id DESC) = 1""",
    "relevance_match": f"""WITH {_VIDEOS}, {_marked("fx_all", "fx_raw", bypass=False)}
SELECT video_id, matched_terms FROM fx_all WHERE len(matched_terms) > 0""",
    "relevance_bypass": f"WITH {_SILVER} SELECT video_id, source, matched_terms FROM fx_marked",
    "videos_relevant": _selected("len(matched_terms) > 0"),
    "videos_discarded": _selected("len(matched_terms) = 0"),
    "relevance_summary": f"""WITH {_SILVER}
SELECT count(*) AS avaliados, count(*) FILTER (WHERE len(matched_terms) > 0) AS relevantes,
  count(*) FILTER (WHERE len(matched_terms) = 0) AS descartados FROM fx_marked""",
    "candidate_mentions": f"WITH {_SILVER} SELECT video_id, candidatos_mencionados FROM fx_videos",
    "silver_videos": f"""WITH {_SILVER}
SELECT * REPLACE (md5(title_clean) AS title_clean, md5(description_clean) AS description_clean)
FROM fx_relevant""",
    "comments_semi_join": f"""WITH {_SILVER}, {_COMMENTS}
SELECT comment_id, video_id, like_count FROM fx_events
WHERE video_id IN (SELECT video_id FROM fx_marked WHERE len(matched_terms) > 0)""",
    "silver_comments": f"""WITH {_SILVER}, {_COMMENTS}, {_SILVER_COMMENTS}
SELECT * REPLACE (md5(text_clean) AS text_clean) FROM fx_clean""",
    "edited_comments": """
SELECT 'c' || event_id AS comment_id, event_id % 5 = 0 AS is_edited FROM events""",
    "clean_text": f"SELECT doc_id, {_clean('text')} AS text_clean FROM documents",
    "fold_text": f"SELECT doc_id, {_fold('text')} AS text_folded FROM documents",
    "emotion_fold": f"SELECT doc_id, {_emotion_fold('text')} AS text_folded FROM documents",
    "anonymize_strict": f"SELECT doc_id, {_masked('text', True)} AS text_anonimizado FROM documents",
    "anonymize_loose": f"SELECT doc_id, {_masked('text', False)} AS text_anonimizado FROM documents",
    "anonymize_page_urls": f"""
SELECT page_id, {_masked(_URL_TEXT, True)} AS strict, {_masked(_URL_TEXT, False)} AS loose
FROM pages""",
    "anonymize_pages": f"""
SELECT page_id, md5({_masked("html", True)}) AS strict, md5({_masked("html", False)}) AS loose
FROM pages""",
    "star_to_sentiment": f"""WITH {_COMMENTS}
SELECT comment_id, sentimento, score_sentimento FROM fx_rated""",
    "emotion_hits": f"""SELECT doc_id, {", ".join(
        f"{_hits('folded', words)} AS {name.lower()}"
        for name, words in defaults.EMOTION_LEXICON.items()
    )} FROM (SELECT doc_id, {_emotion_fold("text")} AS folded FROM documents)""",
    "emotion_scores": f"WITH {_SCORED} SELECT comment_id, {_SCORE_LIST} FROM fx_scored",
    "emotion_scores_default_lexicon": f"""
WITH {_COMMENTS}, {_scored("fx_scored", "fx_comments", defaults.EMOTION_LEXICON)}
SELECT comment_id, {_SCORE_LIST} FROM fx_scored""",
    "emotion_fallback": f"""
WITH {_COMMENTS}, {_scored("fx_scored", "fx_comments", {name: [] for name in views.LEXICON})}
SELECT comment_id, {_SCORE_LIST} FROM fx_scored""",
    "score_comments": f"""
WITH fx_written AS (SELECT 'd' || doc_id AS comment_id, {_clean("text")} AS text_clean FROM documents),
fx_length AS ({_LENGTH_RATED} fx_written)), {_scored("fx_scored", "fx_length", views.LEXICON)}
SELECT comment_id, {_SCORE_LIST} FROM fx_scored""",
    "score_comments_once": f"""
WITH {_COMMENTS}, fx_written AS (
  SELECT comment_id, CASE WHEN written AND text IS NOT NULL THEN text ELSE '' END AS text_clean FROM fx_comments),
fx_length AS ({_LENGTH_RATED} fx_written)), {_scored("fx_scored", "fx_length", views.LEXICON)}
SELECT comment_id, {_SCORE_LIST} FROM fx_scored""",
    "enriched_comments": f"""
WITH {_SILVER}, {_SCORED}, {_enriched("fx_enriched", "fx_scored", "fx_relevant")}
SELECT comment_id, video_id, parent_id, md5(text_clean) AS text_clean, published_at, updated_at,
  published_at <> updated_at AS is_edited, like_count, 'comments_1.json' AS source_file,
  TIMESTAMP '2024-03-01 00:00:00' AS processed_at, {_SCORE_LIST}, channel_title, source, category,
  candidatos_mencionados, candidato FROM fx_enriched""",
    "candidate_attribution": f"""WITH {_SILVER}
SELECT video_id, CASE WHEN category = 'candidato' THEN source
    ELSE coalesce(candidatos_mencionados[1], 'Não Mencionado') END AS candidato,
  CASE WHEN category = 'candidato' THEN source ELSE 'Não Mencionado' END AS candidato_do_canal
FROM fx_videos""",
    "daily_volume": _daily_volume(_COMMENTS),
    "daily_volume_from_cube": _daily_volume(_COLLECTED),
    "latest_state": f"""WITH {_COLLECTED}
SELECT comment_id, video_id, published_at, updated_at, like_count, sentimento,
  'comments_' || CASE WHEN event_id % 3 = 2 OR event_id % 5 = 0 THEN 2 ELSE 1 END || '.json' AS source_file
FROM fx_rated""",
    "candidate_engagement_from_cube": f"WITH {_SILVER}, {_COLLECTED}, {_CANDIDATES} SELECT * FROM fx_candidates",
    "sentiment_by_hour_from_cube": _pivot("hour(updated_at)", "hora", _COLLECTED),
    "candidate_engagement": f"WITH {_SILVER}, {_COMMENTS}, {_CANDIDATES} SELECT * FROM fx_candidates",
    "channel_engagement": f"WITH {_SILVER}, {_COMMENTS} {_channel_engagement('fx_videos', 'fx_rated')}",
    "channel_engagement_from_bronze": f"""WITH {_SILVER}, {_COMMENTS}, {_SILVER_COMMENTS},
fx_length AS ({_LENGTH_RATED} fx_clean)) {_channel_engagement("fx_relevant", "fx_length")}""",
    "candidate_timeline": f"WITH {_FULL} {_timeline('candidato', 'candidato', 'candidato')}",
    "channel_timeline": f"WITH {_FULL} {_timeline('channel_title', 'tema', 'imprensa')}",
    "candidate_timeline_one": f"""WITH {_FULL}
SELECT * FROM ({_timeline("candidato", "candidato", "candidato")}) WHERE candidato = 'src4'""",
    "channel_timeline_one": f"""WITH {_FULL}
SELECT * FROM ({_timeline("channel_title", "tema", "imprensa")}) WHERE tema = 'SRC7'""",
    "sentiment_summary": f"WITH {_COMMENTS} SELECT {_counts('')} FROM fx_rated",
    "sentiment_share": f"""WITH {_COMMENTS}
SELECT positivo, negativo, neutro, positivo::DOUBLE / n * 100 AS positivo_pct,
  negativo::DOUBLE / n * 100 AS negativo_pct, neutro::DOUBLE / n * 100 AS neutro_pct
FROM (SELECT {_counts("")}, count(*) AS n FROM fx_rated)""",
    "home_kpis": f"""WITH {_LIGHT}, {_CANDIDATES}
SELECT (SELECT count(*) FROM fx_candidates) AS candidatos, count(*) AS comentarios,
  count(DISTINCT video_id) AS videos,
  count(DISTINCT channel_title) FILTER (WHERE category = 'imprensa') AS canais_midia,
  sum(like_count)::BIGINT AS likes_total FROM fx_enriched""",
    "press_channel_ranking": f"""WITH {_LIGHT}
SELECT channel_title, count(video_id) AS comentarios_total, sum(like_count)::BIGINT AS likes_total
FROM fx_enriched WHERE category = 'imprensa' GROUP BY 1""",
    "channel_summary": f"""WITH {_LIGHT}
SELECT channel_title AS canal, count(DISTINCT video_id) AS videos_total,
  count(comment_id) AS comentarios_total, sum(like_count)::BIGINT AS likes_total, {_counts()}
FROM fx_enriched WHERE category = 'imprensa' GROUP BY 1""",
    "channel_detail": f"""WITH {_LIGHT}
SELECT channel_title AS canal, count(DISTINCT video_id) AS videos_total,
  count(comment_id) AS comentarios_total, sum(like_count)::BIGINT AS likes_total, {_counts()}
FROM fx_enriched WHERE category = 'imprensa' AND channel_title = 'SRC7' GROUP BY 1""",
    "sentiment_by_day": _pivot("updated_at::DATE", "data"),
    "sentiment_by_hour": _pivot("hour(updated_at)", "hora"),
    "emotion_histogram": f"""WITH {_SCORED}
SELECT emocao, count(*) AS comentarios FROM fx_scored GROUP BY 1""",
    "weekly_video_counts": f"{_WEEKS} SELECT * FROM fx_weeks",
    "weekly_top_videos": f"""{_WEEKS}
SELECT * FROM fx_weeks WHERE semana = (SELECT max(semana) FROM fx_weeks)
ORDER BY comentarios DESC, title_clean LIMIT 5""",
    "distinct_emotions": f"WITH {_SCORED} SELECT DISTINCT emocao FROM fx_scored",
    "distinct_candidates": f"""WITH {_LIGHT}
SELECT DISTINCT candidato FROM fx_enriched WHERE candidato <> 'Não Mencionado'""",
    "distinct_timeline_candidates": f"""WITH {_LIGHT}
SELECT DISTINCT candidato FROM fx_enriched WHERE category = 'candidato'""",
    "distinct_channels": f"""WITH {_LIGHT}
SELECT DISTINCT channel_title AS tema FROM fx_enriched WHERE category = 'imprensa'""",
    "top_candidates": f"""WITH {_SILVER}, {_COMMENTS}, {_CANDIDATES}
SELECT candidato, comentarios_total, score_sentimento_medio, sentimento_positivo,
  sentimento_negativo, sentimento_neutro
FROM fx_candidates ORDER BY comentarios_total DESC, candidato LIMIT 5""",
    "candidate_table": f"""WITH {_SILVER}, {_COMMENTS}, {_CANDIDATES}
SELECT candidato, videos_total, comentarios_total, score_sentimento_medio FROM fx_candidates""",
    "candidate_detail": f"""WITH {_SILVER}, {_COMMENTS}, {_CANDIDATES}
SELECT * FROM fx_candidates WHERE candidato = 'Ana Lima'""",
    "sample_by_emotion": f"""WITH {_SCORED}
SELECT comment_id, {_masked("text_clean", True)} AS text_anonimizado, emocao, score_emocao,
  sentimento, score_sentimento, like_count
FROM (SELECT * FROM fx_scored WHERE emocao = 'RAIVA' ORDER BY comment_id LIMIT 15)""",
    "sample_by_candidate": f"""WITH {_FULL}
SELECT comment_id, {_masked("text_clean", False)} AS text_anonimizado, candidato, sentimento,
  channel_title
FROM (SELECT * FROM fx_enriched WHERE candidato = 'Zélia Braga' AND sentimento = 'POSITIVO'
  ORDER BY md5('42:' || comment_id), comment_id LIMIT 20)""",
    "sample_size": f"""WITH {_LIGHT}
SELECT count(*) AS encontrados, least(count(*), 20) AS mostrando
FROM fx_enriched WHERE candidato = 'Zélia Braga' AND sentimento = 'POSITIVO'""",
}
