"""Table schemas, enforced on read and before every write."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


TEXT, COUNT, NUMBER = T.StringType(), T.LongType(), T.DoubleType()
DAY, TIME, FLAG = T.DateType(), T.TimestampType(), T.BooleanType()
TEXTS = T.ArrayType(TEXT)


def _struct(*parts: T.StructType, **fields: T.DataType) -> T.StructType:
    """The fields of ``parts``, then the given ones."""
    inherited = [field for part in parts for field in part.fields]
    return T.StructType(inherited + [T.StructField(name, kind) for name, kind in fields.items()])


_RAW_VIDEO = _struct(
    source=TEXT,
    category=TEXT,
    channel_id=TEXT,
    channel_title=TEXT,
    video_id=TEXT,
    title=TEXT,
    published_at=TEXT,
    description=TEXT,
    view_count=COUNT,
    like_count=COUNT,
    comment_count=COUNT,
    privacy_status=TEXT,
)
_RAW_COMMENT = _struct(
    comment_id=TEXT,
    video_id=TEXT,
    source=TEXT,
    category=TEXT,
    parent_id=TEXT,
    published_at=TEXT,
    updated_at=TEXT,
    text=TEXT,
    like_count=COUNT,
)
_LANDED = _struct(source_file=TEXT, collected_at=TEXT, position=COUNT)
_SENTIMENT_COUNTS = _struct(
    sentimento_positivo=COUNT, sentimento_negativo=COUNT, sentimento_neutro=COUNT
)
_SENTIMENT_SHARES = _struct(
    sentimento_positivo_pct=NUMBER, sentimento_negativo_pct=NUMBER, sentimento_neutro_pct=NUMBER
)
_SCORES = _struct(
    sentimento=TEXT,
    emocao=TEXT,
    score_sentimento=NUMBER,
    score_emocao=NUMBER,
    score_entusiasmo=NUMBER,
    score_esperanca=NUMBER,
    score_neutro=NUMBER,
    score_raiva=NUMBER,
    score_tristeza=NUMBER,
    score_decepcao=NUMBER,
)
_COMMENT_CORE = _struct(
    parent_id=TEXT,
    text_clean=TEXT,
    published_at=TIME,
    updated_at=TIME,
    is_edited=FLAG,
    like_count=COUNT,
    source_file=TEXT,
    processed_at=TIME,
)
_TIMELINE = _struct(
    _struct(data=DAY),
    _SENTIMENT_COUNTS,
    total_comentarios=COUNT,
    score_sentimento_medio=NUMBER,
    score_emocao_medio=NUMBER,
    likes_total=COUNT,
    likes_media=NUMBER,
    sentimento_positivo_pct=NUMBER,
    sentimento_negativo_pct=NUMBER,
)

# Bronze, silver and gold tables.
VIDEO_STATUS = _struct(video_id=TEXT, status=TEXT, comment_count=COUNT, reason=TEXT)
BRONZE_VIDEOS = _struct(_RAW_VIDEO, _LANDED)
BRONZE_COMMENTS = _struct(_RAW_COMMENT, _LANDED)
SELECTED_VIDEOS = _struct(BRONZE_VIDEOS, matched_terms=TEXTS)
VIDEOS_SILVER = _struct(
    video_id=TEXT,
    channel_id=TEXT,
    channel_title=TEXT,
    source=TEXT,
    category=TEXT,
    title_clean=TEXT,
    description_clean=TEXT,
    published_at=TIME,
    view_count=COUNT,
    like_count=COUNT,
    comment_count=COUNT,
    privacy_status=TEXT,
    candidatos_mencionados=TEXTS,
    source_file=TEXT,
    processed_at=TIME,
)
COMMENTS_SILVER = _struct(
    _struct(comment_id=TEXT, video_id=TEXT, source=TEXT, category=TEXT), _COMMENT_CORE
)
COMMENTS_WITH_SENTIMENT = _struct(COMMENTS_SILVER, _SCORES)
DAILY_VOLUME = _struct(
    data=DAY,
    videos_novos=COUNT,
    comentarios_novos=COUNT,
    likes_total=COUNT,
    sentimento_medio=NUMBER,
    engajamento_medio=NUMBER,
)
CANDIDATE_ENGAGEMENT = _struct(
    _struct(
        candidato=TEXT,
        videos_total=COUNT,
        likes_videos_total=COUNT,
        comentarios_total=COUNT,
        likes_comentarios_total=COUNT,
    ),
    _SENTIMENT_COUNTS,
    _struct(score_sentimento_medio=NUMBER),
    _SENTIMENT_SHARES,
)
CHANNEL_ENGAGEMENT = _struct(
    _struct(tema=TEXT, videos_total=COUNT, comentarios_total=COUNT, likes_media=NUMBER),
    _SENTIMENT_COUNTS,
    _struct(score_sentimento_medio=NUMBER),
    _SENTIMENT_SHARES,
)
ENRICHED_COMMENTS = _struct(
    _struct(comment_id=TEXT, video_id=TEXT),
    _COMMENT_CORE,
    _SCORES,
    channel_title=TEXT,
    source=TEXT,
    category=TEXT,
    candidatos_mencionados=TEXTS,
    candidato=TEXT,
)
CANDIDATE_TIMELINE = _struct(_struct(candidato=TEXT), _TIMELINE)
CHANNEL_TIMELINE = _struct(_struct(tema=TEXT), _TIMELINE)
MANIFEST = _struct(layer=TEXT, run_id=TEXT, file=TEXT, row_count=COUNT, written_at=TIME)

# Landed envelopes: one JSON object per collection.
VIDEO_ENVELOPE = _struct(
    collected_at=TEXT,
    collection_start=TEXT,
    collection_end=TEXT,
    video_count=COUNT,
    videos=T.ArrayType(_RAW_VIDEO),
)
COMMENT_ENVELOPE = _struct(
    collected_at=TEXT,
    source_videos_file=TEXT,
    video_count=COUNT,
    comment_count=COUNT,
    video_status=T.ArrayType(VIDEO_STATUS),
    comments=T.ArrayType(_RAW_COMMENT),
)

# Landed API pages: the raw items of one response, with the request they answer.
CHANNEL_PAGE = _struct(
    source=TEXT, page=COUNT, items=T.ArrayType(_struct(id=TEXT, snippet=_struct(title=TEXT)))
)
COLLECTION_ERROR = _struct(video_id=TEXT, reason=TEXT)
VIDEO_PAGE = _struct(
    source=TEXT,
    page=COUNT,
    items=T.ArrayType(
        _struct(
            id=TEXT,
            snippet=_struct(title=TEXT, description=TEXT),
            statistics=_struct(viewCount=TEXT, likeCount=TEXT, commentCount=TEXT),
            status=_struct(privacyStatus=TEXT),
        )
    ),
)
PLAYLIST_PAGE = _struct(
    source=TEXT,
    page=COUNT,
    items=T.ArrayType(_struct(contentDetails=_struct(videoId=TEXT, videoPublishedAt=TEXT))),
)
_API_COMMENT = _struct(
    id=TEXT, snippet=_struct(publishedAt=TEXT, updatedAt=TEXT, textDisplay=TEXT, likeCount=COUNT)
)
THREAD_PAGE = _struct(
    video_id=TEXT,
    page=COUNT,
    items=T.ArrayType(
        _struct(snippet=_struct(topLevelComment=_API_COMMENT, totalReplyCount=COUNT))
    ),
)
REPLY_PAGE = _struct(video_id=TEXT, parent_id=TEXT, page=COUNT, items=T.ArrayType(_API_COMMENT))

# Settings files.
CHANNELS_FILE = _struct(channels=T.ArrayType(_struct(source=TEXT, category=TEXT, identifier=TEXT)))
TERMS_FILE = _struct(relevance_terms=T.ArrayType(_struct(type=TEXT, label=TEXT, term=TEXT)))


def require_columns(df: DataFrame, names: Iterable[str], purpose: str) -> None:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"{purpose} needs the columns {', '.join(missing)}")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of the schema, in its order, with its types."""
    require_columns(df, schema.names, "the table")
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields))
