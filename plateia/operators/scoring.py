"""Comment scoring: an injected classifier, then native sentiment and emotion columns."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plateia import defaults, schemas
from plateia.functions import emotion
from plateia.functions.text import evaluated_once, is_blank

# A predictor labels a list of texts; its factory runs once per Python worker task.
Predictor = Callable[[list[str]], Iterable[tuple[str, float]]]
PredictorFactory = Callable[[], Predictor]

SCORE_COLUMNS = [
    "sentimento", "emocao", "score_sentimento", "score_emocao", "score_entusiasmo",
    "score_esperanca", "score_neutro", "score_raiva", "score_tristeza", "score_decepcao",
]


def _classifier(factory: PredictorFactory, batch_size: int, batch_chars: int | None):
    """A marked function from texts to (label, confidence); NULL texts get NULL.

    A text that repeats within an Arrow batch is classified once. The distinct texts
    go to the predictor from short to long, so that texts padded to one length have
    similar lengths: ``batch_size`` at a time or, with ``batch_chars``, as many as stay
    within that many characters when all are padded to the longest; one at least.
    """

    def chunks(texts: list[str]) -> Iterator[list[str]]:
        chunk: list[str] = []
        for text in sorted(texts, key=len):
            full = len(chunk) == batch_size if batch_chars is None else (len(chunk) + 1) * len(text) > batch_chars
            if chunk and full:
                yield chunk
                chunk = []
            chunk.append(text)
        if chunk:
            yield chunk

    @evaluated_once
    @F.pandas_udf("label string, confidence double")
    def classify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        predict = factory()
        for texts in batches:
            answers = {
                text: tuple(answer)
                for chunk in chunks(texts.dropna().unique().tolist())
                for text, answer in zip(chunk, predict(chunk), strict=True)
            }
            rows = [answers.get(text, (None, None)) for text in texts]
            yield pd.DataFrame(rows, index=texts.index, columns=["label", "confidence"])

    return classify


def _written(text: str) -> Column:
    return F.when(~is_blank(F.col(text)), F.col(text))


def with_prediction(
    comments: DataFrame,
    factory: PredictorFactory,
    text: str = "text_clean",
    batch_size: int = defaults.CLASSIFIER_BATCH,
    tasks: int | None = None,
    batch_chars: int | None = None,
) -> DataFrame:
    """Adds the classifier's ``label`` and ``confidence``; blank texts get NULL.

    ``tasks`` spreads the comments evenly over that many model tasks, for inputs
    whose splits are sized for reading rather than for inference. Cutting long texts
    to what a model takes is up to the predictor, which gets them whole.
    """
    schemas.require_columns(comments, [text], "scoring")
    classify = _classifier(factory, batch_size, batch_chars)
    spread = comments.repartition(tasks, "comment_id") if tasks else comments
    return spread.withColumn("_answer", classify(_written(text))).select(
        *comments.columns, "_answer.label", "_answer.confidence"
    )


def with_prediction_once(
    comments: DataFrame,
    factory: PredictorFactory,
    text: str = "text_clean",
    batch_size: int = defaults.CLASSIFIER_BATCH,
    tasks: int | None = None,
    batch_chars: int | None = None,
) -> DataFrame:
    """As ``with_prediction``, with every distinct text of the whole table classified once.

    Distinct texts are found by an aggregate that combines on the map side, spread over
    ``tasks`` model tasks, and their answers joined back by a digest of the text. That
    join keeps all comments, so adaptive planning can split the partition of a text that
    a third of them share. ``comments`` is read twice: pass a written table.
    """
    schemas.require_columns(comments, [text], "scoring")
    classify = _classifier(factory, batch_size, batch_chars)
    distinct = comments.select(_written(text).alias("_text")).filter("_text IS NOT NULL").distinct()
    spread = distinct.repartition(tasks, "_text") if tasks else distinct
    answers = spread.withColumn("_answer", classify(F.col("_text"))).select(
        F.sha2("_text", 256).alias("_digest"), "_answer"
    )
    keyed = comments.withColumn("_digest", F.sha2(_written(text), 256))
    return keyed.join(answers, "_digest", "left").select(
        *comments.columns, "_answer.label", "_answer.confidence"
    )


def with_sentiment(comments: DataFrame, blank: str | None = None) -> DataFrame:
    """Adds ``_stars``, ``sentimento`` and ``score_sentimento`` from label and confidence."""
    stars = emotion.stars_of(F.col("label"))
    if blank:
        stars = F.when(is_blank(F.col(blank)), 3).otherwise(stars)
    return (
        comments.withColumn("_stars", stars)
        .withColumn("sentimento", emotion.sentiment_of(F.col("_stars")))
        .withColumn(
            "score_sentimento", emotion.signed_score(F.col("sentimento"), F.col("confidence"))
        )
    )


def score_comments(
    comments: DataFrame,
    factory: PredictorFactory | None = None,
    lexicon: Mapping[str, Sequence[str]] = defaults.EMOTION_LEXICON,
    text: str = "text_clean",
    tasks: int | None = None,
    once: bool = False,
) -> DataFrame:
    """Adds the ten score columns to every comment.

    Without a ``factory`` the comments must already carry ``label`` and
    ``confidence``. With ``once``, equal texts are classified once in the whole table.
    Only rows with a polarity have their text searched.
    """
    schemas.require_columns(comments, [text], "scoring")
    if factory:
        predict = with_prediction_once if once else with_prediction
        comments = predict(comments, factory, text, tasks=tasks)
    schemas.require_columns(comments, ["label", "confidence"], "scoring")
    kept = [name for name in comments.columns if name not in ("label", "confidence")]

    searched = F.when(F.col("sentimento") != "NEUTRO", F.col(text))
    return (
        with_sentiment(comments, blank=text)
        .withColumn("_hits", emotion.keyword_hits(searched, lexicon))
        .withColumn(
            "_emotion",
            emotion.emotion_of(F.col("sentimento"), F.col("_stars"), F.col("_hits")),
        )
        .select(*kept, "sentimento", "score_sentimento", "_emotion.*")
        .select(*kept, *SCORE_COLUMNS)
    )
