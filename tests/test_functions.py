from datetime import UTC, datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from plateia.functions import emotion, numeric, times


def test_round_half_even_equals_array_rounding(column):
    rng = np.random.default_rng(3)
    values = [3.125, 1.015, 2.675, 0.285, 0.5, -1.005, None] + rng.uniform(0, 100, 2000).tolist()
    values += [part / whole * 100 for whole in range(1, 65) for part in range(whole + 1)]
    expected = [None if v is None else float(np.round(v, 2)) for v in values]
    assert column(numeric.round_half_even, values, "DOUBLE") == expected


def test_ratio_and_percent(spark):
    row = spark.sql("SELECT 1 a, 32 b, 0 z").select(
        numeric.percent(F.col("a"), F.col("b")),
        numeric.percent(F.col("a"), F.col("z")),
        numeric.ratio_or_zero(F.col("a"), F.col("z")),
    ).first()
    assert tuple(row) == (3.12, None, 0.0)


def test_window_bounds():
    start, end = times.window_bounds("2026-09-01", "2026-09-01")
    assert start == datetime(2026, 9, 1, tzinfo=UTC)
    assert end == datetime(2026, 9, 1, 23, 59, 59, 999999, tzinfo=UTC)
    start, _ = times.window_bounds("2026-09-01T00:00:00-03:00", "2026-09-02")
    assert start == datetime(2026, 9, 1, 3, tzinfo=UTC)


@pytest.mark.parametrize(
    "start, end",
    [
        ("2026-09-02", "2026-09-01"),
        ("2026-09-01T00:00:00", "2026-09-02"),
        ("yesterday", "2026-09-02"),
        ("2026-13-01", "2026-13-02"),
    ],
)
def test_window_is_validated(start, end):
    with pytest.raises(ValueError):
        times.window_bounds(start, end)


def test_window_is_inclusive(column):
    values = ["2026-08-31T23:59:59.999999Z", "2026-09-01T00:00:00Z", "2026-09-02T23:59:59.999999Z",
              "2026-09-03T00:00:00Z", "2026-09-02T21:30:00-03:00"]
    inside = lambda c: times.in_window(times.to_utc(c), "2026-09-01", "2026-09-02")
    assert column(inside, values) == [False, True, True, False, False]


def test_iso_utc(column):
    values = ["2026-09-01T01:02:03Z", "2026-09-01T01:02:03.5Z", "2026-09-01T01:02:03-03:00"]
    assert column(lambda c: times.iso_utc(times.to_utc(c)), values) == [
        "2026-09-01T01:02:03+00:00",
        "2026-09-01T01:02:03.500000+00:00",
        "2026-09-01T04:02:03+00:00",
    ]


def test_stars_and_sentiment(column):
    labels = ["5 stars", "4 STARS", "3 stars", "2 stars", "1 star", "LABEL_0", None, "1 or 5 stars"]
    assert column(emotion.stars_of, labels) == [5, 4, 3, 2, 1, 3, 3, 5]
    assert column(lambda c: emotion.sentiment_of(emotion.stars_of(c)), labels[:6]) == [
        "POSITIVO", "POSITIVO", "NEUTRO", "NEGATIVO", "NEGATIVO", "NEUTRO",
    ]
