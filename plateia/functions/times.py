"""UTC times and collection windows."""

from __future__ import annotations

from datetime import UTC, date, datetime, time

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_utc(value: Column) -> Column:
    """Strict parse of ISO text to a timestamp; malformed text fails the job."""
    return F.to_timestamp(value)


def to_utc_lenient(value: Column) -> Column:
    """Parse that gives NULL for text that is not a time."""
    return F.try_to_timestamp(value)


def iso_utc(value: Column) -> Column:
    """ISO text with +00:00; microseconds appear only when they are not zero."""
    whole = F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(value, "SSSSSS")
    return F.concat(
        whole, F.when(micros == "000000", "").otherwise(F.concat(F.lit("."), micros)), F.lit("+00:00")
    )


def window_bounds(start: str | datetime, end: str | datetime) -> tuple[datetime, datetime]:
    """Inclusive UTC window from days ('YYYY-MM-DD') or ISO times with an offset."""
    bounds = _bound(start, time.min), _bound(end, time.max)
    if bounds[0] > bounds[1]:
        raise ValueError("the collection window must not end before it starts")
    return bounds


def _bound(value: str | datetime, edge: time) -> datetime:
    if isinstance(value, str):
        try:
            if len(value) == 10:
                return datetime.combine(date.fromisoformat(value), edge, UTC)
            value = datetime.fromisoformat(value)
        except ValueError as error:
            raise ValueError(f"not an ISO 8601 time: {value!r}") from error
    if value.tzinfo is None:
        raise ValueError(f"a window bound needs a time zone: {value!r}")
    return value.astimezone(UTC)


def in_window(published: Column, start: str | datetime, end: str | datetime) -> Column:
    low, high = window_bounds(start, end)
    return published.between(F.lit(low), F.lit(high))
