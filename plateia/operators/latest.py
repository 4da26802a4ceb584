"""Latest record per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Order in which landed snapshots supersede each other; NULL never wins.
SNAPSHOT_ORDER = ("collected_at", "source_file", "position")


def keep_latest(
    df: DataFrame, keys: Sequence[str], order: Sequence[str] = SNAPSHOT_ORDER
) -> DataFrame:
    """One row per key: the greatest by ``order``, compared column by column.

    An aggregate rather than a ranking window, because each map task already
    reduces its copies to one row per key: a key that holds a third of all rows
    sends one row per map task instead of gathering every copy in one task.
    """
    payload = [name for name in df.columns if name not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*payload), F.struct(*order)).alias("_latest"))
        .select(*(name if name in keys else F.col(f"_latest.{name}") for name in df.columns))
    )
