"""Key-based upsert on append-only data (file log T4, run log T3, incremental U2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackyard.operators.dedup import dedup_latest


def latest_state(log: DataFrame, keys: Sequence[str], time_col: str = "event_time") -> DataFrame:
    """Current state per key of an append-only event log (latest event wins)."""
    return dedup_latest(log, keys, [F.col(time_col).desc_nulls_last()])
