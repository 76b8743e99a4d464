"""Backfill without duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame

from leakscope.schemas import EVENT_ID


def new_only(df: DataFrame, existing: DataFrame, key: str = EVENT_ID) -> DataFrame:
    """Rows of ``df`` whose key is not in ``existing`` (left anti join on the key;
    both sides shuffle on the key, or the smaller is broadcast when AQE sees
    it under the broadcast threshold)."""
    return df.join(existing.select(key), key, "left_anti")
