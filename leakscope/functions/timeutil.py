"""Time-zone-safe timestamp literals.

A Python ``datetime`` literal is converted through the driver's local zone,
which need not be the session's; comparing it with a TIMESTAMP_NTZ column then
shifts the bound. Literals are built from ISO text in the column's own type.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType


def iso(value) -> str:
    if isinstance(value, dt.datetime):
        return value.isoformat(sep=" ")
    if isinstance(value, dt.date):
        return dt.datetime(value.year, value.month, value.day).isoformat(sep=" ")
    return str(value)


def ts_lit(df: DataFrame, col: str, value) -> Column:
    """Literal of the same timestamp flavour as ``df[col]``."""
    if isinstance(df.schema[col].dataType, TimestampNTZType):
        return F.to_timestamp_ntz(F.lit(iso(value)))
    return F.to_timestamp(F.lit(iso(value)))
