"""Membership, date-range and severity filters; coercion; rounding;
distinct segment list and date bounds."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leakscope.functions.rounding import round_half_up
from leakscope.functions.timeutil import ts_lit
from leakscope.schemas import EVENT_TS, SEGMENT


def _ts(d) -> dt.datetime:
    if isinstance(d, dt.datetime):
        return d
    if isinstance(d, dt.date):
        return dt.datetime(d.year, d.month, d.day)
    return dt.datetime.fromisoformat(str(d))


def filter_gold(df: DataFrame, segments=None, severities=None, start=None, end=None,
                inclusive_end: bool = True) -> DataFrame:
    """B7-B10. ``inclusive_end=True`` keeps the dashboard's bound
    ``ts <= midnight(end)`` (B8); ``False`` is the repaired half-open day
    range ``ts < end + 1 day`` (B9). Literal predicates push down to the scan
    and prune Gold's (segment, severity) partitions."""
    out = df
    if segments is not None:
        out = out.where(F.col(SEGMENT).isin(list(segments)))
    if severities is not None:
        out = out.where(F.col("severity").isin(list(severities)))
    if start is not None:
        out = out.where(F.col(EVENT_TS) >= ts_lit(df, EVENT_TS, _ts(start)))
    if end is not None:
        e = _ts(end)
        out = (out.where(F.col(EVENT_TS) <= ts_lit(df, EVENT_TS, e)) if inclusive_end
               else out.where(F.col(EVENT_TS) < ts_lit(df, EVENT_TS, e + dt.timedelta(days=1))))
    return out


def severity_is(df: DataFrame, severity: str, negate: bool = False) -> DataFrame:
    """B10."""
    c = F.col("severity") == severity
    return df.where(~c if negate else c)


def coerce(df: DataFrame, numeric=(), timestamps=()) -> DataFrame:
    """Lenient casts; unparsable values become NULL instead of failing."""
    cols = {c: F.expr(f"try_cast(`{c}` AS DOUBLE)") for c in numeric}
    cols.update({c: F.try_to_timestamp(F.col(c).cast("string")) for c in timestamps})
    return df.withColumns(cols)


def round_columns(df: DataFrame, places: dict) -> DataFrame:
    """Per-column half-up rounding, names kept."""
    return df.withColumns({c: round_half_up(c, n) for c, n in places.items()})


def segments(df: DataFrame) -> DataFrame:
    """Distinct non-NULL segment ids, sorted."""
    return df.select(SEGMENT).where(F.col(SEGMENT).isNotNull()).distinct().orderBy(SEGMENT)


def date_bounds(df: DataFrame) -> DataFrame:
    """First and last calendar day present."""
    return df.agg(F.to_date(F.min(EVENT_TS)).alias("min_date"),
                  F.to_date(F.max(EVENT_TS)).alias("max_date"))
