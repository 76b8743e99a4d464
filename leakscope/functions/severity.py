"""Severity, alert text and label expressions (column expressions, no UDF).

All return ``Column`` objects so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Alert trigger thresholds and texts.
PRESSURE_DROP_BELOW = -100.0
FLOW_SPIKE_ABOVE = 1.25
ACOUSTIC_Z_ABOVE = 2.0
CRITICAL_CUT = -0.07
NO_TRIGGER_TEXT = "Multi-sensor anomaly"
LSTM_ONLY_TEXT = "Slow leak trend detected by LSTM"
BOTH_TEXT = "Confirmed by both IF and LSTM"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def severity_expr(pred="anomaly_prediction", score="anomaly_score",
                  cut: float = CRITICAL_CUT) -> Column:
    """H1: prediction 1 -> NORMAL; score <= cut -> CRITICAL; otherwise WARNING."""
    return (F.when(_c(pred) == 1, F.lit("NORMAL"))
            .when(_c(score) <= F.lit(cut), F.lit("CRITICAL"))
            .otherwise(F.lit("WARNING")))


def _fixed(x: Column, places: int, src_scale: int) -> Column:
    """Half-up decimal text with ``places`` digits (Python ``:.Nf`` on non-ties)."""
    r = F.round(x.cast(f"decimal(18,{src_scale})"), places)
    if places == 0:
        return r.cast("bigint").cast("string")
    return r.cast(f"decimal(18,{places})").cast("string")


def _triggers(delta, ratio, z) -> list[Column]:
    delta, ratio, z = _c(delta), _c(ratio), _c(z)
    return [
        F.when(delta < F.lit(PRESSURE_DROP_BELOW),
               F.concat(F.lit("Pressure drop "), _fixed(delta, 0, 2), F.lit(" PSI"))),
        F.when(ratio > F.lit(FLOW_SPIKE_ABOVE),
               F.concat(F.lit("Flow spike x"), _fixed(ratio, 2, 4))),
        F.when(F.abs(z) > F.lit(ACOUSTIC_Z_ABOVE),
               F.concat(F.lit("Acoustic anomaly z="), _fixed(z, 2, 4))),
    ]


def _join_or_default(parts: list[Column]) -> Column:
    joined = F.concat_ws("; ", *parts)  # NULL parts are skipped
    return F.when(joined == "", F.lit(NO_TRIGGER_TEXT)).otherwise(joined)


def alert_message_expr(severity="severity", delta="pressure_delta",
                       ratio="flow_imbalance_ratio", z="acoustic_zscore") -> Column:
    """H2: '' for NORMAL, else the triggered reasons joined by '; '."""
    return (F.when(_c(severity) == "NORMAL", F.lit(""))
            .otherwise(_join_or_default(_triggers(delta, ratio, z))))


def combined_severity_expr(if_flag="if_anomaly", seq_flag="lstm_anomaly") -> Column:
    """H3: both flags -> CRITICAL, one -> WARNING, none -> NORMAL."""
    a, b = _c(if_flag) == 1, _c(seq_flag) == 1
    return (F.when(a & b, F.lit("CRITICAL")).when(a | b, F.lit("WARNING"))
            .otherwise(F.lit("NORMAL")))


def detection_source_expr(if_flag="if_anomaly", seq_flag="lstm_anomaly") -> Column:
    """H4: BOTH / IF_ONLY / LSTM_ONLY / NONE."""
    a, b = _c(if_flag) == 1, _c(seq_flag) == 1
    return (F.when(a & b, F.lit("BOTH")).when(a, F.lit("IF_ONLY"))
            .when(b, F.lit("LSTM_ONLY")).otherwise(F.lit("NONE")))


def dual_message_expr(severity="severity", source="detection_source",
                      delta="pressure_delta", ratio="flow_imbalance_ratio",
                      z="acoustic_zscore") -> Column:
    """H5: H2 triggers plus a detector-specific suffix."""
    suffix = (F.when(_c(source) == "LSTM_ONLY", F.lit(LSTM_ONLY_TEXT))
              .when(_c(source) == "BOTH", F.lit(BOTH_TEXT)))
    return (F.when(_c(severity) == "NORMAL", F.lit(""))
            .otherwise(_join_or_default(_triggers(delta, ratio, z) + [suffix])))


def binary_label_expr(is_anomaly="is_anomaly", positive: str | None = None) -> Column:
    """H6: 1/0 label. ``positive=None`` -> anything but 'normal' is 1;
    ``positive='leak'`` -> only that class is 1."""
    c = _c(is_anomaly)
    cond = (c != F.lit("normal")) if positive is None else (c == F.lit(positive))
    return F.when(cond, F.lit(1)).otherwise(F.lit(0)).cast("int")
