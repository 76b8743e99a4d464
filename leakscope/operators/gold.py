"""Gold assembly: severity and alert text on scored Silver rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leakscope.functions.severity import CRITICAL_CUT, alert_message_expr, severity_expr
from leakscope.schemas import GOLD_COLUMNS


def prediction_from_score(score: str = "anomaly_score"):
    """J5 decision rule: -1 (anomaly) when the offset score is negative."""
    return F.when(F.col(score) < 0, F.lit(-1)).otherwise(F.lit(1)).cast("int")


def classify(scored: DataFrame, cut: float = CRITICAL_CUT) -> DataFrame:
    """Adds ``severity`` and ``alert_message`` to rows carrying
    ``anomaly_prediction`` and ``anomaly_score``."""
    return (scored.withColumn("severity", severity_expr(cut=cut))
            .withColumn("alert_message", alert_message_expr()))


def gold_table(classified: DataFrame, with_clock: bool = True, extra: list[Column] = ()) -> DataFrame:
    """The Gold projection (+ ``gold_ts`` written with the rows, X8)."""
    out = classified.select(*GOLD_COLUMNS, *extra)
    return out.withColumn("gold_ts", F.current_timestamp()) if with_clock else out
