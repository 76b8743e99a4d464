"""Table and message schemas (column names and types of the medallion layers)."""

from pyspark.sql.types import (DoubleType, StringType, StructField, StructType,
                               TimestampNTZType)

SEGMENT = "pipe_segment_id"
EVENT_ID = "event_id"
EVENT_TS = "event_timestamp"

SENSORS = ["pressure_psi", "flow_rate_lpm", "acoustic_g_rms", "temperature_c"]

# Physical sensor bounds (inclusive) used by the quality filter.
BOUNDS = {
    "pressure_psi": (100.0, 3000.0),
    "flow_rate_lpm": (0.0, 600.0),
    "acoustic_g_rms": (0.0, 10.0),
    "temperature_c": (-20.0, 200.0),
}

BATCH_FEATURES = ["pressure_rolling_avg", "flow_rolling_avg", "acoustic_rolling_avg",
                  "pressure_delta", "flow_imbalance_ratio", "acoustic_rolling_std",
                  "acoustic_zscore"]

# Model inputs of the isolation forest, in this order.
FOREST_FEATURES = ["pressure_psi", "flow_rate_lpm", "acoustic_g_rms", "temperature_c",
                   "pressure_delta", "flow_imbalance_ratio", "acoustic_zscore"]
SEQUENCE_FEATURES = list(SENSORS)


def bronze_schema(ts_type=TimestampNTZType()) -> StructType:
    return StructType([
        StructField("event_id", StringType(), False),
        StructField("pipe_segment_id", StringType(), False),
        StructField("event_timestamp", ts_type, False),
        StructField("pressure_psi", DoubleType(), True),
        StructField("flow_rate_lpm", DoubleType(), True),
        StructField("acoustic_g_rms", DoubleType(), True),
        StructField("temperature_c", DoubleType(), True),
        StructField("is_anomaly", StringType(), False),
        StructField("ingestion_ts", ts_type, False),
    ])


BRONZE_SCHEMA = bronze_schema()
BRONZE_COLUMNS = [f.name for f in BRONZE_SCHEMA.fields]

# JSON payload of a sensor message: every field nullable, time as ISO-8601 text.
MESSAGE_SCHEMA = StructType([
    StructField("event_id", StringType(), True),
    StructField("pipe_segment_id", StringType(), True),
    StructField("event_timestamp", StringType(), True),
    StructField("pressure_psi", DoubleType(), True),
    StructField("flow_rate_lpm", DoubleType(), True),
    StructField("acoustic_g_rms", DoubleType(), True),
    StructField("temperature_c", DoubleType(), True),
    StructField("is_anomaly", StringType(), True),
])
MESSAGE_FIELDS = [f.name for f in MESSAGE_SCHEMA.fields]

SILVER_COLUMNS = BRONZE_COLUMNS + BATCH_FEATURES
MICROBATCH_COLUMNS = BRONZE_COLUMNS + ["pressure_delta", "flow_imbalance", "acoustic_zscore"]

GOLD_COLUMNS = ["event_id", "pipe_segment_id", "event_timestamp", "pressure_psi",
                "flow_rate_lpm", "acoustic_g_rms", "temperature_c", "pressure_delta",
                "flow_imbalance_ratio", "acoustic_zscore", "anomaly_score", "severity",
                "alert_message", "is_anomaly"]

DUAL_GOLD_COLUMNS = ["event_id", "pipe_segment_id", "event_timestamp", "pressure_psi",
                     "flow_rate_lpm", "acoustic_g_rms", "temperature_c", "pressure_delta",
                     "flow_imbalance_ratio", "acoustic_zscore", "if_score", "if_anomaly",
                     "lstm_anomaly", "severity", "detection_source", "alert_message",
                     "is_anomaly"]

SEVERITIES = ["CRITICAL", "WARNING", "NORMAL"]

