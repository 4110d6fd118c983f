"""Schemas, column lists and constants shared by every module.

Everything in this file is a fixed value of the data contract: field names, field
order, defaults, window lengths and thresholds that results depend on.
"""

from __future__ import annotations

from pyspark.sql import types as T

V_COLUMNS = [f"V{i}" for i in range(1, 29)]

WINDOWS = {"1h": 3600, "24h": 86400, "7d": 604800}

EPOCH_ORIGIN_SECONDS = 1704067200  # 2024-01-01T00:00:00Z
DEFAULT_POOL_SIZE = 5000

RATIO_EPSILON = 0.01

RAW_CSV_SCHEMA = T.StructType(
    [T.StructField("Time", T.DoubleType())]
    + [T.StructField(v, T.DoubleType()) for v in V_COLUMNS]
    + [T.StructField("Amount", T.DoubleType()), T.StructField("Class", T.IntegerType())]
)

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("event_time", T.StringType()),
        T.StructField("time_offset_seconds", T.DoubleType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("is_fraud", T.IntegerType()),
        T.StructField("produced_at", T.StringType()),
    ]
    + [T.StructField(v, T.DoubleType()) for v in V_COLUMNS]
)

# What a topic source hands over; file-backed streams in tests use the same columns.
TOPIC_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

STAGED_COLUMNS = [
    "transaction_id",
    "user_id",
    "event_time",
    "event_time_unix",
    "event_date",
    "amount",
    "is_fraud",
    *V_COLUMNS,
]

# output column -> (aggregate, window name)
VELOCITY_FRAMES = {
    "txn_count_1h": ("count", "1h"),
    "txn_count_24h": ("count", "24h"),
    "txn_count_7d": ("count", "7d"),
}
SPEND_FRAMES = {
    "total_amount_1h": ("sum", "1h"),
    "total_amount_24h": ("sum", "24h"),
    "avg_amount_24h": ("avg", "24h"),
    "max_amount_24h": ("max", "24h"),
    "min_amount_24h": ("min", "24h"),
    "max_amount_7d": ("max", "7d"),
}
VOLATILITY_FRAMES = {
    "amount_stddev_24h": ("stddev", "24h"),
    "amount_stddev_7d": ("stddev", "7d"),
    "avg_amount_7d": ("avg", "7d"),
}

ROLLING_COLUMNS = [
    "txn_count_1h",
    "txn_count_24h",
    "txn_count_7d",
    "seconds_since_last_txn",
    "total_amount_1h",
    "total_amount_24h",
    "avg_amount_24h",
    "max_amount_24h",
    "min_amount_24h",
    "amount_vs_avg_24h",
    "amount_vs_max_7d",
    "amount_stddev_24h",
    "amount_stddev_7d",
    "amount_zscore_7d",
]

TRANSACTION_FEATURE_COLUMNS = [
    "transaction_id",
    "user_id",
    "event_time",
    "event_date",
    "amount",
    "is_fraud",
    *ROLLING_COLUMNS,
    *V_COLUMNS,
]

ACCOUNT_FEATURE_COLUMNS = [
    "user_id",
    "total_txn_count",
    "last_transaction_time",
    "avg_amount_all_time",
    "max_amount_all_time",
    "amount_stddev_all_time",
    "total_spend_all_time",
    "avg_velocity_1h",
    "avg_velocity_24h",
    "avg_velocity_7d",
    "max_velocity_1h",
    "avg_daily_spend",
    "avg_amount_volatility",
    "avg_amount_ratio",
    "avg_v1",
    "avg_v2",
    "avg_v3",
    "avg_v4",
    "avg_v5",
]

MODEL_ROLLING_COLUMNS = [
    "txn_count_1h",
    "txn_count_24h",
    "txn_count_7d",
    "total_amount_1h",
    "total_amount_24h",
    "avg_amount_24h",
    "max_amount_24h",
    "min_amount_24h",
    "amount_vs_avg_24h",
    "amount_vs_max_7d",
    "amount_stddev_24h",
    "amount_stddev_7d",
]
MODEL_V_COLUMNS = [f"V{i}" for i in (*range(1, 13), 14, 16, 17, 18, 19, 21)]
# Vector order matters to a fitted model.
MODEL_COLUMNS = [*MODEL_ROLLING_COLUMNS, *MODEL_V_COLUMNS, "amount"]

# Profile fields read at scoring time, with the value of an account without history.
PROFILE_DEFAULTS = {
    "avg_velocity_1h": 0.0,
    "avg_velocity_24h": 0.0,
    "avg_velocity_7d": 0.0,
    "avg_daily_spend": 0.0,
    "avg_amount_all_time": 0.0,
    "max_amount_all_time": 0.0,
    "avg_amount_volatility": 0.0,
    "amount_stddev_all_time": 0.0,
}

ONLINE_PREFIX = "user_features"
ONLINE_TTL_SECONDS = 86400
ONLINE_FLUSH_ROWS = 500

DECISION_THRESHOLD = 0.30
HIGH_RISK_THRESHOLD = 0.50

GBT_PARAMS = {
    "maxIter": 200,
    "maxDepth": 4,
    "stepSize": 0.05,
    "subsamplingRate": 0.8,
    "minInstancesPerNode": 20,
    "seed": 42,
}
OVERSAMPLE_RATIO = 0.1
OVERSAMPLE_NEIGHBOURS = 5
TRAIN_FRACTION = 0.80
