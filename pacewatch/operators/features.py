"""Transaction-level and account-level feature tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacewatch.functions.scalars import ratio, zscore
from pacewatch.operators.rolling import HOT_ROWS, rolling
from pacewatch.schema import (
    SPEND_FRAMES,
    TRANSACTION_FEATURE_COLUMNS,
    VELOCITY_FRAMES,
    VOLATILITY_FRAMES,
)

GAP = "seconds_since_last_txn"
_KEYS = ["transaction_id", "user_id", "event_time"]
_FRAME_INPUT = ["transaction_id", "user_id", "event_time", "event_time_unix", "amount"]


def velocity_features(staged: DataFrame, **routing) -> DataFrame:
    """How often the account transacted recently, and the gap to its previous one."""
    framed = rolling(staged.select(*_FRAME_INPUT), VELOCITY_FRAMES, GAP, **routing)
    return framed.select(*_KEYS, *VELOCITY_FRAMES, GAP)


def _with_spend_ratios(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "amount_vs_avg_24h": ratio("amount", "avg_amount_24h"),
            "amount_vs_max_7d": ratio("amount", "max_amount_7d"),
        }
    )


def spend_features(staged: DataFrame, **routing) -> DataFrame:
    """Recent spend level and the amount against it."""
    framed = _with_spend_ratios(rolling(staged.select(*_FRAME_INPUT), SPEND_FRAMES, **routing))
    return framed.select(*_KEYS, *SPEND_FRAMES, "amount_vs_avg_24h", "amount_vs_max_7d")


def _with_zscore(df: DataFrame) -> DataFrame:
    return df.withColumn("amount_zscore_7d", zscore("amount", "avg_amount_7d", "amount_stddev_7d"))


def volatility_features(staged: DataFrame, **routing) -> DataFrame:
    """Recent spread of amounts and the amount's z-score."""
    framed = _with_zscore(rolling(staged.select(*_FRAME_INPUT), VOLATILITY_FRAMES, **routing))
    return framed.select(*_KEYS, "amount_stddev_24h", "amount_stddev_7d", "amount_zscore_7d")


def fill_defaults(df: DataFrame) -> DataFrame:
    """Values of a transaction without usable history. The gap stays null."""
    zeros = {c: F.lit(0).cast("long") for c in VELOCITY_FRAMES}
    zeros |= {
        c: F.lit(0.0)
        for c in (
            "total_amount_1h",
            "total_amount_24h",
            "amount_stddev_24h",
            "amount_stddev_7d",
            "amount_zscore_7d",
        )
    }
    own = {c: F.col("amount") for c in ("avg_amount_24h", "max_amount_24h", "min_amount_24h")}
    ones = {c: F.lit(1.0) for c in ("amount_vs_avg_24h", "amount_vs_max_7d")}
    return df.withColumns(
        {c: F.coalesce(F.col(c), default) for c, default in (zeros | own | ones).items()}
    )


def completed(framed: DataFrame) -> DataFrame:
    """Frames and gap of each row -> all rolling columns, with defaults where there is no history."""
    computed = _with_zscore(_with_spend_ratios(framed))
    frames = VELOCITY_FRAMES | SPEND_FRAMES | VOLATILITY_FRAMES
    feature_names = [*frames, GAP, "amount_vs_avg_24h", "amount_vs_max_7d", "amount_zscore_7d"]
    known = F.col("transaction_id").isNotNull()
    return fill_defaults(computed.withColumns({c: F.when(known, F.col(c)) for c in feature_names}))


def transaction_features(
    staged: DataFrame,
    hot_rows: int = HOT_ROWS,
    count_from: DataFrame | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """The transaction feature table in one window pass, without joins.

    A row without an id has nothing to be looked up by, so its features take the
    defaults, exactly as a join on the id would leave them.
    """
    frames = VELOCITY_FRAMES | SPEND_FRAMES | VOLATILITY_FRAMES
    framed = rolling(staged, frames, GAP, hot_rows=hot_rows, count_from=count_from)
    return completed(framed).select(*TRANSACTION_FEATURE_COLUMNS, *keep)


def assemble_features(
    base: DataFrame, velocity: DataFrame, spend: DataFrame, volatility: DataFrame
) -> DataFrame:
    """The same table from three separately built feature sets, joined on the id.

    Kept for feature sets that already exist as tables. Ids are unique on both sides,
    so each join is one to one.
    """
    joined = base
    for features in (velocity, spend, volatility):
        joined = joined.join(features.drop("user_id", "event_time"), "transaction_id", "left")
    return fill_defaults(joined).select(*TRANSACTION_FEATURE_COLUMNS)


def account_features(features: DataFrame, fill_nulls: bool = True) -> DataFrame:
    """One profile per account. Partial aggregation keeps a huge account cheap."""
    profiles = features.groupBy("user_id").agg(
        F.count("transaction_id").alias("total_txn_count"),
        F.max("event_time").alias("last_transaction_time"),
        F.avg("amount").alias("avg_amount_all_time"),
        F.max("amount").alias("max_amount_all_time"),
        F.stddev_samp("amount").alias("amount_stddev_all_time"),
        F.sum("amount").alias("total_spend_all_time"),
        *[F.avg(f"txn_count_{w}").alias(f"avg_velocity_{w}") for w in ("1h", "24h", "7d")],
        F.max("txn_count_1h").alias("max_velocity_1h"),
        F.avg("total_amount_24h").alias("avg_daily_spend"),
        F.avg("amount_stddev_24h").alias("avg_amount_volatility"),
        F.avg("amount_vs_avg_24h").alias("avg_amount_ratio"),
        *[F.avg(f"V{i}").alias(f"avg_v{i}") for i in range(1, 6)],
    )
    return profiles.fillna(0) if fill_nulls else profiles
