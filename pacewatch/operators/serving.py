"""Score transactions: validate, look up, build the vector, predict, decide, record."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacewatch.functions.scalars import decision, feature_source, ratio, risk_level
from pacewatch.operators.online import lookup_features
from pacewatch.schema import (
    DECISION_THRESHOLD,
    MODEL_COLUMNS,
    MODEL_V_COLUMNS,
    PROFILE_DEFAULTS,
)

PROBABILITY_DIGITS = 4


def validate(txns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): a request needs both ids and a positive amount that is a number."""
    reason = refusal()
    return txns.filter(reason.isNull()), txns.filter(reason.isNotNull())


def refusal() -> Column:
    """Why a request is refused, or null."""
    amount = F.col("amount").cast("double")
    return (
        F.when(F.col("transaction_id").isNull(), "no transaction_id")
        .when(F.col("user_id").isNull(), "no user_id")
        .when(amount.isNull() | F.isnan(amount), "amount is not a number")
        .when(amount <= 0, "amount is not positive")
    )


def proxy_vector(
    df: DataFrame, fields: str = "fields", defaults: Mapping[str, float] = PROFILE_DEFAULTS
) -> DataFrame:
    """Replace rolling features by the nearest all-time figures of the account's profile.

    ``defaults`` hold for fields the profile lacks. An all-time average or maximum of 0
    means no history, as does a missing one: the transaction's own amount stands in.
    """
    amount = F.col("amount").cast("double")

    def field(name: str) -> Column:
        return F.coalesce(F.try_element_at(F.col(fields), F.lit(name)), F.lit(float(defaults[name])))

    def or_amount(name: str) -> Column:
        return F.coalesce(F.nullif(field(name), F.lit(0.0)), amount)

    usual, largest = or_amount("avg_amount_all_time"), or_amount("max_amount_all_time")
    per_hour = field("avg_velocity_1h")
    values = {
        "txn_count_1h": per_hour,
        "txn_count_24h": field("avg_velocity_24h"),
        "txn_count_7d": field("avg_velocity_7d"),
        "total_amount_1h": amount * per_hour,
        "total_amount_24h": field("avg_daily_spend"),
        "avg_amount_24h": usual,
        "max_amount_24h": largest,
        "min_amount_24h": amount,
        "amount_vs_avg_24h": ratio(amount, usual),
        "amount_vs_max_7d": ratio(amount, largest),
        "amount_stddev_24h": field("avg_amount_volatility"),
        "amount_stddev_7d": field("amount_stddev_all_time"),
        "amount": amount,
    }
    for v in MODEL_V_COLUMNS:
        given = F.col(v).cast("double") if v in df.columns else F.lit(None).cast("double")
        values[v] = F.coalesce(given, F.lit(0.0))
    rest = [c for c in df.columns if c not in values]
    return df.select(*rest, *[values[c].alias(c) for c in MODEL_COLUMNS])


def population_defaults(profiles: DataFrame) -> dict[str, float]:
    """Means of the profiles, as defaults for accounts without one; one row leaves the cluster."""
    names = [c for c in PROFILE_DEFAULTS if c in profiles.columns]
    means = profiles.agg(*[F.avg(c).alias(c) for c in names]).first()
    return {c: float(means[c]) if c in names and means[c] is not None else d for c, d in PROFILE_DEFAULTS.items()}


def score(
    txns: DataFrame,
    hashes: DataFrame,
    predict: Callable[[DataFrame], DataFrame],
    threshold: float = DECISION_THRESHOLD,
    now: Column | None = None,
    defaults: Mapping[str, float] = PROFILE_DEFAULTS,
) -> DataFrame:
    """One row per valid transaction; works on a batch or on a stream of requests.

    ``predict`` adds ``probability`` to a frame that holds the model columns. Decisions
    use the exact probability, only the reported one is rounded. Without a probability
    the decision is null. ``defaults`` stand in for missing profile fields; see
    :func:`population_defaults`.
    """
    accepted, _ = validate(txns)
    vectors = proxy_vector(lookup_features(accepted, hashes, now), defaults=defaults)
    p = F.col("probability")
    return predict(vectors).select(
        "transaction_id",
        "user_id",
        "amount",
        F.round(p, PROBABILITY_DIGITS).alias("fraud_probability"),
        risk_level(p, threshold).alias("risk_level"),
        decision(p, threshold).alias("decision"),
        F.lit(float(threshold)).alias("threshold"),
        feature_source("fields").alias("feature_source"),
    )


def rejects(txns: DataFrame, scored: DataFrame | None = None) -> DataFrame:
    """(transaction_id, user_id, amount, reason) of every request that got no decision."""
    columns = ["transaction_id", "user_id", F.col("amount").cast("double").alias("amount")]
    refused = txns.select(*columns, refusal().alias("reason")).filter("reason is not null")
    if scored is None:
        return refused
    undecided = scored.filter("decision is null").select(*columns, F.lit("no probability").alias("reason"))
    return refused.unionByName(undecided)


def audit_records(scored: DataFrame, now: Column | None = None) -> DataFrame:
    """Scored rows -> one JSON text each, for an append-only decision log."""
    clock = F.current_timestamp() if now is None else now.cast("timestamp")
    at = F.date_format(F.to_utc_timestamp(clock, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    record = F.struct(
        F.lit("fraud_decision").alias("event"),
        "transaction_id",
        "user_id",
        "amount",
        "fraud_probability",
        "decision",
        "threshold",
        "feature_source",
        at.alias("timestamp"),
    )
    return scored.select("transaction_id", F.to_json(record).alias("record"))
