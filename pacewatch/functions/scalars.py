"""Column -> Column helpers. All stay inside JVM code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pacewatch.schema import (
    DECISION_THRESHOLD,
    DEFAULT_POOL_SIZE,
    EPOCH_ORIGIN_SECONDS,
    HIGH_RISK_THRESHOLD,
    ONLINE_PREFIX,
    RATIO_EPSILON,
)

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- time ------------------------------------------------------------------------


def epoch_seconds(ts: ColumnOrName) -> Column:
    """Whole seconds since 1970, rounded down; accepts zoned and local timestamps."""
    return F.unix_seconds(col(ts).cast("timestamp"))


def event_date(ts: ColumnOrName) -> Column:
    return F.to_date(col(ts).cast("timestamp"))


def event_time(offset_seconds: ColumnOrName) -> Column:
    """Timestamp of an offset from the fixed dataset origin, to the microsecond."""
    micros = F.rint(col(offset_seconds) * 1_000_000).cast("long")
    return F.timestamp_micros(F.lit(EPOCH_ORIGIN_SECONDS * 1_000_000) + micros)


def iso_utc(ts: ColumnOrName) -> Column:
    """ISO-8601 text with a +00:00 offset; the fraction appears only when not zero."""
    t = col(ts).cast("timestamp")
    utc = F.to_utc_timestamp(t, F.current_timezone())
    has_fraction = F.unix_micros(t) % 1_000_000 != 0
    seconds = F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.concat(F.when(has_fraction, micros).otherwise(seconds), F.lit("+00:00"))


# -- identifiers -----------------------------------------------------------------


def double_text(x: ColumnOrName) -> Column:
    """Text of a double: positional from 1e-4 up to 1e16, exponent form outside."""
    java = col(x).cast("string")
    size = F.abs(col(x))
    plain = (size == 0) | ((size >= 1e-3) & (size < 1e7))
    positional = (size >= 1e-4) & (size < 1e16)
    digits = F.regexp_replace(java.try_cast("decimal(38,22)").cast("string"), "0+$", "")
    digits = F.when(digits.endswith("."), F.concat(digits, F.lit("0"))).otherwise(digits)
    mantissa = F.regexp_replace(F.split_part(java, F.lit("E"), F.lit(1)), r"\.0$", "")
    exponent = F.split_part(java, F.lit("E"), F.lit(2)).try_cast("int")
    sign = F.when(exponent < 0, "e-").otherwise("e+")
    scientific = F.concat(mantissa, sign, F.lpad(F.abs(exponent).cast("string"), 2, "0"))
    return F.when(plain, java).when(positional, digits).otherwise(F.coalesce(scientific, java))


def account_bucket(
    row_index: ColumnOrName, offset_seconds: ColumnOrName, pool_size: int = DEFAULT_POOL_SIZE
) -> Column:
    """Account id from the md5 of ``row:offset``, as a 128-bit number modulo the pool.

    The digest is folded in four 32-bit words, so each step stays below 2^63.
    """
    if not 0 < pool_size < 2**31:
        raise ValueError("pool_size must be between 1 and 2^31 - 1")
    text = F.concat(col(row_index).cast("string"), F.lit(":"), double_text(offset_seconds))
    digest = F.md5(text)
    bucket = F.lit(0).cast("long")
    for word in range(4):
        value = F.conv(F.substring(digest, 8 * word + 1, 8), 16, 10).cast("long")
        bucket = (bucket * F.lit(2**32) + value) % pool_size
    return F.format_string("user_%05d", bucket)


def transaction_id(row_index: ColumnOrName) -> Column:
    return F.format_string("txn_%08d", col(row_index))


# -- feature arithmetic ----------------------------------------------------------


def ratio(amount: ColumnOrName, base: ColumnOrName, eps: float = RATIO_EPSILON) -> Column:
    """Amount against a baseline; without a baseline the amount is its own baseline.

    An amount that makes the denominator exactly zero gives null instead of an error.
    """
    return F.try_divide(col(amount), F.coalesce(col(base), col(amount)) + F.lit(eps))


def zscore(x: ColumnOrName, mean: ColumnOrName, sd: ColumnOrName) -> Column:
    """0 while there is no spread to compare with."""
    flat = F.coalesce(col(sd), F.lit(0.0)) == 0
    return F.when(flat, F.lit(0.0)).otherwise((col(x) - col(mean)) / col(sd))


# -- decisions -------------------------------------------------------------------


def _decided(p: ColumnOrName) -> Column:
    """False where there is no probability to decide on."""
    return col(p).isNotNull() & ~F.isnan(col(p))


def risk_level(p: ColumnOrName, threshold: float = DECISION_THRESHOLD) -> Column:
    """Null without a probability."""
    return (
        F.when(~_decided(p), F.lit(None))
        .when(col(p) >= HIGH_RISK_THRESHOLD, "HIGH")
        .when(col(p) >= threshold, "MEDIUM")
        .otherwise("LOW")
    )


def decision(p: ColumnOrName, threshold: float = DECISION_THRESHOLD) -> Column:
    """Null without a probability: nothing is approved by default."""
    return F.when(~_decided(p), F.lit(None)).when(col(p) >= threshold, "DECLINE").otherwise("APPROVE")


def feature_source(fields: ColumnOrName) -> Column:
    """Where the profile came from; an empty profile counts as none."""
    present = F.size(col(fields)) > 0
    return F.when(present, "online").otherwise("cold_start")


# -- online rows -----------------------------------------------------------------


def online_key(user_id: ColumnOrName, prefix: str = ONLINE_PREFIX) -> Column:
    return F.concat(F.lit(prefix + ":"), col(user_id).cast("string"))


def decode_fields(fields: ColumnOrName) -> Column:
    """Text map -> numeric map; a value that is not a number becomes null."""
    return F.transform_values(col(fields), lambda _, v: v.try_cast("double"))
