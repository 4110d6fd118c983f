"""Account profiles as expiring key-value rows, and lookups into them."""

from __future__ import annotations

import contextlib
import itertools
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from pacewatch.functions.scalars import decode_fields, online_key
from pacewatch.schema import ONLINE_FLUSH_ROWS, ONLINE_PREFIX, ONLINE_TTL_SECONDS


def _as_text(df: DataFrame, name: str) -> Column:
    """Text of a field; times become epoch seconds so that every value reads as a number."""
    kind = df.schema[name].dataType.typeName()
    value = F.col(name)
    if kind.startswith("timestamp"):
        value = F.unix_seconds(value.cast("timestamp"))
    return F.coalesce(value.cast("string"), F.lit("0"))


def to_online_hashes(
    profiles: DataFrame,
    prefix: str = ONLINE_PREFIX,
    ttl: int = ONLINE_TTL_SECONDS,
    now: Column | None = None,
    key: str = "user_id",
) -> DataFrame:
    """(key, fields, expires_at) per account; nulls are written as "0"."""
    clock = F.current_timestamp() if now is None else now.cast("timestamp")
    names = [c for c in profiles.columns if c != key]
    fields = F.map_from_arrays(
        F.array(*[F.lit(c) for c in names]), F.array(*[_as_text(profiles, c) for c in names])
    )
    return profiles.select(
        online_key(key, prefix).alias("key"),
        fields.alias("fields"),
        (clock + F.make_dt_interval(secs=F.lit(ttl))).alias("expires_at"),
    )


def merge_online(stored: DataFrame, fresh: DataFrame, now: Column | None = None) -> DataFrame:
    """Store contents after a sync: fields merge per key, fresh values win.

    A synced key lives as long as its fresh row says. Rows that had expired before the
    sync are gone. Keys are unique on both sides, so the join is one to one.
    """
    clock = F.current_timestamp() if now is None else now.cast("timestamp")
    alive = stored.filter(F.col("expires_at") > clock).select(
        "key", F.col("fields").alias("_old"), F.col("expires_at").alias("_old_expiry")
    )
    kept = F.map_filter(
        "_old", lambda name, _: F.col("fields").isNull() | ~F.map_contains_key("fields", name)
    )
    nothing = F.map_from_arrays(
        F.array().cast("array<string>"), F.array().cast("array<string>")
    )
    return fresh.join(alive, "key", "full_outer").select(
        "key",
        F.map_concat(F.coalesce(kept, nothing), F.coalesce("fields", nothing)).alias("fields"),
        F.coalesce("expires_at", "_old_expiry").alias("expires_at"),
    )


def write_online(
    hashes: DataFrame,
    make_client: Callable[[], object],
    batch: int = ONLINE_FLUSH_ROWS,
    ttl: int = ONLINE_TTL_SECONDS,
) -> None:
    """Push rows to a key-value store: one client per task, one pipeline per ``batch`` accounts.

    ``make_client`` runs on executors and returns an object with the usual pipeline calls
    (``pipeline``, ``hset``, ``expire``, ``execute``, ``close``). Writing a row twice gives
    the same hash, so neither a retried task nor a chunk that is sent once more after a
    lost connection does harm.
    """

    def send(client, rows: tuple[Row, ...]) -> None:
        for last_try in (False, True):
            try:
                commands = client.pipeline(transaction=False)
                for key, fields in rows:
                    commands.hset(key, mapping=fields)
                    commands.expire(key, ttl)
                commands.execute()
                return
            except (ConnectionError, TimeoutError):
                if last_try:
                    raise

    def write_partition(rows: Iterator[Row]) -> None:
        with contextlib.closing(make_client()) as client:
            for chunk in itertools.batched(rows, batch):
                send(client, chunk)

    hashes.select("key", "fields").foreachPartition(write_partition)


def lookup_features(
    txns: DataFrame, hashes: DataFrame, now: Column | None = None, prefix: str = ONLINE_PREFIX
) -> DataFrame:
    """Add ``fields``, the account's numeric profile, or null for a miss.

    Expired rows drop out before the join. The profile side has one row per key, so a
    crowded account on the transaction side can be split freely; whether the profiles are
    small enough to ship is left to their measured size.
    """
    clock = F.current_timestamp() if now is None else now.cast("timestamp")
    alive = hashes.filter((F.col("expires_at") > clock) & (F.size("fields") > 0)).select(
        F.col("key").alias("_key"), decode_fields("fields").alias("fields")
    )
    return txns.join(alive, online_key("user_id", prefix) == F.col("_key"), "left").drop("_key")
