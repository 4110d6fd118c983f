"""Point-in-time rolling aggregates per account.

Every frame covers ``[t - length, t - 1]`` in whole seconds, so a row never sees itself
or anything in its own second. Two plans give the same numbers:

* native: one shuffle by account, one sort, Spark's own RANGE frames. Cost per account
  grows with rows x frame width and an account is one task, which is right for the
  great mass of small accounts.
* paned (:mod:`pacewatch.operators.panes`): for accounts too large for one task.

``rolling`` routes accounts between them by their row count.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pacewatch.operators.panes import paned_rolling
from pacewatch.schema import WINDOWS

# Above this many rows an account leaves the one-task plan: 20,000 rows that all lie
# in one frame cost at most 2e8 frame updates in that task.
HOT_ROWS = 20_000
# The hot keys are shipped to every task; with more keys than this, all accounts take
# the paned plan instead, which needs no key list.
MAX_HOT_KEYS = 10_000

_AGGREGATES = {
    "count": F.count,
    "sum": F.sum,
    "avg": F.avg,
    "max": F.max,
    "min": F.min,
    "stddev": F.stddev_samp,
}


def native_rolling(
    df: DataFrame,
    frames: Mapping[str, tuple[str, str]],
    gap: str | None = None,
    *,
    key: str = "user_id",
    seconds: str = "event_time_unix",
    value: str = "amount",
    ident: str = "transaction_id",
    windows: Mapping[str, int] = WINDOWS,
) -> DataFrame:
    """All frames in one Window over one shuffle and one sort.

    The gap is computed first: its finer order (second, id) also serves the frames,
    so no second sort is planned.
    """
    by_account = Window.partitionBy(key)
    if gap:
        previous = F.lag(seconds).over(by_account.orderBy(seconds, ident))
        df = df.withColumn(gap, F.col(seconds) - previous)

    def frame(agg: str, window: str) -> Column:
        source = ident if agg == "count" else value
        span = by_account.orderBy(seconds).rangeBetween(-windows[window], -1)
        return _AGGREGATES[agg](source).over(span)

    return df.select("*", *[frame(*spec).alias(name) for name, spec in frames.items()])


def hot_keys(df: DataFrame, key: str = "user_id", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Accounts with more than ``hot_rows`` rows: a one-column scan, pre-aggregated."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > hot_rows).select(key)


def rolling(
    df: DataFrame,
    frames: Mapping[str, tuple[str, str]],
    gap: str | None = None,
    *,
    key: str = "user_id",
    seconds: str = "event_time_unix",
    value: str = "amount",
    ident: str = "transaction_id",
    windows: Mapping[str, int] = WINDOWS,
    hot_rows: int = HOT_ROWS,
    count_from: DataFrame | None = None,
) -> DataFrame:
    """Add ``frames`` (output -> (aggregate, window)) and the gap column to ``df``.

    Runs one small counting job to find large accounts. ``count_from`` names a cheaper
    table to count in, such as the raw events before deduplication: it may only
    overstate an account, which moves it to the other plan and changes no result.
    """
    columns = dict(key=key, seconds=seconds, value=value, ident=ident, windows=windows)
    counted = df if count_from is None else count_from
    found = hot_keys(counted, key, hot_rows).limit(MAX_HOT_KEYS + 1).collect()
    if not found:
        return native_rolling(df, frames, gap, **columns)
    if len(found) > MAX_HOT_KEYS:
        return paned_rolling(df, frames, gap, **columns)
    hot = df.sparkSession.createDataFrame(
        [(row[0],) for row in found], f"_hot {df.schema[key].dataType.simpleString()}"
    )
    is_hot = F.col(key).eqNullSafe(F.col("_hot"))
    large = df.join(F.broadcast(hot), is_hot, "left_semi")
    small = df.join(F.broadcast(hot), is_hot, "left_anti")
    return native_rolling(small, frames, gap, **columns).unionByName(
        paned_rolling(large, frames, gap, **columns)
    )
