"""Rolling aggregates for accounts that are too large for one task.

A frame ``[t - L, t - 1]`` is cut along fixed panes (a minute by default; L is a whole
number of panes), which leaves three parts that never overlap:

    seconds of pane p - L/pane from t - L on   (head)
    panes between, whole                        (middle)
    seconds of t's own pane before t            (tail)

Steps, each of bounded size per task whatever the account holds:

1. Rows collapse to one row per (account, second) with map-side combine. All rows of a
   second share their frames, so nothing is lost.
2. (account, second) rows go to (account, chunk of days) tasks. The rows of the last
   ``max(L)`` before a chunk are copied into it as context.
3. Inside a chunk, seconds fold into panes and one Window over panes yields the middle
   aggregates and the head panes.
4. Frames join back to the rows on (account, second); a crowded second is split by
   adaptive skew-join handling, because the frame side has one row per second.

Moments are merged as squared deviations from the frame mean. Every term is positive,
so there is no cancellation between large sums.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pacewatch.schema import WINDOWS

PANE_SECONDS = 60
CHUNK_SECONDS = 14 * 86400


def _total(values: Column, zero: Column) -> Column:
    return F.aggregate(values, zero, lambda a, b: a + b)


def _deviation(parts: Column, mean: Column) -> Column:
    """Sum of squared deviations of all values in ``parts`` from ``mean``."""
    return F.aggregate(
        parts,
        F.lit(0.0),
        lambda acc, p: acc + p["m2"] + p["n"] * (p["m"] - mean) * (p["m"] - mean),
    )


def _since(parts: Column, start: Column) -> Column:
    return F.filter(parts, lambda p: p["_t"] >= start)


def paned_rolling(
    df: DataFrame,
    frames: Mapping[str, tuple[str, str]],
    gap: str | None = None,
    *,
    key: str = "user_id",
    seconds: str = "event_time_unix",
    value: str = "amount",
    ident: str = "transaction_id",
    windows: Mapping[str, int] = WINDOWS,
    pane: int = PANE_SECONDS,
    chunk: int = CHUNK_SECONDS,
) -> DataFrame:
    """Same result as ``native_rolling``; see the module text for the plan."""
    used = {w: windows[w] for _, w in frames.values()}
    reach = max(used.values())
    if any(length % pane or length < 2 * pane for length in used.values()):
        raise ValueError("each window must be a whole number of panes, at least two")
    if chunk % pane or chunk < reach:
        raise ValueError("chunk must be a whole number of panes and cover the longest window")
    spread = {w for agg, w in frames.values() if agg == "stddev"}

    rows = df.select(
        F.col(key).alias("_k"), F.col(seconds).alias("_t"), F.col(value).alias("_v"), F.col(ident).alias("_id")
    )
    chunk_of = F.floor(F.col("_t") / chunk).cast("long")

    per_second = rows.groupBy("_k", "_t").agg(
        F.count("_id").alias("ids"),
        F.count("_v").alias("n"),
        F.coalesce(F.sum("_v"), F.lit(0.0)).alias("s"),
        F.coalesce(F.avg("_v"), F.lit(0.0)).alias("m"),
        F.coalesce(F.var_pop("_v") * F.count("_v"), F.lit(0.0)).alias("m2"),
        F.max("_v").alias("hi"),
        F.min("_v").alias("lo"),
        F.min("_id").alias("first_id"),
        (F.count(F.lit(1)) > F.count("_id")).alias("null_id"),
    )
    is_context = F.col("_t") - F.col("_c") * chunk >= chunk - reach
    placed = (
        per_second.withColumn("_c", chunk_of)
        .withColumn("_home", F.col("_c"))
        .withColumn(
            "_c",
            F.explode(
                F.when(is_context, F.array(F.col("_c"), F.col("_c") + 1)).otherwise(F.array("_c"))
            ),
        )
        .withColumn("own", F.col("_c").eqNullSafe(F.col("_home")))
        .drop("_home")
    )
    if gap:
        placed = placed.unionByName(_last_before(rows, chunk_of), allowMissingColumns=True)

    part = F.struct("_t", "ids", "n", "s", "m", "m2", "hi", "lo", "own", "first_id", "null_id")
    panes = (
        placed.repartition("_k", "_c")
        .groupBy("_k", "_c", F.floor(F.col("_t") / pane).cast("long").alias("_p"))
        .agg(
            F.collect_list(part).alias("parts"),
            F.sum("ids").alias("ids"),
            F.sum("n").alias("n"),
            F.sum("s").alias("s"),
            F.max("hi").alias("hi"),
            F.min("lo").alias("lo"),
            F.max("_t").alias("last_t"),
        )
        .withColumn("m", F.coalesce(F.try_divide("s", F.col("n")), F.lit(0.0)))
        .withColumn("m2", _deviation(F.col("parts"), F.col("m")))
    )

    by_chunk = Window.partitionBy("_k", "_c").orderBy("_p")
    columns: list[Column] = [F.lag("last_t").over(by_chunk).alias("before_t")]
    for w, length in used.items():
        k = length // pane
        between = by_chunk.rangeBetween(-(k - 1), -1)
        columns += [
            F.coalesce(F.sum("ids").over(between), F.lit(0)).alias(f"ids_{w}"),
            F.coalesce(F.sum("n").over(between), F.lit(0)).alias(f"n_{w}"),
            F.coalesce(F.sum("s").over(between), F.lit(0.0)).alias(f"s_{w}"),
            F.max("hi").over(between).alias(f"hi_{w}"),
            F.min("lo").over(between).alias(f"lo_{w}"),
            F.first("parts").over(by_chunk.rangeBetween(-k, -k)).alias(f"head_{w}"),
        ]
        if w in spread:
            columns.append(F.collect_list(F.struct("n", "m", "m2")).over(between).alias(f"list_{w}"))
    middle = panes.select("_k", "parts", *columns)
    # The pane lists shrink to three numbers before rows multiply again.
    for w in spread:
        middle = middle.withColumn(
            f"m_{w}", F.coalesce(F.try_divide(F.col(f"s_{w}"), F.col(f"n_{w}")), F.lit(0.0))
        ).withColumn(f"m2_{w}", _deviation(F.col(f"list_{w}"), F.col(f"m_{w}")))
    middle = middle.drop(*[f"list_{w}" for w in spread])

    opened = middle.withColumn("at", F.explode(F.filter("parts", lambda p: p["own"])))
    here = F.col("at._t")
    tail = F.filter("parts", lambda p: p["_t"] < here)
    nothing = F.filter("parts", lambda p: F.lit(False))
    opened = opened.withColumn("tail", tail)
    for w, length in used.items():
        head = _since(F.col(f"head_{w}"), here - length)
        opened = opened.withColumn(f"rest_{w}", F.concat("tail", F.coalesce(head, nothing)))
    ends = []
    for w in used:
        rest = F.col(f"rest_{w}")
        ends += [
            (F.col(f"ids_{w}") + _total(rest["ids"], F.lit(0).cast("long"))).alias(f"ids_{w}"),
            (F.col(f"n_{w}") + _total(rest["n"], F.lit(0).cast("long"))).alias(f"n_{w}"),
            (F.col(f"s_{w}") + _total(rest["s"], F.lit(0.0))).alias(f"s_{w}"),
            F.greatest(f"hi_{w}", F.array_max(rest["hi"])).alias(f"hi_{w}"),
            F.least(f"lo_{w}", F.array_min(rest["lo"])).alias(f"lo_{w}"),
        ]
        if w in spread:
            ends += [rest, F.col(f"n_{w}").alias(f"nm_{w}"), F.col(f"m_{w}"), F.col(f"m2_{w}")]
    framed = opened.select(
        "_k",
        here.alias("_t"),
        F.col("at.first_id").alias("_first_id"),
        F.col("at.null_id").alias("_null_id"),
        F.coalesce(F.array_max(F.col("tail")["_t"]), F.col("before_t")).alias("_before_t"),
        *ends,
    )
    for w in spread:
        mean = F.col(f"mean_{w}")
        off = F.col(f"m_{w}") - mean
        framed = framed.withColumn(
            f"mean_{w}", F.coalesce(F.try_divide(F.col(f"s_{w}"), F.col(f"n_{w}")), F.lit(0.0))
        ).withColumn(
            f"m2_{w}",
            F.col(f"m2_{w}") + F.col(f"nm_{w}") * off * off + _deviation(F.col(f"rest_{w}"), mean),
        )

    def output(agg: str, w: str) -> Column:
        n = F.col(f"n_{w}")
        if agg == "count":
            return F.col(f"ids_{w}")
        if agg == "sum":
            return F.when(n > 0, F.col(f"s_{w}"))
        if agg == "avg":
            return F.when(n > 0, F.col(f"s_{w}") / n)
        if agg == "max":
            return F.col(f"hi_{w}")
        if agg == "min":
            return F.col(f"lo_{w}")
        # NaN equals NaN here, but neither NaN nor an infinity has a spread of zero.
        flat = (F.col(f"hi_{w}") == F.col(f"lo_{w}")) & (F.abs(f"hi_{w}") < float("inf"))
        return F.when((n > 1) & flat, F.lit(0.0)).when(n > 1, F.sqrt(F.col(f"m2_{w}") / (n - 1)))

    framed = framed.select(
        F.col("_k").alias("_fk"),
        F.col("_t").alias("_ft"),
        "_first_id",
        "_null_id",
        "_before_t",
        *[output(*spec).alias(name) for name, spec in frames.items()],
    )
    joined = df.join(
        framed, F.col(key).eqNullSafe(F.col("_fk")) & F.col(seconds).eqNullSafe(F.col("_ft")), "left"
    )
    if gap:
        leads = F.when(F.col("_null_id"), F.col(ident).isNull()).otherwise(
            F.col(ident) == F.col("_first_id")
        )
        joined = joined.withColumn(
            gap, F.when(leads, F.col(seconds) - F.col("_before_t")).otherwise(F.col(seconds) - F.col(seconds))
        )
    return joined.select(*df.columns, *([gap] if gap else []), *frames)


def _last_before(rows: DataFrame, chunk_of: Column) -> DataFrame:
    """Per (account, chunk) the account's last second in any earlier chunk.

    It enters the chunk as a row that holds no values, so gaps longer than the context
    come out right. One row per account and active chunk is sorted, not one per event.
    """
    last = rows.groupBy("_k", chunk_of.alias("_c")).agg(F.max("_t").alias("_t"))
    earlier = F.lag("_t").over(Window.partitionBy("_k").orderBy("_c"))
    return last.select(
        "_k",
        "_c",
        earlier.alias("_t"),
        *[F.lit(0).cast("long").alias(c) for c in ("ids", "n")],
        *[F.lit(0.0).alias(c) for c in ("s", "m", "m2")],
        F.lit(False).alias("own"),
    ).filter("_t is not null")
