"""Clean raw events: one row per transaction id, plus the time columns features use."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pacewatch.functions.scalars import epoch_seconds, event_date
from pacewatch.schema import STAGED_COLUMNS


def dedupe_first(
    df: DataFrame,
    id_col: str = "transaction_id",
    order_cols: Sequence[str | Column] = ("_ingested_at",),
    unique_order: bool = False,
) -> DataFrame:
    """Keep the first-arrived row of each id.

    Spark ranks inside each map task first and ships one row per id and task
    (WindowGroupLimit), so an id repeated in a third of all rows stays small on the
    wire. Where ``order_cols`` can tie, a whole-row hash decides; ``unique_order`` says
    they cannot, which leaves unused columns out of the scan.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    if not unique_order:
        order.append(F.xxhash64(*[F.col(c) for c in df.columns]))
    first = F.row_number().over(Window.partitionBy(id_col).orderBy(*order))
    return df.withColumn("_dedupe_rank", first).filter("_dedupe_rank = 1").drop("_dedupe_rank")


def arrival(bronze: DataFrame) -> Column:
    """What orders the deliveries of an id: time of arrival, then topic position or a whole-row hash."""
    offsets = ["_kafka_partition", "_kafka_offset"]
    if all(c in bronze.columns for c in offsets):
        ties = [F.col(c).cast("long") for c in offsets]
    else:
        ties = [F.lit(0).cast("long"), F.xxhash64(*bronze.columns)]
    return F.struct(F.col("_ingested_at").alias("at"), ties[0].alias("part"), ties[1].alias("place"))


def staged_columns(first: DataFrame, *keep: str) -> DataFrame:
    """Deduplicated raw rows -> staged columns, and those to keep."""
    derived = {
        "event_time_unix": epoch_seconds("event_time"),
        "event_date": event_date("event_time"),
    }
    names = [derived[c].alias(c) if c in derived else F.col(c) for c in STAGED_COLUMNS]
    return first.select(*names, *keep)


def stage(bronze: DataFrame) -> DataFrame:
    """Raw table -> deduplicated transactions with epoch seconds and date.

    Partition and offset of the source topic, where present, settle equal arrival times.
    """
    offsets = ["_kafka_partition", "_kafka_offset"]
    known = all(c in bronze.columns for c in offsets)
    order = ["_ingested_at", *offsets] if known else ["_ingested_at"]
    return staged_columns(dedupe_first(bronze, "transaction_id", order, unique_order=known))
