"""Split by time, so that a model is tested only on what came after its training."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacewatch.schema import TRAIN_FRACTION


def time_split_point(
    df: DataFrame, frac: float = TRAIN_FRACTION, time_col: str = "event_time"
) -> DataFrame:
    """One row: the instant at ``frac`` of the observed time range, to the microsecond."""
    t = F.col(time_col).cast("timestamp")
    bounds = df.agg(F.unix_micros(F.min(t)).alias("lo"), F.unix_micros(F.max(t)).alias("hi"))
    reach = F.rint((F.col("hi") - F.col("lo")) * F.lit(frac)).cast("long")
    return bounds.select(F.timestamp_micros(F.col("lo") + reach).alias("split_time"))


def time_split(
    df: DataFrame, frac: float = TRAIN_FRACTION, time_col: str = "event_time"
) -> tuple[DataFrame, DataFrame]:
    """(train, test) around the split point. Rows without a time are in neither.

    The point is a scalar subquery: nothing runs while the plan is built, and the scan
    receives it as a pushed filter.
    """
    cut: Column = time_split_point(df, frac, time_col).scalar()
    return df.filter(F.col(time_col) < cut), df.filter(F.col(time_col) >= cut)


def positives(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    return df.filter(f"{label} = 1")


def split_summary(train: DataFrame, test: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Rows, positives and positive rate of both sides."""

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.agg(
            F.count(F.lit(1)).alias("rows"),
            F.coalesce(F.sum(F.col(label).cast("long")), F.lit(0)).alias("positives"),
            F.avg(F.col(label).cast("double")).alias("positive_rate"),
        ).select(F.lit(name).alias("split"), "*")

    return side(train, "train").unionByName(side(test, "test"))
