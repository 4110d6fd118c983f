"""Column and table checks. A check passes when no row fails it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacewatch.schema import ACCOUNT_FEATURE_COLUMNS


@dataclass(frozen=True)
class Check:
    """One test of one column. ``failing`` is None for uniqueness, which needs groups."""

    name: str
    column: str
    failing: Column | None = None

    def failures(self, df: DataFrame) -> DataFrame:
        """The failing rows, or the repeated values with their counts."""
        if self.failing is not None:
            return df.filter(self.failing)
        known = df.filter(F.col(self.column).isNotNull())
        return known.groupBy(self.column).count().filter("count > 1")


def not_null(column: str) -> Check:
    return Check("not_null", column, F.col(column).isNull())


def unique(column: str) -> Check:
    """No value twice; nulls do not count."""
    return Check("unique", column)


def accepted_values(column: str, values: Sequence) -> Check:
    """Only listed values; null passes."""
    return Check("accepted_values", column, ~F.col(column).isin(list(values)))


def expression_true(column: str, condition: str) -> Check:
    """``column condition`` holds, as in ``expression_true("n", "> 0")``; null passes."""
    return Check("expression_true", column, ~F.expr(f"`{column}` {condition}"))


def bronze_checks() -> list[Check]:
    return [
        *[not_null(c) for c in ("transaction_id", "user_id", "event_time", "amount", "is_fraud")],
        accepted_values("is_fraud", [0, 1]),
    ]


def transaction_checks() -> list[Check]:
    return [
        unique("transaction_id"),
        not_null("transaction_id"),
        not_null("user_id"),
        not_null("is_fraud"),
        accepted_values("is_fraud", [0, 1]),
        expression_true("txn_count_1h", ">= 0"),
        expression_true("amount_stddev_24h", ">= 0"),
    ]


def account_checks() -> list[Check]:
    return [unique("user_id"), not_null("user_id"), expression_true("total_txn_count", "> 0")]


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """(check, column, failures) for every check.

    All row-level checks share one aggregation pass; each uniqueness check adds one
    pre-aggregated shuffle on its column.
    """
    row_level = [c for c in checks if c.failing is not None]
    report = None
    if row_level:
        counted = df.agg(
            F.array(
                *[
                    F.struct(
                        F.lit(c.name).alias("check"),
                        F.lit(c.column).alias("column"),
                        F.count(F.when(c.failing, 1)).alias("failures"),
                    )
                    for c in row_level
                ]
            ).alias("results")
        )
        report = counted.select(F.inline("results"))
    for check in checks:
        if check.failing is None:
            found = check.failures(df).agg(
                F.lit(check.name).alias("check"),
                F.lit(check.column).alias("column"),
                F.count(F.lit(1)).alias("failures"),
            )
            report = found if report is None else report.unionByName(found)
    return report


def check_schema(df: DataFrame, required: Sequence[str] = ACCOUNT_FEATURE_COLUMNS) -> DataFrame:
    """Required columns that the table lacks; reads no data."""
    missing = [(c,) for c in required if c not in df.columns]
    return df.sparkSession.createDataFrame(missing, "missing_column string")


def column_coverage(df: DataFrame, required: Sequence[str] = ACCOUNT_FEATURE_COLUMNS) -> DataFrame:
    """One row per required column: whether the table has it, its rows, and how many hold a value; one pass."""

    def row(c: str) -> Column:
        present = c in df.columns
        filled = F.count(F.col(f"`{c}`")) if present else F.lit(0).cast("long")
        return F.struct(F.lit(c).alias("column"), F.lit(present).alias("present"), F.count(F.lit(1)).alias("total"), filled.alias("filled"))

    return df.agg(F.array(*map(row, required)).alias("found")).select(F.inline("found"))


def contract_report(df: DataFrame, required: Sequence[str] = ACCOUNT_FEATURE_COLUMNS) -> DataFrame:
    """The schema contract as one row of a check report: how many required columns are missing."""
    return check_schema(df, required).agg(
        F.lit("required_columns").alias("check"), F.lit("*").alias("column"), F.count(F.lit(1)).alias("failures")
    )


def freshness(df: DataFrame, column: str = "_ingested_at", now: Column | None = None) -> DataFrame:
    """Newest arrival and its age in seconds."""
    clock = F.current_timestamp() if now is None else now
    return df.agg(F.max(column).alias("newest")).withColumn(
        "age_seconds", F.unix_seconds(clock.cast("timestamp")) - F.unix_seconds(F.col("newest").cast("timestamp"))
    )


def primary_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that are null or repeated."""
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    return df.groupBy(*keys).count().filter(any_null | (F.col("count") > 1))
