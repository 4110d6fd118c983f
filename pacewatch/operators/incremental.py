"""Recompute only the feature rows that new transactions can change.

With a longest window of seven days, a new row at t changes the frames of its own
account's rows up to t + 7 days, and the gap of the account's next row however late
that comes. Work is planned in (account, date) units. Rows without an account form one
account of their own, and the rows of an account without a time one unit of theirs, as in
a rebuild.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pacewatch.operators.features import transaction_features
from pacewatch.operators.rolling import HOT_ROWS
from pacewatch.session import use_checkpoints

# The longest window in dates, and one more for zones whose days can last 25 hours.
_REACH_DAYS = 8
_UNIT = ["user_id", "event_date"]
# More distinct dates than this are not listed for partition pruning.
_MAX_DATES = 10_000


def _keyed(df: DataFrame, *more: str) -> DataFrame:
    """Units with keys that are never null: a missing account or date is a value of its own."""
    return df.select(_account().alias("_u"), _date().alias("_d"), *more)


def _account() -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col("user_id").cast("string")), F.lit(""))


def _date() -> Column:
    return F.coalesce("event_date", F.lit("0100-01-01").cast("date"))


def affected_units(activity: DataFrame, touched: DataFrame) -> DataFrame:
    """(_u, _d, affected): units to recompute, and units only read as context.

    ``activity`` has the (user_id, event_date) of all staged rows, ``touched`` those of
    new, replaced and withdrawn rows. Dates collapse to one row per unit before the join.
    """
    new = _keyed(touched).distinct()
    accounts = new.select("_u").distinct()
    dates = _keyed(activity).distinct().join(accounts, "_u", "left_semi")
    by_account = Window.partitionBy("_u").orderBy("_d")
    active = dates.select(
        "_u", "_d", F.lag("_d").over(by_account).alias("before"), F.lead("_d").over(by_account).alias("after")
    )
    reached = new.select("_u", F.explode(F.sequence("_d", F.date_add("_d", _REACH_DAYS))).alias("_d"))
    # A withdrawn row may leave no activity: the date after it is found without it.
    ends = new.select("_u", F.col("_d").alias("_n"))
    followers = (
        active.join(ends, "_u").filter((F.col("_d") > F.col("_n")) & ((F.col("before") <= F.col("_n")) | F.col("before").isNull()))
    ).select("_u", "_d")
    affected = active.join(reached.union(followers).distinct(), ["_u", "_d"])
    context = F.concat(F.sequence(F.date_sub("_d", _REACH_DAYS), F.date_sub("_d", 1)), F.array("before"))
    read = affected.select("_u", F.explode(context).alias("_d"), F.lit(False).alias("affected"))
    flagged = affected.select("_u", "_d", F.lit(True).alias("affected")).union(read)
    return flagged.groupBy("_u", "_d").agg(F.max("affected").alias("affected"))


def incremental_features(
    staged: DataFrame,
    fresh: DataFrame,
    hot_rows: int = HOT_ROWS,
    activity: DataFrame | None = None,
    withdrawn: DataFrame | None = None,
) -> DataFrame:
    """New and changed feature rows after ``fresh`` joined ``staged`` (which includes it).

    ``withdrawn`` are (user_id, event_date) of rows that ``fresh`` took the place of.
    ``activity`` is a cheaper source than ``staged`` for accounts and their dates. The list
    of units is written once; its dates prune the partitions of ``staged`` if that is
    split by date, and the rows read are written once, so nothing is computed twice.
    """
    use_checkpoints(staged.sparkSession)
    touched = fresh.select(*_UNIT)
    if withdrawn is not None:
        touched = touched.unionByName(withdrawn.select(*_UNIT))
    units = affected_units(staged.select(*_UNIT) if activity is None else activity, touched).checkpoint()
    dates = [r[0].isoformat() for r in units.select("_d").distinct().limit(_MAX_DATES + 1).collect() if r[0] and r[0].year > 999]
    if len(dates) <= _MAX_DATES:
        staged = staged.filter(F.col("event_date").isin(dates) | F.col("event_date").isNull())
    rows = staged.withColumns({"_u": _account(), "_d": _date()}).join(units, ["_u", "_d"]).drop("_u", "_d")
    features = transaction_features(rows.checkpoint(), hot_rows=hot_rows, keep=["affected"])
    return features.filter("affected").drop("affected")


def merge_features(existing: DataFrame, changed: DataFrame) -> DataFrame:
    """The feature table with changed rows replaced and new rows added."""
    new = changed.select(F.col("transaction_id").alias("_changed"))
    kept = existing.join(new, F.col("transaction_id").eqNullSafe(F.col("_changed")), "left_anti")
    return kept.unionByName(changed)
