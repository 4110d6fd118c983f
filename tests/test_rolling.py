"""Both rolling plans against a direct computation, on rows chosen to hit every edge."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from pacewatch.operators import features, rolling
from pacewatch.operators.panes import paned_rolling
from pacewatch.operators.stage import dedupe_first, stage
from pacewatch.schema import (
    SPEND_FRAMES,
    V_COLUMNS,
    VELOCITY_FRAMES,
    VOLATILITY_FRAMES,
    WINDOWS,
)

FRAMES = VELOCITY_FRAMES | SPEND_FRAMES | VOLATILITY_FRAMES
SCHEMA = "transaction_id string, user_id string, event_time_unix long, amount double"
GAP = "gap"


def edge_rows():
    t0 = 1704067200
    offsets = [0, 1, 1, 3600, 3601, 3601, 7202, 86400, 86401, 90000, 604800, 604801, 608400]
    offsets += [14 * 86400 - 1, 14 * 86400, 21 * 86400 - 1, 21 * 86400, 21 * 86400 + 60, 60 * 86400, 90 * 86400]
    rows = [(f"e{i:03d}", "edge", t0 + o, 10.0 + i * 1.37) for i, o in enumerate(offsets)]
    rows += [(f"c{i:03d}", "constant", t0 + 600 * i, 0.1) for i in range(30)]
    rows += [(f"d{i:03d}", "spike", t0 + 700 * i, 1e6 if i == 10 else 9.99 + (i % 2) / 100) for i in range(30)]
    rows += [("s000", "single", t0, 5.0)]
    rows += [("n000", "nulls", t0, None), ("n001", "nulls", t0 + 50, 3.0), ("n002", "nulls", t0 + 60, None)]
    rows += [(None, "nulls", t0 + 50, 4.0), ("n003", "nulls", None, 6.0), ("n004", "nulls", None, 8.0)]
    rows += [("u000", None, t0, 1.0), ("u001", None, t0 + 5, 2.0)]
    rng = random.Random(11)
    for i in range(400):
        step = rng.choice([1, 30, 59, 60, 61, 3599, 3600, 3601])
        rows.append((f"r{i:03d}", "busy", t0 + rng.randrange(0, 20) * 86400 + rng.randrange(40) * step, rng.randrange(1, 9999) / 100))
    return rows


def expected(rows):
    out = {}
    for tid, user, t, amount in rows:
        peers = [r for r in rows if r[1] == user]
        values = {}
        for name, (agg, w) in FRAMES.items():
            if t is None:
                inside = [r for r in peers if r[2] is None]
            else:
                inside = [r for r in peers if r[2] is not None and t - WINDOWS[w] <= r[2] <= t - 1]
            xs = [r[3] for r in inside if r[3] is not None]
            if agg == "count":
                values[name] = sum(r[0] is not None for r in inside)
            elif agg == "stddev":
                values[name] = statistics.stdev(xs) if len(xs) > 1 else None
            elif not xs:
                values[name] = None
            else:
                values[name] = {"sum": sum, "max": max, "min": min, "avg": statistics.fmean}[agg](xs)
        order = sorted(
            peers, key=lambda r: (r[2] is not None, r[2] or 0, r[0] is not None, r[0] or "")
        )
        at = order.index((tid, user, t, amount))
        before = order[at - 1][2] if at else None
        values[GAP] = None if t is None or before is None else t - before
        out[(tid, user, t)] = values
    return out


def check(df, rows):
    want = expected(rows)
    got = {(r["transaction_id"], r["user_id"], r["event_time_unix"]): r for r in df.collect()}
    assert set(got) == set(want)
    for key, values in want.items():
        for name, value in values.items():
            have = got[key][name]
            if value is None or have is None:
                assert have is None and value is None, (key, name, have, value)
            else:
                assert math.isclose(have, value, rel_tol=1e-9, abs_tol=1e-9), (key, name, have, value)


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


def test_native_plan(table):
    check(rolling.native_rolling(table, FRAMES, GAP), edge_rows())


def test_paned_plan(table):
    check(paned_rolling(table, FRAMES, GAP), edge_rows())


@pytest.mark.parametrize("pane,chunk", [(1, 7), (1800, 8), (300, 30)])
def test_paned_plan_with_other_sizes(table, pane, chunk):
    check(paned_rolling(table, FRAMES, GAP, pane=pane, chunk=chunk * 86400), edge_rows())


@pytest.mark.parametrize("hot_rows", [0, 25, 100, 10_000])
def test_routing_changes_nothing(table, hot_rows):
    check(rolling.rolling(table, FRAMES, GAP, hot_rows=hot_rows), edge_rows())


def test_too_many_hot_keys_take_the_paned_plan(table, monkeypatch):
    monkeypatch.setattr(rolling, "MAX_HOT_KEYS", 2)
    check(rolling.rolling(table, FRAMES, GAP, hot_rows=0), edge_rows())


def test_constant_amounts_have_no_spread_in_either_plan(table):
    for plan in (rolling.native_rolling, paned_rolling):
        rows = plan(table, VOLATILITY_FRAMES).filter("user_id = 'constant'")
        assert {r.amount_stddev_7d for r in rows.collect()} == {None, 0.0}


def test_paned_plan_rejects_sizes_that_do_not_fit(table):
    with pytest.raises(ValueError):
        paned_rolling(table, FRAMES, pane=7)
    with pytest.raises(ValueError):
        paned_rolling(table, FRAMES, chunk=86400)


def staged_rows(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    extra = {v: F.lit(0.0) for v in V_COLUMNS}
    return df.withColumns(
        {
            **extra,
            "event_time": F.timestamp_seconds("event_time_unix"),
            "event_date": F.to_date(F.timestamp_seconds("event_time_unix")),
            "is_fraud": F.lit(0),
        }
    )


def test_first_transaction_and_null_id_take_defaults(spark):
    rows = [("a", "u", 100, 250.0), ("b", "u", 200, 10.0), (None, "u", 300, 7.0)]
    got = {r.transaction_id: r for r in features.transaction_features(staged_rows(spark, rows)).collect()}
    assert got["a"].txn_count_7d == 0 and got["a"].seconds_since_last_txn is None
    assert got["a"].avg_amount_24h == got["a"].max_amount_24h == got["a"].min_amount_24h == 250.0
    assert got["a"].amount_vs_avg_24h == pytest.approx(250 / 250.01)
    assert got["a"].amount_zscore_7d == 0.0 and got["a"].total_amount_1h == 0.0
    assert got["b"].txn_count_1h == 1 and got["b"].seconds_since_last_txn == 100
    lost = got[None]
    assert lost.txn_count_7d == 0 and lost.seconds_since_last_txn is None
    assert lost.avg_amount_24h == 7.0 and lost.amount_vs_avg_24h == 1.0 and lost.amount_vs_max_7d == 1.0


def test_one_pass_equals_joined_feature_sets(spark):
    rows = [r for r in edge_rows() if r[1] in ("edge", "constant", "busy")] + [(None, "edge", 1704067300, 3.0)]
    base = staged_rows(spark, rows)
    joined = features.assemble_features(
        base,
        features.velocity_features(base),
        features.spend_features(base),
        features.volatility_features(base),
    )
    single = features.transaction_features(base)
    assert joined.exceptAll(single).count() == 0 and single.exceptAll(joined).count() == 0


def test_account_rollup_fills_numbers_only(spark):
    rows = [("a", "u", 100, 10.0), ("b", "u", 200, 30.0), ("c", "lone", None, 5.0)]
    table = features.transaction_features(staged_rows(spark, rows))
    filled = {r.user_id: r for r in features.account_features(table).collect()}
    raw = {r.user_id: r for r in features.account_features(table, fill_nulls=False).collect()}
    assert filled["u"].total_txn_count == 2 and filled["u"].avg_amount_all_time == 20.0
    assert filled["u"].total_spend_all_time == 40.0 and filled["u"].max_velocity_1h == 1
    assert raw["lone"].amount_stddev_all_time is None and filled["lone"].amount_stddev_all_time == 0.0
    assert filled["lone"].last_transaction_time is None


def test_dedupe_keeps_first_arrival_and_one_null_id(spark):
    rows = [("a", 2, 1.0), ("a", 1, 2.0), ("a", 3, 3.0), (None, 1, 4.0), (None, 2, 5.0), ("b", 1, 6.0)]
    df = spark.createDataFrame(rows, "transaction_id string, _ingested_at long, amount double")
    got = {(r.transaction_id, r.amount) for r in dedupe_first(df).collect()}
    assert got == {("a", 2.0), (None, 4.0), ("b", 6.0)}


def test_dedupe_breaks_ties_the_same_way_every_time(spark):
    df = spark.range(300).selectExpr("cast(id % 3 as string) transaction_id", "1 _ingested_at", "id amount")
    first = {r.transaction_id: r.amount for r in dedupe_first(df).collect()}
    again = {r.transaction_id: r.amount for r in dedupe_first(df.repartition(7)).collect()}
    assert first == again


def test_replayed_events_are_removed(spark, sf_dir):
    from pacewatch.plans import adapter

    once = adapter.transactions(spark, sf_dir).drop("event_type")
    twice = once.unionByName(once.withColumn("_ingested_at", F.col("_ingested_at") + F.expr("interval 1 day")))
    assert stage(twice).exceptAll(stage(once)).count() == 0
    assert stage(twice).count() == once.count()
