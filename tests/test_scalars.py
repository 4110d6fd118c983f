import hashlib
import random

import pytest
from pyspark.sql import functions as F

from pacewatch.functions import scalars as s


def one(spark, column):
    return spark.range(1).select(column.alias("x")).head()[0]


def test_account_bucket_matches_big_integer_arithmetic(spark):
    rng = random.Random(3)
    offsets = [0.0, 10.0, 0.5, 1e7, 172792.0, 12345678.25, 0.00025, 1.5e16, 3e-5, 9999999.0, 1e-3]
    rows = [(i, rng.choice([float(rng.randrange(200000)), rng.random() * 1e5, *offsets])) for i in range(800)]
    rows += [(1000 + i, x) for i, x in enumerate(offsets)]
    df = spark.createDataFrame(rows, "i long, t double")
    for pool in (100, 5000, 2**31 - 1):
        got = {r.i: r.u for r in df.select("i", s.account_bucket("i", "t", pool).alias("u")).collect()}
        for i, t in rows:
            digest = hashlib.md5(f"{i}:{t}".encode()).hexdigest()
            assert got[i] == f"user_{int(digest, 16) % pool:05d}", (i, t)


def test_account_bucket_is_stable_and_spreads(spark):
    df = spark.range(1000).select(s.account_bucket("id", F.col("id").cast("double"), 100).alias("u"))
    assert df.distinct().count() > 50
    pair = [one(spark, s.account_bucket(F.lit(42), F.lit(1000.0), 5000)) for _ in range(2)]
    assert pair[0] == pair[1]


@pytest.mark.parametrize("pool", [0, -1, 2**31])
def test_account_bucket_rejects_pool(pool):
    with pytest.raises(ValueError):
        s.account_bucket(F.lit(1), F.lit(1.0), pool)


def test_event_time_and_iso_text(spark):
    assert one(spark, s.iso_utc(s.event_time(F.lit(10.0)))) == "2024-01-01T00:00:10+00:00"
    assert one(spark, s.iso_utc(s.event_time(F.lit(1.25)))) == "2024-01-01T00:00:01.250000+00:00"


def test_iso_text_is_utc_in_any_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert one(spark, s.iso_utc(s.event_time(F.lit(10.0)))) == "2024-01-01T00:00:10+00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_transaction_id(spark):
    assert one(spark, s.transaction_id(F.lit(7))) == "txn_00000007"


def test_epoch_seconds_round_down(spark):
    t = F.lit("2023-12-31 23:59:59.9").cast("timestamp")
    assert one(spark, s.epoch_seconds(t)) == 1704067199
    assert one(spark, s.epoch_seconds(F.lit("1969-12-31 23:59:59.5").cast("timestamp"))) == -1


def test_ratio_without_baseline_uses_own_amount(spark):
    assert one(spark, s.ratio(F.lit(250.0), F.lit(None).cast("double"))) == pytest.approx(250 / 250.01)
    assert one(spark, s.ratio(F.lit(50.0), F.lit(80.0))) == pytest.approx(50 / 80.01)
    assert one(spark, s.ratio(F.lit(5.0), F.lit(-0.01))) is None


def test_zscore_is_zero_without_spread(spark):
    null = F.lit(None).cast("double")
    assert one(spark, s.zscore(F.lit(5.0), F.lit(3.0), null)) == 0.0
    assert one(spark, s.zscore(F.lit(5.0), F.lit(3.0), F.lit(0.0))) == 0.0
    assert one(spark, s.zscore(F.lit(5.0), F.lit(3.0), F.lit(4.0))) == 0.5


def test_risk_and_decision_edges(spark):
    levels = {0.29999: "LOW", 0.3: "MEDIUM", 0.49999: "MEDIUM", 0.5: "HIGH", 1.0: "HIGH"}
    for p, level in levels.items():
        assert one(spark, s.risk_level(F.lit(p))) == level
        assert one(spark, s.decision(F.lit(p))) == ("DECLINE" if p >= 0.3 else "APPROVE")
    # A threshold above the high mark does not lower the level.
    assert one(spark, s.risk_level(F.lit(0.6), 0.9)) == "HIGH"


def test_decode_fields(spark):
    m = F.create_map(F.lit("a"), F.lit("3.5"), F.lit("b"), F.lit("88.20"), F.lit("c"), F.lit("x"))
    assert one(spark, s.decode_fields(m)) == {"a": 3.5, "b": 88.2, "c": None}


def test_feature_source_treats_empty_as_cold(spark):
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<double>"))
    assert one(spark, s.feature_source(empty)) == "cold_start"
    assert one(spark, s.feature_source(F.lit(None).cast("map<string,double>"))) == "cold_start"
    assert one(spark, s.feature_source(F.create_map(F.lit("a"), F.lit(1.0)))) == "online"
