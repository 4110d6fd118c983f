import json

import pytest
from pyspark.sql import functions as F

from pacewatch.operators import features
from pacewatch.operators.incremental import incremental_features, merge_features
from pacewatch.operators.stage import stage
from pacewatch.plans import adapter
from pacewatch.plans.refresh import run_refresh
from pacewatch.schema import TOPIC_SCHEMA
from pacewatch.sources import published
from pacewatch.sources.events import decode_events, observe_ingest
from pacewatch.streaming import bronze, live


def put(spark, path, ids):
    rows = [
        (bytearray(b"k"), bytearray(json.dumps({"transaction_id": f"t{i}", "user_id": "u", "amount": 1.0, "is_fraud": i % 2}).encode()), "t", 0, i, None)
        for i in ids
    ]
    spark.createDataFrame(rows, TOPIC_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_bronze_resumes_from_its_checkpoint(spark, tmp_path):
    topic, out, checkpoint = (str(tmp_path / d) for d in ("topic", "bronze", "checkpoint"))

    def drain():
        bronze.bronze_stream(
            spark, "t", checkpoint, fmt="parquet", options={"path": topic}, path=out, mode="once"
        ).awaitTermination()
        return spark.read.parquet(out)

    put(spark, topic, range(5))
    assert drain().count() == 5
    put(spark, topic, range(5, 8))
    rows = drain()
    assert rows.count() == 8 and rows.select("transaction_id").distinct().count() == 8
    assert drain().count() == 8


def test_bronze_counters_are_observed(spark, tmp_path):
    topic = str(tmp_path / "topic")
    put(spark, topic, range(4))
    decoded = observe_ingest(decode_events(bronze.read_events_stream(spark, "parquet", {"path": topic}), "t"))
    query = bronze.start_bronze(decoded, str(tmp_path / "c"), path=str(tmp_path / "b"), mode="once")
    query.awaitTermination()
    seen = [p.observedMetrics["ingest"] for p in query.recentProgress if "ingest" in p.observedMetrics]
    assert sum(m.sent for m in seen) == 4 and sum(m.positives for m in seen) == 2


def test_bronze_arguments(spark):
    assert bronze.trigger("continuous", "10 seconds") == {"processingTime": "10 seconds"}
    with pytest.raises(ValueError):
        bronze.trigger("always", "")
    with pytest.raises(ValueError):
        bronze.start_bronze(None, "c")


def rounded(df):
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def same(a, b):
    a, b = rounded(a), rounded(b)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_incremental_step_equals_rebuild_and_touches_few_rows(spark, sf_dir, tmp_path):
    stage(adapter.bronze(spark, sf_dir)).write.parquet(str(tmp_path / "s"))
    staged = spark.read.parquet(str(tmp_path / "s"))
    full = features.transaction_features(staged)
    for fresh_if in ("event_time >= '2024-01-28'", "V3 > 3.9", "user_id = 'user_00003' and V3 > 3"):
        is_fresh = F.expr(fresh_if)
        before = features.transaction_features(staged.filter(~is_fresh))
        changed = incremental_features(staged, staged.filter(is_fresh))
        assert changed.count() < staged.count()
        assert same(merge_features(before, changed), full), fresh_if


def test_incremental_gap_reaches_beyond_the_windows(spark, sf_dir):
    """A late row changes the gap of its successor weeks later, and finds its predecessor."""
    one = stage(adapter.bronze(spark, sf_dir)).limit(1)
    days = [0, 20, 45]
    rows = None
    for d in days:
        seconds = 1704067200 + d * 86400
        r = one.withColumns(
            {
                "transaction_id": F.lit(f"x{d}"),
                "event_time_unix": F.lit(seconds).cast("long"),
                "event_time": F.timestamp_seconds(F.lit(seconds)),
                "event_date": F.to_date(F.timestamp_seconds(F.lit(seconds))),
            }
        )
        rows = r if rows is None else rows.unionByName(r)
    changed = incremental_features(rows, rows.filter("transaction_id = 'x20'"))
    gaps = {r.transaction_id: r.seconds_since_last_txn for r in changed.collect()}
    assert gaps == {"x20": 20 * 86400, "x45": 25 * 86400}


def test_incremental_step_keeps_rows_without_time_or_account(spark, sf_dir):
    staged = stage(adapter.bronze(spark, sf_dir))
    no_time, no_user = F.col("V8") > 3.6, F.col("V9") > 3.6
    holes = staged.withColumns(
        {
            **{c: F.when(~no_time, F.col(c)) for c in ("event_time", "event_time_unix", "event_date")},
            "user_id": F.when(~no_user, F.col("user_id")),
        }
    ).checkpoint()
    assert holes.filter("event_date is null").count() and holes.filter("user_id is null").count()
    for is_fresh in (F.expr("V3 > 3"), no_time | no_user):
        before = features.transaction_features(holes.filter(~is_fresh))
        changed = incremental_features(holes, holes.filter(is_fresh))
        assert same(merge_features(before, changed), features.transaction_features(holes))


def test_incremental_step_prunes_partitions_by_date(spark, sf_dir, tmp_path):
    stage(adapter.bronze(spark, sf_dir)).write.partitionBy("event_date").parquet(str(tmp_path / "s"))
    staged = spark.read.parquet(str(tmp_path / "s"))
    read = staged.filter(F.col("event_date").isin(["2024-01-05"]) | F.col("event_date").isNull())
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "event_date" in plan.split("PartitionFilters: [")[1].split("]")[0]


@pytest.mark.parametrize("order", [(0, 1, 1, 2), (2, 1, 0), (1, 2, 0)])
def test_live_batches_equal_rebuild_in_any_order(spark, sf_dir, tmp_path, order):
    """Batches are cut by arrival, so the reversed orders bring earlier arrivals of known ids."""
    raw = adapter.bronze(spark, sf_dir)
    day = F.dayofmonth("_ingested_at")
    raw = raw.withColumn("_n", F.when(F.hour("_ingested_at") < 8, 0).when(day < 15, 1).otherwise(2)).checkpoint()
    staged, out = str(tmp_path / "staged"), str(tmp_path / "features")
    batch = 0
    for i, part in enumerate(order):
        live.update_features(raw.filter(F.col("_n") == part).drop("_n"), batch, staged, out)
        batch += order[i + 1 : i + 2] != (part,)
    # The same events once more change nothing.
    live.update_features(raw.filter("_n = 0").drop("_n"), batch, staged, out)
    full = features.transaction_features(stage(raw.drop("_n")))
    current = live.current_features(spark, out)
    assert same(current.select(*full.columns), full)
    live.compact_features(spark, out, str(tmp_path / "compact"))
    assert same(live.current_features(spark, str(tmp_path / "compact")).select(*full.columns), full)


def test_live_survives_a_first_batch_that_crashed(spark, sf_dir, tmp_path):
    staged, out = tmp_path / "staged", str(tmp_path / "features")
    for name in ("rows", "ids", "gone"):
        (staged / name / "batch_id=0" / "_temporary").mkdir(parents=True)
    raw = adapter.bronze(spark, sf_dir)
    live.update_features(raw, 0, str(staged), out)
    assert live.current_features(spark, out).count() == stage(raw).count()


def test_scoring_stream_sees_new_profiles_and_records_everything(spark, tmp_path):
    schema = "transaction_id string, user_id string, amount double"

    def ask(*rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def profiles(key):
        one = f"select 'user_features:{key}' key, map('avg_amount_all_time', '10') fields, current_timestamp() + interval 1 day expires_at"
        spark.sql(one).write.mode("overwrite").parquet(str(tmp_path / "p"))

    def rule(df):
        p = F.when(F.col("amount") > 1000, 0.95).when(F.col("amount") > 1, 0.05)
        return df.withColumn("probability", p)

    def drain():
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        live.start_scoring(
            stream, lambda s: s.read.parquet(str(tmp_path / "p")), rule, str(tmp_path / "out"), str(tmp_path / "c"), mode="once"
        ).awaitTermination()

    profiles("u1")
    ask(("a", "u1", 5000.0), ("b", "u2", 3.0), ("c", "u3", -1.0), ("d", "u4", float("nan")), ("e", "u5", 0.5))
    drain()
    profiles("u2")
    ask(("f", "u2", 2.0))
    drain()
    got = {r.transaction_id: (r.decision, r.feature_source) for r in spark.read.parquet(str(tmp_path / "out/scored")).collect()}
    assert got == {"a": ("DECLINE", "online"), "b": ("APPROVE", "cold_start"), "f": ("APPROVE", "online")}
    audit = [json.loads(r.record) for r in spark.read.parquet(str(tmp_path / "out/audit")).collect()]
    assert {r["transaction_id"] for r in audit} == set(got) and {r["threshold"] for r in audit} == {0.3}
    refused = {r.transaction_id: r.reason for r in spark.read.parquet(str(tmp_path / "out/rejects")).collect()}
    assert refused == {"c": "amount is not positive", "d": "amount is not a number", "e": "no probability"}


def in_force(spark, path):
    said = published.pointer(spark, str(path))
    return said["version"] if said else None


def test_refresh_publishes_only_what_is_clean(spark, sf_dir, tmp_path):
    raw = adapter.bronze(spark, sf_dir)
    try:
        report = run_refresh(spark, raw, str(tmp_path), "refreshed_profiles").collect()
        assert {r.failures for r in report} == {0} and {r.published for r in report} == {True}
        first = in_force(spark, tmp_path)
        assert spark.read.parquet(f"{first}/online_hashes").count() == spark.read.table("refreshed_profiles").count()
        # An unreadable message is set aside; it stops nothing and enters nothing.
        broken = raw.limit(1).withColumns({"transaction_id": F.lit(None).cast("string"), "user_id": F.lit(None).cast("string")})
        report = run_refresh(spark, raw.unionByName(broken), str(tmp_path), "refreshed_profiles").collect()
        second = in_force(spark, tmp_path)
        assert second != first and spark.read.parquet(f"{second}/quarantine").count() == 1
        assert {r.published for r in report} == {True}
        # A bad label does stop the run before anything is registered or published.
        bad = raw.withColumn("is_fraud", F.when(F.col("V1") > 3.9, 2).otherwise(F.col("is_fraud")))
        report = run_refresh(spark, bad, str(tmp_path), "refreshed_profiles").collect()
        assert {r.published for r in report} == {False} and any(r.failures for r in report)
        assert in_force(spark, tmp_path) == second
    finally:
        spark.sql("DROP TABLE IF EXISTS refreshed_profiles")
