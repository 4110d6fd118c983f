from pyspark.sql import functions as F

from pacewatch.operators import online, serving
from pacewatch.schema import MODEL_COLUMNS, PROFILE_DEFAULTS


def clock():
    return F.lit("2024-01-02 00:00:00").cast("timestamp")


def test_hash_rows_hold_text_zeros_for_nulls_and_expiry(spark):
    df = spark.sql("select 'u1' user_id, 3L n, cast(null as double) x, timestamp'2024-01-01 00:00:10' t, 2.5D y")
    row = online.to_online_hashes(df, now=clock()).head()
    assert row.key == "user_features:u1"
    assert row.fields == {"n": "3", "x": "0", "t": "1704067210", "y": "2.5"}
    assert row.expires_at.isoformat() == "2024-01-03T00:00:00"


def hashes(spark, rows):
    df = spark.createDataFrame(rows, "key string, fields map<string,string>, expires_at string")
    return df.withColumn("expires_at", F.col("expires_at").cast("timestamp"))


def test_merge_is_by_field_and_forgets_the_expired(spark):
    old = hashes(
        spark,
        [
            ("k:a", {"x": "1", "old": "7"}, "2024-01-02 01:00:00"),
            ("k:b", {"x": "2"}, "2024-01-02 02:00:00"),
            ("k:c", {"x": "3", "old": "9"}, "2024-01-01 23:00:00"),
            ("k:d", {"x": "4"}, "2024-01-02 00:00:00"),
        ],
    )
    new = hashes(
        spark,
        [("k:a", {"x": "10"}, "2024-01-03 00:00:00"), ("k:c", {"x": "30"}, "2024-01-03 00:00:00"), ("k:e", {"z": "5"}, "2024-01-03 00:00:00")],
    )
    got = {r.key: (r.fields, r.expires_at.isoformat()) for r in online.merge_online(old, new, now=clock()).collect()}
    assert got == {
        "k:a": ({"old": "7", "x": "10"}, "2024-01-03T00:00:00"),
        "k:b": ({"x": "2"}, "2024-01-02T02:00:00"),
        "k:c": ({"x": "30"}, "2024-01-03T00:00:00"),
        "k:e": ({"z": "5"}, "2024-01-03T00:00:00"),
    }


def test_writer_flushes_in_batches_with_one_client_per_task(spark, tmp_path):
    import json

    class RecordingClient:
        """Writes every flush to a file, because tasks run outside this process."""

        def __init__(self, path):
            self.path, self.waiting = path, []

        def pipeline(self, transaction):
            assert transaction is False
            return self

        def hset(self, key, mapping):
            self.waiting.append((key, dict(mapping)))

        def expire(self, key, ttl):
            self.waiting.append((key, ttl))

        def execute(self):
            import json
            import uuid

            with open(f"{self.path}/{uuid.uuid4().hex}", "w") as f:
                json.dump(self.waiting, f)
            self.waiting = []

        def close(self):
            assert not self.waiting

    path = str(tmp_path)
    df = spark.range(12).coalesce(1).select(F.concat(F.lit("u"), "id").alias("user_id"), F.col("id").alias("n"))
    online.write_online(online.to_online_hashes(df), lambda: RecordingClient(path), batch=5, ttl=60)
    flushes = [json.load(open(p)) for p in tmp_path.iterdir()]
    assert sorted(len(f) for f in flushes) == [4, 10, 10]
    written = {k: v for f in flushes for k, v in f if isinstance(v, dict)}
    assert written["user_features:u7"] == {"n": "7"} and len(written) == 12


def requests(spark, rows):
    return spark.createDataFrame(rows, "transaction_id string, user_id string, amount double")


def test_lookup_misses_expired_empty_and_unknown(spark):
    stored = hashes(
        spark,
        [
            ("user_features:u1", {"avg_velocity_24h": "3.5", "avg_amount_all_time": "88.20"}, "2024-01-03 00:00:00"),
            ("user_features:u2", {"avg_velocity_24h": "1"}, "2024-01-01 00:00:00"),
            ("user_features:u3", {}, "2024-01-03 00:00:00"),
        ],
    )
    txns = requests(spark, [(f"t{i}", f"u{i}", 1.0) for i in range(1, 5)])
    got = {r.user_id: r.fields for r in online.lookup_features(txns, stored, clock()).collect()}
    assert got == {"u1": {"avg_velocity_24h": 3.5, "avg_amount_all_time": 88.2}, "u2": None, "u3": None, "u4": None}


def vector(spark, amount, fields):
    df = requests(spark, [("t", "u", amount)]).withColumn(
        "fields", F.lit(None).cast("map<string,double>") if fields is None else F.create_map(*[F.lit(x) for kv in fields.items() for x in kv])
    )
    return serving.proxy_vector(df)


def test_vector_order_and_cold_start(spark):
    out = vector(spark, 250.0, None)
    assert [c for c in out.columns if c in MODEL_COLUMNS] == MODEL_COLUMNS and len(MODEL_COLUMNS) == 31
    assert all(t == "double" for c, t in out.dtypes if c in MODEL_COLUMNS)
    row = out.head()
    assert row.avg_amount_24h == 250.0 and row.txn_count_1h == 0.0 and row.V1 == 0.0
    assert round(row.amount_vs_avg_24h, 2) == round(250.0 / 250.01, 2)


def test_vector_of_a_known_account(spark):
    profile = {"avg_velocity_1h": 2.0, "avg_velocity_24h": 5.0, "avg_daily_spend": 400.0, "avg_amount_all_time": 80.0, "max_amount_all_time": 300.0}
    row = vector(spark, 50.0, profile).head()
    assert (row.txn_count_1h, row.txn_count_24h, row.total_amount_24h, row.avg_amount_24h) == (2.0, 5.0, 400.0, 80.0)
    assert row.total_amount_1h == 100.0 and row.min_amount_24h == 50.0 and row.amount_stddev_7d == 0.0


def test_zero_average_means_no_history(spark):
    row = vector(spark, 50.0, {"avg_amount_all_time": 0.0, "max_amount_all_time": 0.0}).head()
    assert row.avg_amount_24h == row.max_amount_24h == 50.0


def test_other_defaults_can_be_given(spark):
    df = requests(spark, [("t", "u", 5.0)]).withColumn("fields", F.lit(None).cast("map<string,double>"))
    row = serving.proxy_vector(df, defaults={**PROFILE_DEFAULTS, "avg_velocity_24h": 1.5}).head()
    assert row.txn_count_24h == 1.5


def stand_in(df):
    return df.withColumn("probability", F.when(F.col("amount") > 1000, 0.95).otherwise(0.05))


def test_scoring_decisions(spark):
    stored = hashes(spark, [("user_features:user_00042", {"avg_amount_all_time": "60.0"}, "2024-01-03 00:00:00")])
    txns = requests(
        spark,
        [("small", "user_1", 45.0), ("large", "user_2", 5000.0), ("known", "user_00042", 65.0), ("zero", "user_4", 0.0), ("none", "user_4", None)],
    )
    got = {r.transaction_id: r for r in serving.score(txns, stored, stand_in, now=clock()).collect()}
    assert set(got) == {"small", "large", "known"}
    assert (got["small"].decision, got["small"].feature_source) == ("APPROVE", "cold_start")
    assert (got["large"].decision, got["large"].risk_level) == ("DECLINE", "HIGH")
    assert got["known"].feature_source == "online"
    _, refused = serving.validate(txns)
    assert {r.transaction_id for r in refused.collect()} == {"zero", "none"}


def test_decision_uses_the_exact_probability(spark):
    def nearly(df):
        return df.withColumn("probability", F.lit(0.29999))

    stored = hashes(spark, [("user_features:x", {"a": "1"}, "2024-01-03 00:00:00")])
    row = serving.score(requests(spark, [("t", "u", 5.0)]), stored, nearly, now=clock()).head()
    assert row.fraud_probability == 0.3 and row.decision == "APPROVE" and row.risk_level == "LOW"


def test_audit_record(spark):
    import json

    stored = hashes(spark, [("user_features:x", {"a": "1"}, "2024-01-03 00:00:00")])
    scored = serving.score(requests(spark, [("t", "u", 5000.0)]), stored, stand_in, now=clock())
    assert json.loads(serving.audit_records(scored, now=clock()).head().record) == {
        "event": "fraud_decision", "transaction_id": "t", "user_id": "u", "amount": 5000.0,
        "fraud_probability": 0.95, "decision": "DECLINE", "threshold": 0.3,
        "feature_source": "cold_start", "timestamp": "2024-01-02T00:00:00Z",
    }
