import csv
import json

import pytest
from pyspark.sql import functions as F

from pacewatch.schema import EVENT_SCHEMA, V_COLUMNS
from pacewatch.sources import events as ev
from pacewatch.sources import published, tables
from pacewatch.sources.raw_csv import read_raw_csv

HEADER = ["Time", *V_COLUMNS, "Amount", "Class"]


def write_csv(path, times):
    with open(path, "w", newline="") as f:
        out = csv.writer(f, quoting=csv.QUOTE_NONNUMERIC)
        out.writerow(HEADER)
        for t in times:
            out.writerow([t, *["0.1"] * 28, "125.50", "1"])


def test_csv_row_becomes_the_documented_event(spark, tmp_path):
    write_csv(tmp_path / "raw.csv", [str(float(i)) for i in range(11)])
    raw = read_raw_csv(spark, str(tmp_path / "raw.csv"))
    event = ev.to_events(raw.filter("Time = 10"), 100).head()
    assert event.transaction_id == "txn_00000010"
    assert event.amount == 125.5 and event.is_fraud == 1 and event.time_offset_seconds == 10.0
    assert event.V1 == event.V28 == 0.1 and event.user_id.startswith("user_")
    assert event.event_time == "2024-01-01T00:00:10+00:00"
    assert list(event.asDict()) == EVENT_SCHEMA.names


def test_row_index_is_dense_over_files_and_splits(spark, tmp_path):
    sizes = {"a.csv": 5000, "b.csv": 10, "c.csv": 3000}
    start = 0
    for name, n in sizes.items():
        write_csv(tmp_path / name, [str(float(start + i)) for i in range(n)])
        start += n
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        rows = read_raw_csv(spark, str(tmp_path))
        assert rows.rdd.getNumPartitions() > 3
        assert rows.count() == start
        assert rows.filter("row_index != cast(Time as long)").count() == 0
        assert sorted(r.row_index for r in read_raw_csv(spark, str(tmp_path), limit=7).collect()) == list(range(7))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def messages(spark, values):
    rows = [(bytearray(b"user_1"), bytearray(v.encode()), "t", 2, 10 + i) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "key binary, value binary, topic string, partition int, offset long")
    return df.withColumn("timestamp", F.current_timestamp())


def test_decode_survives_bad_text_fields_and_times(spark):
    good = {"transaction_id": "a", "user_id": "u", "event_time": "2024-01-01T00:00:10+00:00", "amount": 1.5, "is_fraud": 0}
    values = [
        json.dumps(good),
        "not json",
        json.dumps({**good, "amount": "x"}),
        json.dumps({**good, "event_time": "yesterday"}),
    ]
    rows = ev.decode_events(messages(spark, values), "fraud.topic").orderBy("_kafka_offset").collect()
    assert rows[0].amount == 1.5 and rows[0].event_time.isoformat() == "2024-01-01T00:00:10"
    assert rows[0]._source == "kafka:fraud.topic" and rows[0].kafka_key == "user_1"
    assert rows[1].transaction_id is None and rows[1]._kafka_offset == 11
    assert rows[2].amount is None and rows[2].transaction_id == "a"
    assert rows[3].event_time is None and rows[3].amount == 1.5


def test_encoded_events_decode_to_themselves(spark, tmp_path):
    write_csv(tmp_path / "raw.csv", ["1.5", "2.0"])
    events = ev.to_events(read_raw_csv(spark, str(tmp_path / "raw.csv")), 50)
    ev.write_events(events, "json", {"path": str(tmp_path / "topic")})
    back = spark.read.json(str(tmp_path / "topic")).collect()
    sent = {r.transaction_id: r for r in events.drop("produced_at").collect()}
    for row in back:
        body = json.loads(row.value)
        assert row.key == body["user_id"]
        want = sent[body["transaction_id"]].asDict()
        assert {k: body[k] for k in want} == want


def test_null_fields_stay_in_the_json(spark, tmp_path):
    write_csv(tmp_path / "raw.csv", ["1.5"])
    events = ev.to_events(read_raw_csv(spark, str(tmp_path / "raw.csv")), 50).withColumn("V3", F.lit(None).cast("double"))
    assert json.loads(ev.encode_events(events).head().value)["V3"] is None


def test_ingest_counters(spark):
    values = [json.dumps({"transaction_id": str(i), "is_fraud": i % 2}) for i in range(5)] + ["?"]
    decoded = ev.decode_events(messages(spark, values), "t")
    assert ev.ingest_metrics(decoded, elapsed_seconds=2).head().asDict() == {
        "sent": 5, "positives": 2, "errors": 1, "rate": 2.5,
    }
    assert ev.ingest_metrics(decoded, elapsed_seconds=0).head().rate == 0.0


def test_register_modes_and_key_check(spark):
    table = "featuresdb.profiles"
    first = spark.createDataFrame([("a", 1), ("b", 2)], "user_id string, n int")
    second = spark.createDataFrame([("a", 9)], "user_id string, n int")
    try:
        assert tables.register_features(first, table).count() == 2
        assert tables.feature_table_exists(spark, table)
        assert tables.register_features(second, table, mode="create_only").count() == 2
        assert tables.register_features(second, table, mode="refresh").head().n == 9
        for bad in ([("a", 1), ("a", 2)], [(None, 1)]):
            with pytest.raises(ValueError):
                tables.register_features(spark.createDataFrame(bad, "user_id string, n int"), table)
        assert tables.read_feature_table(spark, table).head().n == 9
        with pytest.raises(ValueError):
            tables.register_features(second, table, mode="append")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_a_version_is_in_force_until_the_next_is_whole(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    assert published.pointer(spark, path) is None
    with pytest.raises(ValueError):
        published.read_current(spark, path)
    versions = []
    for n in (1, 2, 3):
        versions.append(published.new_version(path))
        spark.range(n).write.parquet(f"{versions[-1]}/t")
        if n == 3:
            break  # A crash before the rename: written, but not in force.
        published.point(spark, path, versions[-1])
    assert published.read_current(spark, path, "t").count() == 2
    assert published.roll_back(spark, path) == versions[0] and published.read_current(spark, path, "t").count() == 1
    assert published.roll_back(spark, path) == versions[1]
    assert [p.name for p in tmp_path.iterdir() if "current" in p.name and not p.name.endswith(".crc")] == ["current"]


def test_registered_readers_keep_their_version(spark, tmp_path):
    one = spark.createDataFrame([("a", 1)], "user_id string, n int")
    two = spark.createDataFrame([("a", 5), ("b", 6)], "user_id string, n int")
    try:
        reader = tables.register_features(one, "kept_profiles", path=str(tmp_path))
        assert tables.register_features(two, "kept_profiles", path=str(tmp_path)).count() == 2
        assert reader.count() == 1 and len(list((tmp_path / "versions").iterdir())) == 2
        wider = two.withColumn("m", two.n + 1)
        assert tables.register_features(wider, "kept_profiles", path=str(tmp_path)).columns == ["user_id", "n", "m"]
    finally:
        spark.sql("DROP TABLE IF EXISTS kept_profiles")


def test_latest_and_columns(spark):
    df = spark.createDataFrame([("a", 1, 5), ("b", 3, 6), ("c", 3, 7)], "transaction_id string, event_time int, user_id int")
    assert [r.transaction_id for r in tables.latest(df, n=2).collect()] == ["b", "c"]
    assert tables.feature_columns(df) == ["transaction_id", "event_time"]
