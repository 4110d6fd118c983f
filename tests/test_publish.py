"""Counters, restarts and the file store, at their edges."""

import json

import pytest
from pyspark.sql import functions as F

from pacewatch.operators import online
from pacewatch.schema import TOPIC_SCHEMA
from pacewatch.sources import key_value
from pacewatch.sources.events import decode_events, observe_ingest
from pacewatch.streaming import bronze, counters


def put(spark, path, ids):
    rows = [
        (bytearray(b"k"), bytearray(json.dumps({"transaction_id": f"t{i}", "user_id": "u", "amount": 1.0, "is_fraud": i % 2}).encode()), "t", 0, i, None)
        for i in ids
    ]
    spark.createDataFrame(rows, TOPIC_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_counters_become_rows_by_batch(spark, tmp_path):
    topic, out = str(tmp_path / "topic"), str(tmp_path / "counters")
    for part in (range(4), range(4, 10), range(10, 11)):
        put(spark, topic, part)
    listener = counters.IngestCounters(spark, out)
    spark.streams.addListener(listener)
    try:
        events = observe_ingest(decode_events(bronze.read_events_stream(spark, "parquet", {"path": topic, "maxFilesPerTrigger": "1"}), "t"))
        query = bronze.start_bronze(events, str(tmp_path / "c"), path=str(tmp_path / "b"), mode="once", query_name="counted")
        query.awaitTermination()
        assert listener.wait(str(query.runId))
    finally:
        spark.streams.removeListener(listener)
    rows = counters.read_counters(spark, out).orderBy("batch").collect()
    assert [(r.batch, r.sent, r.positives, r.errors) for r in rows] == [(0, 4, 2, 0), (1, 6, 3, 0), (2, 1, 0, 0)]
    assert all(r.rate > 0 for r in rows)


def test_a_batch_that_reports_twice_counts_once(spark, tmp_path):
    rows = [("q", "r1", 0, "2024-01-01T00:00:00Z", 3, 1, 0, 1.0), ("q", "r2", 0, "2024-01-01T00:01:00Z", 5, 2, 0, 1.0)]
    spark.createDataFrame(rows, counters.SCHEMA).write.json(str(tmp_path / "c"))
    got = counters.read_counters(spark, str(tmp_path / "c")).collect()
    assert [(r.batch, r.sent) for r in got] == [(0, 5)]


def test_a_driven_stream_gives_up_on_its_error(spark, tmp_path):
    topic = str(tmp_path / "topic")
    put(spark, topic, range(3))
    events = decode_events(bronze.read_events_stream(spark, "parquet", {"path": topic}), "t")
    broken = events.withColumn("user_id", F.when(F.col("amount") > 0, F.raise_error(F.lit("no")).cast("string")))
    query = bronze.start_bronze(broken, str(tmp_path / "c"), path=str(tmp_path / "b"), interval="100 milliseconds", query_name="broken")
    with pytest.raises(Exception, match="no"):
        bronze.run_batches(query, [lambda: None], seconds=60)


def test_the_file_store_is_idempotent_and_never_half(spark, tmp_path):
    uri = str(tmp_path / "store")
    client = key_value.FileClient(uri)
    for _ in range(2):
        commands = client.pipeline()
        commands.hset("a", mapping={"x": "1"})
        commands.hset("a", mapping={"y": "2"})
        commands.expire("a", 60)
        commands.expire("unknown", 60)
        commands.execute()
    (tmp_path / "store" / "_half").write_text("{")
    assert [r.asDict() for r in key_value.read_written(spark, uri).collect()] == [{"key": "a", "fields": {"x": "1", "y": "2"}, "ttl": 60}]
    df = spark.createDataFrame([(f"k{i}", {"f": str(i)}) for i in range(25)], "key string, fields map<string,string>").repartition(3)
    for _ in range(2):
        online.write_online(df, lambda: key_value.FileClient(uri), batch=4, ttl=9)
    got = {r.key: (r.fields, r.ttl) for r in key_value.read_written(spark, uri).collect()}
    assert len(got) == 26 and got["k7"] == ({"f": "7"}, 9)
