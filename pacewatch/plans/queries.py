"""Registered queries: each operator over whole tables, with comparable outputs.

Doubles that are sums or averages of decimals are rounded to 8 places and the others to
6, timestamps and dates become text, and maps become one row per entry, so that results
can be compared by value across engines.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pacewatch.functions.scalars import account_bucket, feature_source
from pacewatch.operators import features as feat
from pacewatch.operators import incremental, metrics, model, online, quality, serving, split, trees
from pacewatch.operators.oversample import nearest_rows, positives, smote
from pacewatch.operators.panes import paned_rolling
from pacewatch.operators.rolling import rolling
from pacewatch.operators.stage import stage
from pacewatch.plans import adapter
from pacewatch.plans.refresh import run_refresh
from pacewatch.schema import (
    ACCOUNT_FEATURE_COLUMNS,
    EPOCH_ORIGIN_SECONDS,
    MODEL_COLUMNS,
    SPEND_FRAMES,
    TRANSACTION_FEATURE_COLUMNS,
    V_COLUMNS,
    VELOCITY_FRAMES,
    VOLATILITY_FRAMES,
)
from pacewatch.session import use_checkpoints
from pacewatch.sources import events as ev
from pacewatch.sources import key_value, published, tables
from pacewatch.sources.raw_csv import read_raw_csv
from pacewatch.streaming import bronze as bronze_stream
from pacewatch.streaming import counters, live, state

_EXACT = {"amount", *V_COLUMNS}
_FINE = {
    "total_amount_1h",
    "total_amount_24h",
    "avg_amount_24h",
    "max_amount_24h",
    "min_amount_24h",
    "max_amount_7d",
    "avg_amount_7d",
    *ACCOUNT_FEATURE_COLUMNS,
}
# An instant inside the data's month, used wherever a query needs a fixed clock.
NOW = "2024-01-25 00:00:00"
POOL = 5000
# Rows of a file that a query puts before a stream, about.
FILE_ROWS = 100_000


def text_time(c: str | Column) -> Column:
    t = F.col(c) if isinstance(c, str) else c
    return F.date_format(t, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def shown(df: DataFrame) -> DataFrame:
    """Comparable form of a result."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(name)
        if kind == "double" and name not in _EXACT:
            c = F.round(c, 8 if name in _FINE else 6)
        elif kind.startswith("timestamp"):
            c = text_time(name)
        elif kind == "date":
            c = c.cast("string")
        out.append(c.alias(name))
    return df.select(*out)


def scratch(spark: SparkSession) -> str:
    """A new folder of its own under the shared checkpoint folder."""
    return f"{use_checkpoints(spark)}/pacewatch-{uuid.uuid4().hex}"


# -- shared inputs ---------------------------------------------------------------


def _files(df: DataFrame, portions: int) -> int:
    """Files of a portion, so that none of them grows with the table."""
    return max(1, -(-df.count() // (portions * FILE_ROWS)))


def _staged(spark: SparkSession, sf: str) -> DataFrame:
    return stage(adapter.bronze(spark, sf))


def _routing(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Large accounts are looked for in the raw events; duplicates only overstate."""
    return {"count_from": adapter.transactions(spark, sf)}


def _features(spark: SparkSession, sf: str) -> DataFrame:
    return feat.transaction_features(_staged(spark, sf), **_routing(spark, sf))


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled rows with a made-up score of a thousand levels."""
    e = adapter.read_table(spark, sf, "events")
    k = F.get_json_object("props", "$.k").cast("long")
    return e.select(
        (F.col("event_type") == "error").cast("int").alias("is_fraud"),
        ((F.col("event_id") * 7919 + k * 31) % 1000 / F.lit(1000.0)).alias("probability"),
    )


def _now() -> Column:
    return F.to_timestamp(F.lit(NOW))


def _profiles(spark: SparkSession, sf: str) -> DataFrame:
    """Profiles from what happened before NOW."""
    past = _features(spark, sf).filter(F.col("event_time") < _now())
    return feat.account_features(past)


def _hashes(spark: SparkSession, sf: str) -> DataFrame:
    """Profiles as online rows that expire three days after the account's last activity."""
    profiles = _profiles(spark, sf)
    rows = online.to_online_hashes(profiles, now=_now())
    last = F.try_element_at("fields", F.lit("last_transaction_time")).cast("long")
    return rows.withColumn("expires_at", F.timestamp_seconds(last + 3 * 86400))


def _requests(spark: SparkSession, sf: str) -> DataFrame:
    """All transactions as requests, the smallest with amounts of zero or less."""
    return adapter.transactions(spark, sf).select("transaction_id", "user_id", (F.col("amount") - 5).alias("amount"), *V_COLUMNS)


def _rule(df: DataFrame) -> DataFrame:
    """Stand-in model: the further above the usual amount, the riskier."""
    r = F.col("amount_vs_avg_24h")
    return df.withColumn("probability", F.when(r > 2, 0.95).when(r > 1, 0.4123456).otherwise(0.05))


def _raw_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Events in the shape of the raw CSV, numbered by event id."""
    t = adapter.transactions(spark, sf)
    micros = F.unix_micros("event_time") - EPOCH_ORIGIN_SECONDS * 1_000_000
    return t.select(
        F.col("_kafka_offset").alias("row_index"),
        (micros / F.lit(1_000_000.0)).alias("Time"),
        *V_COLUMNS,
        F.col("amount").alias("Amount"),
        F.col("is_fraud").alias("Class"),
    )


def _messages(spark: SparkSession, sf: str) -> DataFrame:
    """Events as topic messages, some of them broken text and some with a bad amount."""
    events = ev.to_events(_raw_rows(spark, sf), POOL)
    encoded = ev.encode_events(events, keep=["transaction_id", "V1", "V2"])
    bad_amount = F.regexp_replace("value", '"amount":[0-9.E-]+', '"amount":"x"')
    value = (
        F.when(F.col("V1") > 3.5, F.concat(F.lit("#"), "value"))
        .when(F.col("V2") > 3.5, bad_amount)
        .otherwise(F.col("value"))
    )
    return encoded.select(
        F.col("key").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit("transactions").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("transaction_id").substr(5, 20).cast("long").alias("offset"),
        F.timestamp_seconds(F.lit(EPOCH_ORIGIN_SECONDS)).alias("timestamp"),
    )


def _decoded_view(decoded: DataFrame) -> DataFrame:
    stable = decoded.drop("produced_at", "_ingested_at", "_kafka_timestamp")
    return stable.select(*[text_time(c).alias(c) if c == "event_time" else F.col(c) for c in stable.columns])


# -- staging and rolling features ------------------------------------------------


def stage_dedupe(spark, sf):
    return shown(_staged(spark, sf))


def velocity(spark, sf):
    return shown(feat.velocity_features(_staged(spark, sf), **_routing(spark, sf)))


def spend(spark, sf):
    return shown(feat.spend_features(_staged(spark, sf), **_routing(spark, sf)))


def volatility(spark, sf):
    return shown(feat.volatility_features(_staged(spark, sf), **_routing(spark, sf)))


def transaction_features(spark, sf):
    return shown(_features(spark, sf))


def assemble_features(spark, sf):
    base, routing = _staged(spark, sf), _routing(spark, sf)
    return shown(
        feat.assemble_features(
            base,
            feat.velocity_features(base, **routing),
            feat.spend_features(base, **routing),
            feat.volatility_features(base, **routing),
        )
    )


def rolling_ties_orders(spark, sf):
    orders = adapter.order_transactions(spark, sf)
    frames = VELOCITY_FRAMES | {"avg_amount_7d": ("avg", "7d"), "amount_stddev_7d": ("stddev", "7d")}
    return shown(rolling(orders, frames, "seconds_since_last_txn").drop("event_time", "amount"))


def rolling_hot_accounts(spark, sf):
    """Accounts of more than 60 transactions take the paned plan, the others the native one."""
    staged = _staged(spark, sf)
    return shown(feat.transaction_features(staged, hot_rows=60, **_routing(spark, sf)))


def rolling_paned(spark, sf):
    """Every account through the paned plan."""
    columns = ["transaction_id", "user_id", "event_time", "event_time_unix", "amount"]
    frames = VELOCITY_FRAMES | SPEND_FRAMES | VOLATILITY_FRAMES
    framed = paned_rolling(_staged(spark, sf).select(*columns), frames, "seconds_since_last_txn")
    return shown(framed)


def incremental_features(spark, sf):
    """Features kept current by an incremental step; late and new rows arrive together."""
    staged = _staged(spark, sf)
    is_fresh = (F.col("event_time") >= _now()) | (F.col("V7") > 3.8)
    before = feat.transaction_features(staged.filter(~is_fresh), **_routing(spark, sf))
    changed = incremental.incremental_features(staged, staged.filter(is_fresh))
    return shown(incremental.merge_features(before, changed).select(*TRANSACTION_FEATURE_COLUMNS))


def partitioned_features(spark, sf):
    """The feature table as written by label, read back through partition pruning."""
    path = scratch(spark)
    tables.write_features(_features(spark, sf), path)
    kept = split.positives(spark.read.parquet(path))
    return shown(kept.select("transaction_id", "user_id", "amount", "is_fraud", "total_amount_24h"))


# -- account profiles ------------------------------------------------------------


def account_features(spark, sf):
    return shown(feat.account_features(_features(spark, sf)))


def account_features_raw(spark, sf):
    return shown(feat.account_features(_features(spark, sf), fill_nulls=False))


def account_preview(spark, sf):
    profiles = feat.account_features(_features(spark, sf))
    return shown(tables.preview(profiles, 5, ["user_id"]))


# -- events ----------------------------------------------------------------------


def raw_csv(spark, sf):
    """Raw rows written as CSV files in order and read back with their row index."""
    path = scratch(spark)
    rows = _raw_rows(spark, sf)
    ordered = rows.repartitionByRange("row_index").sortWithinPartitions("row_index")
    ordered.drop("row_index").write.option("header", True).csv(path)
    return read_raw_csv(spark, path)


def account_buckets(spark, sf):
    raw = _raw_rows(spark, sf)
    return raw.select("row_index", account_bucket("row_index", "Time", POOL).alias("user_id"))


def to_events(spark, sf):
    return ev.to_events(_raw_rows(spark, sf), POOL).drop("produced_at")


def decode_events(spark, sf):
    return _decoded_view(ev.decode_events(_messages(spark, sf), "transactions"))


def ingest_metrics(spark, sf):
    return ev.ingest_metrics(ev.decode_events(_messages(spark, sf), "transactions"))


def bronze_ingest(spark, sf):
    """The same messages through a stream that drains them and stops."""
    path = scratch(spark)
    _messages(spark, sf).write.parquet(f"{path}/topic")
    query = bronze_stream.bronze_stream(
        spark,
        "transactions",
        f"{path}/checkpoint",
        fmt="parquet",
        options={"path": f"{path}/topic"},
        path=f"{path}/bronze",
        mode="once",
        query_name=f"bronze_{uuid.uuid4().hex}",
    )
    query.awaitTermination()
    return _decoded_view(spark.read.parquet(f"{path}/bronze"))


def _drained(spark: SparkSession, path: str, **change) -> DataFrame:
    query = bronze_stream.bronze_stream(
        spark,
        "transactions",
        f"{path}/checkpoint",
        **{
            "fmt": "parquet",
            "options": {"path": f"{path}/topic"},
            "path": f"{path}/bronze",
            "mode": "once",
            "query_name": f"bronze_{uuid.uuid4().hex}",
            **change,
        },
    )
    query.awaitTermination()
    return spark.read.parquet(f"{path}/bronze")


def _made_once(spark: SparkSession, sf: str, path: str) -> DataFrame:
    """Messages carry the time they are made, so what is dealt out in portions is written first."""
    made = _messages(spark, sf)
    made.write.parquet(f"{path}/made")
    return spark.read.schema(made.schema).parquet(f"{path}/made")


def bronze_restart(spark, sf):
    """A stream that breaks off between taking messages in and writing them, gets more, and goes on."""
    path = scratch(spark)
    messages = _made_once(spark, sf, path)
    early = F.pmod(F.xxhash64("value"), F.lit(3)) > 0
    messages.filter(early).write.parquet(f"{path}/topic")
    topic = bronze_stream.read_events_stream(spark, "parquet", {"path": f"{path}/topic"})
    # The offsets are logged before the first row of the batch is read, and that read fails.
    failing = ev.decode_events(topic, "transactions").withColumn(
        "user_id", F.when(F.length("user_id") > 0, F.raise_error(F.lit("power cut")).cast("string")).otherwise(F.col("user_id"))
    )
    try:
        bronze_stream.start_bronze(failing, f"{path}/checkpoint", path=f"{path}/bronze", mode="once", query_name=f"broken_{uuid.uuid4().hex}").awaitTermination()
        raise AssertionError("the first run was to fail")
    except StreamingQueryException:
        messages.filter(~early).write.mode("append").parquet(f"{path}/topic")
    return _decoded_view(_drained(spark, path))


def bronze_interval(spark, sf):
    """The same messages in three portions through a stream that polls at an interval."""
    path = scratch(spark)
    messages = _made_once(spark, sf, path)
    share = F.pmod(F.xxhash64("value"), F.lit(3))
    portions = [lambda n=n: messages.filter(share == n).write.mode("append").parquet(f"{path}/topic") for n in range(3)]
    portions[0]()
    query = bronze_stream.bronze_stream(
        spark, "transactions", f"{path}/checkpoint", fmt="parquet", options={"path": f"{path}/topic"},
        path=f"{path}/bronze", mode="continuous", interval="200 milliseconds", query_name=f"bronze_{uuid.uuid4().hex}",
    )
    batches = bronze_stream.run_batches(query, [lambda: None, *portions[1:]])
    if batches < 3:
        raise AssertionError(f"{batches} batches for three portions")
    return _decoded_view(spark.read.parquet(f"{path}/bronze"))


def stream_metrics(spark, sf):
    """What a listener wrote of the counters of every batch, summed up."""
    path = scratch(spark)
    messages = _messages(spark, sf)
    files = _files(messages, 4)
    messages.repartition(4 * files).write.parquet(f"{path}/topic")
    counted = counters.IngestCounters(spark, f"{path}/counters", flush_rows=2)
    spark.streams.addListener(counted)
    try:
        topic = bronze_stream.read_events_stream(spark, "parquet", {"path": f"{path}/topic", "maxFilesPerTrigger": str(files)})
        events = ev.observe_ingest(ev.decode_events(topic, "transactions"))
        query = bronze_stream.start_bronze(events, f"{path}/checkpoint", path=f"{path}/bronze", mode="once", query_name=f"counted_{uuid.uuid4().hex}")
        query.awaitTermination()
        if not counted.wait(str(query.runId)):
            raise TimeoutError("the listener did not hear of the end")
    finally:
        spark.streams.removeListener(counted)
    return counters.read_counters(spark, f"{path}/counters").agg(*(F.sum(c).alias(c) for c in ("sent", "positives", "errors")))


def live_features(spark, sf):
    """Features kept by a stream in several batches; equal to a full rebuild."""
    path = scratch(spark)
    raw = adapter.bronze(spark, sf)
    files = _files(raw, 3)
    # Many rows may have come at one instant; their places in the topic tell them apart.
    raw.repartitionByRange(3 * files, "_ingested_at", "_kafka_offset").write.parquet(f"{path}/bronze")
    events = (
        spark.readStream.schema(raw.schema)
        .option("maxFilesPerTrigger", 2 * files)
        .parquet(f"{path}/bronze")
    )
    live.start_features(
        events, f"{path}/staged", f"{path}/features", f"{path}/checkpoint", mode="once"
    ).awaitTermination()
    current = live.current_features(spark, f"{path}/features")
    return shown(current.select("transaction_id", "user_id", "txn_count_7d", "seconds_since_last_txn", "total_amount_24h", "amount_zscore_7d"))


def _stateful(spark: SparkSession, sf: str, lateness: str, newest_first: bool) -> DataFrame:
    """Features of a stream of four batches, by arrival or against it, kept in state."""
    path = scratch(spark)
    raw = adapter.bronze(spark, sf)
    ends = raw.select(F.unix_seconds("_ingested_at").alias("s")).approxQuantile("s", [0.25, 0.5, 0.75], 0.01)
    part = sum(((F.unix_seconds("_ingested_at") > int(end)).cast("int") for end in ends), F.lit(0))
    files = _files(raw, len(ends) + 1)
    for batch in sorted(range(len(ends) + 1), reverse=newest_first):
        raw.filter(part == batch).repartition(files).write.mode("append").parquet(f"{path}/bronze")
    events = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", files).parquet(f"{path}/bronze")
    state.start_state_features(events, f"{path}/features", f"{path}/checkpoint", lateness, mode="once").awaitTermination()
    current = state.current_state_features(spark, f"{path}/features")
    return shown(current.select("transaction_id", "user_id", "txn_count_7d", "seconds_since_last_txn", "total_amount_24h", "amount_zscore_7d"))


def state_features(spark, sf):
    """Features kept in the state store, batches in the order of arrival; equal to a full rebuild."""
    return _stateful(spark, sf, "2 days", newest_first=False)


def state_features_late(spark, sf):
    """The same with the newest batch first: every later batch corrects rows that are out already."""
    return _stateful(spark, sf, "60 days", newest_first=True)


def latest_events(spark, sf):
    t = adapter.transactions(spark, sf)
    columns = ["transaction_id", "user_id", "event_time", "amount", "is_fraud"]
    return shown(tables.latest(tables.project(t, columns)))


# -- data quality ----------------------------------------------------------------


def _dirty(spark: SparkSession, sf: str) -> DataFrame:
    t = adapter.transactions(spark, sf)
    again = t.filter("event_type = 'purchase'")
    return t.unionByName(again).withColumns(
        {
            "user_id": F.when(F.col("event_type") != "signup", F.col("user_id")),
            "amount": F.when(F.col("amount") >= 5, F.col("amount")),
            "is_fraud": F.when(F.col("event_type") == "view", 2).otherwise(F.col("is_fraud")),
        }
    )


def dq_report(spark, sf):
    checks = quality.bronze_checks() + [
        quality.unique("transaction_id"),
        quality.expression_true("amount", ">= 40"),
    ]
    return quality.run_checks(_dirty(spark, sf), checks)


def dq_features(spark, sf):
    return quality.run_checks(_features(spark, sf), quality.transaction_checks())


def dq_failing_rows(spark, sf):
    check = quality.accepted_values("is_fraud", [0, 1])
    return check.failures(_dirty(spark, sf)).select("transaction_id", "user_id", "is_fraud")


def dq_primary_key(spark, sf):
    return quality.primary_key(_dirty(spark, sf), ["transaction_id"])


def dq_freshness(spark, sf):
    return shown(quality.freshness(_dirty(spark, sf), now=_now()))


# -- split and quality metrics ---------------------------------------------------


def time_split_point(spark, sf):
    return shown(split.time_split_point(adapter.transactions(spark, sf)))


def time_split_summary(spark, sf):
    train, test = split.time_split(adapter.transactions(spark, sf))
    return shown(split.split_summary(train, test))


def confusion(spark, sf):
    return metrics.confusion(_scored(spark, sf))


def threshold_metrics(spark, sf):
    return shown(metrics.threshold_metrics(_scored(spark, sf)))


def roc_auc(spark, sf):
    return shown(metrics.roc_auc(_scored(spark, sf)))


def average_precision(spark, sf):
    return shown(metrics.average_precision(_scored(spark, sf)))


def score_curve(spark, sf):
    return metrics.score_curve(_scored(spark, sf))


def evaluate(spark, sf):
    return shown(metrics.evaluate(_scored(spark, sf)))


# -- online rows and scoring -----------------------------------------------------


def online_hashes(spark, sf):
    rows = online.to_online_hashes(feat.account_features(_features(spark, sf)), now=_now())
    return rows.select(
        "key", F.explode("fields").alias("field", "text"), text_time("expires_at").alias("expires_at")
    ).select("key", "field", F.round(F.col("text").cast("double"), 8).alias("value"), "expires_at")


def _lossy_client(uri: str):
    """A file client whose first pipeline in a task breaks off when half is sent."""

    class Lossy(key_value.FileClient):
        lost = False

        def put(self, name: str, data: bytes) -> None:
            if not self.lost:
                self.lost = True
                with self.files.open_output_stream(f"{self.folder}/_half_{name}") as out:
                    out.write(data[: len(data) // 2])
                raise ConnectionError("connection lost")
            super().put(name, data)

    return Lossy(uri)


def online_written(spark, sf):
    """The online rows as an external writer put them, through a lost connection in every task, read back."""
    uri = f"{scratch(spark)}/store"
    hashes = online.to_online_hashes(feat.account_features(_features(spark, sf)), now=_now())
    online.write_online(hashes, functools.partial(_lossy_client, uri), batch=50)
    rows = key_value.read_written(spark, uri).withColumn("expires_at", _now().cast("timestamp") + F.make_dt_interval(secs=F.col("ttl")))
    return rows.select(
        "key", F.explode("fields").alias("field", "text"), text_time("expires_at").alias("expires_at")
    ).select("key", "field", F.round(F.col("text").cast("double"), 8).alias("value"), "expires_at")


def online_merge(spark, sf):
    """Stored rows meet a sync that brings one old field, one new field and new accounts."""
    t = adapter.transactions(spark, sf)
    stored = (
        t.filter(F.col("event_time") < _now())
        .groupBy("user_id")
        .agg(
            F.max("amount").alias("max_amount_all_time"),
            F.count(F.lit(1)).alias("seen_before"),
            F.max("event_time").alias("_last"),
        )
    )
    old = online.to_online_hashes(stored.drop("_last")).drop("expires_at")
    expiry = stored.select(
        online.online_key("user_id").alias("key"),
        (F.col("_last") + F.expr("interval 1 day")).alias("expires_at"),
    )
    fresh = (
        t.filter(F.col("event_time") >= _now() - F.expr("interval 12 hours"))
        .groupBy("user_id")
        .agg(F.max("amount").alias("max_amount_all_time"), F.count(F.lit(1)).alias("total_txn_count"))
    )
    merged = online.merge_online(
        old.join(expiry, "key"), online.to_online_hashes(fresh, now=_now()), now=_now()
    )
    return merged.select(
        "key", F.explode("fields").alias("field", "text"), text_time("expires_at").alias("expires_at")
    ).select("key", "field", F.round(F.col("text").cast("double"), 8).alias("value"), "expires_at")


def lookup(spark, sf):
    found = online.lookup_features(_requests(spark, sf), _hashes(spark, sf), now=_now())
    usual = F.try_element_at("fields", F.lit("avg_amount_all_time"))
    return found.select(
        "transaction_id",
        "user_id",
        feature_source("fields").alias("feature_source"),
        F.round(usual, 8).alias("avg_amount_all_time"),
    )


def proxy_vector(spark, sf):
    found = online.lookup_features(_requests(spark, sf), _hashes(spark, sf), now=_now())
    return shown(serving.proxy_vector(found).select("transaction_id", *MODEL_COLUMNS))


def score_rule(spark, sf):
    scored = serving.score(_requests(spark, sf), _hashes(spark, sf), _rule, now=_now())
    return scored.drop("threshold")


def score_stream(spark, sf):
    """The same requests as a stream in two runs, with the profiles overwritten in between."""
    path = scratch(spark)
    asked = _requests(spark, sf)
    profiles = _hashes(spark, sf).checkpoint()
    for part in range(2):
        profiles.write.mode("overwrite").parquet(f"{path}/profiles")
        half = F.pmod(F.xxhash64("transaction_id"), F.lit(2)) == part
        asked.filter(half).write.mode("append").parquet(f"{path}/requests")
        live.start_scoring(
            spark.readStream.schema(asked.schema).parquet(f"{path}/requests"),
            lambda s: s.read.parquet(f"{path}/profiles"),
            _rule,
            f"{path}/out",
            f"{path}/checkpoint",
            mode="once",
            now=_now(),
        ).awaitTermination()
    return spark.read.parquet(f"{path}/out/scored").drop("threshold", "batch_id")


def audit_log(spark, sf):
    scored = serving.score(_requests(spark, sf), _hashes(spark, sf), _rule, now=_now())
    record = F.from_json(
        "record",
        "event string, transaction_id string, user_id string, amount double, fraud_probability double,"
        " decision string, threshold double, feature_source string, timestamp string",
    )
    return serving.audit_records(scored, now=_now()).select(record.alias("r")).select("r.*")


def rejected(spark, sf):
    _, refused = serving.validate(_requests(spark, sf))
    return refused.select("transaction_id", "user_id", "amount")


# -- training --------------------------------------------------------------------


def _rare(spark: SparkSession, sf: str) -> DataFrame:
    """Features with a label rare enough to need oversampling."""
    t = adapter.transactions(spark, sf).drop("event_type")
    return feat.transaction_features(stage(t), **_routing(spark, sf)).withColumn(
        "is_fraud", ((F.col("is_fraud") == 1) & (F.col("amount") > 60)).cast("int")
    )


def smote_counts(spark, sf):
    """Rows by label; the values are summed up too, so that they are computed."""
    finite = F.lit(True)
    for c in MODEL_COLUMNS:
        finite = finite & (F.abs(c) < float("inf"))
    rows = smote(_rare(spark, sf)).groupBy("is_fraud")
    return rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if(finite).alias("finite_rows"))


def smote_neighbours(spark, sf):
    """How far the five nearest other positives of every positive lie."""
    return shown(nearest_rows(positives(_rare(spark, sf)), 5))


def smote_rows(spark, sf):
    """Every synthetic row's draws, and whether it lies where they put it between two positives."""
    rare = _rare(spark, sf).checkpoint() if use_checkpoints(spark) else None
    values = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in MODEL_COLUMNS])
    positive = rare.filter("is_fraud = 1").select(values.alias("v")).distinct()
    made = smote(rare, draws=True)
    for end in ("base", "towards"):
        ends = positive.select(F.col("v").alias(end), F.lit(True).alias(f"{end}_known"))
        made = made.join(ends, end, "left")
    apart = F.zip_with(F.zip_with("base", "towards", lambda a, b: a + F.col("gap") * (b - a)), "point", lambda x, y: F.abs(x - y))
    return made.select(
        "i",
        "index",
        "which",
        "gap",
        F.coalesce(F.col("base_known") & F.col("towards_known"), F.lit(False)).alias("between_positives"),
        (F.array_max(apart) == 0).alias("on_segment"),
    )


def _fitted(spark: SparkSession, sf: str):
    """Features are read from a written table, as in a real run; parameters are the defaults."""
    path = scratch(spark)
    _rare(spark, sf).write.parquet(path)
    train, test = split.time_split(spark.read.parquet(path))
    fitted = model.train(smote(train))
    return fitted, test


def _saved(spark: SparkSession, sf: str):
    """A fitted model, the rows it has not seen, its nodes as a table, and the depth of its trees."""
    fitted, test = _fitted(spark, sf)
    path = f"{scratch(spark)}/model"
    model.save_model(fitted, path)
    return fitted, test, trees.node_table(spark, path), trees.depth_of(spark, path)


def gbt_score(spark, sf):
    """Every later row scored by the fitted model and by a walk through its nodes as a table."""
    fitted, test, nodes, depth = _saved(spark, sf)
    walked = trees.walk(test, nodes, depth).withColumnRenamed("probability", "walked")
    scored = model.predict(fitted, test).join(walked, "transaction_id", "left")
    p = F.col("probability")
    return scored.select(
        "transaction_id",
        "is_fraud",
        ((p >= 0) & (p <= 1)).alias("in_range"),
        F.coalesce(F.abs(p - F.col("walked")) < 1e-9, F.lit(False)).alias("same_by_nodes"),
    )


def importances(spark, sf):
    """Every model input's weight from the table of nodes beside the fitted model's, in falling order."""
    fitted, _, nodes, _ = _saved(spark, sf)
    own = trees.importances(nodes).withColumnRenamed("importance", "by_nodes")
    both = model.importances(fitted, spark).join(own, "feature")
    ranked = both.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("importance"), "feature")))
    top = Window.orderBy("rank")
    fine = ranked.select(
        "rank",
        F.coalesce(F.lag("by_nodes").over(top) >= F.col("by_nodes") - 1e-9, F.lit(True)).alias("ordered"),
        (F.abs(F.col("importance") - F.col("by_nodes")) < 1e-9).alias("same_by_nodes"),
        F.round(F.sum("by_nodes").over(Window.partitionBy()), 6).alias("total"),
    )
    return fine


def training_report(spark, sf):
    """The training step on a written feature table: set sizes and properties that must hold."""
    path = scratch(spark)
    _rare(spark, sf).write.parquet(f"{path}/features")
    _, report = model.run_training(spark.read.parquet(f"{path}/features"), f"{path}/run")
    again = model.load_model(f"{path}/run/model")
    test = split.time_split(spark.read.parquet(f"{path}/features"))[1]
    scored = model.predict(again, test).select("probability")
    weights = spark.read.json(f"{path}/run/importances")
    bounded = F.count_if((F.col("probability") < 0) | (F.col("probability") > 1)).cast("double")
    rows = [
        report.filter("metric in ('test_size', 'test_positives')"),
        scored.agg(F.lit("outside_0_1").alias("metric"), bounded.alias("value")),
        scored.agg(F.lit("scored_by_saved_model").alias("metric"), F.count("probability").cast("double").alias("value")),
        weights.agg(F.lit("importances_sum").alias("metric"), F.round(F.sum("importance"), 6).alias("value")),
        report.filter("metric = 'roc_auc'").select(F.lit("auc_above_half").alias("metric"), (F.col("value") > 0.5).cast("double").alias("value")),
    ]
    out = rows[0]
    for part in rows[1:]:
        out = out.unionByName(part)
    return out


def csv_first_rows(spark, sf):
    """The first hundred rows of the raw CSV, by row index."""
    path = scratch(spark)
    rows = _raw_rows(spark, sf)
    rows.repartitionByRange("row_index").sortWithinPartitions("row_index").drop("row_index").write.option("header", True).csv(path)
    return read_raw_csv(spark, path, limit=100)


def topic_files(spark, sf):
    """Keyed JSON events as a sink wrote them, read back, with the producer's stamp in place."""
    path = scratch(spark)
    ev.write_events(ev.to_events(_raw_rows(spark, sf), POOL), "parquet", {"path": path})
    field = lambda name: F.get_json_object("value", f"$.{name}")
    stamped = F.abs(F.unix_seconds(F.to_timestamp(field("produced_at"))) - F.unix_seconds(F.current_timestamp())) < 86400
    return spark.read.parquet(path).select(
        F.col("key").alias("user_id"),
        field("transaction_id").alias("transaction_id"),
        field("amount").cast("double").alias("amount"),
        field("event_time").alias("event_time"),
        stamped.alias("stamped"),
    )


def schema_contract(spark, sf):
    """Required columns of the unfilled profiles, two of them dropped: which are there, and how many rows hold a value."""
    profiles = feat.account_features(_features(spark, sf), fill_nulls=False).drop("avg_v3", "max_velocity_1h")
    return quality.column_coverage(profiles)


def refresh_report(spark, sf):
    """All scheduled steps on dirty events; the report lists every check, and nothing is published."""
    path = scratch(spark)
    name = f"profiles_{uuid.uuid4().hex}"
    dirty = adapter.bronze(spark, sf).withColumns(
        {
            "user_id": F.when(F.col("V1") <= 3.5, F.col("user_id")),
            "is_fraud": F.when(F.col("V2") > 3.5, 2).otherwise(F.col("is_fraud")),
        }
    )
    report = run_refresh(spark, dirty, path, name)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    return report.select("table", "check", "column", "failures", "published")


def publish_report(spark, sf):
    """What is registered and published after each of five runs: made, left alone, refused, replaced, taken back."""
    path, name = scratch(spark), f"published_{uuid.uuid4().hex}"
    whole = adapter.bronze(spark, sf)
    part = whole.filter("V1 <= 0")
    dirty = whole.withColumn("is_fraud", F.when(F.col("V2") > 3.5, 2).otherwise(F.col("is_fraud")))
    seen = None
    runs = [("create", whole, "create_only"), ("create_again", part, "create_only"), ("dirty", dirty, "refresh"), ("refresh", part, "refresh")]
    for place, (step, bronze, mode) in enumerate([*runs, ("roll_back", None, "")]):
        if bronze is None:
            published.roll_back(spark, path)
            done = True
        else:
            done = run_refresh(spark, bronze, path, name, mode).filter("not published").isEmpty()
        table = tables.read_feature_table(spark, name)
        held = table.agg(F.count(F.lit(1)).alias("accounts"), F.sum("total_txn_count").alias("transactions"))
        rows = published.read_current(spark, path, "staged").count()
        # One row a step, written: the name moves on to other files.
        out = held.select(F.lit(place).alias("place"), F.lit(step).alias("step"), F.lit(done).alias("done"), "*", F.lit(rows).cast("long").alias("published_rows")).checkpoint()
        seen = out if seen is None else seen.unionByName(out)
    exists = tables.feature_table_exists(spark, name)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    return seen.withColumn("registered", F.lit(exists))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        stage_dedupe,
        velocity,
        spend,
        volatility,
        transaction_features,
        assemble_features,
        rolling_ties_orders,
        rolling_hot_accounts,
        rolling_paned,
        incremental_features,
        partitioned_features,
        account_features,
        account_features_raw,
        account_preview,
        raw_csv,
        account_buckets,
        to_events,
        decode_events,
        ingest_metrics,
        bronze_ingest,
        bronze_restart,
        bronze_interval,
        stream_metrics,
        live_features,
        state_features,
        state_features_late,
        latest_events,
        dq_report,
        dq_features,
        dq_failing_rows,
        dq_primary_key,
        dq_freshness,
        time_split_point,
        time_split_summary,
        confusion,
        threshold_metrics,
        roc_auc,
        average_precision,
        score_curve,
        evaluate,
        online_hashes,
        online_written,
        online_merge,
        lookup,
        proxy_vector,
        score_rule,
        score_stream,
        audit_log,
        rejected,
        smote_counts,
        smote_rows,
        smote_neighbours,
        gbt_score,
        importances,
        training_report,
        csv_first_rows,
        topic_files,
        schema_contract,
        refresh_report,
        publish_report,
    )
}
