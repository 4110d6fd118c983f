"""Stateful features: late rows, redeliveries, silence, and a state that stays bounded."""

import random

import pytest
from pyspark.sql import functions as F

from pacewatch.operators.features import transaction_features
from pacewatch.operators.stage import stage
from pacewatch.schema import ROLLING_COLUMNS, V_COLUMNS
from pacewatch.streaming import state

DAY = 86_400
SCHEMA = (
    "transaction_id string, user_id string, event_time timestamp, amount double, is_fraud int, "
    + ", ".join(f"{v} double" for v in V_COLUMNS)
    + ", _kafka_partition int, _kafka_offset long, _ingested_at timestamp, extra string"
)


def events(spark, rows):
    """Rows (id, account, second, amount, arrival); the place in the topic is the place in the list."""
    made = [(i, u, s, a, at, n) for n, (i, u, s, a, at) in enumerate(rows)]
    df = spark.createDataFrame(made, "i string, u string, s long, a double, at long, n long")
    columns = {"transaction_id": "i", "user_id": "u", "amount": "a"}
    named = [F.col(c).alias(name) for name, c in columns.items()] + [F.timestamp_seconds("s").alias("event_time")]
    rest = [F.lit(0).alias("is_fraud"), *(F.lit(0.0).alias(v) for v in V_COLUMNS)]
    rest += [F.lit(0).alias("_kafka_partition"), F.col("n").alias("_kafka_offset"), F.timestamp_seconds("at").alias("_ingested_at")]
    df = df.select(*named, *rest, F.lit("x").alias("extra"))
    return df.select(*[F.col(f.split()[0]) for f in SCHEMA.split(", ")])


def run(spark, path, batches, lateness="60 days"):
    """Feed the batches one after the other, each in a run of its own, so that every start is a restart."""
    for batch in batches:
        events(spark, batch).coalesce(1).write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
        state.start_state_features(stream, f"{path}/out", f"{path}/checkpoint", lateness, mode="once").awaitTermination()
    return state.current_state_features(spark, f"{path}/out")


def rows_of(df):
    names = ["transaction_id", "user_id", "event_time", "amount", *ROLLING_COLUMNS]
    return sorted(tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in df.select(*names).collect())


def rebuilt(spark, batches):
    return rows_of(transaction_features(stage(events(spark, [r for b in batches for r in b]))))


def batch_of(seed, n, days):
    rng = random.Random(seed)
    start = 1_704_067_200
    return [
        (f"t{seed}_{k}", rng.choice(["a", "b", None, "hot", "hot"]), start + rng.randrange(days * DAY), rng.choice([None, 1.0, rng.random() * 90]), 5_000_000_000 + k)
        for k in range(n)
    ]


@pytest.mark.parametrize("turn", [1, -1])
def test_state_equals_a_rebuild_in_any_order(spark, tmp_path, turn):
    batches = [batch_of(s, 120, 30) for s in range(3)]
    first = batches[0][0]
    # Redeliveries: one that came later loses in a later batch, one that came earlier wins there.
    batches[1].append((first[0], first[1], first[2], 999.0, first[4] + 10))
    second = batches[0][1]
    batches[2].append((second[0], second[1], second[2], 555.0, second[4] - 10_000))
    # Ties of a second, the edges of the windows, and one batch with the same row twice.
    at = 1_704_067_200 + 3 * DAY
    batches[2] += [(f"e{d}", "edge", at + d, 2.0, 6_000_000_000) for d in (0, 0.5, 3600, 3601, DAY, DAY + 1, 7 * DAY, 7 * DAY + 1)]
    batches[2] = [(i, u, int(s), a, c) for i, u, s, a, c in batches[2]] + [batches[2][-1]]
    assert rows_of(run(spark, str(tmp_path), batches[::turn])) == rebuilt(spark, batches[::turn])


def days_held(spark, path):
    store = spark.read.format("statestore").option("path", f"{path}/checkpoint").option("stateVarName", "days").load()
    return sorted((r.key.user_id, r.user_map_key.day) for r in store.select("key", "user_map_key").collect())


def test_state_is_bounded_and_gaps_outlive_it(spark, tmp_path):
    start = 1_704_067_200
    batches = [[(f"{u}{d}", u, start + d * DAY, 1.0, d) for u in ("a", "b") if u == "a" or d < 5] for d in (0, 1, 2, 20, 21, 60)]
    batches.append([("b80", "b", start + 80 * DAY, 1.0, 80)])
    path = str(tmp_path)
    got = rows_of(run(spark, path, batches, lateness="1 day"))
    assert got == rebuilt(spark, batches)
    gaps = {r[0]: r[4 + ROLLING_COLUMNS.index("seconds_since_last_txn")] for r in got}
    assert gaps["a60"] == 39 * DAY and gaps["b80"] == 78 * DAY
    # All that the watermark has passed by more than the longest window has left, idle accounts' days too.
    assert days_held(spark, path) == [("b", start // DAY + 80)]


def test_rows_without_id_or_time_are_left_out_and_late_ones_dropped(spark, tmp_path):
    start = 1_704_067_200
    batches = [
        [(None, "a", start, 1.0, 1), ("x", "a", None, 1.0, 1), ("t1", "a", start, float("nan"), 1), ("t2", "a", start + 5, 3.0, 2)],
        [("t3", "a", start + 40 * DAY, 1.0, 3)],
        [("late", "a", start + 6, 1.0, 4)],
    ]
    got = {r.transaction_id: r for r in run(spark, str(tmp_path), batches, lateness="1 day").collect()}
    assert set(got) == {"t1", "t2", "t3"}
    assert got["t2"].txn_count_1h == 1 and got["t2"].total_amount_1h == 0.0 and got["t3"].seconds_since_last_txn == 40 * DAY - 5
