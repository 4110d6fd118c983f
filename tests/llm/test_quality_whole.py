import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

from pacewatch.llm import quality


def test_quality_learns_from_every_labelled_row(spark):
    """More rows than the sample once held: the cut is the exact quantile, and all pairs of a block count."""
    kinds = 40
    docs = spark.range(30_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("word "), F.repeat(F.lit("x! "), F.pmod(F.xxhash64("id"), F.lit(kinds)).cast("int"))).alias("text"))
    loud = F.pmod(F.xxhash64("id"), F.lit(kinds)) > 20
    noise = F.pmod(F.xxhash64("id", F.lit("noise")), F.lit(10)) < 3
    labels = spark.range(30_000).select(F.col("id").alias("doc_id"), (loud != noise).cast("int").alias("quality"))
    rows = quality.labelled_features(docs, labels).toPandas()
    x, y = np.array(rows["x"].tolist()), rows["label"].to_numpy()
    model = quality.train(docs, labels)
    assert len(rows) > 16_000
    assert np.allclose(model.mean, x.mean(0)) and np.allclose(model.spread, x.std(0) + 1e-6)
    assert model.cut == pytest.approx(np.quantile(model.worth(x), (y == 0).mean()), abs=1e-9)
    assert model.slope == pytest.approx(max(1e-3, quality.logistic((model.worth(x) - model.cut)[:, None], y.astype(float), ridge=1e-6)[0]), rel=1e-6)


@pytest.mark.parametrize("good, poor", [(1, 700), (300, 5), (600, 520)])
def test_quality_blocks_leave_no_row_out(spark, good, poor):
    rows = spark.range(good + poor).select(F.col("id").alias("doc_id"), (F.col("id") < good).cast("int").alias("label"), F.array(F.col("id").cast("double")).alias("x"))
    blocks = quality.pair_blocks(rows, {1: good, 0: poor}).collect()
    sides = [sorted(collections.Counter(v for b in blocks for v in b[side]).items()) for side in ("good", "poor")]
    assert [v for v, _ in sides[0]] == list(range(good)) and [v for v, _ in sides[1]] == list(range(good, good + poor))
    assert all(b["good"] and b["poor"] and len(set(b["good"])) == len(b["good"]) <= 256 >= len(b["poor"]) == len(set(b["poor"])) for b in blocks)
    few = sides[0] if good < poor else sides[1]
    assert max(n for _, n in few) - min(n for _, n in few) <= 1


def test_quality_weights_of_a_small_table_use_all_pairs(spark):
    rng = np.random.default_rng(4)
    y = (np.arange(150) % 3 > 0).astype(int)
    x = rng.normal(size=(150, 2)) + y[:, None]
    rows = spark.createDataFrame([(i, int(label), v.tolist()) for i, (label, v) in enumerate(zip(y, x))], "doc_id long, label int, x array<double>")
    got = quality.preference_weights(quality.pair_blocks(rows, {1: 100, 0: 50}), np.ones(2))
    difference = (x[y == 1][:, None] - x[y == 0]).reshape(-1, 2)
    want = quality.logistic(np.concatenate([difference, -difference]), np.r_[np.ones(5000), np.zeros(5000)], ridge=1e-3)
    assert np.allclose(got, want, atol=1e-9)
