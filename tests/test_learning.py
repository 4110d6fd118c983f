"""Split, metrics, oversampling and the model."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pacewatch.operators import metrics, model, oversample, split, trees
from pacewatch.operators.oversample import dense_index, nearest_rows, nearest_vectors, smote
from pacewatch.schema import ACCOUNT_FEATURE_COLUMNS, MODEL_COLUMNS, TRANSACTION_FEATURE_COLUMNS


def test_split_is_by_time_range_and_drops_missing_times(spark):
    rows = [(i, f"2024-01-{d:02d} 00:00:00") for i, d in enumerate([1, 2, 8, 9, 10, 11])] + [(9, None)]
    df = spark.createDataFrame(rows, "id int, t string").withColumn("event_time", F.col("t").cast("timestamp"))
    assert split.time_split_point(df).head().split_time.isoformat() == "2024-01-09T00:00:00"
    train, test = split.time_split(df)
    assert {r.id for r in train.collect()} == {0, 1, 2} and {r.id for r in test.collect()} == {3, 4, 5}


def test_training_columns_hold_no_all_time_profile_field():
    profile = set(ACCOUNT_FEATURE_COLUMNS) - {"user_id"}
    assert not profile & set(MODEL_COLUMNS)
    assert set(MODEL_COLUMNS) <= set(TRANSACTION_FEATURE_COLUMNS)


def scored(spark, pairs):
    return spark.createDataFrame(pairs, "is_fraud int, probability double")


def direct_metrics(pairs):
    pos = [p for y, p in pairs if y]
    neg = [p for y, p in pairs if not y]
    auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    ap = 0.0
    for s in {p for _, p in pairs}:
        hit = sum(a >= s for a in pos)
        ap += sum(a == s for a in pos) / len(pos) * hit / (hit + sum(b >= s for b in neg))
    return auc, ap


@pytest.mark.parametrize("levels", [3, 40, 10**9])
def test_areas_equal_pair_counting(spark, levels):
    rng = random.Random(levels)
    pairs = [(int(rng.random() < 0.3), rng.randrange(levels) / levels) for _ in range(900)]
    auc, ap = direct_metrics(pairs)
    df = scored(spark, pairs)
    assert math.isclose(metrics.roc_auc(df).head()[0], auc, rel_tol=1e-12)
    assert math.isclose(metrics.average_precision(df).head()[0], ap, rel_tol=1e-12)


def test_areas_with_many_distinct_crowded_scores(spark):
    """More distinct scores than ranges, nearly all in a tiny interval."""
    rng = np.random.default_rng(5)
    p = np.where(rng.random(6000) < 0.95, rng.random(6000) * 1e-7, rng.random(6000))
    y = (rng.random(6000) < 0.2).astype(int)
    pos, neg = np.sort(p[y == 1]), np.sort(p[y == 0])
    auc = (np.searchsorted(neg, pos, "left") + np.searchsorted(neg, pos, "right")).sum() / 2 / len(pos) / len(neg)
    df = scored(spark, list(zip(y.tolist(), p.tolist())))
    assert math.isclose(metrics.roc_auc(df).head()[0], auc, rel_tol=1e-12)


def test_undefined_figures(spark):
    only_negative = scored(spark, [(0, 0.1), (0, 0.2)])
    assert metrics.roc_auc(only_negative).head()[0] is None
    assert metrics.average_precision(only_negative).head()[0] is None
    assert metrics.threshold_metrics(only_negative).head().asDict() == {"precision": 0.0, "recall": 0.0, "f1": 0.0}


def test_confusion_lists_empty_cells(spark):
    got = {(r.actual, r.predicted): r.rows for r in metrics.confusion(scored(spark, [(1, 0.3), (0, 0.1)])).collect()}
    assert got == {(0, 0): 1, (0, 1): 0, (1, 0): 0, (1, 1): 1}


def test_dense_index(spark):
    df = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("id"))
    got = sorted(r["index"] for r in dense_index(df, "id").collect())
    assert got == list(range(5000))


def brute(points, k):
    out = {}
    for v in {tuple(p) for p in points}:
        d = np.sort(np.sqrt(((points - np.array(v)) ** 2).sum(1)))
        out[v] = d[1 : k + 1]
    return out


@pytest.mark.parametrize("case", ["uniform", "clusters", "copies", "line", "outliers"])
def test_neighbours_are_exact_across_cells(spark, monkeypatch, case):
    """Cells of a few vectors, so that most neighbours lie in others."""
    monkeypatch.setattr(oversample, "CELL", 24)
    monkeypatch.setattr(oversample, "LOOKING", 40)
    rng = np.random.default_rng(7)
    n, k = 260, 5
    points = {
        "uniform": lambda: rng.random((n, 4)),
        "clusters": lambda: np.concatenate([rng.normal(c, 0.01, (n // 4, 4)) for c in (0, 1, 100, 1e6)]),
        "copies": lambda: np.repeat(rng.integers(0, 3, (n // 4, 4)).astype(float), 4, axis=0),
        "line": lambda: np.outer(rng.random(n), np.ones(4)),
        "outliers": lambda: np.concatenate([rng.random((n, 4)), 10.0 ** rng.integers(2, 9, (12, 4))]),
    }[case]()
    df = spark.createDataFrame([(p.tolist(),) for p in points], "v array<double>")
    got = nearest_vectors(df.groupBy("v").agg(F.count(F.lit(1)).alias("copies")), k).collect()
    want = brute(points, k)
    assert len(got) == len(want)
    for row in got:
        v = np.array(row.v)
        have = np.sort([np.sqrt(((np.array(x) - v) ** 2).sum()) for x in row.neighbours])
        assert np.allclose(have, want[tuple(row.v)], rtol=1e-9, atol=1e-9), (case, row.v)


def recall_of(spark, points, k=5, looked=300):
    df = spark.createDataFrame([(p.tolist(), 1) for p in points], "v array<double>, copies long")
    hits, rows = 0, nearest_vectors(df, k).collect()
    for row in rows[:looked]:
        d = ((points - np.array(row.v)) ** 2).sum(1)
        true = {tuple(points[i]) for i in np.argsort(d)[1 : k + 1]}
        assert len(row.neighbours) == k and tuple(row.v) not in {tuple(x) for x in row.neighbours}
        hits += len(true & {tuple(x) for x in row.neighbours})
    return hits / (min(looked, len(rows)) * k)


def test_neighbours_at_the_width_of_the_model_are_the_true_ones(spark):
    assert recall_of(spark, np.random.default_rng(3).normal(size=(10_000, len(MODEL_COLUMNS)))) == 1.0


def test_a_bounded_search_still_finds_most(spark, monkeypatch):
    """Beyond the bound the nearest cells are looked through first; real features lie in clusters."""
    monkeypatch.setattr(oversample, "CELL", 64)
    monkeypatch.setattr(oversample, "VISITED", 512)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(60, len(MODEL_COLUMNS))) * 3
    assert recall_of(spark, centres[rng.integers(0, 60, 4000)] + rng.normal(size=(4000, len(MODEL_COLUMNS)))) >= 0.9


@pytest.mark.parametrize("case", ["normal", "few in most cells"])
def test_neighbours_are_exact_over_several_rounds(spark, monkeypatch, case):
    """Nearly all cells have to be looked through, a few in a round."""
    monkeypatch.setattr(oversample, "CELL", 16)
    monkeypatch.setattr(oversample, "VISITED", 60)
    searched, calls = oversample._searched, []
    monkeypatch.setattr(oversample, "_searched", lambda *args: calls.append(1) or searched(*args))
    rng = np.random.default_rng(8)
    points = rng.normal(size=(240, len(MODEL_COLUMNS)))
    if case != "normal":
        points = np.concatenate([points[:60] * 50, points[60:]])
    df = spark.createDataFrame([(p.tolist(), 1) for p in points], "v array<double>, copies long")
    got, want = nearest_vectors(df, 5).collect(), brute(points, 5)
    assert len(got) == len(points) and len(calls) > 3
    for row in got:
        have = np.sort([np.sqrt(((np.array(x) - np.array(row.v)) ** 2).sum()) for x in row.neighbours])
        assert np.allclose(have, want[tuple(row.v)], rtol=1e-9)


def test_distances_of_nearest_rows(spark):
    rows = [("a", [0.0, 0.0]), ("b", [3.0, 4.0]), ("c", [0.0, 0.0]), ("d", [0.0, 1.0])]
    got = nearest_rows(spark.createDataFrame(rows, "transaction_id string, v array<double>"), 2).collect()
    assert sorted((r.transaction_id, r["rank"], round(r.distance, 6)) for r in got) == [
        ("a", 1, 0.0), ("a", 2, 1.0), ("b", 1, 4.242641), ("b", 2, 5.0), ("c", 1, 0.0), ("c", 2, 1.0), ("d", 1, 1.0), ("d", 2, 1.0),
    ]


def test_rows_without_other_rows_have_no_neighbours(spark):
    schema = "transaction_id string, v array<double>"
    assert nearest_rows(spark.createDataFrame([("a", [1.0])], schema), 2).count() == 0
    assert nearest_rows(spark.createDataFrame([("a", [1.0]), ("b", [1.0])], schema), 5).count() == 2
    assert nearest_rows(spark.createDataFrame([], schema), 2).count() == 0


def test_a_model_as_a_table_scores_and_weighs_alike(spark, tmp_path):
    df = labelled(spark, 200, 400).withColumn("a", F.when(F.col("a") < 6.5, F.col("a")))
    fitted = model.train(df, {"maxIter": 6, "maxDepth": 3}, ["a", "b", "c"])
    model.save_model(fitted, str(tmp_path))
    nodes, depth = trees.node_table(spark, str(tmp_path)), trees.depth_of(spark, str(tmp_path))
    assert depth == 3 and nodes.select("tree").distinct().count() == 6
    walked = {r.transaction_id: r.probability for r in trees.walk(df, nodes, depth, ["a", "b", "c"]).collect()}
    scored = {r.transaction_id: r.probability for r in model.predict(fitted, df).collect()}
    assert walked.keys() == scored.keys() and all(abs(walked[i] - scored[i]) < 1e-12 for i in scored)
    weights = {r.feature: r.importance for r in trees.importances(nodes, ["a", "b", "c"]).collect()}
    library = {r.feature: r.importance for r in model.importances(fitted, spark).collect()}
    assert weights.keys() == library.keys() and all(abs(weights[f] - library[f]) < 1e-12 for f in library)
    empty = trees.walk(df.limit(0), nodes, depth, ["a", "b", "c"])
    assert empty.count() == 0


def labelled(spark, positives, negatives):
    rng = np.random.default_rng(1)
    rows = [(f"p{i}", 1, *rng.normal(5, 1, 3).tolist()) for i in range(positives)]
    rows += [(f"n{i}", 0, *rng.normal(0, 1, 3).tolist()) for i in range(negatives)]
    return spark.createDataFrame(rows, "transaction_id string, is_fraud int, a double, b double, c double")


def test_smote_reaches_the_ratio_on_segments_between_positives(spark):
    df = labelled(spark, 30, 905)
    out = smote(df, ["a", "b", "c"])
    counts = {r.is_fraud: r["count"] for r in out.groupBy("is_fraud").count().collect()}
    assert counts == {0: 905, 1: int(905 * 0.1)}
    base = np.array([[r.a, r.b, r.c] for r in df.filter("is_fraud = 1").collect()])
    keys = {tuple(p) for p in base}
    made = [np.array([r.a, r.b, r.c]) for r in out.filter("is_fraud = 1").collect() if (r.a, r.b, r.c) not in keys]
    assert len(made) == 60
    near = {i: np.argsort(((base - base[i]) ** 2).sum(1))[1:6] for i in range(len(base))}
    for s in made:
        def on_segment(i, j):
            d = base[j] - base[i]
            t = ((s - base[i]) @ d) / (d @ d)
            return -1e-9 <= t <= 1 + 1e-9 and np.allclose(base[i] + t * d, s, atol=1e-9)

        assert any(on_segment(i, j) for i in near for j in near[i])


def test_smote_draws_from_the_true_neighbours_over_several_rounds(spark, monkeypatch):
    monkeypatch.setattr(oversample, "CELL", 16)
    monkeypatch.setattr(oversample, "VISITED", 30)
    rng, names = np.random.default_rng(9), [f"x{i}" for i in range(12)]
    base = rng.normal(size=(120, 12))
    rows = [(f"p{i}", 1, *p.tolist()) for i, p in enumerate(base)] + [(f"n{i}", 0, *[0.0] * 12) for i in range(2400)]
    df = spark.createDataFrame(rows, ["transaction_id", "is_fraud", *names])
    made = smote(df, names, draws=True).collect()
    assert len(made) == 120
    for row in made:
        d = np.sqrt(((base - np.array(row.base)) ** 2).sum(1))
        assert math.isclose(np.sort(d)[row.which], math.dist(row.base, row.towards), rel_tol=1e-9)


def test_smote_repeats_by_seed_and_leaves_negatives_alone(spark):
    df = labelled(spark, 12, 400)
    one, two = smote(df, ["a", "b", "c"]), smote(df.repartition(5), ["a", "b", "c"])
    assert one.exceptAll(two).count() == 0 and two.exceptAll(one).count() == 0
    other = smote(df, ["a", "b", "c"], seed=7)
    assert one.exceptAll(other).count() > 0


def test_smote_does_nothing_when_there_is_nothing_to_do(spark):
    assert smote(labelled(spark, 50, 100), ["a", "b", "c"]).count() == 150
    with pytest.raises(ValueError):
        smote(labelled(spark, 3, 400), ["a", "b", "c"])


def test_smote_with_one_vector_copied(spark):
    df = labelled(spark, 0, 300).unionByName(
        spark.range(20).selectExpr("concat('p', id) transaction_id", "1 is_fraud", "1D a", "2D b", "3D c")
    )
    rows = smote(df, ["a", "b", "c"]).filter("is_fraud = 1").collect()
    assert len(rows) == 30 and {(r.a, r.b, r.c) for r in rows} == {(1.0, 2.0, 3.0)}


@pytest.fixture(scope="module")
def fitted(spark):
    df = labelled(spark, 120, 400)
    return df, model.train(df, {"maxIter": 4, "minInstancesPerNode": 5}, ["a", "b", "c"])


def test_model_learns_saves_and_repeats(spark, fitted, tmp_path):
    df, fit = fitted
    out = model.predict(fit, df)
    assert out.filter("probability < 0 or probability > 1").count() == 0
    assert metrics.roc_auc(out).head()[0] > 0.95
    assert set(out.columns) == {*df.columns, "probability"}
    model.save_run(str(tmp_path / "run"), fit, metrics.evaluate(out), {"maxIter": 4})
    again = model.predict(model.load_model(str(tmp_path / "run" / "model")), df)
    assert again.exceptAll(out).count() == 0
    saved = {r.metric: r.value for r in spark.read.json(str(tmp_path / "run" / "metrics")).collect()}
    assert saved["test_size"] == 520 and saved["roc_auc"] > 0.95
    top = model.top_importances(fit, spark, 2).collect()
    assert len(top) == 2 and top[0].importance >= top[1].importance


def test_same_seed_same_model(spark, fitted):
    df, fit = fitted
    twin = model.train(df, {"maxIter": 4, "minInstancesPerNode": 5}, ["a", "b", "c"])
    assert model.predict(twin, df).exceptAll(model.predict(fit, df)).count() == 0


def test_missing_inputs_count_as_zero(spark, fitted):
    _, fit = fitted
    gap = spark.sql("select cast(null as double) a, 0D b, 0D c")
    full = spark.sql("select 0D a, 0D b, 0D c")
    assert model.predict(fit, gap).head().probability == model.predict(fit, full).head().probability
