import math

import numpy as np
import pytest

from pacewatch.llm import quality, topk, toxicity
from pacewatch.llm.common import labelled_sample, table

SF = "/root/testdata/sf0.1"


def test_sampled_rows_stand_for_all_of_their_class(spark):
    for n in (700, 1400):
        docs = spark.range(n).selectExpr("id as doc_id", "'x' as text")
        labels = spark.range(n).selectExpr("id as doc_id", "int(id % 8 = 0) as toxic")
        rows = labelled_sample(docs, labels, "toxic", 50, 3, -1).collect()
        for label in (0, 1):
            part = [r.weight for r in rows if r.label == label]
            assert len(part) <= 50 and sum(part) == pytest.approx(sum((i % 8 == 0) == bool(label) for i in range(n)))


def test_an_id_on_a_third_of_the_rows_gives_one_row(spark):
    docs = spark.range(900).selectExpr("if(id % 3 = 0, 7L, id) as doc_id", "if(id = 3, null, concat('text ', id % 5)) as text")
    labels = spark.range(900).selectExpr("id as doc_id", "int(id % 2) as toxic")
    rows = labelled_sample(docs, labels, "toxic", 10_000, 3, -1).collect()
    assert len(rows) == len({r.doc_id for r in rows}) == docs.select("doc_id").distinct().count()
    again = labelled_sample(docs.repartition(5), labels, "toxic", 10_000, 3, -1).collect()
    assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, again), key=repr)


def test_a_vector_id_on_a_third_of_the_rows_is_cut(spark, monkeypatch):
    """Groups stay near their size however often an id repeats, and the answer is the plain one."""
    monkeypatch.setattr(topk, "GROUP", 40)
    rng = np.random.default_rng(9)
    rows = [(100 if i % 3 == 0 else i, rng.normal(size=6).tolist()) for i in range(600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in topk.top_k(df).collect())
    ids, v = np.array([i for i, _ in rows]), np.floor(256 * np.array([x for _, x in rows])).astype(int)
    want = []
    for q in sorted({i for i in ids.tolist() if i % 50 == 0} - {100}):
        scores = v @ v[np.flatnonzero(ids == q)[0]]
        best = sorted((-s, i) for s, i in zip(scores.tolist(), ids.tolist()) if i != q)[:5]
        want += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    assert [r for r in got if r[0] != 100] == want


def test_a_query_goes_only_to_groups_whose_bound_reaches_its_floor(spark, monkeypatch):
    """Rows of one direction lie side by side, so most groups are out of reach; the answer is the plain one."""
    monkeypatch.setattr(topk, "GROUP", 50)
    monkeypatch.setattr(topk, "PACK", 3)
    monkeypatch.setattr(topk, "CHUNK", 5)
    rng = np.random.default_rng(3)
    v = rng.normal(size=(1000, 4)) * 0.05
    v[np.arange(1000), np.arange(1000) // 250] += 1
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    sent = []
    plain = topk.searched
    monkeypatch.setattr(topk, "searched", lambda pairs, *rest: (sent.append(pairs.count()), plain(pairs, *rest))[1])
    got = sorted(tuple(r) for r in topk.top_k(df).collect())
    whole = np.floor(256 * v).astype(int)
    want = []
    for q in range(0, 1000, 50):
        best = sorted((-s, i) for i, s in enumerate((whole @ whole[q]).tolist()) if i != q)[:5]
        want += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    assert got == want
    groups = 20
    assert sent[0] == 20 and 0 < sent[1] < 20 * groups * 0.4


def test_quality_cut_follows_all_rows_not_the_sample():
    rng = np.random.default_rng(1)
    y = (np.arange(8000) % 8 > 0).astype(int)
    x = rng.normal(size=(8000, 3)) + y[:, None]
    whole = quality.fit(x, y)
    take = np.r_[np.flatnonzero(y == 0), np.flatnonzero(y == 1)[:1000]]
    capped = quality.fit(x[take], y[take], w=np.where(y[take] == 1, 7.0, 1.0))
    bare = quality.fit(x[take], y[take])
    assert np.abs(whole.score(x) - capped.score(x)).mean() < 0.03 < 0.1 < np.abs(whole.score(x) - bare.score(x)).mean()
    assert whole.cut == pytest.approx(np.quantile(whole.worth(x), 1 / 8))


def test_capped_toxicity_curve_keeps_the_class_shares(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    marks = labelled_sample(docs, labels, "toxic", 300, toxicity.FOLDS, toxicity.HELD_OUT).toPandas()
    shares = marks.groupby("label").weight.sum()
    true = labelled_sample(docs, labels, "toxic", 10**6, toxicity.FOLDS, toxicity.HELD_OUT).groupBy("label").count().toPandas().set_index("label")["count"]
    assert math.isclose(shares[0] / shares[1], true[0] / true[1], rel_tol=0.02)
    rng = np.random.default_rng(2)
    rows = [("bad " * int(rng.poisson(1.5 if label else 0.3)) + "x " * 20, label) for label in (np.arange(4000) % 8 == 0).astype(int).tolist()]

    def curve(rows):
        return toxicity._calibrated(toxicity.ToxicityModel({"bad": 2.0}), rows).curve

    whole = curve([(*r, 1.0) for r in rows])
    some = [r for r in rows if r[1]] + [r for r in rows if not r[1]][:500]
    capped = curve([(t, label, 1.0 if label else 7.0) for t, label in some])
    assert abs(whole[0] - capped[0]) < 0.4 and abs(whole[0] - curve([(*r, 1.0) for r in some])[0]) > 1.5
