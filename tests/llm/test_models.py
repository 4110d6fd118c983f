import collections
import math

import numpy as np
import pytest
from samples import odd_rows

from pacewatch.llm import mixing, quality, topk, toxicity
from pacewatch.llm import queries as Q


def size(text):
    return len((text or "").encode().split())


def expected_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, "" if s is None else s.encode()))
    weight = {s: (3.0, 1.0, 2.0)[i % 3] for i, s in enumerate(names)}
    goal, capped, left = {}, set(), 1.5 * sum(sizes.values())
    while True:
        rest = sum(weight[s] for s in names if s not in capped)
        over = [s for s in names if s not in capped and left * weight[s] / rest >= 2 * sizes[s]]
        if not over:
            break
        for s in over:
            goal[s] = 2.0 * sizes[s]
        capped |= set(over)
        left = 1.5 * sum(sizes.values()) - sum(goal.values())
        if len(capped) == len(names):
            break
    return goal | {s: left * weight[s] / rest for s in names if s not in capped}


def check_mix(rows, got):
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += size(t)
    goal = expected_targets(dict(sizes))
    taken = collections.Counter()
    assert collections.Counter((r.doc_id, r.source, r.size) for r in got) == collections.Counter((i, s, size(t)) for i, t, s in rows)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(goal[r.source]) and 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - goal[s]) <= 1 for s in sizes)


def test_mix_of_odd_rows(odd, empty):
    got = mixing.mixed(odd).collect()
    check_mix(odd_rows(), got)
    assert sorted(map(repr, got)) == sorted(map(repr, mixing.mixed(odd.repartition(7)).collect()))
    assert mixing.mixed(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0


def test_mix_of_documents(documents):
    rows = [(r.doc_id, r.text, r.source) for r in documents.collect()]
    check_mix(rows, mixing.mixed(documents).collect())


def test_mixed_texts_hold_the_words_taken(documents):
    taken = {r.doc_id: r.taken for r in mixing.mixed(documents).collect()}
    texts = {r.doc_id: r.text for r in documents.collect()}
    out = collections.Counter()
    for r in mixing.mixed_documents(documents).collect():
        out[r.doc_id] += size(r.text)
        assert r.n_chars == len(r.text)
        assert not collections.Counter(r.text.split()) - collections.Counter(texts[r.doc_id].split())
    assert out == collections.Counter({k: v for k, v in taken.items() if v})


def test_permutation_and_its_inverse(spark):
    from pyspark.sql import functions as F

    for n in (1, 2, 7, 1000):
        df = spark.range(n).select("id", mixing.permuted(F.col("id"), F.lit(n), F.lit("s")).alias("p"))
        df = df.withColumn("back", mixing.permuted(F.col("p"), F.lit(n), F.lit("s"), inverse=True))
        rows = df.collect()
        assert sorted(r.p for r in rows) == list(range(n)) and all(r.back == r.id for r in rows)


def test_shards_draw_near_the_weights(documents):
    rows = documents.select("doc_id", "source", mixing.sized(documents).alias("size"))
    sources = mixing.source_table(rows, mixing.WEIGHTS, 1.5, 2.0)
    slots = mixing.plan(sources)
    positions = sorted(r.position for r in slots.collect())
    assert positions == list(range(len(positions)))
    assert mixing.shard_counts(slots).agg({"words": "sum"}).first()[0] == pytest.approx(sum(r.target for r in sources.collect()), abs=len(positions))


@pytest.mark.parametrize("module, name", [(quality, "quality"), (toxicity, "toxic")])
def test_classifiers_on_odd_rows(odd, empty, labels, module, name):
    model = module.train(odd, labels)
    got = module.scored(odd, model).collect()
    assert len(got) == len(odd_rows()) and all(0 <= r.score <= 1 for r in got)
    by_text = collections.defaultdict(set)
    scores = collections.defaultdict(set)
    for r in got:
        scores[r.doc_id].add(r.score)
    for i, t, _ in odd_rows():
        by_text[t or ""] |= scores[i] if i is not None else set()
    assert len(scores[2]) == 1
    assert module.scored(empty, module.train(empty, labels)).count() == 0
    assert module.scored(odd, module.train(empty, labels)).count() == len(odd_rows())


def accuracy(spark, sf, query, label):
    got = query(spark, sf).toPandas()
    marks = spark.read.parquet(f"{sf}/labels.parquet").toPandas()
    held = got[got.held_out].merge(marks, on="doc_id")
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    return (held.predicted == held[label]).mean()


def test_quality_on_held_out_rows(spark):
    assert accuracy(spark, "/root/testdata/sf0.01", Q.op7_quality_classifier, "quality") > 0.95


def test_toxicity_on_held_out_rows(spark):
    assert accuracy(spark, "/root/testdata/sf0.1", Q.op9_toxicity, "toxic") > 0.97


def test_accepted_rows_keep_their_columns(odd, labels):
    model = quality.train(odd, labels)
    good = quality.accepted(odd, model)
    want = quality.scored(odd, model).filter("score >= 0.5").count()
    assert good.columns == odd.columns and good.count() == want


def all_segments(weights, neutral, n):
    """Maximal scoring segments by their definition: the best segment, then left and right of it."""
    dense = [neutral] * n
    for i, x in weights:
        dense[i] = x

    def split(a, b):
        best, where = 0.0, None
        for i in range(a, b):
            total = 0.0
            for j in range(i, b):
                total += dense[j]
                if total > best + 1e-9:
                    best, where = total, (i, j)
        if where is None:
            return []
        return [*split(a, where[0]), (*where, best), *split(where[1] + 1, b)]

    return split(0, n)


def test_segments_equal_their_definition():
    rng = np.random.default_rng(2)
    for _ in range(60):
        n = 40
        at = sorted(rng.choice(n, 8, replace=False).tolist())
        weights = [(i, float(rng.choice([4.13, 1.27, -2.41, 0.59]))) for i in at]
        got = toxicity.segments(weights, -0.7)
        want = all_segments(weights, -0.7, n)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert np.allclose([w for *_, w in got], [w for *_, w in want])


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, id string").repartition(3)


def expected_top(rows, k=5):
    good = [(i, [math.floor(256 * np.float64(np.float32(x))) for x in v]) for i, v, *_ in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in sorted({i: v for i, v in good if i % 50 == 0}.items()):
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q)[:k]
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored, 1)]
    return out


def top_rows(df):
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in topk.top_k(df).collect())


def test_top_k_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1, "x"), (1, [1.0, 2.0], 1, "x"), (2, [1.0, 2.0], 1, "x"), (3, None, 1, "x"), (4, [nan, 1.0], 1, "x"), (5, [inf, 1.0], 1, "x"), (6, [None, 1.0], 1, "x"), (50, [-1.0, 0.5], 1, "x"), (100, [0.0, 0.0], 1, "x"), (7, [3.0, -9.0], 1, "x"), (None, [9.0, 9.0], 1, "x")]
    assert top_rows(vectors(spark, rows)) == expected_top(rows)
    assert top_rows(vectors(spark, rows[:1])) == [] and top_rows(vectors(spark, []).limit(0)) == []


def test_blocks_are_pruned_without_loss():
    rng = np.random.default_rng(4)
    rows = rng.integers(-300, 300, (3000, 16))
    rows[:64] *= 8
    ids = np.arange(3000)
    queries = rows[::50]
    q, who, score = topk.search(ids[::50], queries, ids, rows, 5, block=64)
    full = queries @ rows.T
    for i, query in enumerate(ids[::50]):
        best = sorted((-int(s), j) for j, s in enumerate(full[i]) if j != query)[:5]
        assert sorted(zip((-score[q == query]).tolist(), who[q == query].tolist())) == best
