import collections
import hashlib
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from samples import make, odd_rows, prose

from compare import connect, differences
from pacewatch.llm import hard_negatives, langid, merkle
from pacewatch.llm import queries as Q

VECTORS = "vec_id long, embedding array<double>, label int, id string, v string, chunk string, asked string, nth string, opened string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, e, label, *"xxxxxx") for i, e, label in rows], VECTORS).repartition(3)


def plain_hard_negatives(rows):
    kept = []
    for i, e, label in rows:
        if i is None or label is None or e is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        kept.append((i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * x) for x in e]))
    out = []
    for a in sorted({i for i, _, _ in kept if i % 100 == 0}):
        _, own, q = min(r for r in kept if r[0] == a)
        scored = [(-sum(x * y for x, y in zip(q, v)), i, label) for i, label, v in kept if i != a]
        for score, p, _ in sorted(s for s in scored if s[2] == own)[:5]:
            near = sorted(s for s in scored if s[2] != own and 30 * -score <= 100 * -s[0] <= 90 * -score)
            out += [(a, p, rank, i, -score, -s) for rank, (s, i, _) in enumerate(near[:10], 1)]
    return sorted(out)


def vector_rows(seed, n, hot=0):
    rng = np.random.default_rng(seed)
    rows = [(int(i), rng.normal(0, 1, 12).round(2).tolist(), int(rng.integers(0, 4))) for i in range(n)]
    base = rng.normal(0, 1, 12).round(2).tolist()
    return rows + [(300 if k % 2 else 45, base, 1) for k in range(hot)]


ODD_VECTORS = [
    (None, [1.0] * 12, 1), (700, None, 1), (800, [1.0] * 12, None), (900, [None] * 12, 1), (1000, [float("nan")] * 12, 1),
    (1100, [float("inf")] * 12, 1), (1200, [], 1), (1300, [0.5] * 3, 2), (1301, [0.5] * 20, 2), (1302, [-0.5] * 12, 3), (1400, [0.0] * 12, 2),
]


def test_hard_negatives_equal_brute_force(spark):
    rows = vector_rows(1, 600, hot=300) + ODD_VECTORS
    got = sorted(tuple(r) for r in hard_negatives.hard_negatives(vectors(spark, rows)).collect())
    assert got == plain_hard_negatives(rows) and len(got) > 100


def test_hard_negatives_over_many_groups_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "GROUP_VALUES", 600)
    monkeypatch.setattr(hard_negatives, "CHUNK", 2)
    rows = vector_rows(2, 500, hot=250)
    got = sorted(tuple(r) for r in hard_negatives.hard_negatives(vectors(spark, rows)).collect())
    assert got == plain_hard_negatives(rows)


def test_hard_negatives_beyond_64_bits(spark):
    rows = [(i, [4e6 * (i // 10 % 5 - 2), 3.0, float(i)], i % 2) for i in range(0, 210, 10)]
    group = hard_negatives.Columns(np.arange(3), np.zeros(3, int), np.array([[2**40, 1], [2**41, 2], [3, 4]]), np.array([[2**40, 7]]))
    ids, scores = group.positives(9, 0, np.array([2**40, 7]), 2)
    assert ids.tolist() == [1, 0] and scores.tolist() == [2**81 + 14, 2**80 + 7]
    got = sorted(tuple(r) for r in hard_negatives.hard_negatives(vectors(spark, rows)).collect())
    assert got == plain_hard_negatives(rows)


def test_hard_negatives_of_nothing(spark):
    assert hard_negatives.hard_negatives(vectors(spark, []).limit(0)).count() == 0
    assert hard_negatives.hard_negatives(vectors(spark, [(100, [1.0], 1)])).count() == 0


def test_vertical_scan_reads_fewer_rows_and_keeps_the_best():
    rng = np.random.default_rng(3)
    # Magnitudes that fall, as of rotated vectors: the first columns decide.
    columns = (rng.normal(0, 1, (64, 2000)) * 512 / (1 + np.arange(64)[:, None])).astype(np.int64)
    anchor = columns[:, 7] * 4
    seen = []

    def shrink(lower, upper):
        stays = hard_negatives.best_of(5)(lower, upper)
        seen.append(int(stays.sum()))
        return stays

    rows, score = hard_negatives.vertical_scan(columns, columns.min(1), columns.max(1), anchor, np.arange(2000), shrink)
    exact = anchor @ columns
    assert set(np.argsort(-exact)[:5]) <= set(rows) and (score == exact[rows]).all()
    assert seen == sorted(seen, reverse=True) and seen[4] < 1000


@pytest.mark.parametrize("name", ["op11_hard_negatives", "op12_merkle_manifest"])
def test_query_equals_its_sql(spark, sf_dir, name):
    assert differences(Q.QUERIES[name](spark, sf_dir), connect(sf_dir), Q.ORACLES[name]) is None


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def encoded(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def up(nodes):
    """Root of a list of digests, and the sides of each."""
    sides = [[] for _ in nodes]
    at = list(range(len(nodes)))
    while len(nodes) > 1:
        for leaf, i in enumerate(at):
            run = i // 16 * 16
            sides[leaf].append(("".join(nodes[run:i]), "".join(nodes[i + 1 : run + 16])))
        nodes = [h(*nodes[k : k + 16]) for k in range(0, len(nodes), 16)]
        at = [i // 16 for i in at]
    return nodes[0], sides


def plain_manifest(rows):
    trees = collections.defaultdict(list)
    for r in rows:
        parts = [r.doc_id, r.source, r.lang, r.n_chars]
        leaf = h(*map(encoded, parts), encoded(r.text))
        changed = zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 5 == 0
        low = r.text and r.text.encode().lower().decode()
        trees["" if r.source is None else "=" + r.source].append((r.doc_id is not None, r.doc_id or 0, leaf, h(*map(encoded, parts), encoded(low)) if changed else leaf, r.doc_id))
    names = sorted(trees, key=lambda s: s.encode())
    done = {name: up([x[2] for x in sorted(trees[name])]) for name in names}
    root, over = up([done[n][0] for n in names])
    out = []
    for name, top in zip(names, over):
        for (_, _, leaf, held, doc_id), sides in zip(sorted(trees[name]), done[name][1]):
            for left, right in sides + top:
                held = h(left, held, right)
            out.append((doc_id, leaf, done[name][0], root, h(*(x + y for x, y in sides + top)), held, held == root))
    return sorted(out, key=repr)


def manifest_rows(df):
    return sorted(map(tuple, merkle.manifest(df).collect()), key=repr)


def test_manifest_of_odd_rows(spark, odd, empty):
    assert manifest_rows(odd) == plain_manifest(odd.collect())
    assert merkle.manifest(empty).count() == 0
    one = make(spark, [(1, "Only", None)])
    assert manifest_rows(one) == plain_manifest(one.collect())


def test_manifest_of_many_sources_and_one_hot_source(spark):
    """Runs of 1, 15, 16, 17, 256, 257 and 300 leaves; a doc_id that repeats; forty sources."""
    sizes = {"a": 16, "b": 17, "É": 256, "hot": 300, "": 1, None: 15, "z": 257}
    rows, i = [], 0
    for source, n in [*sizes.items(), *((f"s{k}", 2) for k in range(33))]:
        for _ in range(n):
            i += 1
            rows.append((i, f"Text {i} of {source}", source))
    rows += [(7, "same Id", "hot")] * 40 + [(7, "same id, other", "hot")] * 3
    df = make(spark, rows)
    assert manifest_rows(df) == plain_manifest(df.collect())


def plain_vector(text):
    marks, out = [0], np.zeros(langid.DIMENSIONS, np.int64)
    for c in text.lower():
        if c.isalpha():
            marks.append(ord(c))
        elif marks[-1]:
            marks.append(0)
    marks += [0] if marks[-1] else []
    space = langid.Space()
    for a, b, c in zip(marks, marks[1:], marks[2:]):
        out += np.roll(space.letter(a), 2).astype(int) * np.roll(space.letter(b), 1) * space.letter(c)
    return out


@pytest.mark.parametrize("slice_", [3, 1 << 20])
def test_bundles_equal_their_definition(monkeypatch, slice_):
    monkeypatch.setattr(langid, "SLICE", slice_)
    monkeypatch.setattr(langid, "BOUND", 7)
    texts = ["", "...", "a", "Ab", "The  cat -- sat; on 12 MATS!", "Ünïcode 東京 😀 x", "  lead", "trail  ", "aa aa aa"]
    owners, numbers, counts = langid.counted(texts)
    got = langid.Space().bundle(owners, numbers, counts, len(texts))
    assert (got == np.stack([plain_vector(t) for t in texts])).all()


def test_spaces_that_forget_give_the_same_vectors(monkeypatch):
    numbers = np.unique(langid._numbered(np.random.default_rng(1).integers(97, 123, 4000)))
    whole = langid.Space().of(numbers)
    monkeypatch.setattr(langid, "HELD", 500)
    space = langid.Space()
    parts = [space.of(numbers[a : a + 300]) for a in range(0, len(numbers), 300)]
    assert (np.concatenate(parts) == whole).all()


def test_languages_equal_brute_force(spark):
    texts = [(i, prose(i, 5 + i % 40), "a") for i in range(40)] + [(100 + i, f"der schnelle braune fuchs {i} springt über zäune", "b") for i in range(40)]
    rows = [(i, t, s) for i, t, s in [*texts, *odd_rows()] if t is None or len(t) < 9_000]
    df = make(spark, rows).selectExpr("*", "if(source = 'b', 'de', if(source = 'a', 'x', null)) as tongue").drop("lang").withColumnRenamed("tongue", "lang")
    profiles = collections.defaultdict(lambda: np.zeros(langid.DIMENSIONS, np.int64))
    for r in df.collect():
        if zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 5 and r.lang is not None and r.text is not None:
            profiles[r.lang] += plain_vector(r.text)

    def judged(text):
        v = plain_vector(text or "")
        if not any(c.isalpha() for c in text or ""):
            return "und", 0.0
        cos = {k: float(p @ v) / math.sqrt(float(p @ p)) / math.sqrt(float(v @ v)) for k, p in profiles.items()}
        best = min(cos, key=lambda k: (-cos[k], k))
        return best, max(0.0, cos[best])

    got = langid.languages(df).collect()
    assert len(got) == len(rows)
    want = collections.defaultdict(list)
    for r in df.collect():
        want[r.doc_id].append(judged(r.text))
    for r in got:
        assert r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 5 == 0)
        assert any(name == r.lang_pred and score == pytest.approx(r.score, abs=1e-9) for name, score in want[r.doc_id])


def test_languages_without_rows_or_labels(spark, empty, odd):
    assert langid.languages(empty).count() == 0
    none = odd.withColumn("lang", F.lit(None).cast("string"))
    assert {(r.lang_pred, r.score) for r in langid.languages(none).collect()} == {("und", 0.0)}


def test_languages_on_held_out_rows(spark, documents):
    got = Q.op13_language_id(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), "doc_id")
    assert got.filter("held_out and lang = lang_pred").count() >= 0.98 * got.filter("held_out").count()
