import collections
import hashlib

import numpy as np
import pytest
import xxhash
from samples import make, odd_rows, prose

from pacewatch.llm import exact_dedup as E
from pacewatch.llm import simhash_dedup as S
from pacewatch.llm.components import components


def lowered(text):
    return (text or "").encode().lower()


def expected_exact(rows):
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[lowered(t)].append(i)
    out = []
    for i, t in rows:
        ids = groups[lowered(t)]
        out.append((i, max((x for x in ids if x is not None), default=None), len(ids), hashlib.sha256(lowered(t)).hexdigest()))
    return sorted(out, key=repr)


def test_exact_groups_of_odd_rows(odd):
    got = [tuple(r) for r in E.exact_groups(odd).collect()]
    assert sorted(got, key=repr) == expected_exact([(i, t) for i, t, _ in odd_rows()])


def test_exact_groups_of_nothing(empty):
    assert E.exact_groups(empty).count() == 0 and E.drop_repeats(empty).count() == 0


def test_filters_merge_losslessly():
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 1 << 63, 5000, dtype=np.uint64)
    parts = [np.concatenate([keys[:3000], keys[:10]]), keys[2000:], np.repeat(keys[7], 400)]
    filters = [E.QuotientFilter.build(p, 20) for p in parts]
    whole = filters[0].merge(filters[1]).merge(filters[2])
    want = collections.Counter(np.concatenate(parts).tolist())
    assert dict(zip(whole.fingerprints().tolist(), whole.counts.tolist())) == want
    cut = [E.QuotientFilter.unpacked(*f.packed(), 20) for _, f in whole.segments(4)]
    assert sum(len(f.counts) for f in cut) == len(want)


def test_hot_fingerprint_reaches_the_merge_once_per_filter(spark):
    fps = spark.range(0, 20_000, 1, 4).selectExpr("if(id % 3 = 0, 7L, id * 1000003) as fp")
    assert [r.fp for r in E.repeated_fingerprints(fps, 20_000).collect()] == [7]


def test_filters_merge_at_once_as_one_by_one():
    rng = np.random.default_rng(8)
    parts = [E.QuotientFilter.build(rng.integers(0, 900, 400).astype(np.uint64) << np.uint64(40), 24) for _ in range(7)]
    step = parts[0]
    for part in parts[1:]:
        step = step.merge(part)
    whole = E.QuotientFilter.merged(parts)
    assert (whole.fingerprints() == step.fingerprints()).all() and (whole.counts == step.counts).all() and whole.counts.sum() == 2800


@pytest.mark.parametrize("bits", [7, 12, 26])
def test_a_map_that_is_full_loses_nothing(spark, odd, monkeypatch, bits):
    """Two words of bits let nearly all rows through, many let only suspects through: the groups agree."""
    monkeypatch.setattr(E, "MAP_BITS", bits)
    docs = spark.range(600).selectExpr("id as doc_id", "concat(if(id % 5 = 0, 'Copy ', 'own '), if(id % 5 = 0, id % 40, id)) as text")
    got = {r.doc_id: (r.keep_id, r.group_size) for r in E.exact_groups(docs).collect()}
    want = {i: (560 + i % 40, 15) if i % 5 == 0 else (i, 1) for i in range(600)}
    assert got == want
    assert {r.doc_id for r in E.drop_repeats(docs).collect()} == {k for k, _ in want.values()}
    kept = collections.Counter((r.text or "").lower() for r in E.drop_repeats(odd).collect())
    assert set(kept.values()) == {1} and set(kept) == {(t or "").lower() for _, t, _ in odd_rows()}


def test_drop_repeats_keeps_one_row_of_each_text(odd):
    got = E.drop_repeats(odd)
    assert got.columns == odd.columns
    kept = [(r.doc_id, r.text) for r in got.collect()]
    assert sorted(lowered(t) for _, t in kept) == sorted({lowered(t) for _, t, _ in odd_rows()})
    assert (2, "hello world AGAIN and again") in kept and (5, " \t\n\r") in kept


def fingerprint(text):
    words = lowered(text).split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [b" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def expected_near(rows):
    fps = [fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 3:
                parent[find(a)] = find(b)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return sorted(((key, fps[i], least.get(find(i))) for i, (key, _) in enumerate(rows)), key=repr)


def near_rows(df):
    return sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in S.near_groups(df).collect()), key=repr)


def test_near_groups_of_odd_rows(odd, empty):
    assert near_rows(odd) == expected_near([(i, t) for i, t, _ in odd_rows()])
    assert S.near_groups(empty).count() == 0 and S.drop_near(empty).count() == 0


def test_near_groups_equal_brute_force(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert near_rows(documents) == expected_near(rows)


def test_links_miss_no_pair():
    """Random fingerprints with neighbours at every distance, some anchors crowded."""
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    fps = [int(x) for x in base]
    for x in base:
        for _ in range(60):
            for d in rng.integers(1, 6, 1):
                y = int(x)
                for bit in rng.choice(64, d, replace=False):
                    y ^= 1 << int(bit)
                fps.append(y)
    fps = np.array(sorted(set(fps)), np.uint64)
    row, key, home = S.anchors(fps)
    order = np.argsort(key, kind="stable")
    a, b = S.links_at_anchors(key[order], fps[row][order], home[order], 3)
    group = {int(x): int(x) for x in fps}

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for x, y in zip(a.tolist(), b.tolist()):
        group[find(x)] = find(y)
    want = {int(x): int(x) for x in fps}

    def root(x):
        while want[x] != x:
            x = want[x]
        return x

    for i, x in enumerate(fps.tolist()):
        for y in fps[:i].tolist():
            if (x ^ y).bit_count() <= 3:
                want[root(x)] = root(y)
    together = lambda f: sorted(sorted(int(y) for y in fps if f(int(y)) == r) for r in {f(int(x)) for x in fps})
    assert together(find) == together(root)


def test_crowded_anchors_are_cut_without_losing_links(spark):
    """A third of all fingerprints meet at one anchor; cells stay small and the components are the same."""
    rng = np.random.default_rng(11)
    low = 0x1234ABCD
    family = [(int(x) << 32) | low ^ (1 << int(b)) for x, b in zip(rng.integers(0, 1 << 9, 150), rng.integers(0, 32, 150))]
    fps = sorted({*family, *rng.integers(0, 1 << 62, 300).tolist()})
    distinct = spark.createDataFrame([(x,) for x in fps], "fp long")
    cut = {r.node: r.root for r in components(S.near_links(distinct, large=16)).collect()}
    whole = {r.node: r.root for r in components(S.near_links(distinct)).collect()}
    parent = {x: x for x in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, x in enumerate(fps):
        for y in fps[:i]:
            if (x ^ y).bit_count() <= 3:
                a, b = sorted((find(x), find(y)))
                parent[b] = a
    want = {x: find(x) for x in fps}
    assert cut == whole == {x: r for x, r in want.items() if list(want.values()).count(r) > 1}


def test_drop_near_keeps_the_smallest_of_each_group(spark):
    text = prose(2, 900)
    rows = [(5, text, "a"), (4, text + " more", "a"), (9, text.replace("alpha", "Alpha"), "b"), (1, prose(8, 40), "a"), (1, prose(8, 40), "a"), (2, None, None), (3, "", None)]
    got = S.drop_near(make(spark, rows))
    assert sorted(r.doc_id for r in got.collect()) == [1, 2, 4]


def test_components_of_a_chain_a_star_and_nulls(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 300)] + [(7, 7), (None, 3), (500, 499), (499, 500)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(300)} | {499: 499, 500: 499}
