import collections
import hashlib
import math
import random
import zlib
from array import array

import numpy as np
import public_tokenizers
import pytest
from samples import make, odd_rows, prose
from tokenizers import Tokenizer

from pacewatch.llm import bpe, license_scan, line_dedup, lm_score
from pacewatch.llm.queries import tokenizer_spec

LIBRARY = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_encoding_equals_the_library_on_odd_texts():
    rnd = random.Random(1)
    alphabet = "abcdeéèñßİΣσς ''sretvdm0123٣\x1c​　\n\t<|endoftext|>!?.,;:#@日本語한국어😀👍🏽ﬁ̇\x00"
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40))) for _ in range(1500)]
    texts += ["", "a" * 4000, "abc" * 2000, "<|startoftext|>It's WE'LL<|endoftext|>", *(t or "" for _, t, _ in odd_rows())]
    want = LIBRARY.encode_batch(texts, add_special_tokens=False)
    for text, w, (ids, decoded) in zip(texts, want, bpe.TextEncoder(tokenizer_spec()).run(texts), strict=True):
        assert list(array("I", ids)) == w.ids, text
        assert decoded == LIBRARY.decode(w.ids, skip_special_tokens=False)


def test_encoded_documents_and_digests(spark, odd, empty):
    spec = tokenizer_spec()
    got = bpe.tokenized(odd, spec).collect()
    want = collections.Counter((i, tuple(LIBRARY.encode(t or "", add_special_tokens=False).ids)) for i, t, _ in odd_rows())
    assert collections.Counter((r.doc_id, tuple(r.ids)) for r in got) == want
    for r in got:
        assert r.n_tokens == len(r.ids) and r.ids_sha256 == hashlib.sha256(array("I", r.ids).tobytes()).hexdigest()
    assert bpe.digests(empty, spec).count() == 0 and bpe.encoded(empty, spec).count() == 0


def lm_base(rows):
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1
    tokens = [(i, held(i), [*(t or "").encode().lower().split(), b""]) for i, t in rows]
    c = collections.Counter(w for _, h, ws in tokens if not h for w in ws)
    n, v = sum(c.values()), len(c)
    out = []
    for i, h, ws in tokens:
        base = sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)
        out.append((i, h, len(ws), sum(c[w] > 0 for w in ws), n, round(base, 6)))
    return sorted(out, key=repr)


def lm_rows(df):
    return sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in df), key=repr)


def test_lm_counts_of_odd_rows(odd, empty):
    got = lm_score.scores(odd).collect()
    assert lm_rows(got) == lm_base([(i, t) for i, t, _ in odd_rows()])
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    assert lm_score.scores(empty).count() == 0


def test_lm_model_is_a_distribution_over_bytes():
    model = lm_score.Mixer(*(np.random.default_rng(i).integers(0, 9, (lm_score.PREDICTORS, 1 << lm_score.TABLE_BITS)) for i in (1, 2)))
    # All bytes after one prefix sum to one: 256 tails of one byte more.
    pairs = [(0, b"ab" + bytes([x])) for x in range(256)]
    assert abs(np.exp2(-model.entry_bits(pairs, False)).sum() - 1) < 1e-3


def test_lm_beats_word_counts_on_known_words(documents):
    got = lm_score.scores(documents).toPandas()
    assert lm_rows(got.itertuples()) == lm_base([(r.doc_id, r.text) for r in documents.collect()])
    known = got[(got.n_known == got.n_tokens) & ~got.held_out]
    assert known.score.sum() > 1.1 * known.base_score.sum()
    assert 1 < got.bits_per_byte.mean() < 4


def without_repeats(rows, least=line_dedup.MIN_WORDS):
    first, gone = {}, collections.defaultdict(set)
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0, k))
    cut = {k: (rows[k][1] or "").split("\n") for k in order}
    for k in order:
        full = [i for i, x in enumerate(cut[k]) if x.strip(" \t\r\f\x0b")]
        words = [len(cut[k][i].encode().split()) for i in full]
        for a in range(len(full)):
            total = 0
            for b in range(a, len(full)):
                total += words[b]
                if total >= least:
                    run = tuple(cut[k][i] for i in full[a : b + 1])
                    if first.setdefault(run, (k, a)) != (k, a):
                        gone[k].update(full[a : b + 1])
    return [(rows[k][0], None if rows[k][1] is None else "\n".join(x for i, x in enumerate(cut[k]) if i not in gone[k])) for k in range(len(rows))]


def _long_word_scores(spark, letters):
    keys = ["".join(chr(97 + (i * 7 + k * k * 3 + i * k) % 26) for k in range(letters)) for i in range(100)]
    rows = [(1000 + i, f"the key {keys[i % 100]} stands here", "a") for i in range(1000)]
    return lm_score.scores(make(spark, rows)).agg({"score": "avg"}).first()[0]


def test_lm_scores_long_known_words_by_their_counts(spark):
    short, long = _long_word_scores(spark, 150), _long_word_scores(spark, 1200)
    assert abs(short - long) < 0.5


def test_lm_mixes_counts_and_bytes_at_any_length():
    built, c = np.array([3.0, 900.0, 901.0, 1e6, 1e6, 40.0]), np.array([5, 5, 5, 5, 0, 3])
    plenty, share = np.array([50.0, 50, 50, 50, 50, 0]), 0.75
    got = lm_score.mixed_bits(built, c, plenty, share)
    assert got[0] == pytest.approx(-np.log2(0.75 * 0.1 + 0.25 / 8))
    assert got[1:4] == pytest.approx(-np.log2(0.75 * 0.1)) and got[4] == pytest.approx(1e6 + 2) and got[5] == 40


def test_lm_counts_stay_finite_and_whole():
    big = np.array([0, 1, 4_300_000_000, 10**12 + 1, 2**52])
    assert lm_score._numbers(lm_score._squeezed(big.astype(float), 8), 8).tolist() == big.tolist()
    zeros = np.full((lm_score.PREDICTORS, 1 << lm_score.TABLE_BITS), 1e12, np.float32)
    bits = lm_score.Mixer(zeros, zeros).entry_bits([(0, b"word ")], False)
    assert np.isfinite(bits).all()


def _hashed(context, salt):
    x = (context + salt) % 2**64 * 0x9E3779B97F4A7C15 % 2**64
    x ^= x >> 32
    return (x * 0xBF58476D1CE4E5B9 % 2**64) >> 32


def _plain_decisions(before, word, heads):
    """(slots, bit, place) of every decision of an entry, a byte and a bit at a time."""
    prime, wrap = 0x9E3779B97F4A7C15, 2**64
    for at in range(len(word)):
        contexts, running = [], 17
        for order in range(1, max(lm_score.ORDERS) + 1):
            running = ((running + (word[at - order] + 1 if at >= order else 0)) * prime + order) % wrap
            if order in lm_score.ORDERS:
                contexts.append(running)
        total = sum((b + 1) * pow(0x100000001B3, k, wrap) for k, b in enumerate(word[:at]))
        prefix = total * prime % wrap ^ (min(at, 255) << 56)
        after = (before + 1) * 0xC2B2AE3D27D4EB4F
        contexts.append(((prefix if heads else contexts[lm_score.ORDERS.index(3)]) + after) % wrap)
        if not heads and at < lm_score.HEAD:
            continue
        for j in range(8):
            node = (word[at] >> (8 - j) | 1 << j) * 0x9E3779B1 % 2**32
            slots = [
                ((_hashed(c, 101 * p + (7 if heads else 0)) ^ node) * 0x85EBCA6B % 2**32) >> (32 - lm_score.TABLE_BITS)
                for p, c in enumerate(contexts)
            ]
            yield slots, word[at] >> (7 - j) & 1, min(at, 2)


def _plain_bits(mixer, before, word, heads):
    bits = 0.0
    for slots, bit, place in _plain_decisions(before, word, heads):
        pairs = [mixer.counts[p, s] for p, s in enumerate(slots)]
        odds = [math.log((one + 0.04) / (zero + 0.04)) for zero, one in pairs]
        wide, near = (float(sum(pairs[lm_score.ORDERS.index(k)])) for k in (4, 5))
        gate = (place * 2 + (wide >= 100)) * 8 + sum(near >= x for x in (1, 3, 10, 40, 200, 1000, 10000))
        t = max(-16.0, min(16.0, sum(w * x for w, x in zip(mixer.weights[gate], odds))))
        p = 1 / (1 + math.exp(-t))
        if abs(t) < 8:
            where = (max(-7.999, min(7.999, t)) + 8) * (lm_score.CELLS - 1) / 16
            cell = int(where)
            p = (p + mixer.map[gate, cell] * (1 - where + cell) + mixer.map[gate, cell + 1] * (where - cell)) / 2
        p = min(1 - 1e-7, max(1e-7, p))
        bits -= math.log2(p if bit else 1 - p)
    return bits


def test_lm_score_equals_a_plain_walk(spark, monkeypatch):
    """Every byte and bit of a small table scored one at a time, under the weights that were learnt."""
    seen = []
    train = lm_score.train
    monkeypatch.setattr(lm_score, "train", lambda entries: seen.append(train(entries)) or seen[-1])
    rows = [(i, t, s) for i, t, s in odd_rows() if t is None or len(t) < 20_000]
    rows += [(100 + i, f"some words, and more words {i % 3}! Über alles", "a") for i in range(30)]
    got = {r.doc_id: r.score for r in lm_score.scores(make(spark, rows)).collect() if r.doc_id is not None}
    mixer = seen[0]
    train_words = collections.Counter()
    for i, text, _ in rows:
        if zlib.crc32(str("" if i is None else i).encode()) % lm_score.FOLDS != lm_score.HELD_OUT:
            train_words.update([*(text or "").encode().lower().split(), b""])
    total, once = sum(train_words.values()), sum(n == 1 for n in train_words.values())
    share = min(0.99, max(0.02, 1 - once / total))
    plenty = collections.Counter()
    for word, n in train_words.items():
        plenty[lm_score.head_of(word)] += n
    assert plenty == mixer.head_total
    for i, text, _ in rows:
        if i is None:
            continue
        score, last, script = 0.0, None, 0
        for word in [*(text or "").encode().lower().split(), b""]:
            mark = 0 if last is None else int(lm_score._MARK[last])
            kind = 0 if last is None else int(lm_score._CLASS[last])
            head = lm_score.head_of(word)
            score += _plain_bits(mixer, script << 7 | mark, head, True)
            tail = _plain_bits(mixer, kind, word + b" ", False)
            if plenty[head]:
                score -= math.log2(share * train_words[word] / plenty[head] + (1 - share) * 2.0**-tail)
            else:
                score += tail
            last = word[-1] if word else 0
            beyond = [b for b in word if b >= 128]
            script = (beyond[-1] & 63) + 1 if beyond else script
        assert got[i] == pytest.approx(-score * math.log10(2), rel=1e-4)


def test_lm_does_not_depend_on_the_cut_of_its_input(documents):
    """Other tasks and another number of shuffle partitions, as on another cluster, give the same scores."""
    spark = documents.sparkSession
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    one = sorted(lm_score.scores(documents.repartition(7)).select("doc_id", "score").collect())
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        two = sorted(lm_score.scores(documents.coalesce(1)).select("doc_id", "score").collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    assert [r.doc_id for r in one] == [r.doc_id for r in two]
    assert [r.score for r in one] == pytest.approx([r.score for r in two], rel=1e-12)


def test_line_dedup_equals_brute_force(spark):
    a, b, c, d = (prose(s, 30) for s in range(4))
    rows = [
        (1, f"{a}\n{b}\n{c}", "s"), (2, f"{d}\n\n{a}\n \n{b}\nx", "s"), (3, f"{b}\n{c}\n{a}", "s"), (4, f"{a}\n{b}\n{a}\n{b}\n{a}\n{b}", "s"),
        (5, prose(9, 60), "s"), (6, "y\n" + prose(9, 60), "s"), (7, None, "s"), (8, "", "s"), (9, "one line\none line", "s"), (10, f"{a}\n{d}", "s"),
    ]
    got = {r.doc_id: r.text for r in line_dedup.without_repeated_lines(make(spark, rows)).collect()}
    assert got == dict(without_repeats([(i, t) for i, t, _ in rows]))


def _of_few_lines(seed, n, most):
    """Texts of few distinct lines, so that runs repeat, overlap themselves and nest; some lines are blank or unique."""
    draw = np.random.default_rng(seed)
    pool = ["a", "b c", "d e f", "", " \t", "g h i j k l", "m n"]
    texts = []
    for i in range(n):
        body = [pool[k] for k in draw.integers(0, len(pool), draw.integers(0, most))]
        texts.append("\n".join(body if draw.random() < 0.5 else [*body, f"only{i}", *body[: len(body) // 2]]))
    return texts + texts[:3] + ["\n".join(["b c"] * 37), "\n".join(["b c"] * 50)]


@pytest.mark.parametrize("least", [1, 5, 20])
def test_line_dedup_of_nested_runs_equals_brute_force(spark, least):
    rows = [(None if i == 4 else i, t, "s") for i, t in enumerate(_of_few_lines(least, 25, 40))]
    got = {r.doc_id: r.text for r in line_dedup.without_repeated_lines(make(spark, rows), least).collect()}
    assert got == dict(without_repeats([(i, t) for i, t, _ in rows], least))


def _stretches(spark, texts):
    rows = spark.createDataFrame([(i, i, t) for i, t in enumerate(texts)], "row long, doc_id long, text string")
    return line_dedup.stretches(line_dedup.lines_of(rows), 1)


def test_suffix_array_is_whole_and_its_lcp_exact(spark):
    active = _stretches(spark, _of_few_lines(7, 20, 30))
    stretch, suffix = {}, {}
    for r in active.orderBy("row", "pos").collect():
        stretch.setdefault((r.row, r.pos - r.off), []).append(r.name)
    for (row, at), names in stretch.items():
        suffix |= {(row, at + k): tuple(names[k:]) for k in range(len(names))}
    array = line_dedup.suffix_array(line_dedup.suffix_paths(active))
    order = [(r.row, r.pos) for r in array.orderBy("sa").collect()]
    assert order == sorted(suffix, key=lambda p: (suffix[p], p))
    lcp = [r.lcp for r in line_dedup.neighbour_lcp(array).orderBy("sa").collect()]
    shared = [next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b))) for a, b in zip(map(suffix.get, order), map(suffix.get, order[1:]))]
    assert lcp == shared
    assert max(lcp) > 32


def test_line_dedup_of_a_line_on_a_third_of_all_rows(spark):
    rows = [(i, "the one line of very many texts\nmore " + prose(i, 3) if i % 3 else f"text {i} alone", "s") for i in range(600)]
    got = line_dedup.without_repeated_lines(make(spark, rows))
    assert {r.doc_id for r in got.filter("n_deleted = 1").collect()} == {i for i in range(2, 600) if i % 3}
    assert got.filter("n_deleted > 1").count() == 0


def test_line_dedup_of_odd_rows(odd, empty):
    got = line_dedup.without_repeated_lines(odd)
    assert set(odd.columns) | {"n_lines", "n_deleted"} == set(got.columns)
    rows = collections.Counter((r.doc_id, r.text) for r in got.collect())
    assert rows == collections.Counter(without_repeats([(i, t) for i, t, _ in odd_rows()]))
    assert line_dedup.without_repeated_lines(empty).count() == 0


def test_license_scan_confirms_wording_only(spark, odd, empty):
    filler = prose(3, 60)
    rows = [
        (1, f"{filler}\nLicensed under the Apache License, Version 2.0.", "s"),
        (2, f"{filler} released under the MIT license. {filler} Licensed under CC BY-NC 4.0", "s"),
        (3, "This work is licensed under the GNU General Public License, version 3.", "s"),
        (4, "I lost my driving licence near the copyright office", "s"),
        (5, license_scan.TEMPLATES["MIT-text"].upper(), "s"), (6, filler, "s"), (7, None, "s"), (8, "licen", "s"),
    ]
    got = {r.doc_id: list(r.licenses) for r in license_scan.licenses(make(spark, rows)).collect()}
    assert got == {1: ["Apache-2.0"], 2: ["CC-BY-NC-4.0", "MIT"], 3: ["GPL-3.0"], 4: [], 5: ["MIT-text"], 6: [], 7: [], 8: []}
    assert license_scan.licenses(odd).filter("n_blocks > 0").count() == 0 and license_scan.licenses(empty).count() == 0


def test_license_scan_equals_plain_search(documents):
    known = {
        "GPL-3.0": "licensed under the gnu general public license, version 3",
        "CC-BY-NC-4.0": "licensed under cc by-nc 4.0",
        "MIT": "released under the mit license",
        "Apache-2.0": "licensed under the apache license, version 2.0",
    }
    texts = {r.doc_id: r.text.lower() for r in documents.collect()}
    for r in license_scan.licenses(documents).collect():
        assert list(r.licenses) == sorted(k for k, v in known.items() if v in texts[r.doc_id])


def plain_scan(text, templates=license_scan.TEMPLATES):
    """Licences by comparing every template with every passage of the whole text, without blocks or compression."""
    words = license_scan.wording(text.encode())
    wanted = {name: license_scan.wording(t.encode()) for name, t in templates.items()}
    bands = ((license_scan.WIDTHS[1], 1 << 30), license_scan.WIDTHS, (0, license_scan.WIDTHS[0]))

    def best(part, allowed_words):
        found = None
        for name, template in sorted(wanted.items()):
            if not allowed_words[0] < len(template) <= allowed_words[1]:
                continue
            cost, price = license_scan.prices(part), license_scan.prices(template)
            row = [(0, j) for j in range(len(part) + 1)]  # cost, minus the start
            for word, lost in zip(template, price):
                new = [(row[0][0] + lost, 0)]
                for j, other in enumerate(part, 1):
                    swap = 0 if other == word else max(lost, cost[j - 1])
                    new.append(min((row[j - 1][0] + swap, row[j - 1][1]), (row[j][0] + lost, row[j][1]), (new[-1][0] + cost[j - 1], new[-1][1])))
                row = new
            end = min(range(len(row)), key=lambda j: row[j][0])
            if row[end][0] <= int(license_scan.DIFFERENT * len(template)) and (found is None or len(template) - row[end][0] > found[0]):
                found = (len(template) - row[end][0], name.partition("/")[0], row[end][1], end)
        return found

    out, parts = [], [words]
    for band in bands:
        left = []
        while parts:
            part = parts.pop()
            hit = best(part, band) if part else None
            if hit is None:
                left.append(part)
                continue
            out.append(hit[1])
            parts += [part[: hit[2]], part[hit[3] :]]
        parts = left
    return sorted(out)


def test_license_scan_equals_every_template_everywhere():
    scanner = license_scan.Scanner(license_scan.TEMPLATES)
    rnd = random.Random(4)
    names = sorted(license_scan.TEMPLATES)
    texts = [f"{prose(i, 30)} {license_scan.TEMPLATES[n]} {prose(i + 1, 25)}" for i, n in enumerate(names)]
    for i in range(25):
        parts = [license_scan.TEMPLATES[rnd.choice(names)] for _ in range(3)]
        # A word goes, is changed or put in, up to more than is allowed.
        words = " ".join(parts[1:]).split()
        for _ in range(rnd.randint(0, 6)):
            at = rnd.randrange(len(words))
            words[at : at + 1] = rnd.choice(([], ["other"], [words[at], "more"]))
        texts.append(f"{prose(i, 3 * i)} {parts[0]} {' '.join(words)} {prose(i + 1, i)}")
    for text in texts:
        assert sorted(m.license for m in scanner.scan(text.encode()) if m.confirmed) == plain_scan(text), text
    for i, name in enumerate(names):
        assert [m.license for m in scanner.scan(texts[i].encode()) if m.confirmed] == [name.partition("/")[0]]


def test_license_scan_finds_all_of_a_block(spark):
    whole, far = license_scan.TEMPLATES["MIT-text/whole"], " ".join(prose(2, 28).split())
    header = license_scan.TEMPLATES["GPL-3.0/header"]
    many = " ".join([license_scan.TEMPLATES["MIT"], license_scan.TEMPLATES["CC-BY-SA-4.0"]] * 300)
    rows = [
        (1, "Released under the MIT License. Licensed under the Apache License, Version 2.0.", "s"),
        (2, f"a copyright notice follows here {far} {whole}", "s"),
        (3, "# SPDX-License-Identifier: MIT\nimport x", "s"),
        (4, " * " + header.replace("General", "\n * General"), "s"),
        (5, header.replace("version 3", "version 4"), "s"),
        (6, license_scan.TEMPLATES["GPL-3.0"].replace("General", "Affero General"), "s"),
        (7, license_scan.TEMPLATES["CC-BY-4.0/notice"].replace("Attribution", "Attribution-NoDerivatives"), "s"),
        (8, "// SPDX-License-Identifier: LGPL-2.1-or-later", "s"),
        (9, "This work is licenced under the GNU General Public Licence, version 2", "s"),
        (10, license_scan.TEMPLATES["BSD-3-Clause"], "s"), (11, license_scan.TEMPLATES["BSD-2-Clause"], "s"),
        (12, many, "s"),
    ]
    got = {r.doc_id: r for r in license_scan.licenses(make(spark, rows)).collect()}
    want = {
        1: ["Apache-2.0", "MIT"], 2: ["MIT-text"], 3: ["MIT"], 4: ["GPL-3.0"], 5: [], 6: [], 7: [], 8: ["LGPL-2.1"],
        9: ["GPL-2.0"], 10: ["BSD-3-Clause"], 11: ["BSD-2-Clause"], 12: ["CC-BY-SA-4.0", "MIT"],
    }
    assert {i: list(r.licenses) for i, r in got.items()} == want
    assert got[12].n_blocks == 600
    spans = [(m.first, m.last) for m in got[12].matches]
    assert spans == sorted(spans) and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    with pytest.raises(ValueError):
        license_scan.Scanner({"x": "words that open no block"})
