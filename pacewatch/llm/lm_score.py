"""Language-model scores by logistic mixing of hashed-context bit predictors.

A text is its words, each followed by one blank, and a last blank for the end; every byte is
eight binary decisions. Several predictors look at a decision through contexts of their own,
hashed into tables of bit counts: the last two to five bytes of the word, and for the start
of a word all of what stood before, for the rest three bytes after the class of the mark
that stood before. Their log-odds are mixed by weights that a
gate selects (how well the longest contexts are known, and where in the word), and the mix
is refined by an adaptive map from (gate, mixed probability) to the frequency seen. Weights
and map learn online, each head predicted from all its other occurrences and each tail from
all other words, so that no word is judged by itself and what is learnt holds for new words.

A word's first two bytes (its head) depend on the last mark and the script before it, the
rest (its tail) on the word and the class of that mark. Texts are therefore packed into
blocks with a vocabulary each: distinct heads and distinct (class, word) entries with their
counts, which is all that is shuffled to be counted and all that is scored. What is gathered
so grows with the corpus, and no text leaves its block.

The bytes know how words are built, the counts how often whole words come: given its head, a
word's probability is the sum of both models' with one weight, the share of words that were
seen before. Either gives one to all words together, so the sum does.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pacewatch.llm.common import bounded_batches, column_of, fold, given_back, only, stored, texts_of

FOLDS, HELD_OUT = 5, 1
#: Bytes of text that close a block.
BLOCK_BYTES = 24 << 20
#: Slots of one predictor's table, as a power of two.
TABLE_BITS = 19
#: Predictors: orders 2 to 5, then for heads the bytes so far after mark and script, for tails
#: order 3 after the class before the word.
ORDERS = (2, 3, 4, 5)
PREDICTORS = len(ORDERS) + 1
#: Bytes of a head.
HEAD = 2
GATES = 48
CELLS = 33
#: Steps of the learner, for heads and for tails.
HEAD_RATE, RATE = 0.005, 0.05
#: An entry that occurs n times weighs n to this power as it is learnt from.
HEAD_POWER, POWER = 0.8, 0.25
#: Decisions that step the weights together, and entries that are worked on at a time.
BATCH = 32_768
STEP = 20_000
#: Slots of one slice of a table, as it is merged.
SLICE = 1 << 14
#: Numbers below this are told apart by counting, larger ones by sorting.
COUNTED = 1 << 23
#: Distinct entries that one learner walks through; their number decides how many learners there are.
LEARNER = 1 << 19
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_ODD = 0x100000001B3
#: Mark of a word by its last byte: each ASCII mark its own, letters, digits, beyond ASCII.
_MARK = np.array([1 if b >= 128 else 2 if 97 <= b <= 122 else 3 if 48 <= b <= 57 else b & 31 | 32 | (b & 64) for b in range(256)], np.int32)
#: Class of a last byte for tails: plain, then kinds of marks that come in long rows.
_CLASS = np.array([{**dict.fromkeys(b"#$%&*", 1), **dict.fromkeys(b"!", 2), **dict.fromkeys(b"|<>{}=/\\", 3)}.get(b, 0) for b in range(256)], np.int32)
_ASCII = bytes(range(128))

Entries = list[tuple[int, bytes]]


def _powers(n: int) -> np.ndarray:
    out = np.full(n, np.uint64(_ODD), np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _mixed(context: np.ndarray, salt: int) -> np.ndarray:
    """32 well mixed bits of a context."""
    x = (context + np.uint64(salt)) * _PRIME
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(32)).astype(np.uint32)


def decisions(entries: Entries, heads: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(slots by predictor, bit, place, entry) of each binary decision of the entries, in order.

    An entry is (what stood before, bytes with the closing blank). Heads are cut already; of
    tails only the bytes after the head are decided.
    """
    sizes = np.array([len(w) for _, w in entries], np.int64)
    data = np.frombuffer(b"".join([w for _, w in entries]), np.uint8)
    owner = np.repeat(np.arange(len(entries)), sizes)
    starts = (np.cumsum(sizes) - sizes).astype(np.int64)
    at = np.arange(len(data)) - starts[owner]
    value = data.astype(np.uint64) + np.uint64(1)
    before = np.array([k for k, _ in entries], np.uint64)[owner]
    # Prefix hash of the word so far: running sums of bytes times powers of an odd number.
    terms = value * _powers(int(sizes.max(initial=1)))[at]
    total = np.cumsum(terms, dtype=np.uint64) - terms
    prefix = (total - total[np.minimum(starts, max(0, len(data) - 1))][owner]) * _PRIME ^ (np.minimum(at, 255).astype(np.uint64) << np.uint64(56))
    running, contexts = np.full(len(data), np.uint64(17)), []
    for order in range(1, max(ORDERS) + 1):
        shifted = np.zeros(len(data), np.uint64)
        shifted[order:] = value[: max(0, len(data) - order)]
        shifted[at < order] = 0
        running = (running + shifted) * _PRIME + np.uint64(order)
        if order in ORDERS:
            contexts.append(running)
    after = (before + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
    contexts.append((prefix if heads else contexts[ORDERS.index(3)]) + after)
    if not heads:
        chosen = at >= HEAD
        data, at, owner = data[chosen], at[chosen], owner[chosen]
        contexts = [c[chosen] for c in contexts]
    n = len(data)
    slots = np.empty((PREDICTORS, n, 8), np.uint32)
    bits = np.empty((n, 8), np.uint8)
    shift = np.uint32(32 - TABLE_BITS)
    nodes = []
    for j in range(8):
        node = (data.astype(np.uint32) >> np.uint32(8 - j)) | np.uint32(1 << j)
        nodes.append(node * np.uint32(0x9E3779B1))
        bits[:, j] = (data >> np.uint8(7 - j)) & 1
    for p, context in enumerate(contexts):
        base = _mixed(context, 101 * p + (7 if heads else 0))
        for j in range(8):
            x = base ^ nodes[j]
            x *= np.uint32(0x85EBCA6B)
            x >>= shift
            slots[p, :, j] = x
    place = np.minimum(at, 2).astype(np.int64)
    return slots.reshape(PREDICTORS, -1).view(np.int32), bits.reshape(-1), np.repeat(place, 8), np.repeat(owner, 8)


class Counts:
    """Occurrences of zeros and ones in every slot of every predictor."""

    def __init__(self):
        self.zeros = np.zeros((PREDICTORS, 1 << TABLE_BITS))
        self.ones = np.zeros((PREDICTORS, 1 << TABLE_BITS))

    def add(self, entries: Entries, n: np.ndarray, heads: bool) -> None:
        slots, bits, _, owner = decisions(entries, heads)
        weight = n[owner].astype(np.float64)
        up, down = weight * bits, weight * (1 - bits)
        for p in range(PREDICTORS):
            self.ones[p] += np.bincount(slots[p], up, 1 << TABLE_BITS)
            self.zeros[p] += np.bincount(slots[p], down, 1 << TABLE_BITS)


class Mixer:
    """Gated weights over the predictors' log-odds, and the adaptive map behind them."""

    def __init__(self, zeros: np.ndarray, ones: np.ndarray):
        #: (predictors, slots, 2): a pair is read at once.
        self.counts = np.stack([zeros, ones], axis=-1).astype(np.float32)
        self.weights = np.full((GATES, PREDICTORS), 0.24)
        # Heads (the first gates) start from the context that sees all that stood before.
        self.weights[: GATES * HEAD // (HEAD + 1)] = [0.0] * len(ORDERS) + [1.0]
        self.map = np.tile(1 / (1 + np.exp(-np.linspace(-8, 8, CELLS))), (GATES, 1))
        self.seen = np.full((GATES, CELLS), 20.0)
        self.head_total: dict[bytes, int] = {}

    def inputs(
        self, slots: np.ndarray, place: np.ndarray, bits: np.ndarray | None = None, n: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """Log-odds of each predictor and the gate; with ``bits`` ``n`` own occurrences are left out."""
        x = np.empty((PREDICTORS, slots.shape[1]), np.float32)
        known = []
        own = None if bits is None else np.stack([(1 - bits) * n, bits * n], axis=-1).astype(np.float32)
        for p in range(PREDICTORS):
            pair = self.counts[p].view(np.float64).reshape(-1)[slots[p]].view(np.float32).reshape(-1, 2)
            if own is not None:
                pair = np.maximum(pair - own, 0)
            if p in (ORDERS.index(4), ORDERS.index(5)):
                known.append(pair[:, 0] + pair[:, 1])
            x[p] = np.log((pair[:, 1] + np.float32(0.04)) / (pair[:, 0] + np.float32(0.04)))
        wide = np.searchsorted(np.array([100], np.float32), known[0], side="right")
        near = np.searchsorted(np.array([1, 3, 10, 40, 200, 1000, 10000], np.float32), known[1], side="right")
        return x, (place * 2 + wide) * 8 + near

    def mix(self, x: np.ndarray, gate: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(final probability of a one, mixed probability, map cell, share of the next cell)."""
        weights = self.weights.T.astype(np.float32)
        t = np.zeros(x.shape[1], np.float32)
        for p in range(PREDICTORS):
            t += x[p] * weights[p][gate]
        np.clip(t, -16, 16, out=t)
        mixed = 1 / (1 + np.exp(-t))
        where = (np.clip(t, -7.999, 7.999) + np.float32(8)) * np.float32((CELLS - 1) / 16)
        cell = where.astype(np.int64)
        share = where - cell
        flat, index = self.map.reshape(-1).astype(np.float32), gate * CELLS + cell
        refined = flat[index] * (1 - share) + flat[index + 1] * share
        final = np.where(np.abs(t) < 8, (mixed + refined) / 2, mixed)
        return np.clip(final, 1e-7, 1 - 1e-7), mixed, cell, share

    def learn(self, slots: np.ndarray, bits: np.ndarray, place: np.ndarray, own: np.ndarray, weight: np.ndarray, rate: float) -> None:
        """One online step: predict a batch without its own occurrences, then move."""
        x, gate = self.inputs(slots, place, bits, own)
        _, mixed, cell, share = self.mix(x, gate)
        error = ((bits - mixed) * weight).astype(np.float32)
        total = np.bincount(gate, weight, GATES)
        rate = rate / np.maximum(1.0, total) * np.minimum(1.0, total / 64)
        for p in range(PREDICTORS):
            self.weights[:, p] += rate * np.bincount(gate, error * x[p], GATES)
        index = gate * CELLS + cell + (share >= 0.5)
        hits = np.bincount(index, weight, GATES * CELLS).reshape(GATES, CELLS)
        ups = np.bincount(index, weight * bits, GATES * CELLS).reshape(GATES, CELLS)
        self.seen += hits
        self.map += (ups - hits * self.map) / self.seen

    def learn_entries(self, entries: Entries, n: np.ndarray, heads: bool) -> None:
        """Learn from distinct entries; one that occurs n times weighs a power of n."""
        for a in range(0, len(entries), STEP):
            slots, bits, place, owner = decisions(entries[a : a + STEP], heads)
            count = n[a : a + STEP][owner]
            # Heads are few and come again and again; tails stand for words not seen before.
            own, weight = (np.minimum(count, 1), count**HEAD_POWER) if heads else (count, count**POWER)
            rate = HEAD_RATE if heads else RATE
            step = BATCH // 8 if heads else BATCH
            for i in range(0, len(bits), step):
                j = i + step
                self.learn(slots[:, i:j], bits[i:j], place[i:j], own[i:j], weight[i:j], rate)

    def entry_bits(self, entries: Entries, heads: bool) -> np.ndarray:
        """Bits of every entry under the model as learnt."""
        out = np.zeros(len(entries))
        for a in range(0, len(entries), STEP):
            part = entries[a : a + STEP]
            slots, bits, place, owner = decisions(part, heads)
            final = self.mix(*self.inputs(slots, place))[0]
            out[a : a + STEP] = np.bincount(owner, -np.log2(np.where(bits == 1, final, 1 - final)), len(part))
        return out


def before(ids: np.ndarray, first: np.ndarray, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(mark and script, class) before each token; ``first`` tells the first token of each text.

    The script is the last byte beyond ASCII in the text so far, which tells languages
    apart. Both are functions of the text before, so they take nothing from what comes.
    """
    last = np.array([w[-1] if w else 0 for w in words], np.int32)
    odd = np.array([0 if w.isascii() else (w.translate(None, _ASCII)[-1] & 63) + 1 for w in words], np.int32)
    zero = np.zeros(1, np.int32)
    seen = np.where(first, 0, np.r_[zero, last[ids][:-1]]) if len(ids) else ids
    mark = np.where(first, 0, _MARK[seen])
    script = np.where(first, 0, np.r_[zero, odd[ids][:-1]]) if len(ids) else ids
    place = np.arange(len(ids), dtype=np.int32)
    # The last place with a script, but not before the text's own start.
    found = np.maximum.accumulate(np.where((script > 0) | first, place, 0)) if len(ids) else ids
    return script[found] << 7 | mark, np.where(first, 0, _CLASS[seen])


def head_of(word: bytes) -> bytes:
    return word[:HEAD] if len(word) >= HEAD else word + b" "


# -- on Spark --------------------------------------------------------------------

#: One table for both kinds of rows of a block: its entries (``at`` from 0), and one row
#: (``at`` -1) with the texts as entry numbers.
_ROWS = (
    "block long, at int, head boolean, kind int, word binary, n long, "
    "ids binary, head_ids binary, sizes binary, lengths binary, held binary, docs array<long>"
)
_SCHEMA = pa.schema(
    [
        ("block", pa.int64()), ("at", pa.int32()), ("head", pa.bool_()), ("kind", pa.int32()), ("word", pa.binary()), ("n", pa.int64()),
        ("ids", pa.binary()), ("head_ids", pa.binary()), ("sizes", pa.binary()), ("lengths", pa.binary()), ("held", pa.binary()), ("docs", pa.list_(pa.int64())),
    ]
)


def _squeezed(numbers: np.ndarray, size: int = 4) -> bytes:
    """Whole numbers of ``size`` bytes, byte by byte place, compressed."""
    planes = np.ascontiguousarray(numbers.astype(f"<u{size}").view(np.uint8).reshape(-1, size).T)
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def _numbers(squeezed: bytes, size: int = 4) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(squeezed), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(f"<i{size}").reshape(-1)


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct small numbers in order, and the place of each key among them."""
    if int(keys.max()) >= COUNTED:
        found, place = np.unique(keys, return_inverse=True)
        return found, place.astype(np.int32)
    found = np.flatnonzero(np.bincount(keys))
    place = np.zeros(int(keys.max()) + 1, np.int32)
    place[found] = np.arange(len(found), dtype=np.int32)
    return found, place[keys]


def _packed(name: int, words: list[bytes], texts: list[np.ndarray], held: list[bool], keys: list) -> Iterator[pa.RecordBatch]:
    """One block as rows: tails and heads with training counts, and the texts as numbers."""
    ids = np.concatenate(texts)
    sizes = np.array(list(map(len, texts)), np.int64)
    first = np.zeros(len(ids), bool)
    first[np.cumsum(sizes) - sizes] = True
    kinds, classes = before(ids, first, words)
    train = np.repeat(~np.array(held, bool), sizes)
    entry, entry_ids = _distinct(ids * 4 + classes)
    starts: defaultdict = defaultdict()
    starts.default_factory = starts.__len__
    head_of_word = np.array([starts[head_of(w)] for w in words], np.int64)
    kind, kind_ids = _distinct(kinds)
    pair, head_ids = _distinct(kind_ids.astype(np.int64) * len(starts) + head_of_word[ids])
    names = list(starts)

    def rows(head: bool, kind: np.ndarray, listed: list[bytes], counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        for a in range(0, len(listed), STEP):
            n = len(listed[a : a + STEP])
            have = {
                "block": np.full(n, name), "at": np.arange(a, a + n, dtype=np.int32), "head": np.full(n, head),
                "kind": kind[a : a + n].astype(np.int32), "word": listed[a : a + n], "n": counts[a : a + n],
            }
            yield pa.RecordBatch.from_arrays([pa.array(have[f.name], f.type) if f.name in have else pa.nulls(n, f.type) for f in _SCHEMA], schema=_SCHEMA)

    lengths = np.array([len(w) for w in words], np.int64)[entry >> 2]
    yield from rows(False, entry & 3, [words[i] for i in entry >> 2], np.bincount(entry_ids[train], minlength=len(entry)))
    yield from rows(True, kind[pair // len(starts)], [names[i] for i in pair % len(starts)], np.bincount(head_ids[train], minlength=len(pair)))
    whole = {
        "block": name, "at": -1, "ids": _squeezed(entry_ids), "head_ids": _squeezed(head_ids),
        "sizes": _squeezed(sizes), "lengths": _squeezed(lengths), "held": np.array(held, np.uint8).tobytes(), "docs": keys,
    }
    yield pa.RecordBatch.from_pylist([whole], schema=_SCHEMA)


def blocks(docs: DataFrame) -> DataFrame:
    """Pack texts into blocks: the vocabulary with its training counts, and each text as numbers.

    A block is named by its task and its number there, so a repeated task gives the same rows.
    """
    rows = only(docs, doc_id="long", text="string").withColumn("held_out", fold(F.col("doc_id"), FOLDS) == HELD_OUT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary: defaultdict = defaultdict()
        texts: list[np.ndarray] = []
        held: list[bool] = []
        keys: list = []
        name, size = TaskContext.get().partitionId() << 32, 0

        def seal() -> Iterator[pa.RecordBatch]:
            nonlocal name, size
            yield from _packed(name, list(vocabulary), texts, held, keys)
            for x in (vocabulary, texts, held, keys):
                x.clear()
            name, size = name + 1, 0

        vocabulary.default_factory = vocabulary.__len__
        for batch in given_back(batches):
            columns = (column_of(batch, x).to_pylist() for x in ("doc_id", "held_out"))
            for text, key, out in zip(texts_of(batch), *columns):
                words = text.lower().split()
                words.append(b"")
                texts.append(np.fromiter(map(vocabulary.__getitem__, words), np.int32, len(words)))
                keys.append(key)
                held.append(out)
                size += len(text) + 1
                if size >= BLOCK_BYTES:
                    yield from seal()
        if keys:
            yield from seal()

    bounded_batches(docs.sparkSession)
    return stored(rows.mapInArrow(run, _ROWS))


def _entries(part: pa.RecordBatch, heads: bool) -> Entries:
    words = part.column("word").to_pylist()
    if not heads:
        words = [w + b" " for w in words]
    return list(zip(part.column("kind").to_pylist(), words))


def _split(batch: pa.RecordBatch) -> Iterator[tuple[bool, Entries, np.ndarray]]:
    """The heads and the tails of a batch."""
    is_head = column_of(batch, "head")
    for heads in (True, False):
        part = batch.filter(is_head if heads else pa.compute.invert(is_head))
        if part.num_rows:
            yield heads, _entries(part, heads), part.column("n").to_numpy().astype(np.float64)


def count_tables(entries: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Tables of bit counts over all training entries (head, kind, word, n).

    As many tasks as there are cores each fill tables of the fixed size and send them in
    slices of squeezed whole numbers, which are added up by slice; the driver gets one table
    of each predictor. Whole numbers below 2**53 add up exactly, in whatever order.
    """
    spark = entries.sparkSession
    floats = "predictor int, slice int, zeros binary, ones binary"

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, some = Counts(), False
        for batch in given_back(batches):
            for heads, pairs, n in _split(batch):
                some = True
                counts.add(pairs, n, heads)
        if not some:
            return
        for p in range(PREDICTORS):
            cut = [(i, counts.zeros[p, i : i + SLICE], counts.ones[p, i : i + SLICE]) for i in range(0, 1 << TABLE_BITS, SLICE)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([p] * len(cut), pa.int32()),
                    pa.array([i for i, _, _ in cut], pa.int32()),
                    pa.array([_squeezed(z, 8) for _, z, _ in cut]),
                    pa.array([_squeezed(o, 8) for _, _, o in cut]),
                ],
                names=["predictor", "slice", "zeros", "ones"],
            )

    def add(group: pa.Table) -> pa.Table:
        total = {
            name: sum(_numbers(x, 8) for x in group.column(name).to_pylist()).astype(np.float32).tobytes()
            for name in ("zeros", "ones")
        }
        first = {name: group.column(name)[:1] for name in ("predictor", "slice")}
        return pa.table(first | {name: pa.array([x]) for name, x in total.items()})

    tasks = max(1, spark.sparkContext.defaultParallelism)
    parts = entries.filter("n > 0").coalesce(tasks).mapInArrow(fill, floats)
    zeros = np.zeros((PREDICTORS, 1 << TABLE_BITS), np.float32)
    ones = np.zeros_like(zeros)
    for row in parts.groupBy("predictor", "slice").applyInArrow(add, floats).toLocalIterator():
        at = slice(row["slice"], row["slice"] + SLICE)
        zeros[row["predictor"], at] = np.frombuffer(row["zeros"], np.float32)
        ones[row["predictor"], at] = np.frombuffer(row["ones"], np.float32)
    return zeros, ones


def train(entries: DataFrame) -> Mixer:
    """Count, then learn weights and map online in every learner's share and average by what each has seen.

    The number of learners follows from the number of entries, and a learner's entries and
    their order from hashes. Sums are taken in decimals. So neither the number of cores nor
    the order of tasks changes what is learnt.
    """
    tables = count_tables(entries)
    mixer = Mixer(*tables)
    shared = entries.sparkSession.sparkContext.broadcast(tables)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, total = Mixer(*shared.value), 0.0
        for batch in given_back(batches):
            for heads, pairs, n in _split(batch):
                own.learn_entries(pairs, n, heads)
                total += float(n.sum())
        if total:
            seen = own.seen - 20.0
            values = np.concatenate([own.weights.ravel() * total, (own.map * (seen + 1e-3)).ravel()])
            parts = np.concatenate([np.full(own.weights.size, total), (seen + 1e-3).ravel()])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values), pa.array(parts)], names=["i", "v", "w"])

    known = entries.filter("n > 0")
    learners = max(1, -(-known.count() // LEARNER))
    # Hash order within a share mixes common and rare words.
    order = F.xxhash64("word", "kind", "head")
    dealt = known.repartition(learners, order).sortWithinPartitions(order, "word", "kind", "head")
    exact = "decimal(38,12)"
    sums = dealt.mapInArrow(learn, "i long, v double, w double").groupBy("i")
    sums = sums.agg(*(F.sum(F.col(x).cast("decimal(28,12)")).cast(exact).cast("double").alias(x) for x in "vw"))
    rows = sums.toPandas().sort_values("i")
    if len(rows):
        mean = (rows["v"] / rows["w"]).to_numpy()
        mixer.weights = mean[: mixer.weights.size].reshape(mixer.weights.shape)
        seen = (rows["w"].to_numpy()[mixer.weights.size :] - 1e-3).reshape(mixer.map.shape)
        learnt = mean[mixer.weights.size :].reshape(mixer.map.shape)
        mixer.map = (learnt * seen + mixer.map * 20.0) / (seen + 20.0)
    return mixer


def mixed_bits(built: np.ndarray, c: np.ndarray, plenty: np.ndarray, share: float) -> np.ndarray:
    """Bits of words that the bytes give in ``built`` bits and that ``c`` of ``plenty`` words of their head are.

    The sum of both chances is taken in logarithms, so words of any length keep their counts.
    """
    with np.errstate(divide="ignore"):
        counted = np.log2(share * c) - np.log2(np.maximum(plenty, 1))
    return np.where(plenty > 0, -np.logaddexp2(counted, math.log2(1 - share) - built), built)


def _share(once: int, total: int) -> float:
    """Weight of the word counts: one less the chance of a new word (Good-Turing), which is the
    share of words seen once."""
    return min(0.99, max(0.02, 1 - once / total)) if total else 0.0


def scores(docs: DataFrame) -> DataFrame:
    """One row per document: (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte).

    Null and empty texts are the end alone. Without training rows every count is zero and
    the model is the one before learning. Repeated rows are scored, and learnt from, each.
    A null doc_id counts as the empty text in its fold. Other columns are not read. An empty
    table gives no rows.
    """
    packed = blocks(docs)

    listed = packed.filter("at >= 0").select("block", "at", "head", "kind", "word", "n")
    entries = stored(listed.groupBy("word", "kind", "head").agg(F.sum("n").alias("n")))
    mixer = train(entries)
    # At most one row for each head of up to two bytes.
    heads = entries.filter("head and n > 0").groupBy("word").agg(F.sum("n").alias("n"))
    mixer.head_total = {bytes(r["word"]): r["n"] for r in heads.collect()}
    shared = docs.sparkSession.sparkContext.broadcast(mixer)

    # Classes of a tail are few, so a word's window holds a handful of rows.
    by_word = Window.partitionBy("word", "head")
    counted = stored(
        entries.select(
            "word", "kind", "head", F.sum("n").over(by_word).alias("c"), (F.row_number().over(by_word.orderBy("kind")) == 1).alias("first")
        )
    )
    word = F.col("first") & ~F.col("head")
    total, distinct, once = counted.agg(
        F.coalesce(F.sum(F.when(word, F.col("c"))), F.lit(0)),
        F.count(F.when(word & (F.col("c") > 0), 1)),
        F.count(F.when(word & (F.col("c") == 1), 1)),
    ).first()
    share = _share(once, total)

    def cost(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Bits of each entry, the tails mixed with the counts of words of the same head."""
        own = shared.value
        for batch in given_back(batches):
            for heads in (True, False):
                part = batch.filter(column_of(batch, "head") if heads else pa.compute.invert(column_of(batch, "head")))
                if not part.num_rows:
                    continue
                words = column_of(part, "word").to_pylist()
                bits = own.entry_bits(_entries(part, heads), heads)
                c = column_of(part, "c").to_numpy()
                if not heads:
                    plenty = np.array([own.head_total.get(head_of(w), 0) for w in words], float)
                    bits = mixed_bits(bits, c, plenty, share)
                yield pa.RecordBatch.from_arrays(
                    [*(column_of(part, x) for x in ("word", "kind", "head", "c")), pa.array(bits)],
                    names=["word", "kind", "head", "c", "bits"],
                )

    judged = counted.select("word", "kind", "head", "c").mapInArrow(cost, "word binary, kind int, head boolean, c long, bits double")
    # One whole number names block and kind of row, so that Spark sorts by it alone; the wide row comes first.
    place = (F.col("block") * 2 + F.when(F.col("at") >= 0, 1).otherwise(0)).alias("place")
    known = listed.drop("n").join(judged, ["word", "kind", "head"])
    known = known.select(
        place,
        F.col("head").cast("int").alias("kind"),
        "at",
        F.when(~F.col("head"), F.col("c")).otherwise(0).alias("c"),
        F.col("bits").cast("float").alias("bits"),
        F.lit(None).cast("binary").alias("whole"),
    )
    base = math.log10(total + 0.5 * (distinct + 1))
    result = (
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"
    )

    def summed(whole: bytes, known: list[pa.RecordBatch]) -> pa.RecordBatch:
        """The scores of a block's texts from its one wide row and its entries."""
        texts = pa.ipc.open_stream(whole).read_next_batch()
        row = {name: texts.column(name)[0] for name in wide}
        ids, head_ids, sizes, lengths = (_numbers(row[x].as_py()) for x in ("ids", "head_ids", "sizes", "lengths"))
        found = pa.Table.from_batches(known)
        is_head = found.column("kind").to_numpy() == 1
        at, count = found.column("at").to_numpy(), found.column("c").to_numpy()
        cost = found.column("bits").to_numpy().astype(np.float64)

        def by_number(values: np.ndarray, mine: np.ndarray) -> np.ndarray:
            out = np.zeros(int(mine.sum()), values.dtype)
            out[at[mine]] = values[mine]
            return out

        c, bits, head_bits = by_number(count, ~is_head), by_number(cost, ~is_head), by_number(cost, is_head)
        n = len(sizes)
        owner = np.repeat(np.arange(n, dtype=np.int32), sizes)
        spent = np.bincount(owner, bits[ids] + head_bits[head_ids], n)
        columns = [
            row["docs"].values,
            pa.array(np.frombuffer(row["held"].as_py(), np.uint8).astype(bool)),
            pa.array(sizes.astype(np.int64)),
            pa.array(np.bincount(owner, c[ids] > 0, n).astype(np.int64)),
            pa.array(np.full(n, total, np.int64)),
            pa.array(np.bincount(owner, (np.log10(c + 0.5) - base)[ids], n)),
            pa.array(-spent * math.log10(2)),
            pa.array(spent / np.bincount(owner, lengths[ids] + 1, n)),
        ]
        return pa.RecordBatch.from_arrays(columns, names=[part.split()[0] for part in result.split(", ")])

    def total_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A block's wide row comes first, then its entries; one block's numbers are held at a time."""
        whole, entries_of = None, []
        narrow = ["kind", "at", "c", "bits"]
        for batch in given_back(batches):
            begins = np.flatnonzero(column_of(batch, "whole").is_valid().to_numpy(zero_copy_only=False))
            cuts = sorted({0, *begins.tolist(), batch.num_rows})
            starts = set(begins.tolist())
            for a, b in zip(cuts, cuts[1:]):
                if a in starts:
                    if whole is not None:
                        yield summed(whole, entries_of)
                    whole, entries_of = column_of(batch, "whole")[a].as_py(), []
                    a += 1
                if b > a:
                    entries_of.append(batch.select(narrow).slice(a, b - a))
        if whole is not None:
            yield summed(whole, entries_of)

    wide = ["ids", "head_ids", "sizes", "lengths", "held", "docs"]
    def one_value(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A block's wide row as one binary value, so that its entries carry one empty column."""
        for batch in given_back(batches):
            values = []
            for i in range(batch.num_rows):
                sink = pa.BufferOutputStream()
                one = pa.RecordBatch.from_arrays([pa.concat_arrays([column_of(batch, x).slice(i, 1)]) for x in wide], names=wide)
                with pa.ipc.new_stream(sink, one.schema) as out:
                    out.write_batch(one)
                values.append(sink.getvalue().to_pybytes())
            yield pa.RecordBatch.from_arrays([column_of(batch, "place"), pa.array(values, pa.binary())], names=["place", "whole"])

    whole = packed.filter("at < 0").select(place, *wide).mapInArrow(one_value, "place long, whole binary")
    rows = known.unionByName(whole, allowMissingColumns=True)
    # Every block has the one entry of the end at least, so both kinds of rows meet by hash.
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = rows.repartition(parts, F.shiftright("place", 1)).sortWithinPartitions("place")
    return met.select("kind", "at", "c", "bits", "whole").mapInArrow(total_up, result)
