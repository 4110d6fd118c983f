"""Document quality from preference pairs (Bradley-Terry), cut at a quantile of the scores.

A document's worth is linear in features of its text alone. Of a labelled pair of different
labels the better one is preferred with probability sigmoid(worth difference); the weights
minimise the logistic loss on feature differences. The cut is the quantile of the worths at
the share of poor documents, and a single slope turns the distance to it into a probability.

Every labelled row outside the held-out fold takes part in each of these. Rows are dealt into
blocks of both labels, and a block holds all pairs between its two sides: all pairs there are
in a small table, ``BLOCK`` partners for each row of the larger class in a large one. Only
sums over all blocks or rows come to the driver.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacewatch.llm.common import bounded_batches, column_of, fold, given_back, logistic, marked, only, stored, texts_of
from pacewatch.operators.oversample import dense_index

#: Rows of a label in a block of pairs, at most.
BLOCK = 256
#: Preference pairs that :func:`fit` draws from rows at hand.
PAIRS = 60_000
#: Ranges that values are counted in to find a quantile, in each pass.
RANGES = 1_024
#: Rows of the fold with this remainder are held out.
FOLDS, HELD_OUT = 3, 1

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGIT = bytes(range(48, 58))
_SPACE = b" \t\n\r\x0b\x0c"
_MARKS = b"!#$%&*|.,?:;-_/\\<>{}[]()=+@'\""
_HIGH = bytes(range(128, 256))


def features(text: bytes) -> list[float]:
    """Shares of character kinds and marks, word and line shape, repetition; empty texts give zeros."""
    size = len(text)
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip()]
    n = max(1, len(words))
    per_byte = 1.0 / max(1, size)
    distinct = set(words)
    tails = [w[-1:] for w in words]
    out = [(size - len(text.translate(None, kind))) * per_byte for kind in (_UPPER, _LOWER, _DIGIT, _SPACE, _HIGH)]
    out += [text.count(bytes([mark])) / n for mark in _MARKS]
    out += [
        np.log1p(size) / 10,
        np.log1p(len(words)) / 10,
        size / n / 10 if words else 0.0,
        len(distinct) / n,
        len(words) / max(1, len(lines)) / 100,
        1 - len(set(lines)) / max(1, len(lines)),
        sum(w.isupper() for w in words) / n,
        sum(t in b"!#$%&*|" for t in tails) / n,
        sum(t in b".?!" for t in tails) / n,
        sum(w.isalpha() for w in words) / n,
        len(zlib.compress(text, 1)) / max(64, size),
        float(not words),
    ]
    return [min(x, 5.0) for x in out]


@dataclass
class QualityModel:
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    cut: float
    slope: float

    def worth(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.spread) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * (self.worth(x) - self.cut), -30, 30)))


def weighted_quantile(values: np.ndarray, weights: np.ndarray, share: float) -> float:
    """Linear between the sorted values; with equal weights the usual quantile."""
    order = np.argsort(values, kind="stable")
    before = np.cumsum(weights[order]) - weights[order]
    return float(np.interp(share, before / (before[-1] or 1.0), values[order]))


def fit(x: np.ndarray, y: np.ndarray, pairs: int = PAIRS, seed: int = 7, w: np.ndarray | None = None) -> QualityModel:
    """Learn from feature rows and labels at hand; with one class only, all rows get that class.

    :func:`train` learns from tables, without drawing pairs. ``w`` is how many rows each row stands for, one if not given.
    """
    w = np.ones(len(y)) if w is None else w
    mean = np.average(x, 0, w) if len(x) else np.zeros(x.shape[1])
    spread = (np.sqrt(np.average((x - mean) ** 2, 0, w)) if len(x) else np.ones(x.shape[1])) + 1e-6
    good, poor = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(poor):
        return QualityModel(mean, spread, np.zeros(x.shape[1]), 0.0 if len(good) or not len(poor) else 1.0, 1.0)
    rng = np.random.default_rng(seed)
    z = (x - mean) / spread
    better, worse = z[rng.choice(good, pairs)], z[rng.choice(poor, pairs)]
    # Each pair also counts the other way round, so the loss has no constant to learn.
    difference = np.concatenate([better - worse, worse - better])
    weights = logistic(difference, np.r_[np.ones(pairs), np.zeros(pairs)], ridge=1e-3)
    model = QualityModel(mean, spread, weights, 0.0, 1.0)
    worth = model.worth(x)
    model.cut = weighted_quantile(worth, w, w[poor].sum() / w.sum())
    centred = (worth - model.cut)[:, None]
    model.slope = max(1e-3, float(logistic(centred, (y == 1).astype(float), ridge=1e-6, weights=w)[0]))
    return model


def labelled_features(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, label, x) of every labelled id outside the held-out fold that has a document.

    An id that repeats gives one row, that of the least text hash. Features are taken where
    the texts lie, so that no text is moved.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given_back(batches):
            x = pa.array([features(text) for text in texts_of(batch)], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([column_of(batch, "doc_id"), column_of(batch, "h"), x], names=["doc_id", "h", "x"])

    bounded_batches(docs.sparkSession)
    texts = only(docs, doc_id="long", text="string").filter(F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), FOLDS) != HELD_OUT))
    rows = texts.select("doc_id", F.xxhash64("text").alias("h"), "text").mapInArrow(run, "doc_id long, h long, x array<double>")
    # Partial groups keep a hot id to a row a task.
    least = rows.groupBy("doc_id").agg(F.min(F.struct("h", "x")).alias("least"))
    return least.join(marked(labels, "quality", FOLDS, HELD_OUT), "doc_id").select("doc_id", "label", "least.x")


def summed(df: DataFrame, of: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray:
    """The sum of ``of(batch)`` over all batches: each task sends one vector. No rows give 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in given_back(batches):
            if batch.num_rows:
                total = of(batch) + (0.0 if total is None else total)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["total"])

    bounded_batches(df.sparkSession)
    return sum((np.frombuffer(r["total"], float) for r in df.mapInArrow(run, "total binary").collect()), np.zeros(1))


def _rows_of(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def pair_blocks(rows: DataFrame, have: dict[int, int]) -> DataFrame:
    """(block, good, poor): feature rows of both labels, end to end, whose pairs are learned from.

    The larger class is cut into blocks. The rows of the smaller one go round until every
    block has ``BLOCK`` of them, or all, so each is in as many blocks as the others, give or take one.
    """
    larger, smaller = (1, 0) if have[1] >= have[0] else (0, 1)
    blocks, slots = -(-have[larger] // BLOCK), min(BLOCK, have[smaller])
    first = dense_index(rows.filter(F.col("label") == larger), "doc_id", "n")
    first = first.select("label", "x", "n", F.expr(f"n div {BLOCK}").alias("block"))
    again = dense_index(rows.filter(F.col("label") == smaller), "doc_id", "n")
    again = again.select("label", "x", F.explode(F.sequence(F.col("n").cast("long"), F.lit(blocks * slots - 1).cast("long"), F.lit(have[smaller]).cast("long"))).alias("n"))
    again = again.select("label", "x", "n", F.expr(f"n div {slots}").alias("block"))

    def side(label: int) -> Column:
        ordered = F.sort_array(F.collect_list(F.when(F.col("label") == label, F.struct("n", "x"))))
        return F.flatten(F.transform(ordered, lambda row: row["x"]))

    return first.unionByName(again).groupBy("block").agg(side(1).alias("good"), side(0).alias("poor"))


def preference_weights(blocks: DataFrame, spread: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Bradley-Terry weights of scaled features by Newton's method over all pairs of all blocks."""
    width = len(spread)
    beta = np.zeros(width)
    for _ in range(50):

        def derivatives(batch: pa.RecordBatch, beta: np.ndarray = beta) -> np.ndarray:
            gradient, hessian, pairs = np.zeros(width), np.zeros((width, width)), 0
            for good, poor in zip(column_of(batch, "good"), column_of(batch, "poor")):
                # What all rows have in common drops out of the differences.
                g, p = (side.values.to_numpy(zero_copy_only=False).reshape(-1, width) / spread for side in (good, poor))
                chance = 1 / (1 + np.exp(-np.clip((g @ beta)[:, None] - p @ beta, -30, 30)))
                missed, bend = chance - 1, chance * (1 - chance)
                gradient += missed.sum(1) @ g - missed.sum(0) @ p
                across = g.T @ bend @ p
                hessian += (g * bend.sum(1)[:, None]).T @ g + (p * bend.sum(0)[:, None]).T @ p - across - across.T
                pairs += chance.size
            return np.concatenate([gradient, hessian.ravel(), [pairs]])

        total = summed(blocks, derivatives)
        gradient = total[:width] / total[-1] + ridge * beta
        hessian = total[width:-1].reshape(width, width) / total[-1] + ridge * np.eye(width)
        step = np.linalg.solve(hessian, gradient)
        beta = beta - step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def nth(values: DataFrame, n: int, name: str = "worth") -> float:
    """The value with ``n`` others before it in order, by counts in ever smaller ranges."""
    v = F.col(name)
    low, high = values.agg(F.min(v), F.max(v)).first()
    while low < high:
        place = F.least(F.floor((v - low) / F.lit(high - low) * RANGES), F.lit(RANGES - 1))
        counted = values.filter(v.between(low, high)).groupBy(place.alias("at")).agg(F.count(v).alias("rows"), F.min(v).alias("low"), F.max(v).alias("high"))
        for r in sorted(counted.collect(), key=lambda r: r["at"]):
            if n < r["rows"]:
                low, high = r["low"], r["high"]
                break
            n -= r["rows"]
    return low


def quantile(values: DataFrame, share: float, rows: int, name: str = "worth") -> float:
    """Exact, linear between the sorted values."""
    at = share * (rows - 1)
    n = int(at)
    low = nth(values, n, name)
    upto, above = values.agg(F.count_if(F.col(name) <= low), F.min(F.when(F.col(name) > low, F.col(name)))).first()
    high = low if above is None or upto > n + 1 else above
    return low + (at - n) * (high - low)


def fitted_slope(worths: DataFrame, cut: float, rows: int, ridge: float = 1e-6) -> float:
    """The logistic slope of the distance to the cut, by Newton's method over all rows."""
    slope, c = 0.0, F.col("worth") - cut
    for _ in range(50):
        bounded = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), c * slope))
        p = 1 / (1 + F.exp(-bounded))
        gradient, bend = worths.agg(F.sum((p - F.col("label")) * c), F.sum(p * (1 - p) * c * c)).first()
        step = (gradient / rows + ridge * slope) / (bend / rows + ridge)
        slope -= step
        if abs(step) < 1e-8:
            break
    return slope


def train(docs: DataFrame, labels: DataFrame) -> QualityModel:
    """Learn from every labelled row outside the held-out fold; with one class only, all rows get that class."""
    rows = stored(labelled_features(docs, labels))
    have = {0: 0, 1: 0} | {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    width, n = len(features(b"")), have[0] + have[1]
    if not have[0] or not have[1]:
        return QualityModel(np.zeros(width), np.ones(width), np.zeros(width), 0.0 if have[1] or not n else 1.0, 1.0)
    mean = summed(rows.select("x"), lambda batch: _rows_of(column_of(batch, "x"), width).sum(0)) / n
    spread = np.sqrt(summed(rows.select("x"), lambda batch: ((_rows_of(column_of(batch, "x"), width) - mean) ** 2).sum(0)) / n) + 1e-6
    model = QualityModel(mean, spread, preference_weights(stored(pair_blocks(rows, have)), spread), 0.0, 1.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given_back(batches):
            worth = pa.array(model.worth(_rows_of(column_of(batch, "x"), width)))
            yield pa.RecordBatch.from_arrays([column_of(batch, "label"), worth], names=["label", "worth"])

    worths = stored(rows.select("label", "x").mapInArrow(run, "label int, worth double"))
    model.cut = quantile(worths, have[0] / n, n)
    model.slope = max(1e-3, fitted_slope(worths, model.cut, n))
    return model


def scored(docs: DataFrame, model: QualityModel) -> DataFrame:
    """(doc_id, score) of every row, from its whole text.

    Null and empty texts have the score of a text without words. Repeated rows score alike.
    Other columns are not read. An empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given_back(batches):
            if batch.num_rows:
                x = np.array([features(text) for text in texts_of(batch)])
                score = pa.array(shared.value.score(x))
                yield pa.RecordBatch.from_arrays([column_of(batch, "doc_id"), score], names=["doc_id", "score"])

    bounded_batches(docs.sparkSession)
    return only(docs, doc_id="long", text="string").mapInArrow(run, "doc_id long, score double")


def accepted(docs: DataFrame, model: QualityModel, cut: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores ``cut`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given_back(batches):
            if batch.num_rows:
                x = np.array([features(text) for text in texts_of(batch)])
                yield batch.filter(pa.array(shared.value.score(x) >= cut))

    bounded_batches(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)
