"""Toxic passages as maximum-scoring segments of token log-odds.

Token weights are log-odds between toxic and other texts under Dirichlet priors. A word too
rare to judge takes the weight of its longest prefix that is not. Words without evidence
weigh a fixed negative amount, so the expected weight of clean text is negative and the
maximal segments of a document (linear-time scan) are its passages with more bad words than
chance. The extreme-value law of the maximal segment turns its weight into a significance
that does not depend on the document's length, and a logistic curve into a score.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacewatch.llm.common import bounded_batches, column_of, given_back, labelled_sample, logistic, only, settled

#: Labelled rows of each class that are learned from, at most.
PER_CLASS = 6_000
FOLDS, HELD_OUT = 3, 1
#: Letters of the prefixes that stand in for rare words, longest first.
PREFIXES = (6, 5, 4)
#: Contexts that a word or prefix needs before it is judged by itself.
EVIDENCE = 4
#: Least z-value of a log-odds that counts.
SIGNIFICANT = 3.0
#: Least weight, after caution, that counts.
LEAST = 1.5
#: Weight of a token without significant log-odds.
NEUTRAL = -0.7
#: Dirichlet prior of either class: so many pseudo-occurrences of each unit, and so many
#: more for each occurrence in both classes together, which pulls common words to zero.
PRIOR, PRIOR_SHARE = 0.5, 0.02
#: Standard deviations taken off a log-odds, so that thin evidence weighs little.
CAUTION = 1.5
EULER = 0.5772156649015329
EDGE = ".,;:!?*#$%&|\"'()[]{}<>_-"
#: Distinct words whose weights a task keeps.
KEPT_WORDS = 400_000


def words_of(text: str) -> list[str]:
    return [w for w in (x.strip(EDGE) for x in text.lower().split()) if w]


def segments(weights: Iterable[tuple[int, float]], neutral: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments as (first, last, weight), in one pass.

    ``weights`` are (position, weight) of the tokens that weigh other than ``neutral``, in
    order; what lies between weighs ``neutral`` a token. Each candidate keeps the running
    total before and after it; a new one joins back to the last candidate that began lower,
    unless that one also ended at least as high.
    """
    found: list[list[float]] = []  # first, last, total before, total after
    total, at = 0.0, -1
    for position, weight in weights:
        total += neutral * (position - at - 1)
        at = position
        before, total = total, total + weight
        if weight <= 0:
            continue
        new = [position, position, before, total]
        while True:
            k = len(found) - 1
            while k >= 0 and found[k][2] >= new[2]:
                k -= 1
            if k < 0 or found[k][3] >= new[3]:
                found.append(new)
                break
            new = [found[k][0], new[1], found[k][2], new[3]]
            del found[k:]
    return [(int(a), int(b), after - before) for a, b, before, after in found]


@dataclass
class ToxicityModel:
    weights: dict[str, float]  # of whole words, and of prefixes marked "^"
    scale: float = 1.0  # lambda of the extreme-value law
    log_k: float = 0.0  # its ln K
    curve: tuple[float, float] = (-3.0, 0.0)  # intercept and slope over the significance
    kept: dict[str, float] = field(default_factory=dict, repr=False)

    def weight(self, word: str) -> float:
        known = self.kept.get(word)
        if known is None:
            if len(self.kept) > KEPT_WORDS:
                self.kept.clear()
            names = (word, *("^" + word[:n] for n in PREFIXES if len(word) >= n))
            known = self.kept[word] = next((self.weights[x] for x in names if x in self.weights), NEUTRAL)
        return known

    def scan(self, text: str) -> tuple[int, list[tuple[int, int, float]]]:
        """Number of words and the maximal segments."""
        words = words_of(text)
        kept, weight = self.kept, self.weight
        odd = [(i, x) for i, w in enumerate(words) if (x := kept[w] if w in kept else weight(w)) != NEUTRAL]
        return len(words), segments(odd, NEUTRAL)

    def significance(self, weights: list[float], words: int) -> float:
        """-ln of the chance that clean text of as many words has segments as heavy.

        By the extreme-value law for the sum of the r heaviest segments, at the best r.
        """
        space = self.log_k + math.log(max(1, words))
        best = total = 0.0
        for r, weight in enumerate(sorted(weights, reverse=True), 1):
            total += self.scale * weight - space
            if total <= 0:
                break
            bits = total - (r - 1) * math.log(total) + math.lgamma(r + 1) + math.lgamma(r)
            alone = total if total > 30 else -math.log(-math.expm1(-math.exp(-total)))
            best = max(best, min(total, bits) if r > 1 else alone)
        return best

    def measure(self, text: str) -> float:
        """Significance of the document's segments together; 0 where there is none."""
        n, found = self.scan(text)
        return self.significance([w for _, _, w in found], n)

    def score(self, text: str) -> float:
        a, b = self.curve
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, a + b * self.measure(text)))))

    def passages(self, text: str, chance: float = 0.01) -> list[tuple[int, int, float]]:
        """Every segment (first word, last word, weight) rarer than ``chance`` in clean text."""
        n, found = self.scan(text)
        return [x for x in found if self.significance([x[2]], n) > -math.log(chance)]


def _counts(sample: DataFrame) -> DataFrame:
    """(word, toxic, other): in how many different contexts a word stands, by class.

    Neighbours make the context, so that the copies of one passage count once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given_back(batches):
            rows: set[tuple[str, int, int]] = set()
            for text, label in zip(column_of(batch, "text").to_pylist(), column_of(batch, "label").to_pylist()):
                words = words_of(text or "")
                rows.update((w, hash_of(a, b), label) for a, w, b in zip(["", *words], words, [*words[1:], ""]))
            columns = list(zip(*rows)) or [(), (), ()]
            kinds = (pa.string(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["word", "context", "label"])

    bounded_batches(sample.sparkSession)
    contexts = sample.mapInArrow(run, "word string, context int, label int").distinct()
    return contexts.groupBy("word").agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("other"))


def hash_of(left: str, right: str) -> int:
    return zlib.crc32(f"{left} {right}".encode()) - (1 << 31)


def _weights(counts: DataFrame) -> dict[str, float]:
    """Weights of units with enough evidence, prefixes where they are significant.

    The units come from the bounded sample. Words that are common enough and not toxic get
    the neutral weight if they share a toxic prefix, so that it does not speak for them.
    """
    totals = counts.agg(F.sum("toxic"), F.sum("other")).first()
    if not totals[0] or not totals[1]:
        return {}
    prefixes = counts.select(
        F.explode(F.array(*(F.when(F.length("word") > n, F.concat(F.lit("^"), F.substring("word", 1, n))) for n in PREFIXES))).alias("word"),
        "toxic",
        "other",
    ).filter("word is not null")
    units = counts.unionByName(prefixes.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")))
    judged = units.filter(F.col("toxic") + F.col("other") >= EVIDENCE)
    alpha = PRIOR + PRIOR_SHARE * (F.col("toxic") + F.col("other"))

    def side(name: str, total: int):
        return F.log((F.col(name) + alpha) / float(total + PRIOR_SHARE * (totals[0] + totals[1]) + 1))

    delta = side("toxic", totals[0]) - side("other", totals[1])
    sigma = F.sqrt(1 / (F.col("toxic") + alpha) + 1 / (F.col("other") + alpha))
    weight = delta - CAUTION * sigma
    judged = settled(judged.select("word", weight.alias("weight"), ((delta >= SIGNIFICANT * sigma) & (weight >= LEAST)).alias("bad")))
    bad = {r["word"]: r["weight"] for r in judged.filter("bad").collect()}
    stems = [w[1:] for w in bad if w.startswith("^")]
    if stems:
        starts = F.col("word").substr(1, min(PREFIXES)).isin(sorted({s[: min(PREFIXES)] for s in stems}))
        calm = judged.filter(~F.col("bad") & ~F.col("word").startswith("^") & starts).select("word").collect()
        calm_prefix = judged.filter(~F.col("bad") & F.col("word").startswith("^")).filter(
            F.col("word").substr(2, min(PREFIXES)).isin(sorted({s[: min(PREFIXES)] for s in stems}))
        )
        return {r["word"]: NEUTRAL for r in [*calm, *calm_prefix.select("word").collect()]} | bad
    return bad


def _calibrated(model: ToxicityModel, rows: list[tuple[str, int, float]]) -> ToxicityModel:
    """Extreme-value law from the clean rows, then the curve; rows are others than the weights'.

    Rows are (text, label, weight). The law holds for clean rows alone, so only the curve
    needs the weights that undo the caps of the classes.
    """
    counts: dict[float, int] = {}
    peaks = []
    clean = 0
    for text, label, _ in rows:
        if label:
            continue
        words = words_of(text)
        clean += len(words)
        for w in words:
            x = model.weight(w)
            if x != NEUTRAL:
                counts[x] = counts.get(x, 0) + 1
        found = model.scan(text)[1]
        if words:
            peaks.append((max((w for _, _, w in found), default=0.0), len(words)))
    if not clean or not any(w > 0 for w in model.weights.values()):
        return model
    # Each positive weight is given half an occurrence, so the law exists without any.
    for x in {w for w in model.weights.values() if w > 0}:
        counts[x] = counts.get(x, 0) + 0.5
    values = np.array([*counts, NEUTRAL])
    chance = np.array([*counts.values(), max(1.0, clean - sum(counts.values()))], float)
    chance /= chance.sum()
    low, high = 1e-4, 20.0
    for _ in range(60):
        middle = (low + high) / 2
        if chance @ np.exp(np.minimum(middle * values, 600)) < 1:
            low = middle
        else:
            high = middle
    model.scale = low
    gumbel = [model.scale * peak - math.log(n) for peak, n in peaks if peak > 0]
    shares = len(gumbel) / len(peaks)
    # Where most clean texts have no segment at all, K is set by how many have one.
    total = sum(n for _, n in peaks)
    model.log_k = (sum(gumbel) / len(gumbel) - EULER) if shares > 0.5 else math.log(max(0.5, len(gumbel)) / total) + model.scale * _least(model)
    x = np.array([[1.0, model.measure(text)] for text, _, _ in rows])
    y = np.array([label for _, label, _ in rows], float)
    if 0 < y.sum() < len(y):
        model.curve = tuple(logistic(x, y, ridge=1e-4, weights=np.array([w for _, _, w in rows])))
    return model


def _least(model: ToxicityModel) -> float:
    return min((w for w in model.weights.values() if w > 0), default=0.0)


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> ToxicityModel:
    """Learn from a bounded sample of labelled rows outside the held-out fold.

    Four fifths of the sample give the token weights, the rest the calibration.
    """
    sample = settled(labelled_sample(docs, labels, "toxic", per_class, FOLDS, HELD_OUT))
    part = F.pmod(F.xxhash64("doc_id"), F.lit(5))
    model = ToxicityModel(_weights(settled(_counts(sample.filter(part != 0)))))
    shared = sample.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Only words that weigh, and how many there are: texts stay with the executors."""
        own = shared.value
        for batch in given_back(batches):
            texts = [_skeleton(own, x or "") for x in column_of(batch, "text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [column_of(batch, "doc_id"), pa.array(texts, pa.string()), column_of(batch, "label"), column_of(batch, "weight")],
                names=["doc_id", "text", "label", "weight"],
            )

    rows = sample.filter(part == 0).mapInArrow(run, "doc_id long, text string, label int, weight double").toPandas().sort_values(["doc_id", "text"])
    return _calibrated(model, list(zip(rows["text"], rows["label"], rows["weight"])))


def _skeleton(model: ToxicityModel, text: str) -> str:
    """The text with every word of neutral weight cut to one letter."""
    return " ".join([w if model.weight(w) != NEUTRAL else "x" for w in words_of(text)])


def scored(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc_id, score) of every row, from its whole text.

    Null and empty texts hold no segment and get the lowest score. Repeated rows score
    alike. Other columns are not read. An empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in given_back(batches):
            scores = [own.score(x or "") for x in column_of(batch, "text").to_pylist()]
            yield pa.RecordBatch.from_arrays([column_of(batch, "doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    bounded_batches(docs.sparkSession)
    return only(docs, doc_id="long", text="string").mapInArrow(run, "doc_id long, score double")


def toxic_passages(docs: DataFrame, model: ToxicityModel, chance: float = 0.01) -> DataFrame:
    """(doc_id, first_word, last_word, weight) of every significant passage."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in given_back(batches):
            pairs = zip(column_of(batch, "doc_id").to_pylist(), column_of(batch, "text").to_pylist())
            rows = [(key, *p) for key, text in pairs for p in own.passages(text or "", chance)]
            columns = list(zip(*rows)) or [(), (), (), ()]
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "first_word", "last_word", "weight"]
            )

    bounded_batches(docs.sparkSession)
    return only(docs, doc_id="long", text="string").mapInArrow(run, "doc_id long, first_word int, last_word int, weight double")

