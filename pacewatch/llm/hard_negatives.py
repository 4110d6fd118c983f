"""Hard negatives by a vertical scan of columns with shrinking candidate sets.

Rows are cut into groups that hold their vectors by column, with the least and greatest
value of every column. An anchor reads the columns in the order of its own descending
magnitudes. After each few columns every candidate has a partial score; what the columns
left can add lies between the sums of their least and greatest contributions. A candidate
whose bounds cannot reach what is asked leaves the bitmap, so later columns are read for
fewer rows, and what stays at the end has its exact score.

Two scans of the same kind: the first finds an anchor's best rows of its own label, the
second, for the window of scores that each of these opens, the best rows of other labels.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pacewatch.llm.common import settled
from pacewatch.llm.topk import matrix

#: Values (rows times columns) of a group, which one task searches for one chunk of anchors.
GROUP_VALUES = 1 << 18
#: Anchors of a chunk.
CHUNK = 1_024
#: Columns that are read between two looks at the bounds.
STEP = 8
#: Sums are taken in 64 bits below this, else in Python's integers.
EXACT = float(1 << 62)

Bitmap = Callable[[np.ndarray, np.ndarray], np.ndarray]


def vertical_scan(columns: np.ndarray, low: np.ndarray, high: np.ndarray, anchor: np.ndarray, rows: np.ndarray, shrink: Bitmap) -> tuple[np.ndarray, np.ndarray]:
    """(rows that stay, their exact scores).

    ``shrink(lower, upper)`` gets bounds of the scores of all rows still there and tells
    which stay. Columns are read in the order of the anchor's descending magnitudes.
    """
    order = np.argsort(-np.abs(anchor.astype(np.float64)), kind="stable")
    weight = anchor[order]
    ends = np.stack([weight * low[order], weight * high[order]])
    # What the columns from a place on can still add, at least and at most.
    least = np.concatenate([np.cumsum(ends.min(0)[::-1])[::-1], [0]])
    most = np.concatenate([np.cumsum(ends.max(0)[::-1])[::-1], [0]])
    score = np.zeros(len(rows), columns.dtype)
    for at in range(0, len(order) + STEP, STEP):
        here = min(at, len(order))
        stays = shrink(score + least[here], score + most[here])
        if not stays.all():
            rows, score = rows[stays], score[stays]
        if not len(rows) or here == len(order):
            break
        for place in range(here, min(here + STEP, len(order))):
            if weight[place]:
                score = score + weight[place] * columns[order[place]][rows]
    return rows, score


def best_of(k: int) -> Bitmap:
    """Keeps what can be among the ``k`` highest scores, ties included."""

    def shrink(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        if len(lower) <= k:
            return np.ones(len(lower), bool)
        return upper >= np.sort(lower)[-k] if lower.dtype == object else upper >= np.partition(lower, -k)[-k]

    return shrink


def best_within(windows: list[tuple[int, int]], k: int) -> Bitmap:
    """Keeps what can be among the ``k`` highest scores of any window (least, greatest), ends and ties included."""

    def shrink(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        stays = np.zeros(len(lower), bool)
        for least, greatest in windows:
            may = (upper >= least) & (lower <= greatest)
            sure = lower[(lower >= least) & (upper <= greatest)]
            if len(sure) > k:
                may &= upper >= (np.sort(sure)[-k] if sure.dtype == object else np.partition(sure, -k)[-k])
            stays |= may
        return stays

    return shrink


def window_of(positive: int, share: tuple[int, int]) -> tuple[int, int]:
    """Least and greatest whole score s with share[0] * positive <= 100 * s <= share[1] * positive."""
    return -(-share[0] * positive // 100), share[1] * positive // 100


class Columns:
    """One group: its vectors by column, with ids, labels and the ends of every column."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, anchors: np.ndarray):
        widest = float(np.abs(vectors.astype(float)).max(initial=0)) * float(np.abs(anchors.astype(float)).max(initial=0))
        kind = np.int64 if widest * max(1, vectors.shape[1]) < EXACT else object
        # In the order of ids: of equal scores the earlier row wins.
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels = ids[order], labels[order]
        self.columns = np.ascontiguousarray(vectors[order].T.astype(kind))
        self.low, self.high = self.columns.min(1), self.columns.max(1)
        self.kind = kind

    def positives(self, anchor_id: int, label: int, anchor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        rows = np.flatnonzero((self.labels == label) & (self.ids != anchor_id))
        rows, score = vertical_scan(self.columns, self.low, self.high, anchor.astype(self.kind), rows, best_of(k))
        first = np.argsort(-score, kind="stable")[:k]
        return self.ids[rows[first]], score[first]

    def negatives(self, anchor_id: int, label: int, anchor: np.ndarray, windows: list[tuple[int, int]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        rows = np.flatnonzero((self.labels != label) & (self.ids != anchor_id))
        rows, score = vertical_scan(self.columns, self.low, self.high, anchor.astype(self.kind), rows, best_within(windows, k))
        out = []
        for least, greatest in windows:
            inside = np.flatnonzero((score >= least) & (score <= greatest))
            first = inside[np.argsort(-score[inside], kind="stable")[:k]]
            out.append((self.ids[rows[first]], score[first]))
        return out


def prepared(vectors: DataFrame, key: str, label: str, vector: str, scale: int, moved: int, classes: int) -> DataFrame:
    """(id, label, v): rows that take part, with whole components; every ``moved``-th id has the next label."""
    v = F.col(vector).cast("array<double>")
    # NaN and infinities fail the comparison, nulls make it unknown.
    fit = F.forall(v, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    number, own = F.col(key).cast("long"), F.col(label).cast("long")
    there = number.isNotNull() & own.isNotNull() & F.col(vector).isNotNull() & fit
    return vectors.filter(there).select(
        number.alias("id"),
        F.when(number % moved == 0, (own + 1) % classes).otherwise(own).alias("label"),
        F.transform(v, lambda x: F.floor(x * float(scale)).cast("long")).alias("v"),
    )


def _met(rows: DataFrame, asked: DataFrame, groups: int, chunks: int) -> DataFrame:
    """Every chunk of anchors with every group of rows, as grouped rows."""
    sent = asked.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    held = rows.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    return sent.unionByName(held, allowMissingColumns=True).groupBy("group", "chunk")


def _opened(group: pa.Table, width: int) -> tuple[pa.Table, np.ndarray, Columns | None]:
    """The anchors of a cell, their vectors, and its rows by column."""
    asked, rows = group.filter(group.column("asked")), group.filter(pa.compute.invert(group.column("asked")))
    anchors = matrix(asked.column("v").combine_chunks(), width)
    if not rows.num_rows or not asked.num_rows:
        return asked, anchors, None
    vectors = matrix(rows.column("v").combine_chunks(), width)
    return asked, anchors, Columns(rows.column("id").to_numpy(), rows.column("label").to_numpy(), vectors, anchors)


def hard_negatives(
    vectors: DataFrame,
    key: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
    scale: int = 256,
    every: int = 100,
    moved: int = 7,
    classes: int = 10,
    positives: int = 5,
    negatives: int = 10,
    share: tuple[int, int] = (30, 90),
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose id is divisible by ``every``. Of an anchor's rows of its own
    label the ``positives`` with the highest inner products count; for each of them the
    ``negatives`` highest rows of other labels whose score lies within ``share`` per cent of
    the positive's, ends included. Ties go to the smaller id. A negative positive score has
    an empty window. Ids divisible by ``moved`` take the next label before.

    Rows without an id, with a null label or vector, or with a null or non-finite component
    take no part. Vectors of different lengths are compared over the shorter one. A repeated
    row is a candidate once for each time it stands there, but never for its own id; an
    anchor's id that repeats is asked once, by its least label and vector. Scores beyond 64
    bits are given as the end of that range. Other columns are not read. An empty table
    gives no rows.

    Each chunk of anchors meets each group of rows once in either scan: the stated query set
    against all rows, in blocks. A task holds one group and one chunk, and gives back at most
    ``negatives`` rows for each positive. Groups are dealt in turn, so no id or label makes one large.
    """
    spark = vectors.sparkSession
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    rows = settled(prepared(vectors, key, label, vector, scale, moved, classes))
    n, width = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    if not n:
        return spark.createDataFrame([], out)
    groups = max(1, -(-n * max(1, width) // GROUP_VALUES))
    placed = settled(rows.repartition(groups).withColumn("group", F.spark_partition_id() % groups).withColumn("asked", F.lit(False)))
    least = F.min(F.struct("label", "v")).alias("least")
    anchors = rows.filter(F.col("id") % every == 0).groupBy("id").agg(least).select("id", "least.*")
    chunks = max(1, -(-n // every // CHUNK))
    asked = anchors.withColumn("chunk", F.pmod(F.xxhash64("id"), F.lit(chunks)).cast("int")).withColumn("asked", F.lit(True))

    def find_positives(group: pa.Table) -> pa.Table:
        asked, vectors, held = _opened(group, width)
        found = [(i, *held.positives(i, own, q, positives)) for i, own, q in zip(*_asked(asked), vectors)] if held else []
        return _table(found, ("anchor_id", "positive_id", "positive_score"))

    near = _met(placed, asked, groups, chunks).applyInArrow(find_positives, "anchor_id long, positive_id long, positive_score long")
    best = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    kept = settled(near.withColumn("nth", F.row_number().over(best)).filter(F.col("nth") <= positives))
    # At most ``positives`` scores an anchor, in their order.
    scores = kept.groupBy(F.col("anchor_id").alias("id")).agg(F.sort_array(F.collect_list(F.struct("nth", "positive_score"))).alias("opened"))
    windows = asked.join(scores.select("id", F.col("opened.positive_score").alias("opened")), "id")

    def find_negatives(group: pa.Table) -> pa.Table:
        asked, vectors, held = _opened(group, width)
        found = []
        for i, own, q, opened in zip(*_asked(asked), vectors, asked.column("opened").to_pylist()) if held else ():
            windows = [window_of(p, share) for p in opened]
            for nth, (ids, scores) in enumerate(held.negatives(i, own, q, windows, negatives), 1):
                found.append(((i, nth), ids, scores))
        return _table(found, ("anchor_id", "nth", "negative_id", "negative_score"))

    hard = _met(placed, windows, groups, chunks).applyInArrow(find_negatives, "anchor_id long, nth long, negative_id long, negative_score long")
    first = Window.partitionBy("anchor_id", "nth").orderBy(F.desc("negative_score"), "negative_id")
    ranked = hard.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= negatives)
    return ranked.join(kept.withColumn("nth", F.col("nth").cast("long")), ["anchor_id", "nth"]).select(*(x.split()[0] for x in out.split(", ")))


def _longs(values: np.ndarray) -> np.ndarray:
    return (np.clip(values, -(1 << 63), (1 << 63) - 1) if values.dtype == object else values).astype(np.int64)


def _asked(asked: pa.Table) -> tuple[list, list]:
    return asked.column("id").to_pylist(), asked.column("label").to_pylist()


def _table(found: list, names: tuple[str, ...]) -> pa.Table:
    """Rows of (key or keys, ids, scores)."""
    keys = [np.atleast_2d(np.array(key, np.int64)).repeat(len(ids), 0) for key, ids, _ in found]
    width = len(names) - 2
    wide = np.concatenate([np.zeros((0, width), np.int64), *(k.reshape(-1, width) for k in keys)])
    columns = [*wide.T, *(np.concatenate([np.zeros(0, np.int64), *(_longs(f[j]) for f in found)]) for j in (1, 2))]
    return pa.table(dict(zip(names, map(pa.array, map(np.ascontiguousarray, columns)))))
