"""Exact top-k inner products by block-at-a-time pruning.

Candidates, in id order, are cut into blocks of consecutive rows; a block is a forward index
(one quantised vector per row) with the least and greatest value of every term. For a query
the greatest possible score in a block is the sum over its terms of weight times the maximum
(the minimum where the weight is negative). Blocks are visited in the order of their bounds,
and a query is done once the next bound falls below its k-th score.

Blocks lie in groups, one a task. A query first searches the group with its greatest bound;
the k-th score found there is its floor. It then goes only to those other groups whose bound
reaches the floor, and starts there with the floor as its k-th score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pacewatch.llm.common import column_of, settled

#: Rows of a block.
BLOCK = 256
#: Rows of a group of blocks, which one task searches for one chunk of queries.
GROUP = 8_192
#: Queries of a chunk.
CHUNK = 1_024
#: Groups whose extremes one task compares with one chunk of queries.
PACK = 1_024
#: Scores are exact in double arithmetic below this.
EXACT = float(1 << 53)


def quantised(vectors: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """(id, v): floor(scale * x) of each component; vectors with null or non-finite components go."""
    v = F.col(vector).cast("array<double>")
    # NaN and infinities fail the comparison, nulls make it unknown.
    fit = F.forall(v, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return vectors.filter(F.col(vector).isNotNull() & fit).select(
        F.col(key).cast("long").alias("id"), F.transform(v, lambda x: F.floor(x * float(scale)).cast("long")).alias("v")
    )


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of integers; shorter vectors are filled with zeros, which add nothing."""
    rows = column.to_numpy(zero_copy_only=False)
    out = np.zeros((len(rows), width), np.int64)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of rows: in doubles where that is exact, else in Python integers."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    largest = float(np.abs(a.astype(float)).max()) * float(np.abs(b.astype(float)).max()) * a.shape[1]
    if largest < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def bounds(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Greatest possible score of each query in each block, rounded up."""
    q = queries.astype(np.float64)
    best = np.maximum(q, 0) @ high.astype(np.float64).T + np.minimum(q, 0) @ low.astype(np.float64).T
    return best + np.abs(best) * 1e-9 + 1


def search(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int, block: int = BLOCK,
    floor: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, row id, score) of the k best rows of every query; the work is by blocks.

    Of rows that score below a query's ``floor`` some or all may be left out.
    """
    starts = np.arange(0, len(ids), block)
    low = np.minimum.reduceat(rows, starts, axis=0)
    high = np.maximum.reduceat(rows, starts, axis=0)
    top = bounds(queries, low, high)
    order = np.argsort(-top, axis=1, kind="stable")
    n = len(queries)
    none = np.iinfo(np.int64)
    best = np.full((n, k), none.min)
    who = np.full((n, k), none.max)
    full = np.zeros(n, np.int64)
    active = np.arange(n)
    least = np.full(n, -np.inf) if floor is None else floor.astype(np.float64)
    for step in range(len(starts)):
        at = order[active, step]
        # A row that ties with the k-th may have the smaller id, so equal bounds are searched.
        open_ = ((full[active] < k) | (top[active, at] >= best[active, k - 1])) & (top[active, at] >= least[active])
        active, at = active[open_], at[open_]
        if not len(active):
            break
        for b in np.unique(at):
            mine = active[at == b]
            a, z = starts[b], min(starts[b] + block, len(ids))
            score = products(queries[mine], rows[a:z])
            own = ids[None, a:z] == query_ids[mine, None]
            score = np.concatenate([best[mine], score], axis=1)
            name = np.concatenate([who[mine], np.broadcast_to(ids[a:z], own.shape)], axis=1)
            there = np.concatenate([np.arange(k) < full[mine, None], ~own], axis=1)
            # Best first: present before absent, then score, then the smaller id.
            rank = np.lexsort((name, -score.astype(np.float64), ~there), axis=1)[:, :k]
            if np.abs(score).max(initial=0) >= EXACT:
                rank = np.array([sorted(range(score.shape[1]), key=lambda j: (not there[i, j], -int(score[i, j]), name[i, j]))[:k] for i in range(len(mine))])
            best[mine] = np.take_along_axis(score, rank, 1)
            who[mine] = np.take_along_axis(name, rank, 1)
            full[mine] = np.take_along_axis(there, rank, 1).sum(1)
    have = np.arange(k) < full[:, None]
    return np.repeat(query_ids, k).reshape(n, k)[have], who[have], best[have]


def extremes(placed: DataFrame, width: int) -> DataFrame:
    """(group, low, high): least and greatest value of every component, a row or a few for each group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group = column_of(batch, "group").to_numpy(zero_copy_only=False)
            v = matrix(column_of(batch, "v"), width)
            names = np.unique(group)
            parts = [v[group == g] for g in names]
            kind = pa.list_(pa.int64())
            low, high = ([list(f(p, axis=0)) for p in parts] for f in (np.min, np.max))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(low, kind), pa.array(high, kind)], names=["group", "low", "high"])

    return placed.select("group", "v").mapInArrow(run, "group int, low array<long>, high array<long>")


def reached(asked: DataFrame, ends: DataFrame, width: int, packs: int, chunks: int) -> DataFrame:
    """(id, chunk, group, bound): the groups each query goes to.

    ``asked`` has (id, chunk, v, floor, done). Without a group that is done this is the one
    with the greatest bound of every pack; else all others whose bound reaches the floor.
    """
    none = F.lit(None)
    columns = ("pack", "chunk", "side", "id", "v", "high", "floor", "done")
    queries = asked.withColumns({"pack": F.explode(F.sequence(F.lit(0), F.lit(packs - 1))), "side": F.lit(0), "high": none.cast("array<long>")})
    groups = ends.select(
        F.expr(f"group div {PACK}").cast("int").alias("pack"), F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"), F.lit(1).alias("side"),
        F.col("group").cast("long").alias("id"), F.col("low").alias("v"), "high", none.cast("long").alias("floor"), none.cast("int").alias("done"),
    )

    def run(part: pa.Table) -> pa.Table:
        side = part.column("side").to_numpy()
        ids = part.column("id").to_numpy()
        q, g = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        g = g[np.argsort(ids[g], kind="stable")]
        names, starts = np.unique(ids[g], return_index=True)
        if not len(q) or not len(g):
            at, to, best = np.zeros(0, int), np.zeros(0, int), np.zeros((0, 0))
        else:
            v = part.column("v").combine_chunks()
            best = bounds(matrix(v.take(q), width), matrix(v.take(g), width), matrix(part.column("high").combine_chunks().take(g), width))
            best = np.maximum.reduceat(best, starts, axis=1)
            done = part.column("done").to_pandas().to_numpy(float)[q]
            floor = part.column("floor").to_pandas().fillna(-np.inf).to_numpy(float)[q]
            first = best.argmax(axis=1)[:, None] == np.arange(len(names))
            others = (best >= floor[:, None]) & (names[None, :] != done[:, None])
            at, to = np.nonzero(np.where(np.isnan(done)[:, None], first, others))
        chunk = part.column("chunk").to_numpy()[q]
        return pa.table({"id": ids[q][at], "chunk": pa.array(chunk[at], pa.int32()), "group": pa.array(names[to], pa.int32()), "bound": pa.array(best[at, to], pa.float64())})

    both = queries.select(*columns).unionByName(groups.select(*columns))
    return both.groupBy("pack", "chunk").applyInArrow(run, "id long, chunk int, group int, bound double")


def searched(pairs: DataFrame, asked: DataFrame, placed: DataFrame, width: int, k: int) -> DataFrame:
    """(query_id, vec_id, score): up to k best rows of each (id, chunk, group) in ``pairs``."""
    columns = ("group", "chunk", "side", "id", "v", "floor")
    sent = pairs.select("id", "group").join(asked, "id").withColumn("side", F.lit(0))
    wanted = placed.join(pairs.select("group", "chunk").distinct(), "group").withColumns({"side": F.lit(1), "floor": F.lit(None).cast("long")})

    def run(group: pa.Table) -> pa.Table:
        side = group.column("side").to_numpy()
        ids = group.column("id").to_numpy()
        v = matrix(group.column("v").combine_chunks(), width)
        floor = group.column("floor").to_pandas().fillna(-np.inf).to_numpy(float)
        q, c = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        c = c[np.argsort(ids[c], kind="stable")]
        parts = search(ids[q], v[q], ids[c], v[c], k, floor=floor[q]) if len(q) and len(c) else (np.zeros(0, np.int64),) * 3
        return pa.table(dict(zip(("query_id", "vec_id", "score"), map(pa.array, parts))))

    both = sent.select(*columns).unionByName(wanted.select(*columns))
    return both.groupBy("group", "chunk").applyInArrow(run, "query_id long, vec_id long, score long")


def top_k(vectors: DataFrame, k: int = 5, key: str = "vec_id", vector: str = "embedding", scale: int = 256, every: int = 50) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows of every query, ties to the smaller id.

    Queries are the rows whose id is divisible by ``every``, candidates all rows but those
    of the query's own id. Vectors that are null or hold a null or non-finite component,
    and rows without an id, take no part. Vectors of different lengths are compared over
    the shorter one. A repeated row is a candidate once for each time it stands there, but
    a query is answered once. Other columns are not read; an empty table gives no rows.

    Queries go in chunks to groups of rows: each first to the group of its greatest bound,
    then to those whose bound reaches the k-th score of the first. What leaves a task is k
    rows for each query. A task holds a chunk and a group, or a chunk and the extremes of a
    pack of groups.
    """
    spark = vectors.sparkSession
    rows = settled(quantised(vectors, key, vector, scale).filter("id is not null"))
    n, width = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    groups = max(1, -(-n // GROUP))
    # Ranges of ids: a group holds neighbours, and so do its blocks. The salt cuts ids that repeat.
    salted = rows.withColumn("salt", F.monotonically_increasing_id())
    ranged = salted.repartitionByRange(groups, "id", "salt").drop("salt").withColumn("group", F.spark_partition_id())
    chunks = max(1, -(-n // every // CHUNK))
    placed = settled(ranged)
    found = placed.agg(F.max("group")).first()[0] + 1
    packs = -(-found // PACK)
    none = F.lit(None)
    # Written once: of a repeated id every step must ask with the same vector.
    asked = settled(
        rows.filter(F.col("id") % every == 0).dropDuplicates(["id"]).select(
            "id", F.pmod(F.xxhash64("id"), F.lit(chunks)).cast("int").alias("chunk"), "v", none.cast("long").alias("floor"), none.cast("int").alias("done")
        )
    )
    ends = settled(extremes(placed, width))
    most = F.max_by("group", F.struct(F.col("bound"), -F.col("group")))
    first = settled(reached(asked, ends, width, packs, chunks).groupBy("id", "chunk").agg(most.alias("group")))
    near = settled(searched(first, asked, placed, width, k))
    if found > 1:
        floors = near.groupBy(F.col("query_id").alias("id")).agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("floor"))
        again = settled(asked.drop("floor", "done").join(first.select("id", F.col("group").alias("done")), "id").join(floors, "id", "left"))
        others = settled(reached(again, ends, width, packs, chunks))
        near = near.unionByName(searched(others, again, placed, width, k))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
