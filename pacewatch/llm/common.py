"""Small helpers that the operators share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pacewatch.session import use_checkpoints

#: A word is a run of anything but ASCII white space. ``bytes.split()`` cuts the same way.
WORD = r"[^\x20\x09-\x0D]+"

#: Upper bound on the bytes of one Arrow batch, so that very long texts do not pile up in a worker.
BATCH_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes as well as rows."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5000")


def settled(df: DataFrame) -> DataFrame:
    """Write the rows to the shared checkpoint folder and go on from there.

    Cuts lineage, and a lost executor later costs only a read. Spark removes the files with
    its own references if ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set.
    """
    use_checkpoints(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Write wide rows as a compressed table in the shared checkpoint folder and read them from there."""
    path = f"{use_checkpoints(df.sparkSession)}/llm-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def only(df: DataFrame, **columns: str) -> DataFrame:
    """Just the named columns, cast: columns of other names cannot clash with an operator's own."""
    return df.select(*(F.col(name).cast(kind).alias(name) for name, kind in columns.items()))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only; null counts as empty.

    ``lower`` does just that for pure ASCII and is much faster than ``translate`` there.
    """
    text = F.coalesce(text, F.lit(""))
    upper = "".join(map(chr, range(65, 91)))
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def given_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; what Arrow has freed goes back to the system between two of them."""
    for batch in batches:
        yield batch
        del batch
        pa.default_memory_pool().release_unused()


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """UTF-8 bytes of a text column, nulls as empty."""
    column = batch.column(batch.schema.get_field_index(name))
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def column_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def spans(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of equal values in a sorted array."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return starts, np.diff(np.r_[starts, len(keys)])


def whole_keys(batches: Iterator[pa.RecordBatch], key: str, rows: int = 200_000) -> Iterator[pa.Table]:
    """Regroup batches sorted by ``key`` so that no key is cut in two.

    Several keys share a table of about ``rows`` rows; a key that has more comes whole.
    """
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        n += batch.num_rows
        if n < rows:
            continue
        merged = pa.Table.from_batches(held).combine_chunks()
        keys = merged.column(key).to_numpy()
        cut = int(np.searchsorted(keys, keys[-1]))
        if cut:
            yield merged.slice(0, cut)
        held = merged.slice(cut).combine_chunks().to_batches()
        n = merged.num_rows - cut
        rows = max(rows, 2 * n)
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def marked(labels: DataFrame, label: str, folds: int, skip: int) -> DataFrame:
    """(doc_id, label), one row an id; fold ``skip`` and rows without an id or a label of 0 or 1 are left out."""
    return (
        only(labels, doc_id="long", **{label: "int"})
        .filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & (fold(F.col("doc_id"), folds) != skip))
        .groupBy("doc_id")
        .agg(F.max(label).alias("label"))
    )


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, folds: int, skip: int) -> DataFrame:
    """Texts with labels to learn from: (doc_id, text, label, weight), at most ``per_class`` rows of a label.

    ``weight`` is how many labelled ids of its class a drawn one stands for, so that weighted
    rows have the class shares of all of them. An id that repeats gives one row, that of the
    least text hash. Rows of fold ``skip`` and rows without an id or a label of 0 or 1 take no
    part. Ids are drawn by hash, so reruns agree. The drawn ids are broadcast: their number is bounded.
    """
    marks = marked(labels, label, folds, skip)
    have = {r["label"]: r["count"] for r in marks.groupBy("label").count().collect()}
    draw = F.xxhash64("doc_id", F.lit("labelled"))
    share = F.pmod(draw, F.lit(1 << 30)) / float(1 << 30)
    drawn = None
    for value in (0, 1):
        part = marks.filter((F.col("label") == value) & (share <= per_class / max(1, have.get(value, 0))))
        part = part.orderBy(draw, "doc_id").limit(per_class)
        stands_for = have.get(value, 0) / max(1, part.count()) if have.get(value, 0) > per_class else 1.0
        part = part.withColumn("weight", F.lit(float(stands_for)))
        drawn = part if drawn is None else drawn.unionByName(part)
    # One text for each id, the one with the least hash: partial groups keep a hot id to a row a task.
    texts = only(docs, doc_id="long", text="string").join(F.broadcast(drawn), "doc_id").groupBy("doc_id", "label", "weight")
    return texts.agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("least")).select("doc_id", "least.text", "label", "weight")


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, weights: np.ndarray | None = None) -> np.ndarray:
    """Coefficients of a logistic regression by Newton's method; ``x`` has its own constant column, if any."""
    beta = np.zeros(x.shape[1])
    w = np.ones(len(y)) if weights is None else weights
    scale = w.sum() or 1.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (w * (p - y)) / scale + ridge * beta
        hessian = (x * (w * p * (1 - p))[:, None]).T @ x / scale + ridge * np.eye(len(beta))
        step = np.linalg.solve(hessian, gradient)
        beta -= step
        if np.abs(step).max() < 1e-8:
            break
    return beta
