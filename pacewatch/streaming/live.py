"""Micro-batch upkeep of features, and scoring of a request stream.

Folders of the feature stream, all append-only, one subfolder per batch:

* ``<staged>/rows``: staged rows as they arrived, split by date,
* ``<staged>/ids``: id, arrival, account and date of each, the narrow index of the rows,
* ``<staged>/gone``: (id, batch) of rows that an earlier arrival took the place of,
* ``<features>``: the feature rows that each batch computed.

A batch reads the index, and of the rows only the dates it can change. Every folder of a
batch is overwritten by a retry of that batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pacewatch.operators.incremental import incremental_features
from pacewatch.operators.serving import audit_records, rejects, score
from pacewatch.operators.stage import arrival, dedupe_first, staged_columns
from pacewatch.schema import DECISION_THRESHOLD
from pacewatch.session import use_checkpoints
from pacewatch.streaming.bronze import trigger


def _path_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def _written(spark: SparkSession, path: str, schema: T.StructType, before: int) -> DataFrame:
    """What batches before this one wrote; the schema is given, so folders without files do no harm."""
    full = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    if not _path_exists(spark, path):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", path).parquet(path).filter(F.col("batch_id") < before)


def update_features(batch: DataFrame, batch_id: int, staged_path: str, features_path: str) -> None:
    """Stage one batch of raw events, then rewrite the feature rows it changes.

    The earliest arrival of an id wins, whatever the batch it comes in: a later one drops
    out, an earlier one takes the place of the row that is there, and the units of both are
    recomputed. Rows without id, time or account are rows like any other.
    """
    spark = batch.sparkSession
    use_checkpoints(spark)
    marked = batch.withColumn("_arrival", arrival(batch))
    first = dedupe_first(marked, "transaction_id", ["_arrival"], unique_order=True)
    come = staged_columns(first, "_arrival").checkpoint()
    index_fields = ["transaction_id", "_arrival", "user_id", "event_date"]
    index_schema = come.select(*index_fields).schema
    ids = _written(spark, f"{staged_path}/ids", index_schema, batch_id)
    # Only ids of this batch are grouped.
    named = ids.join(
        come.select(F.col("transaction_id").alias("_id")), F.col("transaction_id").eqNullSafe(F.col("_id")), "left_semi"
    )
    holder = F.min(F.struct("_arrival", "batch_id", "user_id", "event_date")).alias("_held")
    held = named.groupBy("transaction_id").agg(holder).withColumnRenamed("transaction_id", "_id")
    met = come.join(held, F.col("transaction_id").eqNullSafe(F.col("_id")), "left")
    taken = met.filter(F.col("_held").isNull() | (F.col("_arrival") < F.col("_held._arrival"))).checkpoint()
    fresh = taken.select(*come.columns)
    replaced = taken.filter("_held is not null")

    def put(df: DataFrame, name: str, *by: str) -> None:
        df.write.mode("overwrite").partitionBy(*by).parquet(f"{staged_path}/{name}/batch_id={batch_id}")

    gone_now = replaced.select("transaction_id", F.col("_held.batch_id").alias("_of"))
    put(gone_now, "gone")
    put(fresh.select(*index_fields), "ids")
    put(fresh.drop("_arrival"), "rows", "event_date")

    gone = _written(spark, f"{staged_path}/gone", gone_now.schema, batch_id + 1).select(
        F.col("transaction_id").alias("_gone"), "_of"
    )
    rows = _written(spark, f"{staged_path}/rows", fresh.drop("_arrival").schema, batch_id + 1)
    same = F.col("transaction_id").eqNullSafe(F.col("_gone")) & (F.col("batch_id") == F.col("_of"))
    staged = rows.join(gone, same, "left_anti").drop("batch_id")
    activity = _written(spark, f"{staged_path}/ids", index_schema, batch_id + 1).join(gone, same, "left_anti")
    withdrawn = replaced.select("_held.user_id", "_held.event_date")
    changed = incremental_features(staged, fresh, activity=activity, withdrawn=withdrawn)
    changed.write.mode("overwrite").parquet(f"{features_path}/batch_id={batch_id}")


def start_features(
    events: DataFrame,
    staged_path: str,
    features_path: str,
    checkpoint: str,
    mode: str = "continuous",
    interval: str = "1 minute",
) -> StreamingQuery:
    """Keep features current from a stream of decoded events, late ones included."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        update_features(batch, batch_id, staged_path, features_path)

    return (
        events.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger(mode, interval))
        .start()
    )


def current_features(spark: SparkSession, features_path: str) -> DataFrame:
    """The newest version of every feature row."""
    versions = spark.read.option("basePath", features_path).parquet(features_path)
    newest = F.row_number().over(Window.partitionBy("transaction_id").orderBy(F.col("batch_id").desc()))
    return versions.withColumn("_n", newest).filter("_n = 1").drop("_n", "batch_id")


def compact_features(spark: SparkSession, features_path: str, target: str) -> None:
    """Write the newest versions as one batch under ``target``, for readers that outlive many batches."""
    top = spark.read.option("basePath", features_path).parquet(features_path).agg(F.max("batch_id")).first()[0]
    current_features(spark, features_path).write.mode("overwrite").parquet(f"{target}/batch_id={top}")


def start_scoring(
    requests: DataFrame,
    hashes: Callable[[SparkSession], DataFrame],
    predict: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    threshold: float = DECISION_THRESHOLD,
    mode: str = "continuous",
    interval: str = "10 seconds",
    **options,
) -> StreamingQuery:
    """Score a stream of requests; every request leaves a decision with its record, or a reject.

    ``hashes`` opens the profiles and is called for every batch, so a refresh between two
    batches is seen and files it removed are not missed. Batches write to
    ``<path>/scored``, ``<path>/audit`` and ``<path>/rejects``; a retry overwrites its own.
    ``options`` go to :func:`score`.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        use_checkpoints(spark)
        scored = score(batch, hashes(spark), predict, threshold, **options).checkpoint()
        decided = scored.filter("decision is not null")
        for name, df in {
            "scored": decided,
            "audit": audit_records(decided, options.get("now")),
            "rejects": rejects(batch, scored),
        }.items():
            df.write.mode("overwrite").parquet(f"{path}/{name}/batch_id={batch_id}")

    return (
        requests.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger(mode, interval))
        .start()
    )
