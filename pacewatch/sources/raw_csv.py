"""The raw transaction CSV: typed scan and a dense row index in file order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pacewatch.schema import RAW_CSV_SCHEMA

# One row of about 200 bytes per input split; beyond this the index joins by shuffle.
MAX_BROADCAST_SPLITS = 50_000


def with_row_index(scan: DataFrame, name: str = "row_index") -> DataFrame:
    """Number the rows of a file scan from 0, by file name and position in the file.

    Ids that grow inside a scan task give the place within a split; a second, column-free
    pass counts the splits, and only those counts are ordered.
    """
    tagged = scan.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"),
    )
    splits = tagged.groupBy("_file", "_block").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first")
    )
    earlier = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select(
        F.col("_file"),
        F.col("_block"),
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
    )
    # No more splits than files plus tasks: a file is cut only at task borders.
    if len(scan.inputFiles()) + scan.rdd.getNumPartitions() <= MAX_BROADCAST_SPLITS:
        starts = F.broadcast(starts)
    return tagged.join(starts, ["_file", "_block"]).select(
        (F.col("_at") + F.col("_shift")).alias(name), *scan.columns
    )


def read_raw_csv(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Typed rows of the CSV with ``row_index``; ``limit`` keeps the first rows of the file."""
    scan = spark.read.schema(RAW_CSV_SCHEMA).option("header", True).csv(path)
    rows = with_row_index(scan)
    return rows if limit is None else rows.filter(F.col("row_index") < limit)
