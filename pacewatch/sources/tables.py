"""Named tables and written feature tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pacewatch.operators.quality import primary_key
from pacewatch.sources.published import new_version


def read_feature_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def feature_table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def write_features(features: DataFrame, path: str, partition_by: str = "is_fraud") -> None:
    """Full rebuild of a feature table as files split by label.

    Rows stay in the tasks that computed them: the label has two values, so a shuffle on
    it would put nearly everything into one task.
    """
    features.write.mode("overwrite").partitionBy(partition_by).parquet(path)


def register_features(
    features: DataFrame, name: str, keys: Sequence[str] = ("user_id",), mode: str = "refresh", path: str | None = None
) -> DataFrame:
    """Save a feature table with a checked primary key and return it.

    ``create_only`` leaves an existing table alone; ``refresh`` replaces it. The rows go to a
    new folder under ``path`` (by default beside the warehouse's tables), which is never
    changed; the name is then moved to it by one change in the catalog, so readers see the
    old table or the new one, and a crash before leaves the old one. Only where the columns
    changed is the name dropped and made again; the folders stay.
    """
    if mode not in ("create_only", "refresh"):
        raise ValueError("mode is 'create_only' or 'refresh'")
    spark = features.sparkSession
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.rpartition('.')[0]}")
    exists = feature_table_exists(spark, name)
    if mode == "create_only" and exists:
        return read_feature_table(spark, name)
    broken = primary_key(features, keys).limit(1).collect()
    if broken:
        raise ValueError(f"{name}: primary key {list(keys)} is null or repeated: {broken[0].asDict()}")
    version = new_version(path or f"{spark.conf.get('spark.sql.warehouse.dir')}/{name}.published")
    features.write.parquet(version)
    columns = spark.read.parquet(version).schema
    if exists and spark.read.table(name).schema == columns:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{version}'")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.catalog.createTable(name, path=version, source="parquet")
    spark.catalog.refreshTable(name)
    return read_feature_table(spark, name)


def latest(df: DataFrame, time_col: str = "event_time", n: int = 10, tie_col: str = "transaction_id") -> DataFrame:
    """The newest ``n`` rows; each task keeps only its own ``n`` candidates."""
    return df.orderBy(F.col(time_col).desc(), F.col(tie_col)).limit(n)


def preview(df: DataFrame, n: int, order_cols: Sequence[str]) -> DataFrame:
    """First ``n`` rows in a stated order, so that two runs show the same."""
    return df.orderBy(*order_cols).limit(n)


def project(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols)


def feature_columns(df: DataFrame, key: str = "user_id") -> list[str]:
    return [c for c in df.columns if c != key]
