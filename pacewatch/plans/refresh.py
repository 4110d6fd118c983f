"""The scheduled steps in order: stage, features, profiles, checks, then registration and sync."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pacewatch.operators.features import account_features, transaction_features
from pacewatch.operators.online import to_online_hashes
from pacewatch.operators.quality import (
    account_checks,
    bronze_checks,
    contract_report,
    run_checks,
    transaction_checks,
)
from pacewatch.operators.rolling import HOT_ROWS
from pacewatch.operators.stage import stage
from pacewatch.sources.published import new_version, point
from pacewatch.sources.tables import register_features, write_features


def run_refresh(
    spark: SparkSession,
    bronze: DataFrame,
    path: str,
    account_table: str,
    mode: str = "refresh",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Rebuild every table from raw events, publish them if they are clean, and return the report.

    Each run writes a folder of its own under ``path/versions``, so readers of an earlier
    version are not disturbed and a crash leaves that version whole. Unreadable messages (no
    id or no account) go to ``quarantine`` and into no table. Only if every check of the
    features and profiles passes and the profiles keep their contract are the profiles
    registered and the online rows written; the pointer of ``path`` then names the version
    (:mod:`pacewatch.sources.published`), and can be rolled back. The report comes back either
    way, with ``published``.
    """
    version = new_version(path)
    readable = F.col("transaction_id").isNotNull() & F.col("user_id").isNotNull()
    bronze.filter(~readable).write.parquet(f"{version}/quarantine")
    stage(bronze.filter(readable)).write.parquet(f"{version}/staged")
    staged = spark.read.parquet(f"{version}/staged")
    write_features(transaction_features(staged, hot_rows=hot_rows), f"{version}/transaction_features")
    features = spark.read.parquet(f"{version}/transaction_features")
    account_features(features).write.parquet(f"{version}/account_features")
    profiles = spark.read.parquet(f"{version}/account_features")
    reports = {
        "bronze": run_checks(bronze, bronze_checks()),
        "transaction_features": run_checks(features, transaction_checks()),
        "account_features": run_checks(profiles, account_checks()),
        "account_contract": contract_report(profiles),
    }
    combined = None
    for name, report in reports.items():
        named = report.select(F.lit(name).alias("table"), "*")
        combined = named if combined is None else combined.unionByName(named)
    combined.write.parquet(f"{version}/report")
    report = spark.read.parquet(f"{version}/report")
    # Raw events may be dirty, that is what the quarantine is for; what is published may not.
    clean = report.filter("table <> 'bronze' and failures > 0").isEmpty()
    if clean:
        published = register_features(profiles, account_table, ["user_id"], mode, f"{path}/registered")
        to_online_hashes(published).write.parquet(f"{version}/online_hashes")
        point(spark, path, version)
    return report.withColumn("published", F.lit(clean))
