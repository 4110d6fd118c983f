"""Views of the generic ``events`` and ``orders`` tables as payment transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pacewatch.functions.scalars import transaction_id
from pacewatch.schema import V_COLUMNS


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One transaction per event; errors are the positive label.

    The anonymous features are integer arithmetic on the event id and ``props.k``.
    """
    events = read_table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("long")
    return events.select(
        transaction_id("event_id").alias("transaction_id"),
        F.format_string("user_%05d", "user_id").alias("user_id"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.col("value").alias("amount"),
        (F.col("event_type") == "error").cast("int").alias("is_fraud"),
        F.lit(0).alias("_kafka_partition"),
        F.col("event_id").alias("_kafka_offset"),
        F.col("ts").cast("timestamp").alias("_ingested_at"),
        F.col("event_type"),
        *[
            (((F.col("event_id") * (2 * i + 1) + k * i) % 2001 - 1000) / F.lit(250.0)).alias(v)
            for i, v in enumerate(V_COLUMNS, 1)
        ],
    )


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions plus redeliveries: each purchase arrives again an hour later."""
    first = transactions(spark, sf_dir)
    again = first.filter("event_type = 'purchase'").withColumns(
        {
            "amount": F.col("amount") + 1,
            "_ingested_at": F.col("_ingested_at") + F.expr("interval 1 hour"),
        }
    )
    return first.unionByName(again).drop("event_type")


def order_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as transactions per customer; several fall into the same second."""
    return read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").cast("timestamp").alias("event_time"),
        F.unix_seconds(F.col("o_orderdate").cast("timestamp")).alias("event_time_unix"),
        F.col("o_totalprice").alias("amount"),
    )
