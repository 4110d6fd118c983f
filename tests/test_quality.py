from pyspark.sql import functions as F

from pacewatch.operators import quality as q
from pacewatch.schema import ACCOUNT_FEATURE_COLUMNS


def frame(spark):
    rows = [("a", 1, 0), ("a", 2, 1), (None, None, None), (None, -1, 3), ("b", 5, 0)]
    return spark.createDataFrame(rows, "id string, n int, flag int")


def test_each_rule_counts_its_failures_and_null_passes(spark):
    checks = [
        q.not_null("id"),
        q.unique("id"),
        q.accepted_values("flag", [0, 1]),
        q.expression_true("n", ">= 0"),
        q.not_null("flag"),
    ]
    got = {(r.check, r.column): r.failures for r in q.run_checks(frame(spark), checks).collect()}
    assert got == {
        ("not_null", "id"): 2,
        ("unique", "id"): 1,
        ("accepted_values", "flag"): 1,
        ("expression_true", "n"): 1,
        ("not_null", "flag"): 1,
    }
    for check in checks:
        assert check.failures(frame(spark)).count() == got[(check.name, check.column)]


def test_row_checks_share_one_pass(spark):
    text = q.run_checks(frame(spark), [q.not_null("id"), q.not_null("n")])
    assert text._jdf.queryExecution().executedPlan().toString().count("Scan ExistingRDD") == 1


def test_schema_contract(spark):
    empty = spark.range(0).select(*[F.lit(1).alias(c) for c in ACCOUNT_FEATURE_COLUMNS])
    assert q.check_schema(empty).count() == 0
    renamed = empty.withColumnRenamed("avg_amount_volatility", "avg_amount_volatility_24h")
    assert [r.missing_column for r in q.check_schema(renamed).collect()] == ["avg_amount_volatility"]


def test_column_coverage(spark):
    df = frame(spark)
    rows = df.collect()
    got = {r["column"]: (r.present, r.total, r.filled) for r in q.column_coverage(df, ["id", "n", "gone"]).collect()}
    want = {c: (True, len(rows), sum(r[c] is not None for r in rows)) for c in ("id", "n")}
    assert got == want | {"gone": (False, len(rows), 0)}
    assert [r.total for r in q.column_coverage(df.limit(0), ["id"]).collect()] == [0]


def test_freshness_and_key(spark):
    df = spark.sql("select timestamp'2024-01-01 00:00:00' _ingested_at union all select timestamp'2024-01-01 00:01:00'")
    row = q.freshness(df, now=F.lit("2024-01-01 00:03:00")).head()
    assert row.age_seconds == 120
    assert {r["id"] for r in q.primary_key(frame(spark), ["id"]).collect()} == {"a", None}
