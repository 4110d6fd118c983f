"""The physical plans keep the shape they were designed for."""

import re


from pacewatch.operators import features, rolling, split
from pacewatch.operators.stage import stage
from pacewatch.plans import adapter


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def count(text, node):
    return len(re.findall(rf"^[\s:+\-|*()0-9]*{node}\b", text, re.M))


def staged_table(spark, sf_dir, tmp_path):
    path = str(tmp_path / "staged")
    stage(adapter.bronze(spark, sf_dir)).write.parquet(path)
    return spark.read.parquet(path)


def test_features_take_one_shuffle_one_sort_no_join(spark, sf_dir, tmp_path):
    text = plan(features.transaction_features(staged_table(spark, sf_dir, tmp_path)))
    assert count(text, "Exchange") == 1
    assert count(text, "Sort") == 1
    assert count(text, "Window") == 2
    assert "Join" not in text


def test_profiles_reuse_the_account_shuffle(spark, sf_dir, tmp_path):
    table = features.transaction_features(staged_table(spark, sf_dir, tmp_path))
    assert count(plan(features.account_features(table)), "Exchange") == 1


def test_dedupe_keeps_one_row_per_id_before_the_shuffle(spark, sf_dir):
    text = plan(stage(adapter.bronze(spark, sf_dir)))
    assert count(text, "WindowGroupLimit") == 2
    below = text[text.index("Exchange") :]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_velocity_reads_only_its_columns(spark, sf_dir, tmp_path):
    text = plan(features.velocity_features(staged_table(spark, sf_dir, tmp_path)))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert "V1" not in schema and "is_fraud" not in schema


def test_hot_accounts_are_found_from_one_column(spark, sf_dir, tmp_path):
    text = plan(rolling.hot_keys(staged_table(spark, sf_dir, tmp_path)))
    assert re.search(r"ReadSchema: struct<user_id:string>", text)
    assert count(text, "HashAggregate") == 2


def test_split_filter_prunes_columns_and_runs_nothing_early(spark, sf_dir, tmp_path):
    staged = staged_table(spark, sf_dir, tmp_path)
    train, _ = split.time_split(staged)
    text = plan(train.select("transaction_id"))
    assert "Subquery" in text
    assert "ReadSchema: struct<event_time:timestamp>" in text


def test_label_partitions_are_pruned(spark, sf_dir, tmp_path):
    from pacewatch.sources.tables import write_features

    path = str(tmp_path / "features")
    write_features(staged_table(spark, sf_dir, tmp_path), path)
    text = plan(split.positives(spark.read.parquet(path)))
    assert re.search(r"PartitionFilters: \[[^\]]*is_fraud", text)


def test_no_python_in_feature_and_scoring_plans(spark, sf_dir):
    from pacewatch.plans import queries

    for name in ("transaction_features", "rolling_paned", "score_rule", "account_buckets", "decode_events"):
        text = plan(queries.QUERIES[name](spark, sf_dir))
        assert "Python" not in text and "BatchEval" not in text, name


def test_paned_plan_pre_aggregates_before_its_shuffles(spark, sf_dir, tmp_path):
    from pacewatch.operators.panes import paned_rolling
    from pacewatch.schema import VELOCITY_FRAMES

    staged = staged_table(spark, sf_dir, tmp_path)
    text = plan(paned_rolling(staged, VELOCITY_FRAMES, "gap"))
    assert "partial_count" in text and "partial_max" in text
    assert not re.search(r"Window \[.*count.*\], \[user_id", text)
