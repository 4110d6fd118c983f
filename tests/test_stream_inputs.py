"""What is put before the streams."""

import glob

import pytest

from pacewatch.plans import queries


@pytest.mark.parametrize("name, portions, folder", [("live_features", 3, "bronze"), ("stream_metrics", 4, "topic"), ("state_features", 4, "bronze"), ("state_features_late", 4, "bronze")])
def test_files_before_a_stream_do_not_grow_with_the_table(spark, sf_dir, tmp_path, monkeypatch, name, portions, folder):
    monkeypatch.setattr(queries, "FILE_ROWS", 100)
    monkeypatch.setattr(queries, "scratch", lambda spark: str(tmp_path))
    got = queries.QUERIES[name](spark, sf_dir).collect()
    sizes = [spark.read.parquet(f).count() for f in glob.glob(f"{tmp_path}/{folder}/*.parquet")]
    assert len(sizes) > portions and max(sizes) <= 2 * 100 + 10
    monkeypatch.setattr(queries, "FILE_ROWS", 10**9)
    monkeypatch.setattr(queries, "scratch", lambda spark: str(tmp_path / "whole"))
    assert sorted(got) == sorted(queries.QUERIES[name](spark, sf_dir).collect())
