from seisflow.session import checkpoint_dir, scratch_path


def test_scratch_paths_stay_under_the_checkpoint_folder(spark):
    base = checkpoint_dir(spark)
    p = scratch_path(spark, "x")
    assert p.startswith(base.rstrip("/") + "/seisflow-x-")
    assert scratch_path(spark, "x") != p


def test_uri_folders_are_not_made_relative(spark, monkeypatch):
    import seisflow.session as S
    for uri in ["file:/tmp/ck", "hdfs://nn:8020/ck", "s3a://bucket/ck"]:
        monkeypatch.setattr(S, "checkpoint_dir", lambda _s, u=uri: u)
        assert S.scratch_path(spark, "t").startswith(uri + "/seisflow-t-")


def test_relative_folders_are_refused_and_scratch_is_deleted(spark, monkeypatch):
    import os

    import pytest

    import seisflow.session as S
    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    S.drop_scratch(spark, path)
    assert not os.path.exists(path.removeprefix("file:"))
    with pytest.raises(ValueError):
        S.drop_scratch(spark, "/tmp/other")
    monkeypatch.setattr(S, "checkpoint_dir", lambda _s: "some/folder")
    with pytest.raises(ValueError):
        S.scratch_path(spark, "t")
