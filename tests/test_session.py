import os

import pytest

from gustledger import session


def test_stage_and_drop(spark, tmp_path, monkeypatch, rows):
    monkeypatch.setattr(session, "_staged", [])
    monkeypatch.setattr(session, "staging_root", lambda _: str(tmp_path))
    df = session.stage(spark.range(5).selectExpr("id", "id * 2 as twice"), "numbers")
    assert rows(df) == [(i, 2 * i) for i in range(5)]
    assert len(os.listdir(tmp_path)) == 1
    assert session.drop_staged(spark) == 1 and os.listdir(tmp_path) == []


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    class Cluster:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master = "yarn"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.staging_root(Cluster)


def test_the_named_folder_is_used():
    class Named:
        class conf:
            get = staticmethod(lambda key, default=None: "hdfs:///shared/")

    assert session.staging_root(Named) == "hdfs:///shared"
