import os

import pytest
from playlens import session


class Elsewhere:
    """A session on a cluster without the shared folder set."""

    class conf:
        get = staticmethod(lambda key, default: default)

    class sparkContext:
        master = "yarn"


def test_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_root(Elsewhere)


def test_shared_folder_comes_from_the_session():
    class Cluster(Elsewhere):
        class conf:
            get = staticmethod(lambda key, default: "hdfs://shared/")

    assert session.shared_root(Cluster) == "hdfs://shared"


def test_pin_keeps_rows_schema_and_partitions(spark, capsys):
    df = spark.range(10).selectExpr("id", "cast(id % 2 as int) p", "timestamp_ntz '2024-01-01 00:00:00' t")
    pinned = session.pin(df, "x", partition_by=("p",))
    assert sorted(pinned.select("id", "p", "t").collect()) == sorted(df.collect())
    assert {f.name: f.dataType for f in pinned.schema} == {f.name: f.dataType for f in df.schema}
    pinned.filter("p = 1").explain()
    assert "(p#" in capsys.readouterr().out.split("PartitionFilters: [")[1].split("]")[0]


def test_settings_are_put_back(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with session.session_conf(spark, {"spark.sql.shuffle.partitions": "3", "playlens.x": "1"}):
        assert session.shuffle_partitions(spark) == 3
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert spark.conf.get("playlens.x", None) is None


def test_clear_scratch_removes_this_application_only(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(session, "shared_root", lambda spark: str(tmp_path))
    other = tmp_path / "playlens" / "other-application"
    other.mkdir(parents=True)
    session.pin(spark.range(3), "x")
    assert os.listdir(session.scratch_root(spark))
    session.clear_scratch(spark)
    assert not os.path.exists(session.scratch_root(spark)) and other.exists()
