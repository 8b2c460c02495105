"""Where intermediate tables go, and that they go away."""

from __future__ import annotations

from pathlib import Path

from landrecon import session


def test_stages_lie_in_the_shared_folder_and_can_be_dropped(spark, tmp_path, monkeypatch):
    assert "tempfile" not in Path(session.__file__).read_text()
    monkeypatch.setattr(session, "shared_dir", lambda spark: f"file://{tmp_path}/shared")
    df = session.stage(spark.range(5), "five")
    folder = Path(session.stages_dir(spark).removeprefix("file://"))
    assert folder.is_relative_to(tmp_path) and df.count() == 5 and list(folder.iterdir())
    session.drop_stages(spark)
    assert not folder.exists()


def test_the_warehouse_stands_in_where_no_checkpoint_folder_is_named(spark):
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    assert session.shared_dir(spark) == (named or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def test_a_machines_own_disk_is_refused_on_a_cluster(spark, monkeypatch):
    """Neither a named folder nor a shared warehouse: executors could not read each other's stages."""
    import pytest

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        def __init__(self, master):
            self.master = master

        def getConf(self):
            return Conf()

    class Session:
        _jvm, _jsc = spark._jvm, spark._jsc

        def __init__(self, master, warehouse):
            self.sparkContext = Context(master)
            self.conf = type("C", (), {"get": staticmethod(lambda key, default=None: default if key == "spark.checkpoint.dir" else warehouse)})()

    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://x"):
        with pytest.raises(ValueError, match="each machine's own"):
            session.shared_dir(Session(master, "file:/tmp/spark-warehouse"))
    assert session.shared_dir(Session("local[4]", "file:/tmp/spark-warehouse")) == "file:/tmp/spark-warehouse"


def test_derived_tables_follow_the_files(spark, tmp_path):
    from landrecon.catalogue.tables import Tables

    folder = f"file://{tmp_path}"
    spark.range(3).write.parquet(f"{folder}/orders.parquet")
    first = Tables.of(spark, folder)
    assert Tables.of(spark, folder) is first
    spark.range(4).write.mode("append").parquet(f"{folder}/orders.parquet")
    second = Tables.of(spark, folder)
    assert second is not first
    Tables._known.clear()
    assert Tables.of(spark, folder) is not second
