from __future__ import annotations

import pytest

from salesight.sources import files, staging


def test_csv_round_trip_keeps_text_and_headers(spark, tmp_path):
    df = spark.createDataFrame([("007", 'a,"b"'), (None, "x")], ["Order ID", "Note"])
    files.write_table(df, str(tmp_path / "t"), fmt="csv")
    back = files.read_sales(spark, str(tmp_path / "t"))
    assert back.dtypes == [("Order ID", "string"), ("Note", "string")]
    assert {r["Order ID"] for r in back.collect()} == {"007", None}


def test_csv_inference_and_schema_are_options(spark, tmp_path):
    files.write_table(spark.range(3), str(tmp_path / "t"), fmt="csv")
    assert files.read_sales(spark, str(tmp_path / "t"), infer=True).dtypes == [("id", "int")]
    typed = files.read_sales(spark, str(tmp_path / "t"), schema="id bigint")
    assert typed.agg({"id": "sum"}).first()[0] == 3


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])
def test_other_formats(spark, tmp_path, fmt):
    files.write_table(spark.range(4), str(tmp_path / fmt), fmt=fmt)
    assert files.read_sales(spark, str(tmp_path / fmt), fmt).count() == 4


def test_several_paths_in_one_scan(spark, tmp_path):
    for name in "ab":
        files.write_table(spark.range(2), str(tmp_path / name))
    assert files.read_sales(spark, [str(tmp_path / n) for n in "ab"], "parquet").count() == 4


def test_partitioned_write_prunes(spark, tmp_path):
    df = spark.range(10).selectExpr("id", "id % 2 AS side")
    files.write_table(df, str(tmp_path / "t"), partition_by=["side"])
    one = spark.read.parquet(str(tmp_path / "t")).where("side = 1")
    assert one.count() == 5
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(side" in plan


def test_views_and_sql(spark):
    df = files.register(spark.range(6), "numbers_view")
    assert spark.sql("SELECT COUNT(*) FROM numbers_view").first()[0] == 6
    assert files.query(spark, "SELECT MAX(id) AS m FROM {t} WHERE id < :top", t=df, args={"top": 4}).first().m == 3
    assert files.row_count(df).first().row_count == 6


def test_staged_table(spark):
    staged = staging.stage(spark.range(9).selectExpr("id", "-id AS neg"))
    assert staged.frame.count() == 9 and staged.frame.columns == ["id", "neg"]
    assert staging.settle(staged).frame is staged.frame


def _folder(path):
    import os

    return os.path.exists(path.removeprefix("file:"))


def test_staged_tables_are_released(spark):
    staged = staging.stage(spark.range(3))
    assert _folder(staged.path)
    staging.release(spark, staged.path)
    assert not _folder(staged.path)


def test_staged_tables_go_with_the_session():
    """A process that stages and ends leaves no folder behind."""
    import subprocess
    import sys

    code = (
        "from salesight.session import session; from salesight.sources import staging; "
        "s = session(master='local[1]', **{'spark.ui.enabled': 'false'}); "
        "print('PATH', staging.stage(s.range(3)).path, staging.staging_root(s)); s.stop()"
    )
    said = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120).stdout
    _, path, root = next(line for line in said.split("\n") if line.startswith("PATH")).split()
    assert not _folder(path) and not _folder(root)


class _Session:
    """Only the settings of a session."""

    def __init__(self, **settings):
        self.conf = self
        self._settings = {"spark.app.id": "app-1", **settings}

    def get(self, key, default=None):
        return self._settings.get(key, default)


def test_staging_follows_the_checkpoint_setting():
    session = _Session(**{"spark.checkpoint.dir": "hdfs:///shared/ckpt/", "spark.master": "yarn"})
    assert staging.staging_root(session) == "hdfs:///shared/ckpt/salesight-app-1"


def test_local_session_without_the_setting_gets_its_own_folder():
    session = _Session(**{"spark.master": "local[2]", "spark.app.id": "app-2"})
    assert staging.staging_root(session) == staging.staging_root(session)


def test_no_machine_local_staging_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging.staging_root(_Session(**{"spark.master": "spark://host:7077"}))
    local = {"spark.master": "yarn", "spark.checkpoint.dir": "file:///tmp/ckpt"}
    with pytest.raises(RuntimeError, match="one machine"):
        staging.staging_root(_Session(**local))
    mounted = _Session(**local, **{staging.SHARED_FILES: "true"})
    assert staging.staging_root(mounted) == "file:///tmp/ckpt/salesight-app-1"


class _Elsewhere:
    """A session on a cluster with other settings."""

    def __init__(self, spark, **settings):
        self._spark, self.conf = spark, _Session(**settings)

    def __getattr__(self, name):
        return getattr(self._spark, name)


def test_a_mounted_folder_is_taken_on_a_cluster(spark, tmp_path):
    """What executors write to a ``file:`` folder is seen: it is shared, and nothing is left in it."""
    found = _Elsewhere(spark, **{"spark.master": "spark://host:7077", "spark.checkpoint.dir": f"file://{tmp_path}/"})
    assert staging.staging_root(found) == f"file://{tmp_path}/salesight-app-1"
    assert list(tmp_path.iterdir()) == []


def test_a_folder_that_loses_rows_is_refused_on_a_cluster(spark, tmp_path):
    settings = {"spark.master": "spark://host:7077", "spark.checkpoint.dir": f"file://{tmp_path}"}
    found = _Elsewhere(spark, **settings)
    found.range = lambda *args: spark.range(staging.PROBES - 1)  # one executor's file is missing
    with pytest.raises(RuntimeError, match="one machine"):
        staging.staging_root(found)


def test_executors_of_their_own_stage_in_the_warehouse_where_no_checkpoint_folder_is_set(spark, tmp_path):
    settings = {"spark.master": "local-cluster[2,1,1024]", "spark.sql.warehouse.dir": f"file://{tmp_path}"}
    found = _Elsewhere(spark, **settings)
    found.sparkContext = None  # which may have a checkpoint folder from another test
    assert staging.staging_root(found) == f"file://{tmp_path}/salesight-app-1"
