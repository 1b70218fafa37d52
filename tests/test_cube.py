from __future__ import annotations

import pytest

import __spark_entry__ as entry
from salesight.operators.aggregate import group_kpis
from salesight.operators.cube import build_cube, read_cube, write_cube
from salesight.plans import overviews, reports


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sales_are_scanned_once(spark, small_dir, tmp_path):
    path = str(tmp_path / "sales")
    entry.clean(spark, small_dir).write.parquet(path)
    plan = plan_of(build_cube(spark.read.parquet(path)))
    assert plan.count("FileScan parquet") == 1 and plan.count("Exchange") == 1
    assert plan.count("HashAggregate") == 2  # combined before the shuffle


def test_a_report_reads_one_level_only(spark, sales, tmp_path):
    cube = write_cube(sales({"category": "A"}, {"category": "B"}), str(tmp_path / "c"))
    plan = plan_of(cube.sums(["category"]))
    assert "(level" in plan.split("PartitionFilters: ")[1] and "= sub_category" in plan
    assert plan_of(cube.sums(["state", "region"])).count("Exchange") == 0


def test_overviews_take_a_cube(spark, small_dir, tmp_path):
    rows = entry.clean(spark, small_dir)
    cube = write_cube(rows, str(tmp_path / "c"))
    for view in (
        overviews.kpi_totals,
        overviews.monthly_overview,
        overviews.price_tier_overview,
        lambda s: overviews.dimension_overview(s, "region", with_quantity=True),
    ):
        assert view(cube).collect() == view(rows).collect()


def test_null_keys_are_groups_of_their_own(spark, sales, tmp_path):
    rows = sales({"region": None, "state": None}, {"region": None}, {"region": "R"})
    cube = write_cube(rows, str(tmp_path / "c"))
    for keys in (["region"], ["state", "region"], ["product_name", "category", "region"]):
        found, wanted = (
            sorted(map(str, group_kpis(source, keys).drop("profit_margin_pct").collect()))
            for source in (cube, rows)
        )
        assert found == wanted


def test_empty_table(spark, sales, tmp_path):
    rows = sales({}).limit(0)
    cube = write_cube(rows, str(tmp_path / "c"))
    assert overviews.kpi_totals(cube).collect() == overviews.kpi_totals(rows).collect()
    assert reports.q01_category_ranking(cube).count() == 0


def test_what_the_cube_lacks_is_an_error(spark, sales, tmp_path):
    cube = write_cube(sales({}), str(tmp_path / "c"))
    with pytest.raises(ValueError, match="price cuts"):
        reports.q06_price_tiers(cube, (1, 2))
    with pytest.raises(ValueError, match="no level"):
        cube.sums(["state", "category"])


def test_a_cube_is_opened_again(spark, sales, tmp_path):
    path = str(tmp_path / "c")
    written = write_cube(sales({"quantity": 3}), path)
    again = read_cube(spark, path)
    assert again.sums(["category"]).collect() == written.sums(["category"]).collect()
