from __future__ import annotations

import __spark_entry__ as entry
from salesight.operators.prepare import EXACT_SALES_TYPES, prepare_sales
from salesight.operators.quality import clean_sales
from salesight.plans import overviews, reports
from salesight.plans.clean_table import write_clean_table
from salesight.sources.star import sales_raw


def test_reports_on_the_written_table_equal_those_on_the_plan(spark, small_dir, tmp_path):
    table = write_clean_table(
        entry.raw(spark, small_dir), str(tmp_path / "clean"), EXACT_SALES_TYPES
    )
    direct = entry.clean(spark, small_dir)
    assert table.count() == direct.count()
    for report in (reports.q02_region_strength, reports.q08_monthly_growth, overviews.kpi_totals):
        assert report(table).collect() == report(direct).collect()


def test_folders_prune_and_are_few_files(spark, small_dir, tmp_path):
    path = tmp_path / "clean"
    table = write_clean_table(entry.raw(spark, small_dir), str(path), EXACT_SALES_TYPES)
    plan = table.where("order_year = 2006")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_year" in plan
    assert all(len(list(folder.glob("*.parquet"))) <= 4 for folder in path.glob("order_year=*"))


def test_double_money_gives_the_same_report(spark, small_dir):
    """Money typed as double, the default for text input, agrees to the cent."""
    double = clean_sales(prepare_sales(entry.raw(spark, small_dir)))
    assert dict(double.dtypes)["revenue"] == "double"
    found = reports.q09_region_category(double).collect()
    wanted = reports.q09_region_category(entry.clean(spark, small_dir)).collect()
    for a, b in zip(found, wanted, strict=True):
        assert (a.region, a.category, a.rank_in_region) == (b.region, b.category, b.rank_in_region)
        assert abs(a.total_profit - b.total_profit) < 0.011
        assert a.total_revenue == b.total_revenue


def test_table_without_planted_defects(spark):
    """The clean variant of FIXTURES.md."""
    raw = sales_raw(spark, "/root/testdata/sf0.01", defects=False)
    sales = clean_sales(prepare_sales(raw, EXACT_SALES_TYPES))
    assert (sales.count(), sales.where("unit_price < 550").count()) == (53_236, 736)
