"""The physical plans: what is read, shuffled and joined."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from salesight.operators.aggregate import group_kpis
from salesight.operators.benchmark import mean_of, with_benchmark
from salesight.plans import reports
from salesight.sources.staging import stage


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def table(spark, small_dir):
    return stage(entry.clean(spark, small_dir), "clean").frame


LAZY = ["kpi_totals", "region_overview", "q06", "q08", "dominant_value", "cleaning_report"]


@pytest.mark.parametrize("name", LAZY + ["q01", "q04", "q12"])
def test_no_cross_join_and_no_python(spark, small_dir, name):
    text = plan(entry.queries()[name](spark, small_dir))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython"):
        assert bad not in text


def test_benchmark_is_a_subquery(spark):
    df = with_benchmark(spark.range(10), {"m": mean_of("id")})
    text = plan(df)
    assert "Subquery" in text and "Join" not in text


def test_report_on_the_clean_table_reads_its_columns_only(table):
    text = plan(group_kpis(table, ["category"]))
    schema = re.search(r"ReadSchema: struct<([^>]*)", text).group(1)
    assert set(re.findall(r"(\w+):", schema)) == {"category", "quantity", "revenue", "profit"}


def test_filters_reach_the_scan(table):
    text = plan(table.where("order_year = 2006 AND category = 'PROMO'").select("revenue"))
    pushed = re.search(r"PushedFilters: \[([^\]]*)", text).group(1)
    assert "EqualTo(order_year,2006)" in pushed and "EqualTo(category,PROMO)" in pushed


def test_cleaning_filters_before_it_shuffles(spark, small_dir):
    """Range rules run on the scan of line items, below every exchange."""
    text = entry.clean(spark, small_dir)._jdf.queryExecution().optimizedPlan().toString()
    dedupe = text.index("Aggregate")
    assert "l_quantity" in text[dedupe:] and re.search(r"Filter .*l_quantity.* > 0", text[dedupe:])


def test_dedupe_does_not_shuffle_derived_columns(spark, small_dir):
    text = entry.clean(spark, small_dir)._jdf.queryExecution().optimizedPlan().toString()
    keys = re.search(r"Aggregate \[([^\]]*)\]", text).group(1)
    assert "order_year_month" not in keys and "profit_margin_pct" not in keys


def test_fact_join_is_not_broadcast(spark, small_dir):
    text = plan(entry.raw(spark, small_dir))
    fact = [line for line in text.splitlines() if "SortMergeJoin" in line]
    assert any("l_orderkey" in line and "o_orderkey" in line for line in fact)


def test_top_k_is_not_a_full_sort(table):
    from salesight.plans.overviews import top_products

    assert "TakeOrderedAndProject" in plan(top_products(table))


def test_ranks_read_slices(table):
    text = plan(reports.q01_category_ranking(table))
    assert "Window" in text and "slices-" in text


@pytest.mark.parametrize(
    "report,before",
    [(reports.q01_category_ranking, 10), (reports.q03_top_products, 15), (reports.q12_corrective_actions, 10)],
)
def test_reports_run_few_jobs_while_they_are_built(table, report, before):
    spark, group = table.sparkSession, f"build-{report.__name__}"
    spark.sparkContext.setJobGroup(group, group)
    report(table)
    spark.sparkContext.setJobGroup("other", "other")
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) < before


@pytest.mark.parametrize("name", ["cleaning_report", "duplicate_rows", "kpi_totals", "value_counts"])
def test_shuffles_grow_with_the_tables(spark, small_dir, monkeypatch, name):
    """A plan begins with a partition for so many bytes of input, so a task's share stays the same."""
    from salesight import session

    query, usual = entry.queries()[name], int(spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        monkeypatch.setattr(session, "INPUT_BYTES", 5_000)
        found = {int(n) for n in re.findall(r"hashpartitioning\(l_orderkey#\d+L?, (\d+)\)", plan(query(spark, small_dir)))}
        assert len(found) == 1 and min(found) > 30 > usual
    finally:
        monkeypatch.undo()
        small = plan(query(spark, small_dir))
    assert f", {usual})" in small and spark.conf.get(session.INITIAL, None) is None
