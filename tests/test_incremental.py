from __future__ import annotations

import re
import uuid

import pytest

import __spark_entry__ as entry
from salesight.operators.prepare import EXACT_SALES_TYPES
from salesight.plans import incremental

HEADERS = (
    "order_id bigint, order_date string, category string, sub_category string, "
    "product_name string, region string, state string, quantity int, unit_price double, "
    "revenue decimal(12,2), profit decimal(18,4)"
)


@pytest.fixture
def table(spark):
    name = f"t_{uuid.uuid4().hex}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def row(i, **changed):
    base = {
        "order_id": i, "order_date": "01-15-05", "category": "C", "sub_category": "S",
        "product_name": "p", "region": "R", "state": "T", "quantity": 1, "unit_price": 2.0,
        "revenue": 2, "profit": 1, **changed,
    }
    return tuple(base[c.split()[0]] for c in HEADERS.split(", "))


def frame(spark, rows, extra=""):
    from decimal import Decimal

    money = [(*r[:9], Decimal(r[9]), Decimal(r[10]), *r[11:]) for r in rows]
    return spark.createDataFrame(money, HEADERS + extra)


def add(raw, table, path, buckets=3):
    return incremental.add_batch(raw, table, buckets, str(path), EXACT_SALES_TYPES)


def same(a, b):
    cols = sorted(b.columns)
    return sorted(map(repr, a.select(cols).collect())) == sorted(map(repr, b.select(cols).collect()))


def test_batches_make_the_table_of_a_full_run(spark, small_dir, table, tmp_path):
    rows = entry.raw(spark, small_dir)
    for k in range(3):  # each batch repeats a part of the one before
        kept = add(rows.where(f"`Order ID` % 3 = {k} OR `Order ID` % 3 = {k - 1}"), table, tmp_path / "t")
    assert same(kept, entry.clean(spark, small_dir))


def test_adding_a_batch_again_adds_nothing(spark, table, tmp_path):
    batch = frame(spark, [row(1), row(1), row(2), row(3, quantity=0)])
    assert add(batch, table, tmp_path / "t").count() == 2
    assert add(batch, table, tmp_path / "t").count() == 2


def test_rows_that_differ_anywhere_are_new(spark, table, tmp_path):
    add(frame(spark, [row(1)]), table, tmp_path / "t")
    others = [row(1, profit=2), row(1, order_date="01-16-05"), row(1, order_date="01-15-06"), row(1)]
    assert add(frame(spark, others), table, tmp_path / "t").count() == 4


def test_hash_collisions_are_compared(spark):
    """Rows of one hash that differ are kept, NULL being equal to NULL."""
    cols = "order_id bigint, note string, row_hash bigint"
    new = spark.createDataFrame([(1, None, 7), (1, "a", 7), (2, None, 7), (3, "z", 7)], cols)
    old = spark.createDataFrame([(1, None, 7), (3, "z", 7)], cols)
    found = incremental._unseen(new, old, ["order_id", "note"])
    assert {(r.order_id, r.note) for r in found.collect()} == {(1, "a"), (2, None)}


def test_columns_beside_the_known_ones_and_a_given_margin_count(spark, table, tmp_path):
    extra = ", profit_margin_pct double, `a.b` string"
    rows = [(*row(1), 10.0, None), (*row(1), 20.0, None), (*row(1), 20.0, "x")]
    kept = add(frame(spark, rows[:1], extra), table, tmp_path / "t")
    kept = add(frame(spark, rows, extra), table, tmp_path / "t")
    found = {(r.profit_margin_pct, r.given_margin_pct, r["a.b"]) for r in kept.collect()}
    assert kept.count() == 3
    assert found == {(50.0, 10.0, None), (50.0, 20.0, None), (50.0, 20.0, "x")}


def test_empty_batches(spark, table, tmp_path):
    empty = frame(spark, [row(1)]).limit(0)
    assert add(empty, table, tmp_path / "t").count() == 0
    assert add(frame(spark, [row(1)]), table, tmp_path / "t").count() == 1
    assert add(empty, table, tmp_path / "t").count() == 1


def test_history_is_not_shuffled_and_other_years_are_not_read(spark, table, tmp_path):
    add(frame(spark, [row(i, order_date=f"01-15-0{i % 5}") for i in range(50)]), table, tmp_path / "t")
    stored = spark.table(table)
    batch = stored.where("order_year = 2003").drop("order_year", "order_month", "order_year_month", "profit_margin_pct")
    batch = spark.createDataFrame(batch.collect(), batch.schema)
    plan = incremental.new_rows(batch, stored, 3)._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "order_year" in plan.split("PartitionFilters: ")[1]
    left, right = re.split(r"FileScan parquet", plan, maxsplit=1)
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1  # the batch's own
    assert "Exchange" not in right and "SortMergeJoin" in left


def test_a_batch_moves_year_by_year(spark, table, tmp_path, monkeypatch):
    moved, new_rows = [], incremental.new_rows

    def seen(batch, history, buckets):
        years = {r.order_date_parsed.year for r in batch.collect()}
        moved.append((years, spark.conf.get(incremental.SHUFFLE_CLEANUP, None)))
        return new_rows(batch, history, buckets)

    monkeypatch.setattr(incremental, "new_rows", seen)
    before = spark.conf.get(incremental.SHUFFLE_CLEANUP, None)
    rows = [row(i, order_date=f"01-15-0{i % 5}") for i in range(20)]
    assert add(frame(spark, rows[:7]), table, tmp_path / "t").count() == 7
    assert [years for years, _ in moved] == [{y} for y in range(2000, 2005)]
    assert add(frame(spark, rows + rows[:3]), table, tmp_path / "t").count() == 20
    assert [years for years, _ in moved[5:]] == [{y} for y in range(2000, 2005)]
    assert spark.conf.get(incremental.SHUFFLE_CLEANUP, None) == before


def test_buckets_of_the_query_follow_the_input(spark, small_dir, monkeypatch):
    given = []
    monkeypatch.setattr(incremental, "add_batch", lambda raw, table, buckets, *rest: given.append(buckets) or 1 / 0)
    for size in (None, 100 * entry.BATCH_BYTES + 1):
        if size:
            monkeypatch.setattr(entry.star, "sales_bytes", lambda *_: size)
        with pytest.raises(ZeroDivisionError):
            entry.queries()["clean_in_batches"](spark, small_dir)
    assert given == [entry.BATCH_BUCKETS, 101]


def test_another_bucket_number_is_refused(spark, table, tmp_path):
    add(frame(spark, [row(1)]), table, tmp_path / "t")
    with pytest.raises(Exception, match="(?i)bucket"):
        add(frame(spark, [row(2)]), table, tmp_path / "t", buckets=5)
