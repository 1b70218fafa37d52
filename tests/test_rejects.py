from __future__ import annotations

import pytest

from salesight.sources.rejects import FIELDS, file_headers, scan_with_rejects

TYPES = {"order_id": "bigint", "quantity": "int", "unit_price": "double"}


def write(folder, **files):
    folder.mkdir(exist_ok=True)
    for name, lines in files.items():
        (folder / f"{name}.csv").write_bytes("\n".join(lines).encode())
    return str(folder)


def found(scan, *cols):
    rows = sorted(map(tuple, scan.rows.select(*cols).collect()), key=str)
    return rows, sorted((r.line, r.reason) for r in scan.rejects.collect())


def test_every_line_is_a_row_a_reject_or_a_header(spark, tmp_path):
    path = write(
        tmp_path / "in",
        a=["Order ID,Product Name,Quantity", '1,"a, b",2', "2,c", "3,d,4,5", "4,e,many", "", "5,,", '6,"open,7', "7,e,8,<end>"],
    )
    rows, rejects = found(scan_with_rejects(spark, path, TYPES), "order_id", "product_name", "quantity")
    assert rows == [(1, "a, b", 2), (5, None, None)]
    assert rejects == [
        ("2,c", FIELDS), ("3,d,4,5", FIELDS), ("4,e,many", "quantity is not int"), ('6,"open,7', FIELDS),
        ("7,e,8,<end>", FIELDS),
    ]


def test_files_of_different_columns_meet_by_name(spark, tmp_path):
    path = write(
        tmp_path / "in",
        a=["Order ID,Quantity", "1,2"],
        b=["﻿quantity, ORDER  id ,Note", "3,4,x", "5,6"],
        c=["Order ID,Quantity", "7,8", "Order ID,Quantity", "9,10"],
        d=[""],
    )
    scan = scan_with_rejects(spark, path, TYPES)
    rows, rejects = found(scan, "order_id", "quantity", "note")
    assert rows == [(1, 2, None), (4, 3, "x"), (7, 8, None), (9, 10, None)]
    assert rejects == [("5,6", FIELDS)]
    assert scan.rejects.first().file.endswith("b.csv")
    assert dict(scan.rows.dtypes) == {"order_id": "bigint", "quantity": "int", "note": "string"}


def test_several_wrong_values_are_all_named(spark, tmp_path):
    path = write(tmp_path / "in", a=["order_id,quantity,unit_price", "x,1.5,y", "1,2.0,3"])
    rows, rejects = found(scan_with_rejects(spark, path, TYPES), "order_id", "quantity", "unit_price")
    assert rows == [(1, 2, 3.0)]
    assert rejects == [("x,1.5,y", "order_id is not bigint; unit_price is not double")]


def test_odd_names_and_separators(spark, tmp_path):
    path = write(tmp_path / "in", a=["a.b;line;file;_reason", "1;2;3;4", "1"])
    rows, rejects = found(scan_with_rejects(spark, path, {"a.b": "int"}, ";"), "`a.b`", "line", "_reason")
    assert rejects == [("1", FIELDS)] and rows == [(1, "2", "4")]


def test_headers_of_files_in_many_splits(spark, tmp_path):
    """A file that is read in several tasks has one header, its first line."""
    path = write(tmp_path / "in", a=["order_id,quantity", *[f"{i},{i}" for i in range(20_000)]])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        scan = scan_with_rejects(spark, path, TYPES)
        assert scan.rows.rdd.getNumPartitions() > 4
        assert (scan.rows.count(), scan.rejects.count()) == (20_000, 0)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_files_without_a_header_and_repeated_names(spark, tmp_path):
    with pytest.raises(ValueError, match="no file has a header"):
        scan_with_rejects(spark, write(tmp_path / "in", a=["", " "]), TYPES)
    with pytest.raises(ValueError, match="repeated names"):
        scan_with_rejects(spark, write(tmp_path / "two", a=["a,A", "1,2"]), TYPES)


def test_only_headers(spark, tmp_path):
    scan = scan_with_rejects(spark, write(tmp_path / "in", a=["order_id,quantity"]), TYPES)
    assert (scan.rows.count(), scan.rejects.count()) == (0, 0)


def test_first_lines_are_combined_before_the_shuffle(spark, tmp_path):
    from salesight.sources.rejects import _lines

    lines = _lines(spark, write(tmp_path / "in", a=["x", "1"]))
    plan = file_headers(lines)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and plan.count("Exchange") == 1
