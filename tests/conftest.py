from __future__ import annotations

import datetime
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from salesight.session import session  # noqa: E402

SMALL = "/root/testdata/sf0.001"
SALES_SCHEMA = (
    "order_id bigint, order_date_parsed date, order_year_month string, category string, "
    "sub_category string, product_name string, region string, state string, quantity int, "
    "unit_price double, revenue decimal(12,2), profit decimal(18,4)"
)


@pytest.fixture(scope="session")
def spark():
    made = session(
        "salesight-tests",
        master="local[4]",
        shuffle_partitions=4,
        **{"spark.ui.enabled": "false", "spark.driver.memory": "4g"},
    )
    made.sparkContext.setLogLevel("ERROR")
    yield made
    made.stop()


@pytest.fixture(scope="session")
def small_dir():
    return SMALL


@pytest.fixture(scope="session")
def sales(spark):
    """Build clean sales rows from partial dictionaries."""
    from decimal import Decimal

    names = [c.split()[0] for c in SALES_SCHEMA.split(", ")]

    def build(*rows):
        full = []
        for i, row in enumerate(rows):
            base = {
                "order_id": i,
                "order_date_parsed": datetime.date(2005, 1, 15),
                "order_year_month": "2005-01",
                "category": "C",
                "sub_category": "S",
                "product_name": f"p{i}",
                "region": "R",
                "state": "T",
                "quantity": 1,
                "unit_price": 10.0,
                "revenue": 10,
                "profit": 1,
                **row,
            }
            base["revenue"] = Decimal(str(base["revenue"]))
            base["profit"] = Decimal(str(base["profit"]))
            full.append(tuple(base[n] for n in names))
        return spark.createDataFrame(full, SALES_SCHEMA)

    return build
