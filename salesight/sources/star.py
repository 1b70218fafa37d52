"""A denormalised sales table derived from the star-schema test tables.

Nation, region, part and customer are broadcast only while their size is below
``spark.sql.autoBroadcastJoinThreshold`` and fall back to sort-merge joins, which
adaptive execution splits on hot keys, beyond it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fit_shuffles, input_bytes

# Header texts as a CSV export carries them.
RAW_HEADERS = {
    "order_id": "Order ID",
    "order_date": "Order Date",
    "category": "Category",
    "sub_category": "Sub Category",
    "product_name": "Product Name",
    "region": "Region",
    "state": "State",
    "quantity": "Quantity",
    "unit_price": "Unit Price",
    "revenue": "Revenue",
    "profit": "Profit",
}


#: The tables that grow.
LARGE = ("lineitem", "orders", "customer", "part")


def _path(folder: str, name: str) -> str:
    return f"{folder}/{name}.parquet"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(_path(folder, name))


def sales_bytes(spark: SparkSession, folder: str) -> int:
    """Bytes of the tables behind the sales that grow."""
    return input_bytes(spark, [_path(folder, name) for name in LARGE])


def _buyers(spark: SparkSession, folder: str) -> DataFrame:
    places = (
        _table(spark, folder, "nation")
        .join(_table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", F.col("n_name").alias("state"), F.col("r_name").alias("region"))
    )
    return (
        _table(spark, folder, "customer")
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", "state", "region")
    )


def _orders(spark: SparkSession, folder: str, defects: bool) -> DataFrame:
    """Order dates as text, formatted per order and not per line item."""
    # Ten years later, so that two-digit years fall in the same century everywhere.
    date = F.date_format(F.add_months(F.col("o_orderdate").cast("date"), 120), "MM-dd-yy")
    if defects:
        date = F.when(F.col("o_orderkey") % 97 == 0, "bad-date").otherwise(date)
    return (
        _table(spark, folder, "orders")
        .select("o_orderkey", "o_custkey", date.alias("order_date"))
        .join(_buyers(spark, folder), F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "order_date", "state", "region")
    )


def sales_raw(spark: SparkSession, folder: str, defects: bool = True) -> DataFrame:
    """One row per line item with raw headers; ``defects`` plants the dirty variant.

    Defects (see FIXTURES.md): copies of rows, unparseable dates, missing
    quantities, zero prices and zero revenue, chosen by key arithmetic so that
    every engine derives the same rows. The session's shuffles are fitted to the tables.
    """
    fit_shuffles(spark, [_path(folder, name) for name in LARGE])
    parts = _table(spark, folder, "part").select(
        "p_partkey",
        "p_type",
        "p_brand",
        "p_name",
        F.col("p_retailprice").cast("decimal(12,2)").alias("retail"),
    )
    # Items and orders both grow with the data: merge join, never a broadcast.
    items = (
        _table(spark, folder, "lineitem")
        .join(
            _orders(spark, folder, defects).hint("merge"),
            F.col("l_orderkey") == F.col("o_orderkey"),
        )
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
    )

    sold = F.col("l_quantity").cast("int")
    quantity = sold
    price = F.try_divide(F.col("l_extendedprice"), F.col("l_quantity"))
    revenue = F.col("l_extendedprice").cast("decimal(12,2)")
    kept = F.lit(1).cast("decimal(1,0)") - F.col("l_discount").cast("decimal(4,2)")
    cost = F.lit("0.5").cast("decimal(2,1)") * sold * F.col("retail")
    profit = (revenue * kept - cost).cast("decimal(18,4)")
    if defects:
        part = F.col("l_partkey")
        no_sale = F.col("l_orderkey") % 83 == 0
        quantity = F.when(part % 101 == 0, None).otherwise(sold)
        price = F.when(part % 89 == 0, 0.0).otherwise(price)
        revenue = F.when(no_sale, F.lit(0)).otherwise(revenue).cast("decimal(12,2)")
        profit = F.when(no_sale, F.lit(0)).otherwise(profit).cast("decimal(18,4)")

    sales = items.select(
        F.col("l_orderkey").alias("order_id"),
        "order_date",
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("sub_category"),
        F.col("p_name").alias("product_name"),
        "region",
        "state",
        quantity.alias("quantity"),
        price.alias("unit_price"),
        revenue.alias("revenue"),
        profit.alias("profit"),
    )
    if defects:
        copies = F.when(F.col("order_id") % 50 == 0, 2).otherwise(1)
        sales = sales.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).drop("_copy")
    return sales.withColumnsRenamed(RAW_HEADERS)
