"""Sales and merchants read from an order star schema.

``lineitem`` with its ``orders`` gives the sales, ``customer`` with its ``nation`` the
merchants. Some names and categories are left out on purpose, and some sales name a merchant
that does not exist, so that every cleaning rule has work to do. All joins are outer ones: no
line and no customer is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillscope.functions import measures as m


# Columns read from each table. Declared, so that no job runs to find them out.
COLUMNS = {
    "lineitem": "l_orderkey bigint, l_linenumber int, l_extendedprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int",
    "nation": "n_nationkey int, n_regionkey int",
}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{folder}/{name}.parquet")


def _merchant_id(key: str) -> Column:
    return F.concat(F.lit("M"), F.col(key).cast("string"))


def _sold_by() -> Column:
    """Merchant of an order; some orders name one that no customer stands for."""
    unknown = F.concat(F.lit("X"), F.col("o_custkey").cast("string"))
    return F.when(F.col("o_custkey") % 17 == 3, unknown).otherwise(_merchant_id("o_custkey"))


def _order_columns() -> dict[str, Column]:
    """What a sale takes from its order."""
    # Orders carry dates only; the hour comes from the order number.
    hours = F.make_dt_interval(F.lit(0), (F.col("o_orderkey") % 24).cast("int"))
    return {
        "merchant_id": _sold_by(),
        "purchase_date": F.col("o_orderdate") + hours,
        "category": F.when(
            F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderpriority")
        ),
    }


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    """One row per sale."""
    lines = _table(spark, folder, "lineitem")
    orders = _table(spark, folder, "orders")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    order = _order_columns()
    return joined.select(
        order["merchant_id"].alias("merchant_id"),
        F.col("l_extendedprice").alias("purchase_amount"),
        order["purchase_date"].alias("purchase_date"),
        order["category"].alias("category"),
        F.col("l_linenumber").cast("int").alias("installments"),
    )


def order_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Sales totals per order, for analyses that do not look at instalments.

    Lines are summed by order before they meet ``orders``: a very long order arrives as
    partial sums, and on a cluster the sums are already partitioned for the join.
    """
    lines = _table(spark, folder, "lineitem")
    per_order = lines.groupBy("l_orderkey").agg(
        *m.totals(lines, in_cents=True, amount="l_extendedprice")
    )
    orders = _table(spark, folder, "orders")
    joined = per_order.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return joined.select(
        *[column.alias(name) for name, column in _order_columns().items()], m.CENTS, m.COUNT
    )


def merchants(spark: SparkSession, folder: str) -> DataFrame:
    customers = _table(spark, folder, "customer")
    nations = _table(spark, folder, "nation")
    return customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        _merchant_id("c_custkey").alias("merchant_id"),
        F.when(F.col("c_custkey") % 10 != 0, F.col("c_name")).alias("merchant_name"),
        F.col("c_nationkey").cast("int").alias("city_id"),
        F.col("n_regionkey").cast("int").alias("state_id"),
    )
