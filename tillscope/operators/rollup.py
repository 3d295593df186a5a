"""Pre-aggregate sales before they meet the dimension."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillscope.functions import measures as m
from tillscope.operators.cleaning import known_category, known_name, unique_merchants


def key_column(df: DataFrame, key: str) -> Column:
    """A grouping key by name: calendar parts from the date, category with its default."""
    if key == "year":
        return m.year_of(df)
    if key == "month":
        return m.month_of(df)
    if key == "hour":
        return m.hour_of(df)
    if key == "category":
        return known_category().alias("category")
    return F.col(key)


def roll_up(sales: DataFrame, keys: Iterable[str], *, in_cents: bool = False) -> DataFrame:
    """Sales totals by ``keys``; partial sums are formed before the shuffle.

    A merchant holding a third of all sales therefore reaches its reducer as a handful of
    partial sums per map task, and the join that follows sees one row per group.
    """
    return sales.groupBy(*[key_column(sales, k) for k in keys]).agg(
        *m.totals(sales, in_cents=in_cents)
    )


def attach_merchants(totals: DataFrame, merchants: DataFrame) -> DataFrame:
    """Left-join merchants to pre-aggregated sales (which hold ``merchant_id``).

    No broadcast hint: both sides have about one row per merchant and group, and adaptive
    execution turns the join into a broadcast when the measured dimension is small.
    """
    return totals.join(unique_merchants(merchants), "merchant_id", "left").withColumn(
        "merchant_name", known_name()
    )


def merchant_totals(
    sales: DataFrame, merchants: DataFrame, keys: Iterable[str] = (), *, in_cents: bool = False
) -> DataFrame:
    """Sales totals by merchant and ``keys``, with name, city and state attached."""
    totals = roll_up(sales, ["merchant_id", *keys], in_cents=in_cents)
    return attach_merchants(totals, merchants)
