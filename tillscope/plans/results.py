"""The ten result tables.

Every function takes sales (single rows as cleaned, or totals; see
:mod:`tillscope.functions.measures`) and returns one table. Money stays a decimal when it
came in as one; ``measures.as_double`` publishes it.

Sales of unknown merchants have no city or state. They form a group of their own, which is
kept like any other.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillscope.functions import labels
from tillscope.functions import measures as m
from tillscope.operators.ranking import top_ranked

# Assumptions of the instalment analysis.
GROSS_MARGIN = "0.25"
DEFAULT_RATE = "0.229"
LOSS_SHARE = "0.5"

#: Grouping keys each result needs beside the merchant (None: no merchant needed at all).
MERCHANT_KEYS: dict[str, tuple[str, ...]] = {
    "top_merchants_by_month_city": ("year", "month"),
    "avg_sales_by_merchant_state": (),
    "popular_merchants_by_city": (),
    "city_category_sales": ("category",),
    "city_dominant_categories": ("category",),
    "recommendation_top_cities": (),
}
CALENDAR_KEYS: dict[str, tuple[str, ...]] = {
    "top_hours_by_category": ("category", "hour"),
    "recommendation_top_categories": ("category",),
    "monthly_sales_trends": ("year", "month"),
    "hourly_sales_patterns": ("hour",),
    "installment_profitability_analysis": ("installments",),
}


# --- task 1 ---------------------------------------------------------------------------


def top_merchants_by_month_city(sales: DataFrame, n: int = 5) -> DataFrame:
    """Best merchants of each city and month by money taken, then by number of sales."""
    monthly = sales.groupBy(m.year_of(sales), m.month_of(sales), "city_id", "merchant_name").agg(
        m.raw_total(sales).alias("purchase_total"), m.sales(sales).alias("no_of_sales")
    )
    # Few merchants tie in both figures, so one task per city and month is enough.
    best = top_ranked(
        monthly, ["year", "month", "city_id"], ["purchase_total", "no_of_sales"], n
    )
    # Sorted while year and month are still numbers, so months run in calendar order.
    return best.orderBy("year", "month", "city_id", "rank", "merchant_name").select(
        labels.month_name("year", "month").alias("month"),
        "city_id",
        "merchant_name",
        F.round(m.money(sales, "purchase_total"), 2).alias("purchase_total"),
        "no_of_sales",
    )


# --- task 2 ---------------------------------------------------------------------------


def merchant_state_averages(sales: DataFrame) -> DataFrame:
    """Mean sale per merchant and state, unsorted (what the report figures read)."""
    sums = sales.groupBy("merchant_name", "state_id").agg(
        m.total(sales).alias("total"), m.sales(sales).alias("n")
    )
    return sums.select(
        "merchant_name",
        "state_id",
        F.round(m.mean("total", "n", m.money_scale(sales)), 2).alias("average_amount"),
    )


def avg_sales_by_merchant_state(sales: DataFrame) -> DataFrame:
    """Mean sale per merchant and state, highest first."""
    return by_average(merchant_state_averages(sales))


def by_average(averages: DataFrame) -> DataFrame:
    return averages.orderBy(F.desc("average_amount"), "merchant_name", "state_id")


# --- task 3 ---------------------------------------------------------------------------


def category_peak_hours(sales: DataFrame, n: int = 3) -> DataFrame:
    """Best hours of each category by money taken; ``hour`` is a number here."""
    hourly = sales.groupBy("category", m.hour_of(sales)).agg(m.total(sales).alias("total_sales"))
    # At most 24 rows per category, so one task per category is enough.
    return top_ranked(hourly, ["category"], ["total_sales"], n)


def top_hours_by_category(sales: DataFrame, n: int = 3) -> DataFrame:
    """Best hours of each category, hour as text."""
    return (
        category_peak_hours(sales, n)
        .orderBy("category", "rank", "hour")
        .select("category", F.col("hour").cast("string").alias("hour"))
    )


# --- task 4 ---------------------------------------------------------------------------


def popular_merchants_by_city(sales: DataFrame, n: int = 10) -> DataFrame:
    """Merchants with the most sales in each city."""
    counts = sales.groupBy("merchant_name", "city_id").agg(m.sales(sales).alias("transaction_count"))
    return top_ranked(
        counts, ["city_id"], ["transaction_count"], n, spread=True
    ).select("merchant_name", "city_id", "transaction_count", "rank")


def city_category_sales(sales: DataFrame) -> DataFrame:
    """Number of sales and money taken per city and category."""
    return sales.groupBy("city_id", "category").agg(
        m.sales(sales).alias("transaction_count"), m.total(sales).alias("total_sales")
    )


def city_dominant_categories(sales: DataFrame) -> DataFrame:
    """Category with the most sales in each city; the last by name wins a tie."""
    leader = F.max(F.struct("transaction_count", "category"))
    return (
        sales.groupBy("city_id", "category")
        .agg(m.sales(sales).alias("transaction_count"))
        .groupBy("city_id")
        .agg(leader.alias("leader"))
        .select(
            "city_id",
            F.col("leader.category").alias("dominant_category"),
            F.col("leader.transaction_count").alias("category_transactions"),
        )
    )


# --- task 5 ---------------------------------------------------------------------------


def performance(sales: DataFrame, key: str) -> DataFrame:
    """Money taken, number of sales and mean sale per ``key``, unsorted."""
    sums = sales.groupBy(key).agg(
        m.total(sales).alias("total_sales"), m.sales(sales).alias("transaction_count")
    )
    return sums.withColumn(
        "avg_transaction_value", m.mean("total_sales", "transaction_count", m.money_scale(sales))
    )


def recommendation_top_cities(sales: DataFrame, n: int = 5) -> DataFrame:
    """Cities taking the most money (top-k report)."""
    return performance(sales, "city_id").orderBy(F.desc("total_sales"), "city_id").limit(n)


def recommendation_top_categories(sales: DataFrame, n: int = 5) -> DataFrame:
    """Categories taking the most money (top-k report)."""
    return performance(sales, "category").orderBy(F.desc("total_sales"), "category").limit(n)


def monthly_sales_trends(sales: DataFrame) -> DataFrame:
    """Money taken and number of sales per calendar month."""
    return (
        sales.groupBy(m.year_of(sales), m.month_of(sales))
        .agg(m.total(sales).alias("total_sales"), m.sales(sales).alias("transaction_count"))
        .orderBy("year", "month")
    )


def hourly_sales_patterns(sales: DataFrame) -> DataFrame:
    """Money taken and number of sales per hour of the day."""
    return (
        sales.groupBy(m.hour_of(sales))
        .agg(m.total(sales).alias("total_sales"), m.sales(sales).alias("transaction_count"))
        .orderBy("hour")
    )


def installment_profitability_analysis(sales: DataFrame, **assumptions: str) -> DataFrame:
    """Profit of each instalment plan; see :func:`profitability` for the assumptions."""
    return profitability(installment_sums(sales), **assumptions).orderBy("installments")


def installment_sums(sales: DataFrame) -> DataFrame:
    """Mean sale, number of sales and money taken per instalment plan, unsorted."""
    sums = sales.groupBy("installments").agg(
        m.sales(sales).alias("transaction_count"), m.total(sales).alias("total_sales")
    )
    return sums.withColumn(
        "avg_purchase_amount", m.mean("total_sales", "transaction_count", m.money_scale(sales))
    )


def profitability(
    sums: DataFrame,
    *,
    gross_margin: str = GROSS_MARGIN,
    default_rate: str = DEFAULT_RATE,
    loss_share: str = LOSS_SHARE,
) -> DataFrame:
    """Gross profit, expected default loss, net profit and margin of each plan in ``sums``.

    Only plans of more than one payment can default; a plan of unknown length, or of none,
    cannot. A plan whose sales sum to nothing has no margin.
    """
    kind = sums.schema["total_sales"].dataType
    if isinstance(kind, T.DecimalType):
        taken, number = F.col("total_sales").cast(T.DecimalType(24, kind.scale)), Decimal
    else:
        taken, number = F.col("total_sales"), float

    default_loss = F.when(
        F.col("installments") > 1, taken * F.lit(number(default_rate)) * F.lit(number(loss_share))
    ).otherwise(F.lit(number("0")))
    profits = sums.withColumns(
        {"gross_profit": taken * F.lit(number(gross_margin)), "expected_default_loss": default_loss}
    ).withColumn("net_profit", F.col("gross_profit") - F.col("expected_default_loss"))
    margin = F.try_divide(F.col("net_profit"), taken) * F.lit(100)

    cents = {
        c: F.round(c, 2).alias(c)
        for c in ("avg_purchase_amount", "gross_profit", "expected_default_loss", "net_profit")
    }
    return profits.select(
        "installments",
        cents.pop("avg_purchase_amount"),
        "transaction_count",
        *cents.values(),
        F.round(margin, 2).alias("profit_margin_pct"),
    )
