"""Figures and charts of the printed report, each as a DataFrame.

They read the small result tables of :mod:`tillscope.plans.results`, never single sales
(the profile excepted, which reads totals). Nothing is looped over on the driver.

An empty city counts as one city wherever cities are counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillscope.functions import labels
from tillscope.functions import measures as m
from tillscope.plans.results import by_average


def distinct_values(column: str) -> Column:
    """Aggregate: number of distinct values, the empty value counted as one."""
    return F.count_distinct(F.struct(column))


def dataset_profile(sales: DataFrame) -> DataFrame:
    """Number of sales, merchants, cities, states and categories."""
    keys = ("merchant_id", "city_id", "state_id", "category")
    # One row per combination first: the distinct counts then expand these, not the sales.
    combos = sales.groupBy(*keys).agg(m.sales(sales).alias("n"))
    return combos.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_records"),
        distinct_values("merchant_id").alias("unique_merchants"),
        distinct_values("city_id").alias("unique_cities"),
        distinct_values("state_id").alias("unique_states"),
        distinct_values("category").alias("unique_categories"),
    )


def task1_coverage(top_merchants: DataFrame) -> DataFrame:
    return top_merchants.agg(
        F.count(F.lit(1)).alias("result_rows"),
        distinct_values("month").alias("months"),
        distinct_values("city_id").alias("cities"),
    )


def task3_coverage(top_hours: DataFrame) -> DataFrame:
    return top_hours.agg(
        F.count(F.lit(1)).alias("result_rows"), distinct_values("category").alias("categories")
    )


def task4_coverage(popular: DataFrame, dominant: DataFrame) -> DataFrame:
    """Rows and cities of both parts of task 4, one row per part."""
    # Counting a figure that is never empty instead of bare rows makes both parts read the same
    # totals, so the sales are scanned and summed once for both.
    parts = {
        "popular_merchants_by_city": (popular, "transaction_count"),
        "city_dominant_categories": (dominant, "category_transactions"),
    }
    counted = [
        part.agg(F.count(figure).alias("result_rows"), distinct_values("city_id").alias("cities"))
        .select(F.lit(name).alias("part"), "result_rows", "cities")
        for name, (part, figure) in parts.items()
    ]
    return counted[0].unionByName(counted[1])


def avg_sale_summary(averages: DataFrame) -> DataFrame:
    """Number, lowest, highest and mean of the rounded merchant averages."""
    kind = averages.schema["average_amount"].dataType
    scale = kind.scale if isinstance(kind, T.DecimalType) else None
    return averages.agg(
        F.count(F.lit(1)).alias("combinations"),
        F.min("average_amount").alias("min_avg"),
        F.max("average_amount").alias("max_avg"),
        F.sum("average_amount").alias("sum_avg"),
    ).select(
        "combinations",
        "min_avg",
        "max_avg",
        F.round(m.mean("sum_avg", "combinations", scale), 2).alias("overall_avg"),
    )


def top_average_merchants(averages: DataFrame, n: int = 10) -> DataFrame:
    """Merchants with the highest mean sale (top-k report)."""
    return by_average(averages).limit(n)


def avg_sales_page(averages: DataFrame, skip: int = 10, rows: int = 20) -> DataFrame:
    """One page of the ranking by mean sale, ready to print."""
    page = by_average(averages).offset(skip).limit(rows)
    return page.select(
        labels.short_name("merchant_name").alias("merchant"),
        "state_id",
        labels.currency("average_amount", 2).alias("average"),
    )


def peak_hour_distribution(peak_hours: DataFrame) -> DataFrame:
    """How many categories peak at each hour, as a bar chart in numeric hour order."""
    counts = peak_hours.groupBy(F.col("hour").cast("int").alias("hour")).agg(
        F.count(F.lit(1)).alias("categories")
    )
    return counts.orderBy("hour").select(
        "hour", labels.hour_span("hour").alias("time_label"), "categories",
        labels.bar("categories").alias("bar"),
    )


def overall_popular_merchants(popular: DataFrame, n: int = 5) -> DataFrame:
    """City leaders with the most sales (top-k report)."""
    leaders = popular.where(F.col("rank") == 1)
    return leaders.orderBy(F.desc("transaction_count"), "merchant_name", "city_id").limit(n)


def city_podium(popular: DataFrame, n: int = 3) -> DataFrame:
    """The first ranks of each city."""
    return popular.where(F.col("rank") <= n)


def category_dominance(dominant: DataFrame) -> DataFrame:
    """How many cities each category leads."""
    return (
        dominant.groupBy("dominant_category")
        .agg(F.count(F.lit(1)).alias("cities"))
        .orderBy(F.desc("cities"), "dominant_category")
    )


def top_city_market_share(cities: DataFrame, n: int = 5) -> DataFrame:
    """Share of all money that the best ``n`` cities take, in percent.

    ``cities`` holds every city's ``total_sales``. The best few and the rest are told apart
    by tagging, so both sums come from one aggregate.
    """
    best = cities.orderBy(F.desc("total_sales"), "city_id").limit(n)
    tagged = best.select("total_sales", F.lit(True).alias("is_best")).unionByName(
        cities.select("total_sales", F.lit(False).alias("is_best"))
    )
    sums = tagged.agg(
        F.sum(F.when(F.col("is_best"), F.col("total_sales"))).alias("top_cities_sales"),
        F.sum(F.when(~F.col("is_best"), F.col("total_sales"))).alias("total_sales"),
    )
    share = F.try_divide(
        F.col("top_cities_sales").cast("double"), F.col("total_sales").cast("double")
    )
    return sums.withColumn("market_share_pct", share * 100)


def monthly_trend_direction(monthly: DataFrame, months: int = 12) -> DataFrame:
    """Last months with an arrow: up when sales rose, down when not, blank on the first."""
    last = monthly.orderBy(F.desc("year"), F.desc("month")).limit(months)
    before = F.lag("total_sales").over(W.orderBy("year", "month"))  # at most ``months`` rows
    arrow = (
        F.when(before.isNull(), F.lit(""))
        .when(F.col("total_sales") > before, F.lit("↑"))
        .otherwise(F.lit("↓"))
    )
    return (
        last.withColumn("trend", arrow)
        .orderBy("year", "month")
        .select(
            labels.year_month("year", "month").alias("year_month"),
            "total_sales",
            labels.currency("total_sales", 0).alias("sales_label"),
            "transaction_count",
            "trend",
        )
    )


def peak_business_hours(hourly: DataFrame, n: int = 10) -> DataFrame:
    """Hours taking the most money (top-k report)."""
    return hourly.orderBy(F.desc("total_sales"), "hour").limit(n)


def peak_hours_chart(hourly: DataFrame, n: int = 10, width: int = 30) -> DataFrame:
    """The best hours with a bar as long as their share of the best one."""
    best = peak_business_hours(hourly, n)
    sales = F.col("total_sales").cast("double")
    most = F.max(sales).over(W.partitionBy())  # at most ``n`` rows
    return (
        best.withColumn("bar_length", F.floor(F.try_divide(sales, most) * width).cast("int"))
        .orderBy(F.desc("total_sales"), "hour")
        .select(
            "hour",
            labels.hour_start("hour").alias("time_label"),
            "total_sales",
            labels.currency("total_sales", 0).alias("sales_label"),
            "transaction_count",
            "bar_length",
            labels.bar("bar_length").alias("bar"),
        )
    )


def best_installment_plan(profitability: DataFrame) -> DataFrame:
    """The plan with the highest net profit (top-k report)."""
    return (
        profitability.orderBy(F.desc("net_profit"), "installments")
        .limit(1)
        .select("installments", "net_profit", "profit_margin_pct")
    )
