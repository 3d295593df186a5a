from datetime import datetime
from decimal import Decimal

import pytest
from tests.data import cleaned, rows, sale

from tillscope.plans import insights, results


@pytest.fixture(params=[False, True], ids=["double", "exact"])
def sales(request, spark):
    return cleaned(spark, exact=request.param)


def test_profile_counts_the_empty_city(sales):
    assert rows(insights.dataset_profile(sales)) == [(7, 5, 4, 4, 5)]


def test_profile_of_nothing(spark):
    assert rows(insights.dataset_profile(cleaned(spark, []))) == [(0, 0, 0, 0, 0)]


def test_coverages(sales):
    assert rows(insights.task1_coverage(results.top_merchants_by_month_city(sales))) == [(6, 2, 4)]
    assert rows(insights.task3_coverage(results.top_hours_by_category(sales))) == [(7, 5)]
    parts = insights.task4_coverage(
        results.popular_merchants_by_city(sales), results.city_dominant_categories(sales)
    )
    assert sorted(rows(parts)) == [
        ("city_dominant_categories", 4, 4),
        ("popular_merchants_by_city", 5, 4),
    ]


def test_average_figures(sales):
    averages = results.merchant_state_averages(sales)
    assert rows(insights.avg_sale_summary(averages)) == [(5, 15.0, 195.0, 84.0)]
    assert [r[0] for r in rows(insights.top_average_merchants(averages, 2))] == ["Cobalt Cycles", "Harbour Books"]
    assert rows(insights.avg_sales_page(averages, skip=1, rows=2)) == [
        ("Harbour Books", 2, "$100.00"),
        ("Olive Grove", 3, "$64.25"),
    ]


def test_summary_of_nothing(spark):
    averages = results.merchant_state_averages(cleaned(spark, []))
    assert rows(insights.avg_sale_summary(averages)) == [(0, None, None, None)]


def test_long_names_are_cut(spark):
    averages = spark.createDataFrame([("x" * 60, 1, 2.0)], "merchant_name string, state_id int, average_amount double")
    assert rows(insights.avg_sales_page(averages, skip=0)) == [("x" * 40, 1, "$2.00")]


def test_peak_hours_in_numeric_order(spark):
    peaks = spark.createDataFrame([("a", "9"), ("b", "10"), ("c", "9")], "category string, hour string")
    assert rows(insights.peak_hour_distribution(peaks)) == [
        (9, "09:00-09:59", 2, "██"),
        (10, "10:00-10:59", 1, "█"),
    ]


def test_city_figures(sales):
    popular = results.popular_merchants_by_city(sales)
    assert rows(insights.overall_popular_merchants(popular, 2)) == [
        ("Cobalt Cycles", 4, 2, 1),
        ("Harbour Books", 4, 2, 1),
    ]
    assert len(rows(insights.city_podium(popular, 1))) == 5
    dominance = insights.category_dominance(results.city_dominant_categories(sales))
    assert rows(dominance) == [
        ("Garden", 1), ("Sports", 1), ("Toys", 1), ("Unknown category", 1),
    ]


def test_market_share(sales):
    cities = results.performance(sales, "city_id")
    assert rows(insights.top_city_market_share(cities, 1)) == [(590.0, 715.0, 590 / 715 * 100)]
    assert rows(insights.top_city_market_share(cities))[0][2] == 100.0


def test_market_share_of_nothing(spark):
    cities = results.performance(cleaned(spark, []), "city_id")
    assert rows(insights.top_city_market_share(cities)) == [(None, None, None)]


def test_trend(spark):
    monthly = spark.createDataFrame(
        [(2022, 11, 1.0, 1), (2022, 12, 5.0, 1), (2023, 1, 5.0, 2), (2023, 2, 6.5, 3)],
        "year int, month int, total_sales double, transaction_count bigint",
    )
    assert rows(insights.monthly_trend_direction(monthly, months=3)) == [
        ("2022-12", 5.0, "$5", 1, ""),
        ("2023-01", 5.0, "$5", 2, "↓"),
        ("2023-02", 6.5, "$6", 3, "↑"),
    ]


def test_peak_chart(spark):
    hourly = spark.createDataFrame(
        [(h, float(h), 1) for h in range(24)], "hour int, total_sales double, transaction_count bigint"
    )
    chart = rows(insights.peak_hours_chart(hourly))
    assert [r[0] for r in chart] == list(range(23, 13, -1))
    assert chart[0][1:] == ("23:00", 23.0, "$23", 1, 30, "█" * 30)
    assert chart[-1][5] == int(14 / 23 * 30)


def test_best_plan(sales):
    profit = results.installment_profitability_analysis(sales)
    assert rows(insights.best_installment_plan(profit)) == [(1, 67.81, 25.0)]


def test_exact_money_stays_exact(spark):
    many = [sale(amount=0.1, when=datetime(2023, 1, 1, h % 24)) for h in range(30)]
    monthly = results.monthly_sales_trends(cleaned(spark, many, exact=True)).first()
    assert monthly["total_sales"] == Decimal("3.00")
