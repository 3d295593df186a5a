"""The ten result tables on hand-made rows, with values worked out by hand."""

from datetime import datetime

import pytest
from tests.data import MERCHANTS, SALES, cleaned, merchants, row_set, rows, sale, transactions

from tillscope.functions.measures import as_double
from tillscope.operators.rollup import merchant_totals, roll_up
from tillscope.plans import results


@pytest.fixture(params=["double rows", "exact rows", "totals", "exact totals"])
def make(request, spark):
    """Cleaned sales in each of the forms the analyses accept."""

    def build(sales=SALES, dimension=MERCHANTS):
        if request.param.endswith("rows"):
            return cleaned(spark, sales, dimension, exact=request.param == "exact rows")
        return merchant_totals(
            transactions(spark, sales),
            merchants(spark, dimension),
            ("year", "month", "hour", "category", "installments"),
            in_cents=request.param == "exact totals",
        )

    return build


def test_top_merchants(make):
    assert rows(as_double(results.top_merchants_by_month_city(make()))) == [
        ("Mar 2021", None, "K99", 15.0, 1),
        ("Mar 2021", 4, "Cobalt Cycles", 300.0, 1),
        ("Mar 2021", 4, "Harbour Books", 200.0, 2),
        ("Apr 2021", 4, "Cobalt Cycles", 90.0, 1),
        ("Apr 2021", 7, "Olive Grove", 64.25, 1),
        ("Apr 2021", 9, "K58", 45.75, 1),
    ]


def test_average_sales(make):
    assert rows(results.avg_sales_by_merchant_state(make())) == [
        ("Cobalt Cycles", 2, 195.0),
        ("Harbour Books", 2, 100.0),
        ("Olive Grove", 3, 64.25),
        ("K58", 5, 45.75),
        ("K99", None, 15.0),
    ]


def test_top_hours(make):
    assert rows(results.top_hours_by_category(make())) == [
        ("Books", "9"),
        ("Books", "17"),
        ("Garden", "20"),
        ("Sports", "17"),
        ("Sports", "12"),
        ("Toys", "9"),
        ("Unknown category", "12"),
    ]


def test_popular_merchants(make):
    assert row_set(results.popular_merchants_by_city(make())) == [
        ("Cobalt Cycles", 4, 2, 1),
        ("Harbour Books", 4, 2, 1),
        ("K58", 9, 1, 1),
        ("K99", None, 1, 1),
        ("Olive Grove", 7, 1, 1),
    ]


def test_dominant_categories(make):
    assert row_set(results.city_dominant_categories(make())) == [
        (None, "Garden", 1),
        (4, "Sports", 2),
        (7, "Unknown category", 1),
        (9, "Toys", 1),
    ]


def test_city_category_sales(make):
    assert (4, "Sports", 2, 390.0) in row_set(results.city_category_sales(make()))


def test_recommendations(make):
    sales = make()
    assert rows(results.recommendation_top_cities(sales)) == [
        (4, 590.0, 4, 147.5),
        (7, 64.25, 1, 64.25),
        (9, 45.75, 1, 45.75),
        (None, 15.0, 1, 15.0),
    ]
    assert rows(results.recommendation_top_categories(sales)) == [
        ("Sports", 390.0, 2, 195.0),
        ("Books", 200.0, 2, 100.0),
        ("Unknown category", 64.25, 1, 64.25),
        ("Toys", 45.75, 1, 45.75),
        ("Garden", 15.0, 1, 15.0),
    ]
    assert rows(results.monthly_sales_trends(sales)) == [
        (2021, 3, 515.0, 4),
        (2021, 4, 200.0, 3),
    ]
    assert rows(results.hourly_sales_patterns(sales)) == [
        (9, 166.25, 2),
        (12, 154.25, 2),
        (17, 379.5, 2),
        (20, 15.0, 1),
    ]


def test_installments(make):
    assert rows(results.installment_profitability_analysis(make())) == [
        (1, 67.81, 4, 67.81, 0.0, 67.81, 25.0),
        (2, 64.25, 1, 16.06, 7.36, 8.71, 13.55),
        (3, 79.5, 1, 19.88, 9.1, 10.77, 13.55),
        (6, 300.0, 1, 75.0, 34.35, 40.65, 13.55),
    ]


def test_plans_that_cannot_default(make):
    sales = [sale(plan=p, amount=100.0) for p in (None, 0, -1, 2)]
    got = {r[0]: r[4] for r in rows(results.installment_profitability_analysis(make(sales)))}
    assert got == {None: 0.0, 0: 0.0, -1: 0.0, 2: 11.45}


def test_no_margin_without_sales(make):
    sales = [sale(amount=50.0), sale(amount=-50.0)]
    (row,) = rows(results.installment_profitability_analysis(make(sales)))
    assert row[-1] is None


def test_assumptions_are_parameters(make):
    sales = [sale(plan=2, amount=100.0)]
    (row,) = rows(
        results.installment_profitability_analysis(
            make(sales), gross_margin="0.5", default_rate="0.1", loss_share="1"
        )
    )
    assert row[3:] == (50.0, 10.0, 40.0, 40.0)


def test_tied_merchants_are_all_kept(make):
    dimension = [(f"T{i}", f"Tied {i}", 1, 10) for i in range(7)] + [("B", "Best", 1, 10)]
    sales = [sale(f"T{i}", 10.0) for i in range(7)] + [sale("B", 99.0)]
    assert len(rows(results.top_merchants_by_month_city(make(sales, dimension)))) == 8


def test_sixth_merchant_is_cut_and_count_breaks_ties(make):
    dimension = [(f"M{i}", f"Name {i}", 1, 10) for i in range(7)]
    sales = [sale(f"M{i}", 100.0 - i) for i in range(6)] + [sale("M6", 48.0), sale("M6", 48.0)]
    # Name 4 and Name 6 both took 96; Name 6 did so in two sales and ranks higher.
    names = [r[2] for r in rows(results.top_merchants_by_month_city(make(sales, dimension)))]
    assert names == ["Name 0", "Name 1", "Name 2", "Name 3", "Name 6"]


def test_tied_hours_are_all_kept(make):
    sales = [sale(when=datetime(2023, 1, 1, h)) for h in (3, 9, 10, 20)]
    assert [r[1] for r in rows(results.top_hours_by_category(make(sales)))] == ["3", "9", "10", "20"]


def test_last_category_by_name_wins_a_tie(make):
    sales = [sale(category="Alpha"), sale(category="Beta")]
    assert rows(results.city_dominant_categories(make(sales))) == [(4, "Beta", 1)]


def test_months_run_in_calendar_order(make):
    dates = [datetime(2023, 12, 1), datetime(2022, 8, 1), datetime(2023, 4, 1), datetime(2023, 1, 1)]
    got = [r[0] for r in rows(results.top_merchants_by_month_city(make([sale(when=d) for d in dates])))]
    assert got == ["Aug 2022", "Jan 2023", "Apr 2023", "Dec 2023"]


def test_same_name_in_one_city_is_merged(make):
    dimension = [("X1", "Twin", 1, 10), ("X2", "Twin", 1, 10)]
    got = rows(results.popular_merchants_by_city(make([sale("X1"), sale("X2")], dimension)))
    assert got == [("Twin", 1, 2, 1)]


def test_sums_agree_between_tables(spark):
    """Money is neither lost nor doubled on the way to any table."""
    sales = merchant_totals(
        transactions(spark), merchants(spark), ("year", "month", "hour", "category", "installments"),
        in_cents=True,
    )
    whole = sum(s[1] for s in SALES)
    tables = [
        results.monthly_sales_trends(sales),
        results.hourly_sales_patterns(sales),
        results.performance(sales, "city_id"),
        results.performance(sales, "category"),
        results.installment_sums(sales),
    ]
    for table in tables:
        assert sum(float(r["total_sales"]) for r in table.collect()) == whole


def test_half_cent_means_round_up_exactly(spark):
    """0.005 and 0.015 have no exact double; exact money still rounds them half up."""
    sales = [sale("K17", 0.01), sale("K17", 0.0), sale("K20", 0.01), sale("K20", 0.02)]
    totals = merchant_totals(transactions(spark, sales), merchants(spark), in_cents=True)
    got = {r[0]: r[2] for r in rows(results.merchant_state_averages(totals))}
    assert got == {"Harbour Books": 0.01, "Olive Grove": 0.02}


def test_column_types(spark):
    sales = cleaned(spark)
    kinds = dict(as_double(results.top_merchants_by_month_city(sales)).dtypes)
    assert kinds == {
        "month": "string", "city_id": "int", "merchant_name": "string",
        "purchase_total": "double", "no_of_sales": "bigint",
    }
    assert dict(results.top_hours_by_category(sales).dtypes) == {"category": "string", "hour": "string"}
    assert dict(results.popular_merchants_by_city(sales).dtypes)["rank"] == "int"


def test_calendar_roll_up_needs_no_merchants(spark):
    hours = roll_up(transactions(spark), ("category", "hour"), in_cents=True)
    assert rows(results.top_hours_by_category(hours))[0] == ("Books", "9")


def test_order_of_tied_rows(make):
    """Where the sorting figure ties, the keys decide: every sorted table comes out one way."""
    dimension = [("B", "Bee", 2, 1), ("A", "Ant", 2, 1), ("C", "Cat", 1, 1)]
    one, two = datetime(2021, 5, 1, 8), datetime(2021, 6, 1, 10)
    sales = [sale(m, 10.0, when, category) for m in "BAC" for when in (two, one) for category in ("Y", "X")]
    made = make(sales, dimension)
    top = [r[:3] for r in rows(results.top_merchants_by_month_city(made))]
    names = [(1, "Cat"), (2, "Ant"), (2, "Bee")]
    assert top == [(month, *name) for month in ("May 2021", "Jun 2021") for name in names]
    assert [r[0] for r in rows(results.avg_sales_by_merchant_state(made))] == ["Ant", "Bee", "Cat"]
    assert rows(results.top_hours_by_category(made)) == [("X", "8"), ("X", "10"), ("Y", "8"), ("Y", "10")]
    assert [r[0] for r in rows(results.recommendation_top_categories(made))] == ["X", "Y"]
    assert [r[0] for r in rows(results.hourly_sales_patterns(made))] == [8, 10]
    cities = [r[0] for r in rows(results.recommendation_top_cities(make(sales[4:], dimension)))]
    assert cities == [1, 2]
