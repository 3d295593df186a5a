from datetime import datetime

import pytest
from tests.data import MERCHANTS, SALES, cleaned, merchants, row_set, rows, sale, transactions

from tillscope.operators.cleaning import clean, unique_merchants
from tillscope.operators.quality import quality_report
from tillscope.schema import CLEANED_COLUMNS


@pytest.fixture(params=["10MB", "-1"], ids=["broadcast", "shuffled"])
def join_kind(request, spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", request.param)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rules(spark, join_kind):
    df = clean(transactions(spark), merchants(spark))
    assert df.columns == list(CLEANED_COLUMNS)
    by_id = {(r["merchant_id"], r["purchase_amount"]): r for r in df.collect()}
    assert len(by_id) == len(SALES)
    assert by_id["K58", 45.75]["merchant_name"] == "K58"
    unmatched = by_id["K99", 15.0]
    assert (unmatched["merchant_name"], unmatched["city_id"], unmatched["state_id"]) == ("K99", None, None)
    assert by_id["K20", 64.25]["category"] == "Unknown category"
    assert by_id["K17", 120.5]["category"] == "Books"


def test_duplicate_merchants_do_not_multiply_sales(spark, join_kind):
    dimension = [("K17", None, 1, 1), *MERCHANTS, ("K17", "Zed", 1, 1)]
    df = clean(transactions(spark), merchants(spark, dimension))
    assert df.count() == len(SALES)
    # Of the copies the first filled name in order is taken, whole.
    assert {(r["merchant_name"], r["city_id"]) for r in df.where("merchant_id = 'K17'").collect()} == {
        ("Harbour Books", 4)
    }


def test_unique_merchants_is_repeatable(spark):
    dimension = merchants(spark, [("M1", "B", 1, 1), ("M1", "A", 2, 2), ("M1", None, 0, 0)])
    assert rows(unique_merchants(dimension.repartition(3))) == [("M1", "A", 2, 2)]


def test_sale_without_merchant_id_is_kept(spark):
    sales = spark.createDataFrame(
        [(None, 5.0, datetime(2023, 1, 1), "Home", 1)],
        "merchant_id string, purchase_amount double, purchase_date timestamp, category string, installments int",
    )
    (row,) = clean(sales, merchants(spark)).collect()
    assert row["merchant_name"] is None and row["purchase_amount"] == 5.0


def test_quality_report(spark):
    sales = [*SALES, sale(amount=-5.0), sale(amount=1.125), sale(amount=0.1 + 0.2), sale(when=datetime(2030, 1, 1)), sale("GONE"), sale("GONE")]
    dimension = [*MERCHANTS, MERCHANTS[0], MERCHANTS[0]]
    text = spark.createDataFrame(
        [("K1", "A", "4", "x"), ("K2", None, None, "7"), ("K3", "B", "four", "y")],
        "merchant_id string, merchant_name string, city_id string, state_id string",
    )
    report = quality_report(
        transactions(spark, sales), merchants(spark, dimension), "2024-01-01 00:00:00", text
    )
    assert dict(rows(report)) == {
        "null_merchant_id": 0,
        "negative_amount": 1,
        "future_date": 1,
        "sub_cent_amount": 1,
        "unmatched_merchant": 3,
        "duplicate_merchant_id": 2,
        "bad_merchant_field": 2,
    }


def test_quality_report_counts_missing_ids(spark):
    sales = transactions(spark).selectExpr(
        "nullif(merchant_id, 'K17') AS merchant_id", "purchase_amount", "purchase_date"
    )
    report = dict(rows(quality_report(sales, merchants(spark), datetime(2024, 1, 1))))
    assert report["null_merchant_id"] == 2
    assert report["unmatched_merchant"] == 1


def test_quality_report_of_nothing(spark):
    report = quality_report(transactions(spark, []), merchants(spark, []), "2024-01-01 00:00:00")
    assert {n for _, n in rows(report)} == {0}


def test_cleaned_helper_matches(spark):
    assert row_set(cleaned(spark)) == row_set(clean(transactions(spark), merchants(spark)))
