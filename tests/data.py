"""The small hand-made inputs and helpers shared by the tests."""

from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from tillscope import schema
from tillscope.operators.cleaning import clean

MERCHANTS = [
    ("K17", "Harbour Books", 4, 2),
    ("K20", "Olive Grove", 7, 3),
    ("K31", "Cobalt Cycles", 4, 2),
    ("K58", None, 9, 5),
]

SALES = [
    ("K17", 120.5, datetime(2021, 3, 4, 9, 5), "Books", 1),
    ("K17", 79.5, datetime(2021, 3, 18, 17, 40), "Books", 3),
    ("K20", 64.25, datetime(2021, 4, 2, 12, 20), None, 2),
    ("K31", 300.0, datetime(2021, 3, 9, 17, 10), "Sports", 6),
    ("K58", 45.75, datetime(2021, 4, 11, 9, 30), "Toys", 1),
    ("K99", 15.0, datetime(2021, 3, 27, 20, 0), "Garden", 1),
    ("K31", 90.0, datetime(2021, 4, 20, 12, 45), "Sports", 1),
]


def merchants(spark, rows=MERCHANTS):
    return spark.createDataFrame(rows, schema.MERCHANTS)


def transactions(spark, rows=SALES):
    return spark.createDataFrame(rows, schema.TRANSACTIONS)


def cleaned(spark, sales=SALES, dimension=MERCHANTS, exact=False):
    rows = transactions(spark, sales)
    if exact:
        rows = rows.withColumn("purchase_amount", F.col("purchase_amount").cast("decimal(18,2)"))
    return clean(rows, merchants(spark, dimension))


def sale(merchant="K17", amount=10.0, when=datetime(2023, 1, 1, 12), category="Home", plan=1):
    return (merchant, amount, when, category, plan)


def rows(df):
    """Rows as plain tuples, in order, decimals as floats."""
    return [
        tuple(float(v) if isinstance(v, Decimal) else v for v in row) for row in df.collect()
    ]


def row_set(df):
    """Rows as plain tuples, whatever their order."""
    return sorted(rows(df), key=lambda r: tuple((v is not None, v) for v in r))
