"""Calendar columns of sales rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_months(sales: DataFrame) -> DataFrame:
    """Add ``year`` and ``month``, the partition columns of the sales tables."""
    return sales.withColumns({"year": F.year("purchase_date"), "month": F.month("purchase_date")})


def for_months(sales: DataFrame, first: tuple[int, int], last: tuple[int, int]) -> DataFrame:
    """Sales of the months from ``first`` to ``last`` inclusive, as ``(year, month)``.

    Meant for tables partitioned by year and month, where the filter prunes folders.
    """
    number = F.col("year") * 12 + F.col("month")
    return sales.where(
        F.col("year").between(first[0], last[0])
        & number.between(first[0] * 12 + first[1], last[0] * 12 + last[1])
    )
