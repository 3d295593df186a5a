"""Join sales to merchants and fill what is missing, without losing a sale."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillscope.schema import CLEANED_COLUMNS

# Fixed value: the name given to sales that carry no category.
UNKNOWN_CATEGORY = "Unknown category"


def known_category(category: str = "category") -> Column:
    return F.coalesce(F.col(category), F.lit(UNKNOWN_CATEGORY))


def known_name(name: str = "merchant_name", merchant_id: str = "merchant_id") -> Column:
    return F.coalesce(F.col(name), F.col(merchant_id))


def unique_merchants(merchants: DataFrame) -> DataFrame:
    """One row per merchant id, so that the join cannot multiply sales.

    Among copies the first in column order wins, filled values before empty ones. The
    ``row_number`` filter also runs before the shuffle, so an id repeated in a third of all
    rows arrives at its task as one row per map task.
    """
    by_id = W.partitionBy("merchant_id").orderBy(
        *[F.asc_nulls_last(c) for c in ("merchant_name", "city_id", "state_id")]
    )
    return (
        merchants.where(F.col("merchant_id").isNotNull())
        .withColumn("copy", F.row_number().over(by_id))
        .where(F.col("copy") == 1)
        .drop("copy")
    )


def clean(transactions: DataFrame, merchants: DataFrame) -> DataFrame:
    """Every sale with its merchant's name, city and state (left outer join).

    * a sale whose merchant is unknown is kept, with empty city and state;
    * a missing merchant name becomes the merchant id;
    * a missing category becomes ``Unknown category``.

    How the join runs is left to Spark: a dimension below the session's broadcast threshold is
    sent to every executor, a larger one is shuffled, and adaptive execution splits the
    partitions of merchants that hold a large share of all sales.
    """
    dimension = unique_merchants(merchants)
    joined = transactions.select(
        "merchant_id", "category", "purchase_date", "purchase_amount", "installments"
    ).join(
        dimension.select("merchant_id", "merchant_name", "city_id", "state_id"), "merchant_id", "left"
    )
    return joined.withColumns(
        {"merchant_name": known_name(), "category": known_category()}
    ).select(*CLEANED_COLUMNS)
