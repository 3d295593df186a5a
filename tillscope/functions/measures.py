"""Sales measures that read the same from single sales and from pre-aggregated sales.

Two kinds of input occur everywhere in this package:

* *sales rows*: one row per sale, with ``purchase_amount`` and ``purchase_date``;
* *sales totals*: rows already grouped by some keys, with ``sales_count`` (number of sales)
  and the money taken, as ``sales_cents`` (whole cents) or ``sales_total`` (anything else).

Summing is associative, so every analysis gives the same answer on either. The helpers
here pick the right expression by looking at the columns present.

Sums of doubles depend in their last bits on the order of addition, which on a cluster is
never the same twice. Cents are added as 64-bit integers: exact in any order, unchanged
when a lost executor's tasks run again, and cheap in generated code. Results of exact money
are decimals; a group may hold 9.2e16 units of currency, beyond which ANSI mode raises.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TOTAL = "sales_total"
CENTS = "sales_cents"
COUNT = "sales_count"


def is_totals(df: DataFrame) -> bool:
    return COUNT in df.columns


def money_scale(df: DataFrame) -> int | None:
    """Decimals of exact money; None when money is a double."""
    if CENTS in df.columns:
        return 2
    kind = df.schema[TOTAL if is_totals(df) else "purchase_amount"].dataType
    return kind.scale if isinstance(kind, T.DecimalType) else None


def raw_total(df: DataFrame) -> Column:
    """Aggregate: money taken, in the unit it is held in.

    Cents stay 64-bit integers here, which sort and hash far faster than wide decimals.
    """
    if CENTS in df.columns:
        return F.sum(CENTS)
    return F.sum(TOTAL if is_totals(df) else "purchase_amount")


def money(df: DataFrame, raw: Column | str) -> Column:
    """A :func:`raw_total` of ``df`` as money."""
    raw = F.col(raw) if isinstance(raw, str) else raw
    return raw.cast("decimal(20,0)") * F.lit(Decimal("0.01")) if CENTS in df.columns else raw


def total(df: DataFrame) -> Column:
    """Aggregate: money taken."""
    return money(df, raw_total(df))


def sales(df: DataFrame) -> Column:
    """Aggregate: number of sales (bigint)."""
    return F.sum(COUNT) if is_totals(df) else F.count(F.lit(1))


def cents(df: DataFrame, amount: str) -> Column:
    """An amount of at most two decimals as whole cents."""
    hundredfold = F.col(amount) * F.lit(100)
    if isinstance(df.schema[amount].dataType, T.DecimalType):
        return F.round(hundredfold).cast("bigint")
    return F.rint(hundredfold).cast("bigint")


def totals(df: DataFrame, *, in_cents: bool = False, amount: str = "purchase_amount") -> list[Column]:
    """Aggregates that turn sales of either kind into (coarser) sales totals.

    ``in_cents`` declares that single amounts have at most two decimals. Totals stay in the
    unit they are in.
    """
    if CENTS in df.columns:
        money = F.sum(CENTS).alias(CENTS)
    elif is_totals(df):
        money = F.sum(TOTAL).alias(TOTAL)
    elif in_cents:
        money = F.sum(cents(df, amount)).alias(CENTS)
    else:
        money = F.sum(amount).alias(TOTAL)
    return [money, sales(df).alias(COUNT)]


def mean(total_col: str, count_col: str, scale: int | None) -> Column:
    """Money divided by number of sales, both already summed.

    For exact money the quotient carries 14 decimals more than the money. A quotient that
    is not exactly half a unit lies at least 0.5 / count units away from it, so a later
    rounding to whole units is right up to 1e13 sales per group.
    """
    if scale is not None:
        return F.try_divide(
            F.col(total_col).cast(T.DecimalType(24, scale)), F.col(count_col).cast("decimal(13,0)")
        )
    return F.try_divide(F.col(total_col), F.col(count_col))


def year_of(df: DataFrame) -> Column:
    return F.col("year") if "year" in df.columns else F.year("purchase_date").alias("year")


def month_of(df: DataFrame) -> Column:
    return F.col("month") if "month" in df.columns else F.month("purchase_date").alias("month")


def hour_of(df: DataFrame) -> Column:
    return F.col("hour") if "hour" in df.columns else F.hour("purchase_date").alias("hour")


def as_double(df: DataFrame) -> DataFrame:
    """Publish a result: every decimal column becomes the double the result promises."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in df.schema
        ]
    )
