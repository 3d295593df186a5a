"""Checks on the inputs, in one pass over each.

A run counts the checks on single sales (:func:`row_checks`) in the pass that builds its totals; a
report by itself (:func:`quality_report`) takes a pass of its own.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Lines of the report, in order.
CHECKS = (
    "null_merchant_id", "negative_amount", "future_date", "sub_cent_amount", "unmatched_merchant",
    "duplicate_merchant_id", "bad_merchant_field", "malformed_line",
)


def row_checks(transactions: DataFrame, report_time: datetime | str) -> dict[str, Column]:
    """Conditions that single sales fail a check on; ``report_time`` stands for "now"."""
    now: Column = F.lit(str(report_time)).cast(transactions.schema["purchase_date"].dataType)
    hundredfold = F.col("purchase_amount").cast("double") * 100
    return {
        "null_merchant_id": F.col("merchant_id").isNull(),
        "negative_amount": F.col("purchase_amount") < 0,
        "future_date": F.col("purchase_date") > now,
        # A cent amount held as a double may be off by its last bits, never by a thousandth.
        "sub_cent_amount": F.abs(hundredfold - F.rint(hundredfold)) > F.lit(1e-3),
    }


def quality_report(
    transactions: DataFrame,
    merchants: DataFrame,
    report_time: datetime | str,
    raw_merchants: DataFrame | None = None,
    malformed: DataFrame | None = None,
) -> DataFrame:
    """Rows failing each check, as ``(check, failing_rows)``.

    ``raw_merchants`` are the merchants as text, before ids were read as numbers; with them the
    fields that are no numbers are counted too. ``malformed`` are lines of a wrong number of fields.

    ``report_time`` stands for "now", so that the report can be repeated. Sales are summed
    per merchant first; only those sums are joined to the merchants.
    """
    checks = row_checks(transactions, report_time)
    per_merchant = transactions.groupBy("merchant_id").agg(
        F.count(F.lit(1)).alias("sales"),
        *[F.count_if(condition).alias(name) for name, condition in checks.items()],
    )
    copies = _copies(merchants)
    no_merchant = F.col("copies").isNull() & F.col("merchant_id").isNotNull()
    sales_checks = (
        per_merchant.join(copies, "merchant_id", "left")
        .agg(
            *[_sum_where(F.lit(True), name).alias(name) for name in checks],
            _sum_where(no_merchant, "sales").alias("unmatched_merchant"),
        )
        .unpivot([], [*checks, "unmatched_merchant"], "check", "failing_rows")
    )
    return sales_checks.unionByName(merchant_report(merchants, raw_merchants, malformed))


def merchant_report(
    merchants: DataFrame, raw_merchants: DataFrame | None = None, malformed: DataFrame | None = None
) -> DataFrame:
    """The checks on merchants alone, as ``(check, failing_rows)``."""
    report = _copies(merchants).agg(
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).cast("bigint").alias("failing_rows")
    ).select(F.lit("duplicate_merchant_id").alias("check"), "failing_rows")
    if raw_merchants is not None:
        report = report.unionByName(_bad_fields(raw_merchants))
    if malformed is not None:
        lines = malformed.agg(F.count(F.lit(1)).alias("failing_rows"))
        report = report.unionByName(lines.select(F.lit("malformed_line").alias("check"), "failing_rows"))
    return report


def _copies(merchants: DataFrame) -> DataFrame:
    return (
        merchants.where(F.col("merchant_id").isNotNull())
        .groupBy("merchant_id")
        .agg(F.count(F.lit(1)).alias("copies"))
    )


def _bad_fields(raw_merchants: DataFrame) -> DataFrame:
    """Merchants whose city or state is text that is not a number, and is read as empty."""
    bad = F.lit(False)
    for column in ("city_id", "state_id"):
        bad = bad | (F.col(column).isNotNull() & F.col(column).try_cast("int").isNull())
    return raw_merchants.agg(F.count_if(bad).alias("failing_rows")).select(
        F.lit("bad_merchant_field").alias("check"), "failing_rows"
    )


def _sum_where(condition: Column, column: str) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col(column))), F.lit(0)).cast("bigint")
