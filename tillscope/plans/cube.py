"""All sales totals a full run needs, from one pass over the sales.

The ten tables need sales either by merchant or by calendar hour and plan, never both at
once. Two grouping sets over a single scan give both groupings; the result is written, so that
every table afterwards reads totals instead of sales, and a lost executor costs no second pass.
Merchants are joined when the merchant side is read: the calendar side never meets them.

The checks on single sales are counted in the same pass. Every group carries the number of its
sales that fail each check, and an observation adds these numbers up while the totals are written.
It stands behind the grouping, in the stage that writes: Spark counts a task of that stage once,
however often it ran, so the figures hold when executors are lost.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillscope.functions import measures as m
from tillscope.operators.calendar import for_months
from tillscope.operators.rollup import attach_merchants, key_column
from tillscope.session import shared_folder

MERCHANT_SIDE = ("merchant_id", "year", "month", "category")
CALENDAR_SIDE = ("year", "month", "hour", "category", "installments")
_KEYS = ("merchant_id", "year", "month", "hour", "category", "installments")


SIDES = {"merchant": MERCHANT_SIDE, "calendar": CALENDAR_SIDE}
#: Side that only tells which merchants have sales, for runs that need no more of them.
IDENTITY = "identity"
_GROUPINGS = {**SIDES, IDENTITY: ("merchant_id",)}

Month = tuple[int, int]


def sales_totals(
    transactions: DataFrame,
    *,
    sides: Sequence[str] = tuple(SIDES),
    in_cents: bool = False,
    checks: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Totals of the wanted sides, told apart by ``side``.

    ``checks`` are conditions on a sale; each becomes a column with the sales that meet it.
    """
    checks = checks or {}
    keyed = transactions.select(
        *[key_column(transactions, k).alias(k) for k in _KEYS], "purchase_amount",
        *[condition.alias(f"fails_{name}") for name, condition in checks.items()],
    )
    side = (
        F.when(F.grouping("merchant_id") == 1, "calendar")
        .when(F.grouping("category") == 1, IDENTITY)
        .otherwise("merchant")
    )
    return keyed.groupingSets([list(_GROUPINGS[side]) for side in sides], *_KEYS).agg(
        *m.totals(keyed, in_cents=in_cents), side.alias("side"),
        *[F.count_if(f"fails_{name}").alias(name) for name in checks],
    )


def observed(totals: DataFrame, side: str, checks: Sequence[str]) -> tuple[DataFrame, Observation]:
    """``totals`` without the counts of ``checks``, which go into an observation, read off one side."""
    seen = Observation()
    sums = [F.sum(F.when(F.col("side") == side, F.col(name))).alias(name) for name in checks]
    return totals.observe(seen, *sums).drop(*checks), seen


class SalesCube:
    """The totals as a partitioned table in a work database of this application.

    The database lies in the folder the cluster shares and is dropped by :meth:`drop`. ``months``
    limits what is read to the months from the first to the last one, both included.
    """

    def __init__(self, spark: SparkSession, months: tuple[Month, Month] | None = None):
        self.spark = spark
        name = re.sub(r"\W", "_", spark.sparkContext.applicationId).lower()
        self.database = f"tillscope_work_{name}"
        self.months = months
        self._merchants: DataFrame | None = None
        self.sides: tuple[str, ...] = ()
        #: Sales that fail each check, once a build has counted them.
        self.failing: dict[str, int] | None = None

    def build(
        self,
        transactions: DataFrame,
        merchants: DataFrame,
        *,
        sides: Sequence[str] = tuple(SIDES),
        in_cents: bool = False,
        checks: Mapping[str, Column] | None = None,
    ) -> SalesCube:
        """Compute the wanted sides that are not there yet, in one scan.

        With ``checks`` the first scan also counts the sales that fail each, and whatever the sides
        it leaves the ids of the merchants that have sales, for :meth:`unmatched`.
        """
        self._merchants = merchants
        wanted = [side for side in sides if side not in self.sides]
        if not wanted:
            return self
        counting = {} if self.failing is not None else dict(checks or {})
        if counting and "merchant" not in wanted:
            wanted.append(IDENTITY)
        totals = sales_totals(transactions, sides=wanted, in_cents=in_cents, checks=counting)
        seen = None
        if counting:
            totals, seen = observed(totals, wanted[0], list(counting))
        folder = f"{shared_folder(self.spark)}/{self.database}"
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}` LOCATION '{folder}'")
        mode = "append" if self.sides else "overwrite"
        totals.write.mode(mode).partitionBy("side").saveAsTable(f"{self.database}.sales_totals")
        self.sides += tuple(wanted)
        if seen is not None:
            self.failing = {name: seen.get[name] or 0 for name in counting}
        return self

    def _totals(self) -> DataFrame:
        return self.spark.table(f"{self.database}.sales_totals")

    def _side(self, side: str, keys: tuple[str, ...]) -> DataFrame:
        table = self._totals().where(F.col("side") == side)
        if self.months:
            table = for_months(table, *self.months)
        money = m.CENTS if m.CENTS in table.columns else m.TOTAL
        return table.select(*keys, money, m.COUNT)

    @property
    def by_merchant(self) -> DataFrame:
        return attach_merchants(self._side("merchant", MERCHANT_SIDE), self._merchants)

    @property
    def by_calendar(self) -> DataFrame:
        return self._side("calendar", CALENDAR_SIDE)

    def unmatched(self) -> DataFrame:
        """Number of sales whose merchant is not known, from the totals: ``failing_rows``."""
        side = "merchant" if "merchant" in self.sides else IDENTITY
        sold = self._totals().where((F.col("side") == side) & F.col("merchant_id").isNotNull())
        return sold.join(self._merchants.select("merchant_id"), "merchant_id", "left_anti").agg(
            F.coalesce(F.sum(m.COUNT), F.lit(0)).cast("bigint").alias("failing_rows")
        )

    def drop(self) -> None:
        if self.sides:
            self.spark.sql(f"DROP DATABASE IF EXISTS `{self.database}` CASCADE")
            self.sides = ()
            self.failing = None
