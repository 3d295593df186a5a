"""Totals that are kept between runs, so that a run reads only the sales files that are new.

Totals are sums, so the totals of new files are written beside those of earlier ones and every
analysis adds them up. A store is a folder all executors reach:

* ``totals/batch=.../side=.../year=.../month=...``: the totals of one load; a new month is new folders;
* ``manifest``: one row for each load, with the files it read and the checks it counted.

The manifest's row is written last, as one file, and totals are read for the loads it names only. A
load that fails, or whose amounts are refused, thus leaves the store as it was, and running
it again reads the same files. Loads into one store must follow each other.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillscope.plans.cube import SIDES, Month, SalesCube, observed, sales_totals
from tillscope.sources.files import load_transactions

_FILE = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("modified", T.TimestampType()),
    ]
)
MANIFEST = T.StructType(
    [
        T.StructField("batch", T.StringType()),
        T.StructField("in_cents", T.BooleanType()),
        T.StructField("files", T.ArrayType(_FILE)),
        T.StructField("failing", T.MapType(T.StringType(), T.LongType())),
    ]
)


class SubCentAmounts(ValueError):
    """Amounts that are not whole cents, where whole cents were declared."""

    def __init__(self, count: int):
        super().__init__(f"{count} amount(s) are not whole cents; run without --in-cents")


def sales_files(spark: SparkSession, path: str) -> DataFrame:
    """``path``, ``length`` and ``modified`` of every file below ``path``; none of them is opened."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return listed.select("path", "length", F.col("modificationTime").alias("modified"))


class KeptTotals(SalesCube):
    """A :class:`SalesCube` whose totals stay in ``folder`` and grow with the files of the input."""

    def __init__(self, spark: SparkSession, folder: str, months: tuple[Month, Month] | None = None):
        super().__init__(spark, months)
        self.folder = folder.rstrip("/")

    def manifest(self) -> DataFrame:
        """The loads so far; empty for a new store."""
        try:
            return self.spark.read.schema(MANIFEST).parquet(f"{self.folder}/manifest")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], MANIFEST)

    def _new_files(self, path: str) -> list[str]:
        """Files no load has read. A file that changed or went since is an error: its sales are in the totals."""
        now = sales_files(self.spark, path)
        seen = self.manifest().select(F.explode("files").alias("file")).select("file.*")
        both = seen.select("path", F.struct("length", "modified").alias("then")).join(
            now.select("path", F.struct("length", "modified").alias("now")), "path", "full"
        )
        # File names only, as many as Spark's own listing keeps on the driver.
        news = both.where("then is null or now is null or then <> now").select(
            "path", F.col("then").isNull().alias("fresh")
        ).collect()
        stale = sorted(row["path"] for row in news if not row["fresh"])
        if stale:
            raise ValueError(
                f"{len(stale)} file(s) in the kept totals of {self.folder} have changed or gone, such as "
                f"{stale[0]}; give a new folder to start anew"
            )
        return sorted(row["path"] for row in news)

    def update(
        self, path: str, merchants: DataFrame, *, in_cents: bool = False,
        checks: Mapping[str, Column] | None = None,
    ) -> int:
        """Add the sales of files that are new below ``path``; how many these are.

        All sides are kept. With ``in_cents``, a load with amounts that are not whole cents is
        refused before it becomes part of the store.
        """
        self._merchants = merchants
        loads = self.manifest().select("in_cents").distinct().collect()
        if any(load["in_cents"] != in_cents for load in loads):
            raise ValueError(f"the kept totals of {self.folder} hold {'doubles' if in_cents else 'cents'}")
        files = self._new_files(path)
        if files:
            self._load(files, in_cents, dict(checks or {}))
        self.sides = tuple(SIDES)
        counted = self.manifest().select(F.explode("failing").alias("check", "rows")).groupBy("check").sum("rows").collect()
        self.failing = {name: 0 for name in checks or {}} | {row["check"]: row["sum(rows)"] for row in counted}
        return len(files)

    def _load(self, files: Sequence[str], in_cents: bool, checks: dict[str, Column]) -> None:
        batch = f"b{uuid.uuid4().hex}"
        sales = load_transactions(self.spark, files)
        totals, seen = sales_totals(sales, in_cents=in_cents, checks=checks), None
        if checks:
            totals, seen = observed(totals, "calendar", list(checks))
        # Totals of a month come together first: otherwise every task would leave a file in every month.
        totals.hint("rebalance", "side", "year", "month").write.partitionBy("side", "year", "month").parquet(
            f"{self.folder}/totals/batch={batch}"
        )
        failing = {name: seen.get[name] or 0 for name in checks} if seen else {}
        if in_cents and failing.get("sub_cent_amount"):
            raise SubCentAmounts(failing["sub_cent_amount"])
        read = sales_files(self.spark, files).agg(F.collect_list(F.struct(*_FILE.names)).alias("files"))
        counts = F.create_map(*[F.lit(x) for pair in failing.items() for x in pair]) if failing else F.create_map()
        read.select(
            F.lit(batch).alias("batch"), F.lit(in_cents).alias("in_cents"), "files",
            counts.cast("map<string,bigint>").alias("failing"),
        ).coalesce(1).write.mode("append").parquet(f"{self.folder}/manifest")

    def _totals(self) -> DataFrame:
        batches = [row["batch"] for row in self.manifest().select("batch").collect()]
        if not batches:
            raise ValueError(f"the kept totals of {self.folder} are empty")
        places = [f"{self.folder}/totals/batch={batch}" for batch in batches]
        return self.spark.read.option("basePath", f"{self.folder}/totals").parquet(*places)

    def drop(self) -> None:
        """Nothing goes: the totals are there to stay."""
