"""Run the analyses from files: read once, check and total in that pass, write and report each result."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark import InheritableThread
from pyspark.sql import DataFrame, SparkSession

from tillscope.functions.measures import as_double
from tillscope.operators.cleaning import clean
from tillscope.operators.quality import CHECKS, merchant_report, quality_report, row_checks
from tillscope.plans import insights, results
from tillscope.plans.cube import SIDES, Month, SalesCube
from tillscope.plans.kept import KeptTotals, SubCentAmounts
from tillscope.session import create_session
from tillscope.sinks.catalog import DATABASE, REPLACE_PARTITIONS, write_layers, write_table
from tillscope.sinks.files import save_results
from tillscope.sources.files import load_merchants, load_transactions, malformed_merchants, raw_merchants

REPORTS = "reports"
#: Rows of a large result that a run prints.
SHOWN = 50


@dataclass(frozen=True)
class Output:
    """Where one result table goes. ``bounded`` results have few rows at any scale."""

    table: str
    file: str
    build: Callable[[DataFrame], DataFrame]
    bounded: bool = False

    @property
    def by_merchant(self) -> bool:
        return self.table in results.MERCHANT_KEYS


_RECOMMENDATIONS = "task5_recommendations"

#: The result tables of each task, in report order. Table and file names.
TASKS: dict[str, tuple[Output, ...]] = {
    "1": (
        Output(
            "top_merchants_by_month_city", "task1_top_merchants.csv",
            results.top_merchants_by_month_city,
        ),
    ),
    "2": (
        Output(
            "avg_sales_by_merchant_state", "task2_avg_sales_by_state.csv",
            results.avg_sales_by_merchant_state,
        ),
    ),
    "3": (
        Output(
            "top_hours_by_category", "task3_top_hours_by_category.csv",
            results.top_hours_by_category, bounded=True,
        ),
    ),
    "4": (
        Output(
            "popular_merchants_by_city", "task4_popular_merchants.csv",
            results.popular_merchants_by_city,
        ),
        Output(
            "city_dominant_categories", "task4_city_categories.csv",
            results.city_dominant_categories,
        ),
    ),
    "5": (
        Output(
            "recommendation_top_cities", f"{_RECOMMENDATIONS}/top_cities.csv",
            results.recommendation_top_cities, bounded=True,
        ),
        Output(
            "recommendation_top_categories", f"{_RECOMMENDATIONS}/top_categories.csv",
            results.recommendation_top_categories, bounded=True,
        ),
        Output(
            "monthly_sales_trends", f"{_RECOMMENDATIONS}/monthly_trends.csv",
            results.monthly_sales_trends, bounded=True,
        ),
        Output(
            "hourly_sales_patterns", f"{_RECOMMENDATIONS}/hourly_patterns.csv",
            results.hourly_sales_patterns, bounded=True,
        ),
        Output(
            "installment_profitability_analysis", f"{_RECOMMENDATIONS}/installment_analysis.csv",
            results.installment_profitability_analysis, bounded=True,
        ),
    ),
}


class SparkJob:
    """One run over a transactions file and a merchants file.

    ``use_hive`` selects catalog mode: results also become tables of ``database``.
    ``in_cents`` declares that amounts have at most two decimals; sums are then exact and
    repeatable. Without it they are sums of doubles. ``totals_dir`` names a folder where totals are
    kept between runs: a run then reads only the sales files that are new. ``months`` limits the
    results to the months from the first to the last one, as ``(year, month)``. With ``one_file`` every
    result is a single CSV file, however large.
    """

    def __init__(
        self,
        transactions_path: str,
        merchants_path: str,
        use_hive: bool = True,
        spark_config: Mapping[str, str] | None = None,
        *,
        database: str = DATABASE,
        in_cents: bool = False,
        totals_dir: str | None = None,
        months: tuple[Month, Month] | None = None,
        one_file: bool = False,
        spark: SparkSession | None = None,
    ):
        self.transactions_path = transactions_path
        self.merchants_path = merchants_path
        self.use_hive = use_hive
        self.database = database
        self.in_cents = in_cents
        self.one_file = one_file
        self.spark = spark or create_session(catalog=use_hive, conf=spark_config)
        self._owns_session = spark is None
        self._cube = KeptTotals(self.spark, totals_dir, months) if totals_dir else SalesCube(self.spark, months)
        self._kept: list[DataFrame] = []
        self._done: dict[str, dict[str, DataFrame]] = {}

    # --- inputs -------------------------------------------------------------------------

    def transactions(self) -> DataFrame:
        return load_transactions(self.spark, self.transactions_path)

    def merchants(self) -> DataFrame:
        return load_merchants(self.spark, self.merchants_path)

    def get_cleaned_data(self) -> DataFrame:
        """Single cleaned sales, not cached: the tasks read totals instead."""
        return clean(self.transactions(), self.merchants())

    def quality(self) -> DataFrame:
        """Rows of the inputs that fail a check; in cents mode amounts must be whole cents."""
        return quality_report(self.transactions(), self.merchants(), _now(), *self._merchant_text())

    def _merchant_text(self) -> tuple[DataFrame, DataFrame]:
        """Merchants as text, and the lines that have a wrong number of fields."""
        return tuple(read(self.spark, self.merchants_path) for read in (raw_merchants, malformed_merchants))

    def check(self) -> None:
        """Print the quality report alone; refuse amounts that whole cents would change."""
        self._report({row["check"]: row["failing_rows"] for row in self.quality().collect()})

    def _report(self, failing: Mapping[str, int]) -> None:
        _title("INPUT CHECKS")
        for check in CHECKS:
            print(f"{check}: {failing[check]}")
        if self.in_cents and failing["sub_cent_amount"]:
            raise SubCentAmounts(failing["sub_cent_amount"])

    def totals(self, sides: Sequence[str] = tuple(SIDES)) -> SalesCube:
        """Sales totals of the whole input; each side is computed on first use, in one scan.

        The first scan counts the checks too. Amounts that are no whole cents where these were
        declared end the run before any result is written.
        """
        first = not self._cube.sides
        if not first and isinstance(self._cube, KeptTotals):
            return self._cube
        sales = self.transactions()
        options = {"in_cents": self.in_cents, "checks": row_checks(sales, _now())}
        if isinstance(self._cube, KeptTotals):
            files = self._cube.update(self.transactions_path, self.merchants(), **options)
            print(f"{files} new sales file(s) read")
        else:
            self._cube.build(sales, self.merchants(), sides=sides, **options)
        if first:
            report = merchant_report(self.merchants(), *self._merchant_text()).collect()
            of_merchants = {row["check"]: row["failing_rows"] for row in report}
            unmatched = self._cube.unmatched().first()["failing_rows"]
            self._report({**self._cube.failing, "unmatched_merchant": unmatched, **of_merchants})
            _title("DATA")
            if "merchant" in sides:
                insights.dataset_profile(self._cube.by_merchant).show(truncate=False)
            # Taken first: a limit below a join would open every file.
            sample = self.spark.createDataFrame(sales.take(5), sales.schema)
            _show("Sample rows", clean(sample, self.merchants()), 5)
        return self._cube

    # --- tasks --------------------------------------------------------------------------

    def _run(self, task: str, paths: Mapping[str, str | None]) -> dict[str, DataFrame]:
        """Compute, keep, write and return the tables of a task by table name."""
        sides = {"merchant" if output.by_merchant else "calendar" for output in TASKS[task]}
        if task in self._done:
            return self._done[task]
        cube = self.totals(sorted(sides))
        tables = {}
        for output in TASKS[task]:
            source = cube.by_merchant if output.by_merchant else cube.by_calendar
            table = as_double(output.build(source)).persist()
            self._kept.append(table)
            path = paths.get(output.table)
            if path:
                save_results(table, path, single_file=self.one_file or output.bounded, bounded=output.bounded)
            if self.use_hive:
                write_table(table, output.table, self.database)
            tables[output.table] = table
        return tables

    def _run_side_by_side(self, tasks: Mapping[str, Mapping[str, str | None]]) -> None:
        """Make and write the tables of several tasks at once, each in a scheduler pool of its own.

        Where the scheduler is fair (``spark.scheduler.mode``), small tables need not queue behind a
        large one. If a task fails, the jobs of the others are cancelled and its error is raised.
        """
        context = self.spark.sparkContext
        tag = f"tillscope-{id(self)}"
        failed: list[BaseException] = []
        found: dict[str, dict[str, DataFrame]] = {}

        def work(task: str) -> None:
            context.setLocalProperty("spark.scheduler.pool", f"task{task}")
            context.addJobTag(tag)
            try:
                if not failed:
                    found[task] = self._run(task, tasks[task])
            except BaseException as error:
                failed.append(error)
                context.cancelJobsWithTag(tag)

        threads = [InheritableThread(target=work, args=(task,), session=self.spark) for task in tasks]
        for thread in threads:
            thread.start()
        for thread in threads:
            thread.join()
        if failed:
            raise failed[0]
        self._done = found

    def run_task1(self, output_path: str | None = None) -> DataFrame:
        """Best merchants per month and city."""
        _title("TASK 1: TOP MERCHANTS BY CITY AND MONTH")
        table = self._run("1", {"top_merchants_by_month_city": output_path})[
            "top_merchants_by_month_city"
        ]
        insights.task1_coverage(table).show(truncate=False)
        _show("Top merchants", table, SHOWN)
        return table

    def run_task2(self, output_path: str | None = None) -> DataFrame:
        """Mean sale per merchant and state."""
        _title("TASK 2: AVERAGE SALE BY MERCHANT AND STATE")
        table = self._run("2", {"avg_sales_by_merchant_state": output_path})[
            "avg_sales_by_merchant_state"
        ]
        insights.avg_sale_summary(table).show(truncate=False)
        _show("Highest averages", insights.top_average_merchants(table), 10)
        _show("Rows 11 to 30", insights.avg_sales_page(table), 20)
        _show("Averages", table, SHOWN)
        return table

    def run_task3(self, output_path: str | None = None) -> DataFrame:
        """Best hours per category."""
        _title("TASK 3: TOP HOURS BY CATEGORY")
        table = self._run("3", {"top_hours_by_category": output_path})["top_hours_by_category"]
        insights.task3_coverage(table).show(truncate=False)
        _show("Categories peaking at each hour", insights.peak_hour_distribution(table), 24)
        _show("Peak hours", table, SHOWN)
        return table

    def run_task4(
        self, output_merchants: str | None = None, output_categories: str | None = None
    ) -> tuple[DataFrame, DataFrame]:
        """Popular merchants and dominant category per city."""
        _title("TASK 4: POPULAR MERCHANTS AND CATEGORIES BY CITY")
        tables = self._run(
            "4",
            {
                "popular_merchants_by_city": output_merchants,
                "city_dominant_categories": output_categories,
            },
        )
        popular = tables["popular_merchants_by_city"]
        dominant = tables["city_dominant_categories"]
        insights.task4_coverage(popular, dominant).show(truncate=False)
        _show("Most popular city leaders", insights.overall_popular_merchants(popular), 5)
        _show("Cities led by each category", insights.category_dominance(dominant), 20)
        _show("First three ranks by city", insights.city_podium(popular), 20)
        _show("Dominant categories", dominant, 20)
        return popular, dominant

    def run_task5(self, output_dir: str | None = None) -> dict[str, DataFrame]:
        """Recommendations for new merchants."""
        _title("TASK 5: BUSINESS RECOMMENDATIONS")
        paths = {
            o.table: f"{output_dir.rstrip('/')}/{o.file.rsplit('/', 1)[1]}" if output_dir else None
            for o in TASKS["5"]
        }
        tables = self._run("5", paths)
        cities = results.performance(self._cube.by_merchant, "city_id")
        monthly, hourly = tables["monthly_sales_trends"], tables["hourly_sales_patterns"]
        plans = tables["installment_profitability_analysis"]
        _show("Top cities", tables["recommendation_top_cities"], 5)
        _show("Market share of the top cities", insights.top_city_market_share(cities), 1)
        _show("Top categories", tables["recommendation_top_categories"], 5)
        _show("Monthly trend", insights.monthly_trend_direction(monthly), 12)
        _show("Peak business hours", insights.peak_hours_chart(hourly), 10)
        _show("Instalment plans", plans, 20)
        _show("Best instalment plan", insights.best_installment_plan(plans), 1)
        return {
            "top_cities": tables["recommendation_top_cities"],
            "top_categories": tables["recommendation_top_categories"],
            "monthly_trends": monthly,
            "hourly_patterns": hourly,
            "installment_recommendation": plans,
        }

    def run_task(self, task: str, output_base_dir: str | None = None) -> None:
        """One task by number, or ``all``, with the standard file names."""
        if task == "all":
            self.run_all_tasks(output_base_dir)
            return
        base = (output_base_dir or REPORTS).rstrip("/")
        if task == "5":
            self.run_task5(f"{base}/{_RECOMMENDATIONS}")
        else:
            getattr(self, f"run_task{task}")(*[f"{base}/{o.file}" for o in TASKS[task]])

    def run_all_tasks(self, output_base_dir: str | None = None) -> None:
        """All tasks: their tables are made side by side, then reported in order."""
        self.totals()  # both sides in one scan
        base = (output_base_dir or REPORTS).rstrip("/")
        self._run_side_by_side({
            task: {o.table: f"{base}/{o.file}" for o in outputs} for task, outputs in TASKS.items()
        })
        try:
            for task in TASKS:
                self.run_task(task, output_base_dir)
        finally:
            self._done = {}

    def load_raw_data(self, *, buckets: int | None = None, replace_months: bool = False) -> None:
        """Write the raw and cleaned table layers (catalog mode only).

        ``buckets`` lays the raw tables out by merchant, so that they join without a shuffle;
        ``replace_months`` replaces only the months the input has.
        """
        if not self.use_hive:
            raise ValueError("the table layers need catalog mode; run without --no-hive")
        write_layers(
            self.transactions(), self.merchants(), None if buckets else self.get_cleaned_data(), self.database,
            mode=REPLACE_PARTITIONS if replace_months else "overwrite", buckets=buckets,
            malformed=malformed_merchants(self.spark, self.merchants_path),
        )

    def stop(self) -> None:
        """Release what the run kept; stop the session if the job made it."""
        for table in self._kept:
            table.unpersist()
        self._kept.clear()
        self._cube.drop()
        if self._owns_session:
            self.spark.stop()


def _now() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)


def _title(text: str) -> None:
    print(f"\n=== {text} ===")


def _show(what: str, df: DataFrame, rows: int) -> None:
    print(f"\n{what}:")
    df.printSchema()
    df.show(rows, truncate=False)
