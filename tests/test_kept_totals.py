"""One scan of the sales in a run, checks counted in it, and totals kept between runs."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.data import MERCHANTS, SALES, cleaned, merchants, row_set, sale, transactions
from tillscope import cli
from tillscope.functions.measures import as_double
from tillscope.job import TASKS, SparkJob
from tillscope.operators.quality import quality_report, row_checks
from tillscope.plans import kept as kept_module
from tillscope.plans.cube import SalesCube
from tillscope.plans.kept import KeptTotals, SubCentAmounts, sales_files
from tillscope.sources.files import load_merchants, load_transactions, raw_merchants

NOW = "2021-04-01 00:00:00"
#: Sales that fail checks: no merchant, unknown merchants, a refund, dates after NOW.
ODD = [
    *SALES, sale(merchant=None, amount=3.0), sale(merchant="K98", amount=-2.5), sale(merchant="K17", amount=-1.0),
    sale(merchant="K17", amount=8.25, when=datetime(2021, 5, 1, 3, 0)),
]
MARCH = [row for row in ODD if row[2].month == 3]
LATER = [row for row in ODD if row[2].month != 3]


def nullable(spark, rows):
    frame = transactions(spark, SALES)
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in frame.schema)
    return spark.createDataFrame(rows, fields)


@pytest.fixture
def dimension(tmp_path):
    lines = ["merchant_id,merchant_name,city_id,state_id"]
    lines += [",".join("" if v is None else str(v) for v in row) for row in [*MERCHANTS, MERCHANTS[0]]]
    path = tmp_path / "merchants.csv"
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def write_sales(spark, rows, path, mode="append"):
    nullable(spark, rows).coalesce(1).write.mode(mode).parquet(str(path))
    return str(path)


def records_read(spark, action):
    """Rows that Spark's tasks read from files while ``action`` runs."""
    store, tracker = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext.statusTracker()
    group = f"count-{id(action)}"
    spark.sparkContext.setJobGroup(group, "count")
    try:
        action()
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    stages = {s for job in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(job).stageIds}
    return sum(store.lastStageAttempt(s).inputRecords() for s in stages)


def report(frame):
    return {row["check"]: row["failing_rows"] for row in frame.collect()}


def of_sales(failing):
    names = ("null_merchant_id", "negative_amount", "future_date", "sub_cent_amount")
    return {name: failing[name] for name in names}


@pytest.mark.parametrize("sides", [["merchant", "calendar"], ["calendar"], ["merchant"]])
def test_checks_are_counted_with_the_totals(spark, sides):
    sales = nullable(spark, [*ODD, sale(merchant="K20", amount=1.005)])
    want = report(quality_report(sales, merchants(spark), NOW))
    cube = SalesCube(spark)
    try:
        cube.build(sales, merchants(spark), sides=sides, checks=row_checks(sales, NOW))
        assert cube.failing == of_sales(want)
        assert cube.unmatched().first()[0] == want["unmatched_merchant"] == 2
        assert not set(cube.failing) & set(spark.table(f"{cube.database}.sales_totals").columns)
        assert want["negative_amount"] == 2 and want["sub_cent_amount"] == 1 and want["null_merchant_id"] == 1
    finally:
        cube.drop()


def test_checks_of_no_sales(spark):
    sales = nullable(spark, [])
    cube = SalesCube(spark)
    try:
        cube.build(sales, merchants(spark), checks=row_checks(sales, NOW))
        assert set(cube.failing.values()) == {0} and cube.unmatched().first()[0] == 0
    finally:
        cube.drop()


@pytest.mark.parametrize("sides", [("merchant", "calendar"), ("calendar",)])
def test_a_run_scans_the_sales_once(spark, tmp_path, dimension, sides, capsys):
    """Checks, report and totals together read each sale once (and the five that are shown as a sample)."""
    n = 20_000
    many = spark.range(n).select(
        F.concat(F.lit("K"), (F.col("id") % 40).cast("string")).alias("merchant_id"),
        (F.col("id") % 100).cast("double").alias("purchase_amount"),
        F.lit(datetime(2021, 3, 1)).alias("purchase_date"), F.lit("Books").alias("category"), F.lit(1).alias("installments"),
    )
    path = str(tmp_path / "many")
    many.repartition(4).write.parquet(path)
    job = SparkJob(path, dimension, use_hive=False, spark=spark)
    try:
        read = records_read(spark, lambda: job.totals(sides))
    finally:
        job.stop()
    assert n <= read < 1.5 * n
    want = report(quality_report(load_transactions(spark, path), load_merchants(spark, dimension), NOW))
    assert f"unmatched_merchant: {want['unmatched_merchant']}" in capsys.readouterr().out


def test_run_prints_the_same_report_as_check(spark, tmp_path, dimension, capsys):
    sales = write_sales(spark, ODD, tmp_path / "sales")
    argv = ["-t", sales, "-m", dimension, "--no-hive"]
    assert cli.main([*argv, "check"], spark=spark) == 0
    alone = re.findall(r"^\w+: \d+$", capsys.readouterr().out, re.M)
    assert cli.main([*argv, "task3", "-o", str(tmp_path / "a.csv")], spark=spark) == 0
    assert re.findall(r"^\w+: \d+$", capsys.readouterr().out, re.M) == alone
    assert len(alone) == 8 and "duplicate_merchant_id: 1" in alone


def results(cube):
    found = {}
    for output in (o for outputs in TASKS.values() for o in outputs):
        found[output.table] = row_set(as_double(output.build(cube.by_merchant if output.by_merchant else cube.by_calendar)))
    return found


@pytest.mark.parametrize("in_cents", [False, True])
def test_two_loads_equal_one(spark, tmp_path, dimension, in_cents):
    dim = load_merchants(spark, dimension)
    checks = row_checks(nullable(spark, []), NOW)
    whole = KeptTotals(spark, str(tmp_path / "whole"))
    assert whole.update(write_sales(spark, [*MARCH, *LATER], tmp_path / "all"), dim, in_cents=in_cents, checks=checks) == 1
    steps = KeptTotals(spark, str(tmp_path / "steps"))
    path = write_sales(spark, MARCH, tmp_path / "sales")
    assert steps.update(path, dim, in_cents=in_cents, checks=checks) == 1
    write_sales(spark, LATER, path)
    assert steps.update(path, dim, in_cents=in_cents, checks=checks) == 1
    assert steps.update(path, dim, in_cents=in_cents, checks=checks) == 0
    assert results(steps) == results(whole)
    assert steps.failing == whole.failing == of_sales(report(quality_report(nullable(spark, ODD), dim, NOW)))
    assert steps.unmatched().first()[0] == whole.unmatched().first()[0] == 2
    with pytest.raises(ValueError, match="hold"):
        steps.update(path, dim, in_cents=not in_cents)


def test_only_new_files_are_read(spark, tmp_path, dimension):
    dim = load_merchants(spark, dimension)
    path, folder = tmp_path / "sales", str(tmp_path / "kept")
    many = nullable(spark, SALES).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(3000)))).drop("copy")
    many.coalesce(2).write.parquet(str(path))
    old = many.count()
    store = KeptTotals(spark, folder)
    assert records_read(spark, lambda: store.update(str(path), dim)) >= old
    before = {str(f): f.stat().st_mtime_ns for f in (tmp_path / "kept/totals").rglob("*.parquet")}
    write_sales(spark, LATER, path)
    again = KeptTotals(spark, folder)
    assert records_read(spark, lambda: again.update(str(path), dim)) < old / 10
    after = {str(f): f.stat().st_mtime_ns for f in (tmp_path / "kept/totals").rglob("*.parquet")}
    assert before.items() < after.items()
    assert again.manifest().count() == 2 and again._totals().where("side = 'calendar'").agg(F.sum("sales_count")).first()[0] == old + len(LATER)


def test_changed_and_lost_files_are_refused(spark, tmp_path, dimension):
    dim = load_merchants(spark, dimension)
    path = write_sales(spark, MARCH, tmp_path / "sales")
    store = KeptTotals(spark, str(tmp_path / "kept"))
    store.update(path, dim)
    write_sales(spark, MARCH + LATER, path, mode="overwrite")
    with pytest.raises(ValueError, match="changed or gone"):
        store.update(path, dim)


def test_failed_load_leaves_the_store(spark, tmp_path, dimension, monkeypatch):
    dim = load_merchants(spark, dimension)
    path = write_sales(spark, MARCH, tmp_path / "sales")
    store = KeptTotals(spark, str(tmp_path / "kept"))
    store.update(path, dim, in_cents=True, checks=row_checks(nullable(spark, []), NOW))
    good = results(store)
    write_sales(spark, LATER, path)
    with monkeypatch.context() as patch:  # the totals are written, the manifest is not
        patch.setattr(kept_module, "sales_files", lambda spark, where: sales_files(spark, where) if isinstance(where, str) else 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store.update(path, dim, in_cents=True)
    assert results(store) == good
    assert store.update(path, dim, in_cents=True, checks=row_checks(nullable(spark, []), NOW)) == 1
    write_sales(spark, [sale(amount=1.005)], path)
    with pytest.raises(SubCentAmounts):
        store.update(path, dim, in_cents=True, checks=row_checks(nullable(spark, []), NOW))
    assert store.manifest().count() == 2


def test_months_prune_the_kept_totals(spark, tmp_path, dimension):
    path = write_sales(spark, SALES, tmp_path / "sales")
    store = KeptTotals(spark, str(tmp_path / "kept"), ((2021, 4), (2021, 4)))
    store.update(path, load_merchants(spark, dimension))
    plan = store.by_calendar._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(side" in plan and "year" in plan.split("PartitionFilters")[1][:200]
    april = [row for row in SALES if row[2].month == 4]
    monthly = next(o for o in TASKS["5"] if o.table == "monthly_sales_trends")
    assert row_set(as_double(monthly.build(store.by_calendar))) == row_set(as_double(monthly.build(cleaned(spark, april))))


def test_command_line(spark, tmp_path, dimension, capsys):
    path = write_sales(spark, SALES, tmp_path / "sales")
    argv = ["-t", path, "-m", dimension, "--no-hive", "--totals", str(tmp_path / "kept"), "--from-month", "2021-04"]
    for files in (1, 0):
        assert cli.main([*argv, "task5", "-o", str(tmp_path / f"out{files}")], spark=spark) == 0
        assert f"{files} new sales file(s) read" in capsys.readouterr().out
        found = spark.read.option("header", True).csv(str(tmp_path / f"out{files}/monthly_trends.csv"))
        assert [(r["year"], r["month"]) for r in found.collect()] == [("2021", "4")]
    with pytest.raises(SystemExit):
        cli.main([*argv[:-1], "2021-13", "check"], spark=spark)


def test_merchant_fields_that_are_no_numbers(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text("merchant_id,merchant_name,city_id,state_id\nK1,A,x,1\nK2,B,2,y\nK3,C,3,3\n")
    want = quality_report(nullable(spark, []), load_merchants(spark, str(path)), NOW, raw_merchants(spark, str(path)))
    assert report(want)["bad_merchant_field"] == 2
