"""Tables that are replaced safely, partly or whole, with statistics and buckets."""

import pytest
from pyspark.sql import functions as F

from tests.data import MERCHANTS, SALES, cleaned, merchants, row_set, sale, transactions
from tillscope import cli
from tillscope.operators.calendar import with_months
from tillscope.sinks.catalog import cleaned_from_layers, write_layers, write_table


@pytest.fixture
def database(spark, request):
    name = f"db_{request.node.name.split('[')[0]}"
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def files(spark, database, table):
    return {row[0] for row in spark.table(f"{database}.{table}").select("_metadata.file_path").distinct().collect()}


def tables(spark, database):
    return {table.name for table in spark.catalog.listTables(database)}


def failing(df):
    """``df`` with a last row that cannot be computed."""
    return df.withColumn("state_id", F.when(F.col("merchant_id") == "K58", F.raise_error("no")).otherwise(F.col("state_id")))


@pytest.mark.parametrize("partition_by", [None, ["city_id"]])
@pytest.mark.parametrize("mode", ["overwrite", "replace_partitions"])
def test_failed_write_leaves_the_old_table(spark, database, partition_by, mode):
    if mode == "replace_partitions" and not partition_by:
        pytest.skip("needs partitions")
    write_table(merchants(spark), "dim", database, partition_by=partition_by)
    before = files(spark, database, "dim")
    with pytest.raises(Exception, match="no"):
        write_table(failing(merchants(spark)), "dim", database, mode, partition_by)
    assert files(spark, database, "dim") == before != set()
    assert row_set(spark.table(f"{database}.dim").select(*merchants(spark).columns)) == row_set(merchants(spark))
    assert tables(spark, database) == {"dim"}


def test_table_is_replaced_by_rows_read_from_itself(spark, database):
    write_table(merchants(spark), "dim", database)
    write_table(spark.table(f"{database}.dim").where("city_id = 4"), "dim", database)
    assert row_set(spark.table(f"{database}.dim")) == row_set(merchants(spark).where("city_id = 4"))
    write_table(merchants(spark).withColumn("more", F.lit(1)), "dim", database)
    assert spark.table(f"{database}.dim").columns[-1] == "more"
    assert tables(spark, database) == {"dim"}


@pytest.mark.parametrize("buckets", [None, 2])
def test_partitioned_table_is_replaced_whole(spark, database, buckets):
    layout = {"partition_by": ["state_id", "city_id"], "bucket_by": "merchant_id", "buckets": buckets}
    odd = [*MERCHANTS, ("K60", "No city", None, 2), ("K61", "No state", 4, None)]
    write_table(merchants(spark, odd), "dim", database, **layout)
    fewer = merchants(spark, [odd[0], ("K70", "New", 8, 8)])
    write_table(fewer, "dim", database, **layout)
    assert row_set(spark.table(f"{database}.dim").select(*fewer.columns)) == row_set(fewer)
    parts = {row[0] for row in spark.sql(f"SHOW PARTITIONS {database}.dim").collect()}
    assert parts == {"state_id=2/city_id=4", "state_id=8/city_id=8"}
    wider = merchants(spark, odd).withColumn("more", F.lit(1))
    write_table(wider, "dim", database, **layout)
    assert row_set(spark.table(f"{database}.dim").select(*wider.columns)) == row_set(wider)
    assert tables(spark, database) == {"dim"}


@pytest.mark.parametrize("buckets", [None, 2])
def test_reloading_a_month_leaves_the_others(spark, database, buckets):
    write_layers(transactions(spark), merchants(spark), None, database, buckets=buckets)
    march = [row for row in SALES if row[2].month == 3]
    april = [row for row in SALES if row[2].month == 4]
    before = {t: files(spark, database, t) for t in ("raw_transactions", "cleaned_transactions")}
    again = [*march[1:], sale(merchant="K17", amount=9.5, when=march[0][2])]
    write_layers(transactions(spark, again), merchants(spark), None, database, mode="replace_partitions", buckets=buckets)
    for table, old in before.items():
        now = files(spark, database, table)
        assert {f for f in old if "month=4" in f} == {f for f in now if "month=4" in f}
        assert not {f for f in old if "month=3" in f} & now
    kept = spark.table(f"{database}.cleaned_transactions").select(*cleaned(spark).columns)
    assert row_set(kept) == row_set(cleaned(spark, [*again, *april]))


def test_replacing_partitions_needs_the_same_table(spark, database):
    write_table(merchants(spark), "dim", database)
    with pytest.raises(ValueError, match="no partitions"):
        write_table(merchants(spark), "dim", database, "replace_partitions")
    write_table(merchants(spark), "parted", database, "replace_partitions", ["city_id"])
    write_table(merchants(spark).select("state_id", "city_id", "merchant_name", "merchant_id"), "parted", database, "replace_partitions", ["city_id"])
    assert row_set(spark.table(f"{database}.parted").select(*merchants(spark).columns)) == row_set(merchants(spark))
    with pytest.raises(ValueError, match="has the columns"):
        write_table(merchants(spark).drop("state_id"), "parted", database, "replace_partitions", ["city_id"])


def test_statistics_of_keys(spark, database):
    write_table(with_months(cleaned(spark)), "sales", database, partition_by=["year", "month"])
    told = {r[0]: r[1] for r in spark.sql(f"DESCRIBE EXTENDED {database}.sales city_id").collect()}
    assert (told["distinct_count"], told["num_nulls"], told["min"], told["max"]) == ("3", "1", "4", "9")
    assert "height" in told["histogram"] and "num_of_bins" in told["histogram"]
    assert {r[0]: r[1] for r in spark.sql(f"DESCRIBE EXTENDED {database}.sales merchant_id").collect()}["distinct_count"] == "5"
    assert spark.conf.get("spark.sql.statistics.histogram.enabled") == "false"
    write_table(merchants(spark), "bare", database, statistics=())
    told = {r[0]: r[1] for r in spark.sql(f"DESCRIBE EXTENDED {database}.bare city_id").collect()}
    assert told["distinct_count"] == "NULL"


def test_statistics_change_the_estimate_of_a_join(spark, database, no_broadcast):
    """With distinct counts the optimizer knows that a join on the key does not multiply rows."""
    many = transactions(spark).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(200)))).drop("copy")
    for name, columns in (("plain", ()), ("known", None)):
        write_table(many, f"sales_{name}", database, statistics=columns)
        write_table(merchants(spark), f"dim_{name}", database, statistics=columns)

    def rows_expected(name):
        joined = spark.table(f"{database}.sales_{name}").join(spark.table(f"{database}.dim_{name}"), "merchant_id")
        rows = joined._jdf.queryExecution().optimizedPlan().stats().rowCount()
        return int(rows.get()) if rows.isDefined() else None

    before = spark.conf.get("spark.sql.cbo.enabled")
    spark.conf.set("spark.sql.cbo.enabled", "true")
    try:
        plain, known = rows_expected("plain"), rows_expected("known")
    finally:
        spark.conf.set("spark.sql.cbo.enabled", before)
    assert known is not None and known <= 200 * len(SALES) and plain != known


def test_bucketed_layers_join_without_shuffling_sales(spark, database, no_broadcast):
    write_layers(transactions(spark), merchants(spark, [*MERCHANTS, MERCHANTS[0]]), None, database, buckets=3)
    found = cleaned_from_layers(spark, database)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert row_set(found) == row_set(cleaned(spark))
    assert row_set(spark.table(f"{database}.cleaned_transactions").select(*found.columns)) == row_set(found)
    raw = spark.table(f"{database}.raw_transactions")
    # A file holds one bucket.
    per_file = raw.groupBy("_metadata.file_path").agg(F.count_distinct(F.pmod(F.hash("merchant_id"), F.lit(3))).alias("n"))
    assert {r["n"] for r in per_file.collect()} == {1}


def test_command_line(spark, database, tmp_path):
    transactions(spark).write.parquet(str(tmp_path / "sales"))
    lines = ["merchant_id,merchant_name,city_id,state_id"]
    lines += [",".join("" if v is None else str(v) for v in row) for row in MERCHANTS]
    (tmp_path / "m.csv").write_text("\n".join(lines) + "\n")
    argv = ["-t", str(tmp_path / "sales"), "-m", str(tmp_path / "m.csv"), "--database", database, "load-raw-data"]
    assert cli.main([*argv, "--buckets", "2"], spark=spark) == 0
    assert cli.main([*argv, "--buckets", "2", "--replace-months"], spark=spark) == 0
    assert row_set(cleaned_from_layers(spark, database)) == row_set(cleaned(spark))
    assert tables(spark, database) == {"raw_transactions", "raw_merchants", "cleaned_transactions"}
