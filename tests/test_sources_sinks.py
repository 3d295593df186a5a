"""Round trips through files and catalog tables, in temporary folders."""

from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tests.data import SALES, cleaned, merchants, row_set, rows, sale, transactions
from tillscope import schema
from tillscope.operators.calendar import for_months, with_months
from tillscope.plans import results
from tillscope.sinks import files as files_sink
from tillscope.sinks.catalog import register_external, write_layers, write_table
from tillscope.sinks.files import save_results
from tillscope.sources.files import load_merchants, load_transactions


def write_text(path, text):
    path.write_text(text)
    return str(path)


def test_transactions_round_trip(spark, tmp_path):
    path = str(tmp_path / "sales")
    transactions(spark).withColumn("unused", F.lit(1)).write.parquet(path)
    loaded = load_transactions(spark, path)
    assert loaded.columns == schema.TRANSACTIONS.names
    assert row_set(loaded) == row_set(transactions(spark))


def test_transactions_of_other_types(spark, tmp_path):
    path = str(tmp_path / "sales")
    transactions(spark).select(
        "merchant_id",
        F.col("purchase_amount").cast("decimal(12,2)"),
        F.col("purchase_date").cast("timestamp_ntz"),
        "category",
        F.col("installments").cast("bigint"),
    ).write.parquet(path)
    kinds = dict(load_transactions(spark, path).dtypes)
    assert kinds["purchase_amount"] == "decimal(12,2)"
    assert kinds["purchase_date"] == "timestamp_ntz"
    assert kinds["installments"] == "int"


def test_missing_column_is_named(spark, tmp_path):
    path = str(tmp_path / "sales")
    transactions(spark).drop("category", "installments").write.parquet(path)
    with pytest.raises(ValueError, match="category, installments"):
        load_transactions(spark, path)


def test_missing_path_is_reported(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        load_transactions(spark, str(tmp_path / "absent"))


def test_merchants_csv(spark, tmp_path):
    path = write_text(
        tmp_path / "m.csv",
        "state_id,merchant_id,extra,merchant_name,city_id\n"
        '10,M1,x,"Shop, The",1\n'
        "20,M2,x,,2\n"
        ",M3,x,  ,none\n",
    )
    loaded = load_merchants(spark, path)
    assert loaded.dtypes == [
        ("merchant_id", "string"), ("merchant_name", "string"), ("city_id", "int"), ("state_id", "int"),
    ]
    assert rows(loaded) == [
        ("M1", "Shop, The", 1, 10),
        ("M2", None, 2, 20),
        ("M3", "  ", None, None),
    ]


def test_merchants_csv_without_a_column(spark, tmp_path):
    path = write_text(tmp_path / "m.csv", "merchant_id,merchant_name\nM1,A\n")
    with pytest.raises(ValueError, match="city_id, state_id"):
        load_merchants(spark, path)


def test_csv_sink(spark, tmp_path):
    path = str(tmp_path / "out.csv")
    table = results.avg_sales_by_merchant_state(cleaned(spark))
    save_results(table, path, single_file=True)
    parts = sorted((tmp_path / "out.csv").glob("*.csv"))
    assert len(parts) == 1
    lines = parts[0].read_text().splitlines()
    assert lines[0] == "merchant_name,state_id,average_amount"
    assert lines[1] == "Cobalt Cycles,2,195.0" and len(lines) == 6


def test_small_result_is_one_file_unforced(spark, tmp_path):
    save_results(results.avg_sales_by_merchant_state(cleaned(spark)), str(tmp_path / "out.csv"))
    assert len(list((tmp_path / "out.csv").glob("*.csv"))) == 1


@pytest.fixture(params=["streamed", "joined"])
def way(request, spark, monkeypatch):
    """Both ways to one file: a file system that cannot join files, and one that can."""
    if request.param == "joined":
        local = files_sink._file_system(spark, "file:///")
        raw = spark._jvm.org.apache.hadoop.fs.RawLocalFileSystem()
        raw.initialize(local.getUri(), spark._jsc.hadoopConfiguration())
        monkeypatch.setattr(files_sink, "_file_system", lambda *_: raw)
    return request.param


def one_file(folder):
    parts = [p for p in folder.glob("part-*")]
    assert len(parts) == 1
    return parts[0].read_text().splitlines()


def test_one_csv_of_many_parts(spark, tmp_path, way):
    path = str(tmp_path / "out.csv")
    many = spark.range(20_000, numPartitions=12).select(
        F.col("id").alias("a,b"), F.concat(F.lit('x "y", '), F.col("id")).alias("t.u"), F.lit(None).cast("int").alias("none"),
    ).orderBy(F.desc("a,b"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        save_results(many, path, single_file=True)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    lines = one_file(tmp_path / "out.csv")
    assert lines[0] == '"a,b",t.u,none'
    assert [int(line.split(",")[0]) for line in lines[1:]] == list(range(19_999, -1, -1))
    back = spark.read.option("header", True).option("escape", "\\").csv(path)
    assert back.select(F.sum("`a,b`")).first()[0] == sum(range(20_000))
    assert back.where("`t.u` = concat('x \"y\", ', `a,b`)").count() == 20_000
    assert [p.name for p in tmp_path.iterdir()] == ["out.csv"]


def test_one_csv_without_rows(spark, tmp_path, way):
    save_results(spark.range(5).where("id > 9"), str(tmp_path / "out.csv"), single_file=True)
    assert one_file(tmp_path / "out.csv") == ["id"]


def test_one_csv_modes(spark, tmp_path, way):
    path, folder = str(tmp_path / "out.csv"), tmp_path / "out.csv"
    save_results(spark.range(5), path, single_file=True)
    save_results(spark.range(7), path, single_file=True)
    assert one_file(folder) == ["id", *map(str, range(7))]
    save_results(spark.range(3), path, mode="ignore", single_file=True)
    with pytest.raises(AnalysisException):
        save_results(spark.range(3), path, mode="error", single_file=True)
    assert one_file(folder) == ["id", *map(str, range(7))]
    save_results(spark.range(3), path, mode="append", single_file=True)
    assert len(list(folder.glob("part-*"))) == 2
    assert spark.read.option("header", True).csv(path).count() == 10


def test_one_csv_that_fails_leaves_the_old(spark, tmp_path, way):
    path = str(tmp_path / "out.csv")
    save_results(spark.range(5), path, single_file=True)
    broken = spark.range(5).select(F.raise_error(F.lit("no")).cast("long").alias("id"))
    with pytest.raises(Exception, match="no"):
        save_results(broken, path, single_file=True)
    assert one_file(tmp_path / "out.csv") == ["id", *map(str, range(5))]
    assert [p.name for p in tmp_path.iterdir()] == ["out.csv"]


def test_parquet_sink_and_modes(spark, tmp_path):
    path = str(tmp_path / "out")
    df = cleaned(spark)
    save_results(df, path, format="parquet")
    save_results(df, path, format="parquet", mode="append")
    assert spark.read.parquet(path).count() == 2 * len(SALES)
    save_results(df, path, format="parquet", mode="ignore")
    assert spark.read.parquet(path).count() == 2 * len(SALES)
    with pytest.raises(AnalysisException):
        save_results(df, path, format="parquet", mode="error")
    save_results(df, path, format="parquet")
    assert row_set(spark.read.parquet(path)) == row_set(df)


@pytest.mark.parametrize("wrong", [{"format": "orc"}, {"mode": "replace"}])
def test_unknown_format_or_mode(spark, tmp_path, wrong):
    with pytest.raises(ValueError, match="unsupported"):
        save_results(cleaned(spark), str(tmp_path / "x"), **wrong)


@pytest.fixture
def database(spark, request):
    name = f"db_{request.node.name.split('[')[0]}"
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def test_managed_table(spark, database):
    table = results.monthly_sales_trends(cleaned(spark))
    write_table(table, "monthly", database)
    write_table(table, "monthly", database)
    assert row_set(spark.table(f"{database}.monthly")) == row_set(table)
    stats = spark.sql(f"DESCRIBE EXTENDED {database}.monthly").where("col_name = 'Statistics'").first()
    assert "2 rows" in stats["data_type"]
    write_table(table, "monthly", database, mode="append")
    assert spark.table(f"{database}.monthly").count() == 4
    with pytest.raises(ValueError, match="unsupported mode"):
        write_table(table, "monthly", database, mode="merge")


def test_layers_are_partitioned_and_pruned(spark, database):
    sales, dimension = transactions(spark), merchants(spark)
    write_layers(sales, dimension, cleaned(spark), database)
    raw = spark.table(f"{database}.raw_transactions")
    assert raw.columns[-2:] == ["year", "month"]
    assert row_set(raw.select(*sales.columns)) == row_set(sales)
    assert row_set(spark.table(f"{database}.raw_merchants")) == row_set(dimension)
    kept = spark.table(f"{database}.cleaned_transactions")
    assert row_set(kept.select(*cleaned(spark).columns)) == row_set(cleaned(spark))

    march = for_months(kept, (2021, 3), (2021, 3))
    assert march.count() == 4
    plan = march._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    # The analyses read the partition columns of the table as they are.
    assert rows(results.monthly_sales_trends(kept)) == [(2021, 3, 515.0, 4), (2021, 4, 200.0, 3)]


def test_months_across_a_year(spark):
    dates = [datetime(2022, 11, 1), datetime(2022, 12, 1), datetime(2023, 1, 1), datetime(2023, 2, 1)]
    df = with_months(transactions(spark, [sale(when=d) for d in dates]))
    got = for_months(df, (2022, 12), (2023, 1)).select("year", "month")
    assert row_set(got) == [(2022, 12), (2023, 1)]


def test_external_table_leaves_files(spark, database, tmp_path):
    path = str(tmp_path / "files")
    cleaned(spark).write.parquet(path)
    register_external(spark, "outside", path, database)
    assert row_set(spark.table(f"{database}.outside")) == row_set(cleaned(spark))
    spark.sql(f"DROP TABLE {database}.outside")
    assert spark.read.parquet(path).count() == len(SALES)


def test_external_table_of_partitioned_files(spark, database, tmp_path):
    path = str(tmp_path / "files")
    with_months(cleaned(spark)).write.partitionBy("year", "month").parquet(path)
    register_external(spark, "parted", path, database)
    assert spark.table(f"{database}.parted").count() == len(SALES)
    assert spark.table(f"{database}.parted").where("month = 4").count() == 3
