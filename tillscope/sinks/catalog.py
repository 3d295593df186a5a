"""Catalog tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from threading import RLock

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

from tillscope.operators.calendar import with_months
from tillscope.operators.cleaning import clean
from tillscope.sinks.files import MODES

DATABASE = "merchant_analytics"

#: Overwrites only the partitions that the new rows lie in.
REPLACE_PARTITIONS = "replace_partitions"
TABLE_MODES = (*MODES, REPLACE_PARTITIONS)

#: Columns that joins and groupings go by, of which statistics are kept.
KEY_COLUMNS = ("merchant_id", "merchant_name", "city_id", "state_id", "category", "installments", "year", "month")

_HISTOGRAMS = "spark.sql.statistics.histogram.enabled"
_OVERWRITE = "spark.sql.sources.partitionOverwriteMode"


def create_database(spark: SparkSession, database: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")


def write_table(
    df: DataFrame,
    table_name: str,
    database: str = DATABASE,
    mode: str = "overwrite",
    partition_by: Sequence[str] | None = None,
    *,
    bucket_by: str | None = None,
    buckets: int | None = None,
    statistics: Sequence[str] | None = None,
) -> None:
    """Write a managed table, then compute its statistics.

    * ``overwrite`` leaves the old table in place until all new rows are written, so a write that
      fails does not touch it. A table without partitions is written aside and renamed; partitions are
      written aside and moved in one by one, and those without new rows are dropped afterwards.
    * ``replace_partitions`` replaces the partitions that ``df`` has rows for and leaves the files
      of all others untouched; a table that is not there yet is made.

    Rows of a partitioned table are first brought together by partition: otherwise every
    task would leave a small file in every folder. The rebalance splits a partition that is
    far larger than the others, so one heavy month still has many writers. With ``buckets``,
    rows also lie in that many buckets by ``bucket_by``, sorted in each file. ``statistics``
    names the columns to keep statistics of (default: those of ``KEY_COLUMNS`` it has).
    """
    if mode not in TABLE_MODES:
        raise ValueError(f"unsupported mode {mode!r}; supported: {', '.join(TABLE_MODES)}")
    spark = df.sparkSession
    create_database(spark, database)
    name = f"`{database}`.`{table_name}`"
    there = spark.catalog.tableExists(f"{database}.{table_name}")
    layout = (list(partition_by or []), bucket_by if buckets else None, buckets)
    if mode == REPLACE_PARTITIONS and there:
        _replace_partitions(df, name, layout)
    elif mode == "overwrite" and there:
        _replace_whole(df, database, table_name, layout)
    else:
        fresh = mode if mode in MODES else "error"
        _writer(df, layout).mode(fresh).saveAsTable(name)
    _analyze(spark, name, _keys(df) if statistics is None else list(statistics))


def _keys(df: DataFrame) -> list[str]:
    return [column for column in KEY_COLUMNS if column in df.columns]


def _gathered(df: DataFrame, layout: tuple) -> DataFrame:
    """Rows of one folder, or of one bucket of a folder, brought together and large ones split."""
    partition_by, bucket_by, buckets = layout
    if buckets:
        # The table's own buckets are these numbers of the hash.
        df = df.withColumn("_bucket", F.pmod(F.hash(bucket_by), F.lit(buckets)))
        return df.hint("rebalance", *partition_by, "_bucket").drop("_bucket")
    return df.hint("rebalance", *partition_by) if partition_by else df


def _writer(df: DataFrame, layout: tuple) -> DataFrameWriter:
    partition_by, bucket_by, buckets = layout
    writer = _gathered(df, layout).write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if buckets:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    return writer


def _replace_whole(df: DataFrame, database: str, table_name: str, layout: tuple) -> None:
    """Put the rows of ``df`` in the place of a table, which is kept until they are all written."""
    spark, name = df.sparkSession, f"`{database}`.`{table_name}`"
    partition_by = layout[0]
    if partition_by and _layout_of(spark, name) == _layout_for(df, layout):
        before = {tuple(row) for row in spark.table(name).select(*partition_by).distinct().collect()}
        gone = before - _replace_partitions(df, name, layout)
        for values in gone:
            spec = ", ".join(f"`{c}` = {_literal(v)}" for c, v in zip(partition_by, values, strict=True))
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({spec})")
        return
    aside = f"{table_name}__{uuid.uuid4().hex[:8]}"
    new = f"`{database}`.`{aside}`"
    try:
        _writer(df, layout).mode("error").saveAsTable(new)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {new}")
        raise
    if partition_by:
        # Not every catalog moves partitions with a renamed table, so these rows are copied.
        _writer(spark.table(new), layout).mode("overwrite").saveAsTable(name)
        spark.sql(f"DROP TABLE {new}")
        return
    old = f"`{database}`.`{aside}_old`"
    spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE {new} RENAME TO {name}")
    except Exception:
        spark.sql(f"ALTER TABLE {old} RENAME TO {name}")
        raise
    spark.sql(f"DROP TABLE IF EXISTS {old}")


def _literal(value: object) -> str:
    if value is None or isinstance(value, int):
        return "null" if value is None else str(value)
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def _layout_of(spark: SparkSession, name: str) -> tuple:
    columns = spark.catalog.listColumns(name)
    told = {row["col_name"]: row["data_type"] for row in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    kinds = {c.name: c.dataType for c in columns}
    return kinds, [c.name for c in columns if c.isPartition], int(told.get("Num Buckets") or 0)


def _layout_for(df: DataFrame, layout: tuple) -> tuple:
    return dict(df.dtypes), layout[0], layout[2] or 0


def _replace_partitions(df: DataFrame, name: str, layout: tuple) -> set[tuple]:
    """Replace the partitions that ``df`` has rows for; their values."""
    columns = df.sparkSession.catalog.listColumns(name)
    keys = [column.name for column in columns if column.isPartition]
    if not keys:
        raise ValueError(f"{name} has no partitions to replace")
    names = [column.name for column in columns]
    if sorted(names) != sorted(df.columns):
        raise ValueError(f"{name} has the columns {', '.join(names)}; got {', '.join(df.columns)}")
    # As many values as there are partitions, noted while they are written.
    written = Observation()
    rows = _gathered(df.select(*names), layout).observe(written, F.collect_set(F.struct(*keys)).alias("partitions"))
    with _setting(df.sparkSession, _OVERWRITE, "dynamic"):
        rows.write.mode("overwrite").insertInto(name)
    return {tuple(values) for values in written.get["partitions"] or ()}


_ONE_AT_A_TIME = RLock()


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session for a while; threads that write tables take turns."""
    with _ONE_AT_A_TIME:
        before = spark.conf.get(key, None)
        spark.conf.set(key, value)
        try:
            yield
        finally:
            spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def _analyze(spark: SparkSession, name: str, columns: Sequence[str]) -> None:
    """Rows and size of a table, and of ``columns`` the distinct values, bounds and histograms.

    The optimizer sizes joins and groupings by these where ``spark.sql.cbo.enabled`` is on.
    """
    of_columns = f" FOR COLUMNS {', '.join(f'`{c}`' for c in columns)}" if columns else ""
    with _setting(spark, _HISTOGRAMS, "true"):
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS{of_columns}")


def register_external(
    spark: SparkSession, table_name: str, parquet_path: str, database: str = DATABASE
) -> None:
    """Make a table of Parquet files where they lie; nothing is copied or rewritten.

    Dropping the table leaves the files. Folders of a partitioned layout are picked up.
    """
    create_database(spark, database)
    name = f"`{database}`.`{table_name}`"
    spark.catalog.createTable(name, path=parquet_path, source="parquet")
    if any(column.isPartition for column in spark.catalog.listColumns(name)):
        spark.catalog.recoverPartitions(name)


def write_layers(
    transactions: DataFrame,
    merchants: DataFrame,
    cleaned: DataFrame | None = None,
    database: str = DATABASE,
    *,
    mode: str = "overwrite",
    buckets: int | None = None,
    malformed: DataFrame | None = None,
) -> None:
    """The raw and cleaned tables, sales partitioned by year and month.

    ``malformed`` lines of the merchants' file, if any, are kept as they stand in a table of their own.

    ``mode`` holds for the sales tables: ``replace_partitions`` reloads the months that
    ``transactions`` has and leaves the others as they are; merchants are always replaced whole.

    With ``buckets`` the raw tables are bucketed by merchant alike, so that they are joined (and the
    cleaned table made, unless ``cleaned`` is given) without shuffling the sales. A merchant with a large
    share of all sales makes a bucket as large, which nothing splits at run time; leave buckets out then.
    """
    by_month = ("year", "month")
    by_merchant = {"bucket_by": "merchant_id", "buckets": buckets}
    write_table(with_months(transactions), "raw_transactions", database, mode, by_month, **by_merchant)
    write_table(merchants, "raw_merchants", database, **by_merchant)
    if malformed is not None and not malformed.isEmpty():
        write_table(malformed, "malformed_merchants", database)
    elif malformed is not None:
        transactions.sparkSession.sql(f"DROP TABLE IF EXISTS `{database}`.malformed_merchants")
    if cleaned is None:
        cleaned = cleaned_from_layers(transactions.sparkSession, database)
        if mode == REPLACE_PARTITIONS:
            months = with_months(transactions).select("year", "month").distinct()
            cleaned = with_months(cleaned).join(F.broadcast(months), ["year", "month"], "left_semi").drop("year", "month")
    write_table(with_months(cleaned), "cleaned_transactions", database, mode, by_month)


def cleaned_from_layers(spark: SparkSession, database: str = DATABASE) -> DataFrame:
    """Cleaned sales out of the raw tables."""
    return clean(spark.table(f"`{database}`.raw_transactions"), spark.table(f"`{database}`.raw_merchants"))
