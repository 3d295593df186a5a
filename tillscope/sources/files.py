"""Readers of the input files. A missing path is reported by Spark's own reader."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillscope import schema


def load_transactions(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Sales from Parquet (a path, or several), checked against the declared columns.

    The stored column types are read as they are and conformed, so a file that holds
    zone-free timestamps or decimal amounts keeps them.
    """
    paths = [path] if isinstance(path, str) else list(path)
    return schema.conform(spark.read.parquet(*paths), schema.TRANSACTIONS, paths[0])


def load_merchants(spark: SparkSession, path: str) -> DataFrame:
    """Merchants from CSV with a header; columns are found by name, in any order.

    Only the header line is read here. Empty fields are empty values, and an id that is not
    a number becomes one too (the quality report counts these).
    """
    return raw_merchants(spark, path).select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.MERCHANTS]
    )


def raw_merchants(spark: SparkSession, path: str) -> DataFrame:
    """The same columns as the text the file holds.

    A line with too few fields has empty values at its end; of one with too many the first are
    taken. Either is a :func:`malformed_merchants` too.
    """
    text = spark.read.option("header", True).csv(path)
    missing = [c for c in schema.MERCHANTS.names if c not in text.columns]
    if missing:
        raise ValueError(f"{path}: missing column(s) {', '.join(missing)}")
    return text.select(*schema.MERCHANTS.names)


def malformed_merchants(spark: SparkSession, path: str) -> DataFrame:
    """Lines with more or fewer fields than the header, as they stand: ``file``, ``line``."""
    columns = spark.read.option("header", True).csv(path).columns
    line = "line"
    while line in columns:
        line += "_"
    kinds = T.StructType([T.StructField(c, T.StringType()) for c in (*columns, line)])
    rows = (
        spark.read.schema(kinds).option("header", True).option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", line).csv(path)
    )
    # A reader of some columns does not notice a wrong number of fields; this asks for them all.
    every = F.length(F.concat_ws("", *[F.col(f"`{c}`") for c in columns])) >= 0
    return rows.where(every & F.col(line).isNotNull()).select(
        F.col("_metadata.file_path").alias("file"), F.col(line).alias("line")
    )
