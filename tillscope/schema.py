"""Declared schemas of the input tables and the checks made against them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

TRANSACTIONS = T.StructType(
    [
        T.StructField("merchant_id", T.StringType(), False),
        T.StructField("purchase_amount", T.DoubleType(), False),
        T.StructField("purchase_date", T.TimestampType(), False),
        T.StructField("category", T.StringType(), True),
        T.StructField("installments", T.IntegerType(), True),
    ]
)

MERCHANTS = T.StructType(
    [
        T.StructField("merchant_id", T.StringType(), False),
        T.StructField("merchant_name", T.StringType(), True),
        T.StructField("city_id", T.IntegerType(), True),
        T.StructField("state_id", T.IntegerType(), True),
    ]
)

#: Column order of the cleaned (joined) table.
CLEANED_COLUMNS = (
    "merchant_id",
    "merchant_name",
    "city_id",
    "state_id",
    "category",
    "purchase_date",
    "purchase_amount",
    "installments",
)


def conform(df: DataFrame, schema: T.StructType, what: str) -> DataFrame:
    """Select ``schema``'s columns, casting where the stored type differs.

    Timestamps with and without a zone are both taken as they are: casting one to the
    other would shift the hour by the session's zone. Numeric columns already wider than
    declared keep their type when they hold money (a decimal amount stays exact).
    """
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"{what}: missing column(s) {', '.join(missing)}")
    selected = []
    for field in schema:
        stored = df.schema[field.name].dataType
        keep = (
            stored == field.dataType
            or (isinstance(field.dataType, T.TimestampType) and isinstance(stored, T.TimestampNTZType))
            or (field.name == "purchase_amount" and isinstance(stored, T.DecimalType))
        )
        selected.append(df[field.name] if keep else df[field.name].cast(field.dataType).alias(field.name))
    return df.select(*selected)
