"""Top-N within groups, where equal values share a rank and all of them are kept."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Tasks that the rows tied at one value are dealt to.
SALTS = 16


def top_ranked(
    df: DataFrame,
    groups: Sequence[str],
    by: Sequence[str],
    n: int,
    *,
    spread: bool = False,
    rank: str = "rank",
) -> DataFrame:
    """Rows whose dense rank by ``by`` (all descending) within ``groups`` is at most ``n``.

    A plain window already drops most rows before its shuffle, but it brings all tied rows
    of a group to one task. With ``spread`` the work on a group is divided instead:

    1. every task keeps the best ``n`` ranks of the part of each group it happens to hold,
       which cannot drop a row of the group's best ``n``, whatever the parts are;
    2. the distinct values left over, at most ``n`` per part and group, are ranked;
    3. the kept rows look up their rank by value and by a salt, for which the few ranked
       values are repeated, so that rows tied at one value meet in ``SALTS`` tasks, not one.

    Step 3 compares values computed twice, so ``spread`` takes whole numbers and decimals,
    which come out the same each time; sums of doubles need not and are refused.
    """
    values = [F.desc(c) for c in by]
    in_group = W.partitionBy(*groups).orderBy(*values)
    if not spread:
        return df.withColumn(rank, F.dense_rank().over(in_group)).where(F.col(rank) <= n)
    floating = [c for c in by if isinstance(df.schema[c].dataType, T.DoubleType | T.FloatType)]
    if floating:
        raise ValueError(f"cannot spread a ranking by floating-point values: {', '.join(floating)}")

    in_part = W.partitionBy(*groups, "part").orderBy(*values)
    kept = (
        df.withColumn("part", F.spark_partition_id())
        .withColumn("part_rank", F.dense_rank().over(in_part))
        .where(F.col("part_rank") <= n)
        .drop("part", "part_rank")
        .withColumn("salt", F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)))
    )
    ranks = (
        kept.select(*groups, *by).distinct()
        .withColumn(rank, F.dense_rank().over(in_group))
        .where(F.col(rank) <= n)
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        .withColumn("salt", F.col("salt").cast("long"))
    )
    return lookup(kept, ranks, [*groups, *by, "salt"], [rank]).drop("salt")


def lookup(rows: DataFrame, table: DataFrame, on: Sequence[str], take: Sequence[str]) -> DataFrame:
    """Inner join on equal columns in which an empty value equals an empty value."""
    renamed = table.select(*[F.col(c).alias(f"_{c}") for c in on], *take)
    matches: Column = F.lit(True)
    for c in on:
        matches = matches & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return rows.join(renamed, matches).drop(*[f"_{c}" for c in on])
