"""Groups and connected components that tolerate very large groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillscope.llm.storage import checkpointed, compact

# Rows of one group are dealt to this many sub-groups, so no task gets a whole large group.
SALTS = 256


def with_group_totals(
    rows: DataFrame, keys: list[str], spread: Column, totals: dict[str, tuple[Column, str]]
) -> DataFrame:
    """``rows`` with totals of their group, without gathering a group in one task.

    ``totals`` names each new column: the value of a row and ``min``, ``max`` or ``sum``.
    ``spread`` decides which sub-group a row falls in. Sub-groups are summed first, a group's
    at most ``SALTS`` sub-totals are summed by a window, and rows look the outcome up by
    group and sub-group; so a group of a third of all rows is ``SALTS`` separate keys.
    Null keys form a group like any other.
    """
    fold = {"min": F.min, "max": F.max, "sum": F.sum}
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int"))
    parts = salted.groupBy(*keys, "_salt").agg(
        *[fold[how](value).alias(name) for name, (value, how) in totals.items()]
    )
    group = Window.partitionBy(*keys)
    whole = parts.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_salt").alias("_s"),
        *[fold[how](F.col(name)).over(group).alias(name) for name, (_, how) in totals.items()],
    )
    on = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    on.append(F.col("_salt") == F.col("_s"))
    drop = ["_salt", "_s", *[f"_k{i}" for i in range(len(keys))]]
    return salted.join(whole, on, "inner").drop(*drop)


def connected_components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """Smallest reachable node of each node of the edges ``a``, ``b``: columns ``node``, ``component``.

    Alternates two steps until nothing changes: every node hands its larger neighbours to its
    smallest neighbour, then its smaller ones. Both keep the components as they are and lower
    the number of steps to the smallest node; a few rounds do even for long chains. Edges stay
    distributed; each round is checkpointed, and only a count and a checksum reach the driver.
    """

    def digest(frame: DataFrame) -> tuple:
        return tuple(frame.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003)).first())

    def towards_minimum(pairs: DataFrame) -> DataFrame:
        """Each row's neighbour ``b`` linked to the least node around ``a``."""
        least = pairs.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select(F.col("a").alias("_a"), F.least("a", "m").alias("m"))
        return compact(pairs.join(least, F.col("a") == F.col("_a")).select("a", "b", "m"))

    plain = edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    current = checkpointed(compact(plain))
    before = digest(current)
    for _ in range(max_rounds):
        if before[0] == 0:
            break
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = (
            towards_minimum(both).where("b > a and b <> m")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
        )
        down = towards_minimum(large)
        small = (
            down.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(down.select("a", F.col("m").alias("b"))).distinct()
        )
        current = checkpointed(compact(small))
        after = digest(current)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
