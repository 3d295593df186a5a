"""Top-N against brute force, with ties and one group far larger than the rest."""

import random

import pytest
from pyspark.sql import functions as F

from tillscope.operators.ranking import lookup, top_ranked


def brute_force(table, n):
    """(group, value, name) rows whose dense rank by value is at most n, with the rank."""
    kept = []
    for group in {g for g, _, _ in table}:
        values = sorted({v for g, v, _ in table if g == group and v is not None}, reverse=True)
        ranks = {v: i + 1 for i, v in enumerate(values)}
        ranks[None] = len(values) + 1
        kept += [(g, v, name, ranks[v]) for g, v, name in table if g == group and ranks[v] <= n]
    return kept


def key(row):
    return tuple((v is not None, v) for v in row)


@pytest.mark.parametrize("spread", [True, False])
@pytest.mark.parametrize("partitions", [1, 7])
def test_against_brute_force(spark, spread, partitions):
    rng = random.Random(5)
    table = [(None, rng.choice([1, 2, 3, 50, 51, None]), f"n{i}") for i in range(400)]
    table += [(rng.randrange(5), rng.randrange(40), f"m{i}") for i in range(800)]
    df = spark.createDataFrame(table, "g int, v bigint, name string").repartition(partitions)
    for n in (1, 3, 10):
        got = [tuple(r) for r in top_ranked(df, ["g"], ["v"], n, spread=spread).collect()]
        assert sorted(got, key=key) == sorted(brute_force(table, n), key=key)


@pytest.fixture(params=["10MB", "-1"], ids=["broadcast", "shuffled"])
def join_kind(request, spark):
    # Partitions this small would be merged again, which hides how they were made.
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": request.param,
        "spark.sql.adaptive.autoBroadcastJoinThreshold": request.param,
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_all_tied(spark, join_kind):
    """A group that is one big tie is kept whole, and is not ranked in one task."""
    df = spark.range(20_000).select(
        (F.col("id") * 0 + 1).alias("g"), (F.col("id") * 0 + 7).alias("v"), "id"
    ).repartition(8, "id")
    best = top_ranked(df, ["g"], ["v"], 2, spread=True)
    assert best.agg(F.count("*"), F.max("rank")).first() == (20_000, 1)
    sizes = [r["count"] for r in best.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 1 and max(sizes) < 15_000


def test_constant_keys_need_no_cross_join(spark, join_kind):
    df = spark.range(100).select(F.lit(1).alias("g"), F.lit(7).cast("bigint").alias("v"), "id")
    best = top_ranked(df.repartition(4, "id"), ["g"], ["v"], 2, spread=True)
    assert best.count() == 100
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_two_values_rank_together(spark):
    df = spark.createDataFrame([(1, 5, 1), (1, 5, 2), (1, 4, 9)], "g int, a int, b int")
    got = sorted(tuple(r) for r in top_ranked(df, ["g"], ["a", "b"], 2, spread=True).collect())
    assert got == [(1, 5, 1, 2), (1, 5, 2, 1)]


def test_doubles_cannot_be_spread(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 0.25)], "g int, v double")
    with pytest.raises(ValueError, match="floating-point"):
        top_ranked(df, ["g"], ["v"], 1, spread=True)
    assert [tuple(r) for r in top_ranked(df, ["g"], ["v"], 1).collect()] == [(1, 0.5, 1)]


def test_lookup_matches_empty_values(spark):
    left = spark.createDataFrame([(None, 1), (2, 2)], "k int, x int")
    right = spark.createDataFrame([(None, "none"), (3, "three")], "k int, label string")
    assert [tuple(r) for r in lookup(left, right, ["k"], ["label"]).collect()] == [(None, 1, "none")]
