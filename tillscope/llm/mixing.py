"""Mixing sources to target weights by Sainte-Laguë apportionment.

A source's target is a share of the wanted number of words. Equal blocks of words are handed
out to sources, and within a source to its shards, by the highest quotients
``weight / (2 k + 1)``; each shard thus has a whole number of blocks. A shard's documents,
in a seeded order, form one stream of words cut into blocks, and the quota is taken from the
front of that order, going round again when it exceeds the shard. Every word of the stream
is one word of one document, so what each document gives follows from where it lies; blocks
are never written out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillscope.llm.storage import checkpointed, free_name

# A word is a run of characters other than these; weights repeat over sources.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)

MAX_PASSES = 2
BLOCK_WORDS = 16
SHARD_WORDS = 65_536
# Past this many shards a source's shards grow instead, so that one window holds them.
MAX_SHARDS = 4_096


def word_count(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, total_share: float = 1.5) -> DataFrame:
    """One row per source: ``source``, ``source_size``, ``target``.

    Weights ``WEIGHTS`` go to sources by code point order, null last, over and over. The targets
    share ``total_share`` of all words by weight, but none exceeds ``MAX_PASSES`` times its
    source: with sources ordered by how soon they reach that limit, a source is limited exactly
    if its share of what the earlier ones left is above it. Windows here run over sources, of
    which there is one row each.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    in_order = Window.orderBy(F.col("source").isNull(), "source")
    weights = F.array(*[F.lit(w).cast("long") for w in WEIGHTS])
    weighed = per_source.withColumn(
        "weight", F.element_at(weights, ((F.row_number().over(in_order) - 1) % len(WEIGHTS) + 1))
    ).withColumn("limit", F.col("source_size") * MAX_PASSES)
    soonest = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").isNull(), "source")
    earlier = soonest.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    left = weighed.select(
        "*",
        (F.sum("source_size").over(everything) * F.lit(total_share)
         - F.coalesce(F.sum("limit").over(earlier), F.lit(0))).alias("left"),
        (F.sum("weight").over(everything)
         - F.coalesce(F.sum("weight").over(earlier), F.lit(0))).alias("open"),
    ).withColumn("limited", F.col("limit") * F.col("open") < F.col("weight") * F.col("left"))
    # What the limited ones leave goes to the others by weight.
    free = ~F.col("limited")
    rest = left.select(
        "*",
        F.max(F.when(free, F.col("left"))).over(everything).alias("free_words"),
        F.max(F.when(free, F.col("open"))).over(everything).alias("free_weight"),
    )
    share = F.col("weight") * F.col("free_words") / F.col("free_weight")
    return rest.select(
        "source", "source_size",
        F.when(F.col("limited"), F.col("limit").cast("double")).otherwise(share).alias("target"),
    )


def sainte_lague(claims: DataFrame, group: list[str], seats: str, quota: str, tie: list[str]) -> DataFrame:
    """``claims`` with ``blocks``: ``seats`` (one number per group) dealt by highest quotients.

    ``quota`` is a claim's exact share in seats. Rounding every claim down at a divisor just too
    large, and up at one just too small, leaves at most two open seats per claim; only the
    quotients in between are ranked. Equal quotients go by ``tie``.
    """
    of_group = Window.partitionBy(*group)
    n = F.count("*").over(of_group)
    q_all = F.sum(quota).over(of_group)
    sure = F.greatest(
        F.lit(0), F.floor(F.col(quota) * (F.col(seats) - F.col("n") / 2) / F.col("q_all") + 0.5) - 1
    )
    most = F.ceil(F.col(quota) * (F.col(seats) + F.col("n") / 2) / F.col("q_all") + 0.5) + 1
    bounded = claims.select("*", n.alias("n"), q_all.alias("q_all")).select(
        "*",
        F.when(F.col("q_all") > 0, sure).otherwise(0).cast("long").alias("sure"),
        F.when(F.col("q_all") > 0, most).otherwise(0).cast("long").alias("most"),
    )
    open_seats = F.col(seats) - F.sum("sure").over(of_group)
    ranked = (
        bounded.select("*", open_seats.alias("open_seats"))
        .select("*", F.explode_outer(F.when(
            F.col("most") > F.col("sure"), F.sequence("sure", F.col("most") - 1)
        )).alias("k"))
        .withColumn("quotient", F.col(quota) / (2 * F.col("k") + 1))
        .withColumn("place", F.row_number().over(
            of_group.orderBy(F.desc_nulls_last("quotient"), *tie, "k")
        ))
    )
    won = F.sum(F.when(
        (F.col("place") <= F.col("open_seats")) & (F.col("quotient") > 0), 1
    ).otherwise(0))
    return ranked.groupBy(*claims.columns).agg((F.max("sure") + won).alias("blocks"))


def mix_sources(docs: DataFrame, total_share: float = 1.5, seed: str = "mix") -> DataFrame:
    """How many words the mix takes of each document.

    Columns ``doc_id``, ``size``, ``source_size``, ``target``, ``taken``; the seed and the ids
    alone decide the order, so reruns agree. No document gives more than ``MAX_PASSES`` times its
    words. A source's words are within about a block per shard of its target. Null text has no
    words; a null source is a source of its own; rows repeated are documents of their own; an
    empty table gives an empty result. A source without words has target 0.
    """
    sizes = checkpointed(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")))
    sources = source_targets(sizes, total_share).withColumn(
        "shards",
        F.greatest(F.lit(1), F.least(
            F.lit(MAX_SHARDS), F.ceil(F.col("source_size") / SHARD_WORDS)
        )).cast("int"),
    ).select(
        "*", (F.col("target") / BLOCK_WORDS).alias("source_quota"),
        F.round(F.sum("target").over(Window.partitionBy()) / BLOCK_WORDS).cast("long").alias("seats"),
    )
    sources = sainte_lague(sources, [], "seats", "source_quota", ["source"]).select(
        F.col("source").alias("_source"), "source_size", "target", "shards",
        F.col("blocks").alias("source_blocks"),
    )
    draw = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    drawn = sizes.join(sources, F.col("source").eqNullSafe(F.col("_source"))).select(
        "doc_id", "size", "source", "source_size", "target", "shards", "source_blocks",
        draw.alias("draw"),
    ).withColumn(
        "shard", F.conv(F.substring("draw", 1, 8), 16, 10).cast("long") % F.col("shards")
    )
    shards = drawn.groupBy("source", "shard", "source_size", "source_blocks").agg(
        F.sum("size").alias("shard_size")
    ).withColumn(
        "shard_quota",
        F.coalesce(F.try_divide(
            F.col("source_blocks") * F.col("shard_size"), F.col("source_size")
        ), F.lit(0.0)),
    )
    quotas = sainte_lague(shards, ["source"], "source_blocks", "shard_quota", ["shard"]).select(
        F.col("source").alias("_source"), F.col("shard").alias("_shard"), "shard_size",
        F.ceil(F.col("shard_size") / BLOCK_WORDS).alias("in_shard"),
        F.col("blocks"),
    ).withColumn("blocks", F.least("blocks", F.col("in_shard") * MAX_PASSES))
    order = Window.partitionBy("source", "shard").orderBy("draw", "doc_id", "size")
    placed = drawn.withColumn(
        "stop", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    )
    at = placed.join(
        quotas,
        F.col("source").eqNullSafe(F.col("_source")) & (F.col("shard") == F.col("_shard")),
    )
    rounds = F.coalesce(F.try_divide(F.col("blocks"), F.col("in_shard")), F.lit(0)).cast("long")
    front = (F.col("blocks") - rounds * F.col("in_shard")) * BLOCK_WORDS
    start = F.col("stop") - F.col("size")
    taken = rounds * F.col("size") + F.least("stop", front) - F.least(start, front)
    return at.select(
        "doc_id", "size", "source_size", "target", taken.cast("long").alias("taken")
    )


def mixed_documents(docs: DataFrame, total_share: float = 1.5) -> DataFrame:
    """Documents with a part in the mix, with ``taken`` words each (repeats counted).

    Other columns stay as they are; if one is named ``taken``, the new one has ``_`` added. Rows
    that share a doc_id share what the id takes in all.
    """
    node, taken = free_name(docs, "mixed_id"), free_name(docs, "taken")
    shares = mix_sources(docs, total_share).groupBy("doc_id").agg(F.sum("taken").alias(taken))
    return docs.join(
        shares.where(F.col(taken) > 0).select(F.col("doc_id").alias(node), taken),
        F.col("doc_id").eqNullSafe(F.col(node)),
    ).drop(node)
