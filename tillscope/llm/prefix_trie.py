"""Trie of shared conversation prefixes, with totals of every subtree by depth-band rollup.

1. Turns are numbered within their conversation and conversations are rebuilt, by joins on ids.
   Only a hash and a word count of each turn travel; texts stay where they were read.
2. The first d turns of a conversation are named by two running 64-bit hashes (exclusive or of a
   hash of each turn and its place), so a node's name needs no text and no parent's name.
3. Totals of subtrees go up in bands of ``BAND`` depths. Inside its band a node adds its value to
   each of its ancestors there, ``BAND`` at most. The top nodes of bands form a trie of their own,
   ``BAND`` times as shallow, which is summed the same way; completed totals of band tops then go to
   the ancestors of their parents in the band above. So rounds grow with the logarithm of the depth.

No conversation, node or list of members is gathered in one task: numbers and running hashes
are made inside bounded parts and blocks and carried over by joins, sums are pre-aggregated, and
members' ids are joined to texts of at most 2 ** ``ENDS`` ids before a node's are hashed as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillscope.llm.storage import checkpointed

#: Depths of a band.
BAND = 8
#: Turns of a block of running hashes.
BLOCK = 4_096
#: A piece of a node's members is gathered among 2 ** ENDS consecutive ids.
ENDS = 12

# Conversations of a family, and the remainder that says how many turns are shared.
FAMILY = 20
HEADS = 4

NODE = ["depth", "p", "q"]
WORDS = r"[^\x20\x09-\x0D]+"


def _turns(conversations: DataFrame) -> DataFrame:
    """Hash and words of each turn, and its number in its conversation, from 1 on.

    Rows are range-partitioned by conversation and turn, so a conversation that holds a third of
    all turns is spread over as many parts. Numbers are given inside parts and raised by the
    turns the conversation has in earlier parts.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"),
        F.xxhash64(role, F.lit(0), text).alias("h"), F.xxhash64(text, F.lit(1), role).alias("g"),
        F.regexp_count(text, F.lit(WORDS)).alias("words"),
    ).withColumn("row", F.monotonically_increasing_id())
    order = [F.asc_nulls_first("turn"), F.col("h"), F.col("g"), F.col("row")]
    placed = checkpointed(
        turns.repartitionByRange("conv_id", *order).withColumn("part", F.spark_partition_id()).drop("row")
    )
    parts = placed.groupBy("part", "conv_id").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    raised = parts.select("part", "conv_id", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("raise"))
    inside = Window.partitionBy("part", "conv_id").orderBy(*order[:3])
    return placed.withColumn("number", F.row_number().over(inside)).join(raised, ["part", "conv_id"]).select(
        "conv_id", (F.col("number") + F.col("raise")).cast("long").alias("number"), "h", "g", "words"
    )


def _rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations (``conv_id``, ``length``) and their turns (``conv_id``, ``depth``, hashes, ``words``)."""
    sizes = turns.groupBy("conv_id").agg(F.max("number").alias("n"))
    shared = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(HEADS))
    first = F.col("conv_id") - F.pmod("conv_id", F.lit(FAMILY))
    convs = sizes.withColumns({"shared": shared, "first": first})
    firsts = sizes.where(F.pmod("conv_id", F.lit(FAMILY)) == 0).select(
        F.col("conv_id").alias("first"), F.col("n").alias("n_first")
    )
    taken = F.least(F.col("shared"), F.coalesce("n_first", F.lit(0)))
    convs = checkpointed(
        convs.join(firsts, "first", "left").withColumn("taken", taken)
        .withColumn("length", F.col("taken") + F.greatest(F.col("n") - F.col("shared"), F.lit(0)))
        .select("conv_id", "first", "shared", "taken", "length")
    )
    own = turns.join(convs, "conv_id").where("number > shared").select(
        "conv_id", (F.col("number") - F.col("shared") + F.col("taken")).alias("depth"), "h", "g", "words"
    )
    heads = turns.where((F.col("number") < HEADS) & (F.pmod("conv_id", F.lit(FAMILY)) == 0)).select(
        F.col("conv_id").alias("first"), F.col("number").alias("depth"), "h", "g", "words"
    )
    heads = heads.join(convs, "first").where("depth <= taken").select("conv_id", "depth", "h", "g", "words")
    return convs, own.unionByName(heads)


def _paths(turns: DataFrame) -> DataFrame:
    """Each turn with the name ``p``, ``q`` of the prefix it ends and of its parent.

    Running hashes start anew in every block; what earlier blocks come to is carried over.
    """
    at = turns.select(
        "conv_id", "depth", "words", F.floor(F.col("depth") / BLOCK).alias("block"),
        F.xxhash64("depth", "h", "g").alias("x"), F.xxhash64("g", "depth", "h").alias("y"),
    )
    blocks = at.groupBy("conv_id", "block").agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.select(
        "conv_id", "block", *[F.coalesce(F.bit_xor(c).over(earlier), F.lit(0)).alias(f"{c}0") for c in "xy"]
    )
    inside = Window.partitionBy("conv_id", "block").orderBy("depth")
    return at.withColumns({"p": F.bit_xor("x").over(inside), "q": F.bit_xor("y").over(inside)}).join(
        carried, ["conv_id", "block"]
    ).select(
        "conv_id", "depth", "words",
        *[F.col(a).bitwiseXOR(F.col(f"{b}0")).alias(a) for a, b in (("p", "x"), ("q", "y"))],
        *[F.col(a).bitwiseXOR(F.col(f"{b}0")).bitwiseXOR(F.col(b)).alias(f"{a}_up") for a, b in (("p", "x"), ("q", "y"))],
    )


def _ends(paths: DataFrame, convs: DataFrame) -> DataFrame:
    """SHA-256 of the ids of the conversations that end at each node, in ascending order.

    Ids are first joined to texts, each of the ids of one range of 2 ** ``ENDS``; a node's texts are
    then hashed as they come, in order. Memory does not grow with a node's members.
    """
    last = convs.select("conv_id", F.col("length").alias("depth"))
    at = last.where("depth > 0").join(paths.select("conv_id", *NODE), ["conv_id", "depth"]).unionByName(
        last.where("depth = 0").select("conv_id", "depth", F.lit(0).cast("long").alias("p"), F.lit(0).cast("long").alias("q"))
    )
    pieces = at.groupBy(*NODE, F.shiftright("conv_id", ENDS).alias("piece")).agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids")
    )
    ordered = pieces.repartition(*NODE).sortWithinPartitions(*NODE, "piece")
    return ordered.mapInArrow(_digests, "depth long, p long, q long, ends_sha256 string")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [*NODE, "ends_sha256"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
    node, state = None, None
    for batch in batches:
        done: list[tuple] = []
        keys = zip(*[batch.column(c).to_pylist() for c in NODE], strict=True)
        for key, ids in zip(keys, batch.column("ids").to_pylist(), strict=True):
            if key == node:
                state.update(b"," + ids.encode())
                continue
            if state is not None:
                done.append((*node, state.hexdigest()))
            node, state = key, hashlib.sha256(ids.encode())
        yield pa.RecordBatch.from_arrays(
            [pa.array([row[i] for row in done], kind) for i, kind in enumerate(kinds)], names=names
        )
    if state is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array([value], kind) for value, kind in zip((*node, state.hexdigest()), kinds, strict=True)], names=names
        )


def _root() -> Column:
    return F.struct(*[F.lit(0).cast("long").alias(c) for c in NODE])


def band_ancestors(chains: DataFrame, step: int) -> DataFrame:
    """For nodes at multiples of ``step``: their ancestors at such depths, band by band.

    ``chains`` is as for ``subtree_totals``. Columns: the node's key, ``up`` (its ancestors in its own
    band, itself included, topmost first), and, for band tops below the first band, ``over`` (its
    ancestors in the band above).
    """
    high = step * BAND
    at = chains.where(F.col("depth") % step == 0).withColumn("band", F.floor(F.col("depth") / high))
    so_far = Window.partitionBy("conv_id", "band").orderBy("depth")
    with_root = F.when(F.col("band") == 0, F.array(_root())).otherwise(F.array().cast("array<struct<depth:bigint,p:bigint,q:bigint>>"))
    rows = at.withColumn("up", F.concat(with_root, F.collect_list(F.struct(*NODE)).over(so_far)))
    tops = rows.where((F.col("band") > 0) & (F.col("depth") % high == 0))
    # The band above a top is what its chain has at that band's last depth.
    above = rows.where(F.col("depth") % high == high - step).select(
        "conv_id", (F.col("depth") + step).alias("depth"), F.col("up").alias("over")
    )
    tops = tops.select("conv_id", "depth").join(above, ["conv_id", "depth"])
    return rows.where("top").join(tops, ["conv_id", "depth"], "left").select(*NODE, "up", "over")


def subtree_totals(values: DataFrame, chains: DataFrame, columns: list[str]) -> DataFrame:
    """Sums of ``columns`` over the subtree of every node.

    ``values`` has each node's key and own values, the root's among them. ``chains`` has the ways that
    lead to the other nodes: rows ``conv_id``, ``depth``, ``p``, ``q`` and ``top``, which is true once for
    each node, in a chain ``conv_id`` that leads through all its ancestors but the root.
    """
    deepest = values.agg(F.max("depth")).first()[0] or 0
    steps = [1]
    while steps[-1] * BAND <= deepest:
        steps.append(steps[-1] * BAND)
    sums = [F.sum(c).alias(c) for c in columns]
    levels = [checkpointed(band_ancestors(chains, step)) for step in steps]
    # Upwards: values of a whole band meet at its top, which stands for them one level on.
    own = [checkpointed(values.select(*NODE, *columns))]
    for ways in levels[:-1]:
        top = F.coalesce(F.col("up")[0], _root())
        at_top = own[-1].join(ways, NODE, "left").groupBy(top.alias("top")).agg(*sums)
        own.append(checkpointed(at_top.select("top.*", *columns)))
    # Downwards: completed totals of the tops below go to their ancestors in the band above.
    total = None
    for step, ways, value in reversed(list(zip(steps, levels, own, strict=True))):
        parts = value.join(ways, NODE, "left").select(F.coalesce("up", F.array(_root())).alias("to"), *columns)
        if total is not None:
            below = total.where("depth > 0").join(ways.where("over is not null"), NODE)
            parts = parts.unionByName(below.select(F.col("over").alias("to"), *columns))
        total = checkpointed(
            parts.select(F.explode("to").alias("node"), *columns).groupBy("node").agg(*sums).select("node.*", *columns)
        )
    return total


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """Nodes of the trie of rebuilt conversations.

    A conversation c is rebuilt from the first h turns of conversation c - c % 20 and its own after
    its first h, h being the checksum of c modulo 4. Columns, one row for each distinct sequence of
    first turns: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    Turns go by ``turn``, null first; several of one number go by a hash of role and text, repeated rows
    are turns like others. Null roles and texts are empty. Rows without conv_id belong to no conversation.
    Remainders of negative ids count upwards (-5 belongs to -20). An empty table has no nodes, not
    even a root. Other columns are not read.
    """
    convs, turns = _rebuilt(_turns(conversations))
    paths = checkpointed(_paths(turns))
    nodes = paths.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("words").alias("words"),
        F.min("p_up").alias("p_up"), F.min("q_up").alias("q_up"),
    )
    nothing = F.lit(0).cast("long")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0").select(
        *[nothing.alias(c) for c in NODE], "conv_id", "n_convs", F.lit(0).alias("words"),
        F.lit(None).cast("long").alias("p_up"), F.lit(None).cast("long").alias("q_up"),
    )
    nodes = checkpointed(nodes.unionByName(root))
    children = nodes.where("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("p_up").alias("p"), F.col("q_up").alias("q")
    ).agg(F.count("*").alias("n_children"))
    nodes = checkpointed(nodes.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))))
    # One member's chain leads to each node; of a chain all its turns are wanted as ancestors.
    named = nodes.where("depth > 0").select(*NODE, "conv_id", F.lit(True).alias("top"))
    chains = paths.select("conv_id", *NODE).join(
        named.select("conv_id").distinct(), "conv_id", "left_semi"
    ).join(named, [*NODE, "conv_id"], "left").withColumn("top", F.coalesce("top", F.lit(False)))
    own = nodes.select(
        *NODE, F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"),
    )
    totals = subtree_totals(own, checkpointed(chains), ["n_leaves", "saved_tokens"])
    parents = nodes.where("n_children > 0").select(
        (F.col("depth") + 1).alias("depth"), F.col("p").alias("p_up"), F.col("q").alias("q_up"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    none = hashlib.sha256(b"").hexdigest()
    return (
        nodes.join(parents, ["depth", "p_up", "q_up"], "left")
        .join(totals, NODE).join(_ends(paths, convs), NODE, "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
        )
    )
