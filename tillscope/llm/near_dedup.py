"""Near-duplicate documents by SetSketch registers.

1. Every text becomes a set of 5-word shingles; its size, a digest of the set and its
   registers are kept. Documents with equal sets are one class, of which the smallest id goes
   on alone, so copies never meet each other.
2. Bands of registers are bucket keys. A bucket links its members to its smallest id only, so
   the number of pairs is that of the members, however large a bucket is. Pairs whose likely
   similarity (from registers and sizes) is far too small go; the rest is confirmed on the
   full sets of the texts.
3. The links found so far join documents into components. Members of a bucket that lie in
   different components have not all been compared. For these documents alone the rest is
   found exactly: ordered from the rarest shingle on, two similar sets share one of their first
   few, at a place that leaves room for enough others. A pair comes out of the join at its first
   such shingle, not at each, and registers are compared before texts are. So a large group
   whose members are nearly, but not quite, similar enough yields few pairs instead of all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillscope.llm import setsketch
from tillscope.llm.grouping import connected_components, with_group_totals
from tillscope.llm.storage import checkpointed, compact, free_name
from tillscope.llm.textarrays import mix, pieces, shingles, utf8, words

# Words of a shingle, and the least similarity in per cent.
WIDTH = 5
PERCENT = 75

# Two regroupings of the same registers in 30 bands of five: a pair of similarity 0.75 shares no
# band with probability 2.4e-6.
BAND_WIDTH = 5
BAND_ORDERS = 2
# Pairs likelier below this are dropped before the exact check; it is five standard errors
# of the estimate away from the limit.
LEAST_ESTIMATE = 0.55
# A pair is not met again at a shingle if it shares one of this many shingles before it.
LOOK_BACK = 32
# Of the documents at the commonest shingle, about so many at most meet the others in the first
# turn, and so many times more in each later one, until all have met.
FIRST_MET = 32
MORE = 8


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        for start, stop, part, at in pieces(data, offsets):
            hashes, _, first = words(part, at)
            sets = list(shingles(hashes, first, WIDTH))
            sketch = setsketch.registers(sets)
            digests = [
                np.array([mix(s, 21).sum(dtype=np.uint64), mix(s, 22).sum(dtype=np.uint64)]).tobytes()
                for s in sets
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(start, stop - start).cast(pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array([row.tobytes() for row in sketch], pa.binary()),
                ],
                names=["doc_id", "n_shingles", "digest", "registers"],
            )


def summaries(docs: DataFrame) -> DataFrame:
    """Size, digest and registers of every document's shingle set."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _summaries, "doc_id long, n_shingles long, digest binary, registers binary"
    )


def _registers(column: pa.Array) -> np.ndarray:
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, np.uint16).reshape(-1, setsketch.REGISTERS)


def _band_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, batch.num_rows, 2_000):
            part = batch.slice(low, 2_000)
            keys = setsketch.band_keys(_registers(part.column("registers")), BAND_WIDTH, BAND_ORDERS)
            ids = np.repeat(part.column("doc_id").to_numpy(), keys.shape[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel().view(np.int64)), pa.array(ids)], names=["band", "doc_id"]
            )


def _likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, batch.num_rows, 5_000):
            part = batch.slice(low, 5_000)
            n_a, n_b = (part.column(c).to_numpy().astype(float) for c in ("n_a", "n_b"))
            estimate = setsketch.joint_similarity(
                _registers(part.column("registers_a")), _registers(part.column("registers_b")), n_a, n_b
            )
            keep = pa.array(estimate >= LEAST_ESTIMATE)
            yield part.select(["a", "b"]).filter(keep)


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose full sets are similar enough; equal neighbours' sets are made once."""
    known, known_set = None, None
    for batch in batches:
        good = []
        a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
        texts_a, texts_b = batch.column("text_a"), batch.column("text_b")
        for i in range(len(a)):
            if known != a[i]:
                known, known_set = a[i], _shingle_set(texts_a.slice(i, 1))
            other = _shingle_set(texts_b.slice(i, 1))
            both = len(np.intersect1d(known_set, other, assume_unique=True))
            good.append(100 * both >= PERCENT * (len(known_set) + len(other) - both))
        yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))


def _shingle_set(text: pa.Array) -> np.ndarray:
    hashes, _, first = words(*utf8(text))
    return next(shingles(hashes, first, WIDTH))


def _shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        for start, stop, part, at in pieces(data, offsets):
            hashes, _, first = words(part, at)
            sets = list(shingles(hashes, first, WIDTH))
            sizes = np.array([len(x) for x in sets])
            row = pa.array(np.repeat(np.arange(start, stop), sizes))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(row), batch.column("component").take(row),
                    pa.array(np.repeat(sizes, sizes).astype(np.int32)),
                    pa.array(np.concatenate([*sets, np.empty(0, np.uint64)]).view(np.int64)),
                ],
                names=["doc_id", "component", "n", "shingle"],
            )


def _bodies(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs ``a``, ``b`` that hold on the full sets."""
    body = {x: texts.select(F.col("doc_id").alias(x), F.col("text").alias(f"text_{x}")) for x in "ab"}
    return checkpointed(
        pairs.join(body["b"], "b").join(body["a"], "a").mapInArrow(_confirmed, "a long, b long")
    )


def _similar(pairs: DataFrame, sketches: DataFrame, texts: DataFrame) -> DataFrame:
    """The ``pairs`` that are similar; what cannot be is dropped by sizes and registers."""
    side = {
        x: sketches.select(
            F.col("doc_id").alias(x), F.col("n_shingles").alias(f"n_{x}"),
            F.col("registers").alias(f"registers_{x}"),
        )
        for x in "ab"
    }
    likely = pairs.join(side["b"], "b").join(side["a"], "a").where(
        100 * F.least("n_a", "n_b") >= PERCENT * F.greatest("n_a", "n_b")
    ).mapInArrow(_likely, "a long, b long")
    return _bodies(compact(checkpointed(likely)), texts)


def _entries(open_docs: DataFrame, texts: DataFrame) -> DataFrame:
    """Where documents can meet similar ones: ``open_docs`` has ``doc_id``, ``component``.

    Shingles are ordered by how many of these documents have them, then by hash. With x the smaller
    set of a pair, the common part is at least 6/7 of x and 3/4 of the larger y (from
    3/7 of both sizes), so it reaches into the first n - 6n/7 + 1 of x and n - 3n/4 + 1 of y. An
    entry is one of these first shingles of a document, with its ``place`` and those ``before`` it.
    """
    rows = texts.join(open_docs, "doc_id").mapInArrow(
        _shingle_rows, "doc_id long, component long, n int, shingle long"
    )
    common = rows.groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1")
    of_doc = Window.partitionBy("doc_id", "n")
    # Shingles of one document alone come first in its order and lead to no partner.
    place = F.col("n") - F.count("*").over(of_doc) + F.row_number().over(of_doc.orderBy("df", "shingle"))
    before = F.collect_list("shingle").over(of_doc.orderBy("place").rowsBetween(-LOOK_BACK, -1))
    return checkpointed(
        rows.join(common, "shingle").select("doc_id", "component", "n", "shingle", place.alias("place"))
        .where(F.col("place") <= F.col("n") - F.ceil(F.col("n") * PERCENT / 100) + 1)
        .withColumn("before", before)
    )


def _mixed(entries: DataFrame) -> DataFrame:
    """The entries at shingles of several components; ``home`` is the one most frequent there."""
    homes = entries.groupBy("shingle", "component").count().groupBy("shingle").agg(
        F.max_by("component", F.struct("count", "component")).alias("home"), F.count("*").alias("kinds")
    ).where("kinds > 1")
    return entries.join(homes.drop("kinds"), "shingle")


def _meetings(at_mixed: DataFrame, turn: int) -> DataFrame:
    """Pairs of a turn, of different components, that can be similar.

    The turn of a pair is the lesser ``turn`` of its two documents. What holds at
    a shared shingle holds at an earlier one too, so the pair is left to the earliest; only where
    more than ``LOOK_BACK`` others lie between two shared ones is it met again, and made distinct.
    """
    # Documents of this turn meet all, the others only those of this turn.
    now = F.col("turn") == turn
    met = F.explode(F.when(now, F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(True))))
    columns = ("doc_id", "component", "n", "place", "before")
    # Entries of the component most frequent at a shingle need not meet one another.
    left = at_mixed.where("component <> home").select(
        "shingle", met.alias("now"), *[F.col(c).alias(f"{c}_l") for c in columns]
    )
    right = at_mixed.select(
        "shingle", now.alias("now"), (F.col("component") == F.col("home")).alias("at_home"),
        *[F.col(c).alias(f"{c}_r") for c in columns],
    )
    rise, both = F.lit(PERCENT), F.lit(100 + PERCENT)
    least_common = F.ceil((F.col("n_l") + F.col("n_r")) * rise / both)
    room = 1 + F.least(F.col("n_l") - F.col("place_l"), F.col("n_r") - F.col("place_r"))
    left_is_smaller = F.struct("n_l", "doc_id_l") < F.struct("n_r", "doc_id_r")
    smaller_n = F.when(left_is_smaller, F.col("n_l")).otherwise(F.col("n_r"))
    smaller_place = F.when(left_is_smaller, F.col("place_l")).otherwise(F.col("place_r"))
    pairs = left.join(right, ["shingle", "now"]).where(
        (F.col("component_l") != F.col("component_r"))
        & (F.col("at_home") | (F.col("doc_id_l") < F.col("doc_id_r")))
        & (100 * F.least("n_l", "n_r") >= rise * F.greatest("n_l", "n_r"))
        & (smaller_place <= smaller_n - F.ceil(smaller_n * 2 * rise / both) + 1)
        & (room >= least_common)
        & ~F.arrays_overlap("before_l", "before_r")
    )
    return pairs.select(
        F.least("doc_id_l", "doc_id_r").alias("a"), F.greatest("doc_id_l", "doc_id_r").alias("b")
    ).distinct()


def _candidates(open_docs: DataFrame, texts: DataFrame) -> DataFrame:
    """All pairs of documents of different components that can be similar, in one turn."""
    return _meetings(_mixed(_entries(open_docs, texts)).withColumn("turn", F.lit(0)), 0)


def _joined(open_docs: DataFrame, links: DataFrame) -> DataFrame:
    """``open_docs`` with the components that ``links`` make of theirs."""
    of = {x: open_docs.select(F.col("doc_id").alias(x), F.col("component").alias(f"in_{x}")) for x in "ab"}
    edges = links.join(of["a"], "a").join(of["b"], "b").select(
        F.col("in_a").alias("a"), F.col("in_b").alias("b")
    )
    into = connected_components(edges).select(
        F.col("node").alias("component"), F.col("component").alias("into")
    )
    return checkpointed(compact(open_docs.join(into, "component", "left").select(
        "doc_id", F.coalesce("into", "component").alias("component")
    )))


def _links_between(open_docs: DataFrame, sketches: DataFrame, texts: DataFrame) -> DataFrame:
    """Links of documents of different components, enough to join all that similar pairs join.

    Few documents meet all others first, then ``MORE`` times as many, and so on until all have met.
    Components are joined after each turn, and what lies in one by then does not meet any
    more: a family costs pairs until it holds together, not all its pairs.
    """
    live = _mixed(_entries(open_docs, texts))
    most = live.groupBy("shingle").count().agg(F.max("count")).first()[0] or 0
    last = 0
    while FIRST_MET * MORE**last < most:
        last += 1
    # 0 for one in MORE**last documents, up to 1 for one in MORE**(last - 1), ...
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(MORE**last)) + 1
    live = checkpointed(live.withColumn(
        "turn", F.least(F.ceil(F.log(float(MORE), drawn)), F.lit(last)).cast("int")
    ))
    links = fresh = _similar(_meetings(live, 0), sketches, texts)
    for turn in range(1, last + 1):
        open_docs = _joined(open_docs, fresh)
        later = live.where(F.col("turn") >= turn).drop("component", "home").join(open_docs, "doc_id")
        live = checkpointed(_mixed(later))
        if live.isEmpty():
            break
        fresh = _similar(_meetings(live, turn), sketches, texts)
        links = links.unionByName(fresh)
    return links


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Component of every document: ``doc_id``, ``n_shingles``, ``component_id``, ``kept``.

    Words are runs of non-blank characters, A-Z lower-cased; a document's set has its distinct
    runs of five words, or all its words as one if there are fewer. Two documents are linked if
    ``100 * shared >= 75 * all`` of their shingles; a component is named by its smallest doc_id,
    which alone is kept. Null, empty and blank texts have no shingles and no links. Rows under one
    doc_id are one document for links (its texts all link it) and share its fate. A null doc_id
    has no links: its component is null, and it is kept. An empty table gives an empty result.
    Other columns are not read.
    """
    found = checkpointed(summaries(docs))
    linked = found.where("n_shingles > 0 and doc_id is not null")
    classed = checkpointed(with_group_totals(
        linked, ["digest", "n_shingles"], F.col("doc_id"), {"class_id": (F.col("doc_id"), "min")}
    ))
    classes = classed.select("doc_id", "class_id")
    # One row for each class; a doc_id with several texts can stand for several classes.
    sketches = classed.where("doc_id = class_id").dropDuplicates(["digest", "n_shingles"])
    bands = sketches.select("doc_id", "registers").mapInArrow(_band_rows, "band long, doc_id long")
    shared = bands.groupBy("band").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    shared = shared.where("least < most").select("band", "least")
    members = compact(checkpointed(bands.join(shared, "band")))
    ids = compact(members.select("doc_id").distinct())
    texts = checkpointed(docs.select("doc_id", "text").join(ids, "doc_id"))
    stars = compact(members.where("doc_id > least").select(
        F.col("least").alias("a"), F.col("doc_id").alias("b")
    ).distinct())
    links = _similar(stars, sketches, texts)
    so_far = connected_components(links)
    placed = members.select("band", "doc_id").join(
        so_far.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left"
    ).select("band", "doc_id", F.coalesce("component", "doc_id").alias("component"))
    mixed = placed.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    open_docs = placed.join(mixed.where("lo < hi").select("band"), "band").select(
        "doc_id", "component"
    ).distinct()
    more = _links_between(checkpointed(compact(open_docs)), sketches, texts)
    # A doc_id with several texts lies in several classes and links them.
    spans = classes.groupBy("doc_id").agg(F.min("class_id").alias("a"), F.max("class_id").alias("z"))
    bridges = classes.join(spans.where("a < z"), "doc_id").where("class_id > a").select(
        "a", F.col("class_id").alias("b")
    )
    components = connected_components(links.unionByName(more).unionByName(bridges))
    named = classes.groupBy("doc_id").agg(F.min("class_id").alias("class_id"))
    named = named.join(
        components.select(F.col("node").alias("class_id"), "component"), "class_id", "left"
    ).select(F.col("doc_id").alias("_id"), F.coalesce("component", "class_id").alias("component"))
    return found.join(named, F.col("doc_id") == F.col("_id"), "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("component", "doc_id"), F.lit(True)).alias("kept"),
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents that stay, one of each component, with their columns as they were.

    All rows under a doc_id that stays are kept; a null doc_id always stays, as do null, empty and
    blank texts. Columns named like those used here do no harm; an empty table stays empty.
    """
    node = free_name(docs, "gone_id")
    gone = near_duplicates(docs).where("not kept").select(F.col("doc_id").alias(node)).distinct()
    return docs.join(gone, F.col("doc_id") == F.col(node), "left_anti")
