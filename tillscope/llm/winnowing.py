"""Fingerprints of documents by winnowing, in DataFrame functions alone.

The words of a text give one hash per run of ``GRAM`` words. Of every ``WINDOW`` neighbouring
hashes the smallest is kept, the rightmost of equal ones, with the place it stands at. So two
texts that share ``GRAM + WINDOW - 1`` words in a row share a fingerprint, and no two fingerprints
that follow each other are further apart than a window.

Both the hashes of runs and the minima of windows come by doubling: runs (windows) of 2n are put
together from two of n, so the work on a word grows with the logarithm of their length.

Neighbours in the order of doc_id are found without a global sort of texts: ids alone are
range-partitioned, the first of each part is the one number that crosses parts, and texts then
meet the head of their neighbour in a join by key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillscope.llm.storage import checkpointed

#: Words of a hashed run, and hashes of a window; powers of two.
GRAM = 4
WINDOW = 8

# White space between words, and characters of scripts that put none between words.
_BLANKS = r"[ \t\n\x0B\f\r]+"
_UNSPACED = r"([\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u3040-\u30FF\u3400-\u9FFF\uF900-\uFAFF])"
_PLACES = (1 << 31) - 1


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _shifted(values: Column, by: int) -> Column:
    return F.slice(values, by + 1, F.greatest(F.size(values) - by, F.lit(0)))


def _paired(values: Column, by: int, put: Callable[[Column, Column], Column]) -> Column:
    """Each value put together with the one ``by`` places on; null stands for one past the end."""
    return _let(values, lambda v: F.zip_with(v, _shifted(v, by), put))


def words(text: Column) -> Column:
    """Words between white space, lower-cased.

    In a text of mostly three-byte characters, those of scripts written without spaces are words
    of their own; it would be one long word otherwise.
    """
    dense = F.octet_length(text) >= 2 * F.char_length(text)
    spaced = F.when(dense, F.regexp_replace(text, _UNSPACED, " $1 ")).otherwise(text)
    return F.filter(F.split(F.lower(spaced), _BLANKS), lambda word: word != "")


def gram_hashes(found: Column) -> Column:
    """Hash of the ``GRAM`` words from each word on; all words of a shorter text as one."""
    hashes, width = F.transform(found, lambda word: F.xxhash64(word)), 1
    while width < GRAM:
        hashes = _paired(hashes, width, lambda a, b: F.xxhash64(a, b))
        width *= 2
    # Runs over the end are cut off; hashing skips nulls, so a short text still has one hash.
    return _let(hashes, lambda h: F.slice(h, 1, F.greatest(F.size(h) - (GRAM - 1), F.least(F.size(h), F.lit(1)))))


def _places(hashes: Column) -> Column:
    """Places of the smallest hash of each window, the rightmost of equal ones, in order.

    Hashes compare by their upper half; below it stands the place, counted from the far end, so
    the least of a window is also the rightmost. A text of fewer hashes is one window.
    """
    keyed = F.transform(
        hashes,
        lambda h, place: F.shiftleft(F.shiftrightunsigned(h, 32), 31).bitwiseOR(F.lit(_PLACES) - place.cast("long")),
    )
    least, width = keyed, 1
    while width < WINDOW:
        least = _paired(least, width, lambda a, b: F.least(a, b))
        width *= 2
    windows = _let(least, lambda m: F.slice(m, 1, F.greatest(F.size(m) - (WINDOW - 1), F.least(F.size(m), F.lit(1)))))
    return F.transform(
        F.array_distinct(windows), lambda key: (F.lit(_PLACES) - key.bitwiseAND(F.lit(_PLACES))).cast("int")
    )


def fingerprint(text: Column) -> Column:
    """Array of ``hash``, ``place`` (number of the first word) of a text that is not null."""
    return _let(
        gram_hashes(words(text)),
        lambda hashes: F.transform(
            _places(hashes), lambda place: F.struct(F.get(hashes, place).alias("hash"), place.alias("place"))
        ),
    )


def fingerprint_text(found: Column) -> Column:
    """A fingerprint as text: ``hash@place`` in the order of places, hashes in hexadecimal."""
    return F.array_join(
        F.transform(found, lambda f: F.concat(F.lower(F.hex(f["hash"])), F.lit("@"), f["place"].cast("string"))), ","
    )


def likeness(a: Column, b: Column) -> Column:
    """Share of the hashes of either that both have; 1 if neither has any."""
    both = F.size(F.array_intersect(a, b))
    return _let(both, lambda n: F.coalesce(
        F.try_divide(n.cast("double"), F.size(F.array_distinct(a)) + F.size(F.array_distinct(b)) - n), F.lit(1.0)
    ))


def _hashes(found: Column) -> Column:
    return F.transform(found, lambda f: f["hash"])


def neighbours(nodes: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """``keys`` of each row and, as ``prev_*``, those of the row before it; the first follows the last.

    The rows, which should be narrow, are range-partitioned by ``order`` and kept, so that parts are
    the same however often they are read. Inside a part a window looks back; the last row of each
    part (as many rows as there are parts) is handed on to the next part.
    """
    placed = checkpointed(
        nodes.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    )
    here = F.struct(*keys)
    inside = Window.partitionBy("part").orderBy(*order)
    rows = placed.withColumns({
        "before": F.lag(here).over(inside), "at": F.row_number().over(inside),
    })
    ends = rows.groupBy("part").agg(F.max_by(here, "at").alias("end"))
    parts = Window.orderBy("part")  # one row for each part
    handed = ends.select(
        F.col("part").alias("_part"),
        F.coalesce(F.lag("end").over(parts), F.last("end").over(parts.rowsBetween(0, Window.unboundedFollowing))).alias("handed"),
    )
    joined = rows.join(handed, F.col("part") == F.col("_part"))
    before = F.coalesce("before", "handed")
    return joined.select("*", *[before[k].alias(f"prev_{k}") for k in keys]).drop("before", "at", "handed", "part", "_part")


def fingerprinted(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, of its edited text, and how alike they and the next text's are.

    Columns: ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``,
    ``near_edited``, ``near_next``, ``next_doc_id``. The edited text has its last third replaced by
    as many first characters of the next document (all, if it has fewer); next is the one with
    the next smaller doc_id, and after the last comes the first. Null texts count as empty; an
    empty text has an empty fingerprint, and two such are alike. A null doc_id comes after all others.
    Several texts under one doc_id follow each other in the order of a hash of theirs. Rows that
    repeat both doc_id and text are one document, returned as often as it occurs. A lone document is its own
    next one. An empty table gives an empty result. Other columns are not read. Memory follows the longest text.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("body"))
    # Key without nulls: rows are the same document if both parts are.
    keyed = rows.withColumns({
        "k": F.coalesce("id", F.lit(0).cast("long")), "tie": F.xxhash64(F.col("id").isNull(), F.col("body")),
    })
    # A document repeated very often is one partial row per task before anything is moved.
    once = keyed.select("k", "tie", "id", F.char_length("body").alias("n")).groupBy("k", "tie", "id", "n").agg(
        F.count("*").alias("copies")
    )
    linked = checkpointed(neighbours(once, ["k", "tie", "n"], [F.desc_nulls_last("id"), F.asc("tie")]))
    texts = keyed.select("k", "tie", "body").dropDuplicates(["k", "tie"])

    own = texts.join(linked.select("k", "tie", "id", "n", "copies"), ["k", "tie"])
    third = F.floor(F.col("prev_n") / 3).cast("int")
    following = texts.join(linked.select("k", "tie", "id", "prev_k", "prev_tie", "prev_n"), ["k", "tie"]).select(
        F.col("prev_k").alias("k"), F.col("prev_tie").alias("tie"), F.col("id").alias("next_doc_id"),
        F.substring("body", F.lit(1), third).alias("head"),
        _hashes(fingerprint(F.col("body"))).alias("next_hashes"),
    )
    kept = F.col("n") - F.floor(F.col("n") / 3)
    both = own.join(following, ["k", "tie"]).select(
        "id", "n", "copies", "next_doc_id", "next_hashes", fingerprint(F.col("body")).alias("found"),
        F.concat(F.substring("body", F.lit(1), kept.cast("int")), F.col("head")).alias("edited"),
    )
    both = both.withColumn("edited_found", fingerprint(F.col("edited")))
    result = both.select(
        F.col("id").alias("doc_id"), F.col("n").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint_text(F.col("found")).alias("fingerprint"),
        fingerprint_text(F.col("edited_found")).alias("edited_fingerprint"),
        likeness(_hashes(F.col("found")), _hashes(F.col("edited_found"))).alias("near_edited"),
        likeness(_hashes(F.col("found")), F.col("next_hashes")).alias("near_next"),
        "next_doc_id", "copies",
    )
    return result.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).drop("copy", "copies")
