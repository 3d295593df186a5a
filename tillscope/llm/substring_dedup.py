"""Removing strings of 200 bytes that stand elsewhere too, by suffix arrays of what may repeat.

1. Every string of 200 bytes has an anchor, a 32-byte gram chosen by the string alone, so equal
   strings have equal anchors. Neighbouring strings with one anchor make a run; about one
   row per 70 bytes says which bytes it touches (by hash). Runs whose anchor is unique are done.
2. Runs equal in all their bytes are repeated as a whole. Only anchors with a run that has no
   equal need a closer look: one of each kind of their runs goes on.
3. Their bytes, put together anchor by anchor in pieces of bounded size, are suffix-sorted in two
   stages, and neighbours in that order with a common prefix of 200 bytes are repeated strings.
4. The covered bytes of each document are cut out.

An anchor of very many different runs would not fit a piece. Its strings are counted one by
one, by a hash of their bytes, which any number of tasks can share.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.llm.storage import checkpointed
from tillscope.llm.substrings import LENGTH, Rolling, anchored_runs, repeated_strings, segments
from tillscope.llm.textarrays import utf8

PIECE = 2_000_000
# An anchor with more kinds of runs than this (about 5 MB) is counted string by string.
MAX_RUNS = 20_000
# A key with so many rows, and with so large a share of all, is heavy: its rows are not brought together.
HEAVY_ROWS = 10_000
HEAVY_KEYS = 1_000

# Documents taken from a batch at a time.
ROWS = 256

_RUN = "id long, body int, start long, strings int, anchor long, touched long"
_KEY = ["id", "body"]


def _keyed(docs: DataFrame) -> DataFrame:
    """Texts under a key that equal rows share: the id (a number for null) and a hash of the text."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("id"),
        F.hash("text").alias("body"), F.coalesce("text", F.lit("")).alias("text"),
    )


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        ids, bodies = (batch.column(c).to_numpy() for c in _KEY)
        for first, stop, low, high in segments(offsets):
            start, strings, anchor, touched = anchored_runs(data[low:high], offsets[first + 1 : stop + 1] - low)
            text = np.searchsorted(offsets, start + low, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids[text]), pa.array(bodies[text]), pa.array(start + low - offsets[text]),
                    pa.array(strings.astype(np.int32)), pa.array(anchor.view(np.int64)),
                    pa.array(touched.view(np.int64)),
                ],
                names=[*_KEY, "start", "strings", "anchor", "touched"],
            )


def _bar(total: int) -> int:
    """Number of rows from which on a key is heavy; fewer than ``HEAVY_KEYS + 1`` keys can be."""
    return max(HEAVY_ROWS, -(-total // HEAVY_KEYS))


def _join_heavy(rows: DataFrame, known: DataFrame, keys: list[str], n: str, bar: int) -> DataFrame:
    """Inner join of ``rows`` with ``known``, one row per key, where ``n`` counts the key's rows.

    The rows of a heavy key stay where they are and meet the few heavy keys there, so that no task
    gets all of them; the others are shuffled.
    """
    heavy = F.broadcast(known.where(F.col(n) >= bar))
    others = rows.join(heavy.select(*keys), keys, "left_anti").join(known.where(F.col(n) < bar), keys)
    return rows.join(heavy, keys).unionByName(others)


def _shared_runs(runs: DataFrame) -> DataFrame:
    """Runs of anchors that occur more than once, with the number of runs of their anchor."""
    again = checkpointed(runs.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1"))
    return checkpointed(_join_heavy(runs, again, ["anchor"], "n", _bar(runs.count())))


def _candidates(shared: DataFrame) -> DataFrame:
    """Shared runs that are copies as a whole (``copied``) or must be sorted (``sort``), per document."""
    bar = _bar(shared.count())
    kinds = checkpointed(shared.groupBy("anchor", "n", "touched").agg(
        F.count("*").alias("copies"), F.min(F.struct("id", "body", "start")).alias("first")
    ))
    by_anchor = kinds.groupBy("anchor", "n").agg(F.min("copies").alias("least"), F.count("*").alias("kinds"))
    by_anchor = by_anchor.select("anchor", "n", F.when(F.col("least") == 1, F.col("kinds")).alias("kinds"))
    known = checkpointed(_join_heavy(kinds.drop("n"), by_anchor, ["anchor"], "n", bar).drop("n"))
    met = _join_heavy(shared.drop("n"), known, ["anchor", "touched"], "copies", bar)
    marked = met.select(
        *_KEY, "start", "strings", "anchor", (F.col("copies") > 1).alias("copied"),
        (F.col("kinds").isNotNull() & (F.struct("id", "body", "start") == F.col("first"))).alias("sort"),
        (F.col("kinds") > MAX_RUNS).alias("many"),
    )
    return marked.where("copied or sort").groupBy(*_KEY).agg(
        F.collect_list(F.struct(
            "start", "strings", F.when(F.col("sort"), F.col("anchor")).alias("anchor"), "copied", "sort", "many",
        )).alias("runs")
    )


def _few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows, few at a time: as Python objects they take many times their size."""
    for batch in batches:
        for low in range(0, batch.num_rows, ROWS):
            yield batch.slice(low, ROWS)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of the runs that must be sorted."""
    for batch in _few(batches):
        out: list[list] = [[] for _ in range(6)]
        size = 0
        for key, body, text, runs in zip(*(batch.column(c).to_pylist() for c in (*_KEY, "text", "runs")), strict=True):
            data = text.encode()
            for run in runs:
                if run["sort"] and not run["many"]:
                    piece = data[run["start"] : run["start"] + run["strings"] + LENGTH - 1]
                    row = (key, body, run["start"], run["anchor"], run["copied"], piece)
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
                    size += len(piece)
            if size > PIECE:
                yield _slice_batch(out)
                out, size = [[] for _ in range(6)], 0
        yield _slice_batch(out)


def _slice_batch(columns: list[list]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
        names=[*_KEY, "start", "anchor", "copied", "bytes"],
    )


def _sorted_piece(table: pa.Table) -> pa.Table:
    """Strings of the runs of one piece that repeat, as stretches of their documents."""
    table = table.combine_chunks()
    pieces = table.column("bytes").to_pylist()
    text = np.frombuffer(b"".join(pieces), np.uint8)
    lengths = np.array([len(p) for p in pieces], np.int64)
    heads = np.cumsum(lengths) - lengths
    strings = lengths - LENGTH + 1
    row = np.repeat(np.arange(len(pieces)), strings)
    inner = np.arange(len(row)) - np.repeat(np.cumsum(strings) - strings, strings)
    found = repeated_strings(text, heads[row] + inner)
    # Runs that are copies as a whole are settled; they only serve as partners here.
    found &= ~table.column("copied").to_numpy()[row]
    begin = found.copy()
    begin[1:] &= ~(found[:-1] & (row[1:] == row[:-1]))
    first = np.flatnonzero(begin)
    close = found.copy()
    close[:-1] &= ~(found[1:] & (row[1:] == row[:-1]))
    size = np.flatnonzero(close) - first + 1
    return pa.table({
        "id": table.column("id").take(row[first]), "body": table.column("body").take(row[first]),
        "start": pa.array(table.column("start").to_numpy()[row[first]] + inner[first]),
        "strings": pa.array(size.astype(np.int32)),
    })


def _single_strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each string of the anchors with very many runs, by a hash of its bytes."""
    for batch in _few(batches):
        for key, body, text, runs in zip(*(batch.column(c).to_pylist() for c in (*_KEY, "text", "runs")), strict=True):
            wanted = [r for r in runs if r["sort"] and r["many"]]
            if not wanted:
                continue
            rolling = Rolling(np.frombuffer(text.encode(), np.uint8))
            at = np.concatenate([np.arange(r["start"], r["start"] + r["strings"]) for r in wanted])
            sizes = [r["strings"] for r in wanted]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(at), key, np.int64)), pa.array(np.full(len(at), body, np.int32)),
                    pa.array(at), pa.array(np.repeat([r["anchor"] for r in wanted], sizes)),
                    pa.array(rolling.of(at, at + LENGTH).view(np.int64)),
                    pa.array(np.repeat([r["copied"] for r in wanted], sizes)),
                ],
                names=[*_KEY, "start", "anchor", "string", "copied"],
            )


def _repeated_singles(affected: DataFrame) -> DataFrame:
    very_many = affected.where(F.exists("runs", lambda r: r["sort"] & r["many"]))
    each = very_many.select(*_KEY, "text", "runs").mapInArrow(
        _single_strings, "id long, body int, start long, anchor long, string long, copied boolean"
    )
    again = each.groupBy("anchor", "string").count().where("count > 1").drop("count")
    return each.where("not copied").join(again, ["anchor", "string"], "left_semi").select(
        *_KEY, "start", F.lit(1).alias("strings")
    )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes removed, spans removed and the hash of what is left, for documents with candidates."""
    for batch in _few(batches):
        removed, spans, digests = [], [], []
        for text, runs, more in zip(*(batch.column(c).to_pylist() for c in ("text", "runs", "found")), strict=True):
            data = text.encode()
            cover = np.zeros(len(data) + 1, np.int32)
            stretches = [(r["start"], r["strings"]) for r in runs if r["copied"]]
            stretches += [(r["start"], r["strings"]) for r in more or ()]
            for start, strings in stretches:
                cover[start] += 1
                cover[start + strings + LENGTH - 1] -= 1
            gone = np.cumsum(cover[:-1]) > 0
            removed.append(int(gone.sum()))
            spans.append(int((gone[1:] & ~gone[:-1]).sum()) + bool(len(gone) and gone[0]))
            digests.append(hashlib.sha256(np.frombuffer(data, np.uint8)[~gone].tobytes()).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(c) for c in _KEY), pa.array(removed, pa.int64()),
                pa.array(spans, pa.int64()), pa.array(digests, pa.string()),
            ],
            names=[*_KEY, "removed", "spans", "digest"],
        )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """What is left of every document once repeated strings are cut out.

    Columns ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``. A byte goes if a
    string of 200 bytes that covers it starts anywhere else too, in this document or another;
    strings never cross documents and are judged on the input. Null text counts as empty, shorter
    texts lose nothing. A document and its copy both lose what they share. Rows repeated (one
    doc_id, one text) are copies of each other. A null doc_id is a document like any other. An
    empty table gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    texts = _keyed(docs)
    name = uuid.uuid4().hex
    table, run_table = f"repeats_{name}", f"runs_{name}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        # Written, as the runs are read several times and every byte is looked at to find them.
        texts.select(*_KEY, "text").mapInArrow(_runs, _RUN).write.format("parquet").saveAsTable(run_table)
        candidates = _candidates(_shared_runs(spark.table(run_table)))
        # Bucketed by document, so that the texts are shuffled once and not again for the cut.
        (
            texts.select(*_KEY, "text").join(candidates, _KEY).repartition(buckets, *_KEY)
            .write.format("parquet").option("compression", "zstd").bucketBy(buckets, *_KEY).saveAsTable(table)
        )
        affected = spark.table(table)
        slices = affected.select(*_KEY, "text", "runs").mapInArrow(
            _slices, "id long, body int, start long, anchor long, copied boolean, bytes binary"
        )
        size = affected.select(F.explode("runs").alias("r")).where("r.sort and not r.many").agg(
            F.sum(F.col("r.strings") + LENGTH - 1)
        ).first()[0] or 0
        pieces = max(1, -(-size // PIECE))
        found = slices.groupBy(F.pmod("anchor", F.lit(pieces)).alias("piece")).applyInArrow(
            _sorted_piece, "id long, body int, start long, strings int"
        ).unionByName(_repeated_singles(affected))
        found = found.groupBy(*_KEY).agg(F.collect_list(F.struct("start", "strings")).alias("found"))
        cut = affected.join(found, _KEY, "left").select(*_KEY, "text", "runs", "found").mapInArrow(
            _cut, "id long, body int, removed long, spans long, digest string"
        )
        cut = checkpointed(cut.dropDuplicates(_KEY))
    finally:
        for made in (table, run_table):
            spark.sql(f"DROP TABLE IF EXISTS {made}")
    whole = texts.select(
        "doc_id", *_KEY, F.octet_length("text").cast("long").alias("n_bytes"),
        F.sha2("text", 256).alias("whole"),
    )
    return whole.join(cut, _KEY, "left").select(
        "doc_id", "n_bytes", F.coalesce("removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("digest", "whole").alias("kept_sha256"),
    )
