"""Alignment of the tokens that two tokenizers cut the same texts into.

1. Inside a task, Arrow columns hold the tokens of many texts at once. Lists are flattened with
   their parents' numbers, a running sum within each text gives the byte where a token ends, and a
   hash join on (text, end) finds the bytes where tokens of both end. These cut both token
   sequences into groups; the tokens of a group are linked, each of one side to each of the other.
2. A document leaves its task as a few numbers and its distinct pairs of ids with how often each is
   linked. This table is written once, so nothing is tokenized twice.
3. How many documents hold a pair is counted by task with ``Table.group_by``, and the partial counts
   are summed by Spark. Each document's pairs then meet the counts in a join, which sends the counts
   to all tasks only when they have been counted to be few.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillscope.llm.storage import checkpointed, stored
from tillscope.llm.textarrays import pieces, utf8

TOKENIZERS = "/opt/tokenizers"
BYTE_LEVEL = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"

# Fixed value: how byte-level tokenizers cut a text before they merge bytes.
BYTE_LEVEL_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Pairs of linked tokens that are listed at once in a task.
LISTED = 1 << 21
#: Distinct pairs a task holds before it hands its partial counts on.
HELD = 1 << 21
#: Counted pairs that are sent to all tasks; more than these are joined by shuffling.
BROADCAST_ROWS = 1 << 21


class Vocabulary:
    """Bytes and decimal texts of a tokenizer's ids, and its encoder of many texts at once."""

    def __init__(self, tokens: list[bytes], encode: Callable[[list[str]], list]):
        self.size = len(tokens)
        self.tokens = pa.array(tokens, pa.large_binary())
        self.lengths = pc.binary_length(self.tokens)
        self._encode = encode

    def ids(self, texts: list[str]) -> pa.ListArray:
        found = self._encode(texts)
        offsets = np.cumsum([0, *map(len, found)], dtype=np.int64)
        flat = np.fromiter(chain.from_iterable(found), np.int32, offsets[-1])
        return pa.LargeListArray.from_arrays(pa.array(offsets), pa.array(flat))


def byte_level(data: bytes) -> Vocabulary:
    """A byte-level tokenizer, read from its JSON file.

    Its entries write each byte as a printable character. The merges are run by a faster encoder
    that takes the ids for their order; a file for which that does not hold is refused.
    """
    file = json.loads(data)
    model, cut = file["model"], file["pre_tokenizer"] or {}
    if file["normalizer"] or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or model["type"] != "BPE":
        raise ValueError("not a plain byte-level tokenizer")
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
    special = {entry["content"] for entry in file["added_tokens"]}
    ranks = {bytes(byte_of[c] for c in entry): i for entry, i in model["vocab"].items() if entry not in special}
    merges = [merge.split(" ") if isinstance(merge, str) else merge for merge in model["merges"]]
    order = [model["vocab"]["".join(merge)] for merge in merges]
    if order != sorted(order) or len(order) + 256 != len(ranks):
        raise ValueError("the ids of the byte-level tokenizer are not in the order of its merges")
    encoder = tiktoken.Encoding("byte_level", pat_str=BYTE_LEVEL_WORDS, mergeable_ranks=ranks, special_tokens={})
    tokens = [b""] * (max([*ranks.values(), *model["vocab"].values()]) + 1)
    for token, i in ranks.items():
        tokens[i] = token
    return Vocabulary(tokens, lambda texts: [encoder.encode_ordinary(f" {text}") for text in texts])


def piece_level(data: bytes) -> Vocabulary:
    """A tokenizer of pieces with byte fallback, which puts the leading space itself."""
    model = sentencepiece.SentencePieceProcessor(model_proto=data)

    def token(i: int) -> bytes:
        piece = model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()

    return Vocabulary(
        [token(i) for i in range(model.get_piece_size())], lambda texts: model.encode(texts, num_threads=1)
    )


class Alignment:
    """Tokens of both kinds of a few texts, cut into groups."""

    def __init__(self, a: Vocabulary, b: Vocabulary):
        self.a, self.b = a, b
        numbers = [str(i) for i in range(max(a.size, b.size))]
        # Every id as it stands inside and at the end of its side of a group, and at a text's end.
        signs = [(a, ","), (a, "|"), (b, ","), (b, ";"), (b, "")]
        self.written = pa.array([f"{n}{sign}" for v, sign in signs for n in numbers[: v.size]], pa.large_string())

    @staticmethod
    def _flat(vocabulary: Vocabulary, ids: pa.ListArray) -> pa.Table:
        """A row for each token: its text, its id, and the byte of the text where it ends."""
        token, text = pc.list_flatten(ids), pc.list_parent_indices(ids)
        running = pc.cumulative_sum(pc.cast(vocabulary.lengths.take(token), pa.int64()))
        before = pa.concat_arrays([pa.array([0], pa.int64()), running]).take(ids.offsets[:-1])
        return pa.table({"text": text, "end": pc.subtract(running, before.take(text)), "token": token})

    @staticmethod
    def _same(vocabulary: Vocabulary, flat: pa.Table, ids: pa.ListArray, wanted: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Of each text, whether its tokens' bytes are the wanted ones."""
        joined = vocabulary.tokens.take(flat["token"].combine_chunks())
        ends = np.frombuffer(joined.buffers()[1], np.int64)[: len(joined) + 1]
        data = np.frombuffer(joined.buffers()[2] or b"", np.uint8)
        mine = ends[ids.offsets.to_numpy()]
        same = np.diff(mine) == np.diff(at)
        if same.all() and np.array_equal(data[mine[0] : mine[-1]], wanted):
            return same
        for i in np.flatnonzero(same):
            same[i] = np.array_equal(data[mine[i] : mine[i + 1]], wanted[at[i] : at[i + 1]])
        return same

    def rows(self, texts: list[str]) -> tuple[list, pa.Table]:
        """Figures of each text, and a table ``text``, ``pair``, ``times`` of its linked pairs of ids."""
        full = [f" {text}" for text in texts if text]
        where = np.flatnonzero([bool(text) for text in texts])
        ids = [v.ids([text for text in texts if text]) for v in (self.a, self.b)]
        wanted, at = utf8(pa.array(full, pa.large_string()))
        sides = [self._flat(v, x) for v, x in zip((self.a, self.b), ids, strict=True)]
        good = np.ones(len(full), bool)
        for v, side, x in zip((self.a, self.b), sides, ids, strict=True):
            good &= self._same(v, side, x, wanted, at)
        kept = pa.array(good)
        sides = [side.filter(kept.take(side["text"].combine_chunks())) for side in sides]
        flat_a, flat_b = (side.append_column("row", pa.array(np.arange(len(side)))) for side in sides)
        both = flat_a.select(["text", "end", "row"]).join(
            flat_b.select(["text", "end", "row"]).rename_columns(["text", "end", "other"]),
            keys=["text", "end"], join_type="inner", use_threads=False,
        )
        cuts = [np.zeros(len(side), bool) for side in (flat_a, flat_b)]
        cuts[0][both["row"].to_numpy()] = True
        cuts[1][both["other"].to_numpy()] = True
        groups = [np.cumsum(cut) - cut for cut in cuts]
        n = int(cuts[0].sum())
        counts = [np.bincount(g, minlength=n) for g in groups]
        starts = [np.concatenate([[0], np.cumsum(c)]) for c in counts]
        text_of = [side["text"].to_numpy() for side in (flat_a, flat_b)]
        group_text = text_of[0][cuts[0]]

        def per_text(index: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
            out = np.zeros(len(texts), np.int64)
            out[where] = np.bincount(index, weights, minlength=len(full)).astype(np.int64)
            return out

        figures = [
            per_text(text_of[0]), per_text(text_of[1]), per_text(group_text),
            per_text(group_text, (counts[0] * counts[1]).astype(float)),
        ]
        tokens = [side["token"].to_numpy().astype(np.int64) for side in (flat_a, flat_b)]
        digests = self._digests(tokens, cuts, groups, starts, figures[0] + figures[1])
        pairs = self._pairs(tokens, groups, counts, starts, group_text, where)
        return [*figures, digests], pairs

    def _digests(self, tokens, cuts, groups, starts, sizes) -> list[str]:
        """SHA-256 of each text's groups, written out; empty where there are no tokens."""
        line = np.empty(len(tokens[0]) + len(tokens[1]), np.int64)
        place_a = np.arange(len(tokens[0])) + starts[1][groups[0]]
        place_b = np.arange(len(tokens[1])) + starts[0][groups[1] + 1]
        line[place_a] = tokens[0] + self.a.size * cuts[0]
        line[place_b] = tokens[1] + 2 * self.a.size + self.b.size * cuts[1]
        ends = np.cumsum(sizes)
        line[ends[sizes > 0] - 1] += self.b.size
        written = self.written.take(pa.array(line))
        at = np.frombuffer(written.buffers()[1], np.int64)[: len(line) + 1]
        data = memoryview(written.buffers()[2] or b"")
        return [
            hashlib.sha256(data[at[stop - size] : at[stop]]).hexdigest() if size else ""
            for size, stop in zip(sizes.tolist(), ends.tolist(), strict=True)
        ]

    def _pairs(self, tokens, groups, counts, starts, group_text, where) -> pa.Table:
        """Linked pairs of ids of each text with their number, listed a bounded number at a time."""
        token_a, group_a, times_a = tokens[0], groups[0], np.ones(len(tokens[0]), np.int64)
        token_b, times_b = tokens[1], np.ones(len(tokens[1]), np.int64)
        count_b, start_b = counts[1], starts[1]
        if (counts[0] * counts[1]).sum() > 16 * (len(token_a) + len(token_b)):
            # Long groups: equal ids of a group are linked alike, so one of them is listed for all.
            token_a, group_a, times_a = _distinct(token_a, group_a)
            token_b, group_b, times_b = _distinct(token_b, groups[1])
            count_b = np.bincount(group_b, minlength=len(counts[1]))
            start_b = np.concatenate([[0], np.cumsum(count_b)])
        repeats = count_b[group_a]
        listed = np.cumsum(repeats)
        found, low = [], 0
        while low < len(token_a):
            done = listed[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(listed, done + LISTED, side="right")))
            times = repeats[low:high]
            left = np.repeat(np.arange(low, high), times)
            first = np.repeat(listed[low:high] - times - done, times)
            right = start_b[group_a[left]] + np.arange(len(left)) - first
            found.append(_summed(pa.table({
                "text": where[group_text[group_a[left]]], "pair": token_a[left] * self.b.size + token_b[right],
                "times": times_a[left] * times_b[right],
            })))
            low = high
        none = pa.table({c: pa.array([], pa.int64()) for c in ("text", "pair", "times")})
        whole = pa.concat_tables(found) if found else none
        return (_summed(whole) if len(found) > 1 else whole).sort_by("text")


def _distinct(token: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ids of each group, groups in order, and how often each occurs there."""
    table = pa.table({"group": group, "token": token}).group_by(["group", "token"], use_threads=False)
    counted = table.aggregate([([], "count_all")]).sort_by("group")
    return tuple(counted[c].to_numpy() for c in ("token", "group", "count_all"))


def _summed(pairs: pa.Table) -> pa.Table:
    grouped = pairs.group_by(["text", "pair"], use_threads=False).aggregate([("times", "sum")])
    return grouped.select(["text", "pair", "times_sum"]).rename_columns(["text", "pair", "times"])


@lru_cache(maxsize=1)
def _alignment(byte_file: bytes, piece_file: bytes) -> Alignment:
    return Alignment(byte_level(byte_file), piece_level(piece_file))


FIGURES = ["n_a", "n_b", "n_groups", "n_links"]


def _aligned(files) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Function that turns batches of ``doc_id``, ``text`` into figures and pairs of each document."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alignment = _alignment(*files.value)
        for batch in batches:
            texts = batch.column("text")
            for start, stop, _, _ in pieces(*utf8(texts)):
                some = [text or "" for text in texts.slice(start, stop - start).to_pylist()]
                (*figures, digests), pairs = alignment.rows(some)
                offsets = pa.array(np.searchsorted(pairs["text"].to_numpy(), np.arange(len(some) + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(start, stop - start), *map(pa.array, figures), pa.array(digests, pa.string()),
                        *[
                            pa.ListArray.from_arrays(offsets, pairs[c].combine_chunks().cast(pa.int32()))
                            for c in ("pair", "times")
                        ],
                    ],
                    names=["doc_id", *FIGURES, "groups_sha256", "pairs", "times"],
                )

    return align


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each pair in a task, in one or a few tables."""
    held = pa.table({"pair": pa.array([], pa.int32()), "n": pa.array([], pa.int64())})
    for batch in batches:
        pair = pc.list_flatten(batch.column("pairs"))
        fresh = pa.table({"pair": pair, "n": np.ones(len(pair), np.int64)})
        held = pa.concat_tables([held, fresh]).group_by("pair", use_threads=False).aggregate([("n", "sum")])
        held = held.select(["pair", "n_sum"]).rename_columns(["pair", "n"])
        if len(held) > HELD:
            yield from held.to_batches()
            held = held.slice(0, 0)
    yield from held.to_batches()


def tokenizer_files(folder: str = TOKENIZERS) -> tuple[bytes, bytes]:
    return tuple((Path(folder) / name).read_bytes() for name in (BYTE_LEVEL, PIECES))


def align_tokens(docs: DataFrame, tokenizers: str = TOKENIZERS) -> DataFrame:
    """How the tokens of a byte-level and a piece tokenizer align in every document.

    Columns: ``doc_id``, ``n_a``, ``n_b`` (tokens), ``n_groups``, ``n_links``, ``n_best`` (links whose pair
    no other pair of the same A id is held by more documents than), ``count_sum`` (documents of its
    pair, over links), ``groups_sha256``. Null and empty texts, and those whose tokens of either kind
    are not the bytes of the text after a space, have no tokens: zeros, and an empty digest. Rows
    repeated are documents of their own. An empty table gives an empty result; other columns are not
    read. ``tokenizers`` is a folder on the driver; its files are sent to the tasks.
    """
    spark: SparkSession = docs.sparkSession
    files = tokenizer_files(tokenizers)
    sizes = _alignment(*files).a.size, _alignment(*files).b.size
    if sizes[0] * sizes[1] >= 1 << 31:
        raise ValueError("pairs of these vocabularies do not fit into 32 bits")
    sent = spark.sparkContext.broadcast(files)
    kinds = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<int>, times array<int>"
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_aligned(sent), kinds)
    # A number of its own tells rows apart that share a doc_id; once written it does not change.
    found = stored(found.withColumn("row", F.monotonically_increasing_id()), "alignment")

    partial = found.select("pairs").mapInArrow(_partial_counts, "pair int, n long")
    counts = checkpointed(partial.groupBy("pair").agg(F.sum("n").alias("n")))
    of_a = F.floor(F.col("pair") / sizes[1]).alias("a")
    most = counts.groupBy(of_a).agg(F.max("n").alias("most"))  # a row for each id, at most
    ranked = checkpointed(counts.withColumn("a", of_a).join(F.broadcast(most), "a").select(
        "pair", "n", (F.col("n") == F.col("most")).alias("best")
    ))
    if ranked.count() <= BROADCAST_ROWS:
        ranked = F.broadcast(ranked)
    links = found.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("link")).select(
        "row", F.col("link.pairs").alias("pair"), F.col("link.times").cast("long").alias("times")
    )
    sums = links.join(ranked, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("n")).alias("count_sum"),
    )
    zero = F.lit(0).cast("long")
    return found.drop("pairs", "times").join(sums, "row", "left").select(
        "doc_id", *FIGURES, F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"),
        "groups_sha256",
    )
