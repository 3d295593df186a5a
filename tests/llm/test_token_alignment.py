"""Token alignment against a plain version that lists every link of every group."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tests.llm.conftest import prose
from tillscope.llm import token_alignment as ta

TRICKY = [
    None, "", " ", "a", "  two  blanks\n\nand\tlines ", "It's I'll WE'VE <|endoftext|> <s> </s> <unk> <0x41>", "▁ ▁x", "naïve café – “quotes” …",
    "漢字かな交じり文 русский текст", "🙂🙃 x\u0000y\u0007  z", "ﬁ ﬀ Å Å ½", "x" * 3000, " " * 500, "\n" * 70, "aaaaaaaab" * 200,
    "éééééééééé" * 40, "1234567890" * 30, "word " * 900, "🙂" * 300,
]


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(f"{ta.TOKENIZERS}/{ta.BYTE_LEVEL}")
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=f"{ta.TOKENIZERS}/{ta.PIECES}")


def tokens(tokenizers, text):
    """Ids and bytes of both kinds; none where they are not the bytes of the text."""
    a, b = tokenizers
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    byte_of = {chr(x if x in printable else next(others)): x for x in range(256)}
    ids_a = a.encode(f" {text}", add_special_tokens=False).ids
    ids_b = b.encode(text)
    bytes_a = [bytes(byte_of[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    wanted = f" {text}".encode()
    if b"".join(bytes_a) != wanted or b"".join(bytes_b) != wanted:
        return [], [], [], []
    return ids_a, bytes_a, ids_b, bytes_b


def groups(tokenizers, text):
    if not text:
        return []
    ids_a, bytes_a, ids_b, bytes_b = tokens(tokenizers, text)
    ends_a, ends_b = (np.cumsum([len(x) for x in side]).tolist() for side in (bytes_a, bytes_b))
    cuts = set(ends_a) & set(ends_b)
    sides = []
    for ids, ends in ((ids_a, ends_a), (ids_b, ends_b)):
        side, group = [], []
        for i, end in zip(ids, ends, strict=True):
            group.append(i)
            if end in cuts:
                side.append(group)
                group = []
        sides.append(side)
    return list(zip(*sides, strict=True))


def expected(tokenizers, rows):
    found = [(i, groups(tokenizers, text)) for i, text in rows]
    links = [Counter((a, b) for left, right in cut for a in left for b in right) for _, cut in found]
    held = Counter(pair for own in links for pair in own)
    best = defaultdict(int)
    for (a, _), n in held.items():
        best[a] = max(best[a], n)
    out = Counter()
    for (i, cut), own in zip(found, links):
        text = ";".join(f"{','.join(map(str, left))}|{','.join(map(str, right))}" for left, right in cut)
        out[
            i, sum(len(left) for left, _ in cut), sum(len(right) for _, right in cut), len(cut), sum(own.values()),
            sum(n for pair, n in own.items() if held[pair] == best[pair[0]]), sum(n * held[pair] for pair, n in own.items()),
            hashlib.sha256(text.encode()).hexdigest() if cut else "",
        ] += 1
    return out


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def found(frame):
    return Counter(tuple(r) for r in ta.align_tokens(frame).select(*COLUMNS).collect())


def test_same_tokens_as_the_files_say(tokenizers):
    """The faster encoder gives the byte-level file's own ids, also for odd characters."""
    a, b = ta.byte_level(ta.tokenizer_files()[0]), ta.piece_level(ta.tokenizer_files()[1])
    chance = random.Random(1)
    odd = ["".join(chr(chance.choice([chance.randint(32, 0x2FFF), chance.randint(0xE000, 0x1FFFF)])) for _ in range(200)) for _ in range(200)]
    texts = [t for t in TRICKY if t] + odd
    assert a.ids(texts).to_pylist() == [e.ids for e in tokenizers[0].encode_batch([f" {t}" for t in texts], add_special_tokens=False)]
    assert b.ids(texts).to_pylist() == tokenizers[1].encode(texts)


def test_equals_plain_version(spark, tokenizers, docs, rows):
    assert found(docs) == expected(tokenizers, [(r[0], r[1]) for r in rows])
    tricky = list(enumerate([*TRICKY, *[prose(i, 50, 40) for i in range(40)]]))
    frame = spark.createDataFrame(tricky, "doc_id long, text string").repartition(5)
    wanted = expected(tokenizers, tricky)
    assert found(frame) == wanted
    assert sum(1 for row in wanted if row[1]) > 40


def test_repeated_rows_and_empty_table(tokenizers, repeated, nothing):
    assert found(repeated) == expected(tokenizers, [(r.doc_id, r.text) for r in repeated.collect()])
    assert found(nothing) == Counter()


def test_join_by_shuffling_gives_the_same(spark, monkeypatch, docs):
    one = found(docs)
    monkeypatch.setattr(ta, "BROADCAST_ROWS", 0)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert found(docs) == one
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("listed", [1, 7, 1 << 21])
def test_long_groups_are_listed_in_pieces(monkeypatch, listed):
    """Two vocabularies that never end at the same byte: one group, whose equal ids are listed once."""
    monkeypatch.setattr(ta, "LISTED", listed)
    ones = ta.Vocabulary([b" ", b"xx", b"x"], lambda texts: [[0, 2, *[1] * ((len(t) - 2) // 2), 2] for t in texts])
    twos = ta.Vocabulary([b" ", b"xy", b"xx"], lambda texts: [[0, *[2] * (len(t) // 2)] for t in texts])
    alignment, text = ta.Alignment(ones, twos), "x" * 200
    (n_a, n_b, n_groups, n_links, _), pairs = alignment.rows([text, "", text])
    assert (n_a.tolist(), n_b.tolist(), n_groups.tolist()) == ([102, 0, 102], [101, 0, 101], [2, 0, 2])
    assert n_links.tolist() == [1 + 101 * 100, 0, 1 + 101 * 100]
    got = {(r["text"], r["pair"]): r["times"] for r in pairs.to_pylist()}
    assert got == {(t, p): n for t in (0, 2) for p, n in ((0, 1), (2 * 3 + 2, 200), (1 * 3 + 2, 9900))}


def test_other_files_are_refused(tmp_path):
    with pytest.raises(ValueError, match="plain byte-level"):
        ta.byte_level((ta.Path(ta.TOKENIZERS) / "word_bpe_49k.json").read_bytes())
