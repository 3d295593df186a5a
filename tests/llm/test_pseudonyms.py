"""Pseudonyms: formats, validity, linkage, and that different values stay different."""

import re
from datetime import date

import pytest

from tillscope.llm.pseudonyms import permuted, pseudonymised
from pyspark.sql import functions as F


def luhn(number):
    digits = [int(c) for c in re.sub(r"\D", "", number)][::-1]
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(digits)) % 10


def iban_ok(value):
    plain = value.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


VALUES = [
    "jo.doe+x@mail1.example.com", "4539578763621486", "4539 5787 6362 1486", "4981021525375367", "217.75.41.129",
    "+1 (437) 555-0689", "(212) 555-1234", "2021-02-28", "31/12/1999", "12.31.1999", "078-05-1120",
    "GB82 WEST 1234 5698 7654 32", "DE89370400440532013000", "b44e15e09fd311c3cf3163b66d5a9875b883d8ce",
]
UNTOUCHED = ["99/99/1999", "2021-13-01", "DE89370400440532013001", "12 words", "300.1.2.3.4.5", "1850-01-01"]


@pytest.fixture(scope="module")
def fresh(spark):
    frame = spark.createDataFrame([(i, f"see {v}, ok") for i, v in enumerate(VALUES + UNTOUCHED)], "doc_id int, text string")
    return {r.doc_id: r.text[4:-4] for r in pseudonymised(frame, "key").collect()}


def test_formats(fresh, spark):
    capitals = spark.createDataFrame([(0, VALUES[-1].upper())], "doc_id int, text string")
    fresh_of_upper = pseudonymised(capitals, "key").first().text
    shape = lambda v: re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub(r"\d", "0", v)))
    for i, value in enumerate(VALUES):
        assert fresh[i] != value
        if "." not in value and len(value) < 40:
            assert shape(fresh[i]) == shape(value)
    for i, value in enumerate(UNTOUCHED, len(VALUES)):
        assert fresh[i] == value
    got = dict(zip(VALUES, fresh.values(), strict=False))
    for card in VALUES[1:4]:
        assert luhn(got[card]) == luhn(card)
    assert all(0 <= int(o) < 256 for o in got["217.75.41.129"].split("."))
    assert iban_ok(got["GB82 WEST 1234 5698 7654 32"]) and iban_ok(got["DE89370400440532013000"])
    assert 1900 <= date.fromisoformat(got["2021-02-28"]).year < 2100
    assert re.fullmatch("[0-9a-f]{40}", got[VALUES[-1]])
    assert fresh_of_upper == got[VALUES[-1]].upper()
    assert got[VALUES[0]].endswith("@mail1.example.com") and got["+1 (437) 555-0689"].startswith("+1 (")


def test_linked_and_rest_unchanged(spark):
    rows = [(1, "A 4539578763621486 b\n4539578763621486!"), (2, "4539578763621486"), (None, None), (3, ""), (3, "é no numbers"), (4, "x" * 100_000 + " 10.0.0.1")]
    frame = spark.createDataFrame([(*r, "t", 1) for r in rows], "doc_id long, text string, found string, n_values int")
    got = pseudonymised(frame, "key").collect()
    value = got[1].text
    assert got[0].text == f"A {value} b\n{value}!" and value != "4539578763621486"
    assert [r.n_values for r in got] == [2, 1, 0, 0, 0, 1]
    assert got[2].text is None and got[3].text == "" and got[4].text == "é no numbers"
    assert got[5].text.startswith("x" * 100_000)
    assert pseudonymised(frame, "other").collect()[1].text != value
    assert pseudonymised(frame.limit(0), "key").count() == 0


def test_permutation(spark):
    """All values of a small format go to different values of the format."""
    got = spark.range(1000).select(permuted(F.lpad(F.col("id").cast("string"), 3, "0"), "k", "t").alias("v")).collect()
    assert len({r.v for r in got}) == 1000 and all(re.fullmatch(r"\d{3}", r.v) for r in got)
