import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, taken string, LOWERED string, _ID long"


def prose(seed, n, vocabulary=3000):
    chance = random.Random(seed)
    syllables = "ka lo mi ter an shu we dor fil gen pra sto".split()
    known = ["".join(chance.choices(syllables, k=chance.randint(1, 3))) for _ in range(vocabulary)]
    return " ".join(chance.choice(known) for _ in range(n))


@pytest.fixture(scope="session")
def rows():
    """Documents with nulls, blanks, copies, ties, near copies, a very long one and odd columns."""
    texts = [prose(i, 60 + i) for i in range(12)]
    texts += [None, "", "   \n\t", "one two", "one two", "ONE two", "123 456 789", "é"]
    texts += [texts[0], texts[0].upper(), texts[1] + " more words follow here", texts[2].replace(" ", "\n")]
    texts += [prose(99, 30_000, 200), "x" * 3000, " ".join(["again and"] * 300)]
    langs = ["en", "de", None]
    found = [
        (i, t, langs[i % 3], f"src{i % 4}" if i % 5 else None, None, "t", "l", 5 - i) for i, t in enumerate(texts)
    ]
    return found


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).cache()


@pytest.fixture(scope="session")
def repeated(spark, rows):
    """Rows repeated whole, one id with two texts, and rows without an id."""
    more = [rows[0], rows[0], (rows[1][0], *rows[2][1:]), (None, *rows[3][1:]), (None, *rows[3][1:]), (None, None, *rows[3][2:])]
    return spark.createDataFrame(rows + more, SCHEMA).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
