"""Decontamination: passages many documents share, and matches of long and short items."""

from tests.llm.conftest import prose
from tillscope.llm.decontamination import clean, contaminated


def found(spark, texts, items):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in contaminated(docs, benchmark).collect()}
    assert {r.doc_id for r in clean(docs, benchmark).collect()} == set(range(len(texts))) - {d for d, _ in got}
    return got


def test_common_passages_are_found_too(spark):
    """Whether a document is reported does not depend on how many others quote the same."""
    item = prose(1, 40)
    quote = " ".join(item.split()[:18])
    texts = [f"{prose(100 + i, 30)} {quote} {prose(400 + i, 30)}" for i in range(200)] + [item, prose(3, 50)]
    assert found(spark, texts, [item]) == {(i, 0) for i in range(201)}


def test_long_and_short_items(spark):
    """A long passage of a long item is a match, a lone trigram of a short item is none."""
    long, middle = prose(5, 300), prose(6, 40)
    short, tiny = "what is the tallest mountain of europe", "who wrote hamlet"
    texts = [
        f"{prose(7, 90)} {' '.join(long.split()[120:220])} {prose(8, 90)}",
        f"{prose(9, 50)} {' '.join(middle.split()[10:25])} {prose(10, 50)}",
        f"{prose(11, 50)} {' '.join(middle.split()[10:20])} {prose(12, 50)}",
        f"{prose(13, 50)} what is the {prose(14, 50)}",
        f"{prose(15, 50)} what is the tallest mountain of europe {prose(16, 50)}",
        f"{prose(17, 50)} what is the highest mountain of europe {prose(18, 50)}",
        f"{prose(19, 50)} who wrote hamlet {prose(20, 50)}",
    ]
    assert found(spark, texts, [long, middle, short, tiny]) == {(0, 0), (1, 1), (4, 2), (6, 3)}
