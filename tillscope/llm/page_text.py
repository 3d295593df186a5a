"""Main text of web pages by the maximum-scoring run of their blocks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.llm.page_parts import Weights, learn, main_text

# Bounds of the sample that weights are learned from: pages, and characters of a page.
TRAIN_PAGES = 1_000
TRAIN_CHARACTERS = 200_000


def fit(pages: DataFrame) -> Weights:
    """Weights from pages that mark their article, which labels their words.

    At most ``TRAIN_PAGES`` are used, those of the smallest hash of page_id and html; pages over
    ``TRAIN_CHARACTERS`` are not used for learning.
    """
    labelled = pages.where(
        F.col("html").rlike("(?i)<(article|main)[\\s>]") & (F.length("html") <= TRAIN_CHARACTERS)
    ).select("html", F.xxhash64("page_id", "html").alias("draw"))
    share = min(1.0, 4.0 * TRAIN_PAGES / max(labelled.count(), 1))
    near = labelled.where(F.col("draw") / F.lit(2.0**63) <= 2 * share - 1)
    return learn([r["html"] for r in near.orderBy("draw", "html").limit(TRAIN_PAGES).collect()])


def extract(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` (code points) of every page.

    Words score by the elements they stand in, with weights learned from pages that mark their
    article; tags cost. The best contiguous run of blocks is the article; parts in it that are
    none of it (forms, adverts, scripts, comments of readers, ...) are left out. Character
    references are decoded, white space in a block becomes one space, blocks are joined by one
    space. Null, empty and wordless pages have an empty text. Rows repeated are extracted each; an
    empty table gives an empty result. Pages of any length are read whole.
    """
    weights = pages.sparkSession.sparkContext.broadcast(fit(pages))

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html or "", weights.value) for html in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(
        extracted, "page_id long, url string, text string, n_chars long"
    )
