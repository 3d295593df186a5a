"""Language of every document, by a conditional random field over its words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillscope.llm.language_crf import LanguageCrf, train
from tillscope.llm.textarrays import pieces, utf8

# Bounds of the training sample: documents of each language, characters of each document.
TRAIN_DOCUMENTS = 250
TRAIN_CHARACTERS = 4_000
UNKNOWN = "und"


def remainder(modulus: int) -> Column:
    """Remainder of the checksum of doc_id as text, which decides who is held out."""
    return F.crc32(F.col("doc_id").cast("string")) % modulus


def training_sample(docs: DataFrame) -> DataFrame:
    """``lang``, ``text``, ``draw`` of labelled documents that are not held out.

    At most ``TRAIN_DOCUMENTS`` of each language are taken, those of the smallest hash of
    doc_id and text, and of a longer one a stretch of ``TRAIN_CHARACTERS`` at a place the
    hash decides. A first cut by the hash, made where documents are read, leaves several times the
    bound, so only some stretches are shuffled; for it the documents of each language are counted
    (one number for each label of the model).
    """
    usable = F.col("lang").isNotNull() & F.col("text").isNotNull() & (remainder(4) != 2)
    counts = docs.where(usable).groupBy("lang").count().collect()
    if not counts:
        return docs.where(F.lit(False)).select("lang", "text", F.lit(0).cast("long").alias("draw"))
    shares = F.create_map(*[
        F.lit(x) for row in counts for x in (row["lang"], min(1.0, 4.0 * TRAIN_DOCUMENTS / row["count"]))
    ])
    labelled = docs.where(usable).select("lang", "text", F.xxhash64("doc_id", "text").alias("draw"))
    near = labelled.where(F.col("draw") / F.lit(2.0**63) <= 2 * F.element_at(shares, F.col("lang")) - 1)
    spare = F.greatest(F.lit(1), F.length("text") - TRAIN_CHARACTERS + 1)
    stretch = F.substring("text", F.pmod("draw", spare).cast("int") + 1, F.lit(TRAIN_CHARACTERS))
    first = Window.partitionBy("lang").orderBy("draw", "text")
    return (
        near.select("lang", stretch.alias("text"), "draw")
        .withColumn("place", F.row_number().over(first))
        .where(F.col("place") <= TRAIN_DOCUMENTS).drop("place")
    )


def fit(docs: DataFrame) -> LanguageCrf:
    """Model from the training sample, which is bounded for each language."""
    rows = sorted(training_sample(docs).collect(), key=lambda r: (r["lang"], r["draw"]))
    return train([r["text"] for r in rows], [r["lang"] for r in rows])


def predict_languages(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score`` of every document.

    The prediction is the language that most words of the whole text are expected to be in, the
    score its share. ``und`` with score 0 goes to null texts, texts without a letter, and to all
    when nothing could be learned. Ties go to the first language by name. Held out are ids
    whose checksum leaves 2 when divided by 4; a null doc_id is neither held out nor learned from.
    Rows repeated are predicted each; an empty table gives an empty result.
    """
    model = docs.sparkSession.sparkContext.broadcast(_parts(fit(docs)))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crf = LanguageCrf(*model.value)
        for batch in batches:
            for part, names, scores in _named(crf, batch):
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), part.column("held_out"),
                        pa.array(names, pa.string()), pa.array(scores),
                    ],
                    names=["doc_id", "held_out", "lang_pred", "score"],
                )

    held_out = F.coalesce(remainder(4) == 2, F.lit(False))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), "text"
    ).mapInArrow(predict, "doc_id long, held_out boolean, lang_pred string, score double")


def _parts(model: LanguageCrf) -> tuple:
    return model.labels, model.weights, model.moves


def _named(crf: LanguageCrf, batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Pieces of a batch with the language and score of each row's ``text``."""
    labels = np.array([*crf.labels, UNKNOWN], dtype=object)
    texts = batch.column("text")
    for start, stop, _, _ in pieces(*utf8(texts)):
        shares = crf.document_shares(texts.slice(start, stop - start))
        # A column for "none" wins where there are no words to share out.
        shares = np.column_stack([shares, np.zeros(stop - start)])
        blank = np.isnan(shares).any(axis=1) | (not crf.labels)
        best = np.where(blank, len(crf.labels), np.nan_to_num(shares).argmax(axis=1))
        scores = np.where(blank, 0.0, np.minimum(np.nan_to_num(shares).max(axis=1), 1.0))
        yield batch.slice(start, stop - start), labels[best], scores


def identified(docs: DataFrame) -> DataFrame:
    """Documents in identifiable languages, columns as they were; the others are rejected.

    Rejected are those ``predict_languages`` calls ``und``: null texts and texts without a letter.
    Texts that mix languages stay, however evenly. Where no document is labelled, nothing can be
    told apart and all documents stay.
    """
    fitted = fit(docs)
    if not fitted.labels:
        return docs
    model = docs.sparkSession.sparkContext.broadcast(_parts(fitted))

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crf = LanguageCrf(*model.value)
        for batch in batches:
            for part, names, _ in _named(crf, batch):
                yield part.filter(pa.array(names != UNKNOWN))

    return docs.mapInArrow(sift, docs.schema)
