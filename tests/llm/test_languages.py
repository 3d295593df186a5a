"""Texts that mix languages, and models of few labelled words."""

import numpy as np
import pytest

from tests.llm.test_text_models import LANGUAGES, tongue
from tillscope.llm import language_crf
from tillscope.llm.language_id import identified, predict_languages


@pytest.mark.parametrize("each, words", [(4, 8), (12, 12)])
def test_few_labelled_documents(spark, each, words):
    """A few hundred labelled words are learned from, and no text with letters is rejected."""
    rows = [(i, tongue(lang, i, words), lang) for i, lang in enumerate(list(LANGUAGES) * each)]
    rows += [(500 + i, tongue(lang, 900 + i, 30), None) for i, lang in enumerate(list(LANGUAGES) * 5)]
    rows += [(900, " ".join(tongue(lang, 7, 30) for lang in LANGUAGES), None), (901, "12", None), (902, None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in predict_languages(frame).collect()}
    truth = [lang for lang in list(LANGUAGES) * 5]
    assert np.mean([got[500 + i] == lang for i, lang in enumerate(truth)]) >= 0.8
    assert {r.doc_id for r in identified(frame).collect()} == {r[0] for r in rows} - {901, 902}


def test_every_word_is_trained_on():
    order = np.arange(2 * 2304 + 100)
    found = [at for at in language_crf._sequences(order, 2304)]
    assert np.array_equal(np.concatenate([at.ravel() for at in found]), order)
