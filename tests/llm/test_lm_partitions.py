"""The language model depends on the texts, not on how the table is laid out."""

import pytest

from tests.llm.conftest import prose
from tillscope.llm import lm_scoring


@pytest.fixture
def small_tasks(monkeypatch):
    """Tasks small enough that several learn from a small table."""
    monkeypatch.setattr(lm_scoring, "LEAST_TASK_TOKENS", 1_000)
    monkeypatch.setattr(lm_scoring, "TOKENS_A_WORD", 1)


def test_scores_do_not_follow_partitions(spark, small_tasks):
    rows = [(i, prose(i, 40 + i % 90, 400) if i % 11 else None) for i in range(160)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = []
    for parts in (1, 4, 16):
        got = lm_scoring.score_documents(frame.repartition(parts, "doc_id")).collect()
        found.append({r.doc_id: r for r in got})
    assert len(found[0]) == len(rows)
    for other in found[1:]:
        for doc, row in found[0].items():
            assert other[doc].score == pytest.approx(row.score, rel=1e-4)
            assert other[doc].base_score == pytest.approx(row.base_score, rel=1e-9)
            assert other[doc].n_known == row.n_known
