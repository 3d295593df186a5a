"""The pipeline against plain versions of its stages, and every registered query on small tables."""

import os
import random
import re

import pytest

import __spark_entry__ as driver
import corpus_pipeline
from tests.llm import brute
from tests.llm.test_text_models import LANGUAGES, tongue

FOLDER = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("corpus"))
    names = list(LANGUAGES)
    rows = [(i, tongue(names[i % 3], i, 60 + i % 30), names[i % 3], f"s{i % 4}" if i % 7 else None, None) for i in range(90)]
    rows += [(100 + i, rows[i][1].upper(), None, "s1", 1) for i in range(5)]
    rows += [(200 + i, rows[i][1] + " ending", None, "s2", 1) for i in range(5, 10)]
    item = tongue("en", 999, 40)
    rows += [(300, tongue("en", 300, 50) + " " + item, "en", "s0", 1), (301, "12 34", "en", "s0", 1), (302, None, None, None, None)]
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item), (2, tongue("de", 998, 40))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows


def test_stages(spark, corpus):
    folder, rows = corpus
    texts = {r[0]: r[1] for r in rows}
    wanted = [{r[0] for r in rows} - {301, 302}]
    wanted.append({i for i in wanted[-1] if i == max(j for j in wanted[-1] if brute.fold(texts[j]) == brute.fold(texts[i]))})
    parts = brute.components([(i, texts[i]) for i in wanted[-1]])
    wanted.append({i for i, (_, component) in parts.items() if component == i})
    wanted.append(wanted[-1] - {300})
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "exact_dedup", "near_dedup", "decontamination", "source_mix"
    ]
    for (name, stage), kept in zip(corpus_pipeline.STAGES, wanted, strict=False):
        docs = corpus_pipeline.stored(stage(spark, docs, folder), name)
        assert docs.columns == columns and {r.doc_id for r in docs.collect()} == kept, name
    mixed = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in mixed} <= wanted[-1]
    sizes = sum(len(brute.words(texts[i])) for i in wanted[-1])
    assert sum(r.taken for r in mixed) == pytest.approx(1.5 * sizes, rel=0.05)
    assert all(0 < r.taken <= 2 * len(brute.words(r.text)) for r in mixed)


def test_empty_corpus(spark, corpus, tmp_path):
    folder, _ = corpus
    nothing = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, folder).count() == 0


def test_one_query_for_each_operator():
    numbers = [int(m[1]) for m in (re.match(r"op(\d+)_", name) for name in driver.queries()) if m]
    assert sorted(numbers) == list(range(1, 14)) and "pipeline" in driver.queries()


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")
def test_planted_passages_are_found(spark):
    """Test items set into other documents, whole and edited, are reported, and few others are."""
    from tillscope.llm.decontamination import contaminated

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    first = [r.text.split() for r in items.orderBy("item_id").limit(12).collect()]
    chance = random.Random(1)
    hosts = [r.text for r in docs.orderBy("doc_id").limit(12).collect()]
    planted = []
    for k, (words, host) in enumerate(zip(first, hosts, strict=True)):
        own = [w for w in words if k < 4 or chance.random() > 0.15]
        planted.append((10_000 + k, host + " " + " ".join(own) + " " + host))
    found = contaminated(spark.createDataFrame(planted, "doc_id long, text string").unionByName(docs.select("doc_id", "text")), items)
    got = {(r.doc_id, r.item_id) for r in found.collect()}
    assert {(10_000 + k, k) for k in range(12)} <= got
