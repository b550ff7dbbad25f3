"""The pipeline: its contract, and every stage on its own input."""

import corpus_pipeline
import pytest
from barloom.llm import quality, toxicity
from barloom.llm.queries import QUERIES, table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        made = corpus_pipeline.materialize(stage(spark, docs, SF), "test")
        out.append((name, docs, made))
        docs = made
    return out


def test_names_and_columns(stages):
    assert [name for name, *_ in stages] == ["quality rules", "toxicity", "line dedup", "near duplicates", "packing"]
    for _, docs, made in stages[:-1]:
        assert made.columns == docs.columns == corpus_pipeline.COLUMNS


def test_filters_keep_what_their_operators_keep(spark, stages):
    labels = table(spark, SF, "labels")
    for (_, docs, made), kept in zip(
        stages[:2],
        (lambda d: quality.apply_rules(d, labels).where("kept"), lambda d: toxicity.detect(d, labels).where("predicted = 0")),
    ):
        assert {r.doc_id for r in made.collect()} == {r.doc_id for r in kept(docs).collect()}
        texts = {r.doc_id: r.text for r in docs.collect()}
        assert all(texts[r.doc_id] == r.text for r in made.collect())


def test_later_stages(stages):
    (_, before, lines), (_, _, near), (_, packed_from, packed) = stages[2:]
    texts = {r.doc_id: r.text for r in before.collect()}
    assert {r.doc_id for r in lines.collect()} == set(texts)
    assert all(len(r.text) <= len(texts[r.doc_id]) and r.n_chars == len(r.text) for r in lines.collect())
    assert {r.doc_id for r in near.collect()} <= set(texts)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in packed_from.collect()}


def test_run(spark, stages):
    assert corpus_pipeline.run(spark, SF).count() == stages[-1][2].count()


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
