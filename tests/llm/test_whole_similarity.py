"""Similar lines against the similarity alone, over all pairs: how many of them are found."""

import random

import pytest

from barloom.llm import line_dedup
from barloom.llm.components import connected_components
from barloom.llm.queries import table
from barloom.session import materialize
from test_near_duplicates import plain_norm, similar


@pytest.mark.parametrize("length,edits,least", [(10, 1, 0.9), (20, 1, 0.95), (30, 2, 0.95), (40, 4, 0.9), (60, 12, 0.5)])
def test_similar_lines_go(spark, length, edits, least):
    """A line and a copy with some words replaced, a hundred times."""
    random.seed(length)
    word = lambda: "".join(random.choices("abcdefghij", k=random.randint(2, 9)))
    texts = []
    for _ in range(100):
        line = [word() for _ in range(length)]
        near = list(line)
        for at in random.sample(range(length), edits):
            near[at] = word()
        texts += [" ".join(line), " ".join(near)]
    got = line_dedup.dedup_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), counts=True)
    gone = {r.doc_id for r in got.where("n_removed > 0").collect()}
    assert gone <= set(range(1, 200, 2)), "of two copies the first stays"
    assert len(gone) >= least * 100


def test_recall_on_the_documents(spark):
    """Of all pairs of lines with the similarity in the documents of sf0.01, 0.95 or more are in one group."""
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    texts = sorted({plain_norm(line) for r in docs.select("text").collect() for line in (r.text or "").split("\n")})
    words = {t: t.split() for t in texts if len(t.split()) >= line_dedup.MIN_WORDS}
    runs, pairs = {}, set()
    for t, held in words.items():
        for k in range(len(held) - 2):
            runs.setdefault(tuple(held[k : k + 3]), set()).add(t)
    for members in runs.values():
        if len(members) < 400:
            pairs |= {(a, b) for a in members for b in members if a < b}

    def possible(a, b):
        longer = max(len(words[a]), len(words[b]))
        left = list(words[b])
        common = sum(w in left and not left.remove(w) for w in words[a])
        return 5 * (longer - common) <= longer

    true = [(a, b) for a, b in pairs if possible(a, b) and similar(words[a], words[b])]
    assert len(true) > 200
    lines = materialize(line_dedup.lines_of(docs, "doc_id", "text"), "lines")
    unique = materialize(line_dedup.distinct_lines(lines), "distinct")
    number = {r.norm: r.at for r in unique.join(lines.select("at", "norm"), unique.line == lines["at"]).collect()}
    assert set(number) == {t for t in texts if t}
    group = {r.node: r.component for r in connected_components(line_dedup.links(unique, lines), "a", "b").collect()}
    found = sum(group.get(number[a], number[a]) == group.get(number[b], number[b]) for a, b in true)
    assert found >= 0.95 * len(true)


def test_short_lines_go_if_they_are_equal(spark):
    docs = spark.createDataFrame([(1, "Read more!\n\n...\nother words"), (2, "read  more\nread most\n..."), (3, "(Other) words\n")], "doc_id long, text string")
    assert {r.doc_id: r.text for r in line_dedup.dedup_lines(docs).collect()} == {1: "Read more!\n\n...\nother words", 2: "read most\n...", 3: ""}


def test_a_null_id_keeps_its_fuzzy_links(spark):
    line = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda omega"
    near = line.replace("kappa", "sigma")
    docs = spark.createDataFrame([(None, line), (1, line), (2, near)], "doc_id long, text string")
    assert {r.doc_id: r.text for r in line_dedup.dedup_lines(docs).collect()} == {None: line, 1: "", 2: ""}
