"""Merkle manifest, whitening and exact dedup against plain computations in Python."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.llm import exact_dedup, merkle, whitening


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# -- exact dedup --------------------------------------------------------------------------


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def grouped(rows):
    """(id, keep, size, sha) of every row, and how many rows of a text are kept."""
    groups = {}
    for row in rows:
        groups.setdefault(plain(row[1]), []).append(row[0])
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        out += [(i, min(known) if known else None, len(ids), sha(text)) for i in ids]
    return out


def check_groups(got, rows):
    def key(t):
        return tuple((v is None, v) for v in t)

    assert sorted(((r[0], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got), key=key) == sorted(grouped(rows), key=key)
    kept = [r["text_sha256"] for r in got if r["kept"]]
    assert len(kept) == len(set(kept)) == len({plain(r[1]) for r in rows})
    assert all(r[0] == r["keep_id"] for r in got if r["kept"])


def test_odd_rows_are_grouped(odd_docs, odd_rows):
    got = exact_dedup.deduplicate(odd_docs).collect()
    assert got[0].asDict().keys() == {"doc_id", "keep_id", "group_size", "kept", "text_sha256"}
    check_groups(got, odd_rows)


def test_no_rows(no_docs):
    assert exact_dedup.deduplicate(no_docs).count() == 0


@pytest.mark.parametrize("bits", [3, 10, 64])
def test_hashes_that_collide_make_no_wrong_group(spark, bits):
    words = "river stone  lamp\tdoor\n cloud".split(" ")
    rng = np.random.default_rng(bits)
    texts = [" ".join(words[k] for k in rng.integers(0, len(words), size)) for size in rng.integers(1, 1500, 60)]
    # The same text with other white space, with a changed end, with a word less in the middle.
    texts += [t.replace(" ", "\r\n \t") for t in texts[:30]] + [t + "." for t in texts[:10]] + [t[: len(t) // 2] + t[len(t) // 2 + 7 :] for t in texts[:10]]
    texts += [" " + texts[0], texts[0] + "\v", texts[1], None, "", " "]
    rows = list(enumerate(texts)) + [(5, texts[5]), (None, texts[6]), (None, "alone")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    check_groups(exact_dedup.deduplicate(docs, bits=bits).collect(), rows)


def test_chunks_are_those_of_the_content():
    rng = np.random.default_rng(1)
    text = bytes(rng.integers(97, 123, 60_000, np.uint8))
    chunks = exact_dedup.chunks_of([text])[0]
    assert b"".join(chunks) == text
    assert all(exact_dedup.LEAST <= len(c) <= exact_dedup.MOST for c in chunks[:-1])
    shifted = exact_dedup.chunks_of([b"another text", b"a few bytes more " + text])[1]
    assert len(set(chunks) & set(shifted)) >= len(chunks) - 3
    assert exact_dedup.chunks_of([b""]) == [[]]


# -- Merkle manifest ----------------------------------------------------------------------


def climb(hashes):
    """(root, for every leaf its steps (before, after)) of a tree with runs of eight."""
    paths, own = [[] for _ in hashes], [[k] for k in range(len(hashes))]
    while len(hashes) > 1:
        above, owners = [], []
        for b in range(0, len(hashes), 8):
            run = hashes[b : b + 8]
            above.append(sha("".join(run)))
            owners.append([k for part in own[b : b + 8] for k in part])
            for j in range(len(run)):
                for k in own[b + j]:
                    paths[k].append(("".join(run[:j]), "".join(run[j + 1 :])))
        hashes, own = above, owners
    return hashes[0], paths


def leaf_of(row, text):
    values = (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def expected_manifest(rows):
    langs = {}
    for row in rows:
        langs.setdefault(row["lang"], []).append(row)
    order = sorted(langs, key=lambda k: (k is not None, (k or "").encode()))
    trees = []
    for lang in order:
        members = sorted(langs[lang], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r, r["text"])))
        trees.append((members, *climb([leaf_of(r, r["text"]) for r in members])))
    root, crown = climb([t[1] for t in trees])
    out = []
    for (members, subroot, paths), more in zip(trees, crown):
        for row, path in zip(members, paths):
            path, text = path + more, row["text"]
            if row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 3 == 0 and text is not None:
                text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
            h = leaf_of(row, text)
            for before, after in path:
                h = sha(before + h + after)
            out.append((row["doc_id"], leaf_of(row, row["text"]), subroot, root, sha("".join(a + b for a, b in path)), h, h == root))
    return out


def manifest_of(docs):
    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return merkle.manifest(docs, tampered={"text": F.when(third, merkle.lower_case(F.col("text")))})


def in_order(rows):
    return sorted(rows, key=lambda r: tuple((v is None, v) for v in r))


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("sizes", [[1], [8], [9], [64, 1, 7], [65, 3, 513] + [2] * 9], ids=str)
def test_trees_of_many_shapes(spark, sizes):
    langs = [None, "", "É", "de", "en"] + [f"l{k}" for k in range(10)]
    rows = [dict(doc_id=k * 10 + n, text=f"Text {k} of É{n}", lang=lang, source="s" if n % 3 else None, n_chars=n) for lang, size in zip(langs, sizes) for n, k in enumerate(range(size))]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(7)
    got = manifest_of(docs).drop("path").collect()
    assert in_order(map(tuple, got)) == in_order(expected_manifest(rows))
    assert len({r["verified"] for r in got}) == (2 if len(rows) > 20 else len({r["verified"] for r in got}))


def test_more_levels_than_a_block_has(spark, monkeypatch):
    """With blocks of 64 leaves a group of 5,000 takes three rounds."""
    monkeypatch.setattr(merkle, "LEVELS", 2)
    monkeypatch.setattr(merkle.nested, "__defaults__", (2,))
    monkeypatch.setattr(merkle.leaves, "__defaults__", (2,))
    rows = [dict(doc_id=k, text=f"T{k}", lang="en" if k % 10 else "de", source=None, n_chars=k) for k in range(5000)]
    got = manifest_of(spark.createDataFrame(rows, SCHEMA)).drop("path").collect()
    assert in_order(map(tuple, got)) == in_order(expected_manifest(rows))


def test_manifest_of_odd_rows(spark, odd_rows):
    rows = [dict(doc_id=r[0], text=r[1], lang=r[2], source=r[3], n_chars=r[4]) for r in odd_rows] * 2
    docs = spark.createDataFrame(rows, SCHEMA)
    for name in ("g", "rank", "depth", "hash", "item", "row", "leaf", "block", "path", "id"):
        docs = docs.withColumn(name, F.lit(name))
    assert in_order(map(tuple, manifest_of(docs).drop("path").collect())) == in_order(expected_manifest(rows))
    assert manifest_of(docs.limit(0)).count() == 0


# -- whitening ----------------------------------------------------------------------------


def counted(matrix):
    """Its products, and how many vectors were multiplied."""
    seen = []

    def product(block):
        seen.append(block.shape[1])
        return matrix @ block

    return product, seen


@pytest.mark.parametrize("width,wanted,kind", [(300, 10, "near"), (120, 5, "equal"), (40, 16, "low"), (3, 3, "near"), (1, 1, "near"), (200, 8, "steep")])
def test_largest_eigenpairs(width, wanted, kind):
    rng = np.random.default_rng(width)
    basis = np.linalg.qr(rng.standard_normal((width, width)))[0]
    values = {
        "near": np.linspace(1, 2, width), "equal": np.repeat([3.0, 2.0, 1.0], width // 3),
        "low": np.r_[np.ones(4), np.zeros(max(0, width - 4))], "steep": 10.0 ** -np.linspace(0, 12, width),
    }[kind]
    matrix = (basis * values) @ basis.T
    product, seen = counted((matrix + matrix.T) / 2)
    found, vectors = whitening.largest(product, width, wanted)
    want = np.sort(values)[::-1][:wanted]
    assert np.abs(found - want).max() < 1e-13 * want[0]
    assert np.abs(vectors.T @ vectors - np.eye(wanted)).max() < 1e-12
    assert np.linalg.norm(matrix @ vectors - vectors * found, axis=0).max() < 1e-12 * want[0]
    if kind == "near" and width == 300:
        assert max(seen) <= wanted, "products are of blocks, never of the whole width"


def test_inner_solver_solves(spark):
    """MINRES with as many steps as the matrix is wide solves the projected equation."""
    rng = np.random.default_rng(3)
    a = rng.standard_normal((12, 12))
    a = a + a.T
    outside = np.linalg.qr(rng.standard_normal((12, 2)))[0]
    away = np.eye(12) - outside @ outside.T
    values, residual = np.array([0.3, -1.2]), rng.standard_normal((12, 2))
    steps = whitening.INNER
    try:
        whitening.INNER = 12
        t = whitening.corrections(lambda v: a @ v, values, residual, outside)
    finally:
        whitening.INNER = steps
    for k in range(2):
        left = away @ ((a - values[k] * np.eye(12)) @ (away @ t[:, k])) + away @ residual[:, k]
        assert np.abs(left).max() < 2e-2 and np.abs(outside.T @ t[:, k]).max() < 1e-12


def whitened_by_numpy(rows):
    x = np.array([[int(np.floor(64 * np.float64(c))) + 1_000_000 for c in v] for _, v in rows])
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(0)
    z = (n * fit - sums) / n
    values, vectors = np.linalg.eigh(z.T @ z / n)
    return x, n, sums, values[::-1], vectors[:, ::-1]


def check_whitening(got, rows):
    x, n, sums, values, vectors = whitened_by_numpy(rows)
    k = max(r["component"] for r in got)
    shown = ((n * x - sums) / n) @ vectors[:, :k] / np.sqrt(values[:k])
    assert len(got) == len(rows) * k
    of = {}
    for r in got:
        of.setdefault(r[0], []).append(r)
    place = {i: p for p, (i, _) in enumerate(rows)}
    for component in range(1, k + 1):
        ours = np.array([next(r["whitened"] for r in of[i] if r["component"] == component) for i in place])
        theirs = shown[list(place.values()), component - 1]
        assert min(np.abs(ours - theirs).max(), np.abs(ours + theirs).max()) < 1e-8
    for r in got:
        assert r["n"] == n and r["deviation"] == sum((n * int(c) - int(s)) ** 2 for c, s in zip(x[place[r[0]]], sums))
        assert abs(r["explained"] / (values[r["component"] - 1] / values.sum()) - 1) < 1e-9
        assert r["identity_error"] < 1e-8
    return k


def test_whitening_of_odd_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(k, [float(c) for c in rng.standard_normal(20) * np.arange(1, 21)]) for k in range(120)]
    rows += [(200, rows[3][1]), (None, rows[4][1]), (201, rows[5][1])]
    odd = [(300, None), (301, []), (302, [1.0]), (303, [None] * 20), (304, [float("nan")] * 20), (305, [float("inf")] + [0.0] * 19), (306, [1e300] * 20)]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").selectExpr("*", "'x' as x", "1 as component", "2 as at", "3 as id")
    got = whitening.whiten(frame.repartition(3)).collect()
    assert check_whitening(got, rows) == 16
    assert whitening.whiten(frame.limit(0)).count() == 0
    assert whitening.whiten(frame.where("vec_id in (3, 200)")).count() == 0, "one distinct vector has no variance"


def test_whitening_of_a_flat_table(spark):
    """Vectors that fill three dimensions of eight have three components."""
    rng = np.random.default_rng(6)
    rows = [(k, [float(c) for c in np.r_[rng.integers(-9, 9, 3), np.zeros(5)] / 8]) for k in range(60)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    assert check_whitening(got.collect(), rows) == 3


def test_deviation_beyond_a_long(spark):
    rows = [(k, [float(k) * 1e8, 1.0]) for k in range(50)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), components=1).collect()
    assert {r["deviation"] for r in got} == {None} or all(r["deviation"] is None or r["deviation"] >= 0 for r in got)
    assert max(r["identity_error"] for r in got) < 1e-8
