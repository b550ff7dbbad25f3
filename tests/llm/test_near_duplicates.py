"""Operators 6, 7 and 9 against brute force."""

import random
import re
import struct

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from barloom.llm import components, line_dedup, neighbours, simhash
from barloom.llm.components import connected_components


def groups(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    random.seed(1)
    links = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 140)] + [tuple(random.sample(range(200, 260), 2)) for _ in range(50)]
    random.shuffle(links)
    edges = spark.createDataFrame([*links, (5, 5), (None, 3)], "a long, b long")
    got = {r.node: r.component for r in connected_components(edges, "a", "b").collect()}
    assert got == groups({n for link in links for n in link}, links)
    assert connected_components(edges.limit(0), "a", "b").count() == 0


@pytest.mark.parametrize("few", [components.FEW, 0])
def test_few_edges_are_not_shuffled_in_rounds(spark, monkeypatch, few):
    monkeypatch.setattr(components, "FEW", few)
    plans = []
    plain = components.materialize

    def watched(frame, label):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return plain(frame, label)

    monkeypatch.setattr(components, "materialize", watched)
    links = [(k, k + 1) for k in range(40)] + [(50, k) for k in range(51, 60)] + [(60, 59)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert got == groups({n for link in links for n in link}, links)
    assert len(plans) > 2 and any("Exchange hash" in p for p in plans[1:]) == (few == 0)


def plain_print(text, size):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    runs = [b" ".join(words[k : k + size]) for k in range(len(words) - size + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def test_fingerprints_and_components(spark, odd_docs, odd_rows, no_docs):
    got = simhash.components(odd_docs).collect()
    prints = sorted((str(r[0]), f"{plain_print(r[1], 3):016x}") for r in odd_rows)
    assert sorted((str(r.doc_id), r.fingerprint) for r in got) == prints
    spark_hash = spark.sql("select xxhash64('one two three') as h").first().h % (1 << 64)
    assert spark_hash == xxhash.xxh64_intdigest(b"one two three", 42)
    assert simhash.components(no_docs).count() == 0
    clash = odd_docs.selectExpr("*", "1 as own_id", "2 as k1", "3 as k2")
    kept = simhash.keep_first(clash)
    ids = [r.doc_id for r in kept.collect()]
    stay = [(r.doc_id, r.text) for r in kept.collect()]
    assert kept.columns == clash.columns and {0, 4, None} <= set(ids) and not {1, 2} & set(ids)
    assert len(stay) == len(set(stay)), "repeated rows once"
    assert simhash.keep_first(no_docs).count() == 0


def test_one_document_of_each_component_stays(spark):
    random.seed(8)
    rows = [(k, " ".join(random.choices("abcdefgh", k=40))) for k in range(80)]
    rows += [(100 + k, t) for k, t in rows[:30]] + [(200 + k, t + " end") for k, t in rows[:30]] + [(3, rows[3][1]), (4, rows[9][1])]
    prints = [(i, plain_print(t, 3)) for i, t in rows]
    links = [(a, b) for k, (_, a) in enumerate(prints) for _, b in prints[k + 1 :] if (a ^ b).bit_count() <= 2]
    found = groups({p for _, p in prints}, links)
    smallest = {}
    for i, p in prints:
        smallest[found[p]] = min(i, smallest.get(found[p], i))
    got = [r.doc_id for r in simhash.keep_first(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(got) == sorted(smallest.values())


@pytest.mark.parametrize("crowded", [simhash.CROWDED, 3])
def test_links_of_planted_fingerprints(spark, monkeypatch, crowded):
    monkeypatch.setattr(simhash, "CROWDED", crowded)
    random.seed(crowded)
    prints = {random.getrandbits(64) for _ in range(150)}
    for base in list(prints)[:40]:
        for flips in (1, 2, 2, 3):
            near = base
            for bit in random.sample(range(64), flips):
                near ^= 1 << bit
            prints.add(near)
    base = random.getrandbits(64)
    prints |= {base ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(20)}  # a crowd
    signed = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    found = [(r.a, r.b) for r in simhash.links(frame).collect()]
    true = [(a, b) for k, a in enumerate(signed) for b in signed[k + 1 :] if ((a ^ b) % (1 << 64)).bit_count() <= 2]
    assert set(found) <= set(true) | {(b, a) for a, b in true}
    assert groups(signed, found) == groups(signed, true)


def plain_norm(line):
    """Words in lower case; single characters of MARKS and white space separate them."""
    return " ".join(re.split(rf"[ {line_dedup.MARKS}]+", line.lower())).strip()


def plain_blocks(words):
    """The SimHash by its definition, word by word and bit by bit."""

    def place(word, number):
        h = xxhash.xxh64_intdigest(struct.pack("<i", number // 4), xxhash.xxh64_intdigest(word.encode(), 42))
        turn = 16 * (number % 4)
        h = (h << turn | h >> (64 - turn)) % (1 << 64)
        h = h % (1 << 63)
        return h - (1 << 63) if len(word) >= line_dedup.LONG_WORD else h

    out = []
    for k in range(line_dedup.BLOCKS):
        first = [min(place(w, line_dedup.FEATURES * k + j) for w in words) for j in range(line_dedup.FEATURES)]
        out.append(sum(1 << bit for bit in range(64) if sum(f >> bit & 1 for f in first) >= 2))
    return out


def word_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def similar(a, b):
    return 5 * word_distance(a, b) <= max(len(a), len(b))


def plain_line_groups(lines):
    """The definition, over all pairs of distinct normalised lines."""
    norm = {}
    for place, line in lines:
        text = plain_norm(line)
        if text:
            norm.setdefault(text, []).append(place)
    texts = sorted(norm)
    words = {t: t.split() for t in texts}
    blocks = {t: plain_blocks(words[t]) for t in texts}
    links = []
    for k, a in enumerate(texts):
        for b in texts[k + 1 :]:
            long_ = min(len(words[a]), len(words[b])) >= line_dedup.MIN_WORDS
            if long_ and any(x == y for x, y in zip(blocks[a], blocks[b])) and similar(words[a], words[b]):
                links.append((a, b))
    found = groups(texts, links)
    members = {}
    for text, places in norm.items():
        members.setdefault(found[text], []).extend(places)
    return {p for places in members.values() for p in places if p != min(places)}, len(links)


def planted_lines(seed):
    random.seed(seed)
    words = ["".join(random.choices("abcdefghij", k=random.randint(3, 9))) for _ in range(400)]
    base = [random.choices(words, k=random.randint(5, 25)) for _ in range(40)]
    docs = []
    for k in range(120):
        held = []
        for _ in range(random.randint(0, 6)):
            line = list(random.choice(base))
            for _ in range(random.choice([0, 0, 1, 1, 2, 6])):
                line[random.randrange(len(line))] = random.choice(words)
            held.append(random.choice(["{}", "{}.", "  {} !", "({})"]).format(" ".join(line)))
        held += random.choices(["short line", "", "x"], k=2)
        random.shuffle(held)
        docs.append((k, "\n".join(held)))
    return docs


@pytest.mark.parametrize("seed,crowded", [(1, line_dedup.CROWDED), (2, 3), (3, 1)])
def test_line_dedup_is_its_definition(spark, monkeypatch, seed, crowded):
    """Also where nearly every list is crowded."""
    monkeypatch.setattr(line_dedup, "CROWDED", crowded)
    rows = planted_lines(seed)
    gone, n_links = plain_line_groups([((i, pos), line) for i, text in rows for pos, line in enumerate(text.split("\n"))])
    assert n_links > 20
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in line_dedup.dedup_lines(docs, counts=True).collect()}
    for i, text in rows:
        left = [line for pos, line in enumerate(text.split("\n")) if (i, pos) not in gone]
        assert got[i].text == "\n".join(left)
        assert got[i].n_removed == len(text.split("\n")) - len(left)


def test_a_crowd_of_lines(spark):
    """One line in hundreds of versions, on the same postings: chained by small edits."""
    words = [f"w{k}" for k in range(60)]
    rows = []
    for k in range(300):
        line = list(words)
        line[k % 60] = f"x{k}"
        rows.append((k, " ".join(line)))
    gone, _ = plain_line_groups([((i, 0), t) for i, t in rows])
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), counts=True)
    assert {r.doc_id for r in got.where("n_removed > 0").collect()} == {i for i, _ in gone}


def test_a_template_makes_no_pairs(spark, monkeypatch):
    """20,000 lines with the same eight words and six of their own: few comparisons, and only the
    lines that are similar go."""
    random.seed(4)
    word = lambda: "".join(random.choices("abcdefghijklmnop", k=8))
    fixed = "welcome header navigation contact imprint privacy account basket".split()
    rows = [(k, " ".join([*fixed, *(word() for _ in range(6))])) for k in range(20_000)]
    rows += [(k + 50_000, text.rsplit(" ", 1)[0] + " another") for k, text in rows[:50]]
    compared = []
    plain = line_dedup.verified

    def counted(pairs, texts):
        pairs = line_dedup.materialize(pairs, "counted")
        compared.append(pairs.count())
        return plain(pairs, texts)

    monkeypatch.setattr(line_dedup, "verified", counted)
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(8), counts=True)
    gone = {r.doc_id for r in got.where("n_removed > 0").collect()}
    assert gone <= set(range(50_000, 50_050)) and len(gone) >= 45
    assert sum(compared) < 6 * len(rows)


def test_strays_of_a_list_meet_once_and_at_ranks_that_allow_it(spark):
    """Two of the largest group (1 and 2) and strays; a line of 20 words may lack four, one of 18 then two."""
    rows = [(1, 20, 1, 0), (2, 20, 1, 5), (3, 18, 3, 2), (4, 18, 4, 3), (5, 20, 5, 4), (6, 30, 6, 0)]
    frame = spark.createDataFrame([(7, *r[:3], 1, 4, r[3]) for r in rows], "key long, line long, size int, component long, largest long, strays long, rank int")
    pairs = lambda df: sorted(tuple(r) for r in line_dedup.across(df).collect())
    assert pairs(frame.drop("rank")) == [(1, 3), (1, 4), (1, 5), (2, 3), (2, 4), (2, 5), (3, 4), (3, 5), (4, 5)]
    assert pairs(frame) == [(1, 3), (1, 5), (3, 4), (3, 5)]


def test_words_are_one_space_apart(spark):
    """Also in a long text without marks and in runs of all kinds; whole words are passed over at once."""
    random.seed(5)
    texts = ["".join(random.choices("ab éZ  .,;()\t\r\n", k=random.randint(0, 30))) for _ in range(2000)]
    texts += ["word " * 20_000, " ", "", ".", "a", " a", "a ", "a  b", "a ,", ", a", "漢 字. 🙂  x"]
    rows = list(enumerate(texts))
    got = {(r.doc, r.pos): r.norm for r in line_dedup.lines_of(spark.createDataFrame(rows, "id long, t string"), "id", "t").collect()}
    lines = {(i, pos): plain_norm(line) for i, text in rows for pos, line in enumerate(text.split("\n"))}
    assert got == {place: norm for place, norm in lines.items() if norm}


def test_pairs_of_heads_whose_sizes_do_not_fit_meet_one_text_only(spark):
    """Line 1 has ten words; of its list, only line 2 has a size that fits, and its text as well."""
    texts = spark.createDataFrame([(1, "abcdefghij"), (2, "abcdefghix"), (3, "abcde"), (4, "abcdefghijklmno")], "line long, spelled string")
    held = spark.createDataFrame([(7, k, size, 4, 1) for k, size in ((1, 10), (2, 10), (3, 5), (4, 15))], "key long, line long, size int, members long, head long")
    links = line_dedup.with_heads(held, texts)
    assert [tuple(r) for r in links.collect()] == [(1, 2)]
    assert "size" in links._jdf.queryExecution().optimizedPlan().toString()


def test_lists_of_two_lines_whose_sizes_do_not_fit_are_dropped(spark):
    """Of lists 1 (sizes 10 and 13), 2 (10 and 12), 3 (three lines) and 4 (one line)."""
    rows = [(1, 1, 10), (1, 2, 13), (2, 1, 10), (2, 3, 12), (3, 1, 10), (3, 4, 30), (3, 5, 60), (4, 6, 9)]
    got = {tuple(r) for r in line_dedup.shared(spark.createDataFrame(rows, "key long, line long, size int")).collect()}
    assert got == {(2, 1, 10, 2, 1), (2, 3, 12, 2, 1), (3, 1, 10, 3, 1), (3, 4, 30, 3, 1), (3, 5, 60, 3, 1)}


def test_blocks_look_at_long_words_alone_where_there_are_any(spark):
    """Lines with a long word among many short ones, without one, and with long ones alone, some repeated."""
    random.seed(11)
    short, long_ = ["a", "bc", "déf", "ghij", "漢字"], ["klmno", "pqrstu", "vwxyzabc", "ééééé"]
    texts = [" ".join(random.choices(short, k=random.randint(4, 30))) for _ in range(60)]
    texts += [f"{t} {random.choice(long_)} {t}" for t in texts[:40]] + [" ".join(random.choices(long_, k=6)) for _ in range(20)]
    texts += texts[::7]
    lines = line_dedup.lines_of(spark.createDataFrame(list(enumerate(texts)), "id long, t string"), "id", "t").localCheckpoint()
    norms = {r["at"]: r.norm for r in lines.collect()}
    got = {norms[r.line]: (r.times, r["size"], r.blocks) for r in line_dedup.distinct_lines(lines).collect()}
    assert got.keys() == set(texts)
    for text, (times, size, blocks) in got.items():
        n = len(text.split())
        assert (times, size) == (texts.count(text), n if n >= line_dedup.MIN_WORDS else None)
        counted = [w for w in text.split() if len(w) >= line_dedup.LONG_WORD] or text.split()
        if size:
            assert [b % (1 << 64) for b in blocks] == plain_blocks(counted)


def test_words_of_crowded_lists_are_ranked_by_how_rare_they_are(spark):
    """Line 1 comes first, so its words are last; of 10 words three places are posted, of five two."""
    rows = [(7, 1, 10, "abcdefghij"), (7, 2, 10, "abcdefghxy"), (7, 3, 10, "abcdefgxzw"), (7, 4, 5, "abcde"), (7, 5, 5, "xabcd")]
    got = line_dedup.rarest(spark.createDataFrame(rows, "key long, line long, size int, spelled string"))
    wanted = {1: "abc", 2: "yxa", 3: "wzx", 4: "ab", 5: "xa"}  # y, z and w stand in one line each, x in three
    words = spark.createDataFrame([(7, w) for w in "abcdefghijxyzw"], "key long, word string")
    codes = {r.code: r.word for r in words.select(F.xxhash64("key", "word").alias("code"), "word").collect()}
    ranks = {}
    for r in got.collect():
        ranks.setdefault(r.line, {})[r["rank"]] = codes[r["key"]]
    assert {line: "".join(of[k] for k in sorted(of)) for line, of in ranks.items()} == wanted
    assert all(sorted(of) == list(range(len(of))) for of in ranks.values())


def test_new_links_join_groups(spark):
    groups = spark.createDataFrame([(1, 1), (4, 1), (2, 2), (5, 2), (3, 3), (6, 3)], "line long, component long")
    links = spark.createDataFrame([(4, 5), (7, 9), (6, 9)], "a long, b long")
    got = {tuple(r) for r in line_dedup.grown(groups, links).collect()}
    assert got == {(1, 1), (4, 1), (2, 1), (5, 1), (3, 3), (6, 3), (7, 3), (9, 3)}


def test_line_dedup_of_odd_rows(odd_docs, no_docs, odd_rows):
    got = line_dedup.dedup_lines(odd_docs)
    assert got.columns == odd_docs.columns
    texts = {(r.doc_id, r.text) for r in got.collect()}
    assert (0, None) in texts and (1, "") in texts and (None, "an id that is null") in texts
    assert (8, "one two three four five six seven\n") in texts
    clash = odd_docs.selectExpr("*", "1 as __flag", "2 as __gone", "3 as __text", "4 as __doc", "5 as n_lines")
    shown = line_dedup.dedup_lines(clash)
    assert shown.columns == clash.columns and {tuple(r) for r in shown.selectExpr("__flag", "__gone", "__text", "__doc", "n_lines").collect()} == {(1, 2, 3, 4, 5)}
    assert got.count() == len(odd_rows)
    assert line_dedup.dedup_lines(no_docs).count() == 0


def test_line_dedup_stays_native(spark, odd_docs):
    plan = line_dedup.lines_of(odd_docs, "doc_id", "text")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def plain_nearest(rows, k):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(np.array(v, float)).all() and np.any(np.array(v, float))]
    out = {}
    for i, q in ok:
        if i % 20 == 0:
            found = sorted(((-float(v @ q), j) for j, v in ok if j != i and len(v) == len(q)))[:k]
            out[i] = [(j, -s) for s, j in found]
    return out


@pytest.mark.parametrize("block", [neighbours.VECTORS, 150])
def test_neighbours(spark, monkeypatch, block):
    monkeypatch.setattr(neighbours, "VECTORS", block)
    monkeypatch.setattr(neighbours, "QUERIES", max(7, block // 30))
    random_ = np.random.default_rng(3)
    heads = random_.normal(size=(5, 24))
    rows = [(k, (heads[k % 5] + 0.2 * random_.normal(size=24) if k % 3 else 3 * random_.normal(size=24)).astype(np.float32).tolist()) for k in range(1200)]
    rows[31] = (31, rows[32][1])  # a tie
    rows += [(5000, None), (5001, []), (5002, [0.0] * 24), (5003, [float("nan")] * 24), (5004, [float("inf")] + [1.0] * 23), (5005, [None] + [1.0] * 23), (None, [1.0] * 24), (5020, [1.0, 2.0]), (5021, [2.0, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as block", "2 as id", "'x' as vector")
    frame = frame.union(frame.where("vec_id in (40, 41)"))
    got = {}
    for r in neighbours.nearest(frame, F.col("vec_id") % 20 == 0, 20).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(got[r.query_id])
    true = plain_nearest(rows, 20)
    assert set(got) == set(true)
    hits = sum(len({j for j, _ in got[i]} & {j for j, _ in true[i]}) for i in true)
    assert hits >= 0.99 * sum(map(len, true.values()))
    assert got[5020] == [(5021, 4.0)]
    for i, found in got.items():
        scores = dict(true[i])
        assert all(s == pytest.approx(scores[j], abs=1e-12) for j, s in found if j in scores)
    assert neighbours.nearest(frame.limit(0), F.col("vec_id") % 20 == 0).count() == 0
