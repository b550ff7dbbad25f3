"""Operators 2, 4 and 8 against the tokenizer libraries."""

import base64
import random
import zlib
from collections import defaultdict
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from tokenizers import Tokenizer

from barloom.llm import bpe, packing, pretokenize, token_counts
from barloom.llm.queries import BPE_JSON, BPE_RANKS


@pytest.fixture(scope="module")
def library():
    with open(BPE_RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(BPE_JSON)


def test_slices_are_those_of_the_pattern():
    random.seed(3)
    letters = "aé 's'll're'dmtv\n\t 12٣!?,… 　'’ \x85漢\0"
    texts = ["".join(random.choices(letters, k=random.randint(0, 50))) for _ in range(3000)]
    texts += [" " * 700 + "x", "a" * 900 + "'s" * 300, "\n" * 600, "".join(random.choices(letters, k=4000))]
    parts, ends = pretokenize.slices(texts)
    begins = [0, *ends]
    found = [parts[a:b] for a, b in zip(begins, ends)]
    assert found == [regex.findall(public_tokenizers.PATTERN, t) for t in texts]


def test_classes_agree_with_the_tokenizer(tokenizer):
    cut = tokenizer.pre_tokenizer.pre_tokenize_str
    table = pretokenize.classes()
    for point in [*range(0x80, 0x3000), *range(0xA000, 0xAC00), *range(0xF900, 0x10000, 7), *range(0x10000, 0x20000, 23)]:
        if not 0xD800 <= point < 0xE000:
            together = [len(cut(run + chr(point))) == 1 for run in "a1"]
            assert together == [table[point] == pretokenize.LETTER, table[point] == pretokenize.NUMBER], hex(point)


def test_merging_by_scan_and_by_heap(library):
    random.seed(4)
    vocabulary = bpe.from_ranks(BPE_RANKS)
    for _ in range(300):
        word = "".join(random.choices("abcdefghilmnoprstué漢", k=random.randint(1, 70)))
        expected = library.encode_ordinary(word)
        assert vocabulary.scan(word.encode()) == vocabulary.heap(word.encode()) == expected


def test_encode_decode(odd_docs, odd_rows, library):
    got = bpe.encode_decode(odd_docs, BPE_RANKS, with_ids=True).collect()
    assert len(got) == len(odd_rows)
    expected = sorted((str(r[0]), library.encode_ordinary(r[1] or "")) for r in odd_rows)
    assert sorted((str(r.doc_id), r.ids) for r in got) == expected
    texts = defaultdict(list)
    for r in odd_rows:
        texts[r[0]].append((r[1] or "").encode())
    for r in got:
        data = np.array(r.ids, "<u4").tobytes()
        assert (r.n_tokens, r.ids_sha256) == (len(r.ids), sha256(data).hexdigest())
        assert r.decoded_sha256 in {sha256(t).hexdigest() for t in texts[r.doc_id]}
        assert (r.ends[-1] if r.ends else 0) in {len(t) for t in texts[r.doc_id]}


def test_every_token_is_proven_or_merged(odd_docs, odd_rows, tokenizer):
    got = token_counts.count_tokens(odd_docs, BPE_JSON).collect()
    expected = sorted((str(r[0]), len((r[1] or "").encode()), len(tokenizer.encode(r[1] or "", add_special_tokens=False).ids)) for r in odd_rows)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in got) == expected
    assert all(r.over_limit == (r.n_tokens > 512) for r in got)


def plain_best_fit(lengths, window):
    rooms = []
    for length in sorted(lengths, reverse=True):
        fitting = [(room, k) for k, room in enumerate(rooms) if room >= length]
        if fitting:
            rooms[min(fitting)[1]] -= length
        else:
            rooms.append(window - length)
    return sorted(rooms)


@pytest.mark.parametrize("seed", range(12))
def test_grouped_best_fit_is_best_fit(seed):
    random.seed(seed)
    window = random.choice([7, 16, 33, 100])
    lengths = [random.randint(1, window) for _ in range(random.choice([1, 40, 300]))]
    counts = {n: lengths.count(n) for n in lengths}
    plan = packing.best_fit_decreasing(counts, window)
    assert sorted(window - sum(pieces) for windows, pieces in plan for _ in range(windows)) == plain_best_fit(lengths, window)
    used = [n for windows, pieces in plan for n in pieces * windows]
    assert sorted(used) == sorted(lengths)


def test_plan_does_not_grow_with_the_counts():
    random.seed(1)
    counts = {n: random.randint(1, 10**9) for n in range(1, 1025)}
    assert len(packing.best_fit_decreasing(counts, 1024)) < 3 * 1024


def test_pack(odd_docs, odd_rows, tokenizer):
    got = packing.pack(odd_docs, BPE_JSON, window=64).collect()
    expected = sorted((str(r[0]), [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 0]) for r in odd_rows)
    lengths = sorted(min(64, len(ids) - start) for _, ids in expected for start in range(0, len(ids), 64))
    assert sorted(r.length for r in got) == lengths
    pieces = {(str(i), start, zlib.crc32(np.array(ids[start : start + 64], "<u4").tobytes()), len(ids)) for i, ids in expected for start in range(0, len(ids), 64)}
    assert {(str(r.doc_id), r.start, r.ids_crc32, r.doc_tokens) for r in got} == pieces
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    assert sorted(sequences) == list(range(len(sequences)))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 64
    assert len(sequences) == len(plain_best_fit(lengths, 64))


def test_empty_tables(no_docs):
    assert bpe.encode_decode(no_docs, BPE_RANKS).count() == 0
    assert token_counts.count_tokens(no_docs, BPE_JSON).count() == 0
    assert packing.pack(no_docs, BPE_JSON).count() == 0
