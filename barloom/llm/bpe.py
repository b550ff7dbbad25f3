"""Byte-level BPE: encoding with offsets, and decoding (operator 8).

Texts are cut by the scanner of ``pretokenize``; the slices go through a cache to pair merging.
"""

from __future__ import annotations

import base64
import heapq
import json
from functools import lru_cache
from hashlib import sha256

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from barloom.llm.common import by_text
from barloom.llm.pretokenize import slices

#: Entries after which a task's cache starts anew; only speed depends on it.
CACHE = 400_000
#: Above this many bytes pairs wait in a heap, below a scan is faster.
SHORT = 48


class Vocabulary:
    """Token bytes by rank, with pair merging and its cache."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.pieces: list[bytes] = [b""] * (max(ranks.values(), default=-1) + 1)
        for piece, rank in ranks.items():
            self.pieces[rank] = piece
        self.lengths = np.array([len(p) for p in self.pieces], np.int64)
        self.known: dict[str, bytes] = {}

    def merge(self, data: bytes) -> list[int]:
        """Ids of one slice: the adjacent pair of the lowest rank joins first, ties from the left."""
        ranks = self.ranks
        whole = ranks.get(data)
        if whole is not None:
            return [whole]  # as the library does: a listed slice is not taken apart
        return self.scan(data) if len(data) <= SHORT else self.heap(data)

    def scan(self, data: bytes) -> list[int]:
        ranks = self.ranks
        parts = [data[i : i + 1] for i in range(len(data))]
        pairs = [ranks.get(a + b, 1 << 60) for a, b in zip(parts, parts[1:])]
        while pairs:
            best = min(pairs)
            if best == 1 << 60:
                break
            k = pairs.index(best)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
            del pairs[k]
            if k < len(pairs):
                pairs[k] = ranks.get(parts[k] + parts[k + 1], 1 << 60)
            if k:
                pairs[k - 1] = ranks.get(parts[k - 1] + parts[k], 1 << 60)
        return [ranks[p] for p in parts]

    def heap(self, data: bytes) -> list[int]:
        ranks, n = self.ranks, len(data)
        ends, before = list(range(1, n + 1)), list(range(-1, n))

        def pair(k: int) -> int | None:
            return ranks.get(data[k : ends[ends[k]]]) if ends[k] < n else None

        heap = [(rank, k, k + 2) for k in range(n - 1) if (rank := ranks.get(data[k : k + 2])) is not None]
        heapq.heapify(heap)
        alive = bytearray(b"\1") * n
        while heap:
            _, k, end = heapq.heappop(heap)
            if not alive[k] or ends[k] >= n or ends[ends[k]] != end:
                continue
            alive[ends[k]] = 0
            ends[k] = end
            if end < n:
                before[end] = k
            for at in (before[k], k):
                if at >= 0 and (rank := pair(at)) is not None:
                    heapq.heappush(heap, (rank, at, ends[ends[at]]))
        return [ranks[data[k : ends[k]]] for k in range(n) if alive[k]]

    def packed(self, parts: list[str]) -> list[bytes]:
        """Each slice's ids as little-endian 32-bit integers."""
        known = self.known
        out = list(map(known.get, parts))
        if None in out:
            if len(known) > CACHE:
                known.clear()
            for k, ids in enumerate(out):
                if ids is None:
                    part = parts[k]
                    ids = known.get(part)
                    if ids is None:
                        known[part] = ids = np.array(self.merge(part.encode("utf-8", "replace")), "<u4").tobytes()
                    out[k] = ids
        return out

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids, and the byte offset at which each token ends."""
        ids = np.frombuffer(b"".join(self.packed(slices([text])[0])), "<u4")
        return ids, np.cumsum(self.lengths[ids])

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids.tolist()))


@lru_cache(maxsize=2)
def from_ranks(path: str) -> Vocabulary:
    """A file of lines of base64 token and rank."""
    with open(path, "rb") as lines:
        return Vocabulary({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)})


def byte_letters() -> dict[str, int]:
    """The printable stand-ins for bytes in byte-level vocabulary files: a byte that prints as one
    Latin-1 character is its own, the others follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(0x100 + k): b for k, b in enumerate(rest)}


@lru_cache(maxsize=2)
def from_json(path: str) -> tuple[Vocabulary, dict[str, int]]:
    """The vocabulary of a byte-level BPE file and its special strings, which are matched inside
    texts. Its merges are in the order of its ids, which is checked."""
    with open(path, encoding="utf-8") as file:
        held = json.load(file)
    letters = byte_letters()
    special = {t["content"]: t["id"] for t in held["added_tokens"]}
    ids = held["model"]["vocab"]
    ranks = {bytes(letters[c] for c in token): k for token, k in ids.items() if token not in special}
    merged = [ids["".join(m if isinstance(m, list) else m.split(" "))] for m in held["model"]["merges"]]
    if merged != sorted(merged) or held.get("normalizer") or held["pre_tokenizer"]["add_prefix_space"]:
        raise ValueError(f"{path}: not a plain byte-level BPE file in the order of its merges")
    return Vocabulary(ranks), special


def encode_decode(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Encodes every whole text and decodes the ids again.

    Columns: the id, n_tokens, ids_sha256, decoded_sha256; with ``with_ids`` also ``ids`` and
    ``ends`` (the byte offset at which each token ends). A null text is an empty text: no tokens.
    Repeated rows give repeated rows, an empty table an empty one; other columns are not read.
    """
    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    if with_ids:
        fields += [T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("ends", T.ArrayType(T.LongType()))]

    def work(texts: list[str]) -> dict[str, list]:
        vocabulary = from_ranks(ranks_path)
        parts, counts = slices(texts)
        packed = vocabulary.packed(parts)
        out: dict[str, list] = {f.name: [] for f in fields}
        begin = 0
        for end in counts:
            data = b"".join(packed[begin:end])
            ids = np.frombuffer(data, "<u4")
            begin = end
            out["n_tokens"].append(len(ids))
            out["ids_sha256"].append(sha256(data).hexdigest())
            out["decoded_sha256"].append(sha256(vocabulary.decode(ids)).hexdigest())
            if with_ids:
                out["ids"].append(ids.tolist())
                out["ends"].append(np.cumsum(vocabulary.lengths[ids]).tolist())
        return out

    return by_text(docs, text_col, [id_col], fields, work)
