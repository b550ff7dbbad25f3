"""Token counts with a shortcut for whole tokens (operator 4).

Before the job, every vocabulary string is merged on its own: those that come out as one token
are proven. In the job a pre-token that is proven counts one; only the others are merged.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from barloom.llm.bpe import CACHE, SHORT, Vocabulary, from_json
from barloom.llm.common import by_text
from barloom.llm.pretokenize import slices


def merged(vocabulary: Vocabulary, data: bytes) -> int:
    """How many tokens merging leaves of a slice."""
    return len(vocabulary.scan(data) if len(data) <= SHORT else vocabulary.heap(data))


def prove(path: str) -> bytes:
    """One bit per id: whether the id's string, as a pre-token, is encoded as that id alone. As
    large as the vocabulary, whatever the input."""
    vocabulary, _ = from_json(path)
    return np.packbits([bool(p) and merged(vocabulary, p) == 1 for p in vocabulary.pieces]).tobytes()


@lru_cache(maxsize=2)
def counter(path: str, proven: bytes) -> tuple[dict[str, int], dict[str, int], Vocabulary, re.Pattern | None]:
    """Counts of the proven strings, an empty cache for the rest, vocabulary and special strings."""
    vocabulary, special = from_json(path)
    bits = np.unpackbits(np.frombuffer(proven, np.uint8))
    counts = {}
    for k in np.flatnonzero(bits).tolist():
        try:
            counts[vocabulary.pieces[k].decode()] = 1
        except UnicodeDecodeError:
            pass  # part of a character: no pre-token is equal to it
    marks = re.compile("|".join(re.escape(s) for s in sorted(special, key=len, reverse=True))) if special else None
    return counts, {}, vocabulary, marks


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit).

    Special strings inside a text count as their one token, as the library has it by default. A
    null text is an empty text: 0 and 0. Repeated rows give repeated rows, an empty table an empty
    one; other columns are not read.
    """
    proven = prove(tokenizer_path)
    fields = [T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())]

    def work(texts: list[str]) -> dict[str, list]:
        counts, rest, vocabulary, marks = counter(tokenizer_path, proven)
        specials = [len(marks.findall(t)) if marks else 0 for t in texts]
        pieces, owners = [], []
        for k, text in enumerate(texts):
            for piece in marks.split(text) if specials[k] else (text,):
                pieces.append(piece)
                owners.append(k)
        parts, ends = slices(pieces)
        found = list(map(counts.get, parts))
        if None in found:
            if len(rest) > CACHE:
                rest.clear()
            for k, n in enumerate(found):
                if n is None:
                    part = parts[k]
                    n = rest.get(part)
                    if n is None:
                        rest[part] = n = merged(vocabulary, part.encode())
                    found[k] = n
        sums = np.concatenate(([0], np.cumsum(found, dtype=np.int64)))
        totals = np.bincount(owners, np.diff(sums[np.concatenate(([0], ends)).astype(np.int64)]), len(texts)).astype(np.int64)
        totals += np.array(specials, np.int64)
        return {"n_bytes": [len(t.encode()) for t in texts], "n_tokens": totals, "over_limit": totals > limit}

    return by_text(docs, text_col, [id_col], fields, work)
