"""Language identification by error-correcting output codes (operator 10).

Each language has a codeword; for every bit a binary naive Bayes classifier over hashed character
n-grams tells the languages with a one from those with a zero. A text goes to the codeword with
the smallest loss, each bit weighted by how well its classifier separates. The n-gram counts come
from all training documents and are languages x ``BUCKETS`` numbers, whatever the input.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from functools import cache
from unicodedata import category

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.common import by_text, remainder, ship, steps

BUCKETS = 1 << 14
#: Up to so many languages every split of them is a bit; beyond, random splits.
ALL_SPLITS = 6
SMOOTHING = 0.5
#: Below this lead of the best codeword over the next a text is flagged as ambiguous.
AMBIGUOUS = 0.2
MIX = (np.uint32(2654435761), np.uint32(40503), np.uint32(2246822519))


@cache
def letters() -> np.ndarray:
    return np.array([category(chr(c))[0] == "L" for c in range(sys.maxunicode + 1)])


def hashed(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the 1-, 2- and 3-grams that end at a letter or at a word's end, the position in the
    joined texts before which each text's buckets end, and each text's number of letters.

    Everything but letters counts as one blank, and runs of blanks as one; each text stands between
    blanks, so no n-gram spans two texts.
    """
    joined = " " + "".join(t.lower() + "  " for t in texts)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    letter = letters()[points]
    # lower() may lengthen a text, so its own length counts.
    ends = np.cumsum([len(t.lower()) + 2 for t in texts]) + 1
    points = np.where(letter, points, np.uint32(0))
    kept = letter.copy()
    kept[1:] |= letter[:-1]  # the first blank after a word
    kept[0] = True
    at = np.flatnonzero(kept)
    points = points[at]
    stops = np.searchsorted(at, ends)
    total = np.concatenate(([0], np.cumsum(letter)))[ends]
    one = points * MIX[0]
    before = np.concatenate(([np.uint32(0)], points[:-1]))
    two = one ^ ((before + np.uint32(1)) * MIX[1] * MIX[2])
    first = np.concatenate(([np.uint32(0)], before[:-1]))
    three = two ^ ((first + np.uint32(7)) * MIX[2])
    three = three * MIX[0] + np.uint32(3)
    grams = np.stack([one, two * MIX[2] + np.uint32(2), three], 1)
    grams ^= grams >> np.uint32(15)
    return (grams * MIX[2] >> np.uint32(18)).astype(np.int32), stops, np.diff(np.concatenate(([0], total)))


def count_grams(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    """(lang, bucket, n): every task adds up its own documents, then a sum over tasks."""
    ship(docs.sparkSession)
    source = docs.select(F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            for begin, end in steps(texts):
                grams, stops, _ = hashed(texts[begin:end])
                start = 0
                for k, stop in enumerate(stops.tolist(), begin):
                    held = sums.setdefault(langs[k], np.zeros(BUCKETS, np.int64))
                    held += np.bincount(grams[start:stop].ravel(), minlength=BUCKETS)
                    start = stop
        for lang, held in sums.items():
            some = np.flatnonzero(held)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some)), pa.array(some, pa.int32()), pa.array(held[some])], names=["lang", "bucket", "n"])

    return source.mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def codewords(languages: int) -> np.ndarray:
    """Rows of +1 and -1, all different; complementary columns are left out."""
    if languages <= ALL_SPLITS:
        splits = range(1, 1 << (languages - 1)) if languages > 1 else ()
        bits = [[1 if k == 0 else (1 if not split >> (k - 1) & 1 else -1) for split in splits] for k in range(languages)]
        return np.array(bits, np.float64).reshape(languages, len(splits))
    random = np.random.default_rng(languages)
    width = 10 * math.ceil(math.log2(languages))
    while True:
        code = random.choice([-1.0, 1.0], (languages, width))
        mixed = (np.abs(code.sum(0)) < languages).all()
        if mixed and len(np.unique(code, axis=0)) == languages:
            return code


class Model:
    """Languages, their codewords, and for every bit log-likelihood ratios and a weight."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages, self.code = languages, codewords(len(languages))
        shares = (counts + SMOOTHING) / (counts + SMOOTHING).sum(1, keepdims=True)
        bits = self.code.shape[1]
        self.ratios = np.zeros((BUCKETS, bits), np.float64)
        self.weights = np.zeros(bits)
        for bit in range(bits):
            one, zero = shares[self.code[:, bit] > 0].mean(0), shares[self.code[:, bit] < 0].mean(0)
            self.ratios[:, bit] = np.log(one / zero)
            self.weights[bit] = ((one - zero) * self.ratios[:, bit]).sum()  # how far the halves lie apart
        self.weights /= max(self.weights.sum(), 1e-300)

    def losses(self, grams: np.ndarray) -> np.ndarray:
        """Loss of each codeword for one text's buckets (n-grams x 3)."""
        flat = grams.ravel()
        if len(flat) > BUCKETS // 8:
            sums = np.bincount(flat, minlength=BUCKETS) @ self.ratios
        else:
            sums = self.ratios[flat].sum(0)
        margins = sums / math.sqrt(len(flat))
        return (np.logaddexp(0, -self.code * margins) * self.weights).sum(1)


def fit(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> Model:
    """Counts come to the driver: at most languages x BUCKETS rows."""
    held = count_grams(docs.where(F.col(f"`{lang_col}`").isNotNull()), lang_col, text_col).toPandas()
    languages = sorted(held["lang"].unique())
    counts = np.zeros((len(languages), BUCKETS))
    counts[np.searchsorted(languages, held["lang"]), held["bucket"]] = held["n"]
    return Model(languages, counts)


def predict(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """Adds lang_pred, score (share of the best codeword after softmax), ambiguous."""
    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("ambiguous", T.BooleanType())]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS x bits numbers

    def work(texts: list[str]) -> dict[str, list]:
        held = shared.value
        grams, stops, n_letters = hashed(texts)
        names, scores, unsure = [], [], []
        begin = 0
        for stop, letters_ in zip(stops.tolist(), n_letters.tolist()):
            if not letters_ or not held.languages:
                names.append("und"), scores.append(0.0), unsure.append(True)
            else:
                losses = held.losses(grams[begin:stop])
                weight = np.exp(4 * (losses.min() - losses))
                best = int(losses.argmin())
                rest = np.delete(losses, best)
                names.append(held.languages[best])
                scores.append(float(weight[best] / weight.sum()))
                unsure.append(bool(len(rest) and rest.min() - losses[best] < AMBIGUOUS))
            begin = stop
        return {"lang_pred": names, "score": scores, "ambiguous": unsure}

    return by_text(docs, text_col, keep, fields, work)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Learns from the documents whose crc32 of the id modulo 4 is not 2, predicts all.

    Per row: the id, held_out, lang_pred, score, ambiguous. Texts that are null or have no letter
    are ``und`` with score 0; so are all if there is nothing to learn from. A null id is not held out
    and not learned from. Equal losses go to the language first in order. Repeated rows stay and count
    each time.
    """
    part = remainder(id_col, 4)
    model = fit(docs.where(part != 2), lang_col, text_col)
    keyed = docs.withColumn("held_out", F.coalesce(part == 2, F.lit(False)))
    found = predict(keyed.select(F.col(f"`{id_col}`"), "held_out", F.col(f"`{text_col}`")), model, [id_col, "held_out"], text_col)
    return found.select(F.col(f"`{id_col}`"), "held_out", "lang_pred", "score", "ambiguous")
