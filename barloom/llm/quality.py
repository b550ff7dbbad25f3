"""Quality rules with risk-controlled thresholds (operator 5).

Every rule compares a rate of the document with a cutoff of its stratum. Cutoffs are taken from a
fixed grid by tests on labelled documents: for a rule and a stratum the cutoffs are tried from the
laxest on, and a cutoff is certified as long as the exact binomial test rejects "more than the
allowed share of good documents is lost" at the level of the test; the first that fails ends the
sequence, so the sequence needs no correction of its own. The level is divided by the number of
sequences (Bonferroni), and the allowed share by the number of rules, so with the stated
confidence no stratum loses more than the allowed share by all rules together. Of the certified
cutoffs the one is used that separates bad from good documents best.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.common import by_text
from barloom.session import materialize

WINDOW = 8
SYMBOLS = b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
#: Strata by number of words: from each bound up to the next.
STRATA = (20, 60, 200, 1000)
#: Cutoffs that are tried, as shares; a document above its cutoff is rejected.
GRID = tuple(round(0.02 * k, 2) for k in range(50, 0, -1))
RULES = {
    "symbols": lambda: F.col("n_symbols") / F.greatest("n_words", F.lit(1)),
    "lines": lambda: F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
    "repeats": lambda: F.col("n_repeat_words") / F.greatest("n_words", F.lit(1)),
}


def repeated_words(ids: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Marks the words inside windows of ``WINDOW`` words that their text holds twice or more.

    Ranks of pairs, then of pairs of pairs, and so on: equal ranks are equal windows, exactly.
    """
    covered = np.zeros(len(ids), bool)
    rank, width = ids.astype(np.int64), 1
    while width < WINDOW:
        if len(rank) <= width:
            return covered
        rank = rank[:-width] * (rank.max() + 1) + rank[width:]
        rank = np.unique(rank, return_inverse=True)[1].astype(np.int64)
        width *= 2
    whole = np.flatnonzero(owner[: len(rank)] == owner[WINDOW - 1 :])
    if not len(whole):
        return covered
    key = rank[whole] * (int(owner[-1]) + 1) + owner[whole]
    _, place, times = np.unique(key, return_inverse=True, return_counts=True)
    begins = whole[times[place] > 1]
    edge = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edge, begins, 1)
    np.add.at(edge, begins + WINDOW, -1)
    return np.cumsum(edge[:-1]) > 0


def measure(texts: list[str]) -> dict[str, list]:
    known: dict[bytes, int] = {}
    ids: list[int] = []
    out: dict[str, list] = {c: [] for c in COUNTS}
    for text in texts:
        data = text.encode()
        words = data.split()  # ASCII white space only, as bytes
        ids += [known.setdefault(w, len(known)) for w in words]
        out["n_words"].append(len(words))
        blanks = sum(map(data.count, (b" ", b"\t", b"\n", b"\v", b"\f", b"\r")))
        out["word_chars"].append(len(text) - blanks)
        out["n_symbols"].append(sum(map(data.count, (SYMBOLS[k : k + 1] for k in range(len(SYMBOLS))))))
        lines = [line for line in data.split(b"\n") if line.strip()]
        out["n_lines"].append(len(lines))
        out["n_dup_lines"].append(len(lines) - len(set(lines)))
    owner = np.repeat(np.arange(len(texts)), out["n_words"])
    marked = repeated_words(np.array(ids, np.int64), owner)
    out["n_repeat_words"] = np.bincount(owner[marked], minlength=len(texts)).tolist()
    return out


def measured(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """Adds the counts of every whole text, base_failed and the stratum."""
    counts = by_text(docs, text_col, keep, [T.StructField(c, T.LongType()) for c in COUNTS], measure)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    stratum = sum((F.col("n_words") >= bound).cast("int") for bound in STRATA)
    return counts.withColumn("base_failed", failed).withColumn("stratum", stratum)


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(at most k of n) for chance p: the regularised incomplete beta function, by its continued
    fraction (modified Lentz)."""
    if k >= n:
        return 1.0

    def fraction(a: float, b: float, x: float) -> float:
        tiny = 1e-300
        c, d = 1.0, 1 - (a + b) * x / (a + 1)
        d = 1 / (d if abs(d) > tiny else tiny)
        value = d
        for m in range(1, 100_000):
            for term in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
                d = 1 + term * d
                c = 1 + term / c
                d = 1 / (d if abs(d) > tiny else tiny)
                c = c if abs(c) > tiny else tiny
                value *= d * c
            if abs(d * c - 1) < 1e-13:
                break
        return value

    a, b, x = n - k, k + 1, 1 - p
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log(p))
    if x < (a + 1) / (a + b + 2):
        return front * fraction(a, b, x) / a
    return 1 - front * fraction(b, a, p) / b


def certify(rows: list[dict], allowed: float, confidence: float) -> dict[tuple[str, int], float]:
    """The cutoff of each (rule, stratum); none certified: no entry, the rule rejects nothing there.

    ``rows``: stratum, quality, n and for each rule and grid place the number above the cutoff.
    """
    share = allowed / len(RULES)
    level = (1 - confidence) / (len(RULES) * (len(STRATA) + 1))
    out = {}
    for stratum in range(len(STRATA) + 1):
        held = {r["quality"]: r for r in rows if r["stratum"] == stratum}
        if 1 not in held:
            continue
        good, bad = held[1], held.get(0)
        for rule in RULES:
            best = None
            for place, cutoff in enumerate(GRID):
                lost = good[f"{rule}_{place}"]
                if binomial_tail(lost, good["n"], share) > level:
                    break
                gain = (bad[f"{rule}_{place}"] / bad["n"] if bad else 0) - lost / good["n"]
                if best is None or gain > best[0] + 1e-12:
                    best = (gain, cutoff)
            if best:
                out[rule, stratum] = best[1]
    return out


def cutoffs(counts: DataFrame, labels: DataFrame, id_col: str, allowed: float, confidence: float) -> dict[tuple[str, int], float]:
    """Certified cutoffs from all labelled documents that pass the base rules."""
    known = labels.select(F.col("doc_id").alias("__id"), "quality").where("quality in (0, 1)").groupBy("__id").agg(F.min("quality").alias("quality"))
    rates = counts.where("not base_failed").select(F.col(f"`{id_col}`").alias("__id"), "stratum", *[make().alias(rule) for rule, make in RULES.items()])
    above = [F.sum((F.col(rule) > cutoff).cast("long")).alias(f"{rule}_{place}") for rule in RULES for place, cutoff in enumerate(GRID)]
    held = rates.join(known, "__id").groupBy("stratum", "quality").agg(F.count("*").alias("n"), *above)
    return certify([r.asDict() for r in held.collect()], allowed, confidence)  # a row per stratum and label


def judged(counts: DataFrame, chosen: dict[tuple[str, int], float]) -> DataFrame:
    """Adds ``kept``."""
    rejected = F.lit(False)
    for (rule, stratum), cutoff in chosen.items():
        rejected = rejected | ((F.col("stratum") == stratum) & (RULES[rule]() > cutoff))
    return counts.withColumn("kept", ~F.col("base_failed") & ~rejected)


def apply_rules(
    docs: DataFrame,
    labels: DataFrame,
    allowed: float = 0.02,
    confidence: float = 0.95,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """Per row: the id (and ``keep``), the counts, base_failed, stratum, kept.

    Null and empty texts have no words and fail the base rules. Without labels no cutoff is
    certified and only the base rules reject. Repeated rows stay; a document whose labels disagree
    counts as bad. Columns of ``keep`` with the name of an output give way to it.
    """
    counts = materialize(measured(docs, [id_col, *(keep or [])], text_col), "quality")
    return judged(counts, cutoffs(counts, labels, id_col, allowed, confidence))
