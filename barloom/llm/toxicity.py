"""Toxic spans by a linear-chain conditional random field (operator 3).

Labels mark documents; tokens are labelled from them: words, and beginnings of words, that are in
toxic training documents far more often than in others mark the tokens of toxic documents (near
copies count once). A two-state chain is trained on these tokens and tags whole texts: forward and
backward messages are products of 2x2 matrices, so tokens of many texts are scanned side by side.
A text's score is a calibrated function of the expected number of its toxic tokens and of its most
toxic one. Spans are runs of tokens with a
marginal of one half or more.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.common import WORD, by_text, remainder

#: The training sample: so many toxic and other documents by hash of the id, of those with at most
#: so many characters.
TOXIC, OTHERS, SAMPLE_CHARS = 600, 2400, 8000
BUCKETS = 1 << 18
ROUNDS, RATE, DECAY = 40, 1.0, 1e-6
#: A word marks tokens if so many toxic documents hold it, and so many times as large a share of
#: them as of the others.
SUPPORT, RATIO = 5, 10.0
#: Beginnings mark tokens if so large a share of the toxic documents holds them, or has nothing else.
FREQUENT, GAIN = 0.03, 0.01
#: Documents are near copies if so many of their ``SKETCH`` smallest hashes of five words are equal.
SKETCH, EQUAL = 16, 5
#: Lengths of word beginnings, in bytes.
STEMS = (3, 4, 5, 6, 7, 8)
THRESHOLD = 0.7
ROW = 128
#: Tokens that one step of a scan or of training works on, a multiple of ``ROW``: training runs on the
#: driver, which has no room for temporary arrays over all tokens.
BLOCK = 512 * ROW
CACHE = 400_000
EDGES = b".,;:!?\"'()[]{}<>|#*$%&-_~`"
# Kinds of features: the word, its beginnings and its end, and what it tells the words beside it.
OWN, STEM, SUFFIX, BEFORE, AFTER = range(5)
OWNED = 2 + len(STEMS)


def bucket(kind: int, data: bytes) -> int:
    return zlib.crc32(data, kind * 0x9E3779B1 & 0xFFFFFFFF) % BUCKETS


def core(word: bytes) -> bytes:
    return word.strip(EDGES) or word


def words(text: str) -> list[bytes]:
    return text.encode().lower().split()


def features(word: bytes) -> tuple[int, ...]:
    """Own features, then the one it gives to the next word and the one it gives to the word before."""
    w = core(word)
    stems = [bucket(STEM, w[:n] + b"^") for n in STEMS]
    return bucket(OWN, w), *stems, bucket(SUFFIX, w[-4:]), bucket(BEFORE, w), bucket(AFTER, w)


def scan(odds: np.ndarray, begins: np.ndarray, start: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Normalised forward messages (n x 2). ``odds``: exp of the score of state 1; ``begins`` marks
    the first token of a text; start: 2 weights; step: 2 x 2 weights, from state to state."""
    out = np.empty((len(odds), 2))
    state = 1.0, 0.0
    for at in range(0, len(odds), BLOCK):
        out[at : at + BLOCK], state = scan_block(odds[at : at + BLOCK], begins[at : at + BLOCK], start, step, state)
    return out


def scan_block(odds: np.ndarray, begins: np.ndarray, start: np.ndarray, step: np.ndarray, state: tuple[float, float]) -> tuple[np.ndarray, tuple[float, float]]:
    """The messages of some tokens and the one after them, from the one before them (``state``)."""
    n = len(odds)
    rows = -(-n // ROW)
    size = rows * ROW
    moves = np.empty((4, size))
    for k, (i, j) in enumerate(((0, 0), (0, 1), (1, 0), (1, 1))):
        moves[k, :n] = np.where(begins, start[j], step[i, j])
        moves[k, n:] = float(i == j)
    moves[1, :n] *= odds
    moves[3, :n] *= odds
    moves = np.ascontiguousarray(moves.reshape(4, rows, ROW).transpose(0, 2, 1))
    a, b, c, d = np.ones(rows), np.zeros(rows), np.zeros(rows), np.ones(rows)
    for k in range(ROW):
        m00, m01, m10, m11 = moves[:, k]
        a, b, c, d = a * m00 + b * m10, a * m01 + b * m11, c * m00 + d * m10, c * m01 + d * m11
        total = a + b + c + d
        a, b, c, d = a / total, b / total, c / total, d / total
    x, y = state
    left, right = np.empty(rows), np.empty(rows)
    for k, (p, q, r, s) in enumerate(zip(a.tolist(), b.tolist(), c.tolist(), d.tolist())):
        left[k], right[k] = x, y
        x, y = x * p + y * r, x * q + y * s
        total = x + y
        x, y = x / total, y / total
    state = x, y
    out = np.empty((2, ROW, rows))
    x, y = left, right
    for k in range(ROW):
        m00, m01, m10, m11 = moves[:, k]
        x, y = x * m00 + y * m10, x * m01 + y * m11
        total = x + y
        x, y = x / total, y / total
        out[0, k], out[1, k] = x, y
    return out.transpose(2, 1, 0).reshape(size, 2)[:n], state


def marginals(scores: np.ndarray, begins: np.ndarray, start: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(state 1) of every token, and the expected number of each transition (2 x 2).

    ``scores``: of state 1 against state 0; start, step: weights (exp of the scores).
    """
    odds = np.exp(np.clip(scores, -30, 30))
    forward = scan(odds, begins, start, step)
    # Backward messages are forward ones of the reversed texts, without the token's own odds.
    ends = np.append(begins[1:], True)
    reversed_ = scan(odds[::-1], ends[::-1], np.ones(2), step.T)[::-1]
    p, seen = np.empty(len(odds)), np.zeros((1, 2, 2))
    for at in range(0, len(odds), BLOCK):
        # The block's tokens, and for the transitions the one after them.
        now = slice(at, at + BLOCK)
        after = np.ones((len(odds[now]), 2))
        follow = np.flatnonzero(~ends[now])
        after[follow] = reversed_[at + follow + 1] @ step.T
        after /= after.sum(1, keepdims=True)
        both = forward[now] * after
        p[now] = both[:, 1] / both.sum(1)
        then = at + follow + 1
        beyond = reversed_[np.minimum(then + 1, len(odds) - 1)] @ step.T
        beyond[ends[then]] = 1
        beyond /= beyond.sum(1, keepdims=True)
        beyond[:, 1] *= odds[then]
        pairs = forward[now][follow][:, :, None] * step[None] * beyond[:, None, :]
        pairs /= pairs.sum((1, 2), keepdims=True)
        seen = np.concatenate([seen, pairs]).sum(0, keepdims=True)
    return p, seen[0]


def without_copies(texts: list[list[bytes]]) -> list[int]:
    """Places of texts of which no earlier one is a near copy."""
    holders: dict[int, list[int]] = {}
    kept = []
    for k, text in enumerate(texts):
        hashes = {zlib.crc32(b" ".join(text[i : i + 5])) for i in range(max(1, len(text) - 4))}
        least = sorted(hashes)[:SKETCH]
        shared = Counter(other for h in least for other in holders.get(h, ()))
        if max(shared.values(), default=0) >= min(EQUAL, len(least)):
            continue
        kept.append(k)
        for h in least:
            holders.setdefault(h, []).append(k)
    return kept


def units(word: bytes) -> list[bytes]:
    """What may mark a token: the word itself, and its beginnings (with a mark after them)."""
    w = core(word)
    return [w, *(w[:n] + b"^" for n in STEMS if len(w) > n)]


def held_units(text: list[bytes]) -> set[bytes]:
    return {u for w in set(text) for u in units(w)}


def marking_units(texts: list[list[bytes]], labels: np.ndarray) -> set[bytes]:
    """Units that mark toxic tokens."""
    toxic = [t for t, label in zip(texts, labels) if label]
    in_toxic = Counter(u for t in toxic for u in held_units(t))
    in_toxic = Counter({u: n for u, n in in_toxic.items() if n >= SUPPORT})
    # Units of few toxic documents mark nothing, however many other documents hold them.
    in_clean = Counter(u for t, label in zip(texts, labels) if not label for u in held_units(t) if u in in_toxic)
    clean = len(texts) - len(toxic)
    likely = {u for u, n in in_toxic.items() if n / len(toxic) >= RATIO * (in_clean[u] + 1) / (clean + 1)}
    chosen = {u for u in likely if not u.endswith(b"^") or in_toxic[u] >= FREQUENT * len(toxic)}
    held = (held_units(t) & likely for t in toxic)
    left = [h for h in held if h.isdisjoint(chosen)]
    while left:
        gains = Counter(u for h in left for u in h)
        # The first in order of gain, then of rarity in clean documents, then of the unit itself.
        unit, gain = min(gains.items(), key=lambda x: (-x[1], in_clean[x[0]], x[0]), default=(b"", 0))
        if gain < max(3, GAIN * len(toxic)):
            break
        chosen.add(unit)
        left = [h for h in left if unit not in h]
    # A beginning gives way to a longer unit that is in nearly as many documents.
    longer = {u: [v for v in likely if len(v) > len(u) - 1 and v != u and v.startswith(u[:-1])] for u in chosen if u.endswith(b"^")}
    return {u for u in chosen if not any(10 * in_toxic[v] >= 9 * in_toxic[u] for v in longer.get(u, ()))} | {
        v for vs in longer.values() for v in vs if not v.endswith(b"^")
    }


def evidence(p: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Per text: the expected number of toxic tokens, counting only what squared marginals leave of the
    many tiny ones, on a log scale; the log odds of its most toxic token (-10 to 10, as -1 to 1); and
    the root of the share of toxic tokens."""
    out = np.zeros((len(ends), 3))
    out[:, 1] = -1
    begins = np.concatenate(([0], ends[:-1])).astype(np.int64)
    some = np.flatnonzero(ends > begins)
    if len(some):
        at = begins[some]
        expected = np.add.reduceat(p * p, at)
        out[some, 0] = np.log1p(expected)
        out[some, 2] = np.sqrt(expected / (ends[some] - at))
        top = np.clip(np.maximum.reduceat(p, at), 1e-9, 1 - 1e-9)
        out[some, 1] = np.clip(np.log(top / (1 - top)), -10, 10) / 10
    return out


class Field:
    """Weights of the chain and of the calibration of its evidence."""

    def __init__(self):
        self.weights = np.zeros(BUCKETS)
        self.bias = 0.0
        self.start = np.zeros(2)
        self.step = np.zeros((2, 2))
        #: Unless calibrated: one toxic token is decisive.
        self.calibration = np.array([-3.0, 8.0, 3.0, 0.0])
        self.known: dict[bytes, tuple[float, float, float]] = {}

    def __getstate__(self) -> dict:
        some = np.flatnonzero(self.weights)
        return {"some": some, "values": self.weights[some], "bias": self.bias, "start": self.start, "step": self.step, "calibration": self.calibration}

    def __setstate__(self, state: dict) -> None:
        self.__init__()
        self.weights[state["some"]] = state["values"]
        self.bias, self.start, self.step = state["bias"], state["start"], state["step"]
        self.calibration = state["calibration"]

    def fit(self, texts: list[list[bytes]], labels: np.ndarray) -> Field:
        """Maximum likelihood by adaptive gradient steps over all tokens at once. All texts tell which
        words mark tokens; the chain learns from the toxic texts and as many others."""
        unique = without_copies(texts)
        texts, labels = [texts[k] for k in unique], labels[unique]
        marking = marking_units(texts, labels)
        clean = [k for k in range(len(texts)) if not labels[k]][: max(1, int(labels.sum()))]
        kept = [(texts[k], labels[k]) for k in sorted({*clean, *np.flatnonzero(labels).tolist()}) if texts[k]]
        if not marking or not kept:
            self.bias = -30.0
            return self
        lengths = np.array([len(t) for t, _ in kept])
        begins = np.zeros(lengths.sum(), bool)
        begins[np.cumsum(lengths) - lengths] = True
        ends = np.append(begins[1:], True)
        number: dict[bytes, int] = {}
        at = np.fromiter((number.setdefault(w, len(number)) for t, _ in kept for w in t), np.int32)
        own = np.fromiter(chain.from_iterable(map(features, number)), np.int32).reshape(len(number), OWNED + 2)
        marked = np.fromiter((not marking.isdisjoint(units(w)) for w in number), bool)
        truth = (marked[at] & np.repeat([bool(label) for _, label in kept], lengths)).astype(float)
        # Features of a token: its own ones and what its neighbours give it. Outside a text there is no
        # neighbour: a bucket beyond the others, never trained.
        used = own[at]
        used[:, OWNED] = np.where(begins, BUCKETS, np.append(BUCKETS, own[at[:-1], OWNED]))
        used[:, OWNED + 1] = np.where(ends, BUCKETS, np.append(own[at[1:], OWNED + 1], BUCKETS))
        is_used = np.zeros(BUCKETS + 1, bool)
        blocks = [slice(k, k + BLOCK) for k in range(0, len(at), BLOCK)]
        for block in blocks:
            is_used[used[block]] = True
        places = np.flatnonzero(is_used)
        place = (np.cumsum(is_used) - 1).astype(np.int32)
        for block in blocks:
            used[block] = place[used[block]]
        w = np.zeros(len(places))
        outside = places == BUCKETS
        now, then = truth[1:][~begins[1:]].astype(int), truth[:-1][~begins[1:]].astype(int)
        seen = np.bincount(2 * then + now, minlength=4).reshape(2, 2).astype(float)
        firsts = truth[begins]
        base = (truth.sum() + 0.5) / (len(truth) + 1)
        state = [w, np.array([np.log(base / (1 - base))]), self.start, self.step]
        squares = [np.full_like(x, 1e-8) for x in state]
        n = len(truth)
        for _ in range(ROUNDS):
            scores = np.concatenate([state[0][used[block]].sum(1) for block in blocks]) + state[1]
            p, pairs = marginals(scores, begins, np.exp(state[2]), np.exp(state[3]))
            miss = truth - p
            slope = np.zeros(len(places))
            for block in blocks:
                np.add.at(slope, used[block].ravel(), np.repeat(miss[block], OWNED + 2))
            slope -= DECAY * n * state[0]
            slope[outside] = 0
            lost = firsts.sum() - p[begins].sum()
            for x, g, s in zip(state, (slope, np.array([miss.sum()]), np.array([-lost, lost]), seen - pairs), squares):
                s += g * g
                x += RATE * g / np.sqrt(s)
        self.weights[places[~outside]] = state[0][~outside]
        self.bias, self.start, self.step = float(state[1][0]), state[2], state[3]
        # Documents that the chain has not seen as clean calibrate the score.
        seen_clean = set(clean)
        rest = [k for k in range(len(texts)) if labels[k] or k not in seen_clean]
        del at, own, used, truth, number
        self.calibrate([texts[k] for k in rest], labels[rest])
        self.known.clear()
        return self

    def calibrate(self, texts: list[list[bytes]], labels: np.ndarray) -> None:
        """Logistic regression of the label on ``evidence``, by Newton's method with a small ridge."""
        if not 0 < labels.sum() < len(labels):
            return
        p, ends = self.tag(texts, cache=BLOCK // 4)
        x = np.column_stack([np.ones(len(texts)), evidence(p, ends)])
        y, w = labels.astype(float), np.zeros(4)
        for _ in range(30):
            q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            w += np.linalg.solve((x.T * (q * (1 - q))) @ x + 0.1 * np.eye(4), x.T @ (y - q) - 0.1 * w)
        self.calibration = w

    def document_scores(self, p: np.ndarray, ends: np.ndarray) -> np.ndarray:
        w = self.calibration
        return 1 / (1 + np.exp(-np.clip(w[0] + evidence(p, ends) @ w[1:], -30, 30)))

    def token_scores(self, text: list[bytes], cache: int = CACHE) -> tuple[list[float], list[float], list[float]]:
        """Own score, score given to the next word, score given to the word before."""
        known = self.known
        out = list(map(known.get, text))
        if None in out:
            if len(known) > cache:
                known.clear()
            for k, held in enumerate(out):
                if held is None:
                    held = known.get(text[k])
                    if held is None:
                        f = self.weights[list(features(text[k]))].tolist()
                        held = known[text[k]] = (sum(f[:OWNED]), f[OWNED], f[OWNED + 1])
                    out[k] = held
        return out

    def tag(self, texts: list[list[bytes]], cache: int = CACHE) -> tuple[np.ndarray, np.ndarray]:
        """Marginals of all tokens in order, and where each text's tokens end."""
        ends = np.cumsum([len(t) for t in texts])
        flat = [w for t in texts for w in t]
        if not flat:
            return np.zeros(0), ends
        own = np.concatenate([np.array(self.token_scores(flat[k : k + BLOCK], cache)) for k in range(0, len(flat), BLOCK)])
        begins = np.zeros(len(flat) + 1, bool)
        begins[ends - [len(t) for t in texts]] = True
        begins = begins[:-1]
        last = np.append(begins[1:], True)
        scores = own[:, 0] + self.bias
        scores[1:] += np.where(begins[1:], 0, own[:-1, 1])
        scores[:-1] += np.where(last[:-1], 0, own[1:, 2])
        return marginals(scores, begins, np.exp(self.start), np.exp(self.step))[0], ends


def spans(text: str, p: np.ndarray) -> list[tuple[int, int]]:
    """Character offsets (begin, end) of runs of tokens with a marginal of one half or more."""
    if not (p >= 0.5).any():
        return []
    out: list[tuple[int, int]] = []
    open_ = False
    for found, chance in zip(WORD.finditer(text), p):
        if chance >= 0.5:
            out = [*out[:-1], (out[-1][0], found.end())] if open_ else [*out, found.span()]
        open_ = chance >= 0.5
    return out


def sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> list:
    """The training sample: ids first, then the texts of these ids."""
    known = labels.select(F.col("doc_id").alias("__id"), "toxic").where("toxic in (0, 1)").groupBy("__id").agg(F.max("toxic").alias("__toxic"))
    part = remainder(id_col, 3)
    text = F.col(f"`{text_col}`")
    sized = docs.where((part != 1) & (F.length(text) <= SAMPLE_CHARS)).select(F.col(f"`{id_col}`").alias("__id"), F.xxhash64(text).alias("h"))
    # Copies of a text would fill the sample: of equal texts the one with the smallest id is drawn.
    held = sized.join(known, "__id").groupBy("h").agg(F.min(F.struct("__id", "__toxic")).alias("x")).select("x.*")
    drawn = [held.where(F.col("__toxic") == k).orderBy(F.xxhash64("__id"), "__id").limit(n) for k, n in ((0, OTHERS), (1, TOXIC))]
    ids = {r["__id"]: r["__toxic"] for k in drawn for r in k.collect()}
    if not ids:
        return []
    rows = docs.where(F.col(f"`{id_col}`").isin(list(ids))).where(F.length(text) <= SAMPLE_CHARS).select(F.col(f"`{id_col}`").alias("i"), text.alias("t")).distinct().limit(TOXIC + OTHERS).collect()
    return sorted((r["i"], r["t"], ids[r["i"]]) for r in rows)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Field:
    rows = sample(docs, labels, id_col, text_col)
    once: dict[bytes, bytes] = {}  # a word of many texts is held once
    texts = [[once.setdefault(w, w) for w in words(t)] for _, t, _ in rows]
    return Field().fit(texts, np.array([k for _, _, k in rows]))


def score(docs: DataFrame, field: Field, keep: list[str], text_col: str = "text", with_spans: bool = False) -> DataFrame:
    """Adds score, predicted, n_spans and, if asked for, the spans' offsets in characters."""
    fields = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()), T.StructField("n_spans", T.IntegerType())]
    if with_spans:
        fields.append(T.StructField("spans", T.ArrayType(T.ArrayType(T.IntegerType()))))
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def work(texts: list[str]) -> dict[str, list]:
        p, ends = shared.value.tag([words(t) for t in texts])
        toxic = p >= 0.5
        first = toxic.copy()
        first[1:] &= ~toxic[:-1]
        out: dict[str, list] = {f.name: [] for f in fields}
        begin = 0
        for text, end, chance in zip(texts, ends.tolist(), shared.value.document_scores(p, ends).tolist()):
            own = p[begin:end]
            out["score"].append(chance)
            out["predicted"].append(int(chance >= THRESHOLD))
            out["n_spans"].append(int(first[begin:end].sum() + (end > begin and toxic[begin] and not first[begin])))
            if with_spans:
                out["spans"].append(spans(text, own))
            begin = end
        return out

    return by_text(docs, text_col, keep, fields, work)


def detect(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, with_spans: bool = False) -> DataFrame:
    """Learns from labelled documents whose crc32 of the id modulo 3 is not 1, scores all.

    Per row: the id, held_out (and ``keep``), score, predicted, n_spans. Null and empty texts score
    as texts without toxic words, and so does every text if no word tells toxic documents from others (no labels, for example). A
    document whose labels disagree counts as toxic. Repeated rows stay; a null id is not held out.
    """
    field = train(docs, labels, id_col, text_col)
    keyed = docs.withColumn("held_out", F.coalesce(remainder(id_col, 3) == 1, F.lit(False)))
    return score(keyed, field, [id_col, "held_out", *(keep or [])], text_col, with_spans)
