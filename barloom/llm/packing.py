"""Packing documents into sequences by best-fit decreasing (operator 2).

Token ids are cut into full windows and a shorter rest while they are made, so a piece's
checksum needs no second pass. Lengths are whole numbers up to the window, so best-fit
decreasing depends on the number of pieces of each length alone: open windows with the same
content are one group, and a step either uses up a group or the pieces of a length. The plan
has a few groups for each length however many documents there are, and is made on the driver
from one count per length. Pieces then take their places by their number among pieces of their
length.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.bpe import CACHE, from_json
from barloom.llm.common import ship, steps
from barloom.llm.pretokenize import slices
from barloom.session import materialize

PIECE = "start long, length long, ids_crc32 long, doc_tokens long"


class Capacities:
    """Segment tree over remaining capacities; each leaf holds the groups of windows with so much
    room, an inner node the number of its windows."""

    def __init__(self, window: int):
        self.size = 1 << (window + 1).bit_length()
        self.count = [0] * (2 * self.size)
        self.groups: list[list[list]] = [[] for _ in range(window + 1)]

    def _add(self, room: int, windows: int) -> None:
        node = room + self.size
        while node:
            self.count[node] += windows
            node >>= 1

    def push(self, room: int, windows: int, content: tuple) -> None:
        self.groups[room].append([windows, content])
        self._add(room, windows)

    def pop(self, room: int, most: int) -> tuple[int, tuple]:
        """Up to ``most`` windows of the group that was opened first."""
        group = self.groups[room][0]
        taken = min(most, group[0])
        group[0] -= taken
        if not group[0]:
            self.groups[room].pop(0)
        self._add(room, -taken)
        return taken, group[1]

    def tightest(self, least: int) -> int | None:
        """The smallest capacity of at least ``least`` that an open window has."""
        node = least + self.size
        while not self.count[node]:
            while node & 1:  # a right child: nothing further right below this parent
                node >>= 1
            if node == 0:
                return None
            node += 1
            if node & (node - 1) == 0:
                return None  # past the last leaf of this level
        while node < self.size:
            node = 2 * node if self.count[2 * node] else 2 * node + 1
        return node - self.size


def best_fit_decreasing(counts: dict[int, int], window: int) -> list[tuple[int, tuple[int, ...]]]:
    """(windows, lengths of the pieces in each) for so many pieces of each length."""
    tree = Capacities(window)
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                # No open window takes it: each new one takes as many as fit, as one by one would.
                each = window // length
                full, odd = divmod(left, each)
                for windows, pieces in ((full, each), (1 if odd else 0, odd)):
                    if windows:
                        tree.push(window - pieces * length, windows, ((length, pieces),))
                break
            most = max(1, left // (room // length)) if room >= length else 0
            fits = min(room // length, left)
            taken, content = tree.pop(room, most)
            tree.push(room - fits * length, taken, (*content, (length, fits)))
            left -= taken * fits
    out = []
    for groups in tree.groups:
        for windows, content in groups:
            out.append((windows, tuple(length for length, n in content for _ in range(n))))
    return out


@lru_cache(maxsize=2)
def encoder(path: str) -> tuple[tiktoken.Encoding, dict[str, int], dict[str, bytes]]:
    vocabulary, special = from_json(path)
    # Slices are cut before; the pattern takes a slice as it is.
    return tiktoken.Encoding("slices", pat_str=r"[\s\S]+", mergeable_ranks=vocabulary.ranks, special_tokens={}), special, {}


def packed_ids(parts: list[str], path: str) -> list[bytes]:
    """Each slice's ids as little-endian 32-bit integers, through a cache."""
    encoding, _, known = encoder(path)
    out = list(map(known.get, parts))
    if None in out:
        if len(known) > CACHE:
            known.clear()
        for k, ids in enumerate(out):
            if ids is None:
                ids = known.get(parts[k])
                if ids is None:
                    ids = known[parts[k]] = np.array(encoding.encode_ordinary(parts[k]), "<u4").tobytes()
                out[k] = ids
    return out


def document_ids(texts: list[str], path: str) -> list[bytes]:
    """Packed ids of whole texts; special strings inside a text are their own id."""
    _, special, _ = encoder(path)
    pieces, owners, marks = [], [], []
    for k, text in enumerate(texts):
        rest = [(text, b"")]
        for mark, number in special.items():
            if mark in text:
                tail = np.array([number], "<u4").tobytes()
                rest = [(p, tail if i + 1 < len(ps) else end) for t, end in rest for ps in [t.split(mark)] for i, p in enumerate(ps)]
        for piece, end in rest:
            pieces.append(piece)
            owners.append(k)
            marks.append(end)
    parts, ends = slices(pieces)
    packed = packed_ids(parts, path)
    out, begin = [b""] * len(texts), 0
    grouped: list[list[bytes]] = [[] for _ in texts]
    for owner, end, mark in zip(owners, ends, marks):
        grouped[owner] += packed[begin:end]
        grouped[owner].append(mark)
        begin = end
    for k, held in enumerate(grouped):
        out[k] = b"".join(held)
    return out


def cut_pieces(docs: DataFrame, tokenizer_path: str, window: int, closing_id: int, id_col: str, text_col: str) -> DataFrame:
    """Full windows and the rest of every document: row_id (one per input row), the id, start,
    length, ids_crc32, doc_tokens."""
    ship(docs.sparkSession)
    source = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string").alias("__text"))
    kind = source.schema[id_col].dataType
    schema = T.StructType([T.StructField("doc_id", kind)] + T._parse_datatype_string(PIECE).fields)
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    closing = np.array([closing_id], "<u4").tobytes()

    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0), [t or "" for t in batch.column("__text").to_pylist()]
            for begin, end in steps(texts):
                owner, rows = [], []
                for k, data in enumerate(document_ids(texts[begin:end], tokenizer_path), begin):
                    data += closing
                    total = len(data) // 4
                    for start in range(0, total, window):
                        part = data[4 * start : 4 * (start + window)]
                        owner.append(k)
                        rows.append((start, len(part) // 4, zlib.crc32(part), total))
                columns = [ids.take(pa.array(owner, pa.int64())), *(pa.array(c, pa.int64()) for c in zip(*rows))]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return source.mapInArrow(run, schema)


def numbered(pieces: DataFrame) -> DataFrame:
    """Adds ``place``: 0, 1, ... among the pieces of a length.

    Pieces are numbered within (block, length), and blocks start where the counts of those before
    them end. Blocks are hashes of the piece, one for about 2^15 pieces, so that no length, however
    frequent, meets in one task.
    """
    total = pieces.count()
    blocks = max(1, -(-total // (1 << 15)))
    held = pieces.withColumn("block", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(blocks)))
    counts = held.groupBy("length", "block").count()
    starts = counts.withColumn("first", F.sum("count").over(Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)))
    inner = F.row_number().over(Window.partitionBy("block", "length").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")) - 1
    return (
        held.withColumn("inner", inner)
        .join(starts.select("length", "block", F.coalesce("first", F.lit(0)).alias("first")), ["length", "block"])
        .select(*pieces.columns, (F.col("first") + F.col("inner")).alias("place"))
    )


def places(plan: list[tuple[int, tuple[int, ...]]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first place, end place, first sequence, offset, pieces a window): runs of places that
    go to consecutive windows. Their number is bounded by the plan, thus by the window."""
    taken: dict[int, int] = {}
    out, sequence = [], 0
    for windows, lengths in plan:
        offset = 0
        k = 0
        while k < len(lengths):
            length, n = lengths[k], 1
            while k + n < len(lengths) and lengths[k + n] == length:
                n += 1
            first = taken.get(length, 0)
            out.append((length, first, first + windows * n, sequence, offset, n))
            taken[length] = first + windows * n
            offset += n * length
            k += n
        sequence += windows
    return out


def pack(docs: DataFrame, tokenizer_path: str, window: int = 1024, closing_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Packs every document into sequences of at most ``window`` tokens.

    A document is the ids of its whole text and ``closing_id``; a null or empty text is the closing
    id alone. Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id (0, 1, ... without
    gaps), offset. Repeated rows, also of one id, are documents of their own. An empty table gives no
    piece. Other columns are not read.
    """
    pieces = materialize(cut_pieces(docs, tokenizer_path, window, closing_id, id_col, text_col), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # one row per length
    runs = places(best_fit_decreasing(counts, window))
    spark = docs.sparkSession
    table = spark.createDataFrame(runs, "run_length long, first long, end long, sequence long, offset0 long, each long")
    by_length = table.groupBy("run_length").agg(F.sort_array(F.collect_list(F.struct("first", "end", "sequence", "offset0", "each"))).alias("runs"))
    run = F.filter("runs", lambda r: (F.col("place") >= r["first"]) & (F.col("place") < r["end"]))[0]
    return (
        numbered(pieces)
        .join(F.broadcast(by_length), F.col("length") == F.col("run_length"))
        .withColumn("run", run)
        .select(
            F.col("doc_id").alias(id_col),
            "start",
            "length",
            "ids_crc32",
            "doc_tokens",
            (F.col("run.sequence") + F.floor((F.col("place") - F.col("run.first")) / F.col("run.each"))).alias("sequence_id"),
            (F.col("run.offset0") + F.pmod(F.col("place") - F.col("run.first"), F.col("run.each")) * F.col("length")).alias("offset"),
        )
    )
