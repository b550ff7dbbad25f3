"""Exact dedup by recipes of content-defined chunks (operator 13).

A normalised text is cut where a rolling hash of its last bytes is small, so that a text is cut the
same way wherever it stands; its recipe is the ordered list of its chunks' hashes. Only texts with
equal recipes can be equal. Of these the chunks, each distinct one once for a task, are brought
together by hash and compared byte by byte: a chunk's identifier is its hash and its place among the
contents with that hash, so a collision costs a further number and no wrong group. Texts are equal
if their ordered identifier lists are. Whole documents never move; chunks of texts that are alone
with their recipe do not move either.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.common import by_text
from barloom.plans.sizing import broadcast_if_small
from barloom.session import materialize

WHITE = b" \t\n\v\f\r"
#: Bytes of a chunk: at least, at most, and 1 in 2^CUT_BITS places is a cut.
LEAST, MOST, CUT_BITS = 256, 8192, 10
#: Bytes that decide about a cut; below LEAST, so that no text before it matters.
REACH = 32
GEAR = np.random.default_rng(13).integers(0, 1 << 32, 256, np.uint32)
#: Ids that are broadcast at most; above that the join shuffles.
BROADCAST_IDS = 1_000_000


def normalised(text: str) -> bytes:
    """UTF-8 with one space for each run of white space (ASCII)."""
    data = text.encode()
    if not data:
        return data
    words = b" ".join(data.split())
    if not words:
        return b" "
    return (b" " if data[0] in WHITE else b"") + words + (b" " if data[-1] in WHITE else b"")


def rolled(data: bytes) -> np.ndarray:
    """Places after which the hash of the last ``REACH`` bytes allows a cut."""
    h = GEAR[np.frombuffer(data, np.uint8)]
    step = 1
    while step < REACH:
        older = h[:-step] << np.uint32(step)
        h[step:] += older
        step *= 2
    return np.flatnonzero(h >> np.uint32(32 - CUT_BITS) == 0) + 1


def chunks_of(texts: list[bytes]) -> list[list[bytes]]:
    """The chunks of every text; none for an empty one."""
    whole = b"".join(texts)
    cuts = rolled(whole).tolist()
    out, begin = [], 0
    for text in texts:
        end, made = begin + len(text), []
        while begin < end:
            place = bisect_left(cuts, begin + LEAST)
            last = min(cuts[place] if place < len(cuts) else end, begin + MOST, end)
            made.append(whole[begin:last])
            begin = last
        out.append(made)
    return out


def hashed(chunk: bytes, bits: int) -> int:
    """The hash of a chunk, of ``bits`` bits, as a signed long."""
    h = xxhash.xxh3_64_intdigest(chunk) >> (64 - bits)
    return h - (1 << 64) if h >> 63 else h


def recipes(docs: DataFrame, id_col: str, text_col: str, bits: int) -> DataFrame:
    """(id, sha, recipe, chunks): digest of the normalised text, of the list, and the list of hashes."""

    def work(texts: list[str]) -> dict[str, list]:
        plain = [normalised(t) for t in texts]
        lists = [[hashed(c, bits) for c in made] for made in chunks_of(plain)]
        digests = [xxhash.xxh3_64_intdigest(np.array(held, np.int64).tobytes()) for held in lists]
        return {
            "__sha": [hashlib.sha256(p).digest() for p in plain],
            "__recipe": np.array(digests, np.uint64).view(np.int64),
            "__chunks": lists,
        }

    fields = [T.StructField("__sha", T.BinaryType()), T.StructField("__recipe", T.LongType()), T.StructField("__chunks", T.ArrayType(T.LongType()))]
    out = by_text(docs, text_col, [id_col], fields, work)
    return out.select(F.col(f"`{id_col}`").alias("id"), F.col("__sha").alias("sha"), F.col("__recipe").alias("recipe"), F.col("__chunks").alias("chunks"))


def contents(docs: DataFrame, id_col: str, text_col: str, bits: int) -> DataFrame:
    """(id, sha, pos, hash, content): the chunks of every text."""

    def work(texts: list[str]) -> dict[str, list]:
        plain = [normalised(t) for t in texts]
        items = [[(hashed(c, bits), c) for c in made] for made in chunks_of(plain)]
        return {"__sha": [hashlib.sha256(p).digest() for p in plain], "__items": items}

    item = T.StructType([T.StructField("hash", T.LongType()), T.StructField("content", T.BinaryType())])
    fields = [T.StructField("__sha", T.BinaryType()), T.StructField("__items", T.ArrayType(item))]
    out = by_text(docs, text_col, [id_col], fields, work)
    out = out.select(F.col(f"`{id_col}`").alias("id"), F.col("__sha").alias("sha"), F.posexplode("__items").alias("pos", "item"))
    return out.select("id", "sha", "pos", "item.hash", "item.content")


def identified(docs: DataFrame, suspects: DataFrame, id_col: str, text_col: str, bits: int) -> DataFrame:
    """``suspects`` (row, id, sha, recipe, chunks) with ``ranks``: for each chunk its place among the
    contents of its hash, empty where all are the first."""
    ids = broadcast_if_small(materialize(suspects.select(F.col("id").alias("__suspect")).distinct(), "suspects"), BROADCAST_IDS)
    some = docs.join(ids, F.col(f"`{id_col}`").eqNullSafe(F.col("__suspect")), "left_semi")
    found = contents(some, id_col, text_col, bits)
    distinct = materialize(found.groupBy("hash", "content").agg(F.count("*").alias("times")), "chunks")
    collided = materialize(distinct.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash"), "collided")
    none = F.array().cast("array<int>").alias("ranks")
    if collided.isEmpty():
        return suspects.select("*", none)
    # Contents of one hash are few; the first in byte order has place 0.
    order = Window.partitionBy("hash").orderBy("content")
    places = distinct.join(collided, "hash", "left_semi").select("hash", "content", (F.row_number().over(order) - 1).alias("rank"))
    later = found.join(materialize(places.where("rank > 0"), "places"), ["hash", "content"])
    held = later.select("id", "sha", "pos", "rank").distinct().groupBy("id", "sha").agg(F.sort_array(F.collect_list(F.struct("pos", "rank"))).alias("later"))
    held = materialize(held.withColumnsRenamed({"id": "__id", "sha": "__sha"}), "ranks")
    ranks = F.transform(F.flatten(F.transform("later", lambda p: F.array(p["pos"], p["rank"]))), lambda x: x.cast("int"))
    joined = suspects.join(held, F.col("id").eqNullSafe(F.col("__id")) & (F.col("sha") == F.col("__sha")), "left")
    return joined.select(*suspects.columns, F.coalesce(ranks, F.array().cast("array<int>")).alias("ranks"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 64) -> DataFrame:
    """Per row: the id, keep_id, group_size, kept, text_sha256.

    Rows are one group if their texts are equal after every run of ASCII white space has become one
    space; null counts as empty, and empty texts are a group like any other. ``keep_id`` is the smallest
    id of the group (a null id only if there is no other), ``group_size`` the number of its rows, and
    ``kept`` is true for one row of each group: of repeated rows with the smallest id one stays. An
    empty table stays empty. Other columns are not read. ``bits`` is the width of the chunk hash; fewer
    bits mean more collisions and the same groups.
    """
    held = recipes(docs, id_col, text_col, bits).select(F.monotonically_increasing_id().alias("row"), "*")
    held = materialize(held, "recipes")
    again = held.groupBy("recipe").agg(F.count("*").alias("n")).where("n > 1").select("recipe")
    again = broadcast_if_small(materialize(again, "again"), BROADCAST_IDS)
    alone = held.join(again, "recipe", "left_anti")
    suspects = materialize(held.join(again, "recipe", "left_semi").select(*held.columns), "suspected")

    listed = identified(docs, suspects, id_col, text_col, bits)
    by = ["recipe", "chunks", "ranks"]
    # Ids in order, null last; of equal ones the first row.
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row"))
    groups = listed.groupBy(*by).agg(F.count("*").alias("group_size"), first.alias("first"))
    rows = listed.join(groups, by)
    digits = F.lower(F.hex("sha")).alias("text_sha256")
    shown = F.col("id").alias(id_col)
    several = rows.select(shown, F.col("first.id").alias("keep_id"), "group_size", (F.col("row") == F.col("first.row")).alias("kept"), digits)
    single = alone.select(shown, F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), digits)
    return single.unionByName(several)
