"""SimHash near-duplicates through an inverted index of positional bytes (operator 6).

Fingerprints with at most ``distance`` differing bits agree in at least ``8 - distance`` of their
bytes. Each distinct fingerprint is posted under the bytes at its first positions; since at most
``distance`` positions differ, a linked pair shares at least ``6 - distance`` of the first six, so
postings are made for every choice of so many of these. Pairs that meet tally all shared bytes,
pairs below the guaranteed minimum are dropped, the others are verified.

Lists with more than ``CROWDED`` fingerprints make no pairs: their members are posted under every
value within one bit instead. Two fingerprints are within two bits exactly if they share such a
value, and all that share one are linked, so each hangs on the smallest: exact, linear in a group.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.common import by_text, free_names
from barloom.llm.components import connected_components
from barloom.session import materialize

SEED = 42
DISTANCE = 2
POSITIONS = 6
#: Lists up to this size are compared pair by pair.
CROWDED = 128


def fingerprint(words: list[bytes], shingle: int) -> int:
    """64 bits, each set if it is set in over half of the shingles' hashes; no words: zero."""
    if not words:
        return 0
    runs = zip(*(words[k:] for k in range(shingle))) if len(words) >= shingle else [words]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in map(b" ".join, runs)], np.uint64)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    counts = bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, keep: list[str], text_col: str = "text", shingle: int = 3, name: str = "fp") -> DataFrame:
    """Adds the fingerprint of every whole text as a signed long."""

    def work(texts: list[str]) -> dict[str, list]:
        # Bytes: lower() and split() then know ASCII letters and ASCII white space only.
        return {name: [fingerprint(t.encode().lower().split(), shingle) for t in texts]}

    return by_text(docs, text_col, keep, [T.StructField(name, T.LongType())], work)


def links(prints: DataFrame) -> DataFrame:
    """(a, b): links that connect what any pair within two bits connects. ``prints``: distinct fp."""
    byte = [F.shiftrightunsigned(F.col("fp"), 8 * p).bitwiseAND(255) for p in range(POSITIONS)]
    keys = []
    for number, chosen in enumerate(combinations(range(POSITIONS), POSITIONS - DISTANCE)):
        key = F.lit(number).cast("long")
        for p in chosen:
            key = F.shiftleft(key, 8).bitwiseOR(byte[p])
        keys.append(key)
    postings = prints.select("fp", F.explode(F.array(*keys)).alias("key"))
    lists = postings.groupBy("key").count().where("count > 1")
    shared = materialize(postings.join(lists, "key"), "postings")

    few = shared.where(F.col("count") <= CROWDED).select("key", "fp")
    differ = F.col("a").bitwiseXOR(F.col("b"))
    matches = sum((F.shiftrightunsigned(differ, 8 * p).bitwiseAND(255) == 0).cast("int") for p in range(8))
    pairs = (
        few.withColumnRenamed("fp", "a")
        .join(few.withColumnRenamed("fp", "b"), "key")
        .where(F.col("a") < F.col("b"))
        .where(matches >= 8 - DISTANCE)
        .where(F.bit_count(differ) <= DISTANCE)
        .select("a", "b")
    )
    crowd = shared.where(F.col("count") > CROWDED).select("fp").distinct()
    near = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.shiftleft(F.lit(1).cast("long"), k)) for k in range(64)])
    balls = crowd.select("fp", F.explode(near).alias("value"))
    centres = balls.groupBy("value").agg(F.min("fp").alias("a"))
    stars = balls.join(centres, "value").where("a < fp").select("a", F.col("fp").alias("b"))
    return pairs.union(stars).distinct()


def classes_of(firsts: DataFrame) -> DataFrame:
    """(fp, first_id, component) for distinct fingerprints ``firsts`` (fp, first_id)."""
    found = connected_components(links(firsts.select("fp")), "a", "b").withColumnRenamed("node", "fp")
    named = firsts.join(found, "fp", "left").select("fp", "first_id", F.coalesce("component", "fp").alias("component"))
    return materialize(named, "named")


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, keep: list[str] | None = None) -> DataFrame:
    """Per row: the id (and ``keep``), fingerprint (16 hex digits), component_id.

    component_id is the smallest id of the rows that links reach, the row itself included. Null and
    empty texts have fingerprint zero and link with each other. A null id is never the smallest (a
    component of such rows alone has null). Repeated rows stay rows of their own; other columns are
    not read, and ``fingerprint``, ``component_id`` replace kept columns of these names.
    """
    keep = [c for c in dict.fromkeys([id_col, *(keep or [])]) if c not in ("fingerprint", "component_id", "fp")]
    prints = materialize(fingerprints(docs, keep, text_col, shingle), "prints")
    named = classes_of(prints.groupBy("fp").agg(F.min(id_col).alias("first_id")))
    smallest = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    classes = named.join(smallest, "component").select("fp", "component_id")
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return prints.join(classes, "fp").select(*[F.col(f"`{c}`") for c in keep], digits, "component_id")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """The rows of one document of each component, that of the smallest id, columns as they were.

    It is decided row by row: of repeated rows with that id one stays, and of different texts with that
    id one. Rows without id stay. An empty table stays empty.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    own, k1, k2 = free_names(docs.columns, "own_id", "k1", "k2")
    by = [own, k1, k2]  # a row, or copies of it
    keyed = docs.select("*", F.col(f"`{id_col}`").alias(own), F.xxhash64(text).alias(k1), F.xxhash64(F.lit(7), text).alias(k2))
    prints = fingerprints(keyed, by, text_col, shingle, "print_fp").toDF("own_id", "k1", "k2", "fp")
    prints = materialize(prints.where("own_id is not null"), "prints")
    named = classes_of(prints.groupBy("fp").agg(F.min("own_id").alias("first_id"))).select("fp", "component")
    rows = materialize(prints.groupBy("own_id", "k1", "k2", "fp").count().join(named, "fp"), "rows")
    winners = rows.groupBy("component").agg(F.min(F.struct("own_id", "k1", "k2")).alias("stays")).select("component", "stays.*", F.lit(True).alias("kept"))
    # By the whole row, so that a large component does not meet in one task.
    judged = rows.join(winners, ["component", "own_id", "k1", "k2"], "left").withColumn("kept", F.coalesce("kept", F.lit(False)))
    touched = materialize(judged.where("not kept or count > 1").select("own_id", "k1", "k2", "kept").toDF(*by, "kept_row"), "touched")
    whole = keyed.join(touched.select(*by), by, "left_anti")
    repeated = keyed.join(touched.where("kept_row").select(*by), by, "left_semi").dropDuplicates(by)
    order = [F.col(f"`{c}`") for c in docs.columns]
    return whole.select(*order).union(repeated.select(*order))
