"""Nearest neighbours by randomly rotated one-bit codes (operator 9).

A vector is taken relative to a centre, rotated by a random orthogonal matrix and kept as the signs
of its components, with its length and the cosine between it and its code as correction scalars. The
inner product with a query is estimated from the signs, with a bound on the error; the candidates
whose upper bound reaches the k-th best lower bound are compared exactly.

The stated queries meet all rows in blocks: blocks of vectors by blocks of queries, each pair of
blocks one task of bounded size that returns k rows per query.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import ship
from barloom.session import materialize

#: Rows of a block of vectors, and of a block of queries.
VECTORS, QUERIES = 8192, 4096
#: Vectors whose mean is the centre, by hash of the id; only the width of the bounds depends on it.
CENTRE = 2048
#: Half-width of the error bound in standard deviations of the estimate.
SURE = 3.0
SEED = 20
#: Queries that one step estimates together.
STEP = 128


@lru_cache(maxsize=4)
def rotation(width: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((width, width)))
    return q * np.sign(np.diag(r))


def usable(vector: Column) -> Column:
    """Not null, no null or non-finite component, not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(column: pa.ChunkedArray | pa.Array, rows: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1)


def encode(vectors: DataFrame, centres: dict[int, np.ndarray]) -> DataFrame:
    """Adds code (packed signs), length and cosine; rows of one width per batch run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = np.asarray(batch.column("width"))
            for width in np.unique(widths):
                part = batch.filter(pa.array(widths == width))
                x = matrix(part.column("vector"), part.num_rows) - centres.get(int(width), 0.0)
                turned = x @ rotation(int(width)).T
                length = np.sqrt((turned**2).sum(1))
                cosine = np.abs(turned).sum(1) / (np.sqrt(width) * np.where(length > 0, length, 1))
                codes = np.packbits(turned > 0, axis=1)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(length), pa.array(np.where(length > 0, cosine, 1.0))],
                    names=[*part.schema.names, "code", "length", "cosine"],
                )

    ship(vectors.sparkSession)
    fields = ", ".join(f"{n} {t}" for n, t in vectors.dtypes)
    return vectors.mapInArrow(run, f"{fields}, code binary, length double, cosine double")


def search_block(block: dict, queries: dict, k: int, centre: np.ndarray | float) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(place of the query, places of its best k in the block, their inner products)."""
    x, q = block["vector"], queries["vector"]
    width = x.shape[1]
    signs = np.unpackbits(block["code"], axis=1, count=width).astype(np.float32) * 2 - 1
    scale = (block["length"] / (block["cosine"] * np.sqrt(width))).astype(np.float32)
    spread = block["length"] * np.sqrt(np.maximum(1 - block["cosine"] ** 2, 0)) / (block["cosine"] * np.sqrt(max(1, width - 1)))
    turned = (q @ rotation(width).T).astype(np.float32)
    base = q @ (centre if isinstance(centre, np.ndarray) else np.full(width, centre))
    norms = np.sqrt((q**2).sum(1))
    for begin in range(0, len(q), STEP):
        rows = slice(begin, begin + STEP)
        estimate = (turned[rows] @ signs.T) * scale + base[rows, None]
        error = SURE * norms[rows, None] * spread + 1e-5 * (np.abs(estimate) + norms[rows, None])
        own = queries["id"][rows, None] == block["id"]
        lower = np.where(own, -np.inf, estimate - error)
        least = np.partition(lower, -k, axis=1)[:, -k] if lower.shape[1] > k else np.full(len(lower), -np.inf)
        rerank = (estimate + error >= least[:, None]) & ~own
        for row in range(len(lower)):
            places = np.flatnonzero(rerank[row])
            if not len(places):
                continue
            exact = x[places] @ q[begin + row]
            best = np.lexsort((block["id"][places], -exact))[:k]
            yield begin + row, places[best], exact[best]


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The k rows with the largest inner product for every row that ``is_query`` picks: query_id, rank
    (from 1), vec_id, score; ties to the smaller id, fewer rows if there are fewer candidates.

    Rows whose vector is null, zero, or has null or non-finite components, and rows with a null id,
    take no part; vectors meet only those of their own width. A query's own id is no candidate.
    Repeated rows (equal id and vector) count once; an id with several vectors is searched with each,
    ranks are then given over all of them together. Other columns are not read.
    """
    spark = vectors.sparkSession
    ship(spark)
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    held = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), vector.alias("vector"), is_query.alias("asks"))
    held = held.where(F.col("id").isNotNull() & usable(F.col("vector"))).withColumn("width", F.size("vector")).distinct()
    held = materialize(held, "vectors")
    sample = held.orderBy(F.xxhash64("id"), "id").select("vector").limit(CENTRE).collect()
    by_width: dict[int, list] = {}
    for row in sample:
        by_width.setdefault(len(row["vector"]), []).append(row["vector"])
    centres = {w: np.mean(rows, axis=0) for w, rows in by_width.items()}
    total, asking = held.agg(F.count("*"), F.count_if("asks")).first()
    blocks, parts = max(1, -(-total // VECTORS)), max(1, -(-asking // QUERIES))

    index = materialize(encode(held.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")), centres), "index")
    rows = index.select("width", "block", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), "id", "vector", "code", "length", "cosine")
    asks = held.where("asks").withColumn("part", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(parts)).cast("int"))
    asks = asks.select("width", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "part", "id", "vector")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], names=names)
        width = left.column("width")[0].as_py()
        codes = np.frombuffer(b"".join(left.column("code").to_pylist()), np.uint8).reshape(left.num_rows, -1)
        block = {c: left.column(c).to_numpy() for c in ("id", "length", "cosine")} | {"vector": matrix(left.column("vector"), left.num_rows), "code": codes}
        queries = {"id": right.column("id").to_numpy(), "vector": matrix(right.column("vector"), right.num_rows)}
        out = list(search_block(block, queries, k, centres.get(width, 0.0)))
        ids = [np.full(len(p), queries["id"][q]) for q, p, _ in out]
        return pa.table([np.concatenate(c) if out else np.zeros(0, t) for c, t in ((ids, np.int64), ([block["id"][p] for _, p, _ in out], np.int64), ([s for *_, s in out], np.float64))], names=names)

    keys = ["width", "block", "part"]
    found = rows.groupBy(*keys).cogroup(asks.groupBy(*keys)).applyInArrow(run, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
