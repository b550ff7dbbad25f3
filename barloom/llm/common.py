"""Helpers that the operators share."""

from __future__ import annotations

import re
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Words of the contract: runs of anything but ASCII white space.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Characters of text that one step of a task works on.
STEP_CHARS = 1 << 20


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Gives the workers this package, as ``--py-files`` would; once for an application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    target = f"{tempfile.mkdtemp(prefix='barloom-')}/{package.name}.zip"
    with zipfile.ZipFile(target, "w") as file:
        for source in sorted(package.rglob("*.py")):
            file.write(source, source.relative_to(package.parent))
    context.addPyFile(target)
    _SHIPPED.add(context.applicationId)


def by_text(
    df: DataFrame,
    text_col: str,
    keep: list[str],
    fields: list[T.StructField],
    work: Callable[[list[str]], dict[str, list]],
) -> DataFrame:
    """The columns ``keep`` and what ``work`` returns for whole texts (null: empty), narrow.

    ``work`` gets at most about ``STEP_CHARS`` characters at once (a longer text alone). An output
    column takes the place of a kept column of the same name.
    """
    ship(df.sparkSession)
    new = {f.name for f in fields}
    keep = [c for c in dict.fromkeys(keep) if c not in new]
    held = "__text"
    while held in keep:
        held += "_"
    source = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").cast("string").alias(held))
    schema = T.StructType([source.schema[c] for c in keep] + fields)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(held).to_pylist()]
            for begin, end in steps(texts):
                part = batch.slice(begin, end - begin)
                made = work(texts[begin:end])
                columns = [part.column(c) if c in keep else pa.array(made[c], f.type) for c, f in zip(arrow.names, arrow)]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return source.mapInArrow(run, schema)


def steps(texts: list[str], chars: int = STEP_CHARS) -> Iterator[tuple[int, int]]:
    begin = size = 0
    for k, text in enumerate(texts):
        if size and size + len(text) > chars:
            yield begin, k
            begin, size = k, 0
        size += len(text) + 1
    if size:
        yield begin, len(texts)


def remainder(id_col: str, modulus: int) -> F.Column:
    """crc32 of the id as text, modulo ``modulus``."""
    return F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % modulus


def free_names(columns: list[str], *wanted: str) -> list[str]:
    """``wanted``, each with as many underscores as it takes to be no name of a column."""
    out = []
    for name in wanted:
        while name in columns:
            name += "_"
        out.append(name)
    return out
