"""Bar files as a stream: each file is loaded once, whatever its date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from barloom.jobs.ingest import TABLE_OF, landed_rows
from barloom.plans.filters import keep_where
from barloom.schemas import LANDED_CSV
from barloom.sources.flatfiles import CSV_OPTIONS
from barloom.sources.warehouse import SOURCE, Warehouse


def stream_bars(
    spark: SparkSession, root: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Landed bars as a stream; a trigger reads at most so many files."""
    reader = (
        spark.readStream.schema(LANDED_CSV)
        .options(**CSV_OPTIONS)
    )
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(root).withColumn("path", F.col("_metadata.file_path"))


def ingest_stream(
    wh: Warehouse,
    kind: str,
    root: str,
    checkpoint: str,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Load all files that the checkpoint has not seen yet, then stop.

    A batch is written under its own source name, so that a batch which is tried again
    replaces what its first try left. Dates that a batch load has brought are left out, and
    a batch load of a date replaces what streams brought of it.
    """
    rows = landed_rows(stream_bars(wh.spark, root, max_files_per_trigger), kind)

    def write(batch: DataFrame, batch_id: int) -> None:
        source = F.concat(F.coalesce(F.col(SOURCE), F.lit("undated")), F.lit(f"_b{batch_id}"))
        loaded = [s for s in wh.sources(TABLE_OF[kind]) if "_b" not in s]  # dates
        good = keep_where(batch, F.col("reject").isNull())
        good = good.filter(F.col(SOURCE).isNull() | ~F.col(SOURCE).isin(loaded))
        wh.write(good.withColumn(SOURCE, source), TABLE_OF[kind], "replace")

    return (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
