"""Incremental yearly ingestion: every arriving file is processed once, and a year delivered again replaces itself."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridprep.sources.cellgrid import register
from gridprep.sources.text_files import append_years


def ingest_years(spark: SparkSession, source: str, target: str, checkpoint: str, schema: str | None, transform: Callable[[DataFrame], DataFrame] | None = None, kind: str = "parquet") -> None:
    """Processes all files in ``source`` that weren't before and returns.

    The stream's checkpoint remembers the files; each batch overwrites just the years it holds, so a batch that is run
    again after a failure leaves the same rows. ``transform`` gets a batch and returns rows with a year column. ``kind``: the
    files' format; native files (cellgrid) have a schema of their own.
    """

    def write(batch: DataFrame, _: int) -> None:
        out = transform(batch) if transform else batch
        append_years(out, target)

    if kind == "cellgrid":
        register(spark)
    reader = spark.readStream.format(kind)
    stream = (reader.schema(schema) if schema else reader).load(source)
    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
