"""Incremental form of the daily ingest jobs (Structured Streaming).

The reference runs its daily jobs as batches over "the files of day D".
The same work as a file stream with ``trigger(availableNow=True)``: each
run picks up only files not yet processed (tracked in the checkpoint, on
the shared filesystem) and applies the batch transformation.  Each
micro-batch is written under its own ``ingest_batch=<id>`` partition (below
the data's partition columns) with a dynamic partition overwrite: a batch
replayed after a failure rewrites exactly its own files, and two batches
carrying rows of the same day never replace each other's rows.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from recunify.sinks.writers import overwrite_partitions

BATCH_COL = "ingest_batch"


def ingest_files(spark: SparkSession, source_path: str, schema: StructType, sink_path: str,
                 partition_cols: Sequence[str], checkpoint: str,
                 transform: Callable[[DataFrame], DataFrame] = lambda df: df,
                 fmt: str = "parquet", max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start (and return) an available-now stream from ``source_path`` into
    ``sink_path``.  ``transform`` is any batch operator of this library
    (it runs per micro-batch, so it must not need rows of other batches)."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(source_path)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        out = transform(batch).withColumn(BATCH_COL, F.lit(batch_id).cast("long"))
        overwrite_partitions(out, sink_path, list(partition_cols) + [BATCH_COL])

    return (stream.writeStream.foreachBatch(write_batch)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
