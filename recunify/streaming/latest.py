"""The latest row per key (W4) kept up by a stream.

State is the latest row of each (key, day): a streaming aggregation in Spark's
state store, combined map-side, so a hot key sends one row a day from a task.
A watermark of the hot window bounds it: once the newest day seen is more than
``days`` later, a day's state is dropped, and rows of such a day, which come
late, are ignored.  The hot window would leave them out anyway, so whatever
order the files come in, the result is that of ``operators.dedup.latest_dedup``
for the newest day seen.

Each micro-batch writes the (key, day) rows that it changed under its own
``ingest_batch`` partition by a dynamic overwrite: a batch replayed after a
failure rewrites its own files.  ``latest_rows`` reads the table: of a key's
changed rows the latest wins.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from recunify.operators.dedup import latest_dedup
from recunify.sinks.writers import overwrite_partitions
from recunify.streaming.ingest import BATCH_COL


def stream_latest(spark: SparkSession, source_path: str, schema: StructType, sink_path: str, checkpoint: str,
                  keys: Sequence[str], order: Sequence[str], day_col: str = "update_day", days: int = 60,
                  fmt: str = "parquet", max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start (and return) an available-now stream that keeps the latest row of each (key, day).

    Rows without a day are left out, as by the batch rule.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    time = F.to_timestamp(day_col, "yyyy-MM-dd")
    rows = reader.load(source_path).withColumn("__time", time).withWatermark("__time", f"{days} days")
    best = F.max(F.struct(*[F.col(c).alias(f"__o{i}") for i, c in enumerate(order)],
                          F.struct(*[F.col(c) for c in schema.names]).alias("__row")))
    latest = rows.groupBy(*keys, F.window("__time", "1 day").alias("__day")).agg(best.alias("__best")).select("__best.__row.*")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        overwrite_partitions(batch.withColumn(BATCH_COL, F.lit(batch_id).cast("long")), sink_path, [BATCH_COL])

    return (latest.writeStream.outputMode("update").foreachBatch(write_batch)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def latest_rows(spark: SparkSession, sink_path: str, schema: StructType, keys: Sequence[str], order: Sequence[str],
                as_of: str, day_col: str = "update_day", days: int = 60) -> DataFrame:
    """The latest row per key in the hot window before ``as_of``, from the table that ``stream_latest`` keeps."""
    changed = spark.read.schema(schema).parquet(sink_path)
    return latest_dedup(changed, list(keys), list(order), day_col=day_col, as_of=as_of, days=days, columns=schema.names)

