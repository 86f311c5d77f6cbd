"""Structured Streaming use of the row-wise cleaners.

Age and name parsing are narrow projections (no state, no aggregation), so
they run unchanged on a streaming DataFrame: new files (or Kafka records)
are parsed micro-batch by micro-batch. A run that ends and is started again with
the same checkpoint goes on with the files it hasn't seen; the file sink commits
each batch once, so none is lost or written twice. Roster standardization needs
whole sheets and stays a batch job.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def run_file_stream(spark: SparkSession, source: str, schema: str | StructType, transform: Callable[[DataFrame], DataFrame],
                    sink_dir: str, checkpoint_dir: str, fmt: str = "parquet", available_now: bool = True,
                    files_per_batch: int | None = None) -> StreamingQuery:
    """Read the files that ``source`` holds or gets, apply ``transform`` and append the
    result to ``sink_dir`` (exactly-once file sink with its own checkpoint)."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    out = transform(reader.load(source))
    w = out.writeStream.format("parquet").option("path", sink_dir).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.outputMode("append").start()


def clean_available(spark: SparkSession, source: str, schema: str | StructType, transform: Callable[[DataFrame], DataFrame],
                    folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Runs a file stream over everything that ``source`` holds by now and reads its sink.

    ``folder`` keeps the sink and the checkpoint: a later call takes up new files only, also after a run that failed."""
    query = run_file_stream(spark, source, schema, transform, f"{folder}/out", f"{folder}/checkpoint", files_per_batch=files_per_batch)
    query.awaitTermination()
    return spark.read.parquet(f"{folder}/out")
