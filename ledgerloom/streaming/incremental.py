"""Incremental runs as file streams: each new record file is processed once, then the run ends.

A record that fails becomes a row with ``error`` set, so one bad input never stops or drops the rest.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def process_new(spark: SparkSession, source: str, schema: str, sink: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame], files_per_batch: int = 1000) -> StreamingQuery:
    """Transform the record files that came since the last run into Parquet; deleting ``checkpoint`` recomputes all."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(source)
    return transform(rows).writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def with_errors(df: DataFrame, value: Column, name: str, reason: str) -> DataFrame:
    """Adds a value, and sets ``error`` where it could not be made."""
    return df.withColumn(name, value).withColumn("error", F.when(F.col(name).isNull(), F.lit(reason)))


def latest_by_key(spark: SparkSession, source: str, schema: str, key: str, order: str, table: str, checkpoint: str) -> StreamingQuery:
    """Keep the last record of each key in a Parquet folder, batch by batch."""
    from ledgerloom.operators.analytics import latest

    def merge(batch: DataFrame, number: int) -> None:
        new = latest(batch, [key], order)
        previous = f"{table}/v{number - 1}"
        if number:
            new = latest(new.unionByName(spark.read.parquet(previous)), [key], order)
        new.write.mode("overwrite").parquet(f"{table}/v{number}")

    return spark.readStream.schema(schema).json(source).writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
