"""Incremental runs over growing folders of files: waiting, resuming and back-pressure by Structured Streaming."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def files(spark: SparkSession, path: str, schema: StructType | str, kind: str = "parquet", glob: str | None = None, per_batch: int = 100) -> DataFrame:
    """A stream of the files below ``path``, at most ``per_batch`` of them at a time."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.format(kind).load(path)


def run_available(stream: DataFrame, out: str, state: str, by: list[str] | None = None) -> StreamingQuery:
    """Processes what is there now and ends; a later run with the same ``state`` takes up only what is new."""
    writer = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True)
    query = (writer.partitionBy(*by) if by else writer).start()
    query.awaitTermination()
    return query


def each_batch(stream: DataFrame, work: Callable[[DataFrame, int], None], state: str, every: str | None = None) -> StreamingQuery:
    """Calls ``work`` with every batch of new rows: until told to stop if ``every`` is an interval, else for what is there now."""
    writer = stream.writeStream.foreachBatch(work).option("checkpointLocation", state)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def wait_for(there: Callable[[], bool], timeout: float | None = None, every: float = 1.0) -> bool:
    """Whether something came to be there within ``timeout`` seconds; waits for ever without one."""
    until = None if timeout is None else time.monotonic() + timeout
    while not there():
        if until is not None and time.monotonic() >= until:
            return False
        time.sleep(every)
    return True
