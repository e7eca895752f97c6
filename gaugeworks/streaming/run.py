"""Running metric streams: triggers, sinks, and draining a stream in one go."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from gaugeworks.session import ROCKSDB, STATE_STORE_KEY
from gaugeworks.sources.sinks import write_batch

# Collection interval in milliseconds.
MIN_INTERVAL_MS = 1000
DEFAULT_INTERVAL_MS = 15_000


def interval_ms(asked: int) -> int:
    """The asked interval, or the default when it is too short."""
    return asked if asked >= MIN_INTERVAL_MS else DEFAULT_INTERVAL_MS


def run_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    every_ms: int = DEFAULT_INTERVAL_MS,
    drain: bool = False,
    partition_by: list[str] | None = None,
) -> StreamingQuery:
    """Start writing a stream as parquet, on a fixed interval or until the input is used up."""
    writer = stream.writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if drain:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{interval_ms(every_ms)} milliseconds").start()


def metric_stream(metrics: DataFrame, path: str, checkpoint: str, **kw) -> StreamingQuery:
    """Write a stream of metric rows partitioned by date."""
    dated = metrics.withColumn("date", F.to_date("ts"))
    return run_stream(dated, path, checkpoint, partition_by=["date"], **kw)


def each_batch(
    stream: DataFrame,
    job: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    every_ms: int = DEFAULT_INTERVAL_MS,
    drain: bool = False,
) -> StreamingQuery:
    """Run a batch job on every micro-batch, for jobs that rank or group one scrape.

    A job sees what lies in one micro-batch: pass the stream through ``hold_scrapes`` where a
    scrape may come in several files. Each batch has a folder of its own that a repeated run
    replaces, so a batch that is retried after a failure is not written twice; ``read_batches``
    leaves out one that was not written to its end.
    """

    def write(batch: DataFrame, number: int) -> None:
        write_batch(job(batch), path, number)

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if drain:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{interval_ms(every_ms)} milliseconds").start()


@contextmanager
def state_settings(spark: SparkSession) -> Iterator[None]:
    """Settings that stateful operators need at start; the session gets its own back."""
    wanted = {STATE_STORE_KEY: ROCKSDB}
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
