"""Writing metrics: the partitioned metric table and OTLP-style JSON documents."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from gaugeworks.functions.numbers import micros
from gaugeworks.functions.records import record
from gaugeworks.functions.text import clip_bytes
from gaugeworks.operators.union import OUTCOME
from gaugeworks.schema import METRIC_DDL

SCOPE_NAME = "gaugeworks"
SCOPE_VERSION = "1.0"
ROWS_PER_DOCUMENT = 1000
# Rows whose documents a task hands on together, and that it packs into blocks at a time.
ROWS_AT_ONCE = 10_000


def write_metrics(metrics: DataFrame, path: str, mode: str = "append") -> None:
    """Write the metric table partitioned by date.

    The rebalance hint gives files of even size and splits a date that holds most rows.
    """
    dated = metrics.withColumn("date", F.to_date("ts")).hint("rebalance", "date")
    dated.write.mode(mode).partitionBy("date").parquet(path)


def write_outcomes(marked: DataFrame, path: str, mode: str = "append") -> None:
    """Write good and rejected rows (``mark_nonfinite``) in one pass, apart by outcome and date."""
    dated = marked.withColumn("date", F.to_date("ts")).hint("rebalance", OUTCOME, "date")
    dated.write.mode(mode).partitionBy(OUTCOME, "date").parquet(path)


def write_batch(metrics: DataFrame, path: str, number: int) -> None:
    """Write one micro-batch of metrics under its number, in place of what an earlier try of the
    same number has left, whole or half-written. Its mark of success comes last."""
    dated = metrics.withColumn("date", F.to_date("ts"))
    dated.write.mode("overwrite").partitionBy("date").parquet(f"{path}/batch={number}")


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """Metric rows of all batches that were written to the end, with ``date`` and ``batch``."""
    schema = T.StructType.fromDDL(f"{METRIC_DDL}, date date, batch bigint")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    marks = files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/batch=*/_SUCCESS"))
    whole = [str(m.getPath().getParent()) for m in marks or []]
    if not whole:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*whole)


def otlp_attributes(attrs: Column, clip: int | None = None) -> Column:
    """Attribute list sorted by key; ``clip`` cuts values to so many bytes."""
    def text(value: Column) -> Column:
        return value if clip is None else clip_bytes(value, clip)

    return F.transform(
        F.array_sort(F.map_entries(attrs)),
        lambda e: record(key=e["key"], value=record(stringValue=text(e["value"]))),
    )


def otlp_metric(ts: Column | None = None, clip: int | None = None) -> Column:
    """One gauge with one data point as a struct."""
    nanos = (micros(F.col("ts") if ts is None else ts) * 1000).cast("string")
    point = record(
        timeUnixNano=nanos,
        asDouble=F.col("value"),
        attributes=otlp_attributes(F.col("attrs"), clip),
    )
    return record(name=F.col("name"), unit=F.col("unit"), gauge=record(dataPoints=F.array(point)))


def _blocks(keys: Sequence[str]):
    """Rows (keys, m) to blocks: the rows of a batch among ``ROWS_AT_ONCE``, as one compressed list."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(start, ROWS_AT_ONCE)
                metric, first, texts = batch.column("m").to_pylist(), [], {}
                for i, own in enumerate(zip(*[batch.column(k).to_pylist() for k in keys])):
                    if (name := repr(own)) not in texts:
                        texts[name] = []
                        first.append(i)
                    texts[name].append(metric[i])
                packed = [pack(json.dumps(sorted(t)).encode()) for t in texts.values()]
                heads = batch.select(list(keys)).take(pa.array(first, pa.int64()))
                yield pa.RecordBatch.from_arrays([*heads.columns, pa.array(packed, pa.binary())], [*keys, "gw_block"])

    return each


def _closed(keys: Sequence[str], max_rows: int):
    """Blocks sorted by batch to documents: a running count closes one at ``max_rows``. A document's
    rows are in the order of their text."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        key, head, texts, number = None, None, [], 0
        done: list[tuple[pa.RecordBatch, str, int, str]] = []

        def ready() -> pa.RecordBatch:
            heads = pa.Table.from_batches([d[0] for d in done]).combine_chunks()
            columns = [heads.column(k).combine_chunks() for k in keys]
            names, sizes, bodies = (list(c) for c in zip(*[d[1:] for d in done]))
            done.clear()
            return pa.RecordBatch.from_arrays(
                [*columns, pa.array(names), pa.array(sizes, pa.int64()), pa.array(bodies)],
                [*keys, "document", "n_metrics", "metrics"],
            )

        def close() -> None:
            nonlocal number
            done.append((head, f"{task}-{number}", len(texts), ",".join(sorted(texts))))
            number += 1
            texts.clear()

        unpack = zstandard.ZstdDecompressor().decompress
        held = 0
        for batch in batches:
            for i, own in enumerate(zip(*[batch.column(k).to_pylist() for k in keys])):
                if own != key:
                    if texts:
                        close()
                    key, head = own, batch.slice(i, 1).select(list(keys))
                rows = json.loads(unpack(batch.column("gw_block")[i].as_py()))
                held += len(rows)
                while rows:
                    room = max_rows - len(texts)
                    texts += rows[:room]
                    rows = rows[room:]
                    if len(texts) == max_rows:
                        close()
                if held >= ROWS_AT_ONCE and done:
                    yield ready()
                    held = 0
        if texts:
            close()
        if done:
            yield ready()

    return each


def otlp_batches(
    metrics: DataFrame,
    resource: Column,
    batch_keys: Sequence[str] = ("cycle_id",),
    max_rows: int = ROWS_PER_DOCUMENT,
    batch_time: Column | None = None,
    scope: tuple[str, str] = (SCOPE_NAME, SCOPE_VERSION),
    clip: int | None = None,
) -> DataFrame:
    """One JSON document per batch, or several of ``max_rows`` at most when a batch is large.

    One shuffle, no counting beforehand: rows are rebalanced by batch, so a batch lies in one
    task unless it is so large that adaptive execution splits it, and each task closes its
    documents by a running count over its sorted rows. Copies of a row are rows like any other.
    Rows travel in compressed blocks. Adaptive execution deals by bytes as they are shuffled, and
    rows of JSON text take some 35 times as much when sorted; blocks take what they were dealt by.

    ``resource`` is the map of resource attributes, out of the batch keys. Rows keep their own
    time unless ``batch_time`` is given. ``clip`` cuts attribute values of data points to so many
    bytes. Pass rows through ``quarantine_nonfinite`` first.
    """
    keys = list(batch_keys)
    text = F.to_json(otlp_metric(batch_time, clip)).alias("m")
    rows = metrics.select(*keys, text)
    block = T.StructType([*[metrics.schema[k] for k in keys], T.StructField("gw_block", T.BinaryType())])
    blocks = rows.mapInArrow(_blocks(keys), block).hint("rebalance", *keys).sortWithinPartitions(*keys, "gw_block")
    fields = [metrics.schema[k] for k in keys] + [
        T.StructField("document", T.StringType()),
        T.StructField("n_metrics", T.LongType()),
        T.StructField("metrics", T.StringType()),
    ]
    documents = blocks.mapInArrow(_closed(keys, max_rows), T.StructType(fields))
    about = F.to_json(record(attributes=otlp_attributes(resource)))
    by = F.to_json(record(name=F.lit(scope[0]), version=F.lit(scope[1])))
    body = F.concat(
        F.lit('{"resourceMetrics":[{"resource":'), about, F.lit(',"scopeMetrics":[{"scope":'), by,
        F.lit(',"metrics":['), F.col("metrics"), F.lit("]}]}]}"),
    )
    return documents.select(*keys, "document", "n_metrics", body.alias("body"))


def write_otlp(documents: DataFrame, path: str, mode: str = "append") -> None:
    """Write documents as JSON lines."""
    documents.select("body").write.mode(mode).text(path)
