"""Helpers shared by the operators: tables, folds, shared tables, and Arrow batches in pieces."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.session import run_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Bytes of text that one numpy pass takes at once; a longer document is a pass of its own.
PIECE_BYTES = 1 << 20


def query(name: str, oracle: str | None = None):
    """Register a query, with its SQL twin where SQL can express it."""

    def register(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(modulus: int, doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo. A null id counts as the empty text, whose crc32 is 0."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % F.lit(modulus)


#: Spark's setting by which the shuffle files of a query go when it ends.
FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Shared:
    """Tables of one run in the shared folder. Reading one back cuts the lineage, and lost
    executors cost nothing that was written before. So the shuffle files of a table go as soon as
    it is written: a run of many steps holds those of one step only."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder = spark, run_dir(spark, name)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        before = self.spark.conf.get(FILE_CLEANUP, None)
        self.spark.conf.set(FILE_CLEANUP, "true")
        try:
            df.write.parquet(path)
        finally:
            self.spark.conf.unset(FILE_CLEANUP) if before is None else self.spark.conf.set(FILE_CLEANUP, before)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        """Delete a table that nothing reads any more."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def give_back() -> None:
    """Return to the system what this process has freed. An idle worker would keep it, and an
    executor has several."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def pieces(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = PIECE_BYTES, rows: int = 1 << 30
) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows with about ``limit`` bytes of text, and ``rows`` rows at most."""
    try:
        for batch in batches:
            if not batch.num_rows:
                continue
            sizes = batch.column(column).nbytes
            if sizes <= limit and batch.num_rows <= rows:
                yield batch
                continue
            lengths = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
            begin = held = 0
            for i, n in enumerate(lengths):
                if (held and held + n > limit) or i - begin >= rows:
                    yield batch.slice(begin, i - begin)
                    begin, held = i, 0
                held += int(n)
            yield batch.slice(begin)
    finally:
        give_back()


def labelled_sample(
    labels: DataFrame, label: str | Column, modulus: int, held_out: int, per_class: int, classes: int = 2
) -> DataFrame:
    """(doc_id, y) of about ``per_class`` labelled rows of each class, outside the held-out fold.

    Rows are chosen by a hash of their id below a share of the class's size, so the choice takes
    no sort and is the same on every run. Null ids and labels are left out. The size is bounded
    by ``per_class`` (within the square root of it), whatever the table's size.
    """
    label = F.col(label) if isinstance(label, str) else label
    own = labels.where(fold(modulus) != held_out).select(F.col("doc_id").cast("long").alias("doc_id"), label.cast("int").alias("y"))
    own = own.where(F.col("doc_id").isNotNull() & F.col("y").between(0, classes - 1)).groupBy("doc_id").agg(F.max("y").alias("y"))
    sizes = {r["y"]: r["count"] for r in own.groupBy("y").count().collect()}
    if not sizes:
        return own
    share = F.lit(0.0)
    for y, n in sizes.items():
        share = F.when(F.col("y") == y, F.lit(min(1.0, per_class / n))).otherwise(share)
    place = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return own.where(place < share)


def class_shares(labels: DataFrame, label: str, modulus: int, held_out: int) -> float:
    """Share of label 1 among all labelled rows outside the held-out fold; 0.5 if there is none."""
    own = labels.where(fold(modulus) != held_out).where(F.col(label).cast("int").isin(0, 1))
    share = own.agg(F.avg(F.col(label).cast("double"))).first()[0]
    return 0.5 if share is None else min(max(share, 1e-4), 1 - 1e-4)
