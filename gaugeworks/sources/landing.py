"""Reading target settings and landed tables, batch or stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gaugeworks.functions.records import record
from gaugeworks.schema import landed_schema

TARGET = "struct<type: string, dsn: string, name: string>"
#: Bytes of a row group of landed replies.
ROW_GROUP_BYTES = 8 << 20
# Spellings that switch the host target on.
HOST_ON = ["true", "1"]


def load_targets(
    settings: DataFrame, host_flag: Column | None = None, host_name: Column | None = None
) -> DataFrame:
    """Targets out of a JSON list in ``primary``, or in ``fallback`` when that is empty.

    Settings that are no JSON list, or an empty one, give no targets. The host target is
    added when its flag is on.
    """
    text = F.coalesce(F.nullif("primary", F.lit("")), "fallback")
    wrapped = F.concat(F.lit('{"t":'), text, F.lit("}"))
    parsed = F.from_json(wrapped, f"t array<{TARGET}>, _corrupt_record string")
    listed = F.when(parsed["_corrupt_record"].isNull(), parsed["t"])
    flag = F.lit("") if host_flag is None else host_flag
    name = F.lit("host") if host_name is None else F.coalesce(F.nullif(host_name, F.lit("")), F.lit("host"))
    host = F.array(
        record(type=F.lit("host"), dsn=F.lit(""), name=name)
    )
    on = F.coalesce(flag, F.lit("")).isin(HOST_ON)
    targets = settings.select(listed.alias("t"), on.alias("on"), host.alias("host")).where(
        F.size("t") > 0
    )
    every = F.when(F.col("on"), F.concat("t", "host")).otherwise(F.col("t"))
    return targets.select(F.inline(every)).select(
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("type", "dsn", "name")]
    )


def read_landed(
    spark: SparkSession, path: str, table: str, stream: bool = False, **options: str
) -> DataFrame:
    """Scan a landed table with its fixed schema, as a batch or as a stream of files."""
    reader = spark.readStream if stream else spark.read
    return reader.schema(landed_schema(table)).options(**options).parquet(path)


def read_snapshots(
    spark: SparkSession, path: str, stream: bool = False, **options: str
) -> DataFrame:
    """Scan landed raw replies. Lay them out by ``target_type`` and ``endpoint`` to prune."""
    return read_landed(spark, path, "raw_snapshots", stream, **options)


def write_snapshots(snapshots: DataFrame, path: str, mode: str = "append") -> None:
    """Land raw replies partitioned so that each job reads its own endpoint only.

    Parsing is the work of the jobs that read them, and a row group is the least a task can be
    given, so row groups are small.
    """
    spread = snapshots.hint("rebalance", "target_type", "endpoint")
    writer = spread.write.mode(mode).option("parquet.block.size", ROW_GROUP_BYTES)
    writer.partitionBy("target_type", "endpoint").parquet(path)


def route(snapshots: DataFrame, target_type: str, endpoint: str | None = None) -> DataFrame:
    """Replies of one source family, and of one endpoint where asked."""
    kept = snapshots.where(F.col("target_type") == target_type)
    return kept if endpoint is None else kept.where(F.col("endpoint") == endpoint)
