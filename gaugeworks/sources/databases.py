"""MySQL, SQLite and ClickHouse tables, and instance versions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gaugeworks.functions.attrs import base_attrs, make_attrs
from gaugeworks.functions.numbers import kib_to_pages, num_prefix, num_strict, ratio
from gaugeworks.operators.aggregate import count_sum
from gaugeworks.operators.shape import emit, keep_keys, map_names, to_metrics
from gaugeworks.schema import KEYS

# Status key, metric name, unit.
MYSQL_STATUS = [
    ("Threads_connected", "db.mysql.connections.current", "{connections}"),
    ("Threads_running", "db.mysql.connections.running", "{connections}"),
    ("Questions", "db.mysql.queries.total", "{queries}"),
    ("Slow_queries", "db.mysql.queries.slow", "{queries}"),
    ("Bytes_sent", "db.mysql.bytes.sent", "By"),
    ("Bytes_received", "db.mysql.bytes.received", "By"),
    ("Innodb_row_lock_waits", "db.mysql.innodb.row_lock_waits", "{waits}"),
    ("Innodb_row_lock_time", "db.mysql.innodb.row_lock_time_ms", "ms"),
    ("Aborted_connects", "db.mysql.connections.aborted", "{connections}"),
    ("Table_locks_waited", "db.mysql.table_locks.waited", "{locks}"),
]
POOL_REQUESTS = "Innodb_buffer_pool_read_requests"
POOL_READS = "Innodb_buffer_pool_reads"

CLICKHOUSE_METRICS = [
    ("Query", "db.clickhouse.queries.active", "{queries}"),
    ("HTTPConnection", "db.clickhouse.connections.http", "{connections}"),
    ("TCPConnection", "db.clickhouse.connections.tcp", "{connections}"),
    ("MemoryTracking", "db.clickhouse.memory.tracked_bytes", "By"),
]
CLICKHOUSE_EVENTS = [
    ("Query", "db.clickhouse.queries.total", "{queries}"),
    ("FailedQuery", "db.clickhouse.queries.failed", "{queries}"),
    ("Merge", "db.clickhouse.merges.total", "{merges}"),
    ("InsertedRows", "db.clickhouse.inserted_rows", "{rows}"),
    ("InsertedBytes", "db.clickhouse.inserted_bytes", "By"),
    ("SelectedRows", "db.clickhouse.selected_rows", "{rows}"),
    ("SelectedBytes", "db.clickhouse.selected_bytes", "By"),
]
# Families whose instance row appears even without a version.
VERSION_OPTIONAL = ["postgres"]


def instance_info(df: DataFrame) -> DataFrame:
    """Constant-1 row per instance that carries the server version."""
    shown = df.where(F.col("version").isNotNull() | F.col("target_type").isin(VERSION_OPTIONAL))
    attrs = make_attrs(
        {
            "db.system": F.col("target_type"),
            "db.version": F.col("version"),
            "db.name": F.col("target_name"),
            "db.instance": F.col("instance"),
        }
    )
    return to_metrics(shown, [("db.instance.info", F.lit(1), "1")], attrs)


def mysql_status(df: DataFrame) -> DataFrame:
    """Mapped status gauges and the buffer pool hit ratio; the last listed value of a key counts.

    One aggregate per scrape: each wanted key is a conditional last value. Values are parsed
    to numbers first, so the buffers are fixed width and the hash aggregate combines a scrape
    on the map side before its single shuffle.
    """
    keys = [m[0] for m in MYSQL_STATUS] + [POOL_REQUESTS, POOL_READS]
    parsed = keep_keys(df, keys, "name").select(
        *KEYS, "pos", "name", num_strict(F.col("value")).alias("num")
    )
    wide = parsed.groupBy(*KEYS).agg(
        *[F.max_by("num", F.when(F.col("name") == k, F.col("pos"))).alias(k) for k in keys]
    )
    requests, reads = F.col(POOL_REQUESTS), F.col(POOL_READS)
    specs = [(name, F.col(key), unit) for key, name, unit in MYSQL_STATUS]
    specs.append(
        ("db.mysql.innodb.buffer_pool_hit_ratio", ratio(requests - reads, requests), "1")
    )
    return to_metrics(wide, specs, base_attrs("mysql"))


def _clickhouse_named(df: DataFrame, column: str, mapping: list) -> DataFrame:
    numbered = df.withColumn("value", num_prefix(F.col("value")))
    named = map_names(numbered, mapping, column, "value")
    row = F.array(F.struct("name", "value", "unit"))
    return emit(named, row, base_attrs("clickhouse"))


def clickhouse_metrics(df: DataFrame) -> DataFrame:
    return _clickhouse_named(df, "metric", CLICKHOUSE_METRICS)


def clickhouse_events(df: DataFrame) -> DataFrame:
    return _clickhouse_named(df, "event", CLICKHOUSE_EVENTS)


def clickhouse_parts(df: DataFrame) -> DataFrame:
    """Count and size of the active parts."""
    sums = count_sum(df, KEYS, F.col("active") == 1, "bytes_on_disk")
    specs = [
        ("db.clickhouse.parts.active", F.col("n"), "{parts}"),
        ("db.clickhouse.parts.total_bytes", F.col("total"), "By"),
    ]
    return to_metrics(sums, specs, base_attrs("clickhouse"))


def sqlite_pragmas(df: DataFrame, drop_negative_checkpoint: bool = False) -> DataFrame:
    """Sizes in bytes and pages. A negative cache size is in KiB and is turned into pages."""
    count = F.coalesce("page_count", F.lit(0))
    size = F.coalesce("page_size", F.lit(0))
    cache = F.col("cache_size")
    pages = F.when(cache < 0, kib_to_pages(-cache, size)).otherwise(cache)
    done = F.col("checkpointed")
    if drop_negative_checkpoint:
        done = F.when(done >= 0, done)
    specs = [
        (
            "db.sqlite.database_size_bytes",
            F.when((count > 0) & (size > 0), count.cast("double") * size),
            "By",
        ),
        ("db.sqlite.page_size", size, "By"),
        ("db.sqlite.cache_size_pages", pages, "{pages}"),
        ("db.sqlite.wal_checkpoint_count", done, "{checkpoints}"),
    ]
    return to_metrics(df, specs, base_attrs("sqlite"))
