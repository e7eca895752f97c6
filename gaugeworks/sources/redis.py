"""Redis INFO text and slow log."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gaugeworks.functions.attrs import base_attrs, make_attrs
from gaugeworks.functions.numbers import ratio
from gaugeworks.functions.text import info_pairs
from gaugeworks.operators.ordered import log_head
from gaugeworks.operators.shape import keyed, kv_num, kv_specs, kv_text, to_metrics
from gaugeworks.schema import KEYS

# INFO key, metric name, unit.
INFO = [
    ("connected_clients", "db.redis.connections.connected", "{connections}"),
    ("blocked_clients", "db.redis.connections.blocked", "{connections}"),
    ("used_memory", "db.redis.memory.used_bytes", "By"),
    ("used_memory_peak", "db.redis.memory.peak_bytes", "By"),
    ("mem_fragmentation_ratio", "db.redis.memory.fragmentation_ratio", "1"),
    ("keyspace_hits", "db.redis.keyspace.hits", "{hits}"),
    ("keyspace_misses", "db.redis.keyspace.misses", "{misses}"),
    ("total_commands_processed", "db.redis.commands.processed", "{commands}"),
    ("instantaneous_ops_per_sec", "db.redis.commands.per_second", "{ops}/s"),
    ("evicted_keys", "db.redis.evictions", "{keys}"),
    ("expired_keys", "db.redis.expired_keys", "{keys}"),
]
OTHER_KEYS = ["role", "master_repl_offset", "slave_repl_offset"]
VERSION_KEY = "redis_version"
SLOWLOG_ENTRIES = 10


def info(df: DataFrame) -> DataFrame:
    """Mapped INFO gauges, hit ratio, and the replication lag of replicas."""
    keys = [m[0] for m in INFO] + OTHER_KEYS
    hits, misses = kv_num("keyspace_hits"), kv_num("keyspace_misses")
    behind = kv_num("master_repl_offset") - kv_num("slave_repl_offset")
    specs = kv_specs(INFO) + [
        ("db.redis.keyspace.hit_ratio", ratio(hits, hits + misses), "1"),
        ("db.redis.replication.lag", F.when(kv_text("role") == "slave", behind), "{bytes}"),
    ]
    return to_metrics(keyed(df, info_pairs(F.col("body"), keys)), specs, base_attrs("redis"))


def instance_version(df: DataFrame) -> DataFrame:
    """Instance row with the version out of the INFO text."""
    attrs = make_attrs(
        {
            "db.system": F.lit("redis"),
            "db.version": kv_text(VERSION_KEY),
            "db.name": F.col("target_name"),
            "db.instance": F.col("instance"),
        }
    )
    parsed = keyed(df.where("body is not null"), info_pairs(F.col("body"), [VERSION_KEY]))
    return to_metrics(parsed, [("db.instance.info", F.lit(1), "1")], attrs)


def slowlog(df: DataFrame, scrapes: DataFrame | None = None) -> DataFrame:
    """Number of recent slow entries and the duration of the latest one."""
    head = log_head(df, KEYS, "entry_id", "duration_us", SLOWLOG_ENTRIES)
    if scrapes is not None:
        head = scrapes.select(*KEYS).join(head, KEYS, "full")
    specs = [
        ("db.redis.slowlog.count", F.coalesce("n", F.lit(0)), "{entries}"),
        ("db.redis.slowlog.latest_duration_us", F.col("latest"), "us"),
    ]
    return to_metrics(head, specs, base_attrs("redis"))
