"""Column contracts: the canonical metric table and the landed input tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Every landed table starts with these columns; they identify one scrape of one target.
KEYS = ["cycle_id", "collected_at", "target_name", "instance"]
KEY_DDL = "cycle_id bigint, collected_at timestamp_ntz, target_name string, instance string"

METRIC_DDL = (
    "ts timestamp_ntz, cycle_id bigint, target string, name string, "
    "value double, unit string, attrs map<string,string>"
)
METRIC_COLUMNS = ["ts", "cycle_id", "target", "name", "value", "unit", "attrs"]

KEY_LISTING = "key string, kind string, size bigint, value string"

# Columns of each landed table, after the key columns.
LANDED = {
    "raw_snapshots": "target_type string, endpoint string, body string",
    "server_version": "target_type string, version string",
    "pg_stat_database": (
        "datname string, numbackends bigint, xact_commit bigint, xact_rollback bigint, "
        "blks_read bigint, blks_hit bigint, tup_returned bigint, tup_fetched bigint, "
        "tup_inserted bigint, tup_updated bigint, tup_deleted bigint, deadlocks bigint, "
        "temp_bytes bigint"
    ),
    "pg_database_size": "datname string, size_bytes bigint",
    "pg_stat_activity": (
        "datname string, state string, wait_event_type string, query_start timestamp_ntz"
    ),
    "pg_stat_user_tables": (
        "schemaname string, relname string, seq_scan bigint, idx_scan bigint, "
        "n_dead_tup bigint, n_live_tup bigint"
    ),
    "pg_extension": "extname string",
    "pg_stat_statements": "queryid string, query string, mean_exec_time double, calls bigint",
    "mysql_status": "pos bigint, name string, value string",
    "sqlite_pragmas": (
        "page_count bigint, page_size bigint, cache_size bigint, checkpointed bigint"
    ),
    "redis_slowlog": "entry_id bigint, duration_us bigint",
    "ch_metrics": "metric string, value string",
    "ch_events": "event string, value string",
    "ch_parts": "active int, bytes_on_disk bigint",
    "kafka_brokers": "host string, port int, is_controller boolean",
    "kafka_partitions": "topic string, partition int, replicas array<int>, isr array<int>",
    "kafka_groups": "group_id string, state string",
    "kafka_committed": "group_id string, topic string, partition int, committed_offset bigint",
    "kafka_end_offsets": "topic string, partition int, last_offset bigint",
    "redis_keys": KEY_LISTING,
    "bullmq_keys": KEY_LISTING,
    "celery_keys": KEY_LISTING,
    "sidekiq_keys": KEY_LISTING,
    "pg_current_database": "datname string",
    "scrapes": "table_name string",
    "host_facts": "host_name string, arch string, os_type string",
    "sqs_queues": "pos bigint, queue_url string, attributes map<string,string>",
    "mounts": (
        "pos bigint, device string, mountpoint string, fstype string, blocks bigint, "
        "bsize bigint, bfree bigint, bavail bigint, statfs_ok boolean"
    ),
}

# Landed tables of the agent itself; these carry their own keys.
AGENT = {
    "targets": "type string, dsn string, name string",
    "attempts": (
        "cycle_id bigint, collector_id string, type string, ts timestamp_ntz, attempt_no int, "
        "duration_ms bigint, ok boolean, error string"
    ),
    "sends": (
        "batch_id string, agent_id string, ts timestamp_ntz, try_no int, status int, "
        "ok boolean, error string"
    ),
    "discoveries": "collector_id string, ts timestamp_ntz, queues array<string>",
}


def landed_schema(table: str) -> T.StructType:
    """StructType of a landed table, for readers that must not infer a schema."""
    ddl = f"{KEY_DDL}, {LANDED[table]}" if table in LANDED else AGENT[table]
    return T.StructType.fromDDL(ddl)
