"""Which job reads which landed endpoint or table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from gaugeworks.sources import (
    activemq,
    databases,
    documents,
    exposition,
    host,
    kafka,
    postgres,
    queues,
    redis,
)

# Raw replies: (target type, endpoint; None for all endpoints of the type, job).
REPLY_JOBS: list[tuple[str, str | None, Callable[[DataFrame], DataFrame]]] = [
    ("redis", "info", redis.info),
    ("redis", "info/server", redis.instance_version),
    ("mongodb", "serverStatus", documents.mongo_server_status),
    ("mongodb", "replSetGetStatus", documents.mongo_replset),
    ("cassandra", "metrics", exposition.cassandra_exposition),
    ("cassandra", None, exposition.cassandra_jmx),
    ("cockroachdb", "_status/vars", exposition.cockroach_vars),
    ("elasticsearch", "_cluster/health", documents.es_cluster_health),
    ("elasticsearch", "_nodes/stats", documents.es_node_stats),
    ("rabbitmq", "overview", documents.rabbit_overview),
    ("rabbitmq", "queues", documents.rabbit_queues),
    ("rabbitmq", "nodes", documents.rabbit_nodes),
    ("nats", "varz", documents.nats_varz),
    ("nats", "jsz", documents.nats_jetstream),
    ("activemq", "classic/broker", activemq.classic_broker),
    ("activemq", "classic/queues", activemq.classic_queues),
    ("activemq", "artemis/broker", activemq.artemis_broker),
    ("activemq", "artemis/queues", activemq.artemis_queues),
    ("ibmmq", "qmgr", documents.ibmmq_qmgr),
    ("ibmmq", "queue", documents.ibmmq_queues),
    ("ibmmq", "channel", documents.ibmmq_channels),
    ("beanstalkd", "stats", queues.beanstalkd_stats),
    ("host", "proc/stat", host.cpu),
    ("host", "proc/meminfo", host.memory),
    ("host", "proc/net/dev", host.network),
    ("host", "proc/loadavg", host.load),
]

# Landed tables: (tables read, preference among series emitted twice, job). Session counts
# give way to the backend count of the statistics table.
TABLE_JOBS: list[tuple[tuple[str, ...], int, Callable[..., DataFrame]]] = [
    (("server_version",), 1, databases.instance_info),
    (("pg_stat_database",), 1, postgres.stat_database),
    (("pg_database_size",), 1, postgres.database_size),
    (("pg_stat_activity",), 0, postgres.stat_activity),
    (("pg_stat_user_tables",), 1, postgres.user_tables),
    (("pg_stat_statements", "pg_extension"), 1, postgres.statements),
    (("mysql_status",), 1, databases.mysql_status),
    (("redis_slowlog",), 1, redis.slowlog),
    (("ch_metrics",), 1, databases.clickhouse_metrics),
    (("ch_events",), 1, databases.clickhouse_events),
    (("ch_parts",), 1, databases.clickhouse_parts),
    (("sqlite_pragmas",), 1, databases.sqlite_pragmas),
    (("kafka_brokers",), 1, kafka.brokers),
    (("kafka_groups",), 1, kafka.group_states),
    (("kafka_partitions",), 1, kafka.topics),
    (("kafka_groups", "kafka_committed", "kafka_end_offsets"), 1, kafka.group_lag),
    (("bullmq_keys",), 1, queues.bullmq_jobs),
    (("celery_keys",), 1, queues.celery_tasks),
    (("sidekiq_keys",), 1, queues.sidekiq),
    (("sqs_queues",), 1, queues.sqs_queues),
    (("mounts",), 1, host.disk),
]

# Names that two of these jobs emit, and the tables they come from; only these are deduped.
TWICE = ["db.postgres.connections.active"]
TWICE_FROM = {"pg_stat_database", "pg_stat_activity"}
# Tables with a row per database, and those whose jobs report zeros for quiet scrapes.
BY_DATABASE = ("pg_stat_database", "pg_database_size", "pg_stat_activity")
WITH_SCRAPES = ("pg_stat_activity", "redis_slowlog", "kafka_groups")
# Tables whose jobs tell what host a row is of.
WITH_FACTS = ("mounts",)
