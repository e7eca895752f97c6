"""Landed statistics and key tables."""

from datetime import datetime

from gaugeworks.schema import KEYS
from gaugeworks.sources import databases, kafka, postgres, queues, redis
from helpers import landed, values


def test_pg_stat_database(spark):
    df = landed(
        spark,
        "pg_stat_database",
        [("d", 1, 2, 3, 10, 90, 6, 7, 8, 9, 10, 11, 12), ("other", *[0] * 12)],
    )
    got = values(postgres.stat_database(df.where("datname = 'd'")))
    assert len(got) == 13 and got["db.postgres.cache_hit_ratio"] == 0.9
    from pyspark.sql import functions as F

    zero = values(postgres.stat_database(df, F.lit("other")))
    assert zero["db.postgres.cache_hit_ratio"] == 0.0


def test_pg_activity(spark):
    at = datetime(2024, 1, 1, 0, 0, 10)
    rows = [
        ("d", "idle", None, None),
        ("d", "idle", None, datetime(2024, 1, 1)),
        ("d", "active", None, datetime(2024, 1, 1, 0, 0, 5)),
        ("d", "active", "Lock", datetime(2024, 1, 1, 0, 0, 1)),
    ]
    df = landed(spark, "pg_stat_activity", rows, at=at)
    assert values(postgres.stat_activity(df)) == {
        "db.postgres.connections.idle": 2.0,
        "db.postgres.connections.active": 2.0,
        "db.postgres.connections.waiting": 1.0,
        "db.postgres.longest_query_seconds": 9.0,
    }
    none = postgres.stat_activity(df.where("false"), scrapes=df.select(*KEYS).distinct())
    assert set(values(none).values()) == {0.0}


def test_pg_user_tables(spark):
    rows = [("s", f"t{i:02d}", i if i != 5 else None, None, 1, 2) for i in range(12)]
    got = values(postgres.user_tables(landed(spark, "pg_stat_user_tables", rows)), "db.sql.table")
    assert len(got) == 40
    assert ("db.postgres.table.seq_scan", "s.t05") not in got
    assert got[("db.postgres.table.idx_scan", "s.t11")] == 0.0


def test_pg_statements_are_gated(spark):
    rows = [(str(i), "q" * 150, float(i), i) for i in range(12)]
    df = landed(spark, "pg_stat_statements", rows)
    have = landed(spark, "pg_extension", [("pg_stat_statements",), ("plpgsql",)])
    got = postgres.statements(df, have).collect()
    assert len(got) == 20
    assert {len(r["attrs"]["db.statement"]) for r in got} == {150}
    cut = postgres.statements(df, have, clip=100).collect()
    assert {len(r["attrs"]["db.statement"]) for r in cut} == {100}
    assert {r["attrs"]["db.query_id"] for r in got} == {str(i) for i in range(2, 12)}
    lacking = landed(spark, "pg_extension", [("plpgsql",)])
    assert postgres.statements(df, lacking).count() == 0


def test_mysql(spark):
    rows = [
        (1, "Threads_connected", "5"),
        (2, "Threads_connected", "6"),
        (3, "Threads_running", "1.0d"),
        (4, "Innodb_buffer_pool_read_requests", "200"),
        (5, "Innodb_buffer_pool_reads", "50"),
        (6, "Uptime", "1"),
    ]
    got = values(databases.mysql_status(landed(spark, "mysql_status", rows)))
    assert got == {
        "db.mysql.connections.current": 6.0,
        "db.mysql.innodb.buffer_pool_hit_ratio": 0.75,
    }


def test_clickhouse(spark):
    m = landed(
        spark, "ch_metrics", [("Query", "42"), ("TCPConnection", "12abc"), ("MemoryTracking", "x"),
                              ("Other", "1")]
    )
    assert values(databases.clickhouse_metrics(m)) == {
        "db.clickhouse.queries.active": 42.0,
        "db.clickhouse.connections.tcp": 12.0,
        "db.clickhouse.memory.tracked_bytes": 0.0,
    }
    e = landed(spark, "ch_events", [("Query", "7"), ("Merge", " 8 ")])
    assert values(databases.clickhouse_events(e)) == {
        "db.clickhouse.queries.total": 7.0,
        "db.clickhouse.merges.total": 8.0,
    }
    p = landed(spark, "ch_parts", [(1, 10), (1, 5), (0, 99)])
    assert values(databases.clickhouse_parts(p)) == {
        "db.clickhouse.parts.active": 2.0,
        "db.clickhouse.parts.total_bytes": 15.0,
    }


def test_sqlite(spark):
    def run(*row, **kw):
        return values(databases.sqlite_pragmas(landed(spark, "sqlite_pragmas", [row]), **kw))

    base = "db.sqlite."
    assert run(10, 4096, -2000, None) == {
        base + "database_size_bytes": 40960.0,
        base + "page_size": 4096.0,
        base + "cache_size_pages": 500.0,
    }
    assert run(10, 0, -2000, 3) == {base + "page_size": 0.0, base + "wal_checkpoint_count": 3.0}
    assert base + "wal_checkpoint_count" not in run(1, 1, 1, -1, drop_negative_checkpoint=True)
    assert run(1, 1, 7, -1)[base + "cache_size_pages"] == 7.0


def test_instance_info(spark):
    rows = [("postgres", None), ("mysql", None), ("mysql", "8.0")]
    got = databases.instance_info(landed(spark, "server_version", rows)).collect()
    assert sorted((r["attrs"]["db.system"], r["attrs"]["db.version"]) for r in got) == [
        ("mysql", "8.0"),
        ("postgres", ""),
    ]


def test_slowlog(spark):
    df = landed(spark, "redis_slowlog", [(i, 100 + i) for i in range(15)])
    assert values(redis.slowlog(df)) == {
        "db.redis.slowlog.count": 10.0,
        "db.redis.slowlog.latest_duration_us": 114.0,
    }
    empty = redis.slowlog(df.where("false"), scrapes=df.select(*KEYS).distinct())
    assert values(empty) == {"db.redis.slowlog.count": 0.0}


def test_kafka_topics(spark):
    rows = [
        ("t", 0, [1, 2, 3], [1, 2, 3]),
        ("t", 1, [1, 2, 3], [1]),
        ("_int", 0, [1], []),
    ]
    got = values(kafka.topics(landed(spark, "kafka_partitions", rows)))
    base = "messaging.kafka."
    assert got == {
        base + "topic.partitions": 2.0,
        base + "topic.replication_factor": 3.0,
        base + "topic.under_replicated": 2.0,
        base + "topics.count": 1.0,
        base + "partitions.total": 3.0,
        base + "under_replicated.total": 2.0,
    }


def test_kafka_brokers(spark):
    df = landed(spark, "kafka_brokers", [("a", 9092, False), ("b", 9093, True)])
    row = kafka.brokers(df).first()
    assert (row["value"], row["attrs"]["messaging.kafka.controller"]) == (2.0, "b:9093")


def test_kafka_groups(spark):
    groups = landed(spark, "kafka_groups", [("g", "Stable"), ("h", "Stable"), ("i", "Empty")])
    got = values(kafka.group_states(groups), "messaging.kafka.consumer_group.state")
    base = "messaging.kafka.consumer_groups."
    assert got == {
        (base + "by_state", "Stable"): 2.0,
        (base + "by_state", "Empty"): 1.0,
        (base + "count", None): 3.0,
    }
    committed = landed(
        spark, "kafka_committed", [("g", "t", 0, 5), ("g", "t", 1, -1), ("g", "t", 2, 8), ("g", "t", 3, 1)]
    )
    ends = landed(spark, "kafka_end_offsets", [("t", 0, 9), ("t", 1, 50), ("t", 2, 6)])
    lag = values(kafka.group_lag(groups, committed, ends), "messaging.kafka.consumer_group")
    assert {k[1]: v for k, v in lag.items()} == {"g": 4.0, "h": 0.0, "i": 0.0}
    none = landed(spark, "kafka_groups", []).limit(0)
    scrapes = landed(spark, "scrapes", [("kafka_groups",)])
    assert values(kafka.group_states(none, scrapes)) == {base + "count": 0.0}


DEST = "messaging.destination.name"


def test_bullmq(spark):
    rows = [
        ("bull:mail:meta", "hash", 1, None),
        ("bull:mail:wait", "list", 3, None),
        ("bull:mail:failed", "zset", 2, None),
        ("bull:mail:delayed", "list", 9, None),
        ("bull:x", "list", 4, None),
        ("bull:lost:wait", "list", 4, None),
        ("other", "list", 4, None),
    ]
    df = landed(spark, "redis_keys", rows)
    got = values(queues.bullmq_jobs(df))
    base = "messaging.bullmq."
    assert got[base + "queue.waiting"] == 3.0 and got[base + "jobs.waiting"] == 3.0
    assert got[base + "queue.failed"] == 2.0 and got[base + "queue.delayed"] == 0.0
    assert got[base + "queues.count"] == 1.0
    assert base + "jobs.paused" not in got and len(got) == 12
    assert [r["queue"] for r in queues.bullmq_discovery(df).collect()] == ["mail"]


def test_celery(spark):
    rows = [
        ("_kombu.binding.mail", "set", 1, None),
        ("_kombu.binding.", "set", 1, None),
        ("mail", "list", 4, None),
        ("mail\x06\x16\x06\x16", "zset", 0, None),
        ("mail:reserved", "list", 6, None),
        ("celery", "list", 2, None),
        ("celery\x06\x16\x06\x16", "zset", 5, None),
        ("celery:reserved", "list", 7, None),
        ("celery-task-meta-1", "string", 1, None),
    ]
    df = landed(spark, "redis_keys", rows)
    got = values(queues.celery_tasks(df), DEST)
    base = "messaging.celery."
    assert got == {
        (base + "queue.pending", "mail"): 4.0,
        (base + "queue.reserved", "mail"): 6.0,
        (base + "queue.pending", "celery"): 2.0,
        (base + "queue.reserved", "celery"): 5.0,
        (base + "queues.count", None): 2.0,
        (base + "tasks.pending", None): 6.0,
        (base + "tasks.reserved", None): 11.0,
        (base + "results.count", None): 1.0,
    }
    assert {r["queue"] for r in queues.celery_discovery(df).collect()} == {"mail", "celery"}


def test_sidekiq(spark):
    rows = [
        ("queues", "set", 2, "default"),
        ("queues", "set", 2, "low"),
        ("queue:default", "list", 5, None),
        ("queue:gone", "list", 50, None),
        ("processes", "set", 2, "p1"),
        ("processes", "set", 2, "p2"),
        ("p1", "hash", 1, '{"concurrency":10,"busy":4}'),
        ("p2", "hash", 1, "bad"),
        ("p3", "hash", 1, '{"concurrency":99,"busy":99}'),
        ("stat:processed", "string", 1, "12"),
        ("stat:failed", "string", 1, "x"),
        ("retry", "zset", 3, None),
    ]
    got = values(queues.sidekiq(landed(spark, "redis_keys", rows)), DEST)
    base = "messaging.sidekiq."
    assert got.pop((base + "queue.size", "default")) == 5.0
    assert got.pop((base + "queue.size", "low")) == 0.0
    assert {k[0].removeprefix(base): v for k, v in got.items()} == {
        "processed": 12.0,
        "failed": 0.0,
        "queues.count": 2.0,
        "scheduled": 0.0,
        "retries": 3.0,
        "dead": 0.0,
        "processes": 2.0,
        "busy": 4.0,
        "concurrency": 10.0,
        "enqueued": 5.0,
    }
    spaced = [(("ns:" + r[0]), *r[1:]) for r in rows]
    again = values(queues.sidekiq(landed(spark, "redis_keys", spaced), "ns"), DEST)
    assert again[(base + "busy", None)] == 4.0 and again[(base + "enqueued", None)] == 5.0
    none = [r for r in rows if r[0] != "queues"]
    assert queues.sidekiq(landed(spark, "redis_keys", none)).count() == 0


def test_sqs(spark):
    rows = [
        (1, "https://h/1/orders", {"ApproximateNumberOfMessages": "5"}),
        (2, "https://h/1/mails", {"ApproximateNumberOfMessagesNotVisible": "x"}),
    ]
    got = values(queues.sqs_queues(landed(spark, "sqs_queues", rows)), DEST)
    assert got == {
        ("messaging.sqs.queues.count", None): 2.0,
        ("messaging.sqs.queue.visible", "orders"): 5.0,
        ("messaging.sqs.queue.in_flight", "mails"): 0.0,
    }
