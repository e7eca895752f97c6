"""Text replies: INFO, exposition, stats YAML, host files."""

from datetime import datetime

import pytest

from gaugeworks.sources import exposition, host, queues, redis
from helpers import landed, replies, values

INFO = """# Clients
connected_clients:7
connected_clients:9
blocked_clients:x

keyspace_hits:30
keyspace_misses:10
role:slave
master_repl_offset:100
slave_repl_offset:140
"""


def test_info_last_value_wins_and_bad_numbers_drop(spark):
    got = values(redis.info(replies(spark, "redis", INFO)))
    assert got == {
        "db.redis.connections.connected": 9.0,
        "db.redis.keyspace.hits": 30.0,
        "db.redis.keyspace.misses": 10.0,
        "db.redis.keyspace.hit_ratio": 0.75,
        "db.redis.replication.lag": -40.0,
    }


def test_info_ratio_and_lag_are_left_out(spark):
    body = "keyspace_hits:0\nkeyspace_misses:0\nrole:master\nmaster_repl_offset:5\nslave_repl_offset:1\n"
    got = values(redis.info(replies(spark, "redis", body)))
    assert got == {"db.redis.keyspace.hits": 0.0, "db.redis.keyspace.misses": 0.0}


def test_redis_version(spark):
    rows = redis.instance_version(replies(spark, "redis", "redis_version:7.2\r\n")).collect()
    assert rows[0]["attrs"]["db.version"] == "7.2"
    assert rows[0]["value"] == 1.0


def test_exposition_first_mode(spark):
    body = """# HELP x
cassandra_storage_load 500 1700000000
cassandra_storage_load 900
cassandra_client_connectednativeclients{h="a"} bad
cassandra_client_connectednativeclients{h="b"} 4
cassandra_compaction_pendingtasks{h="a"} 3 1700000000
cassandra_clientrequest_read_latency_mean 2000
cassandra_clientrequest_latency_mean 9000
cassandra_table_livediskspaceused_count{s="}"} 5
"""
    got = values(exposition.cassandra_exposition(replies(spark, "cassandra", body)))
    assert got == {
        "db.cassandra.storage.total_bytes": 500.0,
        "db.cassandra.connections.active": 4.0,
        "db.cassandra.read_latency_ms": 2.0,
    }
    stamped = values(
        exposition.cassandra_exposition(replies(spark, "cassandra", body), timestamps=True)
    )
    assert stamped["db.cassandra.compactions_pending"] == 3.0


def test_general_latency_stands_in_for_read_latency(spark):
    body = "cassandra_clientrequest_latency_mean 9000\n"
    got = values(exposition.cassandra_exposition(replies(spark, "cassandra", body)))
    assert got == {"db.cassandra.read_latency_ms": 9.0}


CRDB = """ranges 12
ranges 13
sql_service_latency_p99 5
sql_service_latency{quantile="0.5"} 10
sql_service_latency{quantile="0.99"} 70
sql_service_latency{quantile="0.999"} 99
sql_service_latency{quantile="0.99"} 80
capacity_used{s="}"} 5
"""


def test_exposition_p99_mode(spark):
    got = values(exposition.cockroach_vars(replies(spark, "cockroachdb", CRDB)))
    assert got == {
        "db.cockroachdb.ranges.total": 12.0,
        "db.cockroachdb.sql.latency_p99": 80.0,
        "db.cockroachdb.capacity.used_bytes": 5.0,
    }


def test_missing_report(spark):
    rows = exposition.cockroach_missing(replies(spark, "cockroachdb", CRDB)).collect()
    assert sorted(r["missing"] for r in rows) == [
        "capacity_available",
        "liveness_livenodes",
        "ranges_unavailable",
        "sql_failure_count",
        "sql_query_count",
    ]


def test_cassandra_jmx_takes_numbers_only(spark):
    m = "org.apache.cassandra.metrics:type="
    df = replies(
        spark,
        "cassandra",
        (m + "ClientRequest,scope=Read,name=Latency/Mean", '{"value": 2500}'),
        (m + "ClientRequest,scope=Write,name=Latency/Mean", '{"value": "2500"}'),
        (m + "Compaction,name=PendingTasks/Value", '{"value": 3.5}'),
        (m + "Client,name=connectedNativeClients/Value", '{"value": null}'),
        ("org.apache.cassandra.db:type=StorageService/Load", "not json"),
        ("other", '{"value": 1}'),
    )
    got = values(exposition.cassandra_jmx(df))
    assert got == {"db.cassandra.read_latency_ms": 2.5, "db.cassandra.compactions_pending": 3.5}


def test_stats_yaml(spark):
    body = (
        "OK 60\r\n---\ncurrent-jobs-ready: 5\ncurrent-jobs-ready: 6\ntotal-jobs: 1e2\n"
        "current-tubes: two\n\ncmd-put: 9\n"
    )
    df = replies(spark, "beanstalkd", body, "NOT_FOUND\r\ncmd-put: 1\n")
    assert values(queues.beanstalkd_stats(df)) == {
        "messaging.beanstalkd.jobs.ready": 6.0,
        "messaging.beanstalkd.jobs.total": 100.0,
    }


def test_stats_yaml_ignores_an_unclosed_line(spark):
    df = replies(spark, "beanstalkd", "OK 1\ncmd-put: 1\ncmd-bury: 2")
    assert values(queues.beanstalkd_stats(df)) == {"messaging.beanstalkd.cmd.put": 1.0}


def test_all_tubes_are_listed(spark):
    names = [f"tube{i:03d}" for i in range(60)][::-1]
    listing = "OK 9\n---\n" + "".join(f"- {n}\n" for n in names)
    stats = [(f"stats-tube {n}", "OK 1\ncurrent-jobs-ready: 1\n") for n in names]
    got = values(
        queues.beanstalkd_tubes(
            replies(spark, "beanstalkd", listing), replies(spark, "beanstalkd", *stats)
        ),
        "messaging.destination.name",
    )
    assert {k[1] for k in got} == set(names)


def test_cpu(spark):
    lines = [
        "cpu  100 0 50 800 50 0 0 0\ncpu0 1\ncpu1 1\n",
        "cpu  150 0 60 820 60 5 5 0\ncpu0 1\ncpu1 1\n",
        "cpu  150 0 60 820 60 5 5 0\ncpu0 1\ncpu1 1\n",
        "cpu  1 2\n",
    ]
    frames = [
        landed(spark, "raw_snapshots", [("host", "proc/stat", b)], cycle=i, at=datetime(2024, 1, 1 + i))
        for i, b in enumerate(lines)
    ]
    df = frames[0].unionAll(frames[1]).unionAll(frames[2]).unionAll(frames[3])
    rows = host.cpu(df).collect()
    assert {(r["cycle_id"], r["name"]): r["value"] for r in rows} == pytest.approx(
        {
            (0, "host.cpu.cores"): 2.0,
            (1, "host.cpu.cores"): 2.0,
            (1, "host.cpu.utilization"): 80.0,
            (1, "host.cpu.user"): 50.0,
            (1, "host.cpu.system"): 10.0,
            (1, "host.cpu.iowait"): 10.0,
            (1, "host.cpu.steal"): 0.0,
        }
    )


def test_memory(spark):
    body = (
        "MemTotal: 1000 kB\nMemAvailable:  250 kB\nBuffers: 10 kB\nCached: 20 kB\n"
        "SwapTotal: 0 kB\nSwapFree: x kB\n"
    )
    assert values(host.memory(replies(spark, "host", body))) == {
        "host.memory.total": 1024000.0,
        "host.memory.available": 256000.0,
        "host.memory.used": 768000.0,
        "host.memory.buffers": 10240.0,
        "host.memory.cached": 20480.0,
        "host.memory.utilization": 75.0,
    }


def test_memory_with_swap(spark):
    body = "MemTotal: 0 kB\nSwapTotal: 8 kB\nSwapFree: 3 kB\n"
    got = values(host.memory(replies(spark, "host", body)))
    assert got["host.memory.swap_used"] == 5120.0
    assert "host.memory.utilization" not in got


def test_network(spark):
    body = (
        "Inter-|\n face |\n    lo: 9 9 9 9 0 0 0 0 9 9 9 9 0 0 0 0\n"
        "  eth0: 1 2 3 4 0 0 0 0 5 6 7 8 0 0 0 0\n  bad: 1 2 3 4 5 6 7 8 9 10 11\n"
    )
    got = values(host.network(replies(spark, "host", body)), "host.network.interface")
    assert [v for _, v in sorted(got.items())] == [1, 4, 3, 2, 5, 8, 7, 6]
    assert {k[1] for k in got} == {"eth0"}


def test_load(spark):
    got = values(host.load(replies(spark, "host", "0.5 1.25 bad 1/2 3\n", "0.5 1\n")))
    assert got == {"host.load.1m": 0.5, "host.load.5m": 1.25, "host.load.15m": 0.0}


def test_disk(spark):
    rows = [
        (1, "/dev/a", "/", "ext4", 100, 10, 40, 30, True),
        (2, "/dev/a", "/x", "ext4", 7, 7, 7, 7, True),
        (3, "tmpfs", "/t", "tmpfs", 1, 1, 1, 1, True),
        (4, "/dev/s", "/s", "squashfs", 1, 1, 1, 1, True),
        (5, "/dev/b", "/b", "ext4", 1, 1, 1, 1, False),
        (6, "/dev/b", "/b2", "ext4", 1, 1, 1, 1, True),
    ]
    got = values(host.disk(landed(spark, "mounts", rows)), "host.disk.mountpoint")
    assert got == {
        ("host.disk.total", "/"): 1000.0,
        ("host.disk.used", "/"): 600.0,
        ("host.disk.free", "/"): 300.0,
        ("host.disk.utilization", "/"): 60.0,
    }


def test_long_exposition_reply_is_read_in_linear_time(spark):
    """16,000 labelled lines of few names, as servers write them."""
    import time

    from gaugeworks.sources import exposition

    def seconds(n):
        body = "".join(f'capacity_used{{store="{i}"}} {i}\nranges{{store="{i}"}} {i}\n' for i in range(n // 2))
        df = replies(spark, "cockroachdb", body)
        start = time.perf_counter()
        got = values(exposition.cockroach_vars(df))
        assert got["db.cockroachdb.ranges.total"] == 0.0
        return time.perf_counter() - start

    seconds(100)
    assert seconds(16_000) < 10
