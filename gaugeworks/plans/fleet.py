"""A whole collection cycle over a fleet derived from the benchmark tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gaugeworks.operators.agent import heartbeat
from gaugeworks.operators.union import GOOD, OUTCOME
from gaugeworks.plans.common import base_sql, land, long_sql, query, s, spread, table
from gaugeworks.plans.cycle import collect_marked
from gaugeworks.schema import METRIC_COLUMNS
from gaugeworks.session import run_dir
from gaugeworks.sources.landing import read_snapshots, write_snapshots
from gaugeworks.sources.sinks import write_outcomes

c = F.col

# Order key modulo 6 picks the source of a reply: type, endpoint.
SOURCES = [
    ("redis", "info"),
    ("cockroachdb", "_status/vars"),
    ("elasticsearch", "_cluster/health"),
    ("rabbitmq", "nodes"),
    ("host", "proc/loadavg"),
    ("beanstalkd", "stats"),
]


def replies(spark, sf) -> DataFrame:
    """One raw reply per order."""
    key, cust = c("o_orderkey"), c("o_custkey")
    bodies = [
        s("# Stats\r\nkeyspace_hits:", cust, "\r\nkeyspace_misses:", cust, "\r\n"),
        s("ranges ", cust, "\nranges_unavailable{s=\"1\"} ", key, "\n"),
        s('{"status":"yellow","number_of_nodes":', cust, ',"active_shards":', key, "}"),
        s('[{"name":"a","running":true,"fd_used":', cust, "}]"),
        s(cust, " ", key, " 0.25 1/2 3\n"),
        s("OK 9\n---\ntotal-jobs: ", cust, "\ncmd-put: ", key, "\n"),
    ]
    which = (key % len(SOURCES) + 1).cast("int")

    def pick(values) -> Column:
        return F.element_at(F.array(*values), which)

    return land(
        spread(table(spark, sf, "orders"), "o_orderkey"),
        key,
        s("t", cust),
        c("o_orderpriority"),
        target_type=pick([F.lit(t) for t, _ in SOURCES]),
        endpoint=pick([F.lit(e) for _, e in SOURCES]),
        body=pick(bodies),
    )


def tables(spark, sf) -> dict[str, DataFrame]:
    """Landed statistics tables of the fleet."""
    orders = table(spark, sf, "orders")
    db = s("db", c("o_custkey"))
    stats = ("numbackends", "xact_commit", "xact_rollback", "blks_read", "blks_hit", "tup_returned",
             "tup_fetched", "tup_inserted", "tup_updated", "tup_deleted", "deadlocks", "temp_bytes")
    per_db = orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    sessions = land(
        orders,
        1,
        db,
        F.lit("pg"),
        datname=db,
        state=F.lit("active"),
        wait_event_type=F.lit(None).cast("string"),
        query_start=c("o_orderdate"),
    )
    parts = land(
        table(spark, sf, "lineitem"),
        1,
        s("s", c("l_suppkey")),
        F.lit("ch"),
        active=F.lit(1),
        bytes_on_disk=c("l_quantity").cast("bigint"),
    )
    partitions = land(
        table(spark, sf, "part"),
        1,
        c("p_type"),
        F.lit("k"),
        topic=c("p_brand"),
        partition=c("p_partkey").cast("int"),
        replicas=F.array(F.lit(1), F.lit(2)),
        isr=F.array(F.lit(1)),
    )
    # Scrapes that found nothing: a server without sessions, a log without entries.
    idle = land(
        table(spark, sf, "region"), 1, s("idle", c("r_regionkey")), F.lit("pg"), table_name=F.lit("pg_stat_activity")
    )
    quiet = land(
        table(spark, sf, "region"), 1, s("q", c("r_regionkey")), F.lit("r"), table_name=F.lit("redis_slowlog")
    )
    keys = land(
        table(spark, sf, "nation").withColumn("kind", F.explode(F.array(F.lit("meta"), F.lit("wait")))),
        1,
        F.lit("bull"),
        F.lit("r"),
        key=s("bull:q", c("n_nationkey"), ":", c("kind")),
        kind=F.when(c("kind") == "meta", "hash").otherwise("list"),
        size=c("n_nationkey"),
        value=F.lit(None).cast("string"),
    )
    return {
        "pg_stat_database": land(
            per_db.withColumn("other", F.explode(F.array(F.lit(False), F.lit(True)))),
            1,
            db,
            F.lit("pg"),
            # A second database on each target, which is not the monitored one.
            datname=F.when(c("other"), F.lit("postgres")).otherwise(db),
            **{x: F.when(c("other"), F.lit(10**9)).otherwise(c("n") * 3) for x in stats},
        ),
        "pg_current_database": land(per_db, 1, db, F.lit("pg"), datname=db),
        "scrapes": idle.unionByName(quiet),
        "redis_slowlog": land(
            table(spark, sf, "region").where("r_regionkey < 2"), 1, s("q", c("r_regionkey")), F.lit("r"),
            entry_id=c("r_regionkey"), duration_us=c("r_regionkey") + 5,
        ),
        "bullmq_keys": keys,
        "pg_stat_activity": sessions,
        "ch_parts": parts,
        "kafka_partitions": partitions,
    }


def cycle(spark, sf) -> DataFrame:
    """Run every job over the replies and tables: metric rows with their outcome. Replies are landed
    first, so they are made once and a job reads those of its own endpoint only."""
    landed = run_dir(spark, "replies")
    write_snapshots(replies(spark, sf), landed)
    cycles = table(spark, sf, "region").select(
        F.lit("2002-01-01 00:00:00").cast("timestamp_ntz").alias("ts"),
        c("r_regionkey").cast("bigint").alias("cycle_id"),
        F.lit("agent").alias("target"),
    )
    up = heartbeat(cycles)
    # A copy of each row that is no number must not stand for the finite one.
    broken = up.withColumn("value", F.lit(float("nan")))
    return collect_marked({"raw_snapshots": read_snapshots(spark, landed), **tables(spark, sf)}, [up, broken])


def summary(metrics: DataFrame) -> DataFrame:
    """Series count and value sum per metric."""
    return metrics.select(*METRIC_COLUMNS).groupBy("name", "unit").agg(
        F.count(F.lit(1)).alias("series"), F.sum("value").alias("total")
    )


def _src(i: int) -> str:
    return (
        "(SELECT o_orderkey AS cycle_id, 't' || o_custkey AS target, o_orderpriority AS instance, "
        f"o_custkey AS cust, o_orderkey AS key FROM orders WHERE o_orderkey % 6 = {i})"
    )


_DB = (
    "(SELECT 1 AS cycle_id, 'db' || o_custkey AS target, 'pg' AS instance, count(*) AS n, "
    "max(epoch(TIMESTAMP '2002-01-01') - epoch(o_orderdate)) AS age FROM orders GROUP BY o_custkey)"
)
_PARTS = (
    "(SELECT 1 AS cycle_id, 's' || l_suppkey AS target, 'ch' AS instance, count(*) AS n, "
    "CAST(sum(l_quantity) AS BIGINT) AS q FROM lineitem GROUP BY l_suppkey)"
)
_TOPICS = (
    "(SELECT 1 AS cycle_id, p_type AS target, 'k' AS instance, p_brand, count(*) AS n "
    "FROM part GROUP BY p_type, p_brand)"
)
_CLUSTER = (
    "(SELECT 1 AS cycle_id, p_type AS target, 'k' AS instance, count(DISTINCT p_brand) AS t, "
    "count(*) AS n FROM part GROUP BY p_type)"
)
_NODE = {
    "running": ("1", "1"), "memory_used": ("0", "By"), "memory_limit": ("0", "By"),
    "memory_alarm": ("0", "1"), "disk_free": ("0", "By"), "disk_alarm": ("0", "1"),
    "fd_used": ("cust", "{descriptors}"), "fd_total": ("0", "{descriptors}"),
    "sockets_used": ("0", "{sockets}"), "sockets_total": ("0", "{sockets}"), "uptime_ms": ("0", "ms"),
}
_PG = {
    "connections.active": "{connections}", "transactions.committed": "{transactions}",
    "transactions.rolledback": "{transactions}", "blocks.read": "{blocks}", "blocks.hit": "{blocks}",
    "rows.returned": "{rows}", "rows.fetched": "{rows}", "rows.inserted": "{rows}",
    "rows.updated": "{rows}", "rows.deleted": "{rows}", "deadlocks": "{deadlocks}", "temp_bytes": "By",
}
_ROWS = [
    (
        _src(0),
        [
            ("db.redis.keyspace.hits", "cust", "{hits}"),
            ("db.redis.keyspace.misses", "cust", "{misses}"),
            ("db.redis.keyspace.hit_ratio", "CASE WHEN cust > 0 THEN 0.5 END", "1"),
        ],
    ),
    (
        _src(1),
        [
            ("db.cockroachdb.ranges.total", "cust", "{ranges}"),
            ("db.cockroachdb.ranges.unavailable", "key", "{ranges}"),
        ],
    ),
    (
        _src(2),
        [
            ("db.elasticsearch.cluster.status", "1", "1"),
            ("db.elasticsearch.cluster.nodes", "cust", "{nodes}"),
            ("db.elasticsearch.cluster.shards.active", "key", "{shards}"),
            ("db.elasticsearch.cluster.shards.unassigned", "0", "{shards}"),
        ],
    ),
    (_src(3), [(f"messaging.rabbitmq.node.{n}", v, u) for n, (v, u) in _NODE.items()]),
    (
        _src(4),
        [("host.load.1m", "cust", "1"), ("host.load.5m", "key", "1"), ("host.load.15m", "0.25", "1")],
    ),
    (
        _src(5),
        [
            ("messaging.beanstalkd.jobs.total", "cust", "{jobs}"),
            ("messaging.beanstalkd.cmd.put", "key", "{commands}"),
        ],
    ),
    (
        _DB,
        [(f"db.postgres.{n}", "n * 3", u) for n, u in _PG.items()]
        + [
            ("db.postgres.cache_hit_ratio", "0.5", "1"),
            ("db.postgres.connections.idle", "0", "{connections}"),
            ("db.postgres.connections.waiting", "0", "{connections}"),
            ("db.postgres.longest_query_seconds", "age", "s"),
        ],
    ),
    (
        _PARTS,
        [
            ("db.clickhouse.parts.active", "n", "{parts}"),
            ("db.clickhouse.parts.total_bytes", "q", "By"),
        ],
    ),
    (
        _TOPICS,
        [
            ("messaging.kafka.topic.partitions", "n", "{partitions}"),
            ("messaging.kafka.topic.replication_factor", "2", "1"),
            ("messaging.kafka.topic.under_replicated", "n", "{partitions}"),
        ],
    ),
    (
        _CLUSTER,
        [
            ("messaging.kafka.topics.count", "t", "{topics}"),
            ("messaging.kafka.partitions.total", "n", "{partitions}"),
            ("messaging.kafka.under_replicated.total", "n", "{partitions}"),
        ],
    ),
    (
        "(SELECT *, 1 AS cycle_id, '' AS target, '' AS instance FROM region)",
        [(f"db.postgres.connections.{n}", "0", "{connections}") for n in ("idle", "active", "waiting")]
        + [
            ("db.postgres.longest_query_seconds", "0", "s"),
            ("db.redis.slowlog.count", "CASE WHEN r_regionkey < 2 THEN 1 ELSE 0 END", "{entries}"),
            ("db.redis.slowlog.latest_duration_us", "CASE WHEN r_regionkey < 2 THEN r_regionkey + 5 END", "us"),
        ],
    ),
    (
        "(SELECT *, 1 AS cycle_id, '' AS target, '' AS instance FROM nation)",
        [
            (f"messaging.bullmq.queue.{n}", "n_nationkey" if n == "waiting" else "0", "{jobs}")
            for n in ("waiting", "active", "delayed", "failed", "completed", "paused")
        ],
    ),
    (
        "(SELECT 1 AS cycle_id, '' AS target, '' AS instance, count(*) AS n, sum(n_nationkey) AS w FROM nation)",
        [("messaging.bullmq.queues.count", "n", "{queues}")]
        + [
            (f"messaging.bullmq.jobs.{n}", "w" if n == "waiting" else "0", "{jobs}")
            for n in ("waiting", "active", "delayed", "failed", "completed")
        ],
    ),
    ("(SELECT r_regionkey AS cycle_id, '' AS target, '' AS instance FROM region)",
     [("agent.up", "1", "1")]),
]


_CYCLE = " UNION ALL ".join(long_sql(src, rows, base_sql("redis")) for src, rows in _ROWS)


@query(
    "fleet_cycle",
    "SELECT name, unit, count(*) AS series, CAST(sum(value) AS DOUBLE) AS total "
    f"FROM ({_CYCLE}) GROUP BY name, unit",
)
def fleet_cycle(spark, sf):
    return summary(cycle(spark, sf).where(c(OUTCOME) == GOOD))


@query(
    "written_outcomes",
    "SELECT 'good' AS outcome, CAST(year(TIMESTAMP '2002-01-01') AS INTEGER) AS year, name, unit, count(*) AS series, "
    f"CAST(sum(value) AS DOUBLE) AS total FROM ({_CYCLE}) GROUP BY name, unit "
    "UNION ALL SELECT 'rejected', 2002, 'agent.up', '1', count(*), NULL FROM region",
)
def written_outcomes(spark, sf):
    """A whole cycle, good and rejected rows written in one pass and read back."""
    path = run_dir(spark, "outcomes")
    write_outcomes(cycle(spark, sf), path)
    finite = F.when(~F.isnan("value"), c("value"))
    return spark.read.parquet(path).groupBy(
        OUTCOME, F.year("date").alias("year"), "name", "unit"
    ).agg(F.count(F.lit(1)).alias("series"), F.sum(finite).alias("total"))
