"""Jobs over landed statistics tables, bound to the benchmark tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gaugeworks.plans.common import attrs_sql, base_sql, flat, land, long_sql, query, s, table
from gaugeworks.sources import databases, host, kafka, postgres, redis

c = F.col

# ---- PostgreSQL

PG_COLUMNS = {
    "numbackends": "count(*)",
    "xact_commit": "count(CASE WHEN o_orderstatus = 'F' THEN 1 END)",
    "xact_rollback": "count(CASE WHEN o_orderstatus = 'O' THEN 1 END)",
    "blks_read": "sum(o_orderkey % 3)",
    "blks_hit": "sum(o_custkey % 2)",
    "tup_returned": "sum(o_orderkey)",
    "tup_fetched": "max(o_orderkey)",
    "tup_inserted": "min(o_orderkey)",
    "tup_updated": "count(CASE WHEN o_orderstatus = 'P' THEN 1 END)",
    "tup_deleted": "sum(o_orderkey % 5)",
    "deadlocks": "max(o_orderkey % 7)",
    "temp_bytes": "sum(o_orderkey % 1024)",
}
PG_NAMES = {
    "numbackends": ("connections.active", "{connections}"),
    "xact_commit": ("transactions.committed", "{transactions}"),
    "xact_rollback": ("transactions.rolledback", "{transactions}"),
    "blks_read": ("blocks.read", "{blocks}"),
    "blks_hit": ("blocks.hit", "{blocks}"),
    "tup_returned": ("rows.returned", "{rows}"),
    "tup_fetched": ("rows.fetched", "{rows}"),
    "tup_inserted": ("rows.inserted", "{rows}"),
    "tup_updated": ("rows.updated", "{rows}"),
    "tup_deleted": ("rows.deleted", "{rows}"),
    "deadlocks": ("deadlocks", "{deadlocks}"),
    "temp_bytes": ("temp_bytes", "By"),
}
_pg_src = (
    "(SELECT 1 AS cycle_id, 'db' || o_custkey AS target, 'pg' AS instance, "
    + ", ".join(f"CAST({e} AS BIGINT) AS {n}" for n, e in PG_COLUMNS.items())
    + " FROM orders GROUP BY o_custkey)"
)


@query(
    "stat_wide_to_long",
    long_sql(
        _pg_src,
        [(f"db.postgres.{n}", col, u) for col, (n, u) in PG_NAMES.items()]
        + [
            (
                "db.postgres.cache_hit_ratio",
                "CASE WHEN blks_hit + blks_read > 0 THEN "
                "CAST(blks_hit AS DOUBLE) / CAST(blks_hit + blks_read AS DOUBLE) ELSE 0 END",
                "1",
            )
        ],
        base_sql("postgres"),
    ),
)
def stat_wide_to_long(spark, sf):
    stats = table(spark, sf, "orders").groupBy("o_custkey").agg(
        *[F.expr(e).alias(n) for n, e in PG_COLUMNS.items()]
    )
    name = s("db", c("o_custkey"))
    landed = land(stats, 1, name, F.lit("pg"), datname=name, **{n: c(n) for n in PG_COLUMNS})
    return flat(postgres.stat_database(landed, c("target_name")))


@query(
    "db_size",
    long_sql(
        "(SELECT 1 AS cycle_id, 'supplier' || l_suppkey AS target, 'pg' AS instance, "
        "CAST(sum(l_quantity) AS BIGINT) AS size FROM lineitem GROUP BY l_suppkey)",
        [("db.postgres.database_size_bytes", "size", "By")],
        base_sql("postgres"),
    ),
)
def db_size(spark, sf):
    sizes = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.sum("l_quantity").alias("q"))
    name = s("supplier", c("l_suppkey"))
    landed = land(sizes, 1, name, F.lit("pg"), datname=name, size_bytes=c("q").cast("bigint"))
    return flat(postgres.database_size(landed))


@query(
    "activity_rollup",
    long_sql(
        "(SELECT 1 AS cycle_id, 'db' || o_custkey AS target, 'pg' AS instance, "
        "count(CASE WHEN o_orderstatus = 'O' THEN 1 END) AS idle, "
        "count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS active, "
        "count(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 END) AS waiting, "
        "coalesce(max(epoch(TIMESTAMP '2002-01-01') - epoch(o_orderdate)) "
        "FILTER (WHERE o_orderstatus = 'F'), 0) AS longest FROM orders GROUP BY o_custkey)",
        [
            ("db.postgres.connections.idle", "idle", "{connections}"),
            ("db.postgres.connections.active", "active", "{connections}"),
            ("db.postgres.connections.waiting", "waiting", "{connections}"),
            ("db.postgres.longest_query_seconds", "longest", "s"),
        ],
        base_sql("postgres"),
    ),
)
def activity_rollup(spark, sf):
    state = (
        F.when(c("o_orderstatus") == "O", "idle")
        .when(c("o_orderstatus") == "F", "active")
        .otherwise("idle in transaction")
    )
    name = s("db", c("o_custkey"))
    sessions = land(
        table(spark, sf, "orders"),
        1,
        name,
        F.lit("pg"),
        datname=name,
        state=state,
        wait_event_type=F.when(c("o_orderpriority") == "1-URGENT", "Lock"),
        query_start=c("o_orderdate"),
    )
    return flat(postgres.stat_activity(sessions, c("target_name")))


@query(
    "user_tables_top10",
    long_sql(
        "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY target, instance "
        "ORDER BY seq_scan DESC NULLS LAST, sch, rel) AS rn FROM "
        "(SELECT 1 AS cycle_id, p_brand AS target, p_type AS instance, p_name AS sch, "
        "'t' || p_partkey AS rel, CASE WHEN p_size % 10 <> 0 THEN p_size END AS seq_scan, "
        "CASE WHEN p_size % 4 <> 0 THEN p_partkey END AS idx_scan, p_size * 2 AS dead, "
        "p_partkey * 3 AS live FROM part)) WHERE rn <= 10)",
        [
            ("db.postgres.table.seq_scan", "coalesce(seq_scan, 0)", "{scans}"),
            ("db.postgres.table.idx_scan", "coalesce(idx_scan, 0)", "{scans}"),
            ("db.postgres.table.dead_tuples", "dead", "{tuples}"),
            ("db.postgres.table.live_tuples", "live", "{tuples}"),
        ],
        base_sql("postgres", {"db.sql.table": "sch || '.' || rel"}),
    ),
)
def user_tables_top10(spark, sf):
    tables = land(
        table(spark, sf, "part"),
        1,
        c("p_brand"),
        c("p_type"),
        schemaname=c("p_name"),
        relname=s("t", c("p_partkey")),
        seq_scan=F.when(c("p_size") % 10 != 0, c("p_size").cast("bigint")),
        idx_scan=F.when(c("p_size") % 4 != 0, c("p_partkey")),
        n_dead_tup=(c("p_size") * 2).cast("bigint"),
        n_live_tup=c("p_partkey") * 3,
    )
    return flat(postgres.user_tables(tables))


@query(
    "statements_top10",
    long_sql(
        "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY target, instance "
        "ORDER BY n_chars DESC NULLS LAST, qid) AS rn FROM "
        "(SELECT 1 AS cycle_id, lang AS target, source AS instance, CAST(doc_id AS VARCHAR) AS qid, "
        "text AS stmt, n_chars, doc_id FROM documents d WHERE EXISTS "
        "(SELECT 1 FROM documents e JOIN labels l ON l.doc_id = e.doc_id "
        "WHERE l.quality = 1 AND e.lang = d.lang AND e.source = d.source))) WHERE rn <= 10)",
        [
            ("db.postgres.query.avg_time_ms", "n_chars", "ms"),
            ("db.postgres.query.calls", "doc_id", "{calls}"),
        ],
        base_sql("postgres", {"db.statement": "stmt", "db.query_id": "qid"}),
    ),
)
def statements_top10(spark, sf):
    docs = table(spark, sf, "documents")
    stmts = land(
        docs,
        1,
        c("lang"),
        c("source"),
        queryid=c("doc_id").cast("string"),
        query=c("text"),
        mean_exec_time=c("n_chars").cast("double"),
        calls=c("doc_id"),
    )
    labelled = docs.select("doc_id", "lang", "source").join(table(spark, sf, "labels"), "doc_id")
    extensions = land(
        labelled,
        1,
        c("lang"),
        c("source"),
        extname=F.when(c("quality") == 1, postgres.STATEMENTS).otherwise("plpgsql"),
    )
    return flat(postgres.statements(stmts, extensions))


@query(
    "instance_info",
    "SELECT CAST(s_suppkey AS BIGINT) AS cycle_id, s_name AS target, 'db.instance.info' AS name, "
    "CAST(1 AS DOUBLE) AS value, '1' AS unit, "
    + attrs_sql(
        {
            "db.system": "kind",
            "db.version": "version",
            "db.name": "s_name",
            "db.instance": "s_nationkey",
        }
    )
    + " AS attrs FROM (SELECT *, CASE s_suppkey % 3 WHEN 0 THEN 'postgres' WHEN 1 THEN 'mysql' "
    "ELSE 'mongodb' END AS kind, CASE WHEN s_suppkey % 4 <> 0 THEN 'v' || s_suppkey END AS version "
    "FROM supplier) WHERE version IS NOT NULL OR kind = 'postgres'",
)
def instance_info(spark, sf):
    key = c("s_suppkey")
    kind = F.when(key % 3 == 0, "postgres").when(key % 3 == 1, "mysql").otherwise("mongodb")
    versions = land(
        table(spark, sf, "supplier"),
        key,
        c("s_name"),
        c("s_nationkey"),
        target_type=kind,
        version=F.when(key % 4 != 0, s("v", key)),
    )
    return flat(databases.instance_info(versions))


# ---- MySQL, ClickHouse, SQLite, Redis slow log

MYSQL_BY_TYPE = {
    "view": "Threads_connected",
    "click": "Questions",
    "signup": "Innodb_buffer_pool_read_requests",
    "purchase": "Innodb_buffer_pool_reads",
    "error": "Uptime",
}


def _of_type(kind: str) -> str:
    return f"arg_max(num, event_id) FILTER (WHERE event_type = '{kind}')"


@query(
    "status_kv",
    long_sql(
        "(SELECT 1 AS cycle_id, 'u' || user_id AS target, 'my' AS instance, "
        + ", ".join(
            f"CASE WHEN max(CASE WHEN event_type = '{k}' AND num IS NULL THEN event_id END) "
            f"IS NOT DISTINCT FROM max(CASE WHEN event_type = '{k}' THEN event_id END) THEN NULL "
            f"ELSE {_of_type(k)} END AS {k}_v"
            for k in ("view", "click", "signup", "purchase")
        )
        + " FROM (SELECT *, CASE WHEN event_id % 11 <> 0 THEN event_id END AS num FROM events) "
        "GROUP BY user_id)",
        [
            ("db.mysql.connections.current", "view_v", "{connections}"),
            ("db.mysql.queries.total", "click_v", "{queries}"),
            (
                "db.mysql.innodb.buffer_pool_hit_ratio",
                "CASE WHEN signup_v > 0 THEN "
                "CAST(signup_v - purchase_v AS DOUBLE) / CAST(signup_v AS DOUBLE) END",
                "1",
            ),
        ],
        base_sql("mysql"),
    ),
)
def status_kv(spark, sf):
    names = F.create_map(*[F.lit(x) for kv in MYSQL_BY_TYPE.items() for x in kv])
    rows = land(
        table(spark, sf, "events"),
        1,
        s("u", c("user_id")),
        F.lit("my"),
        pos=c("event_id"),
        name=names[c("event_type")],
        value=F.when(c("event_id") % 11 != 0, c("event_id").cast("string")).otherwise("n/a"),
    )
    return flat(databases.mysql_status(rows))


CH_METRIC = {
    "view": "Query",
    "click": "HTTPConnection",
    "signup": "TCPConnection",
    "purchase": "MemoryTracking",
    "error": "Uptime",
}
CH_EVENT = {
    "view": "Query",
    "click": "FailedQuery",
    "signup": "InsertedRows",
    "purchase": "SelectedBytes",
    "error": "Uptime",
}
# The number a text starts with, computed without reading the text.
_CH_NUM = (
    "CASE WHEN event_id % 7 = 0 THEN 0 WHEN event_id % 3 = 1 THEN event_id "
    "WHEN event_id % 3 = 2 THEN event_id * 100 + 50 ELSE event_id END"
)
_ch_src = (
    "(SELECT event_id AS cycle_id, 'u' || user_id AS target, event_type AS instance, "
    f"event_type, CAST({_CH_NUM} AS DOUBLE) AS num FROM events)"
)


def _ch_rows(spark, sf, column, names):
    event = c("event_id")
    text = (
        F.when(event % 7 == 0, F.lit("x1"))
        .when(event % 3 == 1, s(event, "abc"))
        .when(event % 3 == 2, s(" ", event, ".5e2 ms"))
        .otherwise(s(event))
    )
    mapped = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    return land(
        table(spark, sf, "events"),
        event,
        s("u", c("user_id")),
        c("event_type"),
        c("ts"),
        **{column: mapped[c("event_type")], "value": text},
    )


def _ch_oracle(entries):
    return long_sql(
        _ch_src,
        [
            (f"db.clickhouse.{n}", f"CASE WHEN event_type = '{kind}' THEN num END", u)
            for kind, n, u in entries
        ],
        base_sql("clickhouse"),
    )


@query(
    "key_filter_map",
    _ch_oracle(
        [
            ("view", "queries.active", "{queries}"),
            ("click", "connections.http", "{connections}"),
            ("signup", "connections.tcp", "{connections}"),
            ("purchase", "memory.tracked_bytes", "By"),
        ]
    ),
)
def key_filter_map(spark, sf):
    return flat(databases.clickhouse_metrics(_ch_rows(spark, sf, "metric", CH_METRIC)))


@query(
    "event_key_map",
    _ch_oracle(
        [
            ("view", "queries.total", "{queries}"),
            ("click", "queries.failed", "{queries}"),
            ("signup", "inserted_rows", "{rows}"),
            ("purchase", "selected_bytes", "By"),
        ]
    ),
)
def event_key_map(spark, sf):
    return flat(databases.clickhouse_events(_ch_rows(spark, sf, "event", CH_EVENT)))


@query(
    "count_sum",
    long_sql(
        "(SELECT 1 AS cycle_id, 'supplier' || l_suppkey AS target, 'ch' AS instance, "
        "count(*) FILTER (WHERE l_returnflag = 'N' AND l_suppkey % 5 <> 0) AS n, "
        "CAST(coalesce(sum(l_quantity) FILTER (WHERE l_returnflag = 'N' AND l_suppkey % 5 <> 0), 0) AS BIGINT) "
        "AS total FROM lineitem GROUP BY l_suppkey)",
        [
            ("db.clickhouse.parts.active", "n", "{parts}"),
            ("db.clickhouse.parts.total_bytes", "total", "By"),
        ],
        base_sql("clickhouse"),
    ),
)
def count_sum(spark, sf):
    return flat(databases.clickhouse_parts(part_rows(spark, sf)))


def part_rows(spark, sf) -> DataFrame:
    return land(
        table(spark, sf, "lineitem"),
        1,
        s("supplier", c("l_suppkey")),
        F.lit("ch"),
        pos=c("l_orderkey"),
        active=((c("l_returnflag") == "N") & (c("l_suppkey") % 5 != 0)).cast("int"),
        bytes_on_disk=c("l_quantity").cast("bigint"),
    )


@query(
    "sqlite_math",
    long_sql(
        "(SELECT p_partkey AS cycle_id, p_brand AS target, p_type AS instance, "
        "p_partkey % 50 AS n, CASE WHEN p_size % 9 = 0 THEN 0 ELSE p_size * 512 END AS size, "
        "CASE p_partkey % 3 WHEN 0 THEN -p_partkey WHEN 1 THEN p_partkey END AS cache, "
        "CASE WHEN p_partkey % 4 <> 0 THEN p_size END AS done FROM part)",
        [
            ("db.sqlite.database_size_bytes", "CASE WHEN n > 0 AND size > 0 THEN n * size END", "By"),
            ("db.sqlite.page_size", "size", "By"),
            (
                "db.sqlite.cache_size_pages",
                "CASE WHEN cache >= 0 THEN cache WHEN size > 0 THEN (-cache * 1024) // size END",
                "{pages}",
            ),
            ("db.sqlite.wal_checkpoint_count", "done", "{checkpoints}"),
        ],
        base_sql("sqlite"),
    ),
)
def sqlite_math(spark, sf):
    key, size = c("p_partkey"), c("p_size").cast("bigint")
    pragmas = land(
        table(spark, sf, "part"),
        key,
        c("p_brand"),
        c("p_type"),
        page_count=key % 50,
        page_size=F.when(size % 9 == 0, F.lit(0)).otherwise(size * 512),
        cache_size=F.when(key % 3 == 0, -key).when(key % 3 == 1, key),
        checkpointed=F.when(key % 4 != 0, size),
    )
    return flat(databases.sqlite_pragmas(pragmas))


@query(
    "slowlog_head",
    long_sql(
        "(SELECT 1 AS cycle_id, 'u' || user_id AS target, 'r' AS instance, count(*) AS n, "
        "arg_max(d, event_id) AS latest FROM (SELECT *, event_id * 37 % 5000 AS d, "
        "row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) "
        "WHERE rn <= 10 GROUP BY user_id)",
        [
            ("db.redis.slowlog.count", "n", "{entries}"),
            ("db.redis.slowlog.latest_duration_us", "latest", "us"),
        ],
        base_sql("redis"),
    ),
)
def slowlog_head(spark, sf):
    log = land(
        table(spark, sf, "events"),
        1,
        s("u", c("user_id")),
        F.lit("r"),
        entry_id=c("event_id"),
        duration_us=c("event_id") * 37 % 5000,
    )
    return flat(redis.slowlog(log))


# ---- Kafka


@query(
    "broker_count",
    long_sql(
        "(SELECT 1 AS cycle_id, 'n' || s_nationkey AS target, 'k' AS instance, count(*) AS n, "
        "max(CASE WHEN s_acctbal > 5000 THEN CASE WHEN s_suppkey % 3 = 0 THEN '[fe80::' || s_suppkey || ']' "
        "ELSE s_name END || ':' || (9000 + s_nationkey) END) AS ctl "
        "FROM supplier GROUP BY s_nationkey)",
        [("messaging.kafka.brokers.count", "n", "{brokers}")],
        base_sql("kafka", {"messaging.kafka.controller": "ctl"}),
    ),
)
def broker_count(spark, sf):
    brokers = land(
        table(spark, sf, "supplier"),
        1,
        s("n", c("s_nationkey")),
        F.lit("k"),
        host=F.when(c("s_suppkey") % 3 == 0, s("fe80::", c("s_suppkey"))).otherwise(c("s_name")),
        port=c("s_nationkey") + 9000,
        is_controller=c("s_acctbal") > 5000,
    )
    return flat(kafka.brokers(brokers))


_states = "(SELECT 1 AS cycle_id, 'c' || o_custkey AS target, 'k' AS instance, "


@query(
    "states_count",
    long_sql(
        _states + "o_orderstatus AS st, count(*) AS n FROM orders GROUP BY o_custkey, o_orderstatus)",
        [("messaging.kafka.consumer_groups.by_state", "n", "{groups}")],
        base_sql("kafka", {"messaging.kafka.consumer_group.state": "st"}),
    )
    + " UNION ALL "
    + long_sql(
        _states + "count(*) AS n FROM orders GROUP BY o_custkey)",
        [("messaging.kafka.consumer_groups.count", "n", "{groups}")],
        base_sql("kafka"),
    ),
)
def states_count(spark, sf):
    groups = land(
        table(spark, sf, "orders"),
        1,
        s("c", c("o_custkey")),
        F.lit("k"),
        group_id=s("g", c("o_orderkey")),
        state=c("o_orderstatus"),
    )
    return flat(kafka.group_states(groups))


_topics = (
    "(SELECT 1 AS cycle_id, p_type AS target, 'k' AS instance, topic, count(*) AS parts, "
    "max(r) AS repl, sum(i) AS isr, greatest(0, count(*) * max(r) - sum(i)) AS under FROM "
    "(SELECT *, CASE WHEN p_name LIKE 'red%' THEN '_' || p_brand ELSE p_brand END AS topic, "
    "1 + p_size % 3 AS r, CASE WHEN p_partkey % 5 = 0 THEN p_size % 3 ELSE 1 + p_size % 3 END AS i "
    "FROM part) GROUP BY p_type, topic)"
)
_user = "NOT starts_with(topic, '_')"


@query(
    "topic_rollup",
    long_sql(
        f"(SELECT * FROM {_topics} WHERE {_user})",
        [
            ("messaging.kafka.topic.partitions", "parts", "{partitions}"),
            ("messaging.kafka.topic.replication_factor", "repl", "1"),
            ("messaging.kafka.topic.under_replicated", "under", "{partitions}"),
        ],
        base_sql("kafka", {"messaging.destination.name": "topic"}),
    )
    + " UNION ALL "
    + long_sql(
        f"(SELECT cycle_id, target, instance, count(CASE WHEN {_user} THEN 1 END) AS topics, "
        f"sum(parts) AS parts, coalesce(sum(under) FILTER (WHERE {_user}), 0) AS under "
        f"FROM {_topics} GROUP BY ALL)",
        [
            ("messaging.kafka.topics.count", "topics", "{topics}"),
            ("messaging.kafka.partitions.total", "parts", "{partitions}"),
            ("messaging.kafka.under_replicated.total", "under", "{partitions}"),
        ],
        base_sql("kafka"),
    ),
)
def topic_rollup(spark, sf):
    internal = c("p_name").startswith("red")
    n = 1 + c("p_size") % 3
    ids = F.array(F.lit(1), F.lit(2), F.lit(3))
    partitions = land(
        table(spark, sf, "part"),
        1,
        c("p_type"),
        F.lit("k"),
        topic=F.when(internal, s("_", c("p_brand"))).otherwise(c("p_brand")),
        partition=c("p_partkey").cast("int"),
        replicas=F.slice(ids, F.lit(1), n),
        isr=F.slice(ids, F.lit(1), n - F.when(c("p_partkey") % 5 == 0, 1).otherwise(0)),
    )
    return flat(kafka.topics(partitions))


@query(
    "consumer_lag",
    long_sql(
        "(SELECT 1 AS cycle_id, 'cluster' AS target, 'k' AS instance, g, lag FROM (SELECT g, "
        "sum(CASE WHEN off >= 0 THEN greatest(0, coalesce(last - off, 0)) ELSE 0 END) AS lag FROM "
        "(SELECT 'g' || (o_custkey % 60) AS g, o_orderkey, o_orderkey % 1000 - 5 AS off FROM orders) "
        "LEFT JOIN (SELECT l_orderkey, max(l_linenumber * 100 + CAST(l_quantity AS BIGINT)) AS last "
        "FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey GROUP BY g))",
        [("messaging.kafka.consumer_group.lag", "lag", "{messages}")],
        base_sql("kafka", {"messaging.kafka.consumer_group": "g"}),
    ),
)
def consumer_lag(spark, sf):
    orders = table(spark, sf, "orders").withColumn("g", s("g", c("o_custkey") % 60))
    name, k = F.lit("cluster"), F.lit("k")
    groups = land(orders.select("g").distinct(), 1, name, k, group_id=c("g"), state=F.lit("Stable"))
    committed = land(
        orders,
        1,
        name,
        k,
        group_id=c("g"),
        topic=F.lit("orders"),
        partition=c("o_orderkey"),
        committed_offset=c("o_orderkey") % 1000 - 5,
    )
    ends = land(
        table(spark, sf, "lineitem"),
        1,
        name,
        k,
        topic=F.lit("orders"),
        partition=c("l_orderkey"),
        last_offset=c("l_linenumber") * 100 + c("l_quantity").cast("bigint"),
    )
    return flat(kafka.group_lag(groups, committed, ends))


# ---- Mounts


@query(
    "mounts",
    long_sql(
        "(SELECT 1 AS cycle_id, p_brand AS target, 'localhost' AS instance, dev, "
        "arg_min(mnt, p_partkey) AS mnt, arg_min(total, p_partkey) AS total, "
        "arg_min(used, p_partkey) AS used, arg_min(free, p_partkey) AS free, "
        "arg_min(good, p_partkey) AS good FROM (SELECT *, "
        "CASE WHEN p_size % 7 = 0 THEN 'tmpfs' ELSE '/dev/' || p_type || p_size END AS dev, "
        "'/mnt/' || p_partkey AS mnt, p_partkey * 4096 AS total, "
        "(p_partkey - p_partkey // 2) * 4096 AS used, (p_partkey // 3) * 4096 AS free, "
        "p_partkey % 6 <> 0 AS good FROM part WHERE p_size % 7 <> 0 AND p_size % 8 <> 0) "
        "GROUP BY p_brand, dev)",
        [
            (n, f"CASE WHEN good THEN {v} END", u)
            for n, v, u in [
                ("host.disk.total", "total", "By"),
                ("host.disk.used", "used", "By"),
                ("host.disk.free", "free", "By"),
                (
                    "host.disk.utilization",
                    "CASE WHEN total > 0 THEN "
                    "CAST(100.0 AS DOUBLE) * CAST(used AS DOUBLE) / CAST(total AS DOUBLE) END",
                    "%",
                ),
            ]
        ],
        base_sql("host", {"host.disk.device": "dev", "host.disk.mountpoint": "mnt"}),
    ),
)
def mounts(spark, sf):
    key, size = c("p_partkey"), c("p_size")
    listed = land(
        table(spark, sf, "part"),
        1,
        c("p_brand"),
        F.lit("localhost"),
        pos=key,
        device=F.when(size % 7 == 0, F.lit("tmpfs")).otherwise(s("/dev/", c("p_type"), size)),
        mountpoint=s("/mnt/", key),
        fstype=F.when(size % 8 == 0, F.lit("squashfs")).otherwise("ext4"),
        blocks=key,
        bsize=F.lit(4096).cast("bigint"),
        bfree=F.floor(key / 2),
        bavail=F.floor(key / 3),
        statfs_ok=key % 6 != 0,
    )
    return flat(host.disk(listed))
