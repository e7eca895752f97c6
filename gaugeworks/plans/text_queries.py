"""Jobs over text replies. Every body is rendered from one table row; the SQL twin
computes the answer from the columns and never reads a body."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gaugeworks.functions.numbers import num_prefix, num_strict, num_zero
from gaugeworks.operators.ordered import counter_delta
from gaugeworks.plans.common import attrs_sql, base_sql, flat, land, long_sql, query, s, spread, table
from gaugeworks.sources import exposition, host, queues, redis

c = F.col


def lines(*rows: Column | str) -> Column:
    """Lines joined by line feeds; an absent line is left out."""
    return F.concat_ws("\n", *[F.lit(r) if isinstance(r, str) else r for r in rows])


def order_replies(spark, sf, body: Column, endpoint: Column | str = "e") -> DataFrame:
    """One raw reply per order."""
    end = F.lit(endpoint) if isinstance(endpoint, str) else endpoint
    return land(
        spread(table(spark, sf, "orders"), "o_orderkey"),
        c("o_orderkey"),
        s("c", c("o_custkey")),
        c("o_orderpriority"),
        c("o_orderdate"),
        target_type=F.lit("t"),
        endpoint=end,
        body=body,
    )


ORDER_SRC = (
    "(SELECT *, o_orderkey AS cycle_id, 'c' || o_custkey AS target, "
    "o_orderpriority AS instance FROM orders)"
)

# ---- INFO


def order_cols() -> tuple[Column, Column]:
    return c("o_orderkey"), c("o_custkey")


@query(
    "info_text",
    long_sql(
        ORDER_SRC,
        [
            ("db.redis.connections.connected", "o_custkey + 1", "{connections}"),
            ("db.redis.memory.peak_bytes", "CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey * 7 END", "By"),
            (
                "db.redis.evictions",
                "CASE WHEN o_orderkey % 320 <= 308 "
                "THEN CAST('1e' || (o_orderkey % 320) AS DOUBLE) END",
                "{keys}",
            ),
            ("db.redis.keyspace.hits", "o_orderkey % 4", "{hits}"),
            ("db.redis.keyspace.misses", "o_custkey % 3", "{misses}"),
            (
                "db.redis.keyspace.hit_ratio",
                "CASE WHEN o_orderkey % 4 + o_custkey % 3 > 0 THEN CAST(o_orderkey % 4 AS DOUBLE) "
                "/ CAST(o_orderkey % 4 + o_custkey % 3 AS DOUBLE) END",
                "1",
            ),
            (
                "db.redis.replication.lag",
                "CASE WHEN o_orderstatus = 'F' THEN o_orderkey - o_custkey * 3 END",
                "{bytes}",
            ),
        ],
        base_sql("redis"),
    ),
)
def info_text(spark, sf):
    return flat(redis.info(info_replies(spark, sf)))


def info_replies(spark, sf) -> DataFrame:
    key, cust = order_cols()
    body = lines(
        "# Clients\r",
        s("connected_clients:", cust),
        s("  connected_clients:", cust + 1, " \r"),
        "blocked_clients:many",
        s("used_memory: ", cust),
        "",
        s("#used_memory:", cust),
        F.when(key % 3 != 0, s("used_memory_peak:", cust * 7)),
        s("evicted_keys:1e", key % 320),
        "no separator here",
        s("keyspace_hits:", key % 4),
        s("keyspace_misses:", cust % 3),
        s("expired_keys:", key, ".0d"),
        s("role:", F.when(c("o_orderstatus") == "F", "slave").otherwise("master")),
        s("master_repl_offset:", key),
        s("slave_repl_offset:", cust * 3),
    )
    return order_replies(spark, sf, body)


@query(
    "info_version",
    "SELECT CAST(cycle_id AS BIGINT) AS cycle_id, target, 'db.instance.info' AS name, "
    "CAST(1 AS DOUBLE) AS value, '1' AS unit, 'db.instance=' || instance || ';db.name=' || target "
    "|| ';db.system=redis;db.version=' || CASE WHEN o_orderkey % 2 = 0 "
    "THEN '7.' || o_custkey ELSE '' END AS attrs FROM " + ORDER_SRC,
)
def info_version(spark, sf):
    key, cust = order_cols()
    body = lines("# Server", F.when(key % 2 == 0, s("redis_version:7.", cust)), s("tcp_port:", cust))
    return flat(redis.instance_version(order_replies(spark, sf, body)))


# ---- Exposition text


@query(
    "prom_first",
    long_sql(
        ORDER_SRC,
        [
            (
                "db.cassandra.read_latency_ms",
                "CASE WHEN o_orderkey % 2 = 0 THEN o_custkey * CAST(0.001 AS DOUBLE) "
                "WHEN o_orderkey % 3 = 0 THEN o_orderkey * CAST(0.001 AS DOUBLE) END",
                "ms",
            ),
            ("db.cassandra.connections.active", "o_custkey + 4", "{connections}"),
            (
                "db.cassandra.compactions_pending",
                "CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey END",
                "{compactions}",
            ),
            ("db.cassandra.storage.total_bytes", "o_orderkey * 1024", "By"),
        ],
        base_sql("cassandra"),
    ),
)
def prom_first(spark, sf):
    key, cust = order_cols()
    body = lines(
        "# TYPE cassandra_storage_load gauge",
        "cassandra_storage_load",  # a bare name takes nothing from the next line
        s("cassandra_storage_load ", key * 1024, " 1700000000"),
        s("cassandra_storage_load ", key),
        'cassandra_client_connectednativeclients{h="a"} none',
        s('cassandra_client_connectednativeclients{h="b"} ', cust + 4),
        s("cassandra_client_connectednativeclients ", cust + 9),
        F.when(key % 5 == 0, s('cassandra_compaction_pendingtasks{h="a"} ', cust, " 1700000000")).otherwise(
            s("\tcassandra_compaction_pendingtasks\t", cust, "\r")
        ),
        F.when(key % 3 == 0, s("cassandra_clientrequest_latency_mean ", key)),
        F.when(key % 2 == 0, s('cassandra_clientrequest_read_latency_mean{k="x"}', cust)),
        s('cassandra_table_livediskspaceused_count{s="}"} ', key),
        s("unknown_metric ", key),
    )
    return flat(exposition.cassandra_exposition(order_replies(spark, sf, body)))


def _crdb_body() -> Column:
    key, cust = order_cols()
    return lines(
        "capacity_used",
        s("ranges ", cust),
        s("ranges ", key),
        F.when(key % 4 == 0, s("sql_service_latency_p99 ", key)),
        s('sql_service_latency{quantile="0.5"} ', cust),
        F.when(key % 3 == 0, s('sql_service_latency{quantile="0.99"} ', cust + 70)),
        F.when(key % 3 == 0, s('sql_service_latency{quantile="0.99"} ', cust + 80)),
        s('sql_service_latency{quantile="0.999"} ', cust + 99),
        s('capacity_used{s="}"} ', key * 10),
        F.when(key % 2 == 0, s("capacity_available{store=\"1\"} ", cust * 10)),
        "ranges_unavailable",
        'liveness_livenodes{a="b"}',
    )


@query(
    "prom_p99",
    long_sql(
        ORDER_SRC,
        [
            (
                "db.cockroachdb.sql.latency_p99",
                "CASE WHEN o_orderkey % 3 = 0 THEN o_custkey + 80 "
                "WHEN o_orderkey % 4 = 0 THEN o_orderkey END",
                "ns",
            ),
            ("db.cockroachdb.ranges.total", "o_custkey", "{ranges}"),
            ("db.cockroachdb.capacity.used_bytes", "o_orderkey * 10", "By"),
            (
                "db.cockroachdb.capacity.available_bytes",
                "CASE WHEN o_orderkey % 2 = 0 THEN o_custkey * 10 END",
                "By",
            ),
        ],
        base_sql("cockroachdb"),
    ),
)
def prom_p99(spark, sf):
    return flat(exposition.cockroach_vars(order_replies(spark, sf, _crdb_body())))


@query(
    "prom_missing",
    "SELECT o_orderkey AS cycle_id, 'c' || o_custkey AS target, missing FROM orders, "
    "(SELECT unnest(['sql_query_count', 'sql_failure_count', 'sql_service_latency_p99', "
    "'ranges_unavailable', 'liveness_livenodes', 'capacity_available']) AS missing) "
    "WHERE CASE missing WHEN 'sql_service_latency_p99' "
    "THEN o_orderkey % 3 <> 0 AND o_orderkey % 4 <> 0 "
    "WHEN 'capacity_available' THEN o_orderkey % 2 <> 0 ELSE true END",
)
def prom_missing(spark, sf):
    lacking = exposition.cockroach_missing(order_replies(spark, sf, _crdb_body()))
    return lacking.select("cycle_id", c("target_name").alias("target"), "missing")


# ---- Stats YAML

SUPPLIER_SRC = (
    "(SELECT *, s_suppkey AS cycle_id, s_name AS target, 's' || s_nationkey AS instance "
    "FROM supplier)"
)


@query(
    "yaml_stats",
    long_sql(
        f"(SELECT * FROM {ORDER_SRC} WHERE o_orderstatus <> 'P')",
        [
            ("messaging.beanstalkd.jobs.ready", "o_custkey + 1", "{jobs}"),
            ("messaging.beanstalkd.jobs.total", "o_orderkey * 100", "{jobs}"),
            ("messaging.beanstalkd.cmd.put", "CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END", "{commands}"),
            ("messaging.beanstalkd.timeouts", "CASE WHEN o_orderkey % 2 = 0 THEN 3 END", "{timeouts}"),
        ],
        base_sql("beanstalkd"),
    ),
)
def yaml_stats(spark, sf):
    key, cust = order_cols()
    head = F.when(c("o_orderstatus") == "P", "NOT_FOUND\r").otherwise("OK 99\r")
    body = lines(
        head,
        "---",
        s("current-jobs-ready: ", cust),
        s("current-jobs-ready: ", cust + 1),
        s("total-jobs: ", key, "e2"),
        "current-tubes: two",
        s("current-workers:", cust),
        F.when(key % 2 != 0, "\r"),
        s("cmd-put: ", cust),
        "job-timeouts: 3",
        s("cmd-bury: ", key),
    )
    return flat(queues.beanstalkd_stats(order_replies(spark, sf, body)))


@query(
    "yaml_tubes",
    long_sql(
        "(SELECT s_suppkey AS cycle_id, s_name AS target, 's' || s_nationkey AS instance, "
        "'tube' || i AS tube, s_suppkey * 100 + i AS ready FROM supplier, "
        "generate_series(1, 90) AS g(i) WHERE i <= s_suppkey % 90 AND i % 4 <> 0)",
        [
            ("messaging.beanstalkd.tube.ready", "ready", "{jobs}"),
            ("messaging.beanstalkd.tube.total_jobs", "ready * 2", "{jobs}"),
        ],
        base_sql("beanstalkd", {"messaging.destination.name": "tube"}),
    ),
)
def yaml_tubes(spark, sf):
    key = c("s_suppkey")
    tubes = F.slice(F.sequence(F.lit(1), F.lit(90)), F.lit(1), (key % 90).cast("int"))
    suppliers = spread(table(spark, sf, "supplier"), "s_suppkey").withColumn("tubes", tubes)
    place = (key, c("s_name"), s("s", c("s_nationkey")))
    listing = F.concat(
        F.lit("OK 1\n---\n"),
        F.array_join(F.transform("tubes", lambda i: s("- tube", i, "\n")), ""),
    )
    lists = land(
        suppliers, *place, target_type=F.lit("b"), endpoint=F.lit("list-tubes"), body=listing
    )
    each = suppliers.withColumn("i", F.explode("tubes"))
    ready = key * 100 + c("i")
    reply = s(
        F.when(c("i") % 4 == 0, "NOT_FOUND\n").otherwise("OK 9\n---\n"),
        "current-jobs-ready: ", ready, "\ntotal-jobs: ", ready * 2, "\n",
    )
    replies = land(
        each, *place, target_type=F.lit("b"), endpoint=s("stats-tube tube", c("i")), body=reply
    )
    return flat(queues.beanstalkd_tubes(lists, replies))


# ---- Host text

CPU_SQL = {
    "user": "event_id * 7",
    "nice": "event_id",
    "system": "event_id * 3 + event_id % 5",
    "idle": "(event_id // 4) * 40",
    "iowait": "event_id % 9",
    "irq": "event_id // 3",
    "softirq": "event_id // 2",
    "steal": "event_id // 10",
}


def cpu_columns() -> dict[str, Column]:
    return {n: F.expr(e.replace("//", "div")) for n, e in CPU_SQL.items()}


def cpu_replies(spark, sf) -> DataFrame:
    body = F.concat(
        F.lit("cpu "), F.concat_ws(" ", *[v.cast("string") for v in cpu_columns().values()]),
        F.lit("\ncpu0 1 2 3\ncpu1 1 2 3\nintr 5\n"),
    )
    return land(
        spread(table(spark, sf, "events"), "event_id"),
        c("event_id"),
        s("u", c("user_id")),
        F.lit("localhost"),
        c("ts"),
        target_type=F.lit("host"),
        endpoint=F.lit("proc/stat"),
        body=body,
    )


def cpu_oracle() -> str:
    lagged = ", ".join(
        f"({e}) - lag({e}) OVER (PARTITION BY user_id ORDER BY ts) AS {n}"
        for n, e in CPU_SQL.items()
    )
    total = " + ".join(CPU_SQL)
    src = (
        f"(SELECT *, {total} AS total FROM (SELECT event_id AS cycle_id, 'u' || user_id AS target, "
        f"'localhost' AS instance, {lagged} FROM events))"
    )

    def share(part: str) -> str:
        return (
            f"CASE WHEN total <> 0 THEN CAST(100.0 AS DOUBLE) * CAST({part} AS DOUBLE) "
            "/ CAST(total AS DOUBLE) END"
        )

    busy = (
        "CASE WHEN total <> 0 THEN CAST(100.0 AS DOUBLE) * (CAST(1.0 AS DOUBLE) "
        "- CAST(idle AS DOUBLE) / CAST(total AS DOUBLE)) END"
    )
    return long_sql(
        src,
        [
            ("host.cpu.cores", "CASE WHEN total IS NULL OR total <> 0 THEN 2 END", "{cores}"),
            ("host.cpu.utilization", busy, "%"),
            *[(f"host.cpu.{p}", share(p), "%") for p in ("user", "system", "iowait", "steal")],
        ],
        base_sql("host"),
    )


@query("cpu_shares", cpu_oracle())
def cpu_shares(spark, sf):
    return flat(host.cpu(cpu_replies(spark, sf)))


@query(
    "cpu_delta",
    "SELECT event_id, user_id, "
    + ", ".join(
        f"CAST(({e}) - lag({e}) OVER (PARTITION BY user_id ORDER BY ts) AS DOUBLE) AS d_{n}"
        for n, e in CPU_SQL.items()
    )
    + " FROM events",
)
def cpu_delta(spark, sf):
    counters = table(spark, sf, "events").select(
        "event_id", "user_id", "ts", *[v.cast("double").alias(n) for n, v in cpu_columns().items()]
    )
    deltas = counter_delta(counters, ["user_id"], "ts", list(CPU_SQL))
    return deltas.select("event_id", "user_id", *[f"d_{n}" for n in CPU_SQL])


@query(
    "meminfo",
    long_sql(
        "(SELECT *, (o_custkey % 50) * 1000 AS total, CASE WHEN o_orderkey % 3 = 0 THEN o_custkey % 700 "
        f"ELSE 0 END AS swap FROM {ORDER_SRC})",
        [
            ("host.memory.total", "total * 1024", "By"),
            ("host.memory.available", "o_custkey % 100 * 1024", "By"),
            ("host.memory.used", "(total - o_custkey % 100) * 1024", "By"),
            ("host.memory.buffers", "CASE WHEN o_orderkey % 2 = 0 THEN o_custkey * 1024 ELSE 0 END", "By"),
            ("host.memory.cached", "o_orderkey * 1024", "By"),
            (
                "host.memory.utilization",
                "CASE WHEN total > 0 THEN CAST(100.0 AS DOUBLE) * "
                "CAST((total - o_custkey % 100) * 1024 AS DOUBLE) / CAST(total * 1024 AS DOUBLE) END",
                "%",
            ),
            ("host.memory.swap_total", "CASE WHEN swap > 0 THEN swap * 1024 END", "By"),
            ("host.memory.swap_used", "CASE WHEN swap > 0 THEN (swap - 5) * 1024 END", "By"),
        ],
        base_sql("host"),
    ),
)
def meminfo(spark, sf):
    key, cust = order_cols()
    body = lines(
        s("MemTotal:       ", cust % 50 * 1000, " kB"),
        s("MemAvailable:   ", cust % 100, " kB"),
        F.when(key % 2 == 0, s("Buffers: ", cust, " kB")).otherwise(F.lit("Buffers: n/a kB")),
        s("Cached: 1 kB"),
        s("Cached: ", key, " kB"),
        s("HugePages_Total: ", key),
        F.when(key % 3 == 0, s("SwapTotal: ", cust % 700, " kB")),
        "SwapFree: 5 kB",
    )
    return flat(host.memory(order_replies(spark, sf, body)))


@query(
    "netdev",
    long_sql(
        f"(SELECT *, 'eth' || i AS iface FROM {ORDER_SRC}, generate_series(0, 1) AS g(i) "
        "WHERE i = 0 OR o_orderkey % 2 = 0)",
        [
            (name, f"(o_orderkey + i) * {n}", unit)
            for n, (_, name, unit) in zip((1, 2, 3, 4, 9, 10, 11, 12), host.NET_FIELDS)
        ],
        base_sql("host", {"host.network.interface": "iface"}),
    ),
)
def netdev(spark, sf):
    key, _ = order_cols()
    def row(iface: str, base: Column, count: int) -> Column:
        return s(f"  {iface}: ", F.concat_ws("  ", *[(base * n).cast("string") for n in range(1, count + 1)]))

    body = lines(
        "Inter-|   Receive  |  Transmit",
        " face |bytes packets | bytes: packets",
        row("lo", key, 16),
        row("eth0", key, 16),
        F.when(key % 2 == 0, row("eth1", key + 1, 12)),
        row("short", key, 11),
        "no colon",
    )
    return flat(host.network(order_replies(spark, sf, body)))


@query(
    "load",
    long_sql(
        f"(SELECT * FROM {ORDER_SRC} WHERE o_orderkey % 4 <> 0)",
        [
            ("host.load.1m", "o_custkey", "1"),
            ("host.load.5m", "o_custkey / CAST(4 AS DOUBLE)", "1"),
            ("host.load.15m", "CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey ELSE 0 END", "1"),
        ],
        base_sql("host"),
    ),
)
def load(spark, sf):
    key, cust = order_cols()
    quarter = (cust * 25).cast("string")
    hundredths = F.concat(
        F.floor(cust / 4).cast("string"), F.lit("."), F.lpad((cust % 4 * 25).cast("string"), 2, "0")
    )
    third = F.when(key % 3 == 0, s(key)).otherwise(s(quarter, "x"))
    body = F.when(key % 4 == 0, s(cust, " ", hundredths, "\n")).otherwise(
        s(cust, " ", hundredths, " ", third, " 1/2 3\n")
    )
    return flat(host.load(order_replies(spark, sf, body)))


# What hosts are changes in 1995; some hosts are unknown before that.
_FACTS = (
    "(SELECT DISTINCT 'c' || o_custkey AS target, o_orderpriority AS instance, TIMESTAMP '1992-01-01' AS at, "
    "NULL AS host_name, 'amd64' AS arch, 'linux' AS os FROM orders WHERE o_custkey % 5 <> 0 UNION ALL "
    "SELECT DISTINCT 'c' || o_custkey, o_orderpriority, TIMESTAMP '1995-06-17', 'h' || o_custkey, "
    "CASE WHEN o_custkey % 2 = 0 THEN 'arm64' ELSE 'amd64' END, 'linux' FROM orders)"
)


@query(
    "host_facts",
    long_sql(
        f"(SELECT o.*, f.host_name, f.arch, f.os FROM {ORDER_SRC} o ASOF LEFT JOIN {_FACTS} f "
        "ON o.target = f.target AND o.instance = f.instance AND o.o_orderdate >= f.at)",
        [("host.load.1m", "o_custkey", "1"), ("host.load.5m", "o_orderkey", "1"), ("host.load.15m", "0", "1")],
        attrs_sql({"host.name": "coalesce(host_name, target)", "host.arch": "arch", "os.type": "os"}),
    ),
)
def host_facts(spark, sf):
    """Load averages with what their host was at the time."""
    key, cust = order_cols()
    replies = order_replies(spark, sf, s(cust, " ", key, " x\n"))
    hosts = table(spark, sf, "orders").select("o_custkey", "o_orderpriority").distinct()

    def landed(at: str, name: Column, arch: Column | str, some: DataFrame) -> DataFrame:
        return land(
            some, 1, s("c", cust), c("o_orderpriority"), F.lit(at).cast("timestamp_ntz"),
            host_name=name, arch=F.lit(arch) if isinstance(arch, str) else arch, os_type=F.lit("linux"),
        )

    late = F.when(cust % 2 == 0, "arm64").otherwise("amd64")
    facts = landed("1992-01-01", F.lit(None).cast("string"), "amd64", hosts.where(cust % 5 != 0)).unionByName(
        landed("1995-06-17", s("h", cust), late, hosts)
    )
    return flat(host.load(replies, facts=facts))


# ---- Number rules


@query(
    "number_rules",
    "SELECT o_orderkey, CAST(CASE form WHEN 0 THEN o_custkey WHEN 1 THEN -(o_custkey + 4) / CAST(4 AS DOUBLE) "
    "WHEN 2 THEN o_custkey * 100 END AS DOUBLE) AS strict, "
    "CAST(CASE form WHEN 0 THEN o_custkey WHEN 1 THEN -(o_custkey + 4) / CAST(4 AS DOUBLE) "
    "WHEN 2 THEN o_custkey * 100 WHEN 7 THEN CAST('inf' AS DOUBLE) ELSE 0 END AS DOUBLE) AS zeroed, "
    "CAST(CASE form WHEN 0 THEN o_custkey WHEN 1 THEN -(o_custkey + 4) / CAST(4 AS DOUBLE) "
    "WHEN 2 THEN o_custkey * 100 WHEN 3 THEN o_custkey WHEN 4 THEN o_custkey WHEN 5 THEN o_custkey "
    "WHEN 6 THEN 0 ELSE 0 END AS DOUBLE) AS prefixed "
    "FROM (SELECT *, o_orderkey % 9 AS form FROM orders)",
)
def number_rules(spark, sf):
    key, cust = order_cols()
    form = key % 9
    quarter = F.concat(
        F.lit("-"), F.floor(cust / 4 + 1).cast("string"), F.lit("."), F.lpad((cust % 4 * 25).cast("string"), 2, "0")
    )
    text = (
        F.when(form == 0, s(cust))
        .when(form == 1, quarter)
        .when(form == 2, s("+", cust, ".0E2"))
        .when(form == 3, s(" ", cust, " "))
        .when(form == 4, s(cust, ".0d"))
        .when(form == 5, s(cust, "f"))
        .when(form == 6, s(cust, "e"))
        .when(form == 7, F.lit("9e999"))
        .otherwise("x")
    )
    return spread(table(spark, sf, "orders"), "o_orderkey").select(
        "o_orderkey",
        num_strict(text).alias("strict"),
        num_zero(text).alias("zeroed"),
        num_prefix(text).alias("prefixed"),
    )
