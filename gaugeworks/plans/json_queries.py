"""Jobs over JSON replies. Every body is rendered from one table row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gaugeworks.functions.numbers import num_json
from gaugeworks.operators.aggregate import weighted_avg
from gaugeworks.operators.join import replica_lag as replica_lag_op
from gaugeworks.plans.common import base_sql, flat, land, long_sql, query, s, spread, table
from gaugeworks.sources import activemq, documents, exposition

c = F.col


def customer_replies(spark, sf, body: Column, endpoint: Column | str = "e") -> DataFrame:
    """One raw reply per customer."""
    return land(
        spread(table(spark, sf, "customer"), "c_custkey"),
        c("c_custkey"),
        c("c_name"),
        c("c_mktsegment"),
        target_type=F.lit("t"),
        endpoint=F.lit(endpoint) if isinstance(endpoint, str) else endpoint,
        body=body,
    )


CUSTOMER_SRC = (
    "(SELECT *, c_custkey AS cycle_id, c_name AS target, c_mktsegment AS instance, "
    "c_custkey AS k, c_nationkey AS n FROM customer)"
)


def k() -> Column:
    return c("c_custkey")


def n() -> Column:
    return c("c_nationkey")


def listing(count: Column, most: int, item) -> Column:
    """JSON list text of ``item(i)`` for i from 1 to ``count``, at most ``most``."""
    numbers = F.slice(F.sequence(F.lit(1), F.lit(most)), F.lit(1), count.cast("int"))
    return F.concat(F.lit("["), F.array_join(F.transform(numbers, item), ","), F.lit("]"))


# ---- MongoDB


@query(
    "nested_server_status",
    long_sql(
        CUSTOMER_SRC,
        [
            ("db.mongodb.connections.current", "CASE WHEN k % 3 <> 0 THEN k END", "{connections}"),
            ("db.mongodb.connections.available", "k * 2", "{connections}"),
            ("db.mongodb.opcounters.query", "n", "{operations}"),
            ("db.mongodb.opcounters.update", "k % 7 / CAST(4 AS DOUBLE)", "{operations}"),
            ("db.mongodb.memory.resident_mb", "CASE WHEN k % 5 <> 0 THEN n + 1 END", "MiBy"),
            ("db.mongodb.network.bytes_in", "k * 1000000000000", "By"),
            ("db.mongodb.wiredtiger.cache_used_bytes", "k + n", "By"),
        ],
        base_sql("mongodb"),
    ),
)
def nested_server_status(spark, sf):
    quarter = F.element_at(
        F.array(*[F.lit(x) for x in ("0.0", "0.25", "0.5", "0.75", "1.0", "1.25", "1.5")]),
        (k() % 7 + 1).cast("int"),
    )
    body = s(
        '{"connections":{"current":', F.when(k() % 3 == 0, s('"', k(), '"')).otherwise(s(k())),
        ',"available":', k() * 2, '},"opcounters":{"query":', n(), ',"insert":true,"update":', quarter,
        '},"mem":', F.when(k() % 5 == 0, F.lit("null")).otherwise(s('{"resident":', n() + 1, "}")),
        ',"network":{"bytesIn":', k() * 1000000000000, '},"wiredTiger":{"cache":',
        '{"bytes currently in the cache":', k() + n(), "}}}",
    )
    return flat(documents.mongo_server_status(customer_replies(spark, sf, body)))


@query(
    "replset_members",
    long_sql(
        CUSTOMER_SRC,
        [
            (
                "db.mongodb.replication.lag_seconds",
                "CASE WHEN k % 4 <> 0 THEN greatest(0, k % 50 - n) END",
                "s",
            )
        ],
        base_sql("mongodb"),
    ),
)
def replset_members(spark, sf):
    def at(second: Column) -> Column:
        # The forms in which servers and tools write a time.
        text = F.concat(F.lit("2024-01-01T00:00:"), F.lpad(second.cast("string"), 2, "0"))
        millis = F.unix_millis(F.lit("2024-01-01T00:00:00Z").cast("timestamp")) + second * 1000
        return (
            F.when(k() % 5 == 0, s('"', text, '"'))
            .when(k() % 5 == 1, s('"', text, 'Z"'))
            .when(k() % 5 == 2, s('"', text, '.000+00:00"'))
            .when(k() % 5 == 3, s('{"$date":"', text, 'Z"}'))
            .otherwise(s('{"$date":', millis, "}"))
        )

    body = s(
        '{"members":[{"stateStr":"PRIMARY","optimeDate":"2024-01-01T00:00:59"},',
        '{"stateStr":"PRIMARY","optimeDate":', at(k() % 50), '},{"stateStr":"PRIMARY"},',
        '{"stateStr":"SECONDARY","optimeDate":', at(n()), ',"self":',
        F.when(k() % 4 == 0, "false").otherwise("true"), "}]}",
    )
    return flat(documents.mongo_replset(customer_replies(spark, sf, body)))


@query(
    "replica_lag",
    "SELECT o_custkey, CAST(greatest(0, epoch(p) - epoch(o)) AS DOUBLE) AS lag_s FROM "
    "(SELECT o_custkey, arg_max(o_orderdate, o_orderkey) FILTER (WHERE o_orderstatus = 'F') AS p, "
    "arg_max(o_orderdate, o_orderkey) FILTER (WHERE o_orderstatus = 'O') AS o "
    "FROM orders GROUP BY o_custkey) WHERE p IS NOT NULL AND o IS NOT NULL",
)
def replica_lag(spark, sf):
    members = table(spark, sf, "orders").select(
        "o_custkey",
        c("o_orderkey").alias("pos"),
        F.when(c("o_orderstatus") == "F", "PRIMARY").otherwise("SECONDARY").alias("state"),
        (c("o_orderstatus") == "O").alias("is_self"),
        c("o_orderdate").alias("optime"),
    )
    return replica_lag_op(members, ["o_custkey"])


# ---- Cassandra JMX


@query(
    "jolokia_values",
    long_sql(
        f"(SELECT *, k % 7 AS form FROM {CUSTOMER_SRC} WHERE n % 6 <> 0)",
        [
            (
                f"db.cassandra.{name}",
                f"CASE WHEN form = {i} THEN k / CAST({'1000' if i < 2 else '1'} AS DOUBLE) END",
                unit,
            )
            for i, (name, unit) in enumerate(
                [
                    ("read_latency_ms", "ms"),
                    ("write_latency_ms", "ms"),
                    ("compactions_pending", "{compactions}"),
                    ("tombstones_scanned", "{tombstones}"),
                    ("connections.active", "{connections}"),
                    ("storage.total_bytes", "By"),
                    ("storage.live_bytes", "By"),
                ]
            )
        ],
        base_sql("cassandra"),
    ),
)
def jolokia_values(spark, sf):
    endpoints = F.array(*[F.lit(m[0]) for m in exposition.CASSANDRA_JMX])
    value = (
        F.when(n() % 12 == 0, s('"', k(), '"'))
        .when(n() % 12 == 6, F.lit("{}"))
        .otherwise(s(k()))
    )
    body = s('{"request":{},"value":', value, ',"status":200}')
    endpoint = F.element_at(endpoints, (k() % 7 + 1).cast("int"))
    return flat(exposition.cassandra_jmx(customer_replies(spark, sf, body, endpoint)))


# ---- Elasticsearch


@query(
    "health_enum",
    long_sql(
        f"(SELECT * FROM {CUSTOMER_SRC} WHERE n % 5 <> 0)",
        [
            (
                "db.elasticsearch.cluster.status",
                "CASE k % 4 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE -1 END",
                "1",
            ),
            ("db.elasticsearch.cluster.nodes", "n", "{nodes}"),
            ("db.elasticsearch.cluster.shards.active", "k", "{shards}"),
            (
                "db.elasticsearch.cluster.shards.unassigned",
                "CASE WHEN k % 3 = 0 THEN n * 2 ELSE 0 END",
                "{shards}",
            ),
        ],
        base_sql("elasticsearch"),
    ),
)
def health_enum(spark, sf):
    names = F.array(*[F.lit(x) for x in ("green", "yellow", "red", "blue")])
    shards = F.when(n() % 5 == 0, s('"', k(), '"')).otherwise(s(k()))
    body = s(
        '{"cluster_name":"c","status":"', F.element_at(names, (k() % 4 + 1).cast("int")),
        '","number_of_nodes":', n(), ',"active_shards":', shards,
        F.when(k() % 3 == 0, s(',"unassigned_shards":', n() * 2)).otherwise(""), "}",
    )
    return flat(documents.es_cluster_health(customer_replies(spark, sf, body)))


_nodes = (
    "(SELECT cycle_id, target, instance, coalesce(sum(i), 0) AS si, coalesce(sum(i * k), 0) AS sik, "
    "coalesce(sum(i * n), 0) AS sn, coalesce(sum(i % 2), 0) AS odd FROM "
    f"{CUSTOMER_SRC} LEFT JOIN (SELECT unnest([1, 2, 3, 4]) AS i) ON i <= k % 5 "
    "GROUP BY cycle_id, target, instance)"
)


@query(
    "node_stats_sum",
    long_sql(
        _nodes,
        [
            ("db.elasticsearch.jvm.heap_used_bytes", "sik", "By"),
            ("db.elasticsearch.jvm.heap_max_bytes", "sik * 2", "By"),
            ("db.elasticsearch.indices.docs_count", "si", "{documents}"),
            ("db.elasticsearch.indices.store_size_bytes", "0", "By"),
            ("db.elasticsearch.indices.indexing_rate", "sn", "{operations}"),
            ("db.elasticsearch.indices.search_rate", "sn", "{operations}"),
            ("db.elasticsearch.thread_pool.search_rejected", "odd", "{requests}"),
            ("db.elasticsearch.thread_pool.write_rejected", "si", "{requests}"),
            (
                "db.elasticsearch.indices.search_latency_ms",
                "CASE WHEN sn > 0 THEN CAST(sik AS DOUBLE) / CAST(sn AS DOUBLE) END",
                "ms",
            ),
        ],
        base_sql("elasticsearch"),
    ),
)
def node_stats_sum(spark, sf):
    def node(i: Column) -> Column:
        pools = F.when(i % 2 == 1, F.lit('"search":{"rejected":1,"active":2},')).otherwise("")
        return s(
            '"node', i, '":{"jvm":{"mem":{"heap_used_in_bytes":', i * k(),
            ',"heap_max_in_bytes":', i * k() * 2, '}},"indices":{"docs":{"count":', i,
            ',"deleted":9},"indexing":{"index_total":', i * n(), '},"search":{"query_total":', i * n(),
            ',"query_time_in_millis":', i * k(), '}},"thread_pool":{', pools, '"write":{"rejected":', i,
            "}}}",
        )

    some = F.slice(F.sequence(F.lit(1), F.lit(4)), F.lit(1), (k() % 5).cast("int"))
    nodes = F.array_join(F.transform(some, node), ",")
    body = s('{"_nodes":{"total":1},"nodes":{', nodes, "}}")
    return flat(documents.es_node_stats(customer_replies(spark, sf, body)))


@query(
    "weighted_avg",
    "SELECT l_returnflag, l_linestatus, CASE WHEN sum(l_linenumber - 1) > 0 THEN "
    "sum(l_quantity) / CAST(sum(l_linenumber - 1) AS DOUBLE) END AS weighted_avg "
    "FROM lineitem GROUP BY l_returnflag, l_linestatus",
)
def weighted(spark, sf):
    items = table(spark, sf, "lineitem").withColumn("den", c("l_linenumber") - 1)
    return weighted_avg(items, ["l_returnflag", "l_linestatus"], "l_quantity", "den")


# ---- RabbitMQ

OVERVIEW = [
    ("connections", "object_totals", "connections", "k", "{connections}"),
    ("channels", "object_totals", "channels", "k + 1", "{channels}"),
    ("queues.count", "object_totals", "queues", None, "{queues}"),
    ("consumers", "object_totals", "consumers", "n", "{consumers}"),
    ("exchanges", "object_totals", "exchanges", "n * 2", "{exchanges}"),
    ("messages.total", "queue_totals", "messages", "k * 3", "{messages}"),
    ("messages.ready", "queue_totals", "messages_ready", None, "{messages}"),
    ("messages.unacked", "queue_totals", "messages_unacknowledged", "k * 5", "{messages}"),
]


@query(
    "overview_json",
    long_sql(
        CUSTOMER_SRC,
        [(f"messaging.rabbitmq.{m}", e or "0", u) for m, _, _, e, u in OVERVIEW]
        + [
            ("messaging.rabbitmq.publish.rate", "n / CAST(2 AS DOUBLE)", "{messages}/s"),
            ("messaging.rabbitmq.deliver.rate", "0", "{messages}/s"),
            ("messaging.rabbitmq.ack.rate", "n", "{messages}/s"),
            ("messaging.rabbitmq.publish.total", "k * 7", "{messages}"),
            ("messaging.rabbitmq.redeliver.total", "0", "{messages}"),
        ],
        base_sql("rabbitmq", {"messaging.rabbitmq.version": "'3.' || n"}),
    ),
)
def overview_json(spark, sf):
    def part(group: str) -> Column:
        own = [(f, F.expr(e.replace("k", "c_custkey").replace("n", "c_nationkey")))
               for _, g, f, e, _ in OVERVIEW if g == group and e]
        return F.concat_ws(",", *[s(f'"{f}":', e) for f, e in own])

    half = F.concat(F.floor(n() / 2).cast("string"), F.when(n() % 2 == 1, ".5").otherwise(".0"))
    body = s(
        '{"object_totals":{', part("object_totals"), '},"queue_totals":{', part("queue_totals"),
        '},"message_stats":{"publish":', k() * 7, ',"publish_details":{"rate":', half,
        '},"ack_details":{"rate":', n(), '}},"rabbitmq_version":"3.', n(), '","extra":[1]}',
    )
    return flat(documents.rabbit_overview(customer_replies(spark, sf, body)))


def supplier_replies(spark, sf, body: Column) -> DataFrame:
    return land(
        spread(table(spark, sf, "supplier"), "s_suppkey"),
        c("s_suppkey"),
        c("s_name"),
        s("s", c("s_nationkey")),
        target_type=F.lit("t"),
        endpoint=F.lit("e"),
        body=body,
    )


_supplier_queues = (
    "(SELECT s_suppkey AS cycle_id, s_name AS target, 's' || s_nationkey AS instance, i, "
    "s_suppkey * 1000 + i AS v FROM supplier, generate_series(1, 150) AS g(i) "
    "WHERE i <= s_suppkey % 151)"
)


@query(
    "array_cap",
    long_sql(
        _supplier_queues,
        [
            ("messaging.rabbitmq.queue.messages", "v", "{messages}"),
            ("messaging.rabbitmq.queue.ready", "v - i", "{messages}"),
            ("messaging.rabbitmq.queue.unacked", "i", "{messages}"),
            ("messaging.rabbitmq.queue.consumers", "0", "{consumers}"),
            ("messaging.rabbitmq.queue.memory", "v * 4096", "By"),
            ("messaging.rabbitmq.queue.publish_rate", "i", "{messages}/s"),
            ("messaging.rabbitmq.queue.deliver_rate", "0", "{messages}/s"),
        ],
        base_sql(
            "rabbitmq",
            {
                "messaging.destination.name": "'q' || i",
                "messaging.rabbitmq.vhost": "'/v' || (i % 3)",
                "messaging.rabbitmq.queue.state": "CASE WHEN i % 2 = 0 THEN 'running' END",
            },
        ),
    ),
)
def array_cap(spark, sf):
    key = c("s_suppkey")

    def item(i: Column) -> Column:
        v = key * 1000 + i
        return s(
            '{"name":"q', i, '","vhost":"/v', i % 3, '","messages":', v, ',"messages_ready":', v - i,
            ',"messages_unacknowledged":', i, ',"memory":', v * 4096,
            ',"message_stats":{"publish_details":{"rate":', i, "}}",
            F.when(i % 2 == 0, F.lit(',"state":"running"}')).otherwise("}"),
        )

    return flat(
        documents.rabbit_queues(supplier_replies(spark, sf, listing(key % 151, 150, item)))
    )


@query(
    "bool_node",
    long_sql(
        f"(SELECT * FROM {CUSTOMER_SRC}, generate_series(1, 2) AS g(i) WHERE i <= k % 3)",
        [
            ("messaging.rabbitmq.node.running", "CASE WHEN n % 2 = 0 THEN 1 ELSE 0 END", "1"),
            ("messaging.rabbitmq.node.memory_used", "k * i", "By"),
            ("messaging.rabbitmq.node.memory_limit", "k * 10", "By"),
            ("messaging.rabbitmq.node.memory_alarm", "CASE WHEN i = 2 THEN 1 ELSE 0 END", "1"),
            ("messaging.rabbitmq.node.disk_free", "n", "By"),
            ("messaging.rabbitmq.node.disk_alarm", "0", "1"),
            ("messaging.rabbitmq.node.fd_used", "i", "{descriptors}"),
            ("messaging.rabbitmq.node.fd_total", "1024", "{descriptors}"),
            ("messaging.rabbitmq.node.sockets_used", "0", "{sockets}"),
            ("messaging.rabbitmq.node.sockets_total", "0", "{sockets}"),
            ("messaging.rabbitmq.node.uptime_ms", "k * 1000", "ms"),
        ],
        base_sql("rabbitmq", {"messaging.rabbitmq.node": "'rabbit@' || i"}),
    ),
)
def bool_node(spark, sf):
    def flag(on: Column) -> Column:
        return F.when(on, "true").otherwise("false")

    def item(i: Column) -> Column:
        return s(
            '{"name":"rabbit@', i, '","running":', flag(n() % 2 == 0), ',"mem_used":', k() * i,
            ',"mem_limit":', k() * 10, ',"mem_alarm":', flag(i == 2), ',"disk_free":', n(),
            ',"fd_used":', i, ',"fd_total":1024,"sockets_used":null,"uptime":', k() * 1000, "}",
        )

    return flat(documents.rabbit_nodes(customer_replies(spark, sf, listing(k() % 3, 2, item))))


# ---- NATS

VARZ = [
    ("connections.current", "connections", "k", "{connections}"),
    ("connections.total", "total_connections", "k * 9", "{connections}"),
    ("routes", "routes", None, "{routes}"),
    ("remotes", "remotes", "n", "{remotes}"),
    ("messages.in", "in_msgs", "k * 1000000007", "{messages}"),
    ("messages.out", "out_msgs", "k + n", "{messages}"),
    ("bytes.in", "in_bytes", None, "By"),
    ("bytes.out", "out_bytes", "n * 4096", "By"),
    ("slow_consumers", "slow_consumers", "n % 2", "{consumers}"),
    ("subscriptions", "subscriptions", "k % 17", "{subscriptions}"),
    ("memory", "mem", "k * 1024", "By"),
    ("cpu", "cpu", "n % 100", "%"),
]


def _with_names(e: str) -> Column:
    return F.expr(e.replace("k", "c_custkey").replace("n", "c_nationkey"))


@query(
    "varz_json",
    long_sql(
        CUSTOMER_SRC,
        [(f"messaging.nats.{m}", e or "0", u) for m, _, e, u in VARZ],
        base_sql(
            "nats", {"messaging.nats.version": "'2.' || n", "messaging.nats.server_id": "'S' || k"}
        ),
    ),
)
def varz_json(spark, sf):
    fields = F.concat_ws(",", *[s(f'"{f}":', _with_names(e)) for _, f, e, _ in VARZ if e])
    body = s('{"server_id":"S', k(), '","version":"2.', n(), '","uptime":"1d",', fields, "}")
    return flat(documents.nats_varz(customer_replies(spark, sf, body)))


@query(
    "nested_streams",
    long_sql(
        CUSTOMER_SRC,
        [
            ("messaging.nats.jetstream.memory", "k", "By"),
            ("messaging.nats.jetstream.storage", "0", "By"),
            ("messaging.nats.jetstream.streams", "k % 3 * 2", "{streams}"),
            ("messaging.nats.jetstream.consumers", "n", "{consumers}"),
            ("messaging.nats.jetstream.messages", "k * 5", "{messages}"),
            ("messaging.nats.jetstream.bytes", "k * 50", "By"),
        ],
        base_sql("nats"),
    )
    + " UNION ALL "
    + long_sql(
        f"(SELECT *, k * 100 + a * 10 + i AS v FROM {CUSTOMER_SRC}, generate_series(1, 2) AS g(a), "
        "generate_series(1, 2) AS h(i) WHERE i <= k % 3)",
        [
            ("messaging.nats.jetstream.stream.messages", "v", "{messages}"),
            ("messaging.nats.jetstream.stream.bytes", "v * 2", "By"),
            ("messaging.nats.jetstream.stream.consumers", "i", "{consumers}"),
            ("messaging.nats.jetstream.stream.last_seq", "v * 3", "{sequence}"),
        ],
        base_sql(
            "nats",
            {
                "messaging.nats.jetstream.stream": "'s' || i",
                "messaging.nats.jetstream.account": "'acc' || a",
            },
        ),
    ),
)
def nested_streams(spark, sf):
    def account(a: Column) -> Column:
        def stream(i: Column) -> Column:
            v = k() * 100 + a * 10 + i
            # The first account keeps the sizes beside the state, the second inside it.
            beside = F.when(a == 1, s(',"messages":', v, ',"bytes":', v * 2)).otherwise("")
            inside = F.when(a == 2, s(',"messages":', v, ',"bytes":', v * 2)).otherwise("")
            return s(
                '{"name":"s', i, '","consumer_count":', i, beside, ',"state":{"last_seq":', v * 3,
                inside, "}}",
            )

        return s('{"name":"acc', a, '","stream_detail":', listing(k() % 3, 2, stream), "}")

    body = s(
        '{"memory":', k(), ',"streams":', k() % 3 * 2, ',"consumers":', n(), ',"messages":', k() * 5,
        ',"bytes":', k() * 50, ',"account_details":', listing(F.lit(2), 2, account), "}",
    )
    return flat(documents.nats_jetstream(customer_replies(spark, sf, body)))


# ---- ActiveMQ

VARIANT = "messaging.activemq.variant"


@query(
    "activemq_brokers",
    long_sql(
        CUSTOMER_SRC,
        [
            ("messaging.activemq.connections", "k", "{connections}"),
            ("messaging.activemq.consumers", "CASE WHEN n % 3 <> 0 THEN n END", "{consumers}"),
            ("messaging.activemq.memory_percent", "k % 100", "%"),
        ],
        base_sql("activemq", {VARIANT: "'classic'"}),
    )
    + " UNION ALL "
    + long_sql(
        CUSTOMER_SRC,
        [
            ("messaging.activemq.connections.total", "k", "{connections}"),
            ("messaging.activemq.consumers", "CASE WHEN n % 3 <> 0 THEN n END", "{consumers}"),
            ("messaging.activemq.global_max_size", "k * 1024", "By"),
        ],
        base_sql("activemq", {VARIANT: "'artemis'"}),
    ),
)
def activemq_brokers(spark, sf):
    consumers = F.when(n() % 3 == 0, s('"', n(), '"')).otherwise(s(n()))
    classic = s(
        '"TotalConnectionsCount":', k(), ',"TotalConsumerCount":', consumers,
        ',"MemoryPercentUsage":', k() % 100, ',"BrokerName":"b"',
    )
    artemis = s(
        '"TotalConnectionCount":', k(), ',"TotalConsumerCount":', consumers,
        ',"GlobalMaxSize":', k() * 1024,
    )

    def reply(fields: Column) -> Column:
        # Every other broker answers with one object per matching name.
        nested = s('{"value":{"o:brokerName=b":{', fields, "}}}")
        return F.when(k() % 2 == 0, nested).otherwise(s('{"value":{', fields, "}}"))

    return flat(
        activemq.classic_broker(customer_replies(spark, sf, reply(classic))).unionByName(
            activemq.artemis_broker(customer_replies(spark, sf, reply(artemis)))
        )
    )


@query(
    "jmx_params",
    long_sql(
        f"(SELECT *, 'q' || i AS q FROM {CUSTOMER_SRC}, generate_series(1, 3) AS g(i))",
        [
            ("messaging.activemq.queue.size", "k * i", "{messages}"),
            ("messaging.activemq.queue.enqueue", "CASE WHEN i <> 2 THEN n END", "{messages}"),
        ],
        base_sql("activemq", {VARIANT: "'classic'", "messaging.destination.name": "q"}),
    )
    + " UNION ALL "
    + long_sql(
        f"(SELECT *, 'a' || i AS q FROM {CUSTOMER_SRC}, generate_series(1, 3) AS g(i))",
        [
            ("messaging.activemq.queue.size", "k * i", "{messages}"),
            ("messaging.activemq.queue.delivering", "n", "{messages}"),
        ],
        base_sql("activemq", {VARIANT: "'artemis'", "messaging.destination.name": "q"}),
    ),
)
def jmx_params(spark, sf):
    def classic(i: Column) -> Column:
        return s(
            '"org.apache.activemq:type=Broker,destinationType=Queue, destinationName =q', i,
            '":{"QueueSize":', k() * i, ',"EnqueueCount":', F.when(i == 2, s('"', n(), '"')).otherwise(s(n())),
            "}",
        )

    def artemis(i: Column) -> Column:
        return s(
            '"o:broker=\\"b\\",component=addresses,queue=\\"a', i, '\\"":{"MessageCount":', k() * i,
            ',"DeliveringCount":', n(), ',"Name":"x"}',
        )

    def reply(item) -> Column:
        each = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(3)), item), ",")
        return s('{"value":{"o:type=Broker":{"QueueSize":1},"note":5,', each, "}}")

    return flat(
        activemq.classic_queues(customer_replies(spark, sf, reply(classic))).unionByName(
            activemq.artemis_queues(customer_replies(spark, sf, reply(artemis)))
        )
    )


# ---- IBM MQ


@query(
    "qmgr_json",
    long_sql(
        f"(SELECT *, CASE WHEN (k + i) % 3 = 0 THEN 'ended' ELSE 'running' END AS st "
        f"FROM {CUSTOMER_SRC}, generate_series(1, 2) AS g(i))",
        [
            ("messaging.ibmmq.qmgr.running", "CASE WHEN st = 'running' THEN 1 ELSE 0 END", "1"),
            (
                "messaging.ibmmq.qmgr.connections",
                "CASE WHEN n % 2 = 0 THEN k * i ELSE 0 END",
                "{connections}",
            ),
        ],
        base_sql(
            "ibmmq",
            {"messaging.ibmmq.qmgr": "'QM' || i", "messaging.ibmmq.qmgr.state": "st"},
        ),
    ),
)
def qmgr_json(spark, sf):
    def item(i: Column) -> Column:
        status = F.when(n() % 2 == 0, s(',"status":{"connectionCount":', k() * i, "}")).otherwise("")
        state = F.when((k() + i) % 3 == 0, "ended").otherwise("running")
        return s('{"name":"QM', i, '","state":"', state, '"', status, "}")

    body = s('{"queueManager":', listing(F.lit(2), 2, item), "}")
    return flat(documents.ibmmq_qmgr(customer_replies(spark, sf, body)))


@query(
    "mq_queues",
    long_sql(
        _supplier_queues,
        [
            ("messaging.ibmmq.queue.depth", "v", "{messages}"),
            ("messaging.ibmmq.queue.open_input", "i", "{handles}"),
            ("messaging.ibmmq.queue.open_output", "0", "{handles}"),
            ("messaging.ibmmq.queue.uncommitted", "i % 5", "{messages}"),
            ("messaging.ibmmq.queue.oldest_msg_age", "v % 60", "s"),
        ],
        base_sql(
            "ibmmq",
            {"messaging.destination.name": "'Q' || i", "messaging.ibmmq.queue.type": "'local'"},
        ),
    )
    + " UNION ALL "
    + long_sql(
        "(SELECT s_suppkey AS cycle_id, s_name AS target, 's' || s_nationkey AS instance, "
        "s_suppkey % 151 AS total, s_suppkey % 151 AS m, s_suppkey AS k FROM supplier)",
        [
            ("messaging.ibmmq.queues.count", "total", "{queues}"),
            ("messaging.ibmmq.queues.total_depth", "k * 1000 * m + m * (m + 1) // 2", "{messages}"),
        ],
        base_sql("ibmmq"),
    ),
)
def mq_queues(spark, sf):
    key = c("s_suppkey")

    def item(i: Column) -> Column:
        v = key * 1000 + i
        return s(
            '{"name":"Q', i, '","type":"local","status":{"currentDepth":', v, ',"openInputCount":', i,
            ',"uncommittedMessages":', i % 5, ',"oldestMessageAge":', v % 60, "}}",
        )

    body = s('{"queue":', listing(key % 151, 150, item), "}")
    return flat(documents.ibmmq_queues(supplier_replies(spark, sf, body)))


_channels = (
    f"(SELECT *, CASE WHEN (k + i) % 3 = 0 THEN 'STOPPED' ELSE 'RUNNING' END AS st "
    f"FROM {CUSTOMER_SRC}, generate_series(1, 4) AS g(i) WHERE i <= k % 5)"
)


@query(
    "mq_channels",
    long_sql(
        _channels,
        [
            ("messaging.ibmmq.channel.messages", "k * i", "{messages}"),
            ("messaging.ibmmq.channel.bytes_sent", "k * 1024", "By"),
            ("messaging.ibmmq.channel.bytes_received", "0", "By"),
        ],
        base_sql(
            "ibmmq",
            {
                "messaging.ibmmq.channel": "'CH' || i",
                "messaging.ibmmq.channel.type": "'svrconn'",
                "messaging.ibmmq.channel.state": "st",
            },
        ),
    )
    + " UNION ALL "
    + long_sql(
        CUSTOMER_SRC,
        [("messaging.ibmmq.channels.count", "k % 5", "{channels}")],
        base_sql("ibmmq"),
    )
    + " UNION ALL "
    + long_sql(
        f"(SELECT cycle_id, target, instance, st, count(*) AS cnt FROM {_channels} GROUP BY ALL)",
        [("messaging.ibmmq.channels.by_state", "cnt", "{channels}")],
        base_sql("ibmmq", {"messaging.ibmmq.channel.state": "st"}),
    ),
)
def mq_channels(spark, sf):
    def item(i: Column) -> Column:
        state = F.when((k() + i) % 3 == 0, "STOPPED").otherwise("RUNNING")
        return s(
            '{"name":"CH', i, '","type":"svrconn","status":{"state":"', state, '","msgs":', k() * i,
            ',"bytesSent":', k() * 1024, "}}",
        )

    body = s('{"channel":', listing(k() % 5, 4, item), "}")
    return flat(documents.ibmmq_channels(customer_replies(spark, sf, body)))


# ---- JSON number gate


@query(
    "json_numbers",
    "SELECT o_orderkey, CAST(CASE o_orderkey % 5 WHEN 0 THEN o_custkey "
    "WHEN 1 THEN o_custkey + CAST(0.5 AS DOUBLE) END AS DOUBLE) AS num FROM orders",
)
def json_numbers(spark, sf):
    key, cust = c("o_orderkey"), c("o_custkey")
    text = (
        F.when(key % 5 == 0, s(cust))
        .when(key % 5 == 1, s(cust, ".5"))
        .when(key % 5 == 2, s('"', cust, '"'))
        .when(key % 5 == 3, F.lit("true"))
        .otherwise("[1]")
    )
    return spread(table(spark, sf, "orders"), "o_orderkey").select(
        "o_orderkey", num_json(F.parse_json(text)).alias("num")
    )
