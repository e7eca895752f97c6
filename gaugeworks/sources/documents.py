"""Jobs over JSON replies: MongoDB, Elasticsearch, RabbitMQ, NATS, IBM MQ.

Each reply is read once with a fixed schema, so Spark parses only the listed fields.
A reply that does not fit the schema gives no rows, like one that is no JSON at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gaugeworks.functions.attrs import base_attrs
from gaugeworks.functions.numbers import bool01, enum_code, lag_seconds, num_json, ratio, zero
from gaugeworks.functions.records import record
from gaugeworks.operators.aggregate import count_states, sum_nested
from gaugeworks.operators.shape import once, to_metric_groups, to_metrics

BAD = "_corrupt_record string"
# Spark trims the schema of a call without options to the fields in use, and would then
# overlook a misfit in the others.
KEEP_FIELDS = {"mode": "PERMISSIVE"}


def _first() -> Column:
    # The one row of an exploded reply that also carries what belongs to the whole reply.
    return F.coalesce(F.col("pos"), F.lit(0)) == 0


def read_json(df: DataFrame, fields: str, body: str = "body") -> DataFrame:
    """Parse the body with a fixed schema into column ``j``; unfit replies drop out."""
    parsed = once(df, "j", F.from_json(F.col(body), f"{fields}, {BAD}", KEEP_FIELDS))
    return parsed.where("j is not null and j._corrupt_record is null")


def read_json_list(df: DataFrame, element: str) -> DataFrame:
    """Parse a body that is a JSON list into column ``items``."""
    wrapped = df.withColumn("__body", F.concat(F.lit('{"items":'), "body", F.lit("}")))
    parsed = read_json(wrapped, f"items array<struct<{element}>>", "__body")
    return parsed.withColumn("items", F.coalesce("j.items", F.array().cast(
        f"array<struct<{element}>>"))).drop("j", "__body")


def _zeros(entries: list[tuple[str, str, str]]) -> list[tuple[str, Column, str]]:
    return [(name, zero(F.col(path)), unit) for name, path, unit in entries]


# ---- MongoDB

# Path in the server status document, metric name, unit.
MONGO_STATUS = [
    ("$.connections.current", "db.mongodb.connections.current", "{connections}"),
    ("$.connections.available", "db.mongodb.connections.available", "{connections}"),
    ("$.opcounters.query", "db.mongodb.opcounters.query", "{operations}"),
    ("$.opcounters.insert", "db.mongodb.opcounters.insert", "{operations}"),
    ("$.opcounters.update", "db.mongodb.opcounters.update", "{operations}"),
    ("$.opcounters.delete", "db.mongodb.opcounters.delete", "{operations}"),
    ("$.mem.resident", "db.mongodb.memory.resident_mb", "MiBy"),
    ("$.mem.virtual", "db.mongodb.memory.virtual_mb", "MiBy"),
    ("$.network.bytesIn", "db.mongodb.network.bytes_in", "By"),
    ("$.network.bytesOut", "db.mongodb.network.bytes_out", "By"),
    (
        "$.wiredTiger.cache['bytes currently in the cache']",
        "db.mongodb.wiredtiger.cache_used_bytes",
        "By",
    ),
    (
        "$.wiredTiger.cache['tracked dirty bytes in the cache']",
        "db.mongodb.wiredtiger.cache_dirty_bytes",
        "By",
    ),
]


def mongo_server_status(df: DataFrame) -> DataFrame:
    """Status numbers; a field that is absent or no number gives no row."""
    doc = df.withColumn("doc", F.try_parse_json("body"))
    specs = [
        (name, num_json(F.try_variant_get("doc", path, "variant")), unit)
        for path, name, unit in MONGO_STATUS
    ]
    return to_metrics(doc, specs, base_attrs("mongodb"))


def _mongo_times(members: Column) -> Column:
    """Members with ``optime``, a time in UTC: text with or without a zone, ``{"$date": text}``, or
    ``{"$date": milliseconds}`` (plain or as ``$numberLong``). Steps, so each text is read once."""
    opened = F.transform(
        members,
        lambda m: record(
            stateStr=m["stateStr"], self=m["self"], text=m["optimeDate"],
            inner=F.when(m["optimeDate"].startswith("{"), F.get_json_object(m["optimeDate"], "$.$date")),
        ),
    )
    numbered = F.transform(
        opened,
        lambda m: record(
            stateStr=m["stateStr"], self=m["self"],
            written=F.coalesce(m["inner"], m["text"]),
            millis=F.when(m["inner"].startswith("{"), F.get_json_object(m["inner"], "$.$numberLong"))
            .otherwise(m["inner"]).try_cast("bigint"),
        ),
    )

    def read(written: Column) -> Column:
        zoned = written.rlike(r"(Z|[+-]\d{2}:?\d{2})$")
        return F.when(zoned, written).otherwise(F.concat(written, F.lit("Z"))).try_cast("timestamp")

    # Both are instants; the lag is their difference, so the session's zone does not matter.
    return F.transform(
        numbered,
        lambda m: record(
            stateStr=m["stateStr"], self=m["self"],
            optime=F.when(m["millis"].isNotNull(), F.timestamp_millis(m["millis"])).otherwise(read(m["written"])),
        ),
    )


def mongo_replset(df: DataFrame) -> DataFrame:
    """Seconds the own member trails the primary, when both are known."""
    fields = "members array<struct<stateStr: string, self: boolean, optimeDate: string>>"
    parsed = once(df, "j", F.from_json(F.col("body"), fields))
    timed = once(parsed, "m", F.filter(_mongo_times(F.col("j.members")), lambda m: m["optime"].isNotNull()))

    def last_optime(kept: Column) -> Column:
        return F.try_element_at(kept, F.lit(-1))["optime"]

    primary = last_optime(F.filter("m", lambda m: m["stateStr"] == "PRIMARY"))
    own = last_optime(F.filter("m", lambda m: m["self"]))
    lag = F.when(primary.isNotNull() & own.isNotNull(), lag_seconds(primary, own))
    return to_metrics(
        timed, [("db.mongodb.replication.lag_seconds", lag, "s")], base_attrs("mongodb")
    )


# ---- Elasticsearch

# Cluster status codes.
HEALTH_CODES = {"green": 0, "yellow": 1, "red": 2}
HEALTH_UNKNOWN = -1


def es_cluster_health(df: DataFrame) -> DataFrame:
    parsed = read_json(
        df,
        "status string, number_of_nodes double, active_shards double, unassigned_shards double",
    )
    status = enum_code(F.col("j.status"), HEALTH_CODES, HEALTH_UNKNOWN)
    specs = [
        ("db.elasticsearch.cluster.status", status, "1"),
        ("db.elasticsearch.cluster.nodes", zero(F.col("j.number_of_nodes")), "{nodes}"),
        ("db.elasticsearch.cluster.shards.active", zero(F.col("j.active_shards")), "{shards}"),
        (
            "db.elasticsearch.cluster.shards.unassigned",
            zero(F.col("j.unassigned_shards")),
            "{shards}",
        ),
    ]
    return to_metrics(parsed, specs, base_attrs("elasticsearch"))


NODE_FIELDS = (
    "nodes map<string, struct<"
    "jvm: struct<mem: struct<heap_used_in_bytes: double, heap_max_in_bytes: double>>, "
    "indices: struct<docs: struct<count: double>, store: struct<size_in_bytes: double>, "
    "indexing: struct<index_total: double>, "
    "search: struct<query_total: double, query_time_in_millis: double>>, "
    "thread_pool: map<string, struct<rejected: double>>>>"
)


def es_node_stats(df: DataFrame) -> DataFrame:
    """Sums over the nodes of a cluster and the mean search latency, inside the row."""
    # Metric name, reading of one node, unit.
    readings = {
        "heap_used": lambda n: n["jvm"]["mem"]["heap_used_in_bytes"],
        "heap_max": lambda n: n["jvm"]["mem"]["heap_max_in_bytes"],
        "docs": lambda n: n["indices"]["docs"]["count"],
        "store": lambda n: n["indices"]["store"]["size_in_bytes"],
        "indexed": lambda n: n["indices"]["indexing"]["index_total"],
        "searches": lambda n: n["indices"]["search"]["query_total"],
        "search_ms": lambda n: n["indices"]["search"]["query_time_in_millis"],
        "search_rejected": lambda n: F.try_element_at(n["thread_pool"], F.lit("search"))["rejected"],
        "write_rejected": lambda n: F.try_element_at(n["thread_pool"], F.lit("write"))["rejected"],
    }
    none = F.array().cast("array<" + NODE_FIELDS.split("map<string, ", 1)[1])
    nodes = F.coalesce(F.map_values("j.nodes"), none)
    summed = read_json(df, NODE_FIELDS).withColumn(
        "s", sum_nested(nodes, list(readings), lambda n, f: readings[f](n))
    )
    s = {name: F.col(f"s.{name}") for name in readings}
    specs = [
        ("db.elasticsearch.jvm.heap_used_bytes", s["heap_used"], "By"),
        ("db.elasticsearch.jvm.heap_max_bytes", s["heap_max"], "By"),
        ("db.elasticsearch.indices.docs_count", s["docs"], "{documents}"),
        ("db.elasticsearch.indices.store_size_bytes", s["store"], "By"),
        ("db.elasticsearch.indices.indexing_rate", s["indexed"], "{operations}"),
        ("db.elasticsearch.indices.search_rate", s["searches"], "{operations}"),
        ("db.elasticsearch.thread_pool.search_rejected", s["search_rejected"], "{requests}"),
        ("db.elasticsearch.thread_pool.write_rejected", s["write_rejected"], "{requests}"),
        ("db.elasticsearch.indices.search_latency_ms", ratio(s["search_ms"], s["searches"]), "ms"),
    ]
    return to_metrics(summed, specs, base_attrs("elasticsearch"))


# ---- RabbitMQ

RATES = "publish_details: struct<rate: double>, deliver_get_details: struct<rate: double>"


def rabbit_overview(df: DataFrame) -> DataFrame:
    parsed = read_json(
        df,
        f"message_stats struct<{RATES}, ack_details: struct<rate: double>, publish: bigint, "
        "deliver_get: bigint, ack: bigint, redeliver: bigint>, "
        "queue_totals struct<messages: bigint, messages_ready: bigint, "
        "messages_unacknowledged: bigint>, "
        "object_totals struct<connections: bigint, channels: bigint, queues: bigint, "
        "consumers: bigint, exchanges: bigint>, rabbitmq_version string",
    )
    # Metric name, path, unit.
    specs = _zeros(
        [
            ("messaging.rabbitmq.connections", "j.object_totals.connections", "{connections}"),
            ("messaging.rabbitmq.channels", "j.object_totals.channels", "{channels}"),
            ("messaging.rabbitmq.queues.count", "j.object_totals.queues", "{queues}"),
            ("messaging.rabbitmq.consumers", "j.object_totals.consumers", "{consumers}"),
            ("messaging.rabbitmq.exchanges", "j.object_totals.exchanges", "{exchanges}"),
            ("messaging.rabbitmq.messages.total", "j.queue_totals.messages", "{messages}"),
            ("messaging.rabbitmq.messages.ready", "j.queue_totals.messages_ready", "{messages}"),
            (
                "messaging.rabbitmq.messages.unacked",
                "j.queue_totals.messages_unacknowledged",
                "{messages}",
            ),
            (
                "messaging.rabbitmq.publish.rate",
                "j.message_stats.publish_details.rate",
                "{messages}/s",
            ),
            (
                "messaging.rabbitmq.deliver.rate",
                "j.message_stats.deliver_get_details.rate",
                "{messages}/s",
            ),
            ("messaging.rabbitmq.ack.rate", "j.message_stats.ack_details.rate", "{messages}/s"),
            ("messaging.rabbitmq.publish.total", "j.message_stats.publish", "{messages}"),
            ("messaging.rabbitmq.redeliver.total", "j.message_stats.redeliver", "{messages}"),
        ]
    )
    attrs = base_attrs("rabbitmq", {"messaging.rabbitmq.version": F.col("j.rabbitmq_version")})
    return to_metrics(parsed, specs, attrs)


def rabbit_queues(df: DataFrame) -> DataFrame:
    """The queues of a listing, in listing order."""
    parsed = read_json_list(
        df,
        "name: string, vhost: string, messages: bigint, messages_ready: bigint, "
        "messages_unacknowledged: bigint, consumers: bigint, memory: bigint, "
        f"message_stats: struct<{RATES}>, state: string",
    )
    listed = parsed.withColumn("q", F.explode("items"))
    specs = _zeros(
        [
            ("messaging.rabbitmq.queue.messages", "q.messages", "{messages}"),
            ("messaging.rabbitmq.queue.ready", "q.messages_ready", "{messages}"),
            ("messaging.rabbitmq.queue.unacked", "q.messages_unacknowledged", "{messages}"),
            ("messaging.rabbitmq.queue.consumers", "q.consumers", "{consumers}"),
            ("messaging.rabbitmq.queue.memory", "q.memory", "By"),
            (
                "messaging.rabbitmq.queue.publish_rate",
                "q.message_stats.publish_details.rate",
                "{messages}/s",
            ),
            (
                "messaging.rabbitmq.queue.deliver_rate",
                "q.message_stats.deliver_get_details.rate",
                "{messages}/s",
            ),
        ]
    )
    attrs = base_attrs(
        "rabbitmq",
        {
            "messaging.destination.name": F.col("q.name"),
            "messaging.rabbitmq.vhost": F.col("q.vhost"),
            "messaging.rabbitmq.queue.state": F.col("q.state"),
        },
    )
    return to_metrics(listed, specs, attrs)


def rabbit_nodes(df: DataFrame) -> DataFrame:
    """Node gauges, flags as 0 or 1."""
    parsed = read_json_list(
        df,
        "name: string, running: boolean, mem_used: bigint, mem_limit: bigint, "
        "mem_alarm: boolean, disk_free: bigint, disk_free_alarm: boolean, fd_used: bigint, "
        "fd_total: bigint, sockets_used: bigint, sockets_total: bigint, uptime: bigint",
    )
    specs = [
        ("messaging.rabbitmq.node.running", bool01(F.col("q.running")), "1"),
        ("messaging.rabbitmq.node.memory_used", zero(F.col("q.mem_used")), "By"),
        ("messaging.rabbitmq.node.memory_limit", zero(F.col("q.mem_limit")), "By"),
        ("messaging.rabbitmq.node.memory_alarm", bool01(F.col("q.mem_alarm")), "1"),
        ("messaging.rabbitmq.node.disk_free", zero(F.col("q.disk_free")), "By"),
        ("messaging.rabbitmq.node.disk_alarm", bool01(F.col("q.disk_free_alarm")), "1"),
        ("messaging.rabbitmq.node.fd_used", zero(F.col("q.fd_used")), "{descriptors}"),
        ("messaging.rabbitmq.node.fd_total", zero(F.col("q.fd_total")), "{descriptors}"),
        ("messaging.rabbitmq.node.sockets_used", zero(F.col("q.sockets_used")), "{sockets}"),
        ("messaging.rabbitmq.node.sockets_total", zero(F.col("q.sockets_total")), "{sockets}"),
        ("messaging.rabbitmq.node.uptime_ms", zero(F.col("q.uptime")), "ms"),
    ]
    attrs = base_attrs("rabbitmq", {"messaging.rabbitmq.node": F.col("q.name")})
    return to_metrics(parsed.withColumn("q", F.explode("items")), specs, attrs)


# ---- NATS


def nats_varz(df: DataFrame) -> DataFrame:
    parsed = read_json(
        df,
        "server_id string, version string, connections bigint, total_connections bigint, "
        "routes bigint, remotes bigint, in_msgs bigint, out_msgs bigint, in_bytes bigint, "
        "out_bytes bigint, slow_consumers bigint, subscriptions bigint, mem bigint, cpu double",
    )
    specs = _zeros(
        [
            ("messaging.nats.connections.current", "j.connections", "{connections}"),
            ("messaging.nats.connections.total", "j.total_connections", "{connections}"),
            ("messaging.nats.routes", "j.routes", "{routes}"),
            ("messaging.nats.remotes", "j.remotes", "{remotes}"),
            ("messaging.nats.messages.in", "j.in_msgs", "{messages}"),
            ("messaging.nats.messages.out", "j.out_msgs", "{messages}"),
            ("messaging.nats.bytes.in", "j.in_bytes", "By"),
            ("messaging.nats.bytes.out", "j.out_bytes", "By"),
            ("messaging.nats.slow_consumers", "j.slow_consumers", "{consumers}"),
            ("messaging.nats.subscriptions", "j.subscriptions", "{subscriptions}"),
            ("messaging.nats.memory", "j.mem", "By"),
            ("messaging.nats.cpu", "j.cpu", "%"),
        ]
    )
    attrs = base_attrs(
        "nats",
        {
            "messaging.nats.version": F.col("j.version"),
            "messaging.nats.server_id": F.col("j.server_id"),
        },
    )
    return to_metrics(parsed, specs, attrs)


JSZ_FIELDS = (
    "memory bigint, storage bigint, streams int, consumers int, messages bigint, bytes bigint, "
    "account_details array<struct<name: string, stream_detail: array<struct<name: string, "
    "messages: decimal(20,0), bytes: decimal(20,0), consumer_count: int, "
    "state: struct<last_seq: decimal(20,0), messages: decimal(20,0), bytes: decimal(20,0)>>>>>"
)


def nats_jetstream(df: DataFrame) -> DataFrame:
    """Totals, and stream rows; stream sizes may stand beside the stream state or inside it."""
    accounts = F.filter("j.account_details", lambda a: a["stream_detail"].isNotNull())
    streams = F.flatten(
        F.transform(
            accounts,
            lambda a: F.transform(a["stream_detail"], lambda s: record(account=a["name"], s=s)),
        )
    )
    parsed = read_json(df, JSZ_FIELDS)
    each = parsed.select("*", F.posexplode_outer(streams).alias("pos", "q"))
    either = {f: F.coalesce(f"q.s.{f}", f"q.s.state.{f}") for f in ("messages", "bytes")}
    totals = _zeros(
        [
            ("messaging.nats.jetstream.memory", "j.memory", "By"),
            ("messaging.nats.jetstream.storage", "j.storage", "By"),
            ("messaging.nats.jetstream.streams", "j.streams", "{streams}"),
            ("messaging.nats.jetstream.consumers", "j.consumers", "{consumers}"),
            ("messaging.nats.jetstream.messages", "j.messages", "{messages}"),
            ("messaging.nats.jetstream.bytes", "j.bytes", "By"),
        ]
    )
    base = "messaging.nats.jetstream.stream."
    specs = [
        (base + "messages", zero(either["messages"]), "{messages}"),
        (base + "bytes", zero(either["bytes"]), "By"),
        (base + "consumers", zero(F.col("q.s.consumer_count")), "{consumers}"),
        (base + "last_seq", zero(F.col("q.s.state.last_seq")), "{sequence}"),
    ]
    attrs = base_attrs(
        "nats",
        {
            "messaging.nats.jetstream.stream": F.col("q.s.name"),
            "messaging.nats.jetstream.account": F.col("q.account"),
        },
    )
    return to_metric_groups(
        each, [(F.col("q").isNotNull(), specs, attrs), (_first(), totals, base_attrs("nats"))]
    )


# ---- IBM MQ


def ibmmq_qmgr(df: DataFrame) -> DataFrame:
    parsed = read_json(
        df,
        "queueManager array<struct<name: string, state: string, "
        "status: struct<connectionCount: bigint>>>",
    )
    specs = [
        ("messaging.ibmmq.qmgr.running", bool01(F.col("q.state") == "running"), "1"),
        (
            "messaging.ibmmq.qmgr.connections",
            zero(F.col("q.status.connectionCount")),
            "{connections}",
        ),
    ]
    attrs = base_attrs(
        "ibmmq",
        {"messaging.ibmmq.qmgr": F.col("q.name"), "messaging.ibmmq.qmgr.state": F.col("q.state")},
    )
    return to_metrics(parsed.withColumn("q", F.explode("j.queueManager")), specs, attrs)


MQ_QUEUE = (
    "struct<name: string, type: string, status: struct<currentDepth: bigint, "
    "openInputCount: bigint, openOutputCount: bigint, uncommittedMessages: bigint, "
    "oldestMessageAge: bigint>>"
)


def ibmmq_queues(df: DataFrame) -> DataFrame:
    """Gauges of the queues, their count and total depth."""
    parsed = read_json(df, f"queue array<{MQ_QUEUE}>").withColumn(
        "items", F.coalesce("j.queue", F.array().cast(f"array<{MQ_QUEUE}>"))
    )
    depth = F.aggregate(
        "items",
        F.lit(0).cast("bigint"),
        lambda acc, q: acc + F.coalesce(q["status"]["currentDepth"], F.lit(0)),
    )
    totals = [
        ("messaging.ibmmq.queues.count", F.size("items"), "{queues}"),
        ("messaging.ibmmq.queues.total_depth", depth, "{messages}"),
    ]
    specs = _zeros(
        [
            ("messaging.ibmmq.queue.depth", "q.status.currentDepth", "{messages}"),
            ("messaging.ibmmq.queue.open_input", "q.status.openInputCount", "{handles}"),
            ("messaging.ibmmq.queue.open_output", "q.status.openOutputCount", "{handles}"),
            ("messaging.ibmmq.queue.uncommitted", "q.status.uncommittedMessages", "{messages}"),
            ("messaging.ibmmq.queue.oldest_msg_age", "q.status.oldestMessageAge", "s"),
        ]
    )
    attrs = base_attrs(
        "ibmmq",
        {
            "messaging.destination.name": F.col("q.name"),
            "messaging.ibmmq.queue.type": F.col("q.type"),
        },
    )
    each = parsed.select("*", F.posexplode_outer("items").alias("pos", "q"))
    return to_metric_groups(
        each, [(F.col("q").isNotNull(), specs, attrs), (_first(), totals, base_attrs("ibmmq"))]
    )


MQ_CHANNEL = (
    "struct<name: string, type: string, status: struct<state: string, msgs: bigint, "
    "bytesSent: bigint, bytesReceived: bigint>>"
)


def ibmmq_channels(df: DataFrame) -> DataFrame:
    """Gauges of every channel, the channel count, and the count by state."""
    parsed = read_json(df, f"channel array<{MQ_CHANNEL}>").withColumn(
        "items", F.coalesce("j.channel", F.array().cast(f"array<{MQ_CHANNEL}>"))
    )
    specs = _zeros(
        [
            ("messaging.ibmmq.channel.messages", "q.status.msgs", "{messages}"),
            ("messaging.ibmmq.channel.bytes_sent", "q.status.bytesSent", "By"),
            ("messaging.ibmmq.channel.bytes_received", "q.status.bytesReceived", "By"),
        ]
    )
    attrs = base_attrs(
        "ibmmq",
        {
            "messaging.ibmmq.channel": F.col("q.name"),
            "messaging.ibmmq.channel.type": F.col("q.type"),
            "messaging.ibmmq.channel.state": F.col("q.status.state"),
        },
    )
    states = F.transform("items", lambda q: F.coalesce(q["status"]["state"], F.lit("")))
    count = [("messaging.ibmmq.channels.count", F.size("items"), "{channels}")]
    by_state = [("messaging.ibmmq.channels.by_state", F.col("c.n"), "{channels}")]
    # One list for both kinds of rows: first the channels, then the counted states.
    entry = "array<struct<q: " + MQ_CHANNEL + ", c: struct<state: string, n: int>>>"
    listed = F.concat(
        F.transform("items", lambda q: record(q=q, c=F.lit(None))).cast(entry),
        F.transform(count_states(states), lambda c: record(q=F.lit(None), c=c)).cast(entry),
    )
    each = parsed.select("*", F.posexplode_outer(listed).alias("pos", "e")).select(
        "*", "e.q", "e.c"
    )
    state_attrs = base_attrs("ibmmq", {"messaging.ibmmq.channel.state": F.col("c.state")})
    return to_metric_groups(
        each,
        [
            (F.col("q").isNotNull(), specs, attrs),
            (_first(), count, base_attrs("ibmmq")),
            (F.col("c").isNotNull(), by_state, state_attrs),
        ],
    )
