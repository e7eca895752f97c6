"""JSON replies."""

import json

from gaugeworks.sources import activemq, documents
from helpers import replies, values


def test_mongo_status_takes_json_numbers_only(spark):
    doc = {
        "connections": {"current": "5", "available": 7},
        "opcounters": {"query": 1, "insert": True},
        "mem": {"resident": 1.5},
        "network": {"bytesIn": 3000000000},
        "wiredTiger": {"cache": {"bytes currently in the cache": 9}},
    }
    df = replies(spark, "mongodb", json.dumps(doc), "broken")
    assert values(documents.mongo_server_status(df)) == {
        "db.mongodb.connections.available": 7.0,
        "db.mongodb.opcounters.query": 1.0,
        "db.mongodb.memory.resident_mb": 1.5,
        "db.mongodb.network.bytes_in": 3e9,
        "db.mongodb.wiredtiger.cache_used_bytes": 9.0,
    }


def _members(*rows):
    return json.dumps({"members": [dict(zip(("stateStr", "optimeDate", "self"), r)) for r in rows]})


def test_mongo_lag(spark):
    p, s = "2024-01-01T10:00:05", "2024-01-01T10:00:02"
    ahead = _members(("PRIMARY", p), ("SECONDARY", s, True))
    behind = _members(("PRIMARY", s), ("SECONDARY", p, True))
    no_self = _members(("PRIMARY", p), ("SECONDARY", s))
    lag = "db.mongodb.replication.lag_seconds"
    assert values(documents.mongo_replset(replies(spark, "mongodb", ahead))) == {lag: 3.0}
    assert values(documents.mongo_replset(replies(spark, "mongodb", behind))) == {lag: 0.0}
    assert values(documents.mongo_replset(replies(spark, "mongodb", no_self))) == {}


def test_es_health(spark):
    good = '{"status":"yellow","number_of_nodes":3,"active_shards":9}'
    base = "db.elasticsearch.cluster."
    assert values(documents.es_cluster_health(replies(spark, "es", good))) == {
        base + "status": 1.0,
        base + "nodes": 3.0,
        base + "shards.active": 9.0,
        base + "shards.unassigned": 0.0,
    }
    odd = values(documents.es_cluster_health(replies(spark, "es", '{"status":"blue"}')))
    assert odd[base + "status"] == -1.0
    unfit = replies(spark, "es", '{"status":"green","number_of_nodes":"3"}', "[]")
    assert values(documents.es_cluster_health(unfit)) == {}


def test_es_nodes(spark):
    def node(total, ms, pools):
        search = {"query_total": total, "query_time_in_millis": ms}
        return {"indices": {"search": search}, "thread_pool": pools}

    body = {"nodes": {"a": node(10, 50, {"search": {"rejected": 1}}), "b": node(30, 70, {})}}
    got = values(documents.es_node_stats(replies(spark, "es", json.dumps(body))))
    assert got["db.elasticsearch.indices.search_rate"] == 40.0
    assert got["db.elasticsearch.indices.search_latency_ms"] == 3.0
    assert got["db.elasticsearch.thread_pool.search_rejected"] == 1.0
    assert got["db.elasticsearch.thread_pool.write_rejected"] == 0.0
    idle = values(documents.es_node_stats(replies(spark, "es", '{"nodes":{}}')))
    assert len(idle) == 8 and set(idle.values()) == {0.0}


def test_rabbit_queues_are_all_listed(spark):
    body = json.dumps([{"name": f"q{i}", "vhost": "/", "messages": i} for i in range(101)])
    rows = documents.rabbit_queues(replies(spark, "rabbitmq", body)).collect()
    assert len(rows) == 707
    assert {r["attrs"]["messaging.destination.name"] for r in rows} == {f"q{i}" for i in range(101)}


def test_rabbit_nodes_and_overview(spark):
    body = json.dumps([{"name": "n", "running": True, "mem_alarm": False, "uptime": 5}])
    got = values(documents.rabbit_nodes(replies(spark, "rabbitmq", body, '{"a":1}')))
    assert got["messaging.rabbitmq.node.running"] == 1.0
    assert got["messaging.rabbitmq.node.memory_alarm"] == 0.0
    assert len(got) == 11
    over = json.dumps({"object_totals": {"queues": 4}, "rabbitmq_version": "3.9"})
    df = documents.rabbit_overview(replies(spark, "rabbitmq", over))
    assert values(df)["messaging.rabbitmq.queues.count"] == 4.0
    assert df.first()["attrs"]["messaging.rabbitmq.version"] == "3.9"


def test_nats(spark):
    streams = [
        {"name": "s1", "messages": 3, "state": {"last_seq": 9}},
        {"name": "s2", "state": {"messages": 4, "bytes": 5, "last_seq": 2**63}},
    ]
    body = json.dumps({"streams": 2, "account_details": [{"name": "A", "stream_detail": streams}]})
    got = values(
        documents.nats_jetstream(replies(spark, "nats", body)), "messaging.nats.jetstream.stream"
    )
    assert len(got) == 14
    base = "messaging.nats.jetstream.stream."
    assert got[(base + "messages", "s1")] == 3.0
    assert got[(base + "messages", "s2")] == 4.0
    assert got[(base + "bytes", "s2")] == 5.0
    assert got[(base + "last_seq", "s2")] == float(2**63)
    varz = values(documents.nats_varz(replies(spark, "nats", '{"connections":2,"cpu":1.5}')))
    assert varz["messaging.nats.cpu"] == 1.5 and len(varz) == 12


def test_ibmmq(spark):
    queues = json.dumps(
        {"queue": [{"name": f"q{i}", "status": {"currentDepth": 1}} for i in range(101)]}
    )
    got = documents.ibmmq_queues(replies(spark, "ibmmq", queues)).collect()
    totals = {r["name"]: r["value"] for r in got if "total" in r["name"] or "count" in r["name"]}
    assert totals == {
        "messaging.ibmmq.queues.count": 101.0,
        "messaging.ibmmq.queues.total_depth": 101.0,
    }
    channels = json.dumps(
        {"channel": [{"name": c, "status": {"state": s}} for c, s in
                     [("a", "RUNNING"), ("b", "RUNNING"), ("c", "STOPPED")]]}
    )
    rows = documents.ibmmq_channels(replies(spark, "ibmmq", channels)).collect()
    by_state = {
        r["attrs"]["messaging.ibmmq.channel.state"]: r["value"]
        for r in rows
        if r["name"].endswith("by_state")
    }
    assert by_state == {"RUNNING": 2.0, "STOPPED": 1.0} and len(rows) == 12
    qmgr = '{"queueManager":[{"name":"m","state":"running","status":{"connectionCount":4}}]}'
    assert values(documents.ibmmq_qmgr(replies(spark, "ibmmq", qmgr))) == {
        "messaging.ibmmq.qmgr.running": 1.0,
        "messaging.ibmmq.qmgr.connections": 4.0,
    }


def test_activemq(spark):
    flat = '{"value":{"TotalConnectionsCount":3,"TotalConsumerCount":"7"}}'
    nested = '{"value":{"org.apache.activemq:brokerName=b":{"TotalConnectionsCount":5}}}'
    name = "messaging.activemq.connections"
    assert values(activemq.classic_broker(replies(spark, "activemq", flat))) == {name: 3.0}
    assert values(activemq.classic_broker(replies(spark, "activemq", nested))) == {name: 5.0}
    assert values(activemq.classic_broker(replies(spark, "activemq", '{"value":5}'))) == {}
    key = "org.apache.activemq:type=Broker,destinationType=Queue,"
    classic = json.dumps(
        {"value": {key + "destinationName=q1": {"QueueSize": 2, "EnqueueCount": "9"},
                   key + "x=1": {"QueueSize": 2}}}
    )
    dest = "messaging.destination.name"
    assert values(activemq.classic_queues(replies(spark, "activemq", classic)), dest) == {
        ("messaging.activemq.queue.size", "q1"): 2.0
    }
    artemis = json.dumps({"value": {'o:broker="b", queue="q2"': {"MessageCount": 2.5}}})
    assert values(activemq.artemis_queues(replies(spark, "activemq", artemis)), dest) == {
        ("messaging.activemq.queue.size", "q2"): 2.5
    }
    broker = '{"value":{"GlobalMaxSize":10}}'
    assert values(activemq.artemis_broker(replies(spark, "activemq", broker))) == {
        "messaging.activemq.global_max_size": 10.0
    }
