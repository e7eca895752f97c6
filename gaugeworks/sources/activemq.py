"""ActiveMQ classic and Artemis JMX replies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gaugeworks.functions.attrs import base_attrs
from gaugeworks.functions.numbers import num_json
from gaugeworks.functions.text import jmx_param
from gaugeworks.operators.shape import once, to_metrics

# JMX attribute, metric name, unit; first of the broker, then of a queue.
CLASSIC_BROKER = [
    ("TotalConnectionsCount", "messaging.activemq.connections", "{connections}"),
    ("TotalConsumerCount", "messaging.activemq.consumers", "{consumers}"),
    ("TotalProducerCount", "messaging.activemq.producers", "{producers}"),
    ("TotalEnqueueCount", "messaging.activemq.enqueue.total", "{messages}"),
    ("TotalDequeueCount", "messaging.activemq.dequeue.total", "{messages}"),
    ("StorePercentUsage", "messaging.activemq.store_percent", "%"),
    ("MemoryPercentUsage", "messaging.activemq.memory_percent", "%"),
    ("TempPercentUsage", "messaging.activemq.temp_percent", "%"),
]
CLASSIC_QUEUE = [
    ("QueueSize", "messaging.activemq.queue.size", "{messages}"),
    ("ConsumerCount", "messaging.activemq.queue.consumers", "{consumers}"),
    ("EnqueueCount", "messaging.activemq.queue.enqueue", "{messages}"),
    ("DequeueCount", "messaging.activemq.queue.dequeue", "{messages}"),
    ("ExpiredCount", "messaging.activemq.queue.expired", "{messages}"),
]
ARTEMIS_BROKER = [
    ("ConnectionCount", "messaging.activemq.connections", "{connections}"),
    ("TotalConnectionCount", "messaging.activemq.connections.total", "{connections}"),
    ("TotalConsumerCount", "messaging.activemq.consumers", "{consumers}"),
    ("TotalMessageCount", "messaging.activemq.messages.total", "{messages}"),
    ("AddressMemoryUsage", "messaging.activemq.address_memory", "By"),
    ("GlobalMaxSize", "messaging.activemq.global_max_size", "By"),
]
ARTEMIS_QUEUE = [
    ("MessageCount", "messaging.activemq.queue.size", "{messages}"),
    ("ConsumerCount", "messaging.activemq.queue.consumers", "{consumers}"),
    ("MessagesAdded", "messaging.activemq.queue.enqueue", "{messages}"),
    ("MessagesAcknowledged", "messaging.activemq.queue.dequeue", "{messages}"),
    ("MessagesExpired", "messaging.activemq.queue.expired", "{messages}"),
    ("DeliveringCount", "messaging.activemq.queue.delivering", "{messages}"),
]
VARIANT = "messaging.activemq.variant"


def _reply(df: DataFrame) -> DataFrame:
    parsed = once(df, "v", F.from_json("body", "value map<string, variant>")["value"])
    return parsed.where("v is not null")


def _member(value: Column, field: str) -> Column:
    return num_json(F.try_variant_get(value, f"$.{field}", "variant"))


def _broker(df: DataFrame, variant: str, mapping: list) -> DataFrame:
    """Broker gauges; the reply may hold the fields or one object per matching name."""

    def reading(field: str) -> Column:
        flat = num_json(F.try_element_at("v", F.lit(field)))
        nested = F.filter(
            F.transform(F.map_values("v"), lambda m: _member(m, field)), lambda x: x.isNotNull()
        )
        return F.coalesce(flat, F.try_element_at(nested, F.lit(1)))

    specs = [(name, reading(field), unit) for field, name, unit in mapping]
    return to_metrics(_reply(df), specs, base_attrs("activemq", {VARIANT: F.lit(variant)}))


def _queues(df: DataFrame, variant: str, param: str, mapping: list) -> DataFrame:
    each = _reply(df).select("*", F.explode("v").alias("object_name", "q")).drop("v")
    named = each.withColumn("queue", jmx_param(F.col("object_name"), param)).where("queue <> ''")
    if variant == "artemis":
        named = named.withColumn("queue", F.btrim("queue", F.lit('"')))
    specs = [(name, _member(F.col("q"), field), unit) for field, name, unit in mapping]
    attrs = base_attrs(
        "activemq",
        {VARIANT: F.lit(variant), "messaging.destination.name": F.col("queue")},
    )
    return to_metrics(named, specs, attrs)


def classic_broker(df: DataFrame) -> DataFrame:
    return _broker(df, "classic", CLASSIC_BROKER)


def classic_queues(df: DataFrame) -> DataFrame:
    return _queues(df, "classic", "destinationName", CLASSIC_QUEUE)


def artemis_broker(df: DataFrame) -> DataFrame:
    return _broker(df, "artemis", ARTEMIS_BROKER)


def artemis_queues(df: DataFrame) -> DataFrame:
    return _queues(df, "artemis", "queue", ARTEMIS_QUEUE)
