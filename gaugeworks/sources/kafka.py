"""Kafka broker, topic, group and offset tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gaugeworks.functions.attrs import base_attrs
from gaugeworks.operators.aggregate import cluster_rollup, count_by, topic_rollup
from gaugeworks.operators.join import consumer_lag
from gaugeworks.operators.shape import is_internal_topic, to_metric_groups, to_metrics
from gaugeworks.schema import KEYS



def brokers(df: DataFrame) -> DataFrame:
    """Broker count; the controller is an attribute."""
    six = F.col("host").contains(":")  # an IPv6 address stands in brackets before a port
    host = F.when(six, F.concat(F.lit("["), F.col("host"), F.lit("]"))).otherwise(F.col("host"))
    address = F.concat_ws(":", host, F.col("port").cast("string"))
    counted = df.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.when(F.col("is_controller"), address)).alias("controller"),
    )
    attrs = base_attrs("kafka", {"messaging.kafka.controller": F.col("controller")})
    return to_metrics(counted, [("messaging.kafka.brokers.count", F.col("n"), "{brokers}")], attrs)


def topics(df: DataFrame) -> DataFrame:
    """Per-topic gauges without internal topics, and cluster totals."""
    per_topic = topic_rollup(df, KEYS)
    # The condition stays out of a filter, which would be pushed below the aggregate and give
    # the two uses of it different inputs: this way they share one scan and one shuffle.
    rows = to_metric_groups(
        per_topic,
        [
            (
                ~is_internal_topic(F.col("topic")),
                [
                    ("messaging.kafka.topic.partitions", F.col("partitions"), "{partitions}"),
                    ("messaging.kafka.topic.replication_factor", F.col("replication"), "1"),
                    ("messaging.kafka.topic.under_replicated", F.col("under"), "{partitions}"),
                ],
                base_attrs("kafka", {"messaging.destination.name": F.col("topic")}),
            )
        ],
    )
    totals = to_metrics(
        cluster_rollup(per_topic, KEYS),
        [
            ("messaging.kafka.topics.count", F.col("topics"), "{topics}"),
            ("messaging.kafka.partitions.total", F.col("partitions"), "{partitions}"),
            ("messaging.kafka.under_replicated.total", F.col("under"), "{partitions}"),
        ],
        base_attrs("kafka"),
    )
    return rows.unionByName(totals)


def group_states(df: DataFrame, scrapes: DataFrame | None = None) -> DataFrame:
    """Group count and the count by state. ``scrapes`` lists scrapes by the key columns, so that
    a cluster without groups still reports 0."""
    by_state = count_by(df, KEYS, "state")
    total = by_state.groupBy(*KEYS).agg(F.sum("n").alias("n"))
    if scrapes is not None:
        total = scrapes.select(*KEYS).join(total, KEYS, "full").fillna(0)
    return to_metrics(
        by_state,
        [("messaging.kafka.consumer_groups.by_state", F.col("n"), "{groups}")],
        base_attrs("kafka", {"messaging.kafka.consumer_group.state": F.col("state")}),
    ).unionByName(
        to_metrics(
            total,
            [("messaging.kafka.consumer_groups.count", F.col("n"), "{groups}")],
            base_attrs("kafka"),
        )
    )


def group_lag(groups: DataFrame, committed: DataFrame, ends: DataFrame) -> DataFrame:
    """Unread messages of the listed groups."""
    listed = groups.select(*KEYS, "group_id").distinct()
    lag = consumer_lag(committed, ends, listed, KEYS)
    attrs = base_attrs("kafka", {"messaging.kafka.consumer_group": F.col("group_id")})
    return to_metrics(
        lag, [("messaging.kafka.consumer_group.lag", F.col("lag"), "{messages}")], attrs
    )
