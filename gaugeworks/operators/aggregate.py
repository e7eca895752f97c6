"""Grouped operators. All combine on the map side before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from gaugeworks.functions.numbers import ratio
from gaugeworks.functions.records import record
from gaugeworks.operators.shape import is_internal_topic


def activity_rollup(sessions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Session counts by state and the age of the longest active query."""
    active = F.col("state") == "active"
    return sessions.groupBy(*keys).agg(
        F.count_if(F.col("state") == "idle").alias("idle"),
        F.count_if(active).alias("active"),
        F.count_if(F.col("wait_event_type").isNotNull()).alias("waiting"),
        F.coalesce(F.max(F.when(active, F.col("age_s"))), F.lit(0.0)).alias("longest_s"),
    )


def sum_members(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Per-group sums over member rows, absent readings counting as 0."""
    return df.groupBy(*keys).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast("double").alias(c) for c in cols]
    )


def sum_nested(members: Column, fields: Sequence[str], pick) -> Column:
    """Row-local sums over an array of members: ``struct<field: double, ...>``.

    ``pick(member, field)`` reads one number of a member. Nothing is exploded.
    """
    return F.aggregate(
        members,
        record(**{f: F.lit(0.0) for f in fields}),
        lambda acc, m: record(
            **{f: acc[f] + F.coalesce(pick(m, f).cast("double"), F.lit(0.0)) for f in fields}
        ),
    )


def weighted_avg(
    df: DataFrame, keys: Sequence[str], num: str, den: str, on_zero: str = "omit"
) -> DataFrame:
    """sum(num) / sum(den) per group, guarded."""
    return df.groupBy(*keys).agg(
        ratio(F.sum(num), F.sum(den), on_zero).alias("weighted_avg"),
    )


def count_by(df: DataFrame, keys: Sequence[str], state: str) -> DataFrame:
    return df.groupBy(*keys, state).agg(F.count(F.lit(1)).alias("n"))


def count_states(states: Column) -> Column:
    """Row-local count by state: ``array<struct<state, n>>`` from an array of states."""
    return F.transform(
        F.array_distinct(states),
        lambda s: record(state=s, n=F.size(F.filter(states, lambda x: x == s))),
    )


def count_sum(df: DataFrame, keys: Sequence[str], pred: Column, col: str) -> DataFrame:
    """Row count and column sum over the rows that satisfy a predicate; 0 where none does."""
    return df.groupBy(*keys).agg(
        F.count_if(pred).alias("n"), F.coalesce(F.sum(F.when(pred, F.col(col))), F.lit(0)).alias("total")
    )


def topic_rollup(partitions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per-topic partition count, replication factor and missing in-sync replicas."""
    per_topic = partitions.groupBy(*keys, "topic").agg(
        F.count(F.lit(1)).alias("partitions"),
        F.max(F.size("replicas")).cast("bigint").alias("replication"),
        F.sum(F.size("isr")).alias("isr"),
    )
    lacking = F.col("partitions") * F.col("replication") - F.col("isr")
    return per_topic.withColumn("under", F.greatest(F.lit(0).cast("bigint"), lacking))


def cluster_rollup(topics: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Cluster totals of :func:`topic_rollup`. Internal topics count as partitions only."""
    user = ~is_internal_topic(F.col("topic"))
    return topics.groupBy(*keys).agg(
        F.count_if(user).alias("topics"),
        F.sum("partitions").alias("partitions"),
        F.coalesce(F.sum(F.when(user, F.col("under"))), F.lit(0)).cast("bigint").alias("under"),
    )


def distinct_names(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    return df.select(*keys, name).where(F.col(name).isNotNull()).distinct()
