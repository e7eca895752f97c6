"""Joins: consumer lag, replica lag, facts as of a time, capability gates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from gaugeworks.functions.numbers import lag_seconds
from gaugeworks.operators.ordered import DAY_US, PART, over_slices, sliced


def consumer_lag(
    committed: DataFrame, ends: DataFrame, groups: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Unread messages per consumer group.

    Uncommitted offsets are skipped, only positive differences count, a partition without
    an end offset adds 0 and a group without offsets reports 0. ``groups`` lists the
    groups to report. The wide join is on (keys, topic, partition), where the right side
    is unique, so a hot topic splits safely under adaptive skew handling; the sum is
    combined on the map side.
    """
    on = [*keys, "topic", "partition"]
    listed = committed.where("committed_offset >= 0").join(
        groups.select(*keys, "group_id"), [*keys, "group_id"], "left_semi"
    )
    last = ends.groupBy(*on).agg(F.max("last_offset").alias("last_offset"))
    ahead = F.col("last_offset") - F.col("committed_offset")
    per_group = (
        listed.join(last, on, "left")
        .groupBy(*keys, "group_id")
        .agg(F.sum(F.greatest(F.lit(0).cast("bigint"), F.coalesce(ahead, F.lit(0)))).alias("lag"))
    )
    return groups.join(per_group, [*keys, "group_id"], "left").withColumn(
        "lag", F.coalesce("lag", F.lit(0)).cast("bigint")
    )


def replica_lag(
    members: DataFrame, keys: Sequence[str], pos: str = "pos"
) -> DataFrame:
    """Seconds the own member trails the primary; needs both, last listed wins.

    One conditional aggregate instead of a self join.
    """
    known = F.col("optime").isNotNull()
    primary = F.max_by("optime", F.when((F.col("state") == "PRIMARY") & known, F.col(pos)))
    own = F.max_by("optime", F.when(F.col("is_self") & known, F.col(pos)))
    both = members.groupBy(*keys).agg(primary.alias("primary"), own.alias("own"))
    return (
        both.where("primary is not null and own is not null")
        .withColumn("lag_s", lag_seconds(F.col("primary"), F.col("own")))
        .drop("primary", "own")
    )


def as_of(
    samples: DataFrame,
    facts: DataFrame,
    keys: Sequence[str],
    order: str,
    cols: Sequence[str],
    slice_us: int = DAY_US,
) -> DataFrame:
    """Each sample with the facts that held at its time: those of its key's newest fact row at or
    before it, NULL before the first one. Of fact rows of one time the last in order of ``cols`` holds.

    Both sides are cut into time slices of a key. A slice finds facts among its own rows, and
    what held when it began in the summaries of the slices before it, so neither a key of very
    many samples nor one whose facts change all the time is one task's work.
    """
    def typed(df: DataFrame, name: str) -> Column:
        return F.lit(None).cast(df.schema[name].dataType).alias(name)

    sample = samples.select(*keys, order, F.struct("*").alias("__sample"))
    fact = facts.select(*keys, order, F.struct(*cols).alias("__fact"))
    both = sample.select("*", typed(fact, "__fact")).unionByName(fact.select("*", typed(sample, "__sample")))
    rows = sliced(both, keys, order, slice_us)
    age = F.when(F.col("__fact").isNotNull(), F.struct(order, "__fact"))
    ends = rows.groupBy(PART).agg(F.max_by(F.struct(order, "__sample", "__fact"), age).alias("__end"))
    before = over_slices(keys).rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(PART, F.last("__end", ignorenulls=True).over(before)["__fact"].alias("__held"))
    # Facts of a sample's own time come before it.
    inside = Window.partitionBy(PART).orderBy(order, F.col("__sample").isNotNull(), "__fact").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    own = rows.withColumn("__own", F.last("__fact", ignorenulls=True).over(inside)).where("__sample IS NOT NULL")
    held = F.coalesce("__own", "__held")
    return own.join(carried, PART, "left").select(
        *[F.col("__sample")[c].alias(c) for c in samples.columns], *[held[c].alias(c) for c in cols]
    )


def semi_gate(
    df: DataFrame, extensions: DataFrame, keys: Sequence[str], name: str
) -> DataFrame:
    """Rows of targets that have a named extension."""
    having = extensions.where(F.col("extname") == name).select(*keys).distinct()
    return df.join(having, list(keys), "left_semi")
