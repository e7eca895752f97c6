"""Union of metric tables, series dedupe, and the non-finite gate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from gaugeworks.schema import METRIC_COLUMNS

OUTCOME, GOOD, REJECTED = "outcome", "good", "rejected"


def union_metrics(*parts: DataFrame) -> DataFrame:
    """UNION ALL of metric tables by column name.

    Joined up in pairs: a chain would have Spark analyze the growing plan once per table.
    """
    frames = list(parts)
    while len(frames) > 1:
        pairs = zip(frames[::2], frames[1::2])
        rest = frames[-1:] if len(frames) % 2 else []
        frames = [a.unionByName(b) for a, b in pairs] + rest
    return frames[0]


def dedupe_series(
    metrics: DataFrame, prefer: Column | None = None, apart: Sequence[str] = ()
) -> DataFrame:
    """One row per (cycle, target, name, attributes): a finite value before any other, then the
    highest ``prefer`` (an integer), then the larger value; time and unit are that row's own.

    The attribute map itself is the grouping key (entry order does not matter), and copies are
    folded on the map side: a series emitted many times does not travel as many rows. Rows that
    differ in a column of ``apart`` stay apart, and the column stays.
    """
    rank = F.lit(0) if prefer is None else prefer
    best = F.max(F.struct(is_finite(F.col("value")), rank.cast("int"), "value", "ts", "unit"))
    return (
        metrics.groupBy("cycle_id", "target", "name", "attrs", *apart)
        .agg(best.alias("best"))
        .select(
            F.col("best.ts").alias("ts"), "cycle_id", "target", "name",
            F.col("best.value").alias("value"), F.col("best.unit").alias("unit"), "attrs", *apart,
        )
        .select(*METRIC_COLUMNS, *apart)
    )


def is_finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))


def mark_nonfinite(metrics: DataFrame) -> DataFrame:
    """Rows with their outcome: ``good`` where the value can be written as a JSON number, else
    ``rejected``. One pass serves a sink for both."""
    fine = is_finite(F.col("value"))
    return metrics.withColumn(OUTCOME, F.when(fine, GOOD).otherwise(REJECTED))


def quarantine_nonfinite(metrics: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that can be written as JSON numbers, and the ones that cannot."""
    fine = is_finite(F.col("value"))
    return metrics.where(fine), metrics.where(~fine)
