"""Shaping: wide to long, key mapping, target dispatch, filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from gaugeworks.functions.attrs import ALIASES, FAMILIES
from gaugeworks.functions.instance import instance_from_dsn
from gaugeworks.functions.records import record
from gaugeworks.functions.text import keep_first, keep_last, pairs_map
from gaugeworks.schema import METRIC_COLUMNS

# name, value column, unit
Spec = tuple[str, Column, str]
# source key, metric name, unit, multiplier
Mapping = Sequence[tuple[str, str, str, float]]


def scaled(entries: Sequence[tuple]) -> list[tuple[str, str, str, float]]:
    """Mapping entries with the multiplier filled in (1 where left out)."""
    return [(e[0], e[1], e[2], float(e[3]) if len(e) > 3 else 1.0) for e in entries]


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that later filters use.

    A filter on a plain computed column is pushed below it and computes it again (a second
    parse of every body). A filter on the output of a generator stays above it.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def emit(df: DataFrame, rows: Column, attrs: Column) -> DataFrame:
    """Metric rows from an ``array<struct<name, value, unit>>`` column; absent values drop out."""
    return (
        df.select(
            F.col("collected_at").alias("ts"),
            "cycle_id",
            F.col("target_name").alias("target"),
            attrs.alias("attrs"),
            F.inline(rows),
        )
        .where(F.col("value").isNotNull())
        .select(*METRIC_COLUMNS)
    )


def _constants(values: Sequence[str | int]) -> Column:
    """Constant array in one expression."""
    return F.expr(f"array({', '.join(repr(v) for v in values)})")


def to_metrics(df: DataFrame, specs: Sequence[Spec], attrs: Column) -> DataFrame:
    """One wide stat row becomes one metric row per spec, in a single pass.

    Only the values are exploded; name and unit are looked up by position in constants.
    """
    return to_metric_groups(df, [(None, specs, attrs)])


def to_metric_groups(
    df: DataFrame, groups: Sequence[tuple[Column | None, Sequence[Spec], Column]]
) -> DataFrame:
    """Several groups of metric rows out of one row, each with attributes of its own.

    A group is (condition or None, specs, attributes). One pass over the input serves all
    groups, where a union of separate selections would read and shuffle it once per group.
    """
    flat = [
        (number, name, value if condition is None else F.when(condition, value), unit)
        for number, (condition, specs, _) in enumerate(groups)
        for name, value, unit in specs
    ]
    values = F.array(*[value.cast("double") for _, _, value, _ in flat])
    pos = F.col("__pos")
    attrs = groups[0][2]
    if len(groups) > 1:
        number = F.get(_constants([f[0] for f in flat]), pos)
        for n, (_, _, own) in enumerate(groups[1:], 1):
            attrs = F.when(number == n, own).otherwise(attrs)
    return (
        df.select("*", F.posexplode(values).alias("__pos", "__value"))
        .where(F.col("__value").isNotNull())
        .select(
            F.col("collected_at").alias("ts"),
            "cycle_id",
            F.col("target_name").alias("target"),
            F.get(_constants([f[1] for f in flat]), pos).alias("name"),
            F.col("__value").alias("value"),
            F.get(_constants([f[3] for f in flat]), pos).alias("unit"),
            attrs.alias("attrs"),
        )
    )


def keyed(df: DataFrame, pairs: Column, wins: str = "last") -> DataFrame:
    """Add ``kv``, the map of a row's key/value pairs; the first or last of a key wins.

    All inside the row: no explode, no shuffle.
    """
    keep = {"first": keep_first, "last": keep_last}[wins]
    listed = df.withColumn("__pairs", pairs)
    return listed.withColumn("kv", pairs_map(keep(F.col("__pairs")))).drop("__pairs")


def kv_num(key: str) -> Column:
    return F.col("kv")[key]["num"]


def kv_text(key: str) -> Column:
    return F.col("kv")[key]["value"]


def kv_specs(mapping: Mapping) -> list[Spec]:
    """Specs that read each mapped key out of ``kv``."""
    return [
        (name, kv_num(key) if factor == 1 else kv_num(key) * F.lit(factor), unit)
        for key, name, unit, factor in scaled(mapping)
    ]


def map_names(df: DataFrame, mapping: Mapping, key: str = "key", value: str = "value") -> DataFrame:
    """Rename ``(key, value)`` rows to metric name and unit, scaling the value.

    The mapping is a fixed list, so the lookup is a constant map inside the projection:
    no join, and the key filter reaches the scan. Several keys may map to one name.
    """
    table = F.create_map(
        *[
            part
            for source, name, unit, factor in scaled(mapping)
            for part in (
                F.lit(source),
                record(name=F.lit(name), unit=F.lit(unit), f=F.lit(factor)),
            )
        ]
    )
    hit = table[F.col(key)]
    others = [c for c in df.columns if c not in (value, "name", "unit")]
    return keep_keys(df, [m[0] for m in mapping], key).select(
        *others,
        hit["name"].alias("name"),
        (F.col(value) * hit["f"]).alias("value"),
        hit["unit"].alias("unit"),
    )


def keep_keys(df: DataFrame, keys: Sequence[str], column: str = "key") -> DataFrame:
    """Allow-list filter on stat rows; reaches the scan as an IN predicate."""
    return df.where(F.col(column).isin(list(keys)))


def missing_metrics(found: Column, expected: Sequence[str]) -> Column:
    """Expected names that a scrape did not deliver, as an array inside the row."""
    return F.array_except(F.array(*[F.lit(e) for e in expected]), found)


def family_of(kind: Column) -> Column:
    """Source family of a target type, NULL for an unknown type."""
    names = {**{f: f for f in FAMILIES}, **ALIASES}
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return table[kind]


def classify_targets(targets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Supported targets with family and instance id, and the rejected ones."""
    known = targets.withColumn("family", family_of(F.col("type")))
    supported = known.where("family is not null").withColumn(
        "instance", instance_from_dsn(F.col("type"), F.col("dsn"))
    )
    rejected = known.where("family is null").select(
        "type", "name", F.concat(F.lit("unsupported type: "), "type").alias("reason")
    )
    return supported, rejected


def real_mount(device: Column, fstype: Column) -> Column:
    """Mounts that stand for a disk."""
    # File systems that are not disks.
    return device.startswith("/dev/") & ~fstype.isin("squashfs", "tmpfs", "devtmpfs")


def is_internal_topic(topic: Column) -> Column:
    return topic.startswith("_")
