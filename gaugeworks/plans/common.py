"""Helpers for the queries bound to the benchmark tables, and for their SQL twins."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gaugeworks.functions.attrs import FAMILIES, attrs_text

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# One fixed scrape time for tables whose rows carry no time of their own.
SCRAPED = "2002-01-01 00:00:00"


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with the SQL that computes the same rows from the base tables."""

    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """A base table's rows dealt by key over the session's shuffle partitions, before wide bodies
    are built from them: a table may be one row group, and building and parsing is the work."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def land(
    df: DataFrame,
    cycle: Column | int,
    target: Column,
    instance: Column,
    at: Column | None = None,
    **columns: Column,
) -> DataFrame:
    """Shape table rows as rows of a landed table."""
    at = F.lit(SCRAPED).cast("timestamp_ntz") if at is None else at
    cycle = F.lit(cycle) if isinstance(cycle, int) else cycle
    return df.select(
        cycle.cast("bigint").alias("cycle_id"),
        at.alias("collected_at"),
        target.cast("string").alias("target_name"),
        instance.cast("string").alias("instance"),
        *[c.alias(n) for n, c in columns.items()],
    )


def flat(metrics: DataFrame) -> DataFrame:
    """Metric rows with the attribute map as sorted text."""
    return metrics.select(
        "cycle_id", "target", "name", "value", "unit", attrs_text(F.col("attrs")).alias("attrs")
    )


def s(*parts: Column | str) -> Column:
    """Text out of literals and columns."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


# ---- SQL side


def attrs_sql(pairs: dict[str, str]) -> str:
    """Sorted attribute text; values are SQL expressions."""
    return " || ';' || ".join(
        f"'{key}=' || coalesce(CAST({pairs[key]} AS VARCHAR), '')" for key in sorted(pairs)
    )


def base_sql(family: str, extra: dict[str, str] | None = None) -> str:
    kind, system = FAMILIES[family]
    if kind == "db":
        pairs = {"db.system": f"'{system}'", "db.name": "target", "db.instance": "instance"}
    elif kind == "messaging":
        pairs = {
            "messaging.system": f"'{system}'",
            "messaging.name": "target",
            "messaging.instance": "instance",
        }
    else:
        pairs = {"host.name": "target", "host.arch": "''", "os.type": "''"}
    return attrs_sql({**pairs, **(extra or {})})


def long_sql(source: str, entries: Sequence[tuple[str, str, str]], attrs: str) -> str:
    """Wide rows to metric rows: one SELECT per (name, value expression, unit).

    ``source`` is a FROM item with cycle_id, target, instance and what the expressions use.
    """
    return " UNION ALL ".join(
        f"SELECT CAST(cycle_id AS BIGINT) AS cycle_id, target, '{name}' AS name, CAST({value} AS DOUBLE) AS value, "
        f"'{unit}' AS unit, {attrs} AS attrs FROM {source} WHERE ({value}) IS NOT NULL"
        for name, value, unit in entries
    )
