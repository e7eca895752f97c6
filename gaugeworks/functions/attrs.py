"""Attribute maps of metric rows."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def make_attrs(pairs: dict[str, Column]) -> Column:
    """``map<string,string>`` from named columns; an absent value becomes an empty string."""
    flat: list[Column] = []
    for key, value in pairs.items():
        flat += [F.lit(key), F.coalesce(value.cast("string"), F.lit(""))]
    return F.create_map(*flat)


def base_attrs(family: str, extra: dict[str, Column] | None = None) -> Column:
    """Attributes every row of a source family carries, with per-entity ones on top.

    Those of hosts come from the columns of ``host.with_facts``."""
    kind, system = FAMILIES[family]
    name, instance = F.col("target_name"), F.col("instance")
    if kind == "db":
        pairs = {"db.system": F.lit(system), "db.name": name, "db.instance": instance}
    elif kind == "messaging":
        pairs = {
            "messaging.system": F.lit(system),
            "messaging.instance": instance,
            "messaging.name": name,
        }
    else:
        pairs = {
            "host.name": F.coalesce(F.col("host_name"), name),
            "host.arch": F.col("arch"),
            "os.type": F.col("os_type"),
        }
    return make_attrs({**pairs, **(extra or {})})


def extend_attrs(attrs: Column, extra: Column) -> Column:
    """Copy of a map with the entries of another on top, free of duplicate keys."""
    kept = F.map_filter(attrs, lambda k, v: ~F.map_contains_key(extra, k))
    return F.map_concat(kept, extra)


def resource_attrs(
    service: Column,
    environment: Column,
    optional: dict[str, Column] | None = None,
) -> Column:
    """Batch-level attributes; the optional ones appear only when they are not empty."""
    fixed = {"service.name": service, "deployment.environment": environment}
    extra = optional or {}
    return F.map_filter(
        make_attrs({**fixed, **extra}), lambda k, v: (v != "") | k.isin(list(fixed))
    )


def attrs_text(attrs: Column) -> Column:
    """Sorted ``key=value`` text of a map; equal maps give equal text in any entry order."""
    entries = F.array_sort(F.map_entries(attrs))
    return F.array_join(
        F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";"
    )


# Attribute convention and system label of each source family.
FAMILIES = {
    "postgres": ("db", "postgres"),
    "mysql": ("db", "mysql"),
    "redis": ("db", "redis"),
    "mongodb": ("db", "mongodb"),
    "cassandra": ("db", "cassandra"),
    "elasticsearch": ("db", "elasticsearch"),
    "clickhouse": ("db", "clickhouse"),
    "cockroachdb": ("db", "cockroachdb"),
    "sqlite": ("db", "sqlite"),
    "kafka": ("messaging", "kafka"),
    "rabbitmq": ("messaging", "rabbitmq"),
    "nats": ("messaging", "nats"),
    "bullmq": ("messaging", "bullmq"),
    "sidekiq": ("messaging", "sidekiq"),
    "celery": ("messaging", "celery"),
    "ibmmq": ("messaging", "ibmmq"),
    "activemq": ("messaging", "activemq"),
    "sqs": ("messaging", "aws_sqs"),
    "beanstalkd": ("messaging", "beanstalkd"),
    "host": ("host", ""),
}
# Other spellings of a family in target settings.
ALIASES = {"artemis": "activemq"}
