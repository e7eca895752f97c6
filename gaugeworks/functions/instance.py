"""Instance id of a target, read from its connection string."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Families whose connection string is a URL.
URL_TYPES = [
    "postgres", "mongodb", "redis", "bullmq", "sidekiq", "celery",
    "cassandra", "elasticsearch", "clickhouse", "cockroachdb",
    "rabbitmq", "nats", "ibmmq", "activemq", "artemis",
]
UNKNOWN = "unknown"


def url_host(url: Column, bad: Column | None = None) -> Column:
    """Host and port of a URL without user info.

    A URL that has no authority gives an empty string; text that is no URL (a colon in
    the first path segment, a port that is no number) gives ``bad``.
    """
    bad = F.lit(UNKNOWN) if bad is None else bad
    authority = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1)
    host = F.substring_index(authority, "@", -1)
    bad_port = host.rlike(r":[^:\]]*[^0-9:\]][^:\]]*$")
    return (
        F.when(url.rlike(r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//"), F.when(bad_port, bad).otherwise(host))
        .when(url.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), F.lit(""))
        .when(url.rlike(r"^[^/?#]*:"), bad)
        .otherwise(F.lit(""))
    )


def instance_from_dsn(kind: Column, dsn: Column) -> Column:
    """Instance id by the rule of the target type."""
    parens = r"\(([^)]*)\)"
    return (
        F.when(kind.isin(URL_TYPES), url_host(dsn))
        .when(kind == "kafka", F.substring_index(dsn, ",", 1))
        .when(kind.isin("beanstalkd", "sqlite"), dsn)
        .when(kind == "sqs", F.when(dsn.startswith("http"), url_host(dsn, dsn)).otherwise(dsn))
        .when(kind == "mysql", F.when(dsn.rlike(parens), F.regexp_extract(dsn, parens, 1))
              .otherwise(F.lit(UNKNOWN)))
        .when(kind == "host", F.lit("localhost"))
        .otherwise(F.lit(UNKNOWN))
    )
