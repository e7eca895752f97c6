"""Small landed tables for fixture tests."""

from datetime import datetime

from gaugeworks.schema import landed_schema

AT = datetime(2024, 1, 1)


def landed(spark, table, rows, cycle=1, at=AT, target="t1", instance="i1"):
    """A landed table out of rows that carry only the table's own columns."""
    schema = landed_schema(table)
    return spark.createDataFrame([(cycle, at, target, instance, *r) for r in rows], schema)


def replies(spark, kind, *bodies, endpoint="e"):
    """Raw replies of one source; a body may be a pair of endpoint and body."""
    rows = [(kind, *(b if isinstance(b, tuple) else (endpoint, b))) for b in bodies]
    return landed(spark, "raw_snapshots", rows)


def values(metrics, *labels):
    """{metric name or (name, label values...): value}; fails on duplicate keys."""
    out = {}
    for row in metrics.collect():
        key = (row["name"], *[row["attrs"].get(x) for x in labels]) if labels else row["name"]
        assert key not in out, key
        out[key] = row["value"]
    return out
