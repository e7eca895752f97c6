"""The query contract: names agree, columns agree, and a sample of results agrees."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from gaugeworks.plans import bindings

SF = Path("/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
# One or two of each kind; the whole set is compared by the driver.
SAMPLE = [
    "stat_wide_to_long", "status_kv", "consumer_lag", "topic_rollup", "info_text", "prom_p99",
    "yaml_stats", "cpu_shares", "node_stats_sum", "mq_channels", "jmx_params", "queue_sizes",
    "celery_tasks", "sidekiq_state", "dsn_instance", "clip_bytes", "dedupe_union", "otlp_points",
    "failure_runs", "heartbeat", "array_cap", "prom_first", "count_sum", "sqs_queues",
]

pytestmark = pytest.mark.skipif(not SF.exists(), reason="benchmark tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return con


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def cell(v):
        return "NULL" if v is None or (isinstance(v, float) and math.isnan(v)) else str(v)

    return sorted(tuple(cell(r[i]) for i in order) for r in data)


def test_every_query_has_a_twin():
    assert set(bindings.ORACLES) == set(bindings.QUERIES)
    assert set(bindings.QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", SAMPLE)
def test_sample_matches_its_twin(spark, duck, name):
    df = contract.queries()[name](spark, str(SF))
    twin = duck.execute(contract.oracle_sql()[name])
    names = [d[0] for d in twin.description]
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, df.collect()) == rows(names, twin.fetchall())
