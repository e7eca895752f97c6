"""All queries over the benchmark tables."""

from __future__ import annotations

from gaugeworks.plans import (  # noqa: F401
    agent_queries,
    fleet,
    json_queries,
    operator_queries,
    queue_queries,
    stream_queries,
    table_queries,
    text_queries,
)
from gaugeworks.plans.common import ORACLES, QUERIES  # noqa: F401


def entry(spark, sf_dir):
    """The flagship query: a whole collection cycle, summed up per metric."""
    return fleet.fleet_cycle(spark, sf_dir)
