"""The whole collection cycle as one Spark plan: landed tables in, metric table out."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gaugeworks.operators.union import GOOD, OUTCOME, dedupe_series, mark_nonfinite, union_metrics
from gaugeworks.schema import KEYS
from gaugeworks.sources import queues
from gaugeworks.sources.landing import route
from gaugeworks.sources.registry import BY_DATABASE, REPLY_JOBS, TABLE_JOBS, TWICE, TWICE_FROM, WITH_FACTS, WITH_SCRAPES


def reply_metrics(snapshots: DataFrame, facts: DataFrame | None = None) -> DataFrame:
    """Every job over raw replies. Each one reads its own endpoint partition only."""
    parts = [
        job(route(snapshots, kind, endpoint), **({"facts": facts} if kind == "host" else {}))
        for kind, endpoint, job in REPLY_JOBS
    ]
    tubes = queues.beanstalkd_tubes(
        route(snapshots, "beanstalkd", "list-tubes"),
        route(snapshots, "beanstalkd").where(
            F.col("endpoint").startswith(queues.TUBE_COMMAND)
        ),
    )
    return union_metrics(*parts, tubes)


def _scrapes(scrapes: DataFrame, name: str) -> DataFrame:
    return scrapes.where(F.col("table_name") == name)


def collect_marked(
    tables: dict[str, DataFrame], agent: list[DataFrame] | None = None
) -> DataFrame:
    """Metrics of all landed tables given, each row with its ``outcome``, so that one pass can write
    the good rows and the rejected ones.

    ``tables`` maps landed table names to frames; jobs whose tables are not given are left
    out. ``pg_current_database`` names the monitored database of a scrape; without it every
    database is reported under its name. ``scrapes`` lists scrapes (``table_name`` says of what),
    so that one that found nothing reports zeros. ``host_facts`` says what hosts are. ``agent`` adds
    ready metric tables such as heartbeat and health rows. Rows that are no numbers are set apart
    first, so they never stand for a finite one. Only names that two jobs emit are deduped; all
    other rows go through untouched.
    """
    current, facts = tables.get("pg_current_database"), tables.get("host_facts")
    if current is not None:
        monitored = current.select(*KEYS, "datname").distinct()
        tables = tables | {
            t: tables[t].join(monitored, [*KEYS, "datname"], "left_semi")
            for t in BY_DATABASE
            if t in tables
        }
    sure, shared = list(agent or []), []
    if "raw_snapshots" in tables:
        sure.append(reply_metrics(tables["raw_snapshots"], facts))
    for needed, rank, job in TABLE_JOBS:
        if all(t in tables for t in needed):
            asked = {}
            if needed[0] in WITH_SCRAPES and "scrapes" in tables:
                asked["scrapes"] = _scrapes(tables["scrapes"], needed[0])
            if needed[0] in BY_DATABASE and current is None:
                asked["named"] = True
            if needed[0] in WITH_FACTS:
                asked["facts"] = facts
            rows = job(*[tables[t] for t in needed], **asked)
            if needed[0] in TWICE_FROM:
                shared.append(rows.withColumn("__rank", F.lit(rank)))
            else:
                sure.append(rows)
    out = [mark_nonfinite(rows) for rows in sure]
    if shared:
        marked = mark_nonfinite(union_metrics(*shared))
        twice = F.col("name").isin(TWICE)
        # Rejected rows are not folded: each has a number of its own.
        own = F.when(F.col(OUTCOME) != GOOD, F.monotonically_increasing_id())
        deduped = dedupe_series(
            marked.where(twice).withColumn("__own", own), F.col("__rank"), [OUTCOME, "__own"]
        )
        out += [deduped.drop("__own"), marked.where(~twice).drop("__rank")]
    return union_metrics(*out)


def collect(
    tables: dict[str, DataFrame], agent: list[DataFrame] | None = None
) -> tuple[DataFrame, DataFrame]:
    """``collect_marked`` as two tables, for callers that want one of them."""
    marked = collect_marked(tables, agent)
    good = F.col(OUTCOME) == GOOD
    return marked.where(good).drop(OUTCOME), marked.where(~good).drop(OUTCOME)
