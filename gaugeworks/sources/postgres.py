"""PostgreSQL statistics tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gaugeworks.functions.attrs import base_attrs
from gaugeworks.functions.numbers import micros, ratio
from gaugeworks.functions.text import clip_chars, qualify
from gaugeworks.operators.aggregate import activity_rollup
from gaugeworks.operators.join import semi_gate
from gaugeworks.operators.ordered import top_desc
from gaugeworks.operators.shape import to_metrics
from gaugeworks.schema import KEYS

TOP = 10
STATEMENTS = "pg_stat_statements"


def only_database(df: DataFrame, dbname: Column | None) -> DataFrame:
    """Rows of the monitored database; ``dbname`` is its name as a column or literal."""
    return df if dbname is None else df.where(F.col("datname") == dbname)


def database_attrs(named: bool) -> Column:
    """Attributes of a database's rows; ``named`` adds its name, so that several databases of a
    target stay several series."""
    return base_attrs("postgres", {"db.postgres.database": F.col("datname")} if named else None)


def stat_database(df: DataFrame, dbname: Column | None = None, named: bool = False) -> DataFrame:
    """13 metrics per database row; the cache hit ratio is 0 when no block was touched."""
    hits = ratio(F.col("blks_hit"), F.col("blks_hit") + F.col("blks_read"), on_zero="zero")
    # Metric name, column, unit.
    specs = [
        ("db.postgres.connections.active", F.col("numbackends"), "{connections}"),
        ("db.postgres.transactions.committed", F.col("xact_commit"), "{transactions}"),
        ("db.postgres.transactions.rolledback", F.col("xact_rollback"), "{transactions}"),
        ("db.postgres.blocks.read", F.col("blks_read"), "{blocks}"),
        ("db.postgres.blocks.hit", F.col("blks_hit"), "{blocks}"),
        ("db.postgres.cache_hit_ratio", hits, "1"),
        ("db.postgres.rows.returned", F.col("tup_returned"), "{rows}"),
        ("db.postgres.rows.fetched", F.col("tup_fetched"), "{rows}"),
        ("db.postgres.rows.inserted", F.col("tup_inserted"), "{rows}"),
        ("db.postgres.rows.updated", F.col("tup_updated"), "{rows}"),
        ("db.postgres.rows.deleted", F.col("tup_deleted"), "{rows}"),
        ("db.postgres.deadlocks", F.col("deadlocks"), "{deadlocks}"),
        ("db.postgres.temp_bytes", F.col("temp_bytes"), "By"),
    ]
    return to_metrics(only_database(df, dbname), specs, database_attrs(named))


def database_size(df: DataFrame, dbname: Column | None = None, named: bool = False) -> DataFrame:
    specs = [("db.postgres.database_size_bytes", F.col("size_bytes"), "By")]
    return to_metrics(only_database(df, dbname), specs, database_attrs(named))


def stat_activity(
    df: DataFrame,
    dbname: Column | None = None,
    scrapes: DataFrame | None = None,
    named: bool = False,
) -> DataFrame:
    """Session counts by state and the longest active query.

    ``scrapes`` lists scrapes by the key columns, so that one without any session still
    reports zeros.
    """
    age = (micros(F.col("collected_at")) - micros(F.col("query_start"))) / F.lit(1e6)
    by = [*KEYS, "datname"] if named else KEYS
    rolled = activity_rollup(only_database(df, dbname).withColumn("age_s", age), by)
    if scrapes is not None:
        rolled = scrapes.select(*KEYS).join(rolled, KEYS, "full").fillna(0)
    specs = [
        ("db.postgres.connections.idle", F.col("idle"), "{connections}"),
        ("db.postgres.connections.active", F.col("active"), "{connections}"),
        ("db.postgres.connections.waiting", F.col("waiting"), "{connections}"),
        ("db.postgres.longest_query_seconds", F.col("longest_s"), "s"),
    ]
    return to_metrics(rolled, specs, database_attrs(named))


def user_tables(df: DataFrame, n: int = TOP) -> DataFrame:
    """Tables with the most sequential scans; ranked before absent counters become 0."""
    top = top_desc(df, KEYS, "seq_scan", ["schemaname", "relname"], n)

    def count(column: str) -> Column:
        return F.coalesce(F.col(column), F.lit(0))

    specs = [
        ("db.postgres.table.seq_scan", count("seq_scan"), "{scans}"),
        ("db.postgres.table.idx_scan", count("idx_scan"), "{scans}"),
        ("db.postgres.table.dead_tuples", count("n_dead_tup"), "{tuples}"),
        ("db.postgres.table.live_tuples", count("n_live_tup"), "{tuples}"),
    ]
    table = qualify(F.col("schemaname"), F.col("relname"))
    return to_metrics(top, specs, base_attrs("postgres", {"db.sql.table": table}))


def statements(
    df: DataFrame, extensions: DataFrame, n: int = TOP, clip: int | None = None
) -> DataFrame:
    """Slowest statements, for targets that have the statements extension. ``clip`` cuts the
    statement text to so many characters."""
    gated = semi_gate(df, extensions, KEYS, STATEMENTS)
    top = top_desc(gated, KEYS, "mean_exec_time", ["queryid"], n)
    attrs = base_attrs(
        "postgres",
        {"db.statement": F.col("query") if clip is None else clip_chars(F.col("query"), clip), "db.query_id": F.col("queryid")},
    )
    specs = [
        ("db.postgres.query.avg_time_ms", F.col("mean_exec_time"), "ms"),
        ("db.postgres.query.calls", F.col("calls"), "{calls}"),
    ]
    return to_metrics(top, specs, attrs)
