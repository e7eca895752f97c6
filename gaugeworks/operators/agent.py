"""The agent's own tables: attempt and send outcomes, heartbeat, health, readiness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from gaugeworks.functions.attrs import make_attrs
from gaugeworks.functions.numbers import micros
from gaugeworks.functions.records import record
from gaugeworks.operators.ordered import STATUS_CODE
from gaugeworks.schema import METRIC_COLUMNS

# Settings of the collection and send loops.
MAX_ATTEMPTS = 3
ATTEMPT_LIMIT_MS = 8000
MAX_SENDS = 4
READY_GRACE_S = 30
AGENT_TYPE = "gaugeworks"
AGENT_VERSION = "1.0"


def attempt_outcome(
    attempts: DataFrame,
    keys: Sequence[str],
    max_attempts: int = MAX_ATTEMPTS,
    limit_ms: int = ATTEMPT_LIMIT_MS,
) -> DataFrame:
    """Whether a collection succeeded within its attempts, else the error of the last one."""
    counted = attempts.where(F.col("attempt_no") <= max_attempts)
    good = F.col("ok") & (F.col("duration_ms") <= limit_ms)
    late = F.when(F.col("ok"), F.lit("deadline exceeded")).otherwise(F.col("error"))
    grouped = counted.groupBy(*keys).agg(
        F.bool_or(good).alias("ok"),
        F.min(F.when(good, F.col("attempt_no"))).cast("bigint").alias("attempts_used"),
        F.max(record(attempt_no=F.col("attempt_no"), error=late)).alias("__last"),
    )
    return grouped.withColumn(
        "error", F.when(~F.col("ok"), F.col("__last.error"))
    ).drop("__last")


def send_outcome(sends: DataFrame, keys: Sequence[str], max_sends: int = MAX_SENDS) -> DataFrame:
    """Whether a batch was delivered within its tries. Every error is retried, 4xx too."""
    good = F.col("status") < 300
    return (
        sends.where(F.col("try_no") <= max_sends)
        .groupBy(*keys)
        .agg(
            F.bool_or(good).alias("ok"),
            F.coalesce(F.min(F.when(good, F.col("try_no"))), F.max("try_no"))
            .cast("bigint")
            .alias("tries"),
        )
    )


def heartbeat(
    cycles: DataFrame, agent_type: str = AGENT_TYPE, agent_version: str = AGENT_VERSION
) -> DataFrame:
    """One ``agent.up`` row per cycle; ``cycles`` has ts, cycle_id and target (the agent)."""
    attrs = make_attrs({"agent.type": F.lit(agent_type), "agent.version": F.lit(agent_version)})
    return cycles.select(
        "ts",
        "cycle_id",
        "target",
        F.lit("agent.up").alias("name"),
        F.lit(1.0).alias("value"),
        F.lit("1").alias("unit"),
        attrs.alias("attrs"),
    ).select(*METRIC_COLUMNS)


def health_rows(status: DataFrame) -> DataFrame:
    """One ``agent.collector.health`` row per collector and cycle.

    ``status`` has ts, cycle_id, target, type, status. The target name is an attribute, so
    that two collectors of one type stay two series.
    """
    attrs = make_attrs(
        {
            "agent.collector.type": F.col("type"),
            "agent.collector.status": F.col("status"),
            "agent.collector.name": F.col("target"),
        }
    )
    code = F.create_map(*[F.lit(x) for kv in STATUS_CODE.items() for x in kv])
    return status.select(
        "ts",
        "cycle_id",
        "target",
        F.lit("agent.collector.health").alias("name"),
        code[F.col("status")].alias("value"),
        F.lit("1").alias("unit"),
        attrs.alias("attrs"),
    ).select(*METRIC_COLUMNS)


def health_summary(
    status: DataFrame, sends: DataFrame, keys: Sequence[str], starts: DataFrame | None = None
) -> DataFrame:
    """Agent health: degraded when any collector is open, last good send, last send error.

    With ``starts`` (the keys, started_at, asked_at) also ``uptime_s``, the seconds the agent had
    been up when it was asked; NULL where its start is unknown.
    """
    collectors = status.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("collectors"),
        F.count_if(F.col("status") == "open").alias("open_collectors"),
    )
    last = F.max(F.struct("ts", "ok", "error"))
    sent = sends.groupBy(*keys).agg(
        F.max(F.when(F.col("ok"), F.col("ts"))).alias("last_send_ok"), last.alias("__last")
    )
    summary = (
        collectors.join(sent, list(keys), "left")
        .withColumn("status", F.when(F.col("open_collectors") > 0, "degraded").otherwise("ok"))
        .withColumn("last_send_error", F.when(~F.col("__last.ok"), F.col("__last.error")))
        .drop("__last")
    )
    if starts is None:
        return summary
    up = (micros(F.col("asked_at")) - micros(F.col("started_at"))) / F.lit(1e6)
    return summary.join(starts.select(*keys, up.alias("uptime_s")), list(keys), "left")


def readiness(
    starts: DataFrame, sends: DataFrame, keys: Sequence[str], grace_s: int = READY_GRACE_S
) -> DataFrame:
    """Not ready only if nothing was ever sent and the grace time is over.

    ``starts`` has the keys, started_at and asked_at.
    """
    sent = sends.where(F.col("ok")).groupBy(*keys).agg(F.min("ts").alias("first_ok"))
    never = F.col("first_ok").isNull() | (F.col("first_ok") > F.col("asked_at"))
    over = (micros(F.col("asked_at")) - micros(F.col("started_at"))) > grace_s * 1_000_000
    return starts.join(sent, list(keys), "left").select(
        *starts.columns, (~(never & over)).alias("ready")
    )
