"""The agent's own tables, bound to the events table.

Events are read as a probe log: the user is the collector, an ``error`` event is a failure.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gaugeworks.operators.agent import (
    attempt_outcome,
    health_rows,
    health_summary,
    heartbeat,
    readiness,
    send_outcome,
)
from gaugeworks.operators.ordered import collector_health, failure_runs, latest_run, status_of
from gaugeworks.plans.common import flat, query, s, table

c = F.col
HOUR_US = 3_600_000_000


def probes(spark, sf) -> DataFrame:
    """Event rows with the outcome of a probe."""
    return table(spark, sf, "events").select(
        "event_id",
        "user_id",
        "ts",
        (c("event_type") != "error").alias("ok"),
        F.when(c("event_type") == "error", s("dial http://u:p@h", c("event_id"))).alias("error"),
    )


_RUNS = (
    "(SELECT event_id, user_id, ts, event_type, island, "
    "count(*) FILTER (WHERE event_type = 'error') OVER "
    "(PARTITION BY user_id, island ORDER BY ts) AS fails, "
    "max(CASE WHEN event_type <> 'error' THEN ts END) OVER (PARTITION BY user_id ORDER BY ts) AS good "
    "FROM (SELECT *, count(*) FILTER (WHERE event_type <> 'error') OVER "
    "(PARTITION BY user_id ORDER BY ts) AS island FROM events))"
)
_STATUS = "CASE WHEN {f} >= 5 THEN 'open' WHEN {f} > 0 THEN 'degraded' ELSE 'ok' END"
_HEALTH = "CASE WHEN {f} >= 5 THEN 0 WHEN {f} > 0 THEN 0.5 ELSE 1 END"


@query(
    "failure_runs",
    "SELECT event_id, CAST(fails AS BIGINT) AS consecutive_failures, good AS last_success, "
    "CASE WHEN event_type = 'error' THEN 'dial http://***@h' || event_id END AS last_error, "
    f"{_STATUS.format(f='fails')} AS status, CAST({_HEALTH.format(f='fails')} AS DOUBLE) AS health "
    f"FROM {_RUNS}",
)
def runs(spark, sf):
    found = failure_runs(probes(spark, sf), ["user_id"], "ts", error="error")
    return collector_health(found).select(
        "event_id", "consecutive_failures", "last_success", "last_error", "status", "health"
    )


@query(
    "collector_health",
    "SELECT user_id, good AS last_success, CAST(fails AS BIGINT) AS consecutive_failures, "
    "CASE WHEN fails > 0 THEN 'dial http://***@h' || event_id END AS last_error, "
    f"{_STATUS.format(f='fails')} AS status, CAST({_HEALTH.format(f='fails')} AS DOUBLE) AS health "
    f"FROM {_RUNS} QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1",
)
def health(spark, sf):
    return collector_health(latest_run(probes(spark, sf), ["user_id"], "ts", error="error"))


# Several attempts of one time, ordered by their number, and outcomes that nobody knows.
_TIES = (
    "(SELECT event_id, user_id, date_trunc('day', ts) AS ts, "
    "CASE WHEN event_id % 4 <> 0 THEN event_type <> 'error' END AS ok FROM events)"
)
_TIED = (
    "(SELECT *, count(*) FILTER (WHERE ok IS NOT TRUE) OVER (PARTITION BY user_id, island ORDER BY ts, event_id) AS fails, "
    "max(CASE WHEN ok THEN ts END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS good FROM "
    "(SELECT *, count(*) FILTER (WHERE ok) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island "
    f"FROM {_TIES}))"
)


@query(
    "failure_ties",
    "SELECT r.event_id, CAST(r.fails AS BIGINT) AS consecutive_failures, r.good AS last_success, "
    "CAST(l.fails AS BIGINT) AS latest_failures, l.good AS latest_success "
    f"FROM {_TIED} r JOIN (SELECT * FROM {_TIED} "
    "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1) l USING (user_id)",
)
def ties(spark, sf):
    """Each attempt's run next to its collector's latest one."""
    tries = table(spark, sf, "events").select(
        "event_id",
        "user_id",
        F.date_trunc("day", "ts").cast("timestamp_ntz").alias("ts"),
        F.when(c("event_id") % 4 != 0, c("event_type") != "error").alias("ok"),
    )
    latest = latest_run(tries, ["user_id"], "ts", seq="event_id").select(
        "user_id",
        c("consecutive_failures").alias("latest_failures"),
        c("last_success").alias("latest_success"),
    )
    return failure_runs(tries, ["user_id"], "ts", seq="event_id").join(latest, "user_id").select(
        "event_id", "consecutive_failures", "last_success", "latest_failures", "latest_success"
    )


# ---- Attempts and sends

# Three consecutive events form the attempts of one collection.
_TRIES = (
    "(SELECT *, event_id // 3 AS cyc, event_id % 3 + 1 AS no, event_id % 9 * 1250 AS ms, "
    "event_type IN ('view', 'click') AS good FROM events)"
)


@query(
    "attempts_outcome",
    "SELECT cyc AS cycle_id, ok, CASE WHEN ok THEN CAST(used AS VARCHAR) ELSE 'none' END AS used, "
    "CASE WHEN NOT ok THEN err END AS error FROM (SELECT cyc, bool_or(good AND ms <= 8000) AS ok, "
    "min(CASE WHEN good AND ms <= 8000 THEN no END) AS used, "
    "arg_max(CASE WHEN good THEN 'deadline exceeded' ELSE event_type END, no) AS err "
    f"FROM {_TRIES} GROUP BY cyc)",
)
def attempts(spark, sf):
    tries = table(spark, sf, "events").select(
        F.expr("event_id div 3").alias("cycle_id"),
        (c("event_id") % 3 + 1).alias("attempt_no"),
        (c("event_id") % 9 * 1250).alias("duration_ms"),
        c("event_type").isin("view", "click").alias("ok"),
        c("event_type").alias("error"),
    )
    done = attempt_outcome(tries, ["cycle_id"])
    used = F.when(c("ok"), c("attempts_used").cast("string")).otherwise("none")
    return done.select("cycle_id", "ok", used.alias("used"), "error")


# Five consecutive events form the sends of one batch; the fifth is one try too many.
_CODE = (
    "CASE event_type WHEN 'view' THEN 204 WHEN 'click' THEN 500 WHEN 'signup' THEN 429 "
    "WHEN 'purchase' THEN 302 ELSE 503 END"
)


@query(
    "send_outcome",
    "SELECT batch, bool_or(code < 300) AS ok, "
    "CAST(coalesce(min(CASE WHEN code < 300 THEN no END), max(no)) AS BIGINT) AS tries FROM "
    f"(SELECT event_id // 5 AS batch, event_id % 5 + 1 AS no, {_CODE} AS code FROM events) "
    "WHERE no <= 4 GROUP BY batch",
)
def sends_outcome(spark, sf):
    sends = table(spark, sf, "events").select(
        F.expr("event_id div 5").alias("batch"),
        (c("event_id") % 5 + 1).alias("try_no"),
        F.expr(_CODE).alias("status"),
    )
    return send_outcome(sends, ["batch"])


# ---- Heartbeat, health and readiness


@query(
    "heartbeat",
    "SELECT cycle_id, target, 'agent.up' AS name, CAST(1 AS DOUBLE) AS value, '1' AS unit, "
    "'agent.type=gaugeworks;agent.version=1.0' AS attrs FROM "
    "(SELECT DISTINCT CAST(date_diff('hour', TIMESTAMP '2024-01-01', date_trunc('hour', ts)) AS BIGINT) "
    "AS cycle_id, 'agent' || user_id AS target FROM events) UNION ALL "
    "SELECT event_id, 'u' || user_id, 'agent.collector.health', "
    f"CAST({_HEALTH.format(f='fails')} AS DOUBLE), '1', "
    f"'agent.collector.name=u' || user_id || ';agent.collector.status=' || {_STATUS.format(f='fails')} "
    f"|| ';agent.collector.type=probe' FROM {_RUNS}",
)
def heartbeats(spark, sf):
    hours = F.floor(
        (F.unix_timestamp("ts") - F.unix_timestamp(F.lit("2024-01-01 00:00:00"))) / 3600
    )
    cycles = (
        table(spark, sf, "events")
        .select(hours.alias("cycle_id"), s("agent", c("user_id")).alias("target"))
        .distinct()
        .withColumn("ts", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    )
    found = failure_runs(probes(spark, sf), ["user_id"], "ts")
    status = found.select(
        "ts",
        c("event_id").alias("cycle_id"),
        s("u", c("user_id")).alias("target"),
        F.lit("probe").alias("type"),
        status_of(c("consecutive_failures")).alias("status"),
    )
    return flat(heartbeat(cycles).unionByName(health_rows(status)))


_SENT = (
    "(SELECT *, event_type <> 'error' AS ok FROM events)"
)


@query(
    "health_summary",
    "SELECT grp, n AS collectors, bad AS open_collectors, last_ok AS last_send_ok, "
    "CASE WHEN bad > 0 THEN 'degraded' ELSE 'ok' END AS status, "
    "CASE WHEN NOT last_flag THEN 'e' || last_id END AS last_send_error, uptime_s FROM "
    "(SELECT user_id % 7 AS grp, count(*) AS n, "
    "count(*) FILTER (WHERE fails >= 2) AS bad FROM (SELECT * FROM "
    f"{_RUNS} QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1) GROUP BY 1) "
    "JOIN (SELECT user_id % 7 AS grp, max(ts) FILTER (WHERE ok) AS last_ok, arg_max(ok, ts) AS last_flag, "
    f"arg_max(event_id, ts) AS last_id FROM {_SENT} GROUP BY 1) USING (grp) "
    "JOIN (SELECT user_id % 7 AS grp, CAST(epoch_us(max(ts)) - epoch_us(min(ts)) AS DOUBLE) / 1000000 AS uptime_s "
    "FROM events GROUP BY 1) USING (grp)",
)
def summary(spark, sf):
    latest = latest_run(probes(spark, sf), ["user_id"], "ts")
    status = latest.select(
        (c("user_id") % 7).alias("grp"),
        status_of(c("consecutive_failures"), threshold=2).alias("status"),
    )
    sends = table(spark, sf, "events").select(
        (c("user_id") % 7).alias("grp"),
        "ts",
        (c("event_type") != "error").alias("ok"),
        s("e", c("event_id")).alias("error"),
    )
    starts = sends.groupBy("grp").agg(F.min("ts").alias("started_at"), F.max("ts").alias("asked_at"))
    return health_summary(status, sends, ["grp"], starts)


@query(
    "readiness",
    "SELECT user_id, CASE WHEN first_ok IS NULL OR first_ok > asked THEN NOT asked - started "
    "> INTERVAL 30 SECOND ELSE true END AS ready FROM (SELECT user_id, min(ts) AS started, "
    "min(ts) + INTERVAL 1 SECOND * (user_id % 2 * 3600 + 30) AS asked, "
    f"min(ts) FILTER (WHERE ok) AS first_ok FROM {_SENT} GROUP BY user_id)",
)
def ready(spark, sf):
    events = table(spark, sf, "events")
    wait = F.make_dt_interval(secs=(c("user_id") % 2 * 3600 + 30).cast("decimal(18,6)"))
    starts = events.groupBy("user_id").agg(F.min("ts").alias("started_at")).withColumn(
        "asked_at", c("started_at") + wait
    )
    sends = events.select("user_id", "ts", (c("event_type") != "error").alias("ok"))
    return readiness(starts, sends, ["user_id"]).select("user_id", "ready")
