"""Key listings and queue tables bound to the benchmark tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gaugeworks.functions.records import record
from gaugeworks.plans.common import base_sql, flat, land, long_sql, query, s, spread, table
from gaugeworks.schema import KEYS
from gaugeworks.sources import queues

c = F.col


def item_keys(spark, sf, key: Column, kind: Column, size: Column, value: Column | None = None):
    """One key row per lineitem, with the supplier as the target.

    The generator keeps later filters above the rendering of the keys, as they would be above
    the scan of a stored listing.
    """
    none = F.lit(None).cast("string")
    row = record(key=key, kind=kind, size=size.cast("bigint"), value=none if value is None else value)
    items = table(spark, sf, "lineitem").select("l_suppkey", F.inline(F.array(row)))
    names = ("key", "kind", "size", "value")
    return land(items, 1, s("s", c("l_suppkey")), F.lit("r"), **{n: c(n) for n in names})


ITEM_SRC = (
    "(SELECT *, 1 AS cycle_id, 's' || l_suppkey AS target, 'r' AS instance, "
    "'q' || (l_partkey % 300) AS q, CAST(l_quantity AS BIGINT) AS qty FROM lineitem)"
)

# ---- BullMQ

# Line number to key suffix and kind.
BULL = {
    1: ("wait", "list"),
    2: ("active", "list"),
    3: ("delayed", "zset"),
    4: ("failed", "zset"),
    5: ("completed", "zset"),
    6: ("paused", "list"),
    7: ("meta", "hash"),
}
BULL_STATE = {1: "waiting", 2: "active", 3: "delayed", 4: "failed", 5: "completed", 6: "paused"}


def bull_keys(spark, sf) -> DataFrame:
    line = c("l_linenumber").cast("int")

    def pick(i: int) -> Column:
        return F.element_at(F.array(*[F.lit(v[i]) for v in BULL.values()]), line)

    # Part keys that divide by 4 spell a longer key, which belongs to no known suffix.
    tail = F.when(c("l_partkey") % 4 == 0, F.lit(":x")).otherwise("")
    key = s("bull:q", c("l_partkey") % 300, ":", pick(0), F.when(line == 7, F.lit("")).otherwise(tail))
    return item_keys(spark, sf, key, pick(1), c("l_quantity"))


_bull = (
    "(SELECT cycle_id, target, instance, q, "
    + ", ".join(
        f"coalesce(sum(qty) FILTER (WHERE l_linenumber = {i} AND l_partkey % 4 <> 0), 0) AS {n}"
        for i, n in BULL_STATE.items()
    )
    + f" FROM {ITEM_SRC} GROUP BY cycle_id, target, instance, q "
    "HAVING count(*) FILTER (WHERE l_linenumber = 7) > 0)"
)
_summed = [n for n in BULL_STATE.values() if n != "paused"]


@query(
    "queue_sizes",
    long_sql(
        f"(SELECT * FROM {_bull})",
        [(f"messaging.bullmq.queue.{n}", n, "{jobs}") for n in BULL_STATE.values()],
        base_sql("bullmq", {"messaging.destination.name": "q"}),
    )
    + " UNION ALL "
    + long_sql(
        "(SELECT cycle_id, target, instance, count(*) AS n, "
        + ", ".join(f"sum({n}) AS {n}" for n in _summed)
        + f" FROM {_bull} GROUP BY cycle_id, target, instance)",
        [("messaging.bullmq.queues.count", "n", "{queues}")]
        + [(f"messaging.bullmq.jobs.{n}", n, "{jobs}") for n in _summed],
        base_sql("bullmq"),
    ),
)
def queue_sizes(spark, sf):
    return flat(queues.bullmq_jobs(bull_keys(spark, sf)))


@query(
    "key_listing",
    f"SELECT DISTINCT target, q AS queue FROM {ITEM_SRC} WHERE l_linenumber = 7",
)
def key_listing(spark, sf):
    found = queues.bullmq_discovery(bull_keys(spark, sf))
    return found.select(c("target_name").alias("target"), "queue")


# ---- Celery


def celery_keys(spark, sf) -> DataFrame:
    """Line number picks the role: binding, queue list, unacked set, reserved list, results."""
    line, name = c("l_linenumber").cast("int"), s("q", c("l_partkey") % 300)
    named = F.when(c("l_partkey") % 50 == 0, F.lit("celery")).otherwise(name)
    key = (
        F.when(line == 1, s("_kombu.binding.", named))
        .when(line.isin(2, 3), named)
        .when(line == 4, s(named, queues.CELERY_UNACKED))
        .when(line == 5, s(named, ":reserved"))
        .when(line == 6, s("celery-task-meta-", c("l_orderkey")))
        .otherwise(s("_kombu.binding."))
    )
    kinds = F.array(*[F.lit(x) for x in ("set", "list", "list", "zset", "list", "string", "set")])
    return item_keys(spark, sf, key, F.element_at(kinds, line), c("l_quantity"))


_named = "CASE WHEN l_partkey % 50 = 0 THEN 'celery' ELSE q END"
_celery = (
    "(SELECT *, CASE WHEN z = 0 THEN l ELSE z END AS reserved FROM "
    "(SELECT cycle_id, target, instance, nm, coalesce(sum(qty) FILTER (WHERE l_linenumber IN (2, 3)), 0) "
    "AS pending, coalesce(sum(qty) FILTER (WHERE l_linenumber = 4), 0) AS z, "
    "coalesce(sum(qty) FILTER (WHERE l_linenumber = 5), 0) AS l FROM "
    f"(SELECT *, {_named} AS nm FROM {ITEM_SRC}) GROUP BY cycle_id, target, instance, nm "
    "HAVING nm = 'celery' OR count(*) FILTER (WHERE l_linenumber = 1) > 0))"
)


@query(
    "celery_tasks",
    long_sql(
        f"(SELECT * FROM {_celery})",
        [
            ("messaging.celery.queue.pending", "pending", "{tasks}"),
            ("messaging.celery.queue.reserved", "reserved", "{tasks}"),
        ],
        base_sql("celery", {"messaging.destination.name": "nm"}),
    )
    + " UNION ALL "
    + long_sql(
        "(SELECT cycle_id, target, instance, count(*) AS n, "
        "sum(pending) AS p, sum(reserved) AS r "
        f"FROM {_celery} GROUP BY cycle_id, target, instance)",
        [
            ("messaging.celery.queues.count", "n", "{queues}"),
            ("messaging.celery.tasks.pending", "p", "{tasks}"),
            ("messaging.celery.tasks.reserved", "r", "{tasks}"),
        ],
        base_sql("celery"),
    )
    + " UNION ALL "
    + long_sql(
        "(SELECT cycle_id, target, instance, "
        "count(*) FILTER (WHERE l_linenumber = 6) AS n "
        f"FROM {ITEM_SRC} GROUP BY cycle_id, target, instance)",
        [("messaging.celery.results.count", "n", "{results}")],
        base_sql("celery"),
    ),
)
def celery_tasks(spark, sf):
    return flat(queues.celery_tasks(celery_keys(spark, sf)))


@query(
    "celery_discovery",
    f"SELECT DISTINCT target, {_named} AS queue FROM {ITEM_SRC} WHERE l_linenumber = 1 "
    f"UNION SELECT DISTINCT target, 'celery' AS queue FROM {ITEM_SRC}",
)
def celery_discovery(spark, sf):
    found = queues.celery_discovery(celery_keys(spark, sf))
    return found.select(c("target_name").alias("target"), "queue")


# ---- Sidekiq


def sidekiq_keys(spark, sf) -> DataFrame:
    """Line number picks the role: queue member, queue list, process member, process hash, counters."""
    line = c("l_linenumber").cast("int")
    q, proc = s("q", c("l_partkey") % 300), s("p", c("l_partkey") % 300)
    keys = [
        F.lit("queues"), s("queue:", q), F.lit("processes"), proc, F.lit("stat:processed"),
        F.lit("retry"), F.lit("other"),
    ]
    kinds = ["set", "list", "set", "hash", "string", "zset", "zset"]
    info = F.when(c("l_partkey") % 7 == 0, F.lit("bad")).otherwise(
        s('{"busy":', c("l_partkey") % 300, ',"concurrency":25}')
    )
    values = [
        q, F.lit(None).cast("string"), proc, info,
        F.when(c("l_orderkey") % 2 == 0, s(c("l_orderkey"))).otherwise("n/a"),
        F.lit(None).cast("string"), F.lit(None).cast("string"),
    ]
    return item_keys(
        spark,
        sf,
        F.element_at(F.array(*keys), line),
        F.element_at(F.array(*[F.lit(x) for x in kinds]), line),
        c("l_quantity"),
        F.element_at(F.array(*values), line),
    )


_queues = (
    "(SELECT cycle_id, target, instance, q, "
    "coalesce(max(qty) FILTER (WHERE l_linenumber = 2), 0) AS size "
    f"FROM {ITEM_SRC} GROUP BY cycle_id, target, instance, q "
    "HAVING count(*) FILTER (WHERE l_linenumber = 1) > 0)"
)
_processes = (
    "(SELECT cycle_id, target, instance, q, "
    "coalesce(max(CASE WHEN l_linenumber = 4 AND l_partkey % 7 <> 0 THEN l_partkey % 300 END), 0) AS busy, "
    "coalesce(max(CASE WHEN l_linenumber = 4 AND l_partkey % 7 <> 0 THEN 25 END), 0) AS conc "
    f"FROM {ITEM_SRC} GROUP BY cycle_id, target, instance, q "
    "HAVING count(*) FILTER (WHERE l_linenumber = 3) > 0)"
)
_by = "GROUP BY cycle_id, target, instance"


@query(
    "sidekiq_state",
    long_sql(
        f"(SELECT * FROM {_queues})",
        [("messaging.sidekiq.queue.size", "size", "{jobs}")],
        base_sql("sidekiq", {"messaging.destination.name": "q"}),
    )
    + " UNION ALL "
    + long_sql(
        f"(SELECT cycle_id, target, instance, count(*) AS n, "
        f"sum(size) AS e FROM {_queues} {_by})",
        [
            ("messaging.sidekiq.queues.count", "n", "{queues}"),
            ("messaging.sidekiq.enqueued", "e", "{jobs}"),
        ],
        base_sql("sidekiq"),
    )
    + " UNION ALL "
    + long_sql(
        f"(SELECT cycle_id, target, instance, count(*) AS n, sum(busy) AS b, sum(conc) AS cc "
        f"FROM {_processes} {_by})",
        [
            ("messaging.sidekiq.processes", "n", "{processes}"),
            ("messaging.sidekiq.busy", "b", "{workers}"),
            ("messaging.sidekiq.concurrency", "cc", "{workers}"),
        ],
        base_sql("sidekiq"),
    )
    + " UNION ALL "
    + long_sql(
        "(SELECT cycle_id, target, instance, coalesce(max(CASE WHEN l_linenumber = 5 AND "
        "l_orderkey % 2 = 0 THEN l_orderkey END), 0) AS p, "
        f"coalesce(max(qty) FILTER (WHERE l_linenumber = 6), 0) AS r FROM {ITEM_SRC} {_by})",
        [
            ("messaging.sidekiq.processed", "p", "{jobs}"),
            ("messaging.sidekiq.failed", "0", "{jobs}"),
            ("messaging.sidekiq.scheduled", "0", "{jobs}"),
            ("messaging.sidekiq.retries", "r", "{jobs}"),
            ("messaging.sidekiq.dead", "0", "{jobs}"),
        ],
        base_sql("sidekiq"),
    ),
)
def sidekiq_state(spark, sf):
    return flat(queues.sidekiq(sidekiq_keys(spark, sf)))


# ---- SQS

_sqs = (
    "(SELECT *, 1 AS cycle_id, p_type AS target, "
    "CASE WHEN p_type LIKE '%STEEL' THEN 'sqs.local:4566' ELSE 'eu-west-1' END AS instance FROM part)"
)
_place = {"cloud.provider": "'aws'", "cloud.region": "CASE WHEN instance LIKE '%:%' THEN 'local' ELSE instance END"}


@query(
    "sqs_queues",
    long_sql(
        f"(SELECT * FROM {_sqs})",
        [
            ("messaging.sqs.queue.visible", "p_size", "{messages}"),
            ("messaging.sqs.queue.in_flight", "CASE WHEN p_size % 3 <> 0 THEN p_partkey END", "{messages}"),
            (
                "messaging.sqs.queue.delayed",
                "CASE WHEN p_size % 4 = 0 THEN 0 WHEN p_size % 4 = 1 THEN p_partkey * 2 END",
                "{messages}",
            ),
        ],
        base_sql("sqs", {**_place, "messaging.destination.name": "p_name || '-' || p_partkey"}),
    )
    + " UNION ALL "
    + long_sql(
        f"(SELECT cycle_id, target, instance, count(*) AS n FROM {_sqs} GROUP BY ALL)",
        [("messaging.sqs.queues.count", "n", "{queues}")],
        base_sql("sqs", _place),
    ),
)
def sqs_queues(spark, sf):
    key, size = c("p_partkey"), c("p_size")
    names = [F.lit(a) for a, _ in queues.SQS_ATTRIBUTES]
    values = [
        s(size),
        F.when(size % 3 != 0, s(key)),
        F.when(size % 4 == 0, F.lit("many")).when(size % 4 == 1, s(key * 2)),
    ]
    given = F.map_filter(
        F.map_from_arrays(F.array(*names), F.array(*values)), lambda a, v: v.isNotNull()
    )
    listed = land(
        spread(table(spark, sf, "part"), "p_partkey"),
        1,
        c("p_type"),
        F.when(c("p_type").endswith("STEEL"), "sqs.local:4566").otherwise("eu-west-1"),
        pos=key,
        queue_url=s("https://h/1/", c("p_name"), "-", key),
        attributes=given,
    )
    return flat(queues.sqs_queues(listed))


@query(
    "tube_list",
    "SELECT s_suppkey, CAST(i - 1 AS BIGINT) AS pos, 'tube ' || i AS tube FROM supplier, "
    "generate_series(1, 90) AS g(i) WHERE i <= s_suppkey % 91",
)
def tube_list(spark, sf):
    some = F.slice(F.sequence(F.lit(1), F.lit(90)), F.lit(1), (c("s_suppkey") % 91).cast("int"))
    body = F.concat(
        F.lit("OK 9\r\n---\r\n"), F.array_join(F.transform(some, lambda i: s("- tube ", i, "\r\n")), "")
    )
    lists = land(
        spread(table(spark, sf, "supplier"), "s_suppkey"),
        c("s_suppkey"),
        c("s_name"),
        F.lit("b"),
        target_type=F.lit("beanstalkd"),
        endpoint=F.lit("list-tubes"),
        body=body,
    )
    tubes = queues.beanstalkd_tube_list(lists)
    return tubes.select(c(KEYS[0]).alias("s_suppkey"), c("pos").cast("bigint").alias("pos"), "tube")
