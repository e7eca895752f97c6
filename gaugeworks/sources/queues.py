"""Job queues kept in Redis (BullMQ, Celery, Sidekiq), SQS, and Beanstalkd.

``redis_keys`` is a landed key listing: one row per key with its kind and size. Sets
have one row per member (the member is ``value``), strings carry their text, and a
hash row carries its ``info`` field. Each job is one scan with a prefix filter and one
aggregation by queue name; discovery and sizes come out of the same pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from gaugeworks.functions.attrs import base_attrs
from gaugeworks.functions.numbers import num_zero
from gaugeworks.functions.records import record
from gaugeworks.functions.text import key_part, strip_prefix, url_tail, yaml_items, yaml_pairs
from gaugeworks.operators.aggregate import distinct_names
from gaugeworks.operators.shape import keyed, kv_specs, once, to_metric_groups, to_metrics
from gaugeworks.schema import KEYS
from gaugeworks.sources.documents import KEEP_FIELDS

# ---- BullMQ

# Key spellings and suffixes.
BULL_PREFIX = "bull"
BULL_STATES = ["waiting", "active", "delayed", "failed", "completed", "paused"]
BULL_SUFFIX = {"waiting": "wait"}
BULL_LISTS = ["waiting", "active", "paused"]


def bullmq_discovery(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Distinct queue names out of ``bull:<queue>:meta`` keys."""
    meta = df.where(F.col("key").like(f"{BULL_PREFIX}:%:meta"))
    return distinct_names(meta.withColumn("queue", key_part(F.col("key"), 2)), keys, "queue")


def _bull_sizes(df: DataFrame) -> DataFrame:
    listed = df.where(F.col("key").startswith(BULL_PREFIX + ":")).select(
        *KEYS, "kind", F.coalesce("size", F.lit(0)).alias("size"), F.split("key", ":").alias("parts")
    )
    parts, n = F.col("parts"), F.size("parts")
    named = listed.select(
        *KEYS,
        F.get(parts, F.lit(1)).alias("queue"),
        F.when(n == 3, F.get(parts, F.lit(2))).alias("suffix"),
        ((n >= 3) & (F.get(parts, n - 1) == "meta")).alias("meta"),
        "kind",
        "size",
    )

    def total(state: str) -> Column:
        kinds = ["zset", "list"] if state in BULL_LISTS else ["zset"]
        hit = (F.col("suffix") == BULL_SUFFIX.get(state, state)) & F.col("kind").isin(kinds)
        return F.coalesce(F.sum(F.when(hit, F.col("size"))), F.lit(0)).alias(state)

    found = F.bool_or("meta").alias("found")
    return named.groupBy(*KEYS, "queue").agg(found, *[total(s) for s in BULL_STATES]).where("found")


def _totals(queues: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Number of queues of a scrape as ``n``, and ``sum_*`` over all of them."""
    return queues.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(f"sum_{c}") for c in cols]
    )


def bullmq_jobs(df: DataFrame) -> DataFrame:
    """Six gauges per queue and the totals over all queues."""
    sizes = _bull_sizes(df)
    summed = [s for s in BULL_STATES if s != "paused"]
    rows = [(f"messaging.bullmq.queue.{s}", F.col(s), "{jobs}") for s in BULL_STATES]
    totals = [("messaging.bullmq.queues.count", F.col("n"), "{queues}")]
    totals += [(f"messaging.bullmq.jobs.{s}", F.col(f"sum_{s}"), "{jobs}") for s in summed]
    attrs = base_attrs("bullmq", {"messaging.destination.name": F.col("queue")})
    return to_metrics(sizes, rows, attrs).unionByName(
        to_metrics(_totals(sizes, summed), totals, base_attrs("bullmq"))
    )


# ---- Celery

# Key spellings, and the queue that always exists.
CELERY_BINDING = "_kombu.binding."
CELERY_RESULT = "celery-task-meta-"
CELERY_DEFAULT = "celery"
CELERY_UNACKED = "\x06\x16\x06\x16"
CELERY_RESERVED = ":reserved"


def celery_discovery(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Distinct queue names out of binding keys, and the default queue."""
    bound = df.where(F.col("key").startswith(CELERY_BINDING)).withColumn(
        "queue", strip_prefix(F.col("key"), CELERY_BINDING)
    )
    default = df.select(*keys).distinct().withColumn("queue", F.lit(CELERY_DEFAULT))
    named = bound.where("queue <> ''").select(*keys, "queue").unionByName(default)
    return distinct_names(named, keys, "queue")


def celery_tasks(df: DataFrame) -> DataFrame:
    """Pending and reserved tasks per queue, their totals, and the number of results, in one pass."""
    key, kind, size = F.col("key"), F.col("kind"), F.coalesce("size", F.lit(0))
    bound = key.startswith(CELERY_BINDING)
    unacked = key.endswith(CELERY_UNACKED) & (kind == "zset")
    reserved = key.endswith(CELERY_RESERVED) & (kind == "list")

    def cut(tail: str) -> Column:
        return F.left(key, F.length(key) - F.lit(len(tail)))

    # A list that ends in ":reserved" may be a reserved list or a queue of that name. Every key
    # also stands for its scrape (no queue) and for the default queue, which is always there.
    roles = F.array(
        record(queue=F.when(bound, strip_prefix(key, CELERY_BINDING)), role=F.lit("bound")),
        record(queue=F.when(kind == "list", key), role=F.lit("pending")),
        record(queue=F.when(unacked, cut(CELERY_UNACKED)), role=F.lit("zset")),
        record(queue=F.when(reserved, cut(CELERY_RESERVED)), role=F.lit("list")),
        record(queue=F.lit(CELERY_DEFAULT), role=F.lit("bound")),
    )
    named = F.filter(roles, lambda r: r["queue"] != "")
    scrape = record(
        queue=F.lit(None).cast("string"),
        role=F.when(key.startswith(CELERY_RESULT), "result").otherwise("other"),
    )
    listed = df.select(*KEYS, size.alias("size"), F.inline(F.concat(named, F.array(scrape))))

    def sum_of(role: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("role") == role, F.col("size"))), F.lit(0))

    grouped = listed.groupBy(*KEYS, "queue").agg(
        F.bool_or(F.col("role") == "bound").alias("found"),
        sum_of("pending").alias("pending"),
        sum_of("zset").alias("z"),
        sum_of("list").alias("l"),
        F.count_if(F.col("role") == "result").alias("results"),
    )
    whole = Window.partitionBy(*KEYS)
    found = F.col("found")
    sized = grouped.withColumn(
        "reserved", F.when(F.col("z") == 0, F.col("l")).otherwise(F.col("z"))
    ).withColumns(
        {
            "n": F.count_if(found).over(whole),
            "sum_pending": F.sum(F.when(found, F.col("pending"))).over(whole),
            "sum_reserved": F.sum(F.when(found, F.col("reserved"))).over(whole),
        }
    )
    rows = [
        ("messaging.celery.queue.pending", F.col("pending"), "{tasks}"),
        ("messaging.celery.queue.reserved", F.col("reserved"), "{tasks}"),
    ]
    totals = [
        ("messaging.celery.queues.count", F.col("n"), "{queues}"),
        ("messaging.celery.tasks.pending", F.col("sum_pending"), "{tasks}"),
        ("messaging.celery.tasks.reserved", F.col("sum_reserved"), "{tasks}"),
        ("messaging.celery.results.count", F.col("results"), "{results}"),
    ]
    attrs = base_attrs("celery", {"messaging.destination.name": F.col("queue")})
    return to_metric_groups(
        sized, [(found, rows, attrs), (F.col("queue").isNull(), totals, base_attrs("celery"))]
    )


# ---- Sidekiq

SIDEKIQ_INFO = "concurrency bigint, busy bigint, _corrupt_record string"
# Sorted-set key, column.
SIDEKIQ_SETS = {"schedule": "scheduled", "retry": "retries", "dead": "dead"}
# Counter key, column.
SIDEKIQ_COUNTERS = {"stat:processed": "processed", "stat:failed": "failed"}


def sidekiq(df: DataFrame, namespace: str = "") -> DataFrame:
    """Process, queue and job set gauges. A scrape without any queue gives no rows."""
    prefix = f"{namespace}:" if namespace else ""
    key, kind, size = F.col("key"), F.col("kind"), F.coalesce("size", F.lit(0))

    def at(name: str, of: str) -> Column:
        return (key == prefix + name) & (kind == of)

    mine = df.where(key.startswith(prefix)) if prefix else df
    # One entity name per row: a queue (member or list), a process (member or hash), or one of
    # the single keys. All of them come out of one scan and one shuffle.
    queue = F.when(at("queues", "set"), F.col("value")).when(
        key.startswith(prefix + "queue:") & (kind == "list"),
        F.substr(key, F.lit(len(prefix) + len("queue:") + 1)),
    )
    process = F.when(at("processes", "set"), F.col("value")).when(
        kind == "hash", F.substr(key, F.lit(len(prefix) + 1))
    )
    single = F.lit(False)
    for name in SIDEKIQ_COUNTERS:
        single = single | at(name, "string")
    for name in SIDEKIQ_SETS:
        single = single | at(name, "zset")
    info = F.when(kind == "hash", F.from_json("value", SIDEKIQ_INFO, KEEP_FIELDS))
    named = once(mine.where(kind.isin("set", "list", "hash", "string", "zset")), "info", info).select(
        *KEYS,
        queue.alias("queue"),
        process.alias("process"),
        F.when(single, F.substr(key, F.lit(len(prefix) + 1))).alias("single"),
        (kind == "set").alias("listed"),
        F.when(kind == "string", F.col("value").try_cast("bigint")).otherwise(size).alias("size"),
        (kind == "set").alias("is_set"),
        F.when(F.col("info._corrupt_record").isNull(), F.col("info")).alias("info"),
    )
    what = F.when(F.col("queue").isNotNull(), "q").when(F.col("process").isNotNull(), "p")
    entities = (
        named.where("queue is not null or process is not null or single is not null")
        .withColumn("what", what.otherwise("s"))
        .withColumn("entity", F.coalesce("queue", "process", "single"))
        .groupBy(*KEYS, "what", "entity")
        .agg(
            F.bool_or("listed").alias("listed"),
            F.bool_or(F.col("what") == "q").alias("is_queue"),
            F.coalesce(F.max(F.when(~F.col("is_set"), F.col("size"))), F.lit(0)).alias("size"),
            F.coalesce(F.max("info.busy"), F.lit(0)).alias("busy"),
            F.coalesce(F.max("info.concurrency"), F.lit(0)).alias("concurrency"),
        )
    )
    # Both uses below keep the aggregate as it is, so its shuffle is shared: the conditions are
    # on aggregated columns, which cannot be pushed into the scan, and name every one of them,
    # so none is pruned from one use only (queues have no process numbers: both are 0).
    no_process = (F.col("busy") == 0) & (F.col("concurrency") == 0)
    queues = entities.where(F.col("listed") & F.col("is_queue") & no_process)
    is_process = F.col("listed") & (F.col("what") == "p")

    def scalar(name: str, alias: str) -> Column:
        hit = (F.col("what") == "s") & (F.col("entity") == name)
        return F.coalesce(F.max(F.when(hit, F.col("size"))), F.lit(0)).alias(alias)

    counts = entities.groupBy(*KEYS).agg(
        F.count_if(F.col("listed") & F.col("is_queue")).alias("queues"),
        F.sum(F.when(F.col("listed") & F.col("is_queue"), F.col("size"))).alias("enqueued"),
        F.count_if(is_process).alias("processes"),
        F.coalesce(F.sum(F.when(is_process, F.col("busy"))), F.lit(0)).alias("busy"),
        F.coalesce(F.sum(F.when(is_process, F.col("concurrency"))), F.lit(0)).alias("concurrency"),
        *[scalar(k, c) for k, c in {**SIDEKIQ_COUNTERS, **SIDEKIQ_SETS}.items()],
    )
    joined = counts.where("queues > 0")
    # Metric name, column, unit.
    specs = [
        ("messaging.sidekiq.processed", F.col("processed"), "{jobs}"),
        ("messaging.sidekiq.failed", F.col("failed"), "{jobs}"),
        ("messaging.sidekiq.queues.count", F.col("queues"), "{queues}"),
        ("messaging.sidekiq.enqueued", F.col("enqueued"), "{jobs}"),
        ("messaging.sidekiq.scheduled", F.col("scheduled"), "{jobs}"),
        ("messaging.sidekiq.retries", F.col("retries"), "{jobs}"),
        ("messaging.sidekiq.dead", F.col("dead"), "{jobs}"),
        ("messaging.sidekiq.processes", F.col("processes"), "{processes}"),
        ("messaging.sidekiq.busy", F.col("busy"), "{workers}"),
        ("messaging.sidekiq.concurrency", F.col("concurrency"), "{workers}"),
    ]
    sizes = [("messaging.sidekiq.queue.size", F.col("size"), "{jobs}")]
    attrs = base_attrs("sidekiq", {"messaging.destination.name": F.col("entity")})
    return to_metrics(queues, sizes, attrs).unionByName(to_metrics(joined, specs, base_attrs("sidekiq")))


# ---- SQS

# Queue attribute, metric name.
SQS_ATTRIBUTES = [
    ("ApproximateNumberOfMessages", "messaging.sqs.queue.visible"),
    ("ApproximateNumberOfMessagesNotVisible", "messaging.sqs.queue.in_flight"),
    ("ApproximateNumberOfMessagesDelayed", "messaging.sqs.queue.delayed"),
]


def _region() -> Column:
    """The landed instance names the region; an endpoint of its own (host and port) is local."""
    return F.when(F.col("instance").contains(":"), "local").otherwise(F.col("instance"))


def sqs_queues(df: DataFrame, region: Column | None = None) -> DataFrame:
    """Queue count, and the message counts a queue reports."""
    place = {
        "cloud.provider": F.lit("aws"),
        "cloud.region": _region() if region is None else region,
    }
    specs = [
        (
            name,
            F.when(
                F.map_contains_key("attributes", F.lit(key)),
                num_zero(F.try_element_at("attributes", F.lit(key))),
            ),
            "{messages}",
        )
        for key, name in SQS_ATTRIBUTES
    ]
    attrs = base_attrs(
        "sqs", {**place, "messaging.destination.name": url_tail(F.col("queue_url"))}
    )
    count = [("messaging.sqs.queues.count", F.col("n"), "{queues}")]
    return to_metrics(df, specs, attrs).unionByName(
        to_metrics(df.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n")), count, base_attrs("sqs", place))
    )


# ---- Beanstalkd

# Stats key, metric name, unit; first of the server, then of a tube.
BEANSTALKD_STATS = [
    ("current-jobs-ready", "messaging.beanstalkd.jobs.ready", "{jobs}"),
    ("current-jobs-reserved", "messaging.beanstalkd.jobs.reserved", "{jobs}"),
    ("current-jobs-delayed", "messaging.beanstalkd.jobs.delayed", "{jobs}"),
    ("current-jobs-buried", "messaging.beanstalkd.jobs.buried", "{jobs}"),
    ("current-jobs-urgent", "messaging.beanstalkd.jobs.urgent", "{jobs}"),
    ("total-jobs", "messaging.beanstalkd.jobs.total", "{jobs}"),
    ("current-connections", "messaging.beanstalkd.connections.current", "{connections}"),
    ("current-producers", "messaging.beanstalkd.connections.producers", "{connections}"),
    ("current-workers", "messaging.beanstalkd.connections.workers", "{connections}"),
    ("current-waiting", "messaging.beanstalkd.connections.waiting", "{connections}"),
    ("current-tubes", "messaging.beanstalkd.tubes.count", "{tubes}"),
    ("cmd-put", "messaging.beanstalkd.cmd.put", "{commands}"),
    ("cmd-reserve", "messaging.beanstalkd.cmd.reserve", "{commands}"),
    ("cmd-delete", "messaging.beanstalkd.cmd.delete", "{commands}"),
    ("cmd-bury", "messaging.beanstalkd.cmd.bury", "{commands}"),
    ("cmd-kick", "messaging.beanstalkd.cmd.kick", "{commands}"),
    ("job-timeouts", "messaging.beanstalkd.timeouts", "{timeouts}"),
]
BEANSTALKD_TUBE = [
    ("current-jobs-ready", "messaging.beanstalkd.tube.ready", "{jobs}"),
    ("current-jobs-reserved", "messaging.beanstalkd.tube.reserved", "{jobs}"),
    ("current-jobs-delayed", "messaging.beanstalkd.tube.delayed", "{jobs}"),
    ("current-jobs-buried", "messaging.beanstalkd.tube.buried", "{jobs}"),
    ("current-waiting", "messaging.beanstalkd.tube.waiting", "{consumers}"),
    ("total-jobs", "messaging.beanstalkd.tube.total_jobs", "{jobs}"),
]
TUBE_COMMAND = "stats-tube "


def _stats(df: DataFrame, mapping: list, attrs: Column) -> DataFrame:
    parsed = keyed(df, yaml_pairs(F.col("body"), [m[0] for m in mapping]))
    return to_metrics(parsed, kv_specs(mapping), attrs)


def beanstalkd_stats(df: DataFrame) -> DataFrame:
    """Server gauges out of the stats reply."""
    return _stats(df, BEANSTALKD_STATS, base_attrs("beanstalkd"))


def beanstalkd_tube_list(df: DataFrame) -> DataFrame:
    """Tubes of the list reply, in listing order."""
    tubes = yaml_items(F.col("body"))
    return df.select(*KEYS, F.posexplode(tubes).alias("pos", "tube"))


def beanstalkd_tubes(lists: DataFrame, replies: DataFrame) -> DataFrame:
    """Gauges of the listed tubes; each tube has a stats reply under its own endpoint."""
    listed = beanstalkd_tube_list(lists).select(*KEYS, "tube").distinct()
    named = replies.withColumn("tube", strip_prefix(F.col("endpoint"), TUBE_COMMAND))
    shown = named.join(listed, [*KEYS, "tube"], "left_semi")
    attrs = base_attrs("beanstalkd", {"messaging.destination.name": F.col("tube")})
    return _stats(shown, BEANSTALKD_TUBE, attrs)
