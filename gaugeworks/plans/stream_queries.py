"""Streaming twins: the same answers as the batch queries, through a drained stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from gaugeworks.functions.numbers import micros
from gaugeworks.plans import table_queries, text_queries
from gaugeworks.plans.common import ORACLES, SCRAPED, flat, query, table
from gaugeworks.plans.operator_queries import order_metrics
from gaugeworks.schema import KEYS
from gaugeworks.session import run_dir
from gaugeworks.sources import databases, landing, redis
from gaugeworks.sources.sinks import read_batches, write_batch
from gaugeworks.streaming.run import each_batch, metric_stream, run_stream, state_settings
from gaugeworks.streaming.stateful import counter_delta_stream, hold_scrapes

c = F.col
DELIVERIES = 3


def drained(spark: SparkSession, name: str, stream: DataFrame, start=run_stream) -> DataFrame:
    """Run a stream until its input is used up and read back what it wrote."""
    folder = run_dir(spark, name)
    with state_settings(spark):
        start(stream, f"{folder}/out", f"{folder}/checkpoint", drain=True).awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")


def delivered(
    spark: SparkSession, name: str, rows: DataFrame, transform: Callable[[DataFrame], DataFrame], start
) -> str:
    """Land rows in deliveries by their column ``arrival`` and drain the stream after each one, from
    the checkpoint of the last; the folder that was written to. The rows are made once and lie
    apart by delivery."""
    folder = run_dir(spark, name)
    landed = rows.drop("arrival")
    rows.write.partitionBy("arrival").parquet(f"{folder}/rows")
    made = spark.read.schema(rows.schema).parquet(f"{folder}/rows")
    for number in range(DELIVERIES):
        made.where(c("arrival") == number).select(*landed.columns).write.mode("append").parquet(f"{folder}/in")
        stream = transform(spark.readStream.schema(landed.schema).parquet(f"{folder}/in"))
        with state_settings(spark):
            start(stream, f"{folder}/out", f"{folder}/checkpoint", drain=True).awaitTermination()
    return f"{folder}/out"


# Counters beyond what a double holds exactly.
BASE = 1 << 60
_ARRIVING = (
    "(SELECT *, least(2, 3 * (epoch_us(ts) - lo) // (hi - lo + 1) + CASE WHEN event_id % 50 = 0 THEN 1 ELSE 0 END) "
    "AS arrival FROM events, (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM events))"
)


@query(
    "cpu_stream",
    "SELECT event_id, user_id, "
    + ", ".join(
        f"CASE WHEN NOT late THEN CAST({e} + {BASE} AS BIGINT) - CAST(lag({e} + {BASE}) OVER "
        f"(PARTITION BY user_id, late ORDER BY arrival, ts) AS BIGINT) END AS d_{n}"
        for n, e in text_queries.CPU_SQL.items()
    )
    + " FROM (SELECT *, coalesce(ts < max(ts) OVER (PARTITION BY user_id ORDER BY arrival "
    f"RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS late FROM {_ARRIVING})",
)
def cpu_stream(spark, sf):
    """Whole-number counters in three deliveries; some samples come a delivery too late."""
    names = list(text_queries.CPU_SQL)
    events = table(spark, sf, "events")
    lo, hi = events.agg(F.min(micros(c("ts"))), F.max(micros(c("ts")))).first()
    third = F.expr("3 * (us - lo) div (hi - lo + 1)") + F.when(c("event_id") % 50 == 0, 1).otherwise(0)
    counters = events.withColumns({"us": micros(c("ts")), "lo": F.lit(lo), "hi": F.lit(hi)}).select(
        "event_id",
        "user_id",
        "ts",
        *[(v + F.lit(BASE)).cast("bigint").alias(n) for n, v in text_queries.cpu_columns().items()],
        F.least(F.lit(DELIVERIES - 1), third).alias("arrival"),
    )

    def deltas(stream: DataFrame) -> DataFrame:
        found = counter_delta_stream(stream, ["user_id"], "ts", names)
        return found.select("event_id", "user_id", *[f"d_{n}" for n in names])

    out = delivered(spark, "cpu", counters, deltas, run_stream)
    kinds = ", ".join(f"d_{n} bigint" for n in names)
    return spark.read.schema(f"event_id bigint, user_id bigint, {kinds}").parquet(out)


@query("held_scrapes", ORACLES["count_sum"])
def held_scrapes(spark, sf):
    """A table job on a stream whose scrapes come in three files each."""
    parts = table_queries.part_rows(spark, sf)
    sizes = parts.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("rows_in_scrape"))
    rows = parts.join(sizes, KEYS).withColumn("arrival", F.pmod(c("pos"), F.lit(DELIVERIES)))

    def job(whole: DataFrame) -> DataFrame:
        return databases.clickhouse_parts(whole)

    def start(stream, path, checkpoint, drain):
        return each_batch(stream, job, path, checkpoint, drain=drain)

    out = delivered(spark, "held", rows, lambda stream: hold_scrapes(stream, KEYS, "rows_in_scrape"), start)
    return flat(read_batches(spark, out))


@query(
    "replayed_batches",
    "SELECT CAST(o_orderkey % 4 AS BIGINT) AS batch, CAST(date_trunc('year', o_orderdate) AS DATE) AS date, "
    "count(*) AS n, CAST(sum(o_orderkey) AS DOUBLE) AS total FROM orders WHERE o_orderkey % 4 < 3 "
    "GROUP BY o_orderkey % 4, CAST(date_trunc('year', o_orderdate) AS DATE)",
)
def replayed_batches(spark, sf):
    """Micro-batches written under their numbers: one is written twice, one is left half-written and
    tried again, and one is left half-written for good."""
    path = run_dir(spark, "batches")
    # A few dates, as a micro-batch has them.
    day = F.date_trunc("year", "ts").cast("timestamp_ntz")
    metrics = order_metrics(spark, sf, "m", c("o_orderkey")).withColumn("ts", day)
    batch = (c("value") % 4).cast("bigint")

    def broken(number: int) -> None:
        some = metrics.where((batch == number) & (c("value") % 3 == 0)).withColumn("date", F.lit("1990-01-01").cast("date"))
        writer = some.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
        writer.partitionBy("date").parquet(f"{path}/batch={number}")

    for number in (0, 1, 1):
        write_batch(metrics.where(batch == number), path, number)
    broken(2)
    write_batch(metrics.where(batch == 2), path, 2)
    broken(3)
    return read_batches(spark, path).groupBy("batch", "date").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")
    )


@query("replicated_log", ORACLES["info_text"])
def replicated_log(spark, sf):
    """Replies are landed, streamed in, turned into metrics, written and read back."""
    # One scrape time for all: a live stream writes few dates at once, not years of them.
    at = F.lit(SCRAPED).cast("timestamp_ntz")
    replies = text_queries.info_replies(spark, sf).withColumn("collected_at", at)
    landed = run_dir(spark, "landed")
    landing.write_snapshots(replies, landed)
    metrics = redis.info(landing.read_snapshots(spark, landed, stream=True))
    return flat(drained(spark, "metrics", metrics, metric_stream))
