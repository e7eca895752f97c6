"""Cassandra and CockroachDB: metric exposition text, and Cassandra over JMX replies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gaugeworks.functions.attrs import base_attrs
from gaugeworks.functions.numbers import num_json
from gaugeworks.functions.records import record
from gaugeworks.functions.text import (
    P99_MARK,
    exposition_samples,
    keep_first,
    keep_last,
    pairs_map,
)
from gaugeworks.operators.shape import (
    emit,
    keyed,
    kv_num,
    kv_specs,
    missing_metrics,
    scaled,
    to_metrics,
)
from gaugeworks.schema import KEYS

# Sample name, metric name, unit, multiplier. The first latency entry is the
# general name and gives way to the read one.
CASSANDRA_GENERAL_READ = "cassandra_clientrequest_latency_mean"
CASSANDRA_READ = "cassandra_clientrequest_read_latency_mean"
CASSANDRA = [
    (CASSANDRA_READ, "db.cassandra.read_latency_ms", "ms", 0.001),
    ("cassandra_clientrequest_write_latency_mean", "db.cassandra.write_latency_ms", "ms", 0.001),
    ("cassandra_compaction_pendingtasks", "db.cassandra.compactions_pending", "{compactions}"),
    (
        "cassandra_table_tombstonescannedhistogram_mean",
        "db.cassandra.tombstones_scanned",
        "{tombstones}",
    ),
    (
        "cassandra_client_connectednativeclients",
        "db.cassandra.connections.active",
        "{connections}",
    ),
    ("cassandra_storage_load", "db.cassandra.storage.total_bytes", "By"),
    ("cassandra_table_livediskspaceused_count", "db.cassandra.storage.live_bytes", "By"),
]
# Endpoint (object name and attribute), metric name, unit, multiplier.
JMX = "org.apache.cassandra.metrics:type="
CASSANDRA_JMX = [
    (JMX + "ClientRequest,scope=Read,name=Latency/Mean", "db.cassandra.read_latency_ms", "ms", 1e3),
    (
        JMX + "ClientRequest,scope=Write,name=Latency/Mean",
        "db.cassandra.write_latency_ms",
        "ms",
        1e3,
    ),
    (
        JMX + "Compaction,name=PendingTasks/Value",
        "db.cassandra.compactions_pending",
        "{compactions}",
        1,
    ),
    (
        JMX + "Table,name=TombstoneScannedHistogram/Mean",
        "db.cassandra.tombstones_scanned",
        "{tombstones}",
        1,
    ),
    (
        JMX + "Client,name=connectedNativeClients/Value",
        "db.cassandra.connections.active",
        "{connections}",
        1,
    ),
    (
        "org.apache.cassandra.db:type=StorageService/Load",
        "db.cassandra.storage.total_bytes",
        "By",
        1,
    ),
    (JMX + "Table,name=LiveDiskSpaceUsed/Count", "db.cassandra.storage.live_bytes", "By", 1),
]
COCKROACH = [
    ("sql_query_count", "db.cockroachdb.sql.query_count", "{queries}"),
    ("sql_failure_count", "db.cockroachdb.sql.failure_count", "{queries}"),
    ("sql_service_latency_p99", "db.cockroachdb.sql.latency_p99", "ns"),
    ("ranges", "db.cockroachdb.ranges.total", "{ranges}"),
    ("ranges_unavailable", "db.cockroachdb.ranges.unavailable", "{ranges}"),
    ("liveness_livenodes", "db.cockroachdb.liveness.live_nodes", "{nodes}"),
    ("capacity_used", "db.cockroachdb.capacity.used_bytes", "By"),
    ("capacity_available", "db.cockroachdb.capacity.available_bytes", "By"),
]
P99 = "_p99"


def cassandra_exposition(df: DataFrame, timestamps: bool = False) -> DataFrame:
    """Mapped samples; the first sample of a name that holds a number counts."""
    names = [m[0] for m in CASSANDRA] + [CASSANDRA_GENERAL_READ]
    samples = exposition_samples(F.col("body"), names, "first", timestamps)
    (_, name, unit, factor), *others = scaled(CASSANDRA)
    latency = F.coalesce(kv_num(CASSANDRA_READ), kv_num(CASSANDRA_GENERAL_READ)) * F.lit(factor)
    specs = [(name, latency, unit), *kv_specs(others)]
    return to_metrics(keyed(df, samples, "first"), specs, base_attrs("cassandra"))


def cassandra_jmx(df: DataFrame) -> DataFrame:
    """One reply per attribute; a value that is no JSON number gives no row."""
    value = num_json(F.try_variant_get(F.try_parse_json("body"), "$.value", "variant"))
    table = F.create_map(
        *[
            part
            for key, name, unit, factor in CASSANDRA_JMX
            for part in (
                F.lit(key),
                record(name=F.lit(name), unit=F.lit(unit), factor=F.lit(float(factor))),
            )
        ]
    )
    entry = table[F.col("endpoint")]
    wanted = df.where(F.col("endpoint").isin([m[0] for m in CASSANDRA_JMX]))
    row = F.array(
        record(name=entry["name"], value=(value / entry["factor"]), unit=entry["unit"])
    )
    return emit(wanted, row, base_attrs("cassandra"))


def _cockroach_samples(df: DataFrame) -> DataFrame:
    names = [m[0] for m in COCKROACH]
    listed = sorted({*names, *[n.removesuffix(P99) for n in names]})
    samples = df.withColumn("__s", exposition_samples(F.col("body"), listed, "p99"))
    # The last quantile line counts, and the first one of everything else.
    marked = F.filter("__s", lambda p: p["key"].endswith(P99_MARK))
    plain = F.filter("__s", lambda p: ~p["key"].endswith(P99_MARK))
    split = samples.withColumn("__q", marked).withColumn("__p", plain)
    kept = F.concat(keep_last(F.col("__q")), keep_first(F.col("__p")))
    return split.withColumn("kv", pairs_map(kept)).drop("__s", "__q", "__p")


def _cockroach_value(name: str) -> Column:
    # A quantile wins over a plain sample spelled with the same suffix.
    if not name.endswith(P99):
        return kv_num(name)
    return F.coalesce(kv_num(name.removesuffix(P99) + P99_MARK), kv_num(name))


def cockroach_vars(df: DataFrame) -> DataFrame:
    """Mapped samples, with 0.99 quantiles under their own name."""
    specs = [(name, _cockroach_value(key), unit) for key, name, unit in COCKROACH]
    return to_metrics(_cockroach_samples(df), specs, base_attrs("cockroachdb"))


def cockroach_missing(df: DataFrame) -> DataFrame:
    """Expected sample names a scrape did not deliver, one row each."""
    expected = [m[0] for m in COCKROACH]
    found = F.array(*[F.when(_cockroach_value(k).isNotNull(), F.lit(k)) for k in expected])
    return _cockroach_samples(df).select(
        *KEYS, F.explode(missing_metrics(found, expected)).alias("missing")
    )
