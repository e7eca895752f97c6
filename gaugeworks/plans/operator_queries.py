"""Shared operators on their own: targets, attributes, ordering, dedupe, sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugeworks.functions.attrs import attrs_text, base_attrs, extend_attrs, resource_attrs
from gaugeworks.functions.numbers import convert, kib_to_pages, ratio
from gaugeworks.functions.text import clip_bytes, clip_chars, qualify, redact_userinfo
from gaugeworks.operators.aggregate import count_by, distinct_names, sum_members
from gaugeworks.operators.ordered import cap_per_key, first_per_key, last_per_key, top_desc
from gaugeworks.operators.shape import classify_targets, map_names, to_metrics
from gaugeworks.operators.union import dedupe_series, quarantine_nonfinite, union_metrics
from gaugeworks.plans.common import attrs_sql, flat, land, query, s, table
from gaugeworks.sources.landing import load_targets
from gaugeworks.session import run_dir
from gaugeworks.sources.sinks import otlp_batches, write_metrics

c = F.col

# ---- Targets

# Connection strings by customer key modulo 12: type, text before and after the name, instance.
DSNS = [
    ("postgres", "postgres://u:p@", ":5432/d?x=1#f", "{n}:5432"),
    ("mongodb", "mongodb://a@b:c@", "/admin", "{n}"),
    ("redis", "10.{n}:6379", "", "unknown"),
    ("mysql", "u:p(x)@tcp({n}:3306)/", "d", "x"),
    ("mysql", "u:p@tcp {n}", "", "unknown"),
    ("kafka", "{n}:9092, b:9092", "", "{n}:9092"),
    ("sqs", "http://", ":9324/q", "{n}:9324"),
    ("sqs", "eu-{n}", "", "eu-{n}"),
    ("sqlite", "/var/{n}.db", "", "/var/{n}.db"),
    ("artemis", "https://{n}", "/console", "{n}"),
    ("oracle", "oracle://{n}", "", None),
    ("nats", "http://", ":port/", "unknown"),
]


def _case_sql(i: int) -> str:
    branches = []
    for n, d in enumerate(DSNS):
        value = d[i]
        if value is None:
            value = "NULL"
        else:
            value = "'" + value.replace("{n}", "' || 'h' || c_custkey || '") + "'"
        branches.append(f"WHEN {n} THEN {value}")
    return f"CASE c_custkey % {len(DSNS)} " + " ".join(branches) + " END"


def customer_settings(spark, sf):
    """One JSON settings text per customer, with the host flag on for some."""
    name = s("h", c("c_custkey"))
    kind, dsn = F.lit(None).cast("string"), F.lit(None).cast("string")
    for n, (k, before, after, _) in enumerate(DSNS):
        here = c("c_custkey") % len(DSNS) == n
        if "{n}" in before:
            text = F.replace(F.lit(before), F.lit("{n}"), name)
        else:
            text = F.concat(F.lit(before), name)
        kind = F.when(here, F.lit(k)).otherwise(kind)
        dsn = F.when(here, F.concat(text, F.lit(after))).otherwise(dsn)
    body = s('[{"type":"', kind, '","dsn":"', dsn, '","name":"t', c("c_custkey"), '"}]')
    return table(spark, sf, "customer").select(
        F.when(c("c_nationkey") % 2 == 0, body).otherwise("").alias("primary"),
        F.when(c("c_nationkey") % 5 == 4, F.lit("[]"))
        .when(c("c_nationkey") % 5 == 3, F.lit("no json"))
        .otherwise(body)
        .alias("fallback"),
        F.when(c("c_nationkey") % 3 == 0, "true").otherwise("no").alias("flag"),
    )


_usable = "(c_nationkey % 2 = 0 OR c_nationkey % 5 < 3)"


@query(
    "dsn_instance",
    f"SELECT {_case_sql(0)} AS type, 't' || c_custkey AS name, "
    f"CASE {_case_sql(0)} WHEN 'artemis' THEN 'activemq' ELSE {_case_sql(0)} END AS family, "
    f"{_case_sql(3)} AS instance FROM customer WHERE {_usable} AND c_custkey % 12 <> 10 "
    "UNION ALL SELECT 'host', 'web', 'host', 'localhost' FROM customer "
    f"WHERE {_usable} AND c_nationkey % 3 = 0",
)
def dsn_instance(spark, sf):
    targets = load_targets(customer_settings(spark, sf), c("flag"), F.lit("web"))
    supported, _ = classify_targets(targets)
    return supported.select("type", "name", "family", "instance")


@query(
    "rejected_targets",
    "SELECT 'oracle' AS type, 't' || c_custkey AS name, 'unsupported type: oracle' AS reason "
    f"FROM customer WHERE {_usable} AND c_custkey % 12 = 10",
)
def rejected_targets(spark, sf):
    _, rejected = classify_targets(load_targets(customer_settings(spark, sf)))
    return rejected


# ---- Attributes and text


@query(
    "base_attrs",
    "SELECT c_custkey, "
    + attrs_sql(
        {
            "messaging.system": "'kafka'",
            "messaging.name": "c_name",
            "messaging.instance": "'replaced'",
            "messaging.destination.name": "c_mktsegment",
        }
    )
    + " AS attrs FROM customer",
)
def base_attributes(spark, sf):
    landed = land(table(spark, sf, "customer"), c("c_custkey"), c("c_name"), F.lit("i"),
                  topic=c("c_mktsegment"))
    own = base_attrs("kafka", {"messaging.destination.name": c("topic")})
    override = F.create_map(F.lit("messaging.instance"), F.lit("replaced"))
    return landed.select(
        c("cycle_id").alias("c_custkey"), attrs_text(extend_attrs(own, override)).alias("attrs")
    )


@query(
    "resource_attrs",
    "SELECT c_custkey, CASE WHEN c_nationkey % 2 = 0 THEN 'cloud.region=' || c_nationkey || ';' "
    "ELSE '' END || 'deployment.environment=prod;service.name=' || c_mktsegment AS attrs FROM customer",
)
def resource_attributes(spark, sf):
    region = F.when(c("c_nationkey") % 2 == 0, s(c("c_nationkey"))).otherwise("")
    attrs = resource_attrs(
        c("c_mktsegment"),
        F.lit("prod"),
        {"cloud.provider": F.lit(""), "cloud.region": region},
    )
    return table(spark, sf, "customer").select("c_custkey", attrs_text(attrs).alias("attrs"))


@query(
    "clip_bytes",
    # The longest character prefix within 256 bytes; one more character, cut in two, shows as
    # one replacement character when bytes are left over.
    "SELECT doc_id, octet_length(encode(text)) > 256 AS clipped, prefix || CASE "
    "WHEN octet_length(encode(text)) > 256 AND octet_length(encode(prefix)) < 256 "
    "THEN chr(65533) ELSE '' END AS clip, left(text, 100) AS head FROM "
    "(SELECT doc_id, text, left(text, CAST(list_max(list_filter(range(0, 257), "
    "lambda n: octet_length(encode(left(text, n))) <= 256)) AS BIGINT)) AS prefix FROM documents)",
)
def clip(spark, sf):
    text = c("text")
    return table(spark, sf, "documents").select(
        "doc_id",
        (F.octet_length(text) > 256).alias("clipped"),
        clip_bytes(text).alias("clip"),
        clip_chars(text, 100).alias("head"),
    )


@query(
    "redact_userinfo",
    "SELECT c_custkey, 'GET https://***@h' || c_custkey || '/x: refused by a@b' AS error FROM customer",
)
def redact(spark, sf):
    error = s("GET https://u:", c("c_name"), "@h", c("c_custkey"), "/x: refused by a@b")
    return table(spark, sf, "customer").select("c_custkey", redact_userinfo(error).alias("error"))


@query(
    "unit_math",
    "SELECT p_partkey, p_type || '.' || p_name AS qualified, p_size * CAST(0.001 AS DOUBLE) AS ms, "
    "p_size * CAST(1024 AS DOUBLE) AS bytes, p_size * CAST(100 AS DOUBLE) AS percent, "
    "CASE WHEN p_size % 5 > 0 THEN CAST((p_partkey * 1024) // (p_size % 5) AS DOUBLE) END AS pages, "
    "CASE WHEN p_size % 5 > 0 THEN CAST(p_partkey AS DOUBLE) / CAST(p_size % 5 AS DOUBLE) "
    "ELSE CAST(0 AS DOUBLE) END AS ratio_zero, "
    "CASE WHEN p_size % 5 > 0 THEN CAST(p_partkey AS DOUBLE) / CAST(p_size % 5 AS DOUBLE) "
    "END AS ratio_omit FROM part",
)
def unit_math(spark, sf):
    size, den = c("p_size"), c("p_size") % 5
    return table(spark, sf, "part").select(
        "p_partkey",
        qualify(c("p_type"), c("p_name")).alias("qualified"),
        convert(size, "us_to_ms").alias("ms"),
        convert(size, "kb_to_bytes").alias("bytes"),
        convert(size, "ratio_to_percent").alias("percent"),
        kib_to_pages(c("p_partkey"), den.cast("bigint")).cast("double").alias("pages"),
        ratio(c("p_partkey"), den, "zero").alias("ratio_zero"),
        ratio(c("p_partkey"), den, "omit").alias("ratio_omit"),
    )


# ---- Mapping, ordering, grouping

RENAMES = [
    ("view", "reads", "{reads}", 1),
    ("click", "reads", "{reads}", 10),
    ("purchase", "writes", "{writes}", 100),
]


@query(
    "map_names",
    "SELECT event_id, CASE event_type WHEN 'purchase' THEN 'writes' ELSE 'reads' END AS name, "
    "CAST(event_id * CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 10 ELSE 100 END AS DOUBLE) "
    "AS value, CASE event_type WHEN 'purchase' THEN '{writes}' ELSE '{reads}' END AS unit "
    "FROM events WHERE event_type IN ('view', 'click', 'purchase')",
)
def rename(spark, sf):
    rows = table(spark, sf, "events").select(
        "event_id", c("event_type").alias("key"), c("event_id").cast("double").alias("value")
    )
    return map_names(rows, RENAMES).select("event_id", "name", "value", "unit")


@query(
    "top_n",
    "SELECT o_custkey, o_orderkey, CAST(rn AS INTEGER) AS rank FROM (SELECT *, row_number() OVER "
    "(PARTITION BY o_custkey ORDER BY p DESC NULLS LAST, o_orderkey) AS rn FROM (SELECT *, "
    "CASE WHEN o_orderstatus <> 'P' THEN CAST(floor(o_totalprice) AS BIGINT) END AS p FROM orders)) "
    "WHERE rn <= 10",
)
def top(spark, sf):
    price = F.when(c("o_orderstatus") != "P", F.floor("o_totalprice"))
    orders = table(spark, sf, "orders").withColumn("p", price)
    best = top_desc(orders, ["o_custkey"], "p", ["o_orderkey"])
    return best.select("o_custkey", "o_orderkey", "rank")


@query(
    "cap_per_key",
    "SELECT o_orderpriority, o_orderkey, CAST(-1 AS BIGINT) AS truncated FROM (SELECT *, "
    "row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS rn FROM orders) "
    "WHERE rn <= 100 UNION ALL SELECT o_orderpriority, CAST(-1 AS BIGINT), "
    "CAST(greatest(0, count(*) - 100) AS BIGINT) FROM orders GROUP BY o_orderpriority",
)
def cap(spark, sf):
    kept, over = cap_per_key(table(spark, sf, "orders"), ["o_orderpriority"], ["o_orderkey"], 100)
    none = F.lit(-1).cast("bigint")
    return kept.select("o_orderpriority", "o_orderkey", none.alias("truncated")).unionByName(
        over.select("o_orderpriority", none.alias("o_orderkey"), "truncated")
    )


@query(
    "first_last_per_key",
    "SELECT l_orderkey, CAST(arg_min(l_quantity, pos) AS DOUBLE) AS first_qty, "
    "CAST(arg_max(l_quantity, pos) AS DOUBLE) AS last_qty FROM (SELECT *, "
    "(l_linenumber * 100000 + l_suppkey) * 10000000 + l_partkey * 100 + CAST(l_quantity AS BIGINT) "
    "AS pos FROM lineitem) GROUP BY l_orderkey",
)
def first_last(spark, sf):
    # Position is unique as far as the kept column goes, so ties cannot change the result.
    pos = (
        (c("l_linenumber") * 100000 + c("l_suppkey")) * 10000000
        + c("l_partkey") * 100
        + c("l_quantity").cast("bigint")
    )
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", pos.alias("pos"))
    first = first_per_key(items, ["l_orderkey"], "pos", ["l_quantity"])
    last = last_per_key(items, ["l_orderkey"], "pos", ["l_quantity"])
    return first.withColumnRenamed("l_quantity", "first_qty").join(
        last.withColumnRenamed("l_quantity", "last_qty"), "l_orderkey"
    )


@query(
    "members_sum",
    "SELECT l_suppkey, CAST(sum(l_quantity) AS DOUBLE) AS l_quantity, "
    "CAST(sum(l_linenumber) AS DOUBLE) AS l_linenumber FROM lineitem GROUP BY l_suppkey",
)
def members_sum(spark, sf):
    return sum_members(table(spark, sf, "lineitem"), ["l_suppkey"], ["l_quantity", "l_linenumber"])


@query(
    "count_by_state",
    "SELECT user_id, event_type, count(*) AS n FROM events GROUP BY user_id, event_type",
)
def count_state(spark, sf):
    return count_by(table(spark, sf, "events"), ["user_id"], "event_type")


@query(
    "distinct_names",
    "SELECT DISTINCT p_brand, CASE WHEN p_size % 2 = 0 THEN p_name END AS name FROM part "
    "WHERE p_size % 2 = 0",
)
def names(spark, sf):
    part = table(spark, sf, "part").withColumn(
        "name", F.when(c("p_size") % 2 == 0, c("p_name"))
    )
    return distinct_names(part, ["p_brand"], "name")


# ---- Union, dedupe, gate, documents


def order_metrics(spark, sf, name: str, value):
    """One metric row per order, with the customer as target."""
    landed = land(
        table(spark, sf, "orders"),
        c("o_orderkey") % 100,
        s("c", c("o_custkey")),
        c("o_orderpriority"),
        c("o_orderdate"),
        status=c("o_orderstatus"),
        v=value,
    )
    return to_metrics(landed, [(name, c("v"), "1")], base_attrs("redis", {"s": c("status")}))


@query(
    "dedupe_union",
    "SELECT CAST(o_orderkey % 100 AS BIGINT) AS cycle_id, 'c' || o_custkey AS target, 'm' AS name, "
    "CAST(max(o_orderkey * 2) AS DOUBLE) AS value, '1' AS unit, "
    + attrs_sql(
        {
            "db.system": "'redis'",
            "db.name": "'c' || o_custkey",
            "db.instance": "o_orderpriority",
            "s": "o_orderstatus",
        }
    )
    + " AS attrs FROM orders "
    "GROUP BY o_orderkey % 100, o_custkey, o_orderpriority, o_orderstatus",
)
def dedupe_union(spark, sf):
    preferred = order_metrics(spark, sf, "m", c("o_orderkey") * 2).withColumn("p", F.lit(1))
    other = order_metrics(spark, sf, "m", c("o_orderkey") * 5).withColumn("p", F.lit(0))
    return flat(dedupe_series(union_metrics(preferred, other), prefer=c("p")))


@query(
    "quarantine",
    "SELECT 'good' AS side, count(*) AS n FROM orders WHERE o_orderkey % 10 > 2 "
    "UNION ALL SELECT 'bad', count(*) FROM orders WHERE o_orderkey % 10 <= 2",
)
def quarantine(spark, sf):
    forms = c("o_orderkey") % 10
    value = (
        F.when(forms == 0, F.lit(float("nan")))
        .when(forms == 1, F.lit(float("inf")))
        .when(forms == 2, F.lit(float("-inf")))
        .otherwise(c("o_orderkey").cast("double"))
    )
    good, bad = quarantine_nonfinite(order_metrics(spark, sf, "m", value))
    return good.groupBy(F.lit("good").alias("side")).agg(F.count(F.lit(1)).alias("n")).unionByName(
        bad.groupBy(F.lit("bad").alias("side")).agg(F.count(F.lit(1)).alias("n"))
    )


def _documents(spark, sf):
    metrics = order_metrics(spark, sf, "m", c("o_orderkey"))
    resource = resource_attrs(F.lit("infra"), F.lit("prod"), {"cloud.region": F.lit("")})
    return otlp_batches(metrics, resource, ["cycle_id"], max_rows=50)


# What each document carries: rows and points are counted again after reading the JSON back.
_POINTS = (
    "resourceMetrics array<struct<scopeMetrics: array<struct<metrics: array<struct<name: string, "
    "unit: string, gauge: struct<dataPoints: array<struct<timeUnixNano: string, asDouble: double, "
    "attributes: array<struct<key: string, value: struct<stringValue: string>>>>>>>>>>>>"
)


@query(
    "otlp_points",
    "SELECT CAST(o_orderkey % 100 AS BIGINT) AS cycle_id, 'm' AS name, '1' AS unit, "
    "CAST(CAST(epoch(o_orderdate) AS BIGINT) * 1000000000 AS VARCHAR) AS nanos, "
    "CAST(o_orderkey AS DOUBLE) AS value, 'c' || o_custkey AS db_name, CAST(4 AS INTEGER) AS n_attrs "
    "FROM orders",
)
def otlp_points(spark, sf):
    read = _documents(spark, sf).select("cycle_id", F.from_json("body", _POINTS).alias("j"))
    points = read.select(
        "cycle_id", F.explode(c("j.resourceMetrics")[0]["scopeMetrics"][0]["metrics"]).alias("m")
    ).withColumn("p", c("m.gauge.dataPoints")[0])
    named = F.filter("p.attributes", lambda a: a["key"] == "db.name")
    return points.select(
        "cycle_id",
        c("m.name").alias("name"),
        c("m.unit").alias("unit"),
        c("p.timeUnixNano").alias("nanos"),
        c("p.asDouble").alias("value"),
        named[0]["value"]["stringValue"].alias("db_name"),
        F.size("p.attributes").alias("n_attrs"),
    )


@query(
    "otlp_batches",
    "SELECT CAST(o_orderkey % 100 AS BIGINT) AS cycle_id, count(*) AS n_metrics, "
    "'[{\"key\":\"deployment.environment\",\"value\":{\"stringValue\":\"prod\"}},"
    "{\"key\":\"service.name\",\"value\":{\"stringValue\":\"infra\"}}]' AS resource, "
    "'{\"name\":\"gaugeworks\",\"version\":\"1.0\"}' AS scope, "
    "count(*) > 50 AS split_up, true AS bounded FROM orders GROUP BY o_orderkey % 100",
)
def otlp(spark, sf):
    docs = _documents(spark, sf)
    return docs.groupBy("cycle_id").agg(
        F.sum("n_metrics").alias("n_metrics"),
        F.max(F.get_json_object("body", "$.resourceMetrics[0].resource.attributes")).alias(
            "resource"
        ),
        F.max(F.get_json_object("body", "$.resourceMetrics[0].scopeMetrics[0].scope")).alias("scope"),
        (F.count(F.lit(1)) > 1).alias("split_up"),
        (F.max("n_metrics") <= 50).alias("bounded"),
    )


@query(
    "written_metrics",
    "SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS n, CAST(sum(o_orderkey) AS DOUBLE) AS total FROM orders "
    "GROUP BY CAST(o_orderdate AS DATE)",
)
def written_metrics(spark, sf):
    """The metric table, written by date and read back."""
    path = run_dir(spark, "metric-table")
    write_metrics(order_metrics(spark, sf, "m", c("o_orderkey")), path)
    return spark.read.parquet(path).groupBy("date").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")
    )
