"""Shared operators on small inputs."""

import json
import random
from datetime import datetime, timedelta

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gaugeworks.functions.attrs import attrs_text, extend_attrs, resource_attrs
from gaugeworks.functions.instance import instance_from_dsn
from gaugeworks.functions.numbers import num_prefix, num_strict, num_zero
from gaugeworks.functions.text import clip_bytes
from gaugeworks.operators.agent import (
    attempt_outcome,
    health_summary,
    heartbeat,
    readiness,
    send_outcome,
)
from gaugeworks.operators.join import as_of
from gaugeworks.operators.ordered import (
    cap_per_key,
    collector_health,
    counter_delta,
    failure_runs,
    latest_run,
)
from gaugeworks.operators.shape import classify_targets
from gaugeworks.operators.union import (
    dedupe_series,
    mark_nonfinite,
    quarantine_nonfinite,
    union_metrics,
)
from gaugeworks.plans.cycle import collect
from gaugeworks.schema import METRIC_DDL, landed_schema
from gaugeworks.sources.landing import load_targets
from gaugeworks.sources.sinks import _blocks, otlp_batches, write_metrics, write_otlp, write_outcomes
from gaugeworks.streaming.run import interval_ms
from helpers import AT, landed, replies

T0 = datetime(2024, 1, 1)


def one(spark, expr, value, ddl="x string"):
    return spark.createDataFrame([(value,)], ddl).select(expr(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    "text,strict,zero,prefix",
    [
        ("5", 5.0, 5.0, 5.0),
        ("-.5e1", -5.0, -5.0, -5.0),
        ("5.", 5.0, 5.0, 5.0),
        (" 5", None, 0.0, 5.0),
        ("5\n", None, 0.0, 5.0),
        ("1.0d", None, 0.0, 1.0),
        ("2f", None, 0.0, 2.0),
        ("0x1p4", None, 0.0, 0.0),
        ("1_000", None, 0.0, 0.0),
        ("12e", None, 0.0, 0.0),
        ("1e400", None, float("inf"), 0.0),
        ("-Infinity", float("-inf"), float("-inf"), float("-inf")),
        ("", None, 0.0, 0.0),
        (None, None, 0.0, 0.0),
    ],
)
def test_number_rules(spark, text, strict, zero, prefix):
    assert one(spark, num_strict, text) == strict
    assert one(spark, num_zero, text) == zero
    assert one(spark, num_prefix, text) == prefix


DSNS = [
    ("postgres", "postgres://u:p@h:5432/d", "h:5432"),
    ("mongodb", "mongodb://a:b@h1:1,h2:2/x", "h1:1,h2:2"),
    ("redis", "localhost:6379", ""),
    ("redis", "127.0.0.1:6379", "unknown"),
    ("nats", "http://h:port/", "unknown"),
    ("nats", "http://[::1]:8222/", "[::1]:8222"),
    ("mysql", "u:p@tcp(h:3306)/d", "h:3306"),
    ("mysql", "u:p@h/d", "unknown"),
    ("kafka", "a:1, b:2", "a:1"),
    ("sqs", "us-east-1", "us-east-1"),
    ("sqs", "http://h:9/x", "h:9"),
    ("sqlite", "/x/y.db", "/x/y.db"),
    ("host", "", "localhost"),
    ("oracle", "x", "unknown"),
]


def test_instances(spark):
    df = spark.createDataFrame([d[:2] for d in DSNS], "type string, dsn string")
    got = df.select("type", "dsn", instance_from_dsn(F.col("type"), F.col("dsn")).alias("i"))
    assert [(r[0], r[1], r[2]) for r in got.collect()] == DSNS


def test_targets(spark):
    good = '[{"type":"redis","dsn":"redis://h","name":"r"},{"type":"oracle","name":"o"}]'
    rows = [(good, None), ("", good), ("[]", good), ("bad", good)]
    settings = spark.createDataFrame(rows, "primary string, fallback string")
    targets = load_targets(settings, F.lit("1"), F.lit("box"))
    supported, rejected = classify_targets(targets)
    assert sorted((r["type"], r["name"], r["instance"]) for r in supported.collect()) == [
        ("host", "box", "localhost"),
        ("host", "box", "localhost"),
        ("redis", "r", "h"),
        ("redis", "r", "h"),
    ]
    assert [r["reason"] for r in rejected.collect()] == ["unsupported type: oracle"] * 2


def test_attributes(spark):
    df = spark.createDataFrame([({"b": "1", "a": "2"}, {"b": "9"})], "x map<string,string>, y map<string,string>")
    assert df.select(attrs_text(extend_attrs(F.col("x"), F.col("y")))).first()[0] == "a=2;b=9"
    got = df.select(
        attrs_text(resource_attrs(F.lit(""), F.lit("e"), {"t": F.lit(""), "r": F.lit("x")}))
    ).first()[0]
    assert got == "deployment.environment=e;r=x;service.name="


def test_clip_bytes(spark):
    assert one(spark, clip_bytes, "a" * 300) == "a" * 256
    assert one(spark, clip_bytes, "a" * 255 + "é") == "a" * 255 + "�"
    assert one(spark, clip_bytes, "é" * 128) == "é" * 128


def test_cap(spark):
    df = spark.createDataFrame([("a", i) for i in range(12)] + [("b", 1)], "k string, p int")
    kept, over = cap_per_key(df, ["k"], ["p"], 10)
    assert kept.groupBy("k").count().collect() and kept.count() == 11
    assert {(r["k"], r["truncated"]) for r in over.collect()} == {("a", 2), ("b", 0)}


@pytest.mark.parametrize("hours", [1, 5, 1000])
def test_runs_and_deltas_cross_slices(spark, hours):
    flags = [True, False, False, False, True, False, False, False, False, False, False, True]
    rows = [("c", T0 + timedelta(hours=2 * i), ok, i * i, f"e{i}") for i, ok in enumerate(flags)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, ok boolean, n bigint, error string")
    size = hours * 3_600_000_000
    got = failure_runs(df, ["k"], "ts", error="error", slice_us=size).orderBy("ts").collect()
    assert [r["consecutive_failures"] for r in got] == [0, 1, 2, 3, 0, 1, 2, 3, 4, 5, 6, 0]
    assert got[3]["last_success"] == T0 and got[3]["last_error"] == "e3"
    assert got[4]["last_error"] is None
    status = collector_health(failure_runs(df, ["k"], "ts", slice_us=size)).orderBy("ts").collect()
    assert [r["health"] for r in status] == [1, 0.5, 0.5, 0.5, 1, 0.5, 0.5, 0.5, 0.5, 0, 0, 1]
    deltas = counter_delta(df, ["k"], "ts", ["n"], slice_us=size).orderBy("ts").collect()
    assert [r["d_n"] for r in deltas] == [None] + [2 * i - 1 for i in range(1, 12)]
    latest = latest_run(df.where(F.col("n") < 100), ["k"], "ts", error="error").first()
    assert (latest["consecutive_failures"], latest["last_error"]) == (5, "e9")


def metric(name, value, attrs=None, cycle=1):
    return (AT, cycle, "t", name, value, "1", attrs or {"a": "1", "b": "2"})


def test_dedupe_prefers_and_keeps_entry_order_out(spark):
    rows = [metric("m", 1.0), metric("m", 5.0, {"b": "2", "a": "1"}), metric("m", 7.0, {"a": "9"})]
    df = spark.createDataFrame(rows, METRIC_DDL)
    ranked = df.withColumn("r", F.when(F.col("value") == 1, 1).otherwise(0))
    once = dedupe_series(ranked, prefer=F.col("r"))
    assert sorted(r["value"] for r in once.collect()) == [1.0, 7.0]
    again = dedupe_series(once)
    assert sorted(r["value"] for r in again.collect()) == [1.0, 7.0]
    assert union_metrics(df, df, df).count() == 9


def test_quarantine_and_documents(spark, tmp_path):
    rows = [metric("m", float(i)) for i in range(30)] + [metric("m", 3.0)] * 400
    rows += [metric("x", float("nan")), metric("x", float("-inf"))]
    good, bad = quarantine_nonfinite(spark.createDataFrame(rows, METRIC_DDL))
    assert bad.count() == 2
    docs = otlp_batches(
        good,
        resource_attrs(F.lit("svc"), F.lit("prod")),
        max_rows=50,
        batch_time=F.lit("2024-01-02 00:00:00").cast("timestamp_ntz"),
    )
    write_otlp(docs, str(tmp_path / "docs"))
    points = []
    for row in spark.read.text(str(tmp_path / "docs")).collect():
        scope = json.loads(row[0])["resourceMetrics"][0]["scopeMetrics"][0]
        assert scope["scope"] == {"name": "gaugeworks", "version": "1.0"}
        points += [m["gauge"]["dataPoints"][0] for m in scope["metrics"]]
    assert len(points) == 430
    assert {p["timeUnixNano"] for p in points} == {"1704153600000000000"}
    assert sum(p["asDouble"] == 3.0 for p in points) == 401
    assert max(r["n_metrics"] for r in docs.collect()) < 430


def test_metric_table_round_trip(spark, tmp_path):
    df = spark.createDataFrame([metric("m", 1.0), metric("n", 2.0)], METRIC_DDL)
    write_metrics(df, str(tmp_path / "metrics"))
    back = spark.read.parquet(str(tmp_path / "metrics"))
    assert back.where("date = '2024-01-01'").count() == 2


def test_collect_prefers_backends_over_sessions(spark):
    stats = landed(spark, "pg_stat_database", [("d", 7, *[0] * 11)])
    sessions = landed(spark, "pg_stat_activity", [("d", "active", None, AT)])
    beat = heartbeat(spark.createDataFrame([(AT, 1, "agent")], "ts timestamp_ntz, cycle_id bigint, target string"))
    snaps = replies(spark, "host", ("proc/loadavg", "1 2 3\n"))
    good, bad = collect(
        {"pg_stat_database": stats, "pg_stat_activity": sessions, "raw_snapshots": snaps}, [beat]
    )
    got = {r["name"]: r["value"] for r in good.collect()}
    assert got["db.postgres.connections.active"] == 7.0
    assert got["agent.up"] == 1.0 and got["host.load.5m"] == 2.0
    assert len(got) == 13 + 3 + 1 + 3 and bad.count() == 0


def test_attempts_and_sends(spark):
    cols = "c string, attempt_no int, duration_ms bigint, ok boolean, error string"
    rows = [
        ("a", 1, 10, False, "x"), ("a", 2, 9000, True, None), ("a", 3, 10, False, "z"),
        ("a", 4, 10, True, None), ("b", 1, 10, False, "x"), ("b", 2, 8000, True, None),
    ]
    got = {r["c"]: r for r in attempt_outcome(spark.createDataFrame(rows, cols), ["c"]).collect()}
    assert (got["a"]["ok"], got["a"]["error"]) == (False, "z")
    assert (got["b"]["ok"], got["b"]["attempts_used"], got["b"]["error"]) == (True, 2, None)
    sends = [("a", 1, 500), ("a", 2, 400), ("a", 3, 200), ("b", 1, 500), ("b", 2, 404),
             ("b", 3, 301), ("b", 4, 500), ("b", 5, 200)]
    out = send_outcome(spark.createDataFrame(sends, "c string, try_no int, status int"), ["c"])
    assert {(r["c"], r["ok"], r["tries"]) for r in out.collect()} == {("a", True, 3), ("b", False, 4)}


def test_health_and_readiness(spark):
    status = spark.createDataFrame([("x", "ok"), ("x", "open"), ("y", "ok")], "a string, status string")
    sends = spark.createDataFrame(
        [("x", T0, True, None), ("x", T0 + timedelta(seconds=9), False, "boom")],
        "a string, ts timestamp_ntz, ok boolean, error string",
    )
    got = {r["a"]: r for r in health_summary(status, sends, ["a"]).collect()}
    assert (got["x"]["status"], got["x"]["last_send_ok"], got["x"]["last_send_error"]) == (
        "degraded", T0, "boom",
    )
    assert (got["y"]["status"], got["y"]["last_send_ok"]) == ("ok", None)
    starts = spark.createDataFrame(
        [("x", T0, T0 + timedelta(seconds=99)), ("y", T0, T0 + timedelta(seconds=30)),
         ("z", T0, T0 + timedelta(seconds=31))],
        "a string, started_at timestamp_ntz, asked_at timestamp_ntz",
    )
    ready = {r["a"]: r["ready"] for r in readiness(starts, sends, ["a"]).collect()}
    assert ready == {"x": True, "y": True, "z": False}


def test_settings():
    assert interval_ms(500) == 15_000 and interval_ms(1000) == 1000
    assert landed_schema("attempts").fieldNames()[0] == "cycle_id"
    assert landed_schema("mounts").fieldNames()[:2] == ["cycle_id", "collected_at"]


def test_runs_with_equal_times_and_unknown_outcomes(spark):
    at = datetime(2024, 1, 1)
    rows = [("a", at, 1, False), ("a", at, 2, None), ("a", at, 3, False), ("b", at, 1, False), ("b", at, 2, True)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, n long, ok boolean")
    got = failure_runs(df, ["k"], "ts", seq="n").orderBy("k", "n").collect()
    assert [r["consecutive_failures"] for r in got] == [1, 2, 3, 1, 0]
    last = {r["k"]: r["consecutive_failures"] for r in latest_run(df, ["k"], "ts", seq="n").collect()}
    assert last == {"a": 3, "b": 0}


def test_finite_value_wins_and_keeps_its_time(spark):
    rows = [(datetime(2024, 1, 1, h), 1, "t", "m", v, "1", {}) for h, v in ((3, float("nan")), (1, 5.0), (2, 4.0))]
    df = spark.createDataFrame(rows, METRIC_DDL)
    (row,) = dedupe_series(df).collect()
    assert (row["value"], row["ts"]) == (5.0, datetime(2024, 1, 1, 1))


def test_documents_are_bounded_for_any_batch_keys(spark):
    rows = [(datetime(2024, 1, 1) + timedelta(minutes=i), i, "t", "agent.up", 1.0, "1", {}) for i in range(950)]
    rows += [rows[0]] * 333
    df = spark.createDataFrame(rows, METRIC_DDL)
    docs = otlp_batches(df, F.create_map(F.lit("a"), F.lit("b")), ["target"], max_rows=100).collect()
    assert max(r["n_metrics"] for r in docs) <= 100 and sum(r["n_metrics"] for r in docs) == 1283
    assert len({r["document"] for r in docs}) == len(docs)


# ---- One shuffle for rows and summaries


def scans(df):
    """Scans in the plan that ran; a shuffle that is used again has none of its own."""
    plan = df._jdf.queryExecution().executedPlan()
    df.collect()
    return plan.toString().split("== Initial Plan ==")[0].count("FileScan")


def test_input_is_read_once(spark, tmp_path):
    rows = [(f"k{i % 3}", T0 + timedelta(hours=7 * i), i, i % 4 != 0, f"e{i}") for i in range(200)]
    spark.createDataFrame(rows, "k string, ts timestamp_ntz, n long, ok boolean, error string").write.parquet(str(tmp_path / "in"))
    df = spark.read.parquet(str(tmp_path / "in"))
    facts = df.where("n % 20 = 0").select("k", "ts", F.col("error").alias("fact"))
    for made, n in (
        (counter_delta(df, ["k"], "ts", ["n"]), 1),
        (failure_runs(df, ["k"], "ts", error="error"), 1),
        (latest_run(df, ["k"], "ts", error="error"), 1),
        (as_of(df, facts, ["k"], "ts", ["fact"]), 2),
    ):
        assert scans(made) == n


def plain_runs(rows):
    out, run, good = {}, {}, {}
    for k, ts, n, ok, error in sorted(rows, key=lambda r: (r[1], r[2])):
        run[k] = 0 if ok else run.get(k, 0) + 1
        if ok:
            good[k] = ts
        out[k, n] = (run[k], good.get(k), None if ok else error)
    return out


@pytest.mark.parametrize("slice_us", [1, 3_600_000_000, 10**15])
def test_runs_with_equal_times_and_unknown_outcomes(spark, slice_us):
    r = random.Random(slice_us)
    rows = [(f"k{r.randrange(3)}", T0 + timedelta(hours=r.randrange(30)), i, r.choice([True, False, False, None]), f"e{i}") for i in range(300)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, n long, ok boolean, error string")
    want = plain_runs(rows)
    got = failure_runs(df, ["k"], "ts", error="error", seq="n", slice_us=slice_us).collect()
    assert {(x["k"], x["n"]): (x["consecutive_failures"], x["last_success"], x["last_error"]) for x in got} == want
    last = {k: max((x for x in rows if x[0] == k), key=lambda x: (x[1], x[2]))[2] for k in {x[0] for x in rows}}
    latest = latest_run(df, ["k"], "ts", error="error", seq="n", slice_us=slice_us).collect()
    assert {x["k"]: (x["consecutive_failures"], x["last_success"], x["last_error"]) for x in latest} == {k: want[k, n] for k, n in last.items()}


def test_without_numbers_a_success_of_the_same_time_counts_last(spark):
    df = spark.createDataFrame([("a", T0, True), ("a", T0, False), ("a", T0, None)], "k string, ts timestamp_ntz, ok boolean")
    assert latest_run(df, ["k"], "ts").first()["consecutive_failures"] == 0
    assert sorted(x["consecutive_failures"] for x in failure_runs(df, ["k"], "ts").collect()) == [0, 1, 2]


@pytest.mark.parametrize("slice_us", [1, 3_600_000_000, 10**15])
def test_facts_as_of_a_time(spark, slice_us):
    r = random.Random(slice_us)
    facts = [(f"k{r.randrange(3)}", T0 + timedelta(minutes=17 * r.randrange(60)), f"f{r.randrange(9)}", r.choice([None, "x"])) for _ in range(40)]
    samples = [(f"k{r.randrange(4)}", T0 + timedelta(minutes=17 * r.randrange(70) - 60), i, {"m": "1"}) for i in range(200)]
    a = spark.createDataFrame(samples, "k string, ts timestamp_ntz, n long, attrs map<string,string>")
    b = spark.createDataFrame(facts, "k string, ts timestamp_ntz, f string, g string")
    want = {}
    for k, ts, n, _ in samples:
        held = [(t, f, g or "") for q, t, f, g in facts if q == k and t <= ts]
        best = max(held, default=(None, None, ""))
        want[n] = (best[1], best[2] or None)
    got = as_of(a, b, ["k"], "ts", ["f", "g"], slice_us)
    assert got.columns == ["k", "ts", "n", "attrs", "f", "g"]
    assert {x["n"]: (x["f"], x["g"]) for x in got.collect()} == want


def test_uptime(spark):
    status = spark.createDataFrame([(1, "ok"), (2, "open")], "g int, status string")
    sends = spark.createDataFrame([(1, T0, True, "e")], "g int, ts timestamp_ntz, ok boolean, error string")
    starts = spark.createDataFrame([(1, T0, T0 + timedelta(seconds=90, milliseconds=250))], "g int, started_at timestamp_ntz, asked_at timestamp_ntz")
    got = {x["g"]: x["uptime_s"] for x in health_summary(status, sends, ["g"], starts).collect()}
    assert got == {1: 90.25, 2: None}


def test_outcomes_in_one_pass(spark, tmp_path):
    rows = [metric("m", 1.0), metric("m", float("nan")), metric("m", float("inf")), metric("n", 2.0), metric("n", None)]
    write_outcomes(mark_nonfinite(spark.createDataFrame(rows, METRIC_DDL)), str(tmp_path / "o"))
    back = spark.read.parquet(str(tmp_path / "o"))
    assert {(x["outcome"], x["count"]) for x in back.groupBy("outcome").count().collect()} == {("good", 2), ("rejected", 3)}


def test_documents_keep_batches_of_null_keys_and_copies(spark):
    rows = [(T0, None if i % 3 == 0 else i % 2, "t", "m", float(i % 7), "1", {"a": "x"}) for i in range(500)]
    docs = otlp_batches(spark.createDataFrame(rows, METRIC_DDL), F.create_map(F.lit("a"), F.lit("b")), ["cycle_id"], max_rows=40).collect()
    sizes = {}
    for d in docs:
        scope = json.loads(d["body"])["resourceMetrics"][0]
        points = [m["gauge"]["dataPoints"][0]["asDouble"] for m in scope["scopeMetrics"][0]["metrics"]]
        assert len(points) == d["n_metrics"] <= 40
        assert scope["resource"] == {"attributes": [{"key": "a", "value": {"stringValue": "b"}}]}
        sizes.setdefault(d["cycle_id"], []).extend(points)
    want = {}
    for x in rows:
        want.setdefault(x[1], []).append(x[4])
    assert {k: sorted(v) for k, v in sizes.items()} == {k: sorted(v) for k, v in want.items()}


def test_documents_are_sorted_as_blocks(spark):
    """What is shuffled and sorted is compressed blocks of a batch's rows, none of them lost."""
    text = '{"name":"m","gauge":{"dataPoints":[{"asDouble":%d.0,"attributes":[{"key":"a","value":{"stringValue":"x"}}]}]}}'
    rows = pa.RecordBatch.from_pydict({"k": [i % 3 or None for i in range(6000)], "m": [text % (i % 50) for i in range(6000)]})
    (blocks,) = _blocks(["k"])(iter([rows]))
    assert sorted(blocks.column("k").to_pylist(), key=str) == [1, 2, None]
    assert sum(len(b) for b in blocks.column("gw_block").to_pylist()) * 20 < sum(len(m) for m in rows.column("m").to_pylist())
    df = spark.createDataFrame([(T0 + timedelta(seconds=i), i % 2, "t", "m", float(i % 97), "1", {"a": "x"}) for i in range(3000)], METRIC_DDL)
    docs = otlp_batches(df, F.create_map(F.lit("a"), F.lit("b")), ["cycle_id"], max_rows=70)
    got = docs.collect()
    assert sorted((r["cycle_id"], r["n_metrics"]) for r in got) == [(k, n) for k in (0, 1) for n in [30] + [70] * 21]
    metrics = [json.loads(r["body"])["resourceMetrics"][0]["scopeMetrics"][0]["metrics"] for r in got]
    times = [[m["gauge"]["dataPoints"][0]["timeUnixNano"] for m in d] for d in metrics]
    assert all(t == sorted(t) for t in times) and len({x for t in times for x in t}) == 3000
    plan = docs._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert all("gw_block" in line for line in plan.splitlines() if " Sort [" in line)
