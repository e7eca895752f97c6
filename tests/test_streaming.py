"""Streams over several files give what the batch operators give."""

import time
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from gaugeworks.operators.ordered import counter_delta
from gaugeworks.schema import KEYS, METRIC_DDL
from gaugeworks.sources import databases, postgres
from gaugeworks.sources.sinks import read_batches, write_batch
from gaugeworks.streaming import stateful
from gaugeworks.streaming.run import DEFAULT_INTERVAL_MS, each_batch, interval_ms, run_stream, state_settings
from gaugeworks.streaming.stateful import counter_delta_stream, hold_scrapes
from helpers import AT, landed

T0 = datetime(2024, 1, 1)
DDL = "k string, ts timestamp_ntz, ok boolean, n double, queues array<string>"


def log_files(spark, folder, files=3):
    """A log written as several files that are read one per micro-batch."""
    rows = [
        ("ab"[i % 2], T0 + timedelta(seconds=70 * i), i % 5 == 0, float(i * i),
         None if i % 3 == 0 else [f"q{i}"] if i % 4 else [])
        for i in range(90)
    ]
    df = spark.createDataFrame(rows, DDL)
    for f in range(files):
        part = df.where(F.floor(F.col("n") ** 0.5 / (90 / files)) == f)
        part.coalesce(1).write.mode("append").parquet(folder)
    return df


def drain(spark, tmp_path, name, make):
    folder = str(tmp_path / name)
    df = log_files(spark, folder + "/in")
    stream = spark.readStream.schema(DDL).option("maxFilesPerTrigger", 1).parquet(folder + "/in")
    out = make(stream)
    with state_settings(spark):
        query = run_stream(out, folder + "/out", folder + "/ck", drain=True)
        query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) > 1
    return df, spark.read.schema(out.schema).parquet(folder + "/out")


def same(a, b, cols):
    def rows(df):
        return sorted(map(str, df.select(*cols).collect()))

    assert rows(a) == rows(b)


def test_counter_stream(spark, tmp_path):
    df, got = drain(spark, tmp_path, "c", lambda s: counter_delta_stream(s, ["k"], "ts", ["n"]))
    same(counter_delta(df, ["k"], "ts", ["n"]), got, ["k", "ts", "d_n"])


def test_each_batch_ranks_inside_a_batch(spark, tmp_path):
    rows = [("s", f"t{i:02d}", i, None, 1, 2) for i in range(12)]
    df = landed(spark, "pg_stat_user_tables", rows)
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    each_batch(
        stream, postgres.user_tables, str(tmp_path / "out"), str(tmp_path / "ck"), drain=True
    ).awaitTermination()
    assert read_batches(spark, str(tmp_path / "out")).count() == 40


# ---- Bounded state


class Value:
    """A value state in memory."""

    def __init__(self):
        self.row = None

    def exists(self):
        return self.row is not None

    def get(self):
        return self.row

    def update(self, row):
        self.row = row

    def clear(self):
        self.row = None


class Map:
    def __init__(self):
        self.rows, self.most = {}, 0

    def updateValue(self, key, row):
        self.rows[key] = row
        self.most = max(self.most, len(self.rows))

    def getValue(self, key):
        return self.rows[key]

    def removeKey(self, key):
        del self.rows[key]


class Handle:
    def getValueState(self, name, schema):
        return Value()

    def getMapState(self, name, key, schema):
        return Map()


BIG = 1 << 61


def pieces_of(n, size, seed=1):
    """A key's samples, out of order, in pieces as a worker gets them."""
    at = pd.Series(range(n)).sample(frac=1, random_state=seed).reset_index(drop=True)
    rows = pd.DataFrame({"k": "a", "n": at, "__n": (at * at + BIG).astype(str), "__us": at * 1_000_000})
    return (rows.iloc[i : i + size] for i in range(0, n, size))


def processor(slice_us=10_000 * 1_000_000):
    made = stateful._Delta(["k", "n", "__n", "__us"], ["n"], [True], "d_", slice_us)
    made.init(Handle())
    return made


def test_a_key_of_many_rows_is_never_held_whole():
    made, held, seen = processor(), [], 0
    for out in made.handleInputRows(("a",), pieces_of(200_000, 10_000), None):
        held.append(len(out))
        want = [None if n == BIG else 2 * (n - BIG) ** 0.5 - 1 for n in out["n"]]
        seen += len(out)
        assert out["d_n"].isna().sum() == sum(w is None for w in want)
        assert out["d_n"].dropna().astype(int).tolist() == [2 * i - 1 for i in range(seen - len(out), seen) if i]
    assert seen == 200_000 and max(held) == 10_000  # a slice
    assert made.aside.rows == {} and made.aside.most == 400  # 20 pieces in 20 slices


def test_pieces_and_one_piece_agree():
    one = pd.concat(processor().handleInputRows(("a",), pieces_of(500, 500), None))
    many = pd.concat(processor(7_000_000).handleInputRows(("a",), pieces_of(500, 60), None))
    assert one["d_n"].astype("Int64").tolist() == many["d_n"].astype("Int64").tolist()
    assert one["n"].tolist() == many["n"].tolist()


def test_whole_numbers_with_absent_ones(spark, tmp_path):
    rows = [("a", T0 + timedelta(seconds=i), None if i % 7 == 3 else BIG + i * i) for i in range(40)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, n bigint")
    folder = str(tmp_path / "w")
    for part in (df.where("second(ts) < 20"), df.where("second(ts) >= 20"), df.where("second(ts) = 5")):
        part.coalesce(1).write.mode("append").parquet(folder + "/in")
        stream = spark.readStream.schema(df.schema).parquet(folder + "/in")
        with state_settings(spark):
            run_stream(counter_delta_stream(stream, ["k"], "ts", ["n"]), folder + "/out", folder + "/ck", drain=True).awaitTermination()
    got = [(r["ts"], r["n"], r["d_n"]) for r in spark.read.parquet(folder + "/out").collect()]
    want = [(r["ts"], r["n"], r["d_n"]) for r in counter_delta(df, ["k"], "ts", ["n"]).collect()]
    late = (T0 + timedelta(seconds=5), BIG + 25, None)  # delivered again, too late
    assert sorted(got, key=str) == sorted([*want, late], key=str)


# ---- Scrapes in several files


def parts(target, n, cycle=1):
    return [(cycle, AT, target, "ch", i % 2, 10 * i, n) for i in range(n)]


def test_scrapes_are_held_until_they_are_whole(spark, tmp_path):
    schema = landed(spark, "ch_parts", []).schema.add("n_rows", "long")
    whole, slow, lost = parts("a", 30), parts("b", 7), parts("c", 5)
    files = [whole[:10] + slow[:3], whole[10:20] + lost[:4], whole[20:] + slow[3:]]
    folder = str(tmp_path / "h")

    def stream():
        return hold_scrapes(spark.readStream.schema(schema).parquet(folder + "/in"), KEYS, "n_rows")

    seen = []
    for rows in files:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder + "/in")
        with state_settings(spark):
            each_batch(stream(), databases.clickhouse_parts, folder + "/out", folder + "/ck", drain=True).awaitTermination()
        seen.append({r["target"] for r in read_batches(spark, folder + "/out").collect()})
    assert seen == [set(), set(), {"a", "b"}]
    got = read_batches(spark, folder + "/out").select("target", "name", "value").collect()
    want = databases.clickhouse_parts(spark.createDataFrame(whole + slow, schema)).select("target", "name", "value").collect()
    assert sorted(got) == sorted(want)


def test_a_scrape_that_stays_incomplete_goes_out_marked(spark, tmp_path):
    schema = landed(spark, "ch_parts", []).schema.add("n_rows", "long")
    folder = str(tmp_path / "i")
    spark.createDataFrame(parts("a", 5)[:3], schema).coalesce(1).write.parquet(folder + "/in")
    stream = hold_scrapes(spark.readStream.schema(schema).parquet(folder + "/in"), KEYS, "n_rows", wait_ms=500)
    with state_settings(spark):
        query = run_stream(stream, folder + "/out", folder + "/ck", every_ms=1000)
        end = time.time() + 60
        out = []
        while time.time() < end and not out:
            time.sleep(1)
            out = spark.read.schema(stream.schema).parquet(folder + "/out").collect() if (tmp_path / "i/out").exists() else []
        query.stop()
    assert len(out) == 3 and not any(r["complete"] for r in out)


# ---- Sinks and triggers


def metrics(spark, n, day=1):
    rows = [(datetime(2024, 1, day), i, "t", "m", float(i), "1", {}) for i in range(n)]
    return spark.createDataFrame(rows, METRIC_DDL)


def test_a_batch_is_written_once_however_often_it_is_tried(spark, tmp_path):
    path = str(tmp_path / "b")
    assert read_batches(spark, path).count() == 0
    half = metrics(spark, 3, day=2).withColumn("date", F.to_date("ts"))
    half.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").partitionBy("date").parquet(f"{path}/batch=1")
    write_batch(metrics(spark, 5), path, 0)
    assert read_batches(spark, path).count() == 5  # the half-written one does not count
    for _ in range(2):
        write_batch(metrics(spark, 7), path, 1)
    assert sorted(r["batch"] for r in read_batches(spark, path).collect()) == [0] * 5 + [1] * 7
    assert read_batches(spark, path).where("date = '2024-01-02'").count() == 0


@pytest.mark.parametrize("asked", [1500, 200])
def test_interval_trigger(spark, tmp_path, asked):
    """A new file waits for the next trigger; an interval that is too short becomes the default."""
    folder = str(tmp_path / "t")
    metrics(spark, 2).coalesce(1).write.parquet(folder + "/in")
    stream = spark.readStream.schema(METRIC_DDL).parquet(folder + "/in")
    query = run_stream(stream, folder + "/out", folder + "/ck", every_ms=asked)
    started = []
    end = time.time() + 30
    while time.time() < end and not query.recentProgress:
        time.sleep(0.1)
    for day in (2, 3):
        metrics(spark, 2, day).coalesce(1).write.mode("append").parquet(folder + "/in")
        time.sleep(1.6)
    time.sleep(1.5)
    started = [p for p in query.recentProgress if p["numInputRows"]]
    query.stop()
    if interval_ms(asked) == asked:
        at = [datetime.fromisoformat(p["timestamp"].replace("Z", "+00:00")).timestamp() for p in started]
        assert len(at) >= 2 and all(b - a >= 1.3 for a, b in zip(at, at[1:]))
    else:
        assert interval_ms(asked) == DEFAULT_INTERVAL_MS and len(started) == 1


# ---- Many keys in one call


class Found(Map):
    """A map state that has nothing under an unknown key, as the store's."""

    def getValue(self, key):
        return self.rows.get(key)

    def removeKey(self, key):
        self.rows.pop(key, None)


class FoundHandle(Handle):
    def getMapState(self, name, key, schema):
        return Found()


def test_deltas_of_a_bucket_come_together():
    """One call and one frame for 300 keys; each has its own state, late rows and rows without a time."""
    made = stateful._Delta(["k", "n", "__n", "__us", "__key"], ["n"], [True], "d_", 10**12)
    made.init(FoundHandle())

    def call(rows):
        frame = pd.DataFrame(rows, columns=["k", "n", "__us"])
        frame.insert(2, "__n", frame["n"].astype(str))
        (out,) = made.handleInputRows((7,), iter([frame.assign(__key=frame["k"])]), None)
        assert list(out.columns) == ["k", "n", "d_n"]
        return {(k, int(n)): None if pd.isna(d) else int(d) for k, n, d in zip(out["k"], out["n"], out["d_n"])}

    got = call([(f"k{i}", BIG + i * j, j) for j in (2, 1) for i in range(300)])
    assert all(got[f"k{i}", BIG + 2 * i] == i and (i == 0 or got[f"k{i}", BIG + i] is None) for i in range(1, 300))
    got = call([(f"k{i}", BIG + 5 * i, 3) for i in range(1, 300)] + [("k1", BIG, 1), ("k2", BIG, None), ("new", BIG, 0)])
    assert all(got[f"k{i}", BIG + 5 * i] == 3 * i for i in range(1, 300))
    assert got["k1", BIG] is None and got["k2", BIG] is None and got["new", BIG] is None


@pytest.mark.parametrize("size", [10_000, 130])
def test_scrapes_of_a_bucket_come_together(size):
    """200 scrapes of one bucket, in one piece and in several: whole ones in one frame, the rest aside."""
    made = stateful._Hold(["k", "v", "of", "__key"], "of", None)
    made.init(FoundHandle())

    def call(rows):
        frame = pd.DataFrame(rows, columns=["k", "v", "of"]).assign(__key=lambda f: f["k"])
        parts = (frame.iloc[i : i + size] for i in range(0, len(frame), size))
        out = list(made.handleInputRows((7,), parts, None))
        assert len(out) <= 1 and all(list(f.columns) == ["k", "v", "of", "complete"] and f["complete"].all() for f in out)
        return sorted((k, v) for f in out for k, v in zip(f["k"], f["v"]))

    assert call([(f"s{i}", j, 3) for j in range(2) for i in range(200)]) == []
    assert call([(f"s{i}", 2, 3) for i in range(0, 200, 2)] + [("t", 0, 1)]) == sorted(
        [(f"s{i}", j) for i in range(0, 200, 2) for j in range(3)] + [("t", 0)]
    )
    assert {k for k, _ in made.rows.rows} == {k for (k,) in made.counts.rows} == {f"s{i}" for i in range(1, 200, 2)}
