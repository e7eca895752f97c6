"""Stateful streams: counter deltas, and scrapes held until they are whole.

State is kept in the state store, and no call holds all rows that a micro-batch has of one key: where
they come in several pieces, the pieces are put aside in the store and taken out again one by one.

A call has a price of its own, so keys are dealt over ``BUCKETS`` by a hash and a call takes a whole
bucket: its rows go through numpy together, only the small state is read and written key by key.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from gaugeworks.functions.numbers import micros
from gaugeworks.operators.ordered import DAY_US

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
#: Calls a micro-batch is dealt over. A checkpoint is bound to its number.
BUCKETS = 4096
#: Rows that a call hands on together.
ROWS_AT_ONCE = 10_000


def _text(df: DataFrame, key: str) -> Column:
    """A key column as text, equal where grouping takes the values as equal."""
    kind, value = df.schema[key].dataType, F.col(key)
    if isinstance(kind, T.BinaryType):
        value = F.hex(value)
    elif isinstance(kind, T.TimestampType):
        value = F.unix_micros(value)
    elif isinstance(kind, (T.FloatType, T.DoubleType)):
        value = F.when(value == 0, F.lit(0).cast(kind)).otherwise(value)
    return value.cast("string")


def in_buckets(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """Rows with the text of their key, ``__key``, and its bucket."""
    named = df.withColumn("__key", F.to_json(F.array(*[_text(df, k) for k in keys])))
    return named.withColumn("__bucket", F.pmod(F.xxhash64("__key"), F.lit(buckets)).cast("int"))


def own_columns(names: Sequence[str]) -> list[str]:
    return [n for n in names if not n.startswith("__")]


def packed(rows: pd.DataFrame | pa.Table) -> bytes:
    table = rows if isinstance(rows, pa.Table) else pa.Table.from_pandas(rows, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def unpacked(data: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(data).read_all().to_pandas()


class _Delta(StatefulProcessor):
    """Last time and counters of each key. Whole numbers come as text, since a column with an
    absent one would turn into doubles, and stay whole numbers. Without a column ``__key`` all rows
    of a call are of one key."""

    def __init__(self, names: list[str], cols: list[str], whole: list[bool], prefix: str, slice_us: int):
        self.names, self.cols, self.prefix, self.slice_us = names, cols, prefix, slice_us
        self.whole, self.keyed = whole, "__key" in names
        kinds = ["bigint" if w else "double" for w in whole]
        self.schema = ", ".join(["us bigint", *[f"c{i} {k}" for i, k in enumerate(kinds)]])

    def init(self, handle: StatefulProcessorHandle) -> None:
        if self.keyed:
            self.last = handle.getMapState("last", "key string", self.schema)
        else:
            self.state = handle.getValueState("state", self.schema)
        self.aside = handle.getMapState("aside", "slice bigint, piece int", "rows binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        # Rows arrive as tuples, which lose the names of columns that start with "_".
        parts = (part.set_axis(self.names, axis=1) for part in rows)
        first, second = next(parts), next(parts, None)
        if second is None:
            yield self._deltas(first)
            return
        # Several pieces, not in order: cut by time slice, and taken out slice by slice.
        held: dict[int, int] = {}
        for part in chain([first, second], parts):
            for number, own in part.groupby(part["__us"].fillna(-1) // self.slice_us, sort=False):
                number = int(number)
                self.aside.updateValue((number, held.get(number, 0)), (packed(own),))
                held[number] = held.get(number, 0) + 1
        first = second = None
        for number in sorted(held):
            own = []
            for piece in range(held[number]):
                own.append(unpacked(self.aside.getValue((number, piece))[0]))
                self.aside.removeKey((number, piece))
            yield self._deltas(pd.concat(own))

    def _before(self, key: str | None):
        if self.keyed:
            return self.last.getValue((key,))
        return self.state.get() if self.state.exists() else None

    def _after(self, key: str | None, row: tuple) -> None:
        if self.keyed:
            self.last.updateValue((key,), row)
        else:
            self.state.update(row)

    def _numbers(self, batch: pd.DataFrame, col: str, whole: bool) -> tuple[np.ndarray, np.ndarray]:
        """Values of a counter, and where there is none."""
        if whole:
            found = pa.array(batch[f"__{col}"], pa.string(), from_pandas=True).cast(pa.int64())
            return found.fill_null(0).to_numpy(zero_copy_only=False), found.is_null().to_numpy(zero_copy_only=False)
        found = batch[col].astype("Float64")
        return found.to_numpy(float, na_value=np.nan), found.isna().to_numpy()

    def _deltas(self, batch: pd.DataFrame) -> pd.DataFrame:
        code, keys = pd.factorize(batch["__key"]) if self.keyed else (np.zeros(len(batch), np.int64), [None])
        order = np.lexsort((batch["__us"], code))
        batch, code = batch.take(order).reset_index(drop=True), code[order]
        before = [self._before(key) for key in keys]
        # Rows older than the state come too late: they get no delta and do not move it. The same
        # holds for rows without a time.
        newest = np.array([-(1 << 63) if b is None else b[0] for b in before], np.int64)
        untimed = batch["__us"].isna().to_numpy()
        us = batch["__us"].fillna(0).to_numpy(np.int64)
        timely = np.flatnonzero(~untimed & (us >= newest[code]))
        own = code[timely]
        begins = np.append(True, own[1:] != own[:-1])[: len(own)]
        last = timely[np.append(own[1:] != own[:-1], True)[: len(own)]]
        kept, deltas, states = batch[own_columns(batch.columns)].copy(), {}, []
        for i, (c, w) in enumerate(zip(self.cols, self.whole), 1):
            array, kind = (pd.arrays.IntegerArray, np.int64) if w else (pd.arrays.FloatingArray, np.float64)
            now, absent = self._numbers(batch, c, w)
            none = np.array([b is None or b[i] is None for b in before], bool)
            first = np.array([0 if n else b[i] for b, n in zip(before, none)], kind)
            prior = np.where(begins, first[own], now[np.roll(timely, 1)])
            delta, gone = np.zeros(len(batch), kind), np.ones(len(batch), bool)
            delta[timely] = now[timely] - prior
            gone[timely] = absent[timely] | np.where(begins, none[own], absent[np.roll(timely, 1)])
            deltas[f"{self.prefix}{c}"] = array(delta, gone)
            states.append([None if a else v for v, a in zip(now[last].tolist(), absent[last])])
            if w:
                kept[c] = array(now, absent)
        for row in zip(code[last], us[last].tolist(), *states):
            self._after(keys[row[0]], row[1:])
        return pd.concat([kept, pd.DataFrame(deltas, index=batch.index)], axis=1)

    def close(self) -> None:
        pass


def counter_delta_stream(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    cols: Sequence[str],
    prefix: str = "d_",
    slice_us: int = DAY_US,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Difference of each counter to the previous sample of its key; NULL on the first one.

    Integer counters stay integers at any size. A sample older than the newest one of an earlier
    micro-batch, or without a time, gets NULL and is passed over. A task holds the rows that a bucket
    of keys has in one time slice of a micro-batch; ``slice_us`` and ``buckets`` bound them.
    """
    whole = [isinstance(df.schema[c].dataType, INTEGRAL) for c in cols]
    text = [F.col(c).cast("string").alias(f"__{c}") for c, w in zip(cols, whole) if w]
    timed = in_buckets(df, keys, buckets).select("*", *text, micros(F.col(order)).alias("__us"))
    extra = [
        T.StructField(f"{prefix}{c}", T.LongType() if w else T.DoubleType())
        for c, w in zip(cols, whole)
    ]
    return timed.groupBy("__bucket").transformWithStateInPandas(
        statefulProcessor=_Delta(timed.columns, list(cols), whole, prefix, slice_us),
        outputStructType=T.StructType([*df.schema.fields, *extra]),
        outputMode="Append",
        timeMode="None",
    )


class _Hold(StatefulProcessor):
    """Rows of scrapes in the store, and how many there are of each."""

    def __init__(self, names: list[str], expected: str, wait_ms: int | None):
        self.names, self.expected, self.wait_ms = names, expected, wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getMapState("rows", "scrape string, piece int", "rows binary")
        self.counts = handle.getMapState("counts", "scrape string", "n bigint, of bigint, pieces int, until bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        parts = (part.set_axis(self.names, axis=1) for part in rows)
        first, second = next(parts), next(parts, None)
        until = 0 if self.wait_ms is None else timerValues.getCurrentProcessingTimeInMs() + self.wait_ms
        seen: dict[str, list[int]] = {}
        held: list[tuple[str, pa.Table]] = []
        for part in chain([first], [] if second is None else [second], parts):
            for scrape, own in self._cut(part, seen, until):
                if second is None:
                    held.append((scrape, own))
                else:
                    self._aside(scrape, own, seen[scrape])
        first = None
        whole = {scrape: [] for scrape, (n, of, _, _) in seen.items() if n >= of}
        for scrape, own in held:
            if scrape in whole:
                whole[scrape].append(own)
            else:
                self._aside(scrape, own, seen[scrape])
        for scrape, count in seen.items():
            if scrape not in whole:
                self.counts.updateValue((scrape,), tuple(count))
        if any(until == count[3] for scrape, count in seen.items() if scrape not in whole) and self.wait_ms is not None:
            self.handle.registerTimer(until)
        yield from self._out(whole, seen, True)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        at = expiredTimerInfo.getExpiryTimeInMs()
        over = {scrape: list(count) for (scrape,), count in self.counts.iterator() if count[3] <= at}
        yield from self._out({scrape: [] for scrape in over}, over, False)

    def _cut(self, part: pd.DataFrame, seen: dict[str, list[int]], until: int) -> Iterator[tuple[str, pa.Table]]:
        """The rows of each scrape, counted: rows, rows expected, pieces put aside, time to wait till."""
        code, scrapes = pd.factorize(part["__key"])
        order = np.argsort(code, kind="stable")
        table = pa.Table.from_pandas(part[own_columns(self.names)].take(order), preserve_index=False)
        table = table.replace_schema_metadata(None)
        most = part[self.expected].groupby(code).max()
        sizes = np.bincount(code)
        for i, (scrape, end) in enumerate(zip(scrapes, np.cumsum(sizes).tolist())):
            if scrape not in seen:
                seen[scrape] = list(self.counts.getValue((scrape,)) or (0, 0, 0, until))
            count, size = seen[scrape], int(sizes[i])
            count[0], count[1] = count[0] + size, max(count[1], int(most[i]))
            yield scrape, table.slice(end - size, size)

    def _aside(self, scrape: str, own: pa.Table, count: list[int]) -> None:
        self.rows.updateValue((scrape, count[2]), (packed(own),))
        count[2] += 1

    def _out(self, fresh: dict[str, list[pa.Table]], counts: dict[str, list[int]], whole: bool) -> Iterator[pd.DataFrame]:
        """Scrapes with what is aside of them, several together, and out of the store."""
        some: list[pa.Table] = []
        for scrape, tables in fresh.items():
            for piece in range(counts[scrape][2]):
                tables.append(pa.ipc.open_stream(self.rows.getValue((scrape, piece))[0]).read_all())
                self.rows.removeKey((scrape, piece))
            self.counts.removeKey((scrape,))
            for table in tables:
                if some and (some[0].schema != table.schema or sum(map(len, some)) >= ROWS_AT_ONCE):
                    yield pa.concat_tables(some).to_pandas().assign(complete=whole)
                    some.clear()
                some.append(table)
            tables.clear()
        if some:
            yield pa.concat_tables(some).to_pandas().assign(complete=whole)

    def close(self) -> None:
        pass


def hold_scrapes(
    df: DataFrame, keys: Sequence[str], expected: str, wait_ms: int | None = None, buckets: int = BUCKETS
) -> DataFrame:
    """Rows of a stream, a scrape's only once all of them are there, then all in one micro-batch.

    The scrape's ``keys`` name it and the column ``expected`` says on every row how many it has. A
    scrape that is still incomplete ``wait_ms`` after its first row goes out as it is; the column
    ``complete`` tells which is which. Without ``wait_ms`` it waits for ever. Rows beyond the
    number that come later begin a scrape of their own. Scrapes are dealt over ``buckets``.
    """
    named = in_buckets(df, keys, buckets)
    return named.groupBy("__bucket").transformWithStateInPandas(
        statefulProcessor=_Hold(named.columns, expected, wait_ms),
        outputStructType=T.StructType([*df.schema.fields, T.StructField("complete", T.BooleanType())]),
        outputMode="Append",
        timeMode="None" if wait_ms is None else "ProcessingTime",
    )
