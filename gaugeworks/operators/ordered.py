"""Ordered operators: caps, top-n, first/last, deltas, runs.

Operators that follow one key through time cut each key into time slices. A slice is
worked on independently and takes what it needs from earlier slices out of a small
per-slice summary, so one key that holds most rows still spreads over many tasks. Rows and
summaries start from one shuffle by key and slice (``sliced``), so the input is read once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from gaugeworks.functions.numbers import enum_code, micros
from gaugeworks.functions.text import redact_userinfo

SLICE, PART = "__slice", "__part"
DAY_US = 86_400_000_000


def sliced(df: DataFrame, keys: Sequence[str], order: str, slice_us: int) -> DataFrame:
    """Rows dealt by key and time slice, the struct ``__part``. What is derived from it in two ways
    shares the shuffle, as long as both ways need every column: summaries take whole rows for that.

    The struct is never NULL, whatever the keys are, so a join on it adds no filter to one side
    only, and absent keys meet.
    """
    number = F.floor(micros(F.col(order)) / F.lit(slice_us)).cast("bigint")
    part = F.struct(*keys, number.alias(SLICE)).alias(PART)
    return df.select("*", part).repartition(PART)


def part_keys(keys: Sequence[str]) -> list[Column]:
    """Keys of a summary of parts."""
    return [F.col(PART)[k] for k in keys]


def over_slices(keys: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*part_keys(keys)).orderBy(F.col(PART)[SLICE])


def top_n(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 10, rank: str = "rank"
) -> DataFrame:
    """First ``n`` rows per key. Spark cuts each map task to ``n`` per key before the shuffle."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(rank, place).where(F.col(rank) <= n)


def top_desc(
    df: DataFrame, keys: Sequence[str], by: str, tie: Sequence[str], n: int = 10
) -> DataFrame:
    """First ``n`` rows per key by a column, descending, absent values last."""
    order = [F.col(by).desc_nulls_last(), *[F.col(t) for t in tie]]
    return top_n(df, keys, order, n)


def cap_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int
) -> tuple[DataFrame, DataFrame]:
    """First ``n`` rows per key in listing order, and per key how many were left out."""
    kept = top_n(df, keys, [F.col(o) for o in order], n)
    truncated = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("total"))
        .withColumn("truncated", F.greatest(F.lit(0).cast("bigint"), F.col("total") - n))
    )
    return kept, truncated


def first_per_key(df: DataFrame, keys: Sequence[str], pos: str, cols: Sequence[str]) -> DataFrame:
    """Keep the first listed row per key."""
    return df.groupBy(*keys).agg(*[F.min_by(c, pos).alias(c) for c in cols])


def last_per_key(df: DataFrame, keys: Sequence[str], pos: str, cols: Sequence[str]) -> DataFrame:
    """Keep the last listed row per key.

    With fixed-width columns (numbers, times) this is a hash aggregate without a sort, so
    parse text to numbers before calling it.
    """
    return df.groupBy(*keys).agg(*[F.max_by(c, pos).alias(c) for c in cols])


def log_head(
    log: DataFrame, keys: Sequence[str], entry: str, value: str, n: int = 10
) -> DataFrame:
    """Number of entries among the last ``n`` of a log, and the value of the latest one."""
    head = top_n(log, keys, [F.col(entry).desc()], n)
    return head.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.max_by(value, entry).alias("latest")
    )


def counter_delta(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    cols: Sequence[str],
    slice_us: int = DAY_US,
    prefix: str = "d_",
) -> DataFrame:
    """Difference of each counter to the previous sample of its key; NULL on the first one.

    Sample times must be unique per key. The last row of each slice is carried to the next one.
    """
    rows = sliced(df, keys, order, slice_us)
    tails = rows.groupBy(PART).agg(F.max_by(F.struct(*df.columns), order).alias("__tail"))
    carried = tails.select(PART, F.lag("__tail").over(over_slices(keys)).alias("__before"))
    inside = Window.partitionBy(PART).orderBy(order)
    local = rows.select(
        "*",
        F.row_number().over(inside).alias("__at"),
        *[F.lag(c).over(inside).alias(f"__lag_{c}") for c in cols],
    )

    def prior(c: str) -> Column:
        return F.when(F.col("__at") == 1, F.col("__before")[c]).otherwise(F.col(f"__lag_{c}"))

    return local.join(carried, PART, "left").select(
        *df.columns, *[(F.col(c) - prior(c)).alias(f"{prefix}{c}") for c in cols]
    )


def share_of_delta(deltas: Sequence[Column], part: Column) -> Column:
    """Percentage one delta has of all deltas; NULL when nothing moved."""
    total = deltas[0]
    for d in deltas[1:]:
        total = total + d
    moved = F.when(total != 0, total.cast("double"))
    return F.lit(100.0) * part / moved


def _runs(
    attempts: DataFrame, keys: Sequence[str], order: str, ok: str, slice_us: int, seq: str | None
) -> tuple[DataFrame, DataFrame]:
    """Run lengths inside each slice, and a row for each slice with the run that leaves it.

    Rows get ``__at``, ``__run``, ``__good`` (time of the last success) and ``__base`` (NULL before
    the first success), all of the slice alone. Slices have ``tail`` and ``end`` (run that leaves
    the slice, without and with what came in), ``good`` (last success) and ``last`` (last row).
    """
    good = F.coalesce(F.col(ok), F.lit(False))
    # Without a sequence number, failures of one time come before its successes.
    at = [F.col(order), good if seq is None else F.col(seq)]
    inside = Window.partitionBy(PART).orderBy(*at).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    counted = sliced(attempts, keys, order, slice_us).select(
        "*",
        F.row_number().over(inside).alias("__at"),
        F.sum(F.when(good, 0).otherwise(1)).over(inside).alias("__f"),
        F.max(F.when(good, F.col(order))).over(inside).alias("__good"),
    )
    # Failures counted when the last success of this slice came; NULL before the first one.
    based = counted.withColumn("__base", F.max(F.when(good, F.col("__f"))).over(inside))
    rows = based.withColumn("__run", F.col("__f") - F.coalesce("__base", F.lit(0)))
    last = F.max_by(F.struct(*attempts.columns, "__run", "__good"), "__at")
    slices = rows.groupBy(PART).agg(last.alias("last")).select(
        PART, "last", F.col("last.__run").alias("tail"), F.col("last.__good").alias("good")
    )
    island = slices.withColumn("__island", F.count("good").over(over_slices(keys)))
    run = Window.partitionBy(*part_keys(keys), "__island").orderBy(F.col(PART)[SLICE])
    return rows, island.withColumn("end", F.sum("tail").over(run))


def failure_runs(
    attempts: DataFrame,
    keys: Sequence[str],
    order: str,
    ok: str = "ok",
    error: str | None = None,
    slice_us: int = DAY_US,
    seq: str | None = None,
) -> DataFrame:
    """Consecutive failures up to each attempt, time of the last success, last error.

    A success resets the run and clears the error; an unknown outcome is a failure. ``seq``
    orders attempts of one time; without it failures of one time come before its successes. A
    key of very many attempts in one slice is one task's work: ``slice_us`` is the way out.
    """
    rows, ended = _runs(attempts, keys, order, ok, slice_us, seq)
    before = over_slices(keys).rowsBetween(Window.unboundedPreceding, -1)
    carried = ended.select(
        PART,
        F.lag("end").over(over_slices(keys)).alias("__in_run"),
        F.max("good").over(before).alias("__in_good"),
    )
    carry = F.when(F.col("__base").isNull(), F.coalesce("__in_run", F.lit(0))).otherwise(0)
    out = [
        (F.col("__run") + carry).cast("bigint").alias("consecutive_failures"),
        F.coalesce("__good", "__in_good").alias("last_success"),
    ]
    if error is not None:
        failed = ~F.coalesce(F.col(ok), F.lit(False))
        out.append(F.when(failed, redact_userinfo(F.col(error))).alias("last_error"))
    return rows.join(carried, PART, "left").select(*[F.col(c) for c in attempts.columns], *out)


def latest_run(
    attempts: DataFrame,
    keys: Sequence[str],
    order: str,
    ok: str = "ok",
    error: str | None = None,
    seq: str | None = None,
    slice_us: int = DAY_US,
) -> DataFrame:
    """Current run length, last success and last error per key, out of the slices' summaries.

    An unknown outcome is a failure; ``seq`` orders attempts of one time, without it failures
    of one time come before its successes.
    """
    _, ended = _runs(attempts, keys, order, ok, slice_us, seq)
    # The slice is null where the time is; such attempts come first.
    number = F.coalesce(F.col(PART)[SLICE], F.lit(-(1 << 63)))
    latest = ended.groupBy(*[k.alias(n) for k, n in zip(part_keys(keys), keys)]).agg(
        F.max("good").alias("last_success"), F.max_by(F.struct("end", "last"), number).alias("__l")
    )
    run = F.col("__l.end").cast("bigint")
    out = [F.col(k) for k in keys] + [F.col("last_success"), run.alias("consecutive_failures")]
    if error is not None:
        text = redact_userinfo(F.col("__l.last")[error])
        out.append(F.when(run > 0, text).alias("last_error"))
    return latest.select(*out)


# Failures that open a circuit, and the code of each status.
OPEN_AFTER = 5
STATUS_CODE = {"ok": 1.0, "degraded": 0.5, "open": 0.0}


def status_of(failures: Column, threshold: int = OPEN_AFTER) -> Column:
    return (
        F.when(failures >= threshold, "open").when(failures > 0, "degraded").otherwise("ok")
    )


def collector_health(runs: DataFrame, threshold: int = OPEN_AFTER) -> DataFrame:
    """Status label and numeric health on top of a run length."""
    status = status_of(F.col("consecutive_failures"), threshold)
    return runs.withColumn("status", status).withColumn(
        "health", enum_code(F.col("status"), STATUS_CODE, 1.0)
    )
