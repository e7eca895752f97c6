"""Host text files: CPU, memory, network, load; and the mount table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gaugeworks.functions.attrs import base_attrs
from gaugeworks.functions.numbers import convert, num_zero, ratio, trim_ws
from gaugeworks.functions.records import record
from gaugeworks.functions.text import (
    WS,
    after_first,
    before_first,
    fields,
    named_lines,
    split_lines,
    with_numbers,
)
from gaugeworks.operators.join import as_of
from gaugeworks.operators.ordered import DAY_US, counter_delta, first_per_key, share_of_delta
from gaugeworks.operators.shape import (
    keyed,
    kv_num,
    once,
    real_mount,
    to_metrics,
)
from gaugeworks.schema import KEYS

#: What a host is; landed when it changes.
FACTS = ["host_name", "arch", "os_type"]


def with_facts(df: DataFrame, facts: DataFrame | None) -> DataFrame:
    """Rows with the facts of their host as of their time; unknown ones are absent. Join parsed
    rows, not replies: they are shuffled."""
    if facts is None:
        return df.withColumns({c: F.lit(None).cast("string") for c in FACTS})
    return as_of(df, facts, ["target_name", "instance"], "collected_at", FACTS)


# Columns of the cpu line in file order.
CPU_TIMES = ["user", "nice", "system", "idle", "iowait", "irq", "softirq", "steal"]


def cpu_samples(df: DataFrame, cores: Column | None = None) -> DataFrame:
    """CPU counters of each snapshot; a text without a full cpu line is no sample.

    ``cores`` is the CPU count where it is landed; by default the per-CPU lines are counted.
    """
    lines = split_lines(F.col("body"))
    total_line = F.try_element_at(F.filter(lines, lambda l: l.startswith("cpu ")), F.lit(1))
    per_cpu = F.size(F.filter(lines, lambda l: l.rlike("^cpu[0-9]")))
    split = once(
        df.withColumn("cores", (per_cpu if cores is None else cores).cast("double")),
        "f",
        fields(total_line),
    ).where(F.size("f") >= 8)
    return split.select(
        *KEYS,
        "cores",
        *[
            num_zero(F.coalesce(F.try_element_at("f", F.lit(i + 2)), F.lit(""))).alias(name)
            for i, name in enumerate(CPU_TIMES)
        ],
    )


def cpu_rows(deltas: DataFrame) -> DataFrame:
    """CPU gauges from counter deltas (columns ``d_*``); the first sample has no shares."""
    d = {name: F.col(f"d_{name}") for name in CPU_TIMES}
    parts = list(d.values())
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    moved = F.when(total != 0, total)
    shown = deltas.where(total.isNull() | (total != 0))
    busy = F.lit(100.0) * (F.lit(1.0) - d["idle"] / moved)
    specs = [
        ("host.cpu.cores", F.col("cores"), "{cores}"),
        ("host.cpu.utilization", busy, "%"),
        ("host.cpu.user", share_of_delta(parts, d["user"]), "%"),
        ("host.cpu.system", share_of_delta(parts, d["system"]), "%"),
        ("host.cpu.iowait", share_of_delta(parts, d["iowait"]), "%"),
        ("host.cpu.steal", share_of_delta(parts, d["steal"]), "%"),
    ]
    return to_metrics(shown, specs, base_attrs("host"))


def cpu(
    df: DataFrame,
    cores: Column | None = None,
    slice_us: int = DAY_US,
    facts: DataFrame | None = None,
) -> DataFrame:
    """CPU shares between consecutive snapshots of a host."""
    samples = cpu_samples(df, cores)
    deltas = counter_delta(samples, ["target_name", "instance"], "collected_at", CPU_TIMES, slice_us)
    return cpu_rows(with_facts(deltas, facts))


# Meminfo keys.
MEM_KEYS = ["MemTotal", "MemAvailable", "Buffers", "Cached", "SwapTotal", "SwapFree"]


def memory(df: DataFrame, facts: DataFrame | None = None) -> DataFrame:
    """Memory gauges in bytes; utilisation and swap only where there is any."""
    def number(l: Column) -> Column:
        return record(
            key=trim_ws(before_first(l, ":")),
            value=trim_ws(F.regexp_replace(trim_ws(after_first(l, ":")), r" kB\z", "")),
        )

    listed = named_lines(F.col("body"), MEM_KEYS, rf"{WS}*:.*")
    numbers = with_numbers(F.transform(listed, number))
    parsed = keyed(df, F.filter(numbers, lambda p: p["num"].isNotNull()))
    wide = parsed.select(
        *KEYS,
        *[
            F.coalesce(convert(kv_num(k), "kb_to_bytes"), F.lit(0.0)).alias(k)
            for k in MEM_KEYS
        ],
    )
    total, free = F.col("MemTotal"), F.col("MemAvailable")
    swap = F.col("SwapTotal")
    specs = [
        ("host.memory.total", total, "By"),
        ("host.memory.available", free, "By"),
        ("host.memory.used", total - free, "By"),
        ("host.memory.buffers", F.col("Buffers"), "By"),
        ("host.memory.cached", F.col("Cached"), "By"),
        ("host.memory.utilization", ratio(F.lit(100.0) * (total - free), total), "%"),
        ("host.memory.swap_total", F.when(swap > 0, swap), "By"),
        ("host.memory.swap_used", F.when(swap > 0, swap - F.col("SwapFree")), "By"),
    ]
    return to_metrics(with_facts(wide, facts), specs, base_attrs("host"))


# Field number, metric name, unit.
NET_FIELDS = [
    (1, "host.network.receive_bytes", "By"),
    (2, "host.network.receive_packets", "{packets}"),
    (3, "host.network.receive_errors", "{errors}"),
    (4, "host.network.receive_drops", "{drops}"),
    (9, "host.network.transmit_bytes", "By"),
    (10, "host.network.transmit_packets", "{packets}"),
    (11, "host.network.transmit_errors", "{errors}"),
    (12, "host.network.transmit_drops", "{drops}"),
]
NET_HEADER = 2
NET_MIN_FIELDS = 12


def network(df: DataFrame, facts: DataFrame | None = None) -> DataFrame:
    """Interface counters without the loopback."""
    lines = split_lines(F.col("body"))
    rows = F.slice(lines, NET_HEADER + 1, F.greatest(F.size(lines) - NET_HEADER, F.lit(0)))
    cut = F.transform(
        F.filter(rows, lambda l: F.instr(l, ":") > 0),
        lambda l: record(iface=trim_ws(before_first(l, ":")), f=fields(after_first(l, ":"))),
    )
    shown = df.select(*KEYS, F.inline(cut)).where(
        (F.col("iface") != "lo") & (F.size("f") >= NET_MIN_FIELDS)
    )
    specs = [(name, num_zero(F.get("f", F.lit(i - 1))), unit) for i, name, unit in NET_FIELDS]
    return to_metrics(
        with_facts(shown, facts), specs, base_attrs("host", {"host.network.interface": F.col("iface")})
    )


def disk(mounts: DataFrame, facts: DataFrame | None = None) -> DataFrame:
    """Size gauges per device. The first mount of a device counts, readable or not."""
    real = mounts.where(real_mount(F.col("device"), F.col("fstype")))
    cols = ["mountpoint", "blocks", "bsize", "bfree", "bavail", "statfs_ok"]
    first = first_per_key(real, [*KEYS, "device"], "pos", cols).where("statfs_ok")
    size = F.col("bsize").cast("decimal(20,0)")
    total, unused = F.col("blocks") * size, F.col("bfree") * size
    used = total - unused
    specs = [
        ("host.disk.total", total, "By"),
        ("host.disk.used", used, "By"),
        ("host.disk.free", F.col("bavail") * size, "By"),
        (
            "host.disk.utilization",
            ratio(F.lit(100.0) * used.cast("double"), total.cast("double")),
            "%",
        ),
    ]
    attrs = base_attrs(
        "host",
        {"host.disk.device": F.col("device"), "host.disk.mountpoint": F.col("mountpoint")},
    )
    return to_metrics(with_facts(first, facts), specs, attrs)


def load(df: DataFrame, facts: DataFrame | None = None) -> DataFrame:
    """Load averages; a text with fewer than three fields gives no rows."""
    split = once(df, "f", fields(F.col("body"))).where(F.size("f") >= 3)
    names = ["host.load.1m", "host.load.5m", "host.load.15m"]
    specs = [(n, num_zero(F.get("f", F.lit(i))), "1") for i, n in enumerate(names)]
    # Narrow before facts are joined: a reply is not shuffled.
    narrow = split.select(*KEYS, "f")
    return to_metrics(with_facts(narrow, facts), specs, base_attrs("host"))
