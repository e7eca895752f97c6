"""Row-local parsers for landed text bodies.

A body is complete in one row, so first-wins and last-wins are settled inside the
row with array expressions. Nothing here explodes a body into rows and groups it
back, which would shuffle the raw data.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from gaugeworks.functions.numbers import SPACE, as_number, drop_out_of_range, trim_ws
from gaugeworks.functions.records import record


# White space that may stand around a line (never the line feed itself).
WS = r"[ \t\x0B\f\r\u0085\u00a0]"
# The label of the 0.99 quantile, and how its samples are marked in a list.
QUANTILE = 'quantile="0.99"'
P99_MARK = "_p99!"


def split_lines(body: Column) -> Column:
    return F.split(body, "\n")


def fields(line: Column) -> Column:
    """White-space separated fields of a line."""
    return F.split(trim_ws(line), r"\s+")


def after_first(text: Column, sep: str) -> Column:
    """What follows the first ``sep``."""
    return F.substr(text, F.instr(text, sep) + F.lit(len(sep)))


def before_first(text: Column, sep: str) -> Column:
    return F.substring_index(text, sep, 1)


def named_lines(body: Column, keys: Sequence[str], after: str) -> Column:
    """Lines of a body that start with one of the given keys, in order.

    One regular expression pass picks them out, so the other lines of a long body are never
    turned into values. ``after`` is the pattern that must follow the key.
    """
    # Longer keys first, so that a key is not taken for a shorter one it starts with.
    names = "|".join(re.escape(k) for k in sorted(keys, key=len, reverse=True))
    return F.regexp_extract_all(body, F.lit(f"(?md)^{WS}*(?:{names}){after}"), F.lit(0))


def _pairs(lines: Column, sep: str) -> Column:
    """``array<struct<key, value, num>>``; the number follows the strict rule."""
    cut = F.transform(
        F.transform(lines, trim_ws),
        lambda l: record(key=before_first(l, sep), value=after_first(l, sep)),
    )
    return with_numbers(cut)


def with_numbers(pairs: Column) -> Column:
    """Add the strictly parsed number of each value. Two steps, so each is parsed once."""
    read = F.transform(
        pairs, lambda p: record(key=p["key"], value=p["value"], num=as_number(p["value"]))
    )
    return F.transform(
        read,
        lambda p: record(
            key=p["key"], value=p["value"], num=drop_out_of_range(p["num"], p["value"])
        ),
    )


def info_pairs(body: Column, keys: Sequence[str]) -> Column:
    """``key:value`` lines of the given keys, in order."""
    return _pairs(named_lines(body, keys, ":.*"), ":")


def _reply(body: Column) -> Column:
    # The first line must say OK, and a blank line ends the reply.
    head = F.get(F.split(body, rf"(?d)\n{WS}*(?=\n)", 2), F.lit(0))
    ended = F.when(F.length(head) < F.length(body), F.concat(head, F.lit("\n"))).otherwise(body)
    first = trim_ws(before_first(body, "\n"))
    return F.when(first.startswith("OK") & (F.instr(body, "\n") > 0), ended)


def yaml_pairs(body: Column, keys: Sequence[str]) -> Column:
    """``key: value`` lines of a stats reply; NULL when the reply is not OK.

    Only lines closed by a line feed count.
    """
    return _pairs(named_lines(_reply(body), keys, r": .*(?=\n)"), ": ")


def yaml_items(body: Column) -> Column:
    """``- item`` lines of a list reply in order; NULL when the reply is not OK."""
    items = F.regexp_extract_all(
        _reply(body), F.lit(rf"(?md)^{WS}*- (.*)(?=\n)"), F.lit(1)
    )
    return F.filter(F.transform(items, lambda i: F.rtrim(i, F.lit(SPACE))), lambda i: i != "")


def exposition_samples(
    body: Column, names: Sequence[str], mode: str = "first", timestamps: bool = False
) -> Column:
    """Samples of the given names as ``array<struct<key, value, num>>`` in order.

    ``first`` takes what follows the first closing brace as the value, ``p99`` what
    follows the last one; in that mode a line of the 0.99 quantile is listed a second time
    under ``<name>_p99!``. Lines whose value is no number are left out. ``timestamps`` lets
    labelled lines end in a timestamp.
    """

    def cut(line: Column) -> Column:
        labelled = F.instr(line, "{") > 0
        if mode == "first":
            labels = after_first(line, "{")
            tail = F.when(F.instr(labels, "}") > 0, after_first(labels, "}"))
        else:
            tail = F.when(F.instr(line, "}") > 0, F.substring_index(line, "}", -1))
        tail = trim_ws(tail)
        if timestamps:
            tail = F.try_element_at(F.split(tail, r"\s+"), F.lit(1))
        words = F.split(line, r"\s+", 3)
        name, value = F.try_element_at(words, F.lit(1)), F.try_element_at(words, F.lit(2))
        return record(
            key=F.when(labelled, before_first(line, "{")).otherwise(name),
            value=F.when(labelled, tail).otherwise(value),
        )

    lines = F.transform(named_lines(body, names, r"[ \t\x0B\f\r{].*"), trim_ws)
    samples = F.transform(lines, cut)
    if mode == "p99":
        quantiles = F.filter(lines, lambda l: F.contains(l, F.lit(QUANTILE)) & l.like("%{%"))
        marked = F.transform(F.transform(quantiles, cut), lambda p: record(
            key=F.concat(p["key"], F.lit(P99_MARK)), value=p["value"]
        ))
        samples = F.concat(samples, marked)
    return F.filter(with_numbers(samples), lambda p: p["num"].isNotNull())


def keep_last(pairs: Column) -> Column:
    """The last pair of each key, by key."""
    return _keep_one(pairs, -1)


def keep_first(pairs: Column) -> Column:
    """The first pair of each key, by key."""
    return _keep_one(pairs, 1)


def _keep_one(pairs: Column, step: int) -> Column:
    # Sorted by key and then by place, the wanted pair is the one whose left neighbour has
    # another key. Texts that repeat a name thousands of times are the rule.
    placed = F.array_sort(
        F.transform(
            pairs,
            lambda p, i: record(key=p["key"], at=i * step, value=p["value"], num=p["num"]),
        )
    )
    left = F.concat(F.array(F.lit(None)), F.transform(placed, lambda p: p["key"]))
    chosen = F.zip_with(
        placed, left, lambda p, key: F.when(p.isNotNull() & ~F.equal_null(p["key"], key), p)
    )
    return F.transform(
        F.filter(chosen, lambda p: p.isNotNull()),
        lambda p: record(key=p["key"], value=p["value"], num=p["num"]),
    )


def pairs_map(pairs: Column) -> Column:
    """``map<key, struct<value, num>>`` of pairs with distinct keys."""
    return F.map_from_entries(
        F.transform(
            pairs, lambda p: record(key=p["key"], value=record(value=p["value"], num=p["num"]))
        )
    )


def jmx_param(object_name: Column, param: str) -> Column:
    """Value of a named parameter of a JMX object name, empty when it is not there."""
    hits = F.filter(
        F.split(object_name, ","),
        lambda part: (F.instr(part, "=") > 0) & (trim_ws(before_first(part, "=")) == param),
    )
    return F.coalesce(after_first(F.try_element_at(hits, F.lit(1)), "="), F.lit(""))


def clip_chars(text: Column, n: int = 100) -> Column:
    return F.left(text, F.lit(n))


def clip_bytes(text: Column, n: int = 256) -> Column:
    """At most ``n`` bytes of UTF-8; a character cut in two shows as U+FFFD."""
    raw = F.encode(text, "UTF-8")
    cut = F.make_valid_utf8(F.substring(raw, 1, n).cast("string"))
    return F.when(F.octet_length(text) > n, cut).otherwise(text)


def qualify(schema: Column, table: Column) -> Column:
    return F.concat(schema, F.lit("."), table)


def url_tail(url: Column) -> Column:
    """Last path segment."""
    return F.substring_index(url, "/", -1)


def strip_prefix(text: Column, prefix: str) -> Column:
    return F.when(text.startswith(prefix), F.substr(text, F.lit(len(prefix) + 1))).otherwise(text)


def key_part(key: Column, index: int) -> Column:
    """The ``index``-th part of a colon separated key, counted from 1."""
    return F.try_element_at(F.split(key, ":"), F.lit(index))


def redact_userinfo(text: Column) -> Column:
    """Hide credentials written inside a URL."""
    return F.regexp_replace(text, r"(://)[^/\s@]*@", "$1***@")
