"""Benchmark decontamination with a generalised suffix automaton of the test items.

Words are runs of ASCII letters and digits and of non-ASCII characters, in lower case. The items
go into automata of a bounded number of words each (``BLOCK_WORDS``), which are built in tasks,
written, and broadcast one after the other; every document streams its words through each block's automaton, which tells at each word the longest
match that ends there. A window is ``window`` consecutive words of an item, or a whole item of
fewer words; every word inside an occurrence of a window is hit.

Stretches of words whose neighbours never stand together in any item cannot hold a window and are
passed over in numpy; the automaton sees the rest.

Null and empty texts have no words and are clean; items without words are no items. A null
item id is named by the empty text. Repeated rows and ids get a row each; items of one id count
once.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.llm.common import Shared, pieces, query, table
from gaugeworks.llm.tokens import ALNUM, Words, buffers, mix, split

WINDOW = 13
COVERAGE_PERCENT = 5
#: Words of items in one automaton: bounds what is broadcast to about 100 MB.
BLOCK_WORDS = 200_000

_U = np.uint64


class Automaton:
    """Suffix automaton of several word sequences."""

    def __init__(self, window: int):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.items: dict[int, set[str]] = {}  #: state of a window -> items that have it
        self.short: dict[int, tuple[int, set[str]]] = {}  #: state of a whole short item
        self.vocabulary: dict[int, int] = {}
        self.pairs: set[int] = set()
        self.least = window
        self._read: list[tuple[str, list[int]]] = []

    def add(self, item: str, hashes: np.ndarray) -> None:
        words = [self.vocabulary.setdefault(int(h), len(self.vocabulary)) for h in hashes]
        if not words:
            return
        self.least = min(self.least, len(words))
        self.pairs.update(mix(hashes[:-1] * _U(3) + hashes[1:]).tolist())
        last = 0
        for w in words:
            last = self._extend(last, w)
        self._read.append((item, words))

    def _new(self, length: int, after: dict[int, int], link: int) -> int:
        self.next.append(after)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _clone(self, p: int, q: int, w: int) -> int:
        """Split off of q what p reaches with w."""
        c = self._new(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = c
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = c
            p = self.link[p]
        return c

    def _extend(self, last: int, w: int) -> int:
        if w in self.next[last]:  # an earlier item went this way
            q = self.next[last][w]
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, q, w)
        state, p = self._new(self.length[last] + 1, {}, 0), last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = state
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[state] = q if self.length[q] == self.length[p] + 1 else self._clone(p, q, w)
        return state

    def finish(self) -> Automaton:
        """Note at which states windows and short items lie, once all items are in."""
        self.window_state = [self._at_length(s, self.window) for s in range(len(self.next))]
        for item, words in self._read:
            state = 0
            for i, w in enumerate(words):
                state = self.next[state][w]
                if i + 1 >= self.window:
                    self.items.setdefault(self.window_state[state], set()).add(item)
            if len(words) < self.window:
                self.short.setdefault(state, (len(words), set()))[1].add(item)
        self.short_state = [-1] * len(self.next)
        for s in sorted(range(len(self.next)), key=self.length.__getitem__):
            self.short_state[s] = s if s in self.short else (self.short_state[self.link[s]] if s else -1)
        del self._read
        known = np.array(sorted(self.vocabulary), _U)
        self.known, self.ids = known, np.array([self.vocabulary[int(h)] for h in known], np.int64)
        self.pairs = np.array(sorted(self.pairs), _U)
        return self

    def _at_length(self, state: int, n: int) -> int:
        """The state on the way to the root that holds strings of n words, or -1."""
        if self.length[state] < n:
            return -1
        while self.length[self.link[state]] >= n:
            state = self.link[state]
        return state

    def stretches(self, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word ids, and begin and end of the stretches that can hold a window."""
        if not len(self.known):
            none = np.zeros(0, np.int64)
            return none, none, none
        at = np.searchsorted(self.known, hashes)
        at[at == len(self.known)] = 0
        ids = np.where(self.known[at] == hashes, self.ids[at], -1)
        joined = np.zeros(len(hashes) + 1, bool)  # whether a word goes on from the one before
        if len(hashes) > 1 and len(self.pairs):
            two = mix(hashes[:-1] * _U(3) + hashes[1:])
            k = np.searchsorted(self.pairs, two)
            k[k == len(self.pairs)] = 0
            joined[1:-1] = self.pairs[k] == two
        joined[first] = False
        begin = np.flatnonzero(~joined[:-1])
        end = np.append(begin[1:], len(hashes))
        long = (end - begin >= self.least) & (ids[begin] >= 0)
        return ids, begin[long], end[long]

    def stream(self, ids: list[int]) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Longest match, hit word ranges and items of one stretch of words."""
        state, matched, longest, spans, items = 0, 0, 0, [], set()
        after, link, length, window = self.next, self.link, self.length, self.window
        for i, w in enumerate(ids):
            while state and w not in after[state]:
                state = link[state]
                matched = length[state]
            if w in after[state]:
                state = after[state][w]
                matched += 1
            longest = max(longest, matched)
            if matched >= window:
                spans.append((i - window + 1, i + 1))
                items |= self.items[self.window_state[state]]
            s = self.short_state[state]
            while s >= 0:
                n, names = self.short[s]
                if n <= matched:
                    spans.append((i - n + 1, i + 1))
                    items |= names
                s = self.short_state[link[s]]
        return longest, spans, items


def _build(window: int):
    def each(group: pa.Table) -> pa.Table:
        automaton = Automaton(window)
        for item, text in sorted(zip(group.column("item_id").to_pylist(), group.column("text").to_pylist(), strict=True), key=str):
            automaton.add(item, split(pa.array([text], pa.string()), ALNUM).hashes())
        data = pickle.dumps(automaton.finish(), pickle.HIGHEST_PROTOCOL)
        return pa.table({"block": group.column("block").slice(0, 1), "automaton": pa.array([data], pa.binary())})

    return each


def blocks(items: DataFrame, shared: Shared, window: int, block_words: int) -> Iterator[bytes]:
    """Automata, pickled, over all items (item_id, text), of about ``block_words`` words each."""
    rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.col("text").cast("string").alias("text"))
    words = F.regexp_count("text", F.lit("[0-9A-Za-z\\x{80}-\\x{10FFFF}]+"))
    n_blocks = (rows.agg(F.sum(words)).first()[0] or 0) // block_words + 1
    numbered = rows.where("text IS NOT NULL").withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)))
    built = shared.keep(numbered.groupBy("block").applyInArrow(_build(window), "block long, automaton binary"), "automata")
    for number in range(n_blocks):
        for row in built.where(F.col("block") == number).select("automaton").collect():  # one
            yield bytes(row[0])


def _merged(spans: list[tuple[int, int]]) -> list[int]:
    out: list[int] = []
    for a, b in sorted(spans):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += (a, b)
    return out


def _matches(words: Words, automaton: Automaton) -> dict[int, tuple[int, list, set]]:
    """By text: longest match, spans of word numbers within the text, items."""
    ids, begin, end = automaton.stretches(words.hashes(), words.first)
    owner = np.searchsorted(words.first, begin, "right") - 1
    found: dict[int, tuple[int, list, set]] = {}
    for a, b, d in zip(begin.tolist(), end.tolist(), owner.tolist(), strict=True):
        longest, spans, items = automaton.stream(ids[a:b].tolist())
        base = a - int(words.first[d])
        most, all_spans, all_items = found.get(d, (0, [], set()))
        found[d] = (max(most, longest), all_spans + [(base + x, base + y) for x, y in spans], all_items | items)
    return found


def _scan(shared_automaton):
    def each(batches):
        automaton = pickle.loads(shared_automaton.value)
        for batch in pieces(batches, "gw_text"):
            words = split(batch.column("gw_text"), ALNUM)
            found = _matches(words, automaton) if len(words.start) else {}
            spans, items = batch.column("gw_spans").to_pylist(), batch.column("gw_items").to_pylist()
            longest = batch.column("gw_longest").to_pylist()
            for d, (most, more, names) in found.items():
                pairs = list(zip(spans[d][::2], spans[d][1::2], strict=True))
                spans[d] = _merged(pairs + more)
                items[d] = sorted(names | set(items[d]))
                longest[d] = max(most, longest[d])
            names = batch.schema.names
            new = {
                "gw_words": pa.array(words.counts(), pa.int64()),
                "gw_spans": pa.array(spans, pa.list_(pa.int64())),
                "gw_items": pa.array(items, pa.list_(pa.string())),
                "gw_longest": pa.array(longest, pa.int64()),
            }
            yield pa.RecordBatch.from_arrays([new.get(n, batch.column(n)) for n in names], names)

    return each


def matches(
    rows: DataFrame, items: DataFrame, shared: Shared, window: int = WINDOW, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """``rows`` with ``gw_text`` to the same with gw_words (count), gw_spans (begin, end, ... of
    hit words), gw_items (ids found) and gw_longest (longest match)."""
    state = rows.withColumns(
        {
            "gw_words": F.lit(0).cast("long"),
            "gw_spans": F.array().cast("array<long>"),
            "gw_items": F.array().cast("array<string>"),
            "gw_longest": F.lit(0).cast("long"),
        }
    )
    sc, last = rows.sparkSession.sparkContext, None
    for k, automaton in enumerate(blocks(items, shared, window, block_words)):
        if last is not None:
            state = shared.keep(state, f"block-{k}")
            last.destroy()
        last = sc.broadcast(automaton)
        state = state.mapInArrow(_scan(last), state.schema)
    if last is None:  # no items: only words are counted
        state = state.mapInArrow(_scan(sc.broadcast(pickle.dumps(Automaton(window).finish()))), state.schema)
    hit = F.expr(
        "aggregate(gw_spans, named_struct('n', 0L, 's', -1L), (a, x) -> IF(a.s < 0, "
        "named_struct('n', a.n, 's', x), named_struct('n', a.n + x - a.s, 's', -1L)), a -> a.n)"
    )
    return state.withColumn("gw_hit", hit)


def contaminated(coverage_percent: int = COVERAGE_PERCENT):
    return (F.col("gw_hit") > 0) & (100 * F.col("gw_hit") >= coverage_percent * F.col("gw_words"))


def _cut(window: int):
    """Take the spans of ``window`` words or more out of the text."""

    def each(batches):
        for batch in pieces(batches, "gw_text"):
            words = split(batch.column("gw_text"), ALNUM)
            raw, offsets = buffers(batch.column("gw_text"))
            texts = batch.column("gw_text").to_pylist()
            for d, spans in enumerate(batch.column("gw_spans").to_pylist()):
                cut = [(a, b) for a, b in zip(spans[::2], spans[1::2], strict=True) if b - a >= window]
                if cut:
                    left, at = [], int(offsets[d])
                    for a, b in cut:
                        left.append(raw[at : words.start[words.first[d] + a]].tobytes())
                        at = int(words.end[words.first[d] + b - 1])
                    left.append(raw[at : offsets[d + 1]].tobytes())
                    texts[d] = b"".join(left).decode()
            names = batch.schema.names
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string()) if n == "gw_text" else batch.column(n) for n in names], names
            )

    return each


def decontaminate(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, coverage_percent: int = COVERAGE_PERCENT, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """Rows of ``docs``, all columns, less those of which ``coverage_percent`` or more of the
    words are hit. Spans of ``window`` words or more are taken out of the others' text, and
    ``n_chars`` follows a text that changed."""
    rows = docs.select(F.struct("*").alias("gw_row"), F.col("text").cast("string").alias("gw_text"))
    found = matches(rows, items, Shared(docs.sparkSession, "decontaminate"), window, block_words)
    kept = found.where(~contaminated(coverage_percent))
    kept = kept.mapInArrow(_cut(window), kept.schema)
    changed = F.col("gw_hit") > 0
    return kept.select(
        *[
            F.when(changed, F.col("gw_text")).otherwise(F.col("gw_row.text")).alias(c) if c == "text"
            else F.when(changed, F.length("gw_text")).otherwise(F.col("gw_row.n_chars")).cast(docs.schema[c].dataType).alias(c) if c == "n_chars"
            else F.col(f"gw_row.`{c}`").alias(c)
            for c in docs.columns
        ]
    )


_TEXT = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+')"

ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce({_TEXT}, []) AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item, {_TEXT} AS w FROM benchmark),
v AS (SELECT item, unnest([array_to_string(w[p:p + n - 1], ' ') FOR p IN range(1, len(w) - n + 2)]) AS g, n
  FROM (SELECT item, w, least(13, len(w)) AS n FROM i WHERE len(w) > 0)),
x AS (SELECT k, n, p, array_to_string(w[p:p + n - 1], ' ') AS g
  FROM (SELECT k, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM v))),
h AS (SELECT k, p, x.n, item FROM x JOIN v ON x.g = v.g AND x.n = v.n),
c AS (SELECT k, count(DISTINCT q) AS n_hit FROM (SELECT k, unnest(range(p, p + n)) AS q FROM h) GROUP BY k),
t AS (SELECT k, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM h GROUP BY k)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN c ON c.k = d.k LEFT JOIN t ON t.k = d.k
"""


@query("op2_decontaminate", ORACLE)
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents against all benchmark items."""
    rows = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("gw_text"))
    found = matches(rows, table(spark, sf_dir, "benchmark"), Shared(spark, "op2"))
    return found.select(
        "doc_id",
        F.col("gw_words").alias("n_words"),
        F.col("gw_hit").alias("n_hit"),
        F.size("gw_items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("gw_items"), ","), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )
