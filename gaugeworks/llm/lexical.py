"""Ranked lexical search by bag deduplication: all documents ranked for each item.

A document's score depends on its term counts for the item's terms and on ``m``, which follows from
its length. So documents are boiled down to their bag over the items' vocabulary; bags and ``m`` that
are the same make a class, which is scored once:

1. *Bags.* Documents are streamed against the vocabulary. Words are looked up by a 64-bit hash and
   their bytes compared. Number and lengths of documents are counted on the way.
2. *Classes.* Rows meet by a digest of (bag, m) and are grouped by the bag itself, so two bags of
   one digest stay apart. A class keeps its ``top`` smallest doc_ids (no other can be among the
   ``top`` best of any item); each task cuts its own rows to these before the shuffle, so a group
   of very many copies is never one task's work.
3. *Scores.* Each task scores its classes against the items' postings and keeps, per item, the
   ``top`` classes by score and smallest doc_id.
4. *Expansion.* These classes are expanded to their members by ascending doc_id and ranked.

Items go in blocks of about ``BLOCK_WORDS`` words, hashed by id: that bounds the vocabulary that a
task holds. Items of one id are one item of all their distinct texts; null texts have no terms.
Repeated rows of documents are ranked each; a null doc_id comes after all others of its score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugeworks.llm.common import Shared, pieces, query, table
from gaugeworks.llm.tokens import ALNUM, Words, split

TOP = 20
#: Words of items in one block.
BLOCK_WORDS = 200_000
#: Score cells and posting entries of one numpy pass.
CELLS = 1 << 20

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
LAST = np.iinfo(np.int64).max  #: stands for a null doc_id in comparisons


class Block:
    """Vocabulary and postings of some items."""

    def __init__(self, rows):
        """``rows``: (item, term, times)."""
        self.items = sorted({r[0] for r in rows}, key=lambda x: (x is not None, x))
        number = {item: i for i, item in enumerate(self.items)}
        terms = sorted({r[1].encode() for r in rows})
        words = split(pa.array([t.decode() for t in terms], pa.string()), ALNUM)
        hashes = words.hashes()
        order = np.argsort(hashes)
        self.hashes, rank = hashes[order], np.argsort(order)
        if len(terms) != len(hashes) or (self.hashes[1:] == self.hashes[:-1]).any():
            raise ValueError("two terms of one hash in a block")
        place = dict(zip(terms, rank.tolist(), strict=True))
        sizes = np.array([len(t) for t in terms], np.int64)[order]
        self.end = np.cumsum(sizes)
        self.start = self.end - sizes
        self.data = np.frombuffer(b"".join(terms[i] for i in order), np.uint8)
        of = np.array([place[r[1].encode()] for r in rows], np.int64)
        by_term = np.argsort(of, kind="stable")
        self.item = np.array([number[r[0]] for r in rows], np.int64)[by_term]
        self.times = np.array([r[2] for r in rows], np.int64)[by_term]
        self.postings = np.searchsorted(of[by_term], np.arange(len(terms) + 1))

    def look_up(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words that are in the vocabulary, and their terms."""
        h = words.hashes()
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        size = words.end - words.start
        found = np.flatnonzero((self.hashes[at] == h) & (self.end[at] - self.start[at] == size))
        term, n = at[found], size[found]
        if len(found):
            inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            same = words.data[np.repeat(words.start[found], n) + inside] == self.data[np.repeat(self.start[term], n) + inside]
            right = np.logical_and.reduceat(same, np.cumsum(n) - n)
            found, term = found[right], term[right]
        return found, term


def _bags(block: Block):
    """Texts to their number of terms and their bag: pairs of term and count, by term."""

    def each(batches):
        for batch in pieces(batches):
            words = split(batch.column("text"), ALNUM)
            found, term = block.look_up(words)
            owner = np.searchsorted(words.first, found, "right") - 1
            cell, tf = np.unique(owner * len(block.hashes) + term, return_counts=True)
            owner, term = np.divmod(cell, len(block.hashes))
            at = np.searchsorted(owner, np.arange(batch.num_rows + 1)) * 8
            bags = pa.Array.from_buffers(
                pa.binary(), batch.num_rows,
                [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(np.column_stack([term, tf]).astype("<i4").tobytes())],
            )
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(words.counts().astype(np.int64)), bags], ["doc_id", "n", "bag"])

    return each


def _unpack(bags: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Term, count and owner of all entries of a column of bags."""
    sizes = pa.compute.binary_length(bags).to_numpy(zero_copy_only=False) // 8
    pairs = np.frombuffer(b"".join(bags.to_pylist()), "<i4").reshape(-1, 2).astype(np.int64)
    return pairs[:, 0], pairs[:, 1], np.repeat(np.arange(len(bags)), sizes)


def _holders(n_terms: int):
    """Bags to (term, number of them that hold it), once a task."""

    def each(batches):
        held = np.zeros(n_terms, np.int64)
        for batch in batches:
            held += np.bincount(_unpack(batch.column("bag"))[0], minlength=n_terms)
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(held[some])], ["term", "df"])

    return each


class _Best:
    """Per item the ``top`` classes by score and smallest doc_id."""

    def __init__(self, n_items: int, top: int):
        self.top, self.members = top, {}
        self.least = np.ones(n_items, np.int64)  #: score that is still of use
        self.rows = np.zeros((0, 4), np.int64)  #: item, score, smallest doc_id, class
        self.pending: list[np.ndarray] = []
        self.waiting = self.known = 0

    def add(self, item, score, first, members, batch) -> None:
        """``members``: number in ``batch``, the column of member lists, of each row."""
        useful = np.flatnonzero(score >= self.least[item])
        if not len(useful):
            return
        seen, at = np.unique(members[useful], return_inverse=True)
        self.members.update(zip(range(self.known, self.known + len(seen)), batch.take(pa.array(seen)).to_pylist(), strict=True))
        self.pending.append(np.column_stack([item[useful], score[useful], first[useful], at + self.known]))
        self.known += len(seen)
        self.waiting += len(useful)
        if self.waiting > 100_000:
            self.fold()

    def fold(self) -> None:
        rows = np.concatenate([self.rows, *self.pending])
        rows = rows[np.lexsort((rows[:, 2], -rows[:, 1], rows[:, 0]))]
        begin = np.searchsorted(rows[:, 0], rows[:, 0])
        place = np.arange(len(rows)) - begin
        self.least[rows[place == self.top - 1, 0]] = rows[place == self.top - 1, 1]
        self.rows, self.pending, self.waiting = rows[place < self.top], [], 0
        self.members = {k: self.members[k] for k in set(self.rows[:, 3].tolist())}


def _scores(block: Block, weight: np.ndarray, top: int):
    """Classes (bag, m, members) to (item, score, members): those that a task has among its best."""
    n_items = len(block.items)
    width = np.diff(block.postings)

    def each(batches):
        best = _Best(n_items, top)
        for batch in batches:
            term, tf, owner = _unpack(batch.column("bag"))
            m = batch.column("m").to_numpy()
            members = batch.column("members")
            first = batch.column("first").fill_null(LAST).to_numpy()
            gain = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[owner]))
            upto = np.concatenate([[0], np.cumsum(np.bincount(owner, weights=width[term], minlength=batch.num_rows))])
            bounds = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            rows = max(1, CELLS // n_items)
            a = 0
            while a < batch.num_rows:
                b = max(a + 1, min(a + rows, int(np.searchsorted(upto, upto[a] + CELLS, "right")) - 1))
                own = slice(bounds[a], bounds[b])
                t, n = term[own], width[term[own]]
                entry = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(block.postings[t], n)
                value = np.repeat(gain[own], n) * block.times[entry]
                cell = np.repeat(owner[own] - a, n) * n_items + block.item[entry]
                # Two halves, so that sums in doubles are exact.
                high = np.bincount(cell, weights=value >> 26, minlength=(b - a) * n_items)
                low = np.bincount(cell, weights=value & (1 << 26) - 1, minlength=(b - a) * n_items)
                score = (high.astype(np.int64) << 26) + low.astype(np.int64)
                hit = np.flatnonzero(score)
                which, item = np.divmod(hit, n_items)
                best.add(item, score[hit], first[a + which], a + which, members)
                a = b
        best.fold()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([None if block.items[i] is None else str(block.items[i]) for i in best.rows[:, 0]], pa.string()),
                pa.array(best.rows[:, 1].copy()), pa.array([best.members[k] for k in best.rows[:, 3].tolist()], pa.list_(pa.int64())),
            ],
            ["item", "score", "members"],
        )

    return each


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)


def ranked_search(docs: DataFrame, items: DataFrame, shared: Shared, top: int = TOP, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, text) and (item_id, text) to (item_id, rank, doc_id, score): for each item its ``top``
    documents with a score above 0, equal scores by ascending doc_id. Empty tables give no rows."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    kind = items.schema["item_id"].dataType
    terms = shared.keep(
        items.select("item_id", F.col("text").cast("string").alias("text")).distinct()
        .select("item_id", F.explode(F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(TERM), 0)).alias("term"))
        .groupBy("item_id", "term").agg(F.count("*").alias("times")),
        "terms",
    )
    n_blocks = terms.count() // block_words + 1
    numbered = terms.withColumn("block", F.pmod(F.xxhash64(F.col("item_id").cast("string")), F.lit(n_blocks)))
    totals, found = None, None
    for number in range(n_blocks):
        rows = numbered.where(F.col("block") == number).select("item_id", "term", "times").collect()  # a block
        if not rows:
            continue
        block = Block(rows)
        bags = shared.keep(docs.mapInArrow(_bags(block), "doc_id long, n long, bag binary"), f"bags-{number}")
        if totals is None:
            totals = bags.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        n_docs, length = totals
        bags = bags.where(F.octet_length("bag") > 0)
        df = np.zeros(len(block.hashes), np.int64)
        for term, holders in bags.select("bag").mapInArrow(_holders(len(df)), "term long, df long").groupBy("term").agg(F.sum("df")).collect():
            df[term] = holders
        m = F.lit(75).cast("long") + F.expr(f"(25 * n * {n_docs}L) div {max(length, 1)}L")
        classed = bags.select("doc_id", "bag", m.alias("m")).withColumn("digest", F.xxhash64("bag", "m"))
        own = Window.partitionBy("digest", "m", "bag").orderBy(F.col("doc_id").asc_nulls_last())
        classes = (
            classed.withColumn("place", F.row_number().over(own)).where(F.col("place") <= top)
            .groupBy("digest", "m", "bag")
            .agg(F.min("doc_id").alias("first"), F.collect_list(F.struct("doc_id")).alias("members"))
            .select("bag", "m", "first", F.col("members.doc_id").alias("members"))
        )
        best = classes.mapInArrow(_scores(block, weights(df, n_docs), top), "item string, score long, members array<long>")
        found = best if found is None else found.union(best)
    if found is None:
        return docs.sparkSession.createDataFrame([], "rank int, doc_id long, score long").select(F.lit(None).cast(kind).alias("item_id"), "*")
    one = found.select(F.col("item").cast(kind).alias("item_id"), F.explode("members").alias("doc_id"), "score")
    place = F.row_number().over(Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last()))
    return one.withColumn("rank", place).where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
s AS (SELECT count(*) FILTER (WHERE len(w) > 0) AS docs, CAST(sum(len(w)) AS BIGINT) AS all_terms FROM d),
q AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT DISTINCT item_id, text FROM benchmark))
  GROUP BY item_id, term),
t AS (
  SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(w) AS n, unnest(w) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY r, doc_id, n, term),
v AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM t CROSS JOIN s GROUP BY term, docs),
p AS (
  SELECT q.item_id, t.r, t.doc_id, CAST(sum(q.times * v.w * ((1000000000 * t.tf) // (1000 * t.tf + 12 * (100 - 25 + ((25 * t.n * s.docs) // s.all_terms))))) AS BIGINT) AS score
  FROM q JOIN t ON t.term = q.term JOIN v ON v.term = q.term CROSS JOIN s GROUP BY q.item_id, t.r, t.doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM p WHERE score > 0)
WHERE rank <= 20
"""


@query("op13_lexical_search", ORACLE)
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents ranked for every benchmark item, 20 each."""
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), Shared(spark, "op13"))
