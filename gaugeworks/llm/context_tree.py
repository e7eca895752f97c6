"""Language-model scores by context-tree weighting.

A text is its words in lower case (A-Z), each followed by a blank, and then an end mark: bytes
that stand for the token sequence exactly. Each byte is eight binary decisions. For every context
of 0 to ``DEPTH`` bytes and every decision node a Krichevsky-Trofimov estimator keeps the counts of
both bits; the tree weighs, at each context, its own estimate against those of the contexts one
byte longer by their block probabilities on the training texts. A byte's probability is the
product of its eight mixed decisions, its code length the logarithm.

How the corpus flows:

1. Each *chunk* (rows dealt by hash, about ``CHUNK_BYTES`` of text) is boiled down to its distinct
   tokens and its distinct (DEPTH + 1)-grams with their training counts; grams of texts that are
   not trained on count 0.
2. These rows are brought together by key, once: the key's count and the chunks that hold it.
3. The tree is built in shards of contexts that end in the same three bytes, any number of them,
   up to depth 3. No more than 2 ** 24 grams end so, however large the corpus. Depths 2, 1 and 0
   have at most 65,536 + 256 + 1 contexts of 255 nodes (of which text has some hundred thousand);
   Spark sums up what they need, and the driver weighs them. A second pass over the shards gives
   every gram its log-probability.
4. Keys go back to the chunks that asked for them, with count or log-probability, and each chunk
   scores its texts. No model is broadcast whole and nothing is cut off.

Texts that are null or empty have one token, the end. Repeated rows and ids get a row each and
count each time. Without training texts every estimate is that of no counts (one half a bit).
Tokens are compared by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.llm.common import Shared, fold, pieces, query, table
from gaugeworks.llm.tokens import NOT_BLANK, Words, mix, split

DEPTH = 5
END = 255  #: not a byte of UTF-8
END_KEY = int(mix(np.array([END], np.uint64))[0].astype(np.int64))
PIECE = 1 << 18
#: Keys that a chunk gathers before they are folded into its distinct ones.
FOLD = 1 << 19
#: Grams of one shard of the tree, about.
SHARD_GRAMS = 100_000
#: Bytes of text in a chunk, about.
CHUNK_BYTES = 12 << 20

_U = np.uint64
TOKEN, GRAM = 0, 1


def token_keys(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all tokens, ends included, and the text of each."""
    n = len(words.first) - 1
    keys = np.concatenate([words.hashes().view(np.int64), np.full(n, END_KEY)])
    owner = np.concatenate([np.repeat(np.arange(n), words.counts()), np.arange(n)])
    return keys, owner


def gram_codes(words: Words, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """Code of each byte with its context, oldest byte first, and the text of each."""
    n = len(words.first) - 1
    length = words.end - words.start
    counts = words.counts()
    owner = np.repeat(np.arange(n), counts)
    size = np.bincount(owner, weights=length + 1, minlength=n).astype(np.int64) + 1  # with the end
    begin = np.cumsum(size + depth) - (size + depth)
    before = np.cumsum(length + 1) - (length + 1)
    base = np.repeat((begin + depth) - np.append(before, [0])[np.minimum(words.first[:-1], len(before))], counts)
    stream = np.full(int((size + depth).sum()), 32, np.uint8)
    source = np.flatnonzero(NOT_BLANK[words.data])
    stream[source + np.repeat(base + before - words.start, length)] = words.data[source]
    pads = (begin[:, None] + np.arange(depth)).ravel()
    stream[pads] = 0
    stream[begin + depth + size - 1] = END
    wide = stream.astype(np.int64)
    codes = np.zeros(len(wide) - depth, np.int64)
    for k in range(depth + 1):
        codes = codes << 8 | wide[k : len(wide) - depth + k]
    real = np.ones(len(stream), bool)
    real[pads] = False
    return codes[real[depth:]], np.repeat(np.arange(n), size)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    begin = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[begin], np.add.reduceat(counts, begin) if len(begin) else counts


class _Gathered:
    """Distinct keys of a chunk with their counts, folded now and then."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.pending = 0

    def add(self, keys: np.ndarray, trained: bool) -> None:
        found, counts = np.unique(keys, return_counts=True)
        self.parts.append((found, counts if trained else np.zeros(len(found), np.int64)))
        self.pending += len(found)
        if self.pending >= FOLD:
            self.parts, self.pending = [self.all()], 0

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        return _summed(np.concatenate([k for k, _ in self.parts]), np.concatenate([c for _, c in self.parts]))


def _local(depth: int):
    def each(rows: pa.Table) -> pa.Table:
        held = {TOKEN: _Gathered(), GRAM: _Gathered()}
        for trained in (True, False):
            own = rows.filter(pa.compute.equal(rows.column("trained"), trained)).combine_chunks()
            for piece in pieces(iter(own.to_batches()), limit=PIECE):
                words = split(piece.column("text"))
                held[TOKEN].add(token_keys(words)[0], trained)
                held[GRAM].add(gram_codes(words, depth)[0], trained)
        out = []
        for kind, gathered in held.items():
            keys, counts = gathered.all()
            same = [np.full(len(keys), kind, np.int32), keys, counts, np.full(len(keys), rows.column("chunk")[0].as_py(), np.int64)]
            out.append(pa.table([pa.array(c) for c in same], ["kind", "key", "n", "chunk"]))
        return pa.concat_tables(out)

    return each


def _gather(batches):
    """Rows sorted by (kind, key) to one row a key: its count, and the chunks that hold it."""
    held = None
    for batch in batches:
        table_ = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
        if not table_.num_rows:
            continue
        kind, key = table_.column("kind").to_numpy(), table_.column("key").to_numpy()
        begin = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (kind[1:] != kind[:-1])))
        held = table_.slice(int(begin[-1])).to_batches()[0]
        if len(begin) > 1:
            yield _keys(table_, begin[:-1], int(begin[-1]))
    if held is not None:
        yield _keys(pa.Table.from_batches([held]), np.zeros(1, np.int64), held.num_rows)


def _keys(rows: pa.Table, begin: np.ndarray, end: int) -> pa.RecordBatch:
    counts = np.add.reduceat(rows.column("n").to_numpy()[:end], begin)
    chunks = rows.column("chunk").slice(0, end).combine_chunks()
    chunks = chunks if isinstance(chunks, pa.Array) else pa.concat_arrays(chunks.chunks)
    at = pa.array(np.append(begin, end).astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(rows.column("kind").to_numpy()[begin]), pa.array(rows.column("key").to_numpy()[begin]),
            pa.array(counts), pa.ListArray.from_arrays(at, chunks),
        ],
        ["kind", "key", "n", "chunks"],
    )


def log_gamma(x: np.ndarray) -> np.ndarray:
    """For x of 0.5 or more: Stirling's series after eight steps up."""
    low = np.ones_like(x)
    for k in range(8):
        low = low * (x + k)
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - np.log(low)


def kt_block(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of n0 zeros and n1 ones."""
    shift = np.minimum(n0 + n1, 1)  # exactly 0 for no counts
    return shift * (log_gamma(n0 + 0.5) + log_gamma(n1 + 0.5) - log_gamma(n0 + n1 + 1.0) - np.log(np.pi))


def weigh(n0: np.ndarray, n1: np.ndarray, deeper: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(log weighted probability, weight of the own estimate, own estimate of a 1) of contexts
    whose longer contexts have log probability ``deeper`` in sum."""
    own = kt_block(n0, n1)
    both = np.logaddexp(own, deeper)
    return both - np.log(2), np.exp(own - both), (n1 + 0.5) / (n0 + n1 + 1)


def _backward(contexts: np.ndarray, depth: int) -> np.ndarray:
    """Contexts with the newest byte first, so that shorter contexts are prefixes."""
    out = np.zeros_like(contexts)
    for _ in range(depth):
        out = out << 8 | contexts & 255
        contexts = contexts >> 8
    return out


def subtree(codes: np.ndarray, counts: np.ndarray, depth: int, upper=None):
    """The tree above depth 3 for all grams of some three-byte contexts.

    Without ``upper``: arrays (last three bytes with the newest first, node, n0, n1, log weighted
    probability) of depth 3. With it (the tables of depths 2 to 0): each gram's log10
    probability. Grams without counts weigh nothing.
    """
    backward = _backward(codes >> 8, depth)
    symbol = codes & 255
    found, score = [], np.zeros(len(codes))
    for k in range(8):
        node, bit = (1 << k) | (symbol >> (8 - k)), (symbol >> (7 - k)) & 1
        key = node << (8 * depth) | backward
        order = np.argsort(key, kind="stable")
        key = key[order]
        ones = np.where(bit[order] == 1, counts[order], 0).astype(np.float64)
        zeros = counts[order] - ones
        group = np.arange(len(key))
        way, deeper = [], None
        for d in range(depth, 2, -1):
            begin = np.flatnonzero(np.append(True, (key[1:] != key[:-1]))) if d == depth else np.flatnonzero(np.append(True, key[1:] >> 8 != key[:-1] >> 8))
            if d < depth:
                key = key >> 8
            to = np.cumsum(np.bincount(begin, minlength=len(key))) - 1
            key = key[begin]
            zeros, ones = np.add.reduceat(zeros, begin), np.add.reduceat(ones, begin)
            if d == depth:
                deeper, own, estimate = kt_block(zeros, ones), np.ones(len(key)), (ones + 0.5) / (zeros + ones + 1)
            else:
                deeper, own, estimate = weigh(zeros, ones, np.add.reduceat(deeper, begin))
            group = to[group]
            way.append((group, own, estimate))
        if upper is None:
            found.append((key & 0xFFFFFF, key >> 24, zeros, ones, deeper))
            continue
        places, own2, estimate2, own1, estimate1, own0, estimate0 = upper
        p = None
        for group, own, estimate in way:
            p = estimate[group] if p is None else own[group] * estimate[group] + (1 - own[group]) * p
        newest, of = (backward[order] >> (8 * (depth - 2))).astype(np.int64), node[order]
        at = np.searchsorted(places, newest << 8 | of)
        p = own2[at] * estimate2[at] + (1 - own2[at]) * p
        newest = newest >> 8
        p = own1[newest, of] * estimate1[newest, of] + (1 - own1[newest, of]) * p
        p = own0[of] * estimate0[of] + (1 - own0[of]) * p
        score[order] += np.log10(np.where(bit[order] == 1, p, 1 - p))
    return score if upper is not None else tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _rooted(depth: int):
    def each(group: pa.Table) -> pa.Table:
        context, node, n0, n1, weighted = subtree(group.column("key").to_numpy(), group.column("n").to_numpy(), depth)
        # This shard's share of each context of two bytes.
        seen, at = np.unique((context >> 8) << 8 | node, return_inverse=True)
        sums = [np.bincount(at, weights=x) for x in (n0, n1, weighted)]
        return pa.table({"place": pa.array(seen.astype(np.int64)), **{k: pa.array(v) for k, v in zip(("n0", "n1", "weighted"), sums, strict=True)}})

    return each


def upper_tables(rows: pa.Table) -> tuple[np.ndarray, ...]:
    """Tables of depths 2, 1 and 0 from (two newest bytes << 8 | node, n0, n1, sum of log weights); that
    of depth 2 has just the places there are, in order."""
    places = rows.column("place").to_numpy()
    order = np.argsort(places)
    places = places[order]
    n0, n1, deeper = (rows.column(c).to_numpy()[order] for c in ("n0", "n1", "weighted"))
    weighted, own2, estimate2 = weigh(n0, n1, deeper)
    at = (places >> 16) << 8 | places & 255
    n0, n1, deeper = (np.bincount(at, weights=x, minlength=1 << 16).reshape(256, 256) for x in (n0, n1, weighted))
    weighted, own1, estimate1 = weigh(n0, n1, deeper)
    _, own0, estimate0 = weigh(n0.sum(axis=0), n1.sum(axis=0), weighted.sum(axis=0))
    return places, own2, estimate2, own1, estimate1, own0, estimate0


def _scored_grams(depth: int, upper):
    def each(group: pa.Table) -> pa.Table:
        score = subtree(group.column("key").to_numpy(), group.column("n").to_numpy(), depth, upper)
        return pa.table({"key": group.column("key"), "value": pa.array(score), "chunks": group.column("chunks")})

    return each


def _look_up(known: np.ndarray, values: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = np.searchsorted(known, keys)
    at[at == len(known)] = 0
    if not len(known) or (known[at] != keys).any():
        raise RuntimeError("a chunk changed between two reads of the documents")
    return values[at]


def _score(depth: int, total: int, distinct: int):
    """Texts and keys of one chunk to the texts' scores."""

    def each(texts: pa.Table, keys: pa.Table) -> pa.Table:
        kind, key, value = (keys.column(c).to_numpy() for c in ("kind", "key", "value"))
        tables = []
        for wanted in (TOKEN, GRAM):
            own = np.flatnonzero(kind == wanted)
            own = own[np.argsort(key[own])]
            tables.append((key[own], value[own]))
        out = []
        for piece in pieces(iter(texts.combine_chunks().to_batches()), limit=PIECE):
            words, n = split(piece.column("text")), piece.num_rows
            tokens, owner = token_keys(words)
            counts = _look_up(*tables[TOKEN], tokens)
            base = np.log10((counts + 0.1) / (total + 0.1 * (distinct + 1)))
            codes, of = gram_codes(words, depth)
            score = np.bincount(of, weights=_look_up(*tables[GRAM], codes), minlength=n)
            size = np.bincount(of, minlength=n)
            out.append(
                pa.table(
                    {
                        "doc_id": piece.column("doc_id"), "held_out": pa.compute.invert(piece.column("trained")),
                        "n_tokens": pa.array(np.bincount(owner, minlength=n)),
                        "n_known": pa.array(np.bincount(owner, weights=counts > 0, minlength=n).astype(np.int64)),
                        "train_tokens": pa.array(np.full(n, total, np.int64)),
                        "base_score": pa.array(np.bincount(owner, weights=base, minlength=n)),
                        "score": pa.array(score),
                        "bits_per_byte": pa.array(-score / np.log10(2) / size),
                    }
                )
            )
        return pa.concat_tables(out) if out else pa.Table.from_batches([], SCORES)

    return each


SCORES = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()),
     ("base_score", pa.float64()), ("score", pa.float64()), ("bits_per_byte", pa.float64())]
)
SCORES_SQL = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"


def hashed_chunks(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES, by: list[str] | None = None) -> Column:
    """A chunk for each row by a hash of columns ``by``, so many that each has about ``chunk_bytes``.
    By default the row's own id and text, which deals rows that are quite the same to one chunk."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return F.pmod(F.xxhash64(*(by or ["doc_id", "text"])), F.lit(size // chunk_bytes + 1))


def tree_scores(docs: DataFrame, shared: Shared, depth: int = DEPTH) -> DataFrame:
    """(doc_id, text, trained, chunk) to scores, a row for each row; learns from ``trained`` ones.

    ``chunk`` (long) names a bounded number of rows and must be the same on every read.
    """
    local = docs.select("text", "trained", "chunk").groupBy("chunk").applyInArrow(_local(depth), "kind int, key long, n long, chunk long")
    keys = shared.keep(
        local.repartition("kind", "key").sortWithinPartitions("kind", "key")
        .mapInArrow(_gather, "kind int, key long, n long, chunks array<long>"),
        "keys",
    )
    tokens = keys.where(F.col("kind") == TOKEN)
    total, distinct = tokens.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("n") > 0)).first()
    n_grams = keys.where(F.col("kind") == GRAM).count()
    # Contexts that end in the same three bytes stay together.
    ends = F.shiftright("key", 8).bitwiseAND(F.lit(0xFFFFFF))
    grams = keys.where(F.col("kind") == GRAM).withColumn("shard", F.pmod(F.xxhash64(ends), F.lit(n_grams // SHARD_GRAMS + 8)))
    roots = (
        grams.select("shard", "key", "n").groupBy("shard")
        .applyInArrow(_rooted(depth), "place long, n0 double, n1 double, weighted double")
        .groupBy("place").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("weighted").alias("weighted"))
    )
    upper = upper_tables(roots.toArrow())
    scored = grams.select("shard", "key", "n", "chunks").groupBy("shard").applyInArrow(
        _scored_grams(depth, upper), "key long, value double, chunks array<long>"
    )
    answers = tokens.select(F.lit(TOKEN).alias("kind"), "key", F.col("n").cast("double").alias("value"), "chunks").union(
        scored.select(F.lit(GRAM).alias("kind"), "key", "value", "chunks")
    )
    answers = answers.select(F.explode("chunks").alias("chunk"), "kind", "key", "value")
    texts = docs.select("chunk", "doc_id", "text", "trained")
    return texts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_score(depth, total, distinct), SCORES_SQL)


@query("op1_context_tree")
def op1_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents; chunks go by a row's file and its place in it, which no read changes. Tests
    hold it against plain code."""
    docs = table(spark, sf_dir, "documents")
    docs = docs.withColumn("chunk", hashed_chunks(docs, by=["_metadata.file_path", "_metadata.row_index"]))
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        (fold(10) != 0).alias("trained"), "chunk",
    )
    return tree_scores(docs, Shared(spark, "op1"))
