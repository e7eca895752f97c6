"""Packing of tokenised documents into sequences, by swap-based local search.

A document is its token ids and a closing 0; longer ones than a sequence are cut into pieces, of
which all but the last fill a sequence of their own. The other pieces are packed in groups of a
bounded number, dealt by a hash of the row:

1. Best fit gives a first packing: the longest piece first, each into the fullest sequence with
   room.
2. The local search takes the emptiest sequence and gives its pieces to fuller ones that are not
   full: as a move, as an exchange of one piece for a shorter one, or of two pieces for one or one
   for two. Every step makes the sum of squared fills grow; a sequence that loses its last piece is
   gone. The search ends when there are no more sequences than there must be, or when a sweep over
   all sequences has emptied none.
3. Sequences with room for the group's shortest piece are taken apart and dealt again, together
   with those of other groups, until one group holds all that is left or there is hardly less of
   it than before.

Only piece lengths and keys are shuffled, never tokens or texts. Null and empty texts are the
closing 0 alone. Repeated rows are packed each. An empty table has no rows.
"""

from __future__ import annotations

import gc
import os
import re
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.llm.common import Shared, pieces, query, table

CAPACITY = 2048
#: Pieces that are packed together.
GROUP = 16_384
#: A round has to leave less than this share of its pieces to be followed by another one.
LEFT = 0.9
#: Words whose ids a worker remembers, about.
REMEMBERED = 1_000_000
#: Letters of ASCII and Latin-1, with ASCII signs behind an ASCII letter; an apostrophe is none of
#: them, since it may belong to the letters that follow.
LETTERS = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)(?:(?<=[A-Za-z])([!-&(-/:-@\[-`{-~]+))?").fullmatch
SIGNS = re.compile(rb"[!-&(-/:-@\[-`{-~]+").fullmatch

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


# ---- tokens


class _Places(dict):
    """Words to their numbers; an unknown one gets the next number and is noted."""

    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self.new.append(word)
        self[word] = n = len(self)
        return n


def _wide() -> dict[int, str]:
    """Bytes that a byte-level vocabulary does not write as the character of their number: these take
    the characters from 256 on, in order."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    return {b: chr(256 + k) for k, b in enumerate(x for x in range(256) if x not in shown)}


class Encoder:
    """Token ids of many texts. No rule of the tokenizer reaches over ASCII blanks, so the ids of
    words between them are remembered; words are forgotten when there are too many.

    Most words are letters, or letters and signs behind them. Where the tokenizer lowers case, cuts
    before such signs and is byte-level (tried out on ``SAMPLES``), these are put together from the
    ids of their parts, and a part goes straight to the model. Others, and all words of other
    tokenizers, go through the whole tokenizer.
    """

    SAMPLES = ("the", "Strength", "x" * 40, "zqxjkvb", "ÉCOLE,", "straße", "ÿñandú?!", "ÄÖÜ...", "a#&(", "Won))", "été-", "ab;", "àâ/")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.wide, self.direct = _wide(), True
        self._forget()
        samples = [w.encode() for w in self.SAMPLES]
        ids, _ = self(samples)
        self.direct = ids.tolist() == [i for own in self._encoded(samples) for i in (*own, 0)]
        self._forget()

    def _encoded(self, words: list[bytes]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)]

    def _forget(self) -> None:
        self.place = _Places()
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0
        self.start = np.zeros(1, np.int64)  #: where each remembered word's ids begin, and the end

    def _learn(self) -> None:
        place, base = self.place, len(self.start) - 1
        if not place.new:
            return
        tokenize, wide = self.tokenizer.model.tokenize, self.wide
        found: list[list[int]] = []
        made, whole = [], []
        for word in place.new:  # grows by parts of its words
            own = None
            if self.direct:
                m = LETTERS(word.decode())
                if m and m[2]:
                    made.append((len(found), place[m[1].lower().encode()], place[m[2].encode()]))
                elif m and (low := m[1].lower()) != m[1]:
                    made.append((len(found), place[low.encode()], None))
                elif m or SIGNS(word):
                    own = [t.id for t in tokenize(word.decode("latin-1").translate(wide))]
                else:
                    whole.append(len(found))
            else:
                whole.append(len(found))
            found.append(own)
        for i, own in zip(whole, self._encoded([place.new[i] for i in whole]), strict=True):
            found[i] = own

        def known(k: int | None) -> list[int]:
            if k is None:
                return []
            return found[k - base] if k >= base else self.ids[self.start[k] : self.start[k + 1]].tolist()

        for i, a, b in made:
            found[i] = known(a) + known(b)
        place.new = []
        size = np.fromiter(map(len, found), np.int64, len(found))
        n = int(size.sum())
        if self.used + n > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(n, len(self.ids)), np.uint32)])
        self.ids[self.used : self.used + n] = np.fromiter(chain.from_iterable(found), np.uint32, n)
        self.start = np.concatenate([self.start, self.used + np.cumsum(size)])
        self.used += n

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other with a 0 after each, and their numbers."""
        words = [t.split() for t in texts]
        count = np.fromiter(map(len, words), np.int64, len(words))
        if len(self.place) > REMEMBERED:
            self._forget()
        at = np.fromiter(map(self.place.__getitem__, chain.from_iterable(words)), np.int64, int(count.sum()))
        self._learn()
        begin = self.start[at]
        n = self.start[at + 1] - begin
        upto = np.concatenate([[0], np.cumsum(n)])
        total = np.diff(upto[np.cumsum(count)], prepend=0) + 1
        # Each word's ids go behind those of the words before it and the closing zeros between.
        shift = upto[:-1] + np.repeat(np.arange(len(texts)), count)
        steps = np.arange(int(upto[-1])) - np.repeat(upto[:-1], n)
        out = np.zeros(int(total.sum()), np.uint32)
        out[steps + np.repeat(shift, n)] = self.ids[steps + np.repeat(begin, n)]
        return out, total


_encoders: dict[str, Encoder] = {}


def _cut(path: str, capacity: int):
    """Texts to their pieces."""

    def each(batches):
        encoder = _encoders.get(path) or _encoders.setdefault(path, Encoder(path))
        for batch in pieces(batches):
            gc.disable()  # many small lists and no cycles: looking for some takes a sixth of the time
            try:
                ids, total = encoder([(t or "").encode() for t in batch.column("text").to_pylist()])
            finally:
                gc.enable()
            count = (total + capacity - 1) // capacity
            owner = np.repeat(np.arange(len(total)), count)
            piece = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
            start = piece * capacity
            length = np.minimum(total[owner] - start, capacity)
            begin = (np.cumsum(total) - total)[owner] + start
            wire = ids.astype("<u4", copy=False)
            crc = [zlib.crc32(wire[a : a + n]) for a, n in zip(begin.tolist(), length.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(owner)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length),
                    pa.array(crc, pa.int64()),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return each


# ---- packing of one group


def best_fit(size: np.ndarray, capacity: int) -> np.ndarray:
    """Sequence of each piece: the longest first, each into the fullest sequence with room."""
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_, n = 0, 0  # bit g is set where a sequence has room for exactly g
    out = np.zeros(len(size), np.int64)
    order = np.argsort(-size, kind="stable")
    for i, s in zip(order.tolist(), size[order].tolist(), strict=True):
        fit = open_ >> s
        if fit:
            gap = s + (fit & -fit).bit_length() - 1
            own = room[gap].pop()
            if not room[gap]:
                open_ ^= 1 << gap
        else:
            gap, own, n = capacity, n, n + 1
        out[i] = own
        if gap > s:
            room[gap - s].append(own)
            open_ |= 1 << (gap - s)
    return out


def least_sequences(size: np.ndarray, capacity: int) -> int:
    """No packing has fewer sequences: for every k, pieces above capacity - k stand alone, those above
    half of it never share, and those of k or more only fit beside the latter."""
    if not len(size):
        return 0
    s = np.sort(size)[::-1]
    upto = np.concatenate([[0], np.cumsum(s)])
    k = np.unique(s[2 * s <= capacity])
    k = np.append(k, 0)
    half = np.searchsorted(-s, -capacity / 2, "left")  # above one half
    alone = np.minimum(np.searchsorted(-s, -(capacity - k), "left"), half)  # above capacity - k
    small = np.searchsorted(-s, -k, "right")  # of k or more
    room = (half - alone) * capacity - (upto[half] - upto[alone])
    rest = np.maximum(upto[small] - upto[half] - room, 0)
    return int((half + -(-rest // capacity)).max())


class LocalSearch:
    """Improves a packing by moves and exchanges between sequences that are not full."""

    def __init__(self, size: np.ndarray, held: np.ndarray, capacity: int):
        self.size, self.capacity, self.held = size, capacity, held.copy()
        self.fill = np.bincount(held, weights=size).astype(np.int64)
        self.used = len(self.fill)
        self.least = least_sequences(size, capacity)

    def run(self) -> np.ndarray:
        while self.used > self.least:
            before = self.used
            under = np.flatnonzero((self.fill > 0) & (self.fill < self.capacity))
            self.items = np.flatnonzero(np.isin(self.held, under))
            self.i, self.j = pairs(self.items, self.held[self.items], self.size)
            for donor in under[np.argsort(self.fill[under], kind="stable")].tolist():
                while self.used > self.least and 0 < self.fill[donor] < self.capacity and self.step(donor):
                    pass
            if self.used == before:
                break
        return self.held

    def give(self, gone: list[int], back: list[int], donor: int) -> None:
        """Exchange pieces ``gone`` of the donor for ``back`` of the sequence that has room."""
        self.held[gone], self.held[back] = self.to, donor
        d = int(self.size[gone].sum() - self.size[back].sum())
        self.fill[self.to] += d
        self.fill[donor] -= d
        self.used -= self.fill[donor] == 0

    def best(self, given: np.ndarray, taken: np.ndarray, of: np.ndarray, donor: int) -> tuple[int, int] | None:
        """Of what the donor may give (sums) and get back (sums, from sequences ``of``): the exchange
        that leaves least room. The sum of squared fills has to grow."""
        room = self.capacity - self.fill[of]
        useful = np.flatnonzero((of != donor) & (room > 0))
        if not len(useful) or not len(given):
            return None
        taken, room, of = taken[useful], room[useful], of[useful]
        behind = self.fill[donor] - self.fill[of]
        found = None
        for k, s in enumerate(given.tolist()):
            d = s - taken
            left = np.where((d > 0) & (d <= room) & (d > behind), room - d, self.capacity)
            i = int(np.argmin(left))
            if left[i] < self.capacity and (found is None or left[i] < found[0]):
                found = (int(left[i]), k, int(useful[i]), int(of[i]))
                if not left[i]:
                    break
        if found is None:
            return None
        self.to = found[3]
        return found[1:3]

    def step(self, donor: int) -> bool:
        """One step that takes tokens from ``donor`` and makes the sum of squared fills grow."""
        here = self.held[self.items]
        own = self.items[here == donor]
        # Equal lengths are alike, so one of each stands for all; the longest first.
        own = own[np.unique(self.size[own], return_index=True)[1]][::-1]
        others = np.unique(here)
        found = self.best(self.size[own], np.zeros(len(others), np.int64), others, donor)  # a move
        if found:
            self.give([own[found[0]]], [], donor)
            return True
        found = self.best(self.size[own], self.size[self.items], here, donor)  # one for one
        if found:
            self.give([own[found[0]]], [self.items[found[1]]], donor)
            return True
        together = self.held[self.i] == self.held[self.j]
        i, j = self.i[together], self.j[together]
        both, of = self.size[i] + self.size[j], self.held[i]
        mine = of == donor
        found = self.best(both[mine], self.size[self.items], here, donor)  # two for one
        if found:
            self.give([i[mine][found[0]], j[mine][found[0]]], [self.items[found[1]]], donor)
            return True
        found = self.best(self.size[own], both, of, donor)  # one for two
        if found:
            self.give([own[found[0]]], [i[found[1]], j[found[1]]], donor)
            return True
        return False


def pairs(items: np.ndarray, of: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of pieces of one sequence; of equal lengths two pieces at most stand for all, so a
    sequence of many short pieces has some thousands."""
    order = np.lexsort((size[items], of))
    items, of = items[order], of[order]
    key = of * (int(size.max(initial=0)) + 1) + size[items]
    few = np.arange(len(key)) - np.searchsorted(key, key) < 2
    items, of = items[few], of[few]
    _, begin, count = np.unique(of, return_index=True, return_counts=True)
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for k in np.unique(count[count > 1]).tolist():
        rows = items[begin[count == k][:, None] + np.arange(k)]
        a, b = np.triu_indices(k, 1)
        left.append(rows[:, a].ravel())
        right.append(rows[:, b].ravel())
    return np.concatenate(left), np.concatenate(right)


def pack(size: np.ndarray, capacity: int) -> np.ndarray:
    """Sequence of each piece of a group, by best fit and local search."""
    return LocalSearch(size, best_fit(size, capacity), capacity).run() if len(size) else size


# ---- packing of a table


def _pack_group(capacity: int, number: int):
    """Pieces of a group with their place, and whether their sequence is closed."""

    def each(group: pa.Table) -> pa.Table:
        size = group.column("length").to_numpy()
        held = pack(size, capacity)
        order = np.lexsort((-size, held))
        held, size = held[order], size[order]
        _, first, own = np.unique(held, return_index=True, return_inverse=True)
        upto = np.cumsum(size) - size
        offset = upto - upto[first][own]
        # Closed where no piece of the group fits in any more.
        closed = capacity - np.bincount(own, weights=size)[own] < size.min()
        sequence = np.int64(number) << 56 | group.column("part")[0].as_py() << 24 | own
        out = group.select(["row", "doc_id", "piece", "start", "length", "ids_crc32"]).take(pa.array(order))
        for name, values in (("sequence_id", pa.array(sequence.astype(np.int64))), ("offset", pa.array(offset)), ("closed", pa.array(closed))):
            out = out.append_column(name, values)
        return out

    return each


def packed(
    docs: DataFrame, shared: Shared, tokenizer: str, capacity: int = CAPACITY, group: int = GROUP
) -> DataFrame:
    """(doc_id, text) to (doc_id, piece, start, length, ids_crc32, sequence_id, offset). ``tokenizer`` is
    the path of a tokenizer's file on every executor."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    cut = shared.keep(docs.mapInArrow(_cut(tokenizer, capacity), PIECES).withColumn("row", F.monotonically_increasing_id()), "pieces")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    alone = cut.where(F.col("length") == capacity)
    out = alone.withColumn("sequence_id", -1 - F.col("row")).withColumn("offset", F.lit(0).cast("long")).select(*columns)
    left, number = cut.where(F.col("length") < capacity), 0
    n = left.count()
    while n:
        parts = -(-n // group)
        part = F.pmod(F.xxhash64("row", F.lit(number)), F.lit(parts)).alias("part")
        rows = left.select("row", *columns[:5], part)
        done = shared.keep(
            rows.groupBy("part").applyInArrow(_pack_group(capacity, number), f"row long, {PIECES}, sequence_id long, offset long, closed boolean"),
            f"round-{number}",
        )
        open_ = done.where(~F.col("closed"))
        remaining = open_.count()
        number += 1
        if parts == 1 or remaining > LEFT * n:
            return out.union(done.select(*columns))
        out, left, n = out.union(done.where("closed").select(*columns)), open_, remaining
    return out


@query("op11_best_fit")
def op11_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents. Tests hold it against plain tokenisation and the rules of a packing."""
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    return packed(table(spark, sf_dir, "documents"), Shared(spark, "op11"), str(path))
