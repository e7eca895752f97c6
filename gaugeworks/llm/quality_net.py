"""Quality classifier: a byte-level convolutional network in numpy.

A text is cut into chunks of ``CHUNK`` window starts each; neighbouring chunks overlap by a window
less one byte, so every window of the whole text is in one chunk. Learned filters over ``WIDTH``
bytes run through each chunk and are max-pooled; the maxima of all chunks are combined twice, by
maximum and by mean, and a logistic unit makes one probability of both.

It is fitted on about ``PER_CLASS`` labelled rows of each class (the documented bound; the driver
holds their texts), both classes weighing the same. Every document is scored
over its whole text. Null and empty texts are one chunk of zero bytes and get that chunk's
probability. Without labelled rows every score is 0.5. Repeated rows and ids get a row each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.llm.common import fold, labelled_sample, pieces, query, table
from gaugeworks.llm.tokens import buffers

WIDTH = 8
FILTERS = 16
CHUNK = 248
PER_CLASS = 1500
EPOCHS = 10


def chunked(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chunk rows of all texts, zero-padded, and each chunk's text number."""
    lengths = np.diff(offsets)
    counts = np.maximum(1, -(-lengths // CHUNK))
    owner = np.repeat(np.arange(len(counts)), counts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = offsets[owner] + nth * CHUNK
    at = start[:, None] + np.arange(CHUNK + WIDTH - 1)
    inside = at < offsets[owner + 1][:, None]
    padded = np.append(raw, np.uint8(0))
    return np.where(inside, padded[np.minimum(at, len(raw))], np.uint8(0)), owner


class Network:
    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.taps = (rng.standard_normal((WIDTH, 256, FILTERS)) * 0.25).astype(np.float32)
        self.bias = np.zeros(FILTERS, np.float32)
        self.out = (rng.standard_normal(2 * FILTERS) * 0.1).astype(np.float32)
        self.level = np.zeros(1, np.float32)
        self.pairs: np.ndarray | None = None

    def freeze(self) -> Network:
        """Add up the tables of neighbouring taps, so that scoring looks up byte pairs."""
        even, odd = self.taps[0::2], self.taps[1::2]
        self.pairs = (even[:, :, None, :] + odd[:, None, :, :]).reshape(WIDTH // 2, 65536, FILTERS)
        return self

    def responses(self, chunks: np.ndarray) -> np.ndarray:
        """(chunks, windows, filters) before the bias."""
        if self.pairs is None:
            total = self.taps[0][chunks[:, :CHUNK]]
            for k in range(1, WIDTH):
                total += self.taps[k][chunks[:, k : k + CHUNK]]
            return total
        two = chunks[:, :-1].astype(np.int32) << 8 | chunks[:, 1:]
        total = self.pairs[0][two[:, :CHUNK]]
        for k in range(1, WIDTH // 2):
            total += self.pairs[k][two[:, 2 * k : 2 * k + CHUNK]]
        return total

    def pooled(self, chunks: np.ndarray, step: int = 64) -> np.ndarray:
        """Each chunk's maxima, (chunks, filters), a few chunks at a time."""
        out = np.empty((len(chunks), FILTERS), np.float32)
        for i in range(0, len(chunks), step):
            out[i : i + step] = self.responses(chunks[i : i + step]).max(axis=1)
        return np.maximum(out + self.bias, 0)

    def combined(self, hidden: np.ndarray, owner: np.ndarray) -> np.ndarray:
        begin = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        counts = np.diff(np.append(begin, len(owner)))
        most = np.maximum.reduceat(hidden, begin)
        mean = np.add.reduceat(hidden, begin) / counts[:, None].astype(np.float32)
        return np.hstack([most, mean])

    def logits(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        chunks, owner = chunked(raw, offsets)
        return self.combined(self.pooled(chunks), owner) @ self.out + self.level[0]


NAMES = ("taps", "bias", "out", "level")


def gradients(net: Network, raw: np.ndarray, offsets: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean weighted logistic loss of some texts, by each of ``NAMES``."""
    n = len(offsets) - 1
    chunks, owner = chunked(raw, offsets)
    peak = np.empty((len(chunks), FILTERS), np.int64)
    best = np.empty((len(chunks), FILTERS), np.float32)
    for i in range(0, len(chunks), 64):
        r = net.responses(chunks[i : i + 64])
        p = r.argmax(axis=1)
        peak[i : i + 64] = p
        best[i : i + 64] = np.take_along_axis(r, p[:, None, :], 1)[:, 0, :]
    hidden = np.maximum(best + net.bias, 0)
    features = net.combined(hidden, owner)
    p = 1 / (1 + np.exp(-(features @ net.out + net.level[0])))
    d = ((p - y) * weight / n).astype(np.float32)
    grads = {"out": features.T @ d, "level": np.array([d.sum()], np.float32)}
    counts = np.bincount(owner, minlength=n).astype(np.float32)
    down = d[:, None] * net.out[None, :]
    g = (down[:, FILTERS:] / counts[:, None])[owner]
    top = (hidden == features[owner, :FILTERS]).astype(np.float32)
    ties = np.zeros((n, FILTERS), np.float32)
    np.add.at(ties, owner, top)
    g += top * (down[:, :FILTERS] / ties)[owner]
    g *= hidden > 0
    grads["bias"] = g.sum(axis=0)
    rows, filters = np.nonzero(g)
    values, at = g[rows, filters], peak[rows, filters]
    taps = np.zeros(WIDTH * 256 * FILTERS, np.float64)
    for k in range(WIDTH):
        index = (k * 256 + chunks[rows, at + k].astype(np.int64)) * FILTERS + filters
        taps += np.bincount(index, weights=values, minlength=len(taps))
    grads["taps"] = taps.reshape(net.taps.shape).astype(np.float32)
    return grads


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0] + [len(t) for t in texts])


def train(texts: list[bytes], y: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Network:
    """Adam on the logistic loss, each class weighing one half, so that 0.5 lies between them
    whatever their shares are."""
    net, rng = Network(seed), np.random.default_rng(seed)
    first = {n: np.zeros_like(getattr(net, n)) for n in NAMES}
    second = {n: np.zeros_like(getattr(net, n)) for n in NAMES}
    weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    step, batch = 0, 32
    for epoch in range(epochs):
        order = rng.permutation(len(texts))
        for b in range(0, len(order), batch):
            own = order[b : b + batch]
            grads = gradients(net, *joined([texts[i] for i in own]), y[own], weight[own])
            step += 1
            rate = 0.01 * (1 - 0.9 * epoch / epochs)
            for n in NAMES:
                first[n] = 0.9 * first[n] + 0.1 * grads[n]
                second[n] = 0.999 * second[n] + 0.001 * grads[n] ** 2
                move = (first[n] / (1 - 0.9**step)) / (np.sqrt(second[n] / (1 - 0.999**step)) + 1e-8)
                setattr(net, n, (getattr(net, n) - rate * move).astype(np.float32))
    return net


def _score(shared_net):
    def each(batches):
        net = shared_net.value
        if net is not None and net.pairs is None:
            net.freeze()
        for batch in pieces(batches):
            if net is None:
                score = np.full(batch.num_rows, 0.5)
            else:
                score = 1 / (1 + np.exp(-net.logits(*buffers(batch.column("text"))).astype(np.float64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(score, pa.float64())],
                ["doc_id", "held_out", "score"],
            )

    return each


def fit(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held_out: int, per_class: int = PER_CLASS) -> Network | None:
    sample = labelled_sample(labels, label, modulus, held_out, per_class)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # The sample is bounded by per_class, and so is what is broadcast and collected.
    rows = sorted(texts.join(F.broadcast(sample), "doc_id").collect())
    y = np.array([r["y"] for r in rows], np.float64)
    if len(set(y)) < 2:
        return None
    return train([r["text"].encode() for r in rows], y)


@query("op5_quality_net")
def op5_quality_net(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents. Training is beyond SQL; tests hold out a fold."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    net = spark.sparkContext.broadcast(fit(docs, labels, "quality", 3, 1))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (fold(3) == 1).alias("held_out"), F.col("text").cast("string").alias("text")
    )
    scored = rows.mapInArrow(_score(net), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
