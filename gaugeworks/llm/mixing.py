"""Mixing sources to target weights by soft membership.

A softmax classifier over hashed byte trigrams is fitted on a labelled table and gives every
document a posterior over the domains; here a domain is a pair of quality and toxicity labels.
Document rates r >= 0 (how often a document is drawn) then make the expected share of tokens of
each domain match its target:

    minimise  1/2 sum_k (a_k - t_k)^2 / t_k  +  ridge/2 sum_d w_d (r_d - 1)^2
    where     a = sum_d w_d r_d p_d,   w_d = tokens of d / all tokens

with p_d the posterior and t the targets; dividing by t makes rare domains count. It is solved by accelerated projected gradient steps.
A step of a document needs only its own posterior and the K residuals of the steps so far, which
all documents share, so rates are never stored or shuffled: each step is one pass over the
compact posteriors that adds up K numbers, and any task can replay any rate.

The classifier is fitted on about ``PER_DOMAIN`` labelled rows of each domain (the documented
bound), weighted to the domains' shares among all labelled rows. Null and empty texts have no
words, weigh nothing, and get the rate of the posterior of an empty text. Without labels all
domains are equally likely. Repeated rows and ids get a row each.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.llm.common import Shared, labelled_sample, pieces, query, table
from gaugeworks.llm.language_centroids import BUCKETS, ROWS, counts
from gaugeworks.llm.tokens import split

#: Domains and the share of tokens each shall have. Their order is 2 * quality + toxic.
TARGETS = {"low": 0.10, "low_toxic": 0.01, "high": 0.87, "high_toxic": 0.02}
PER_DOMAIN = 600
RIDGE = 1e-3
STEPS = 300
TOLERANCE = 1e-6
#: The least target that a residual is divided by.
LEAST_TARGET = 1e-3


@dataclass
class Posterior:
    weights: np.ndarray  #: (buckets, domains)
    bias: np.ndarray

    def __call__(self, column: pa.Array) -> np.ndarray:
        return softmax(features(column) @ self.weights + self.bias)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def features(column: pa.Array) -> np.ndarray:
    v = np.log1p(counts(column))
    length = np.linalg.norm(v, axis=1, keepdims=True)
    return v / np.where(length > 0, length, 1)


def train(x: np.ndarray, y: np.ndarray, shares: np.ndarray, steps: int = 300) -> Posterior:
    """Full-batch Adam with a little shrinkage; rows weigh as their domain's share."""
    k = len(shares)
    sizes = np.bincount(y, minlength=k)
    row = shares[y] / sizes[y]
    row /= row.sum()
    w, b = np.zeros((x.shape[1], k), np.float32), np.log(np.maximum(shares, 1e-6)).astype(np.float32)
    target = np.eye(k, dtype=np.float32)[y]
    first, second = [np.zeros_like(w), np.zeros_like(b)], [np.zeros_like(w), np.zeros_like(b)]
    for step in range(1, steps + 1):
        d = ((softmax(x @ w + b) - target) * row[:, None]).astype(np.float32)
        moves = []
        for i, g in enumerate((x.T @ d + 1e-6 * w, d.sum(axis=0))):
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
            moves.append(first[i] / (1 - 0.9**step) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8))
        w, b = w - np.float32(0.2) * moves[0], b - np.float32(0.05) * moves[1]
    return Posterior(w, b)


def fit_posterior(docs: DataFrame, labels: DataFrame, domains: int, per_domain: int = PER_DOMAIN) -> Posterior:
    label = 2 * F.col("quality").cast("int") + F.col("toxic").cast("int")
    sizes = {r["y"]: r["count"] for r in labels.select(label.alias("y")).groupBy("y").count().collect()}
    sample = labelled_sample(labels, label, 1, -1, per_domain, domains)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = sorted(docs.join(F.broadcast(sample), "doc_id").select("doc_id", "text", "y").collect())
    if not rows:
        return Posterior(np.zeros((BUCKETS, domains), np.float32), np.zeros(domains, np.float32))
    shares = np.array([sizes.get(k, 0) for k in range(domains)], float)
    x = np.concatenate([features(pa.array([r["text"] for r in rows[i : i + ROWS]], pa.string())) for i in range(0, len(rows), ROWS)])
    return train(x, np.array([r["y"] for r in rows]), shares / shares.sum())


def rates(p: np.ndarray, residuals: np.ndarray, ridge: float, step: float) -> tuple[np.ndarray, np.ndarray]:
    """Rates after the steps with these residuals (steps, K), and the point of the next step."""
    r = point = np.ones(len(p))
    t = 1.0
    for residual in residuals:
        moved = np.maximum(0.0, point - step * (p @ residual + ridge * (point - 1)))
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        point = moved + (t - 1) / after * (moved - r)
        r, t = moved, after
    return r, point


def _posteriors(shared_posterior):
    def each(batches):
        posterior = shared_posterior.value
        for batch in pieces(batches, rows=ROWS):
            p = posterior(batch.column("text")).astype(np.float64)
            flat = pa.array(p.ravel())
            at = pa.array(np.arange(0, p.size + 1, p.shape[1], dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(split(batch.column("text")).counts()), pa.ListArray.from_arrays(at, flat)],
                ["doc_id", "n_tokens", "posterior"],
            )

    return each


def _matrix(column: pa.Array, k: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, k)


def _totals(residuals: np.ndarray, k: int, ridge: float, step: float):
    """Sums over documents of tokens * (rate, and point of the next step) * posterior."""

    def each(batches):
        total = np.zeros(2 * k)
        for batch in batches:
            if batch.num_rows:
                p = _matrix(batch.column("posterior"), k)
                tokens = batch.column("n_tokens").to_numpy()
                total += np.concatenate([(tokens * x) @ p for x in rates(p, residuals, ridge, step)])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(2 * k)), pa.array(total)], ["i", "total"])

    return each


def _gram(k: int):
    """Sums over documents of tokens * posterior * posterior'."""

    def each(batches):
        total = np.zeros((k, k))
        for batch in batches:
            if batch.num_rows:
                p = _matrix(batch.column("posterior"), k)
                total += (p * batch.column("n_tokens").to_numpy()[:, None]).T @ p
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k * k)), pa.array(total.ravel())], ["i", "total"])

    return each


def _added(posteriors: DataFrame, each, size: int) -> np.ndarray:
    """Sums of the ``size`` numbers that each task makes."""
    sums = posteriors.select("n_tokens", "posterior").mapInArrow(each, "i long, total double")
    found = {r["i"]: r["total"] for r in sums.groupBy("i").agg(F.sum("total").alias("total")).collect()}
    return np.array([found.get(i, 0.0) for i in range(size)])


def fit_rates(posteriors: DataFrame, targets: np.ndarray, ridge: float = RIDGE, steps: int = STEPS, tolerance: float = TOLERANCE):
    """Scaled residuals of the steps, and the step length, from (n_tokens, posterior)."""
    k, n = len(targets), posteriors.agg(F.sum("n_tokens")).first()[0] or 0
    scale = np.maximum(targets, LEAST_TARGET)
    residuals = np.zeros((0, k))
    if not n:
        return residuals, 1.0
    gram = _added(posteriors, _gram(k), k * k).reshape(k, k) / n
    steepest = np.linalg.eigvalsh(gram / np.sqrt(np.outer(scale, scale))).max()
    step = 1.0 / (steepest + ridge)
    last = None
    for _ in range(steps):
        total = _added(posteriors, _totals(residuals, k, ridge, step), 2 * k) / n
        if last is not None and np.abs(total[:k] - last).max() < tolerance:
            break
        last = total[:k]
        residuals = np.vstack([residuals, (total[k:] - targets) / scale])
    return residuals, step


def _rated(residuals: np.ndarray, k: int, ridge: float, step: float):
    def each(batches):
        for batch in batches:
            p = _matrix(batch.column("posterior"), k) if batch.num_rows else np.zeros((0, k))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(rates(p, residuals, ridge, step)[0])], [*batch.schema.names, "rate"]
            )

    return each


def mix(docs: DataFrame, labels: DataFrame, shared: Shared, targets: dict[str, float] = TARGETS, ridge: float = RIDGE) -> DataFrame:
    """(doc_id, text) to (doc_id, n_tokens, posterior, rate), a row for each row."""
    goal = np.array(list(targets.values()))
    posterior = fit_posterior(docs, labels, len(goal))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    compact = shared.keep(
        rows.mapInArrow(
            _posteriors(docs.sparkSession.sparkContext.broadcast(posterior)), "doc_id long, n_tokens long, posterior array<double>"
        ),
        "posteriors",
    )
    residuals, step = fit_rates(compact, goal, ridge)
    return compact.mapInArrow(_rated(residuals, len(goal), ridge, step), "doc_id long, n_tokens long, posterior array<double>, rate double")


def mix_rows(docs: DataFrame, labels: DataFrame, shared: Shared, targets: dict[str, float] = TARGETS, ridge: float = RIDGE) -> DataFrame:
    """``docs``, all rows and columns, with `mix_rate` added: posteriors and rates are replayed
    beside each row, so nothing is joined."""
    goal = np.array(list(targets.values()))
    k = len(goal)
    posterior = docs.sparkSession.sparkContext.broadcast(fit_posterior(docs, labels, k))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    compact = shared.keep(
        rows.mapInArrow(_posteriors(posterior), "doc_id long, n_tokens long, posterior array<double>"), "posteriors"
    )
    residuals, step = fit_rates(compact, goal, ridge)

    def each(batches):
        for batch in pieces(batches, "gw_text", rows=ROWS):
            p = posterior.value(batch.column("gw_text")).astype(np.float64)
            rate = pa.array(rates(p, residuals, ridge, step)[0])
            names = batch.schema.names
            yield pa.RecordBatch.from_arrays([rate if n == "gw_rate" else batch.column(n) for n in names], names)

    whole = docs.select(F.struct("*").alias("gw_row"), F.col("text").cast("string").alias("gw_text"), F.lit(0.0).alias("gw_rate"))
    done = whole.mapInArrow(each, whole.schema)
    own = [F.col(f"gw_row.`{c}`").alias(c) for c in docs.columns if c.lower() != "mix_rate"]
    return done.select(*own, F.col("gw_rate").alias("mix_rate"))


@query("op4_mixing")
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents. Fits are beyond SQL; tests hold the rates against plain descent."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    mixed = mix(docs, labels, Shared(spark, "op4"))
    names = [F.element_at("posterior", i + 1).alias(f"p_{name}") for i, name in enumerate(TARGETS)]
    return mixed.select("doc_id", "n_tokens", *names, "rate", (F.col("rate") * F.col("n_tokens")).alias("expected_tokens"))
