"""Toxicity from confirmed examples and unlabelled text.

A sparse linear classifier over the words of a text and their beginnings is trained in
numpy with the non-negative positive-unlabelled risk: the risk of confirmed examples as
toxic, weighted by the class prior, plus the risk of unlabelled texts as harmless less
the share that the prior owes to toxic texts among them, which is kept from falling
below zero. A one-norm keeps chance features at zero, so long texts do not add up noise.

Fitting reads at most ``POSITIVE`` confirmed and ``UNLABELLED`` other texts, whose labels
are not looked at; scoring reads every text whole.

Defined cases: a null or empty text scores as one without features; every text scores
the class prior when there is no confirmed example or nothing else; repeated rows are
scored one by one; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factgraph.llm.common import key_type, label_share, map_slices, record, sample_ids

POSITIVE, UNLABELLED = 2000, 6000
# Features of one text that fitting looks at, and the texts a feature must stand in.
MOST_FEATURES, LEAST_TEXTS = 20_000, 8
STEPS, RATE, SPARSITY = 250, 0.08, 4e-4
BEGINNINGS = (4, 5)
THRESHOLD = 0.5
MARKS = b".,;:!?()[]{}\"'"


def features(text: str | None) -> np.ndarray:
    """Hashes of the distinct words and word beginnings of a whole text."""
    words = set((text or "").encode("utf-8", "surrogatepass").lower().translate(None, MARKS).split())
    parts = set()
    for size in BEGINNINGS:
        parts.update([b"^" + w[:size] for w in words if len(w) >= size])
    return np.unique(np.fromiter(map(crc32, words | parts), np.int64))


@dataclass
class Model:
    names: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def score(self, text: str | None) -> float:
        if not len(self.names):
            return self.prior
        own = features(text)
        at = np.searchsorted(self.names, own)
        at[at == len(self.names)] = 0
        z = self.bias + float(self.weights[at[self.names[at] == own]].sum())
        return float(1 / (1 + np.exp(-min(max(z, -30.0), 30.0))))


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> Model:
    """Minimise the non-negative risk with Adam steps and soft thresholds."""
    seen, counts = np.unique(np.concatenate(positive + unlabelled), return_counts=True)
    names = seen[counts >= LEAST_TEXTS]

    def rows(texts):
        own = []
        for t in texts:
            at = np.searchsorted(names, t)
            at[at == len(names)] = 0
            own.append(at[names[at] == t] if len(names) else at[:0])
        sizes = np.array([len(o) for o in own])
        return np.concatenate(own), sizes, np.repeat(np.arange(len(own)), sizes)

    p_cols, p_sizes, p_rows = rows(positive)
    u_cols, u_sizes, u_rows = rows(unlabelled)
    n, n_p, n_u = len(names), len(positive), len(unlabelled)
    w = np.zeros(n + 1)
    w[n] = np.log(prior / (1 - prior))
    first, second = np.zeros(n + 1), np.zeros(n + 1)
    for step in range(1, STEPS + 1):
        g_p = np.bincount(p_rows, w[p_cols], n_p) + w[n]
        g_u = np.bincount(u_rows, w[u_cols], n_u) + w[n]
        s_p, s_u = (1 / (1 + np.exp(-np.clip(g, -30, 30))) for g in (g_p, g_u))
        harmless = np.logaddexp(0, g_u).mean() - prior * np.logaddexp(0, g_p).mean()
        if harmless >= 0:
            d_p, d_u = (-prior * (1 - s_p) - prior * s_p) / n_p, s_u / n_u
        else:  # the estimate fell below zero: step back along its gradient alone
            d_p, d_u = prior * s_p / n_p, -s_u / n_u
        slope = np.bincount(p_cols, np.repeat(d_p, p_sizes), n) + np.bincount(u_cols, np.repeat(d_u, u_sizes), n)
        slope = np.r_[slope, d_p.sum() + d_u.sum()]
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope * slope
        scale = RATE / (np.sqrt(second / (1 - 0.999**step)) + 1e-6)
        w = w - scale * first / (1 - 0.9**step)
        shrink = np.minimum(scale[:n] * SPARSITY, 0.5)
        w[:n] = np.sign(w[:n]) * np.maximum(np.abs(w[:n]) - shrink, 0)
    kept = np.flatnonzero(w[:n])
    return Model(names[kept], w[kept], float(w[n]), prior)


def fit(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "toxic") -> Model:
    """Learn from the confirmed rows and the unlabelled texts that ``learn`` allows."""
    share = label_share(labels, label, learn)
    nothing = Model(np.zeros(0, np.int64), np.zeros(0), 0.0, 0.5 if share is None else float(share))
    if not share or share >= 1:
        return nothing
    toxic = labels.filter((F.col(label) == 1) & learn).select("doc_id", F.lit(1).alias("part")).distinct()
    other = docs.filter(learn & (F.length("text") > 0)).select("doc_id", F.lit(0).alias("part"))
    ids = sample_ids(toxic, "part", POSITIVE).unionByName(sample_ids(other, "part", UNLABELLED).distinct())
    sample = docs.select("doc_id", "text").filter(F.length("text") > 0).join(F.broadcast(ids), "doc_id")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = [features(t) for t in batch.column("text").to_pylist()]
        return record(
            part=batch.column("part"), features=pa.array([f[:MOST_FEATURES].astype("<u4").tobytes() for f in own], pa.binary())
        )

    rows = sorted((r.part, bytes(r.features)) for r in map_slices(sample.select("part", "text"), work, "part int, features binary").collect())
    sets = [[np.frombuffer(f, "<u4").astype(np.int64) for p, f in rows if p == part] for part in (1, 0)]
    return train(*sets, float(share)) if all(sets) else nothing


def scores(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, score, predicted`` of every whole text."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [model.score(t) for t in batch.column("text").to_pylist()]
        return record(doc_id=batch.column("doc_id"), score=pa.array(found, pa.float64()))

    rows = map_slices(docs.select("doc_id", "text"), work, f"doc_id {key_type(docs)}, score double")
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
