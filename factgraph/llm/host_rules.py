"""Quality rules judged by host.

Every document is measured on its whole text. Rule failures are summed by host, the rate
of each host is shrunk towards the rate of all hosts with a beta prior fitted to the
hosts themselves, and documents of hosts whose shrunk rate is too high are rejected with
the documents that fail a rule on their own.

Defined cases: a null text counts as empty; an empty text has no words and fails; rows
without a host form one host of their own; repeated rows are judged one by one; an empty
table gives an empty result. Other columns of the input are never read.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factgraph.llm.common import map_slices, record, staged

# A host is rejected when its shrunk failure rate is above this.
MAX_HOST_RATE = 0.5
# Bounds of the prior's weight in documents.
LEAST_WEIGHT, MOST_WEIGHT = 1.0, 1e6

MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"


def measure(text: str | None) -> tuple[int, int, int, int, int]:
    """Words, their code points, symbols, repeated lines and words in repeated 3-word windows."""
    import numpy as np

    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    n = len(words)
    seen, dup_lines = set(), 0
    for line in text.split("\n"):
        if line in seen:
            dup_lines += 1
        elif line.strip(SPACES):
            seen.add(line)
    repeated = 0
    if n > 3:
        h = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
        grams = h[:-2] * np.uint64(0x9E3779B97F4A7C15) + (h[1:-1] ^ (h[1:-1] >> np.uint64(29))) * np.uint64(
            0xC2B2AE3D27D4EB4F
        )
        grams = (grams ^ (grams >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93) + h[2:]
        order = np.argsort(grams, kind="stable")
        ranked = grams[order]
        same = ranked[1:] == ranked[:-1]
        twice = np.zeros(n - 2, bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        covered = np.zeros(n, bool)
        for shift in range(3):
            covered[shift : n - 2 + shift] |= twice
        repeated = int(covered.sum())
    return n, len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), dup_lines, repeated


def measures(docs: DataFrame, host: Column | str = "source") -> DataFrame:
    """``doc_id, host`` and the measures of every whole text."""
    rows = docs.select("doc_id", (F.col(host) if isinstance(host, str) else host).cast("string").alias("host"), "text")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = list(zip(*map(measure, batch.column("text").to_pylist()), strict=True))
        return record(
            doc_id=batch.column("doc_id"),
            host=batch.column("host"),
            **{c: pa.array(v, pa.int64()) for c, v in zip(("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"), found, strict=True)},
        )

    return map_slices(rows, work, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, host string, {MEASURES}")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def host_rates(judged: DataFrame) -> DataFrame:
    """``host, n, failed, rate, shrunk``: rates of hosts under the fitted beta prior.

    With p the rate over all documents and v the variance of host rates weighted by
    documents, the prior weighs s = p (1 - p) / v - 1 documents.
    """
    hosts = judged.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("base_failed").cast("long")).alias("failed"))
    hosts = hosts.withColumn("rate", F.col("failed") / F.col("n"))
    total, n = F.sum("failed"), F.sum("n")
    squares = F.sum(F.col("failed") * F.col("rate"))
    row = hosts.agg((total / n).alias("p"), (squares / n).alias("q")).first()
    p, v = row.p or 0.0, max((row.q or 0.0) - (row.p or 0.0) ** 2, 0.0)
    weight = MOST_WEIGHT if v <= 1e-12 else min(max(p * (1 - p) / v - 1, LEAST_WEIGHT), MOST_WEIGHT)
    return hosts.withColumn("shrunk", (F.col("failed") + p * weight) / (F.col("n") + weight))


def host_rules(docs: DataFrame, host: Column | str = "source", max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """``doc_id, host``, the measures, ``base_failed``, the host's ``shrunk`` rate and ``kept``.

    The measures are staged once; only they and the host's name are shuffled, and a hot
    host costs one counter per task. The prior is two
    numbers, read on the driver.
    """
    judged = staged(measures(docs, host).withColumn("base_failed", base_failed()))
    rates = host_rates(judged).select(F.col("host").alias("_host"), "shrunk")
    joined = judged.join(rates, F.col("host").eqNullSafe(F.col("_host")), "left").drop("_host")
    return joined.withColumn("kept", ~F.col("base_failed") & (F.col("shrunk") <= max_host_rate))
