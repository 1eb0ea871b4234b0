"""Repeated spans of fifty words, found on a compacted De Bruijn graph of tokens.

Token k-mers of sixteen words are the edges of the graph. Of every 50-word window the
smallest k-mer by hash, the leftmost among equals, is its edge, so equal windows hang on
equal edges at equal places. Consecutive windows on one edge form a path. A join keeps
the edges that stand in several documents. Paths that never branch are equal as a whole
wherever they stand: Spark groups paths by content, which compacts all their copies into
one row with the coordinates of the first, and copies in later documents go as a whole.
Where an edge branches into several paths, the first copy of each is opened at its source
coordinates into its windows, since single windows may stand in smaller documents on
another path; a grouping of those windows verifies them one by one.

Nothing is limited: a hot path costs one row per task before the shuffle, a join on it is
split by AQE, and all windows of a hot edge spread by their own hashes.

Hashes are 64 bits of the words, two independent ones in every comparison (edge and path,
edge and window).

Defined cases: a null or empty text has no words and is kept as it is; texts of fewer
words than a window lose nothing; rows with one ``doc_id`` are one document and do not
remove from each other; rows without ``doc_id`` neither lose words nor are sources; an
empty table gives an empty result. Columns may have any names but those starting with
``__``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factgraph.llm.common import frugal, map_slices, record, slices, staged

WINDOW = 50
EDGE = 16
BASE = 0x9E3779B97F4A7C15


@lru_cache(maxsize=4)
def _powers(n: int):
    """Powers of an odd base and of its inverse modulo 2**64."""
    import numpy as np

    inverse = np.uint64(pow(BASE, -1, 1 << 64))
    with np.errstate(over="ignore"):
        up = np.cumprod(np.r_[np.uint64(1), np.full(n, BASE, np.uint64)])
        down = np.cumprod(np.r_[np.uint64(1), np.full(n, inverse, np.uint64)])
    return up, down


class Hashed:
    """Hashes of all runs of words of one text, by prefix sums."""

    def __init__(self, words: list[bytes]):
        import numpy as np
        import xxhash

        n = len(words)
        up, self.down = _powers(1 << max(10, n.bit_length()))
        own = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(own * up[:n], dtype=np.uint64)])

    def runs(self, start, end):
        import numpy as np

        h = (self.sums[end] - self.sums[start]) * self.down[start]
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(32))


def tokens(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def text_paths(words: list[bytes]):
    """``first window, windows, edge, path`` of every path of one text."""
    import numpy as np

    n = len(words)
    if n < WINDOW:
        return None
    hashed = Hashed(words)
    at = np.arange(n - EDGE + 1)
    edges = hashed.runs(at, at + EDGE)
    span = WINDOW - EDGE + 1
    smallest = np.lib.stride_tricks.sliding_window_view(edges, span).argmin(1) + np.arange(n - WINDOW + 1)
    first = np.flatnonzero(np.r_[True, smallest[1:] != smallest[:-1]])
    count = np.diff(np.r_[first, len(smallest)])
    path = hashed.runs(first, first + count + (WINDOW - 1))
    return first, count, edges[smallest[first]].view(np.int64), path.view(np.int64)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("__hash", F.xxhash64("text"))


def paths(docs: DataFrame) -> DataFrame:
    """``doc_id, __hash, at, n, edge, path`` of all texts."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = _keyed(docs.filter(F.col("doc_id").isNotNull())).select("doc_id", "__hash", "text")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        import numpy as np

        found = [text_paths(tokens(t)) for t in batch.column("text").to_pylist()]
        sizes = [0 if f is None else len(f[0]) for f in found]
        rows = pa.array(np.repeat(np.arange(len(found)), sizes))
        some = [f for f in found if f is not None]
        parts = [np.concatenate([f[i] for f in some]) if some else np.zeros(0, np.int64) for i in range(4)]
        return record(
            doc_id=batch.column("doc_id").take(rows),
            __hash=batch.column("__hash").take(rows),
            at=pa.array(parts[0], pa.int32()),
            n=pa.array(parts[1], pa.int32()),
            edge=pa.array(parts[2], pa.int64()),
            path=pa.array(parts[3], pa.int64()),
        )

    return map_slices(rows, work, f"doc_id {kind}, __hash long, at int, n int, edge long, path long")


def removals(docs: DataFrame) -> DataFrame:
    """``__id, __key, __runs``: per document the windows to remove, as places and bit masks.

    ``docs`` must carry ``__hash``. All its columns pass the step that opens paths, so that
    Spark uses one exchange of ``docs`` here and in the caller's own join.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = staged(paths(docs.drop("__hash")))
    shared = found.groupBy("edge").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).filter("a < b").select("edge")
    near = staged(found.join(staged(shared), "edge"))
    compact = staged(
        near.groupBy("edge", "path", "n").agg(F.min(F.struct("doc_id", "__hash", "at")).alias("source"), F.max("doc_id").alias("last"))
    )
    # An edge whose paths all begin in one document has nothing to look up.
    branching = compact.groupBy("edge").agg(F.min("source.doc_id").alias("a"), F.max("source.doc_id").alias("b")).filter("a < b").select("edge")

    # First copies are opened at their source coordinates.
    opened = staged(
        compact.join(staged(branching), "edge").groupBy(F.col("source.doc_id").alias("__id"), F.col("source.__hash").alias("__key")).agg(
            F.collect_list(F.struct(F.col("source.at").alias("at"), "n", "edge", "path")).alias("__open")
        )
    )
    at_source = docs.join(opened, (docs["doc_id"] == opened["__id"]) & (docs["__hash"] == opened["__key"]), "left")

    def open_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow.compute as pc

        for whole in batches:
            for batch in slices(whole.filter(pc.is_valid(whole.column("__open")))):
                out = {c: [] for c in ("doc_id", "edge", "path", "n", "i", "window")}
                for doc, text, own in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "__open")), strict=True):
                    hashed = Hashed(tokens(text))
                    n = np.array([p["n"] for p in own])
                    i = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    start = np.repeat(np.array([p["at"] for p in own]), n) + i
                    out["doc_id"].append(np.repeat(doc, n.sum()))
                    out["edge"].append(np.repeat(np.array([p["edge"] for p in own]), n))
                    out["path"].append(np.repeat(np.array([p["path"] for p in own]), n))
                    out["n"].append(np.repeat(n, n))
                    out["i"].append(i)
                    out["window"].append(hashed.runs(start, start + WINDOW).view(np.int64))
                if out["i"]:
                    types = {"doc_id": batch.schema.field("doc_id").type, "n": pa.int32(), "i": pa.int32()}
                    yield record(**{c: pa.array(np.concatenate(v), types.get(c, pa.int64())) for c, v in out.items()})

    schema = f"doc_id {kind}, edge long, path long, n int, i int, window long"
    every = at_source.select(*docs.columns, "__open").mapInArrow(frugal(open_paths), schema)
    owners = every.groupBy("edge", "window").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last")).filter("owner < last")
    masks = (
        every.join(owners.drop("last").hint("rebalance"), ["edge", "window"]).filter("owner < doc_id")
        .groupBy("edge", "path", "n").agg(F.bit_or(F.expr("shiftleft(1L, i)")).alias("mask"))
    )
    first = compact.select("edge", "path", "n", F.col("source.doc_id").alias("first"), "last")
    known = first.join(masks, ["edge", "path", "n"], "left").filter("first < last or mask is not null")
    whole = F.expr("shiftleft(1L, n) - 1")
    # Dealt anew, as the owners above, so that AQE can split a hot key in these joins.
    gone = near.join(known.hint("rebalance"), ["edge", "path", "n"]).select(
        F.col("doc_id").alias("__id"), F.col("__hash").alias("__key"),
        F.struct("at", F.when(F.col("doc_id") > F.col("first"), whole).otherwise(F.col("mask")).alias("mask")).alias("run"),
    ).filter("run.mask is not null")
    return gone.groupBy("__id", "__key").agg(F.collect_set("run").alias("__runs"))


def kept_words(words: list[bytes], runs: list[dict] | None) -> list[bytes]:
    """The words no removed window covers."""
    import numpy as np

    if not runs:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    for run in runs:
        mask, at = run["mask"], run["at"]
        starts = at + np.flatnonzero((mask >> np.arange(mask.bit_length())) & 1)
        np.add.at(edge, starts, 1)
        np.add.at(edge, starts + WINDOW, -1)
    gone = np.cumsum(edge[:-1]) > 0
    return [w for w, g in zip(words, gone.tolist(), strict=True) if not g]


def _joined(docs: DataFrame) -> DataFrame:
    keyed = _keyed(docs)
    gone = removals(keyed)
    return keyed.join(gone, (keyed["doc_id"] == gone["__id"]) & (keyed["__hash"] == gone["__key"]), "left")


def report(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` per document."""
    import hashlib

    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        n, kept, digest = [], [], []
        for text, runs in zip(batch.column("text").to_pylist(), batch.column("__runs").to_pylist(), strict=True):
            words = tokens(text)
            left = kept_words(words, runs)
            n.append(len(words)), kept.append(len(words) - len(left))
            digest.append(hashlib.sha256(b" ".join(left)).hexdigest())
        return record(
            doc_id=batch.column("doc_id"), n_words=pa.array(n, pa.int64()), n_removed=pa.array(kept, pa.int64()), kept_sha256=pa.array(digest, pa.string())
        )

    rows = _joined(docs.select("doc_id", "text")).select("doc_id", "text", "__runs")
    return map_slices(rows, work, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string")


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated words removed from ``text``; ``n_chars``, if there, follows.

    A text that loses nothing stays as it is, line breaks included; of any other the kept
    words remain, joined by one space.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = []
        for text, runs in zip(batch.column("text").to_pylist(), batch.column("__runs").to_pylist(), strict=True):
            texts.append(b" ".join(kept_words(tokens(text), runs)).decode("utf-8", "surrogatepass") if runs else text)
        at = batch.schema.names.index("text")
        out = batch.set_column(at, "text", pa.array(texts, pa.string()))
        return out.drop_columns(["__runs"])

    rows = _joined(docs).select(*docs.columns, "__runs")
    out = map_slices(rows, work, docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out
