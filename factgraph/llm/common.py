"""Steps that several operators share: folds, Arrow batches, bounded samples."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factgraph.session import staged  # noqa: F401 (operators take it from here)

# Bytes of text that a task holds at once, whatever the size of an Arrow batch.
SLICE_BYTES = 4 << 20
# Values of a key that one expression tells apart; the counts of more are joined.
FEW_VALUES = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: Column | str, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``; null keys belong to no fold."""
    return F.crc32(F.col(key).cast("string") if isinstance(key, str) else key.cast("string")) % folds


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts hold about ``limit`` bytes; one longer text stands alone."""
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
    start = held = 0
    for i, size in enumerate(sizes):
        if i > start and held + size > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if len(sizes) > start:
        yield batch.slice(start)


def give_back() -> None:
    """Return freed memory to the system: Python workers are kept for later tasks."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


# What operators keep in a Python worker between tasks: how to forget it, by operator.
_kept: dict[str, Callable[[], None]] = {}


def keep_between_tasks(owner: str, forget: Callable[[], None]) -> None:
    """Say that ``owner`` keeps results in this worker, and what drops them."""
    _kept[owner] = forget


def forget_others(owner: str | None = None) -> None:
    """Drop what operators other than ``owner`` keep in this worker."""
    others = [name for name in _kept if name != owner]
    for name in others:
        _kept.pop(name)()
    if others:
        give_back()


def frugal(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], owner: str | None = None):
    """``work`` for ``mapInArrow``, giving its memory back when a task ends.

    A worker serves the tasks of one operator after those of another; what others than
    ``owner`` keep there is dropped when a task begins.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_others(owner)
        try:
            yield from work(batches)
        finally:
            give_back()

    return run


def map_slices(
    df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, setup: Callable[[], Callable] | None = None,
    limit: int = SLICE_BYTES,
) -> DataFrame:
    """``work`` over Arrow slices of ``df``; ``setup``, when given, builds it once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = setup() if setup else work
        for batch in batches:
            for part in slices(batch, limit=limit):
                out = step(part)
                if out.num_rows:
                    yield out

    return df.mapInArrow(frugal(run), schema)


class Memory:
    """Results by key, remembered up to so many bytes in two generations.

    ``known`` is a plain dict, so that callers map its ``__getitem__`` over many keys; take
    it anew after ``make_room``. When half of the bytes are used, what is known becomes the
    older generation, and what is asked for again comes back from there (``recall``). Keys
    longer than ``longest`` stay only until ``forget_long``.
    """

    # What a key and its result take besides their own bytes.
    EACH = 160

    def __init__(self, most_bytes: int, longest: int = 1024):
        self.known: dict = {}
        self.older: dict = {}
        self.most_bytes, self.longest, self.held = most_bytes, longest, 0
        self.long: list = []

    def make_room(self) -> dict:
        if 2 * self.held > self.most_bytes:
            self.older, self.known, self.held = self.known, {}, 0
        return self.known

    def recall(self, key):
        """The result from the older generation, if it is there."""
        value = self.older.get(key)
        if value is not None:
            self.keep(key, value, len(value))
        return value

    def recall_all(self, keys: Sequence) -> list:
        """``recall`` for many keys; returns those that are not there."""
        older = self.older
        back = [k for k in keys if k in older]
        if not back:
            return list(keys)
        self.keep_all(back, list(map(older.__getitem__, back)))
        return [k for k in keys if k not in older]

    def keep(self, key, value, size: int) -> None:
        """``size``: bytes of the result."""
        self.known[key] = value
        if len(key) > self.longest:
            self.long.append(key)
        else:
            self.held += len(key) + size + self.EACH

    def keep_all(self, keys: Sequence, values: Sequence) -> None:
        """``keep`` for many results that have a length."""
        self.known.update(zip(keys, values, strict=True))
        long = [k for k in keys if len(k) > self.longest]
        self.long += long
        sizes = sum(map(len, keys)) + sum(map(len, values)) + self.EACH * (len(keys) - len(long))
        self.held += sizes - sum(len(k) + len(self.known[k]) for k in long)

    def forget_long(self) -> None:
        for key in self.long:
            self.known.pop(key, None)
        self.long.clear()


def record(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(columns)


def sample_ids(rows: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """``n`` rows per value of ``key`` in the order of a hash of ``doc_id``.

    A bounded sample for fitting only; ``key`` is a label, whose values the driver can
    hold. The counts per value give the share of hashes that holds about ``1.5 n`` rows, so no more than that
    meet in the task that ranks a value.
    """
    from factgraph.operators.shaping import first_n

    whole = 1 << 40
    order = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(whole))
    counts = rows.groupBy(key).count()
    found = counts.limit(FEW_VALUES + 1).collect()
    if len(found) > FEW_VALUES:
        limits = counts.select(F.col(key).alias("_value"), F.least(F.lit(whole), (whole * 3 * n / (F.col("count") * 2)).cast("long")).alias("_limit"))
        near = rows.join(F.broadcast(limits), F.col(key).eqNullSafe(F.col("_value"))).filter(order <= F.col("_limit")).select(*rows.columns)
        return first_n(near, [key], [order, "doc_id"], n, "_rank").drop("_rank")
    near = F.lit(False)
    for value, count in found:
        near = near | (F.col(key).eqNullSafe(F.lit(value)) & (order <= min(whole, whole * 3 * n // (2 * count))))
    return first_n(rows.filter(near), [key], [order, "doc_id"], n, "_rank").drop("_rank")


def text_windows(docs: DataFrame, keep: Sequence[str], per_doc: int, width: int) -> DataFrame:
    """Up to ``per_doc`` windows of ``width`` code points, spread evenly over each whole text.

    For fitting on bounded samples only; scoring reads whole texts.
    """
    size = F.length("text")
    count = F.least(F.lit(per_doc), F.ceil(size / width)).cast("int")
    starts = F.transform(
        F.sequence(F.lit(0), count - 1),
        lambda i: (F.when(count > 1, i * (size - width) / (count - 1)).otherwise(0)).cast("int") + 1,
    )
    rows = docs.filter(size > 0).select(*keep, "text", F.explode(starts).alias("_at"))
    return rows.select(*keep, F.substring("text", F.col("_at"), F.lit(width)).alias("text"))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, n: int) -> DataFrame:
    """``doc_id, label, text`` of at most ``n`` learnable rows per label value.

    The rows are chosen from ``labels`` alone; their ids, at most ``n`` per value of a 0/1
    label, are sent to the scan of ``docs``, so no text is shuffled. Labels that
    contradict each other for one id teach nothing.
    """
    known = labels.filter(F.col(label).isin(0, 1) & learn).groupBy("doc_id").agg(
        F.min(label).alias("label"), F.max(label).alias("_most")
    )
    ids = sample_ids(known.filter("label = _most").select("doc_id", "label"), "label", n)
    return docs.select("doc_id", "text").filter(F.length("text") > 0).join(F.broadcast(ids), "doc_id")


def label_share(labels: DataFrame, label: str, learn: Column) -> float | None:
    """Share of label 1 among all learnable rows; None without rows."""
    return labels.filter(F.col(label).isin(0, 1) & learn).agg(F.avg(label)).first()[0]


def key_type(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()


def logistic(features, labels, weights, ridge: float = 1e-4):
    """Weights and bias of a ridge logistic regression by damped Newton steps."""
    import numpy as np

    x = np.c_[features, np.ones(len(features))]
    w = np.zeros(x.shape[1])
    damp = np.r_[np.full(x.shape[1] - 1, ridge), 1e-6]
    weights = weights / weights.sum()

    def loss(w):
        return weights @ np.logaddexp(0, -(x @ w) * (2 * labels - 1)) + damp @ (w * w) / 2

    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weights * (p - labels)) + damp * w
        step = np.linalg.solve((x * (weights * p * (1 - p))[:, None]).T @ x + np.diag(damp), slope)
        size, now = 1.0, loss(w)
        while loss(w - size * step) > now and size > 1e-6:
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return w
