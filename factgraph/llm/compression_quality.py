"""Quality by compression: a text that good examples help to compress is good.

Two zstandard dictionaries are trained, one on windows of good and one on windows of bad
labelled texts, less the lines that stand in both. A whole text is compressed in pieces under both; the difference of the
two sizes, normalised by the text's length and by the sizes themselves, and the mean
size, normalised by length, go through a logistic calibration fitted on other labelled
texts than those behind the dictionaries.

Fitting reads at most ``SAMPLE_PER_LABEL`` labelled texts per label, ``WINDOWS`` windows
of ``WINDOW`` characters each; scoring reads every text whole.

Defined cases: a null or empty text, and every text when the labels do not hold both
values, scores the share of label 1 (0.5 without labels); repeated rows are scored one by
one; an empty table gives an empty result; label rows with nulls or other values than 0
and 1 teach nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factgraph.llm.common import key_type, label_share, labelled_sample, logistic, map_slices, record, text_windows

SAMPLE_PER_LABEL = 3000
WINDOWS, WINDOW = 4, 2048
DICTIONARY_BYTES, LEVEL, PIECE = 112 << 10, 3, 512
THRESHOLD = 0.7


@dataclass
class Model:
    """Two dictionaries and the calibration; ``good`` is empty when nothing was learnt."""

    good: bytes
    bad: bytes
    center: list[float]
    scale: list[float]
    weights: list[float]
    share: float

    def scorer(self) -> Callable[[str | None], float]:
        import math

        if not self.good:
            return lambda text: self.share
        sizes = _sizes(self.good, self.bad)

        def score(text: str | None) -> float:
            found = sizes(text)
            if found is None:
                return self.share
            z = self.weights[-1]
            for value, c, s, w in zip(found, self.center, self.scale, self.weights, strict=False):
                z += w * min(max((value - c) / s, -6.0), 6.0)
            return 1 / (1 + math.exp(-min(max(z, -30.0), 30.0)))

        return score


def _dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary, or the end of the samples themselves when they are too few."""
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


def _sizes(good: bytes, bad: bytes) -> Callable[[str | None], tuple[float, float, float] | None]:
    """The normalised sizes of one whole text under both dictionaries."""
    import zstandard

    def press(data):
        return zstandard.ZstdCompressor(
            level=LEVEL, dict_data=zstandard.ZstdCompressionDict(data), write_content_size=False, write_dict_id=False, write_checksum=False
        ).compress

    of_good, of_bad = press(good), press(bad)

    def sizes(text: str | None):
        data = (text or "").encode("utf-8", "surrogatepass")
        if not data:
            return None
        g = b = 0
        for at in range(0, len(data), PIECE):
            piece = data[at : at + PIECE]
            g += len(of_good(piece))
            b += len(of_bad(piece))
        return (b - g) / len(data), (b - g) / (b + g), (b + g) / 2 / len(data)

    return sizes


def fit(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "quality") -> Model:
    """Learn from the label rows that ``learn`` allows."""
    import numpy as np

    share = label_share(labels, label, learn)
    empty = Model(b"", b"", [], [], [], 0.5 if share is None else float(share))
    if share is None or not 0 < share < 1:
        return empty
    sample = labelled_sample(docs, labels, label, learn, SAMPLE_PER_LABEL).withColumn(
        "part", F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(2))
    )
    windows = text_windows(sample.filter("part = 0"), ["label"], WINDOWS, WINDOW).collect()
    # A line that both kinds share says nothing, but would help only one dictionary.
    lines = [[r.text.encode("utf-8", "surrogatepass").split(b"\n") for r in windows if r.label == v] for v in (1, 0)]
    common = set.intersection(*({line for own in kind for line in own} for kind in lines))
    good, bad = (_dictionary(sorted(b"\n".join(line for line in own if line not in common) for own in kind)) for kind in lines)
    if not good or not bad:
        return empty
    del windows

    def setup():
        sizes = _sizes(good, bad)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = [sizes(t) for t in batch.column("text").to_pylist()]
            return record(label=batch.column("label").cast(pa.int32()), sizes=pa.array(rows, pa.list_(pa.float64())))

        return work

    rest = sample.filter("part = 1").select("label", "text")
    rows = sorted(map_slices(rest, None, "label int, sizes array<double>", setup).collect())
    y = np.array([r.label for r in rows], float)
    if not 0 < y.sum() < len(y):
        return empty
    x = np.array([list(r.sizes) for r in rows])
    center, scale = x.mean(0), x.std(0) + 1e-9
    weights = np.where(y == 1, share / y.sum(), (1 - share) / (len(y) - y.sum()))
    w = logistic(np.clip((x - center) / scale, -6, 6), y, weights)
    return Model(good, bad, center.tolist(), scale.tolist(), w.tolist(), float(share))


def scores(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, score, predicted`` of every whole text."""

    def setup():
        score = model.scorer()

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [score(t) for t in batch.column("text").to_pylist()]
            return record(doc_id=batch.column("doc_id"), score=pa.array(found, pa.float64()))

        return work

    rows = map_slices(docs.select("doc_id", "text"), None, f"doc_id {key_type(docs)}, score double", setup)
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def accepted(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs``, all columns as they are, whose text the classifier accepts.

    Scoring and choice are one step over the scan: nothing is joined or shuffled.
    """

    def setup():
        score = model.scorer()

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            keep = [score(t) >= threshold for t in batch.column("text").to_pylist()]
            return batch.filter(pa.array(keep, pa.bool_()))

        return work

    return map_slices(docs, None, docs.schema, setup)
