"""Language of a text by a small convolutional network over its bytes.

Bytes are embedded, filters of several widths run over fixed-length windows, the largest
answer of each filter in a window goes to a softmax over the learned languages. A whole
text is cut into windows; their log probabilities, weighted by the bytes they hold, are
averaged. The network is trained in numpy on a bounded sample: at most
``SAMPLE_PER_LANGUAGE`` documents per language, ``WINDOWS`` windows of each. Every language
of the table is learnt, however rare; beyond ``MANY_LANGUAGES`` the documents per language
grow fewer, down to one, and the training steps more in proportion.

Defined cases: a null text, an empty one and one without a letter are ``und`` with score
0; so is every text when nothing can be learnt; rows with null text or language teach
nothing; repeated rows are judged one by one; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factgraph.llm.common import key_type, map_slices, record, sample_ids, text_windows

SAMPLE_PER_LANGUAGE, MANY_LANGUAGES, WINDOWS = 800, 256, 3
WIDTHS, FILTERS, EMBED = (2, 3, 4), 12, 6
LENGTH, STEPS, BATCH, RATE = 256, 900, 48, 0.01
UNKNOWN = "und"


@dataclass
class Network:
    languages: list[str]
    embed: np.ndarray  # 256 x EMBED; byte 0 pads
    filters: np.ndarray  # (widest * EMBED) x (widths * FILTERS), zero beyond a filter's width
    shift: np.ndarray
    out: np.ndarray
    bias: np.ndarray

    def columns(self, windows: np.ndarray) -> np.ndarray:
        """Every place's embedded bytes as one row: (windows * LENGTH) x (widest * EMBED)."""
        wide = max(WIDTHS)
        padded = np.zeros((len(windows), LENGTH + wide - 1), np.uint8)
        padded[:, :LENGTH] = windows
        cells = self.embed[padded]
        a, b, c = cells.strides
        view = np.lib.stride_tricks.as_strided(cells, (len(windows), LENGTH, wide * EMBED), (a, b, c))
        return view.reshape(-1, wide * EMBED)

    def log_odds(self, windows: np.ndarray) -> np.ndarray:
        """Log probabilities of windows, a small batch of them at a time."""
        found = []
        for at in range(0, len(windows), 64):
            part = windows[at : at + 64]
            answers = (self.columns(part) @ self.filters).reshape(len(part), LENGTH, -1).max(1)
            z = np.maximum(answers + self.shift, 0) @ self.out + self.bias
            z = z - z.max(1, keepdims=True)
            found.append(z - np.log(np.exp(z).sum(1, keepdims=True)))
        return np.concatenate(found)


def _mask() -> np.ndarray:
    wide = max(WIDTHS)
    columns = [np.repeat(np.r_[np.ones(w), np.zeros(wide - w)], EMBED)[:, None].repeat(FILTERS, 1) for w in WIDTHS]
    return np.concatenate(columns, 1).astype(np.float32)


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], seed: int = 1) -> Network:
    """Minimise the cross entropy with Adam; the gradient of a maximum goes to its place."""
    rng = np.random.default_rng(seed)
    mask = _mask()
    n = len(WIDTHS) * FILTERS
    net = Network(
        languages,
        rng.normal(0, 0.5, (256, EMBED)).astype(np.float32),
        (rng.normal(0, 0.4, mask.shape) * mask).astype(np.float32),
        np.zeros(n, np.float32),
        rng.normal(0, 0.2, (n, len(languages))).astype(np.float32),
        np.zeros(len(languages), np.float32),
    )
    names = ("embed", "filters", "shift", "out", "bias")
    first = {k: np.zeros_like(getattr(net, k)) for k in names}
    second = {k: np.zeros_like(getattr(net, k)) for k in names}
    wide = max(WIDTHS)
    steps = STEPS * max(len(languages), MANY_LANGUAGES) // MANY_LANGUAGES
    for step in range(1, steps + 1):
        pick = rng.integers(0, len(windows), BATCH)
        x, y = windows[pick], labels[pick]
        cells = net.columns(x)
        answers = (cells @ net.filters).reshape(BATCH, LENGTH, n)
        place = answers.argmax(1)
        top = np.take_along_axis(answers, place[:, None], 1)[:, 0] + net.shift
        hidden = np.maximum(top, 0)
        z = hidden @ net.out + net.bias
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[np.arange(BATCH), y] -= 1
        p /= BATCH
        back = (p @ net.out.T) * (top > 0)
        rows = (np.arange(BATCH)[:, None] * LENGTH + place).ravel()
        spot, of = cells[rows].reshape(BATCH, n, -1), back[:, :, None]
        grad = {
            "out": hidden.T @ p,
            "bias": p.sum(0),
            "shift": back.sum(0),
            "filters": (spot * of).sum(0).T * mask,
        }
        to_cells = (of * net.filters.T[None]).reshape(BATCH, n, wide, EMBED)
        padded = np.zeros((BATCH, LENGTH + wide - 1), np.uint8)
        padded[:, :LENGTH] = x
        used = padded[np.arange(BATCH)[:, None, None], place[:, :, None] + np.arange(wide)]
        grad["embed"] = np.zeros_like(net.embed)
        np.add.at(grad["embed"], used.ravel(), to_cells.reshape(-1, EMBED))
        for k in names:
            g = grad[k].astype(np.float32)
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            move = RATE * (1 - step / steps) * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
            setattr(net, k, (getattr(net, k) - move).astype(np.float32))
        net.filters *= mask
    return net


def cut(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """All fixed-length windows of a text's bytes, the last one padded, and the bytes each holds."""
    n = max(1, -(-len(data) // LENGTH))
    cells = np.zeros(n * LENGTH, np.uint8)
    cells[: len(data)] = np.frombuffer(data, np.uint8)
    held = np.full(n, LENGTH)
    held[-1] = len(data) - LENGTH * (n - 1)
    return cells.reshape(n, LENGTH), held


def fit(docs: DataFrame, learn: Column, language: str = "lang") -> Network | None:
    """Learn every language from a bounded sample of rows that ``learn`` allows."""
    known = docs.filter(learn & F.col(language).isNotNull() & (F.length("text") > 0)).select("doc_id", F.col(language).alias("lang"))
    n = known.select("lang").distinct().count()
    if not n:
        return None
    each = max(1, SAMPLE_PER_LANGUAGE * MANY_LANGUAGES // max(n, MANY_LANGUAGES))
    ids = sample_ids(known, "lang", each).distinct()
    texts = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    rows = sorted((r.lang, r.text) for r in text_windows(texts, ["lang"], WINDOWS, LENGTH).collect())
    languages = sorted({r[0] for r in rows})
    windows = np.concatenate([cut(t.encode("utf-8", "surrogatepass")[:LENGTH])[0] for _, t in rows])
    place = {v: i for i, v in enumerate(languages)}
    return train(windows, np.array([place[v] for v, _ in rows]), languages)


def languages(docs: DataFrame, network: Network | None) -> DataFrame:
    """``doc_id, lang_pred, score`` of every whole text."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text").to_pylist()
        names, found = [UNKNOWN] * len(texts), [0.0] * len(texts)
        at = [i for i, t in enumerate(texts) if t and network and any(map(str.isalpha, t))]
        if at:
            parts = [cut(texts[i].encode("utf-8", "surrogatepass")) for i in at]
            odds = network.log_odds(np.concatenate([p[0] for p in parts]))
            held = np.concatenate([p[1] for p in parts]).astype(np.float64)
            starts = np.cumsum([0, *(len(p[1]) for p in parts)])[:-1]
            mean = np.add.reduceat(odds * held[:, None], starts) / np.add.reduceat(held, starts)[:, None]
            p = np.exp(mean - mean.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            for i, k, row in zip(at, p.argmax(1), p, strict=True):
                names[i], found[i] = network.languages[k], float(row[k])
        return record(doc_id=batch.column("doc_id"), lang_pred=pa.array(names, pa.string()), score=pa.array(found, pa.float64()))

    return map_slices(docs.select("doc_id", "text"), work, f"doc_id {key_type(docs)}, lang_pred string, score double")
