"""Exact token counts at every prefix of a text.

The count of a prefix is the count up to the last cut before it plus the count of the
rest, where a cut is a place that no piece of the vocabulary crosses: before a run of
spaces, and around a line break. So counts of chunks add up, each chunk is encoded by the
library once per task and remembered, and one running sum over a text holds the count of
every prefix that ends at a cut. A prefix that ends inside a chunk adds the count of that
part. Truncation and budgets are read from the sums; no text is encoded again.

Counts inside a chunk are made at the first question for them and remembered by chunk. The
tokens of a prefix less its last token are the tokens of a shorter prefix, as merges beside
a token never depend on what follows it, so the count is that prefix's plus one. The last
token is the only piece that ends there and stays apart from the token before it; the
library is asked once per pair of pieces. What is encoded again is thus such pairs only,
and time and memory grow with the length of the chunk. Models with other pieces than plain
ones and bytes have the prefixes of a chunk encoded, a bounded number of characters at once.

Defined cases: a null text counts as empty and has no tokens; very long texts are taken
whole; repeated rows count one by one; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from functools import partial

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factgraph.llm.common import map_slices, record

MODEL = "piece_bpe_32k.model"
# Chunks remembered per task; beyond, the memory is emptied and filled again.
REMEMBERED = 400_000
# Characters of prefixes encoded at once.
AT_ONCE = 1 << 20

CHUNK = re.compile(r" *[^ \n]+|\n| +")


def model_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class PrefixCounter:
    """Token counts of prefixes under one sentencepiece model."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        plain = not any("▁" in p.lstrip("▁") or "\n" in p for p in pieces)
        probe = "a  b\n c"
        self.cuts = plain and self.model.decode(self.model.encode(probe)) == probe
        self.known: dict[str, int] = {}
        self.remembered = remembered
        special = [i for i in range(len(pieces)) if self.model.is_byte(i) or self.model.is_control(i) or self.model.is_unknown(i)]
        self.plain = {p.replace("▁", " ") for p in set(pieces) - {pieces[i] for i in special}}
        self.widest = max(map(len, self.plain), default=1)
        merged = all(self.model.get_score(i) == int(self.model.get_score(i)) <= 0 for i in range(len(pieces)))
        self.by_pairs = self.cuts and merged and any(map(self.model.is_byte, special)) and not any(map(self.model.is_unused, range(len(pieces))))
        self.apart: dict[tuple[str, str], bool] = {}
        self.inside: dict[str, list[int]] = {}
        self.held = 0

    def chunks(self, text: str) -> list[str]:
        """The text with the model's leading space, cut where no piece crosses."""
        if not text:
            return []
        return CHUNK.findall(" " + text.replace("▁", " "))

    def _learn(self, chunks: list[str]) -> None:
        if len(self.known) > self.remembered:
            self.known.clear()
        missing = [c for c in dict.fromkeys(chunks) if c not in self.known]
        # The model puts a space before a text; the line break keeps it away from the chunk.
        ids = self.model.encode(["\n" + c for c in missing], num_threads=1)
        self.known.update((c, len(i) - 2) for c, i in zip(missing, ids, strict=True))

    def sums(self, text: str):
        """Token counts at every cut, the end of the text included."""
        import numpy as np

        chunks = self.chunks(text)
        known = self.known
        try:
            counts = np.fromiter(map(known.__getitem__, chunks), np.int64, len(chunks))
        except KeyError:
            self._learn(chunks)
            counts = np.fromiter(map(known.__getitem__, chunks), np.int64, len(chunks))
        return np.cumsum(counts)

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if not self.cuts:
            return len(self.model.encode(text, num_threads=1))
        return int(self.sums(text)[-1])

    def prefixes(self, text: str | None) -> list[int]:
        """Token counts of ``text[:1]``, ``text[:2]`` and so on to the whole text."""
        text = text or ""
        if not self.cuts:
            return [len(self.model.encode(text[: i + 1], num_threads=1)) for i in range(len(text))]
        counts, before = [], 0
        for chunk, total in zip(self.chunks(text), self.sums(text).tolist() if text else [], strict=True):
            counts += [before + c for c in self._inside(chunk)]
            before = total
        return counts[1:]  # the first is the model's leading space

    def _inside(self, chunk: str) -> list[int]:
        """Token counts of ``chunk[:1]``, ``chunk[:2]`` and so on, remembered by chunk."""
        if chunk not in self.inside:
            if self.held > self.remembered:
                self.inside.clear()
                self.held = 0
            self.inside[chunk] = self._by_pairs(chunk) if self.by_pairs else self._by_parts(chunk)
            self.held += len(chunk)
        return self.inside[chunk]

    def _by_parts(self, chunk: str) -> list[int]:
        counts: list[int] = []
        while len(counts) < len(chunk):
            at = len(counts)
            parts = ["\n" + chunk[: i + 1] for i in range(at, min(len(chunk), at + max(1, AT_ONCE // (at + 1)), at + 256))]
            counts += [len(i) - 2 for i in self.model.encode(parts, num_threads=1)]
        return counts

    def _by_pairs(self, chunk: str) -> list[int]:
        last, counts = [""], [0]  # by the end of a prefix: its last token, its count
        for end in range(1, len(chunk) + 1):
            for size in range(min(self.widest, end), 0, -1):
                piece = chunk[end - size : end]
                if piece in self.plain:
                    if self._apart(last[end - size], piece):
                        last.append(piece), counts.append(counts[end - size] + 1)
                        break
                elif size == 1:  # bytes, which nothing merges with
                    last.append(""), counts.append(counts[end - 1] + len(piece.encode("utf-8", "surrogatepass")))
            if len(counts) != end + 1:
                return self._by_parts(chunk)
        return counts[1:]

    def _apart(self, before: str, piece: str) -> bool:
        """Whether the library keeps two pieces as they are when one follows the other."""
        found = self.apart.get((before, piece))
        if found is None:
            if len(self.apart) > self.remembered:
                self.apart.clear()
            got = [p.replace("▁", " ") for p in self.model.encode("\n" + before + piece, out_type=str)[2:]]
            found = self.apart[(before, piece)] = got == ([before, piece] if before else [piece])
        return found

    def longest(self, text: str | None, budget: int) -> int:
        """Code points of the longest prefix with at most ``budget`` tokens."""
        return self.within(text, budget)[1]

    def within(self, text: str | None, budget: int) -> tuple[int, int]:
        """Tokens of the whole text, and code points of its longest prefix within ``budget``."""
        import numpy as np

        text = text or ""
        if not text:
            return 0, 0
        if not self.cuts:
            total = self.count(text)
            if budget <= 0 or total <= budget:
                return total, len(text) if budget > 0 else 0
            return total, max([0, *(i + 1 for i, c in enumerate(self.prefixes(text)) if c <= budget)])
        chunks, sums = self.chunks(text), self.sums(text)
        total = int(sums[-1])
        if budget <= 0 or total <= budget:
            return total, len(text) if budget > 0 else 0
        at = int(np.searchsorted(sums, budget, side="right"))
        done = sum(map(len, chunks[:at]))
        before = int(sums[at - 1]) if at else 0
        done += max([0, *(i + 1 for i, c in enumerate(self._inside(chunks[at])) if before + c <= budget)])
        return total, max(0, done - 1)


def _key_type(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()


def token_counts(docs: DataFrame, path: str | None = None, limit: int = 4096) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, limit_chars, over_limit`` of every whole text, read from its
    prefixes; ``limit_chars`` are the code points of the longest one within ``limit`` tokens."""
    path = path or model_path(MODEL)

    def setup():
        counter = PrefixCounter(path)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [counter.within(t, limit) for t in batch.column("text").to_pylist()]
            sizes = pc.binary_length(batch.column("text")).fill_null(0).cast(pa.int64())
            return record(
                doc_id=batch.column("doc_id"), n_bytes=sizes, n_tokens=pa.array([f[0] for f in found], pa.int64()),
                limit_chars=pa.array([f[1] for f in found], pa.int64()),
            )

        return work

    rows = map_slices(docs.select("doc_id", "text"), None, f"doc_id {_key_type(docs)}, n_bytes long, n_tokens long, limit_chars long", setup)
    return rows.withColumn("over_limit", F.col("n_tokens") > limit)


def prefix_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, counts``: the token count of every prefix, one entry per code point."""
    return _per_text(docs, "prefixes", pa.list_(pa.int64()), "counts array<long>", path)


def truncated(docs: DataFrame, budget: int, path: str | None = None) -> DataFrame:
    """``doc_id, text``: the longest prefix of each text within ``budget`` tokens."""
    return _per_text(docs, partial(_cut, budget=budget), pa.string(), "text string", path)


def _cut(counter: PrefixCounter, text: str | None, budget: int) -> str | None:
    return None if text is None else text[: counter.longest(text, budget)]


def _per_text(docs: DataFrame, what, kind: pa.DataType, column: str, path: str | None) -> DataFrame:
    path = path or model_path(MODEL)
    name = column.split()[0]

    def setup():
        counter = PrefixCounter(path)
        call = getattr(counter, what) if isinstance(what, str) else partial(what, counter)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            values = [call(t) for t in batch.column("text").to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values, kind)], ["doc_id", name])

        return work

    return map_slices(docs.select("doc_id", "text"), None, f"doc_id {_key_type(docs)}, {column}", setup)
