"""Byte-level BPE over a contiguous array of ranks, and back to text.

A text is cut into words as the tokenizer file says. A word is held as its parts, at first
one byte each, beside the ranks of adjacent parts. The smallest rank is found by a scan, the
boundary inside that pair goes, and the ranks of its neighbours are looked up anew, until no
adjacent parts merge. Short words take these steps together, one row each of the same
arrays; longer ones alone; and those beyond ``LONG`` bytes, where scans would cost the square
of the length, over a heap and links.

Each distinct word is encoded once per Python worker while remembered (bounded by bytes).
Texts of Latin-1 are split by the file's pattern; others are cut at white space, and each
distinct chunk is split by the library's own splitter, whose tables of letters count.

Defined cases: a null text counts as empty and has no tokens; special strings inside texts
are special tokens, or plain text with ``plain_specials``; very long texts and words are
taken whole; repeated rows are encoded one by one; an empty table gives an empty result;
columns other than ``doc_id`` and ``text`` are not read. Ids that a vocabulary lacks decode
to nothing, and bytes that are no UTF-8 to replacement marks, as in the library.
"""

from __future__ import annotations

import json
import re
import sys
from array import array
from collections.abc import Sequence
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain, filterfalse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from factgraph.llm.common import Memory, key_type, map_slices, record

MODEL = "byte_bpe_50k.json"
# Bytes of words that a worker remembers, and of chunks beyond Latin-1.
REMEMBERED, CHUNKS_REMEMBERED = 80 << 20, 16 << 20
# Bytes of text encoded at once.
SLICE_BYTES = 1 << 20
# Words of at most so many bytes are merged together; words of more than ``LONG`` over a heap.
SHORT, LONG = 24, 400
# Short words merged at once.
TOGETHER = 4096

# White space of the file's pattern, and that pattern for Latin-1.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
CHUNK = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
LATIN = re.compile("[\x00-\xff]*")
_S, _L, _N = "\t-\r \x85\xa0", "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe"
LATIN_WORD = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_alphabet() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable bytes stand
    for themselves, the others are numbered from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class RankBpe:
    """Ids of whole texts as little-endian unsigned 32-bit integers, and texts of ids."""

    def __init__(self, path: str, plain_specials: bool = False, remembered: int = REMEMBERED):
        from tokenizers import pre_tokenizers

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, added = spec["model"], spec["added_tokens"]
        split, back = spec["pre_tokenizer"] or {}, spec["decoder"] or {}
        known = (
            (model["type"], split.get("type"), back.get("type")) == ("BPE", "ByteLevel", "ByteLevel")
            and split["use_regex"] and not split["add_prefix_space"] and spec["normalizer"] is None
            and not any(model.get(x) for x in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added)
        )
        if not known:
            raise ValueError(f"{path}: not a plain byte-level BPE file")
        self.splitter = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        alphabet = byte_alphabet()
        own = {token: bytes(map(alphabet.__getitem__, token)) for token in model["vocab"]}
        self.ids = {own[token]: i for token, i in model["vocab"].items()}
        self.ranks: dict[bytes, int] = {}
        self.cut: list[int] = []  # by rank: bytes of the left part
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            if self.ranks.setdefault(own[left] + own[right], rank) != rank:
                raise ValueError(f"{path}: two merges make one token")
            self.cut.append(len(own[left]))
        self.never = len(self.cut)
        self.cut.append(-1)
        self.specials = {t["content"]: t["id"] for t in added}
        longest_first = sorted(self.specials, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if added and not plain_specials else None
        self.bytes = [b""] * (max([*self.ids.values(), *self.specials.values()], default=-1) + 1)
        for token, i in [*self.ids.items(), *((t.encode(), i) for t, i in self.specials.items())]:
            self.bytes[i] = token
        self.words, self.chunks = Memory(remembered), Memory(min(remembered, CHUNKS_REMEMBERED))
        # The same ranks by the ids of both parts, for many words at once.
        one = np.array([self.ids.get(bytes([b]), -1) for b in range(256)], np.int64)
        self.one, self.width = one, len(self.bytes)
        pairs = [(self.ids[t[: self.cut[r]]] * self.width + self.ids[t[self.cut[r] :]], r, self.ids[t]) for t, r in self.ranks.items()]
        found = np.array(sorted(pairs) or [(-1, self.never, -1)], np.int64)
        self.pairs, self.pair_ranks = found[:, 0].copy(), found[:, 1].astype(np.int32)
        self.made = np.full(self.never + 1, -1, np.int64)
        self.made[found[:, 1]] = found[:, 2]

    def encode(self, text: str | None) -> bytes:
        return self.encode_all([text])[0]

    def encode_all(self, texts: Sequence[str | None]) -> list[bytes]:
        """The ids of each text; words that no text had before are merged together."""
        plans = [self._parts(t) for t in texts]
        known = self.words.make_room()
        every = chain.from_iterable(words for plan in plans for words in plan if isinstance(words, list))
        missing = set(filterfalse(known.__contains__, every))
        self._learn([w for w in missing if self.words.recall(w) is None])
        get = known.__getitem__
        out = [b"".join([p if isinstance(p, bytes) else b"".join(map(get, p)) for p in plan]) for plan in plans]
        self.words.forget_long()
        return out

    def _parts(self, text: str | None) -> list[list[str] | bytes]:
        """Words of a text, and the ids of special strings between them."""
        if not text:
            return []
        if self.special is None or not any(s in text for s in self.specials):
            return [self._split(text)]
        parts = self.special.split(text)
        return [self._packed([self.specials[p]]) if i % 2 else self._split(p) for i, p in enumerate(parts)]

    def _split(self, text: str) -> list[str]:
        if text.isascii() or LATIN.fullmatch(text):
            return LATIN_WORD.findall(text)
        chunks = CHUNK.findall(text)
        known = self.chunks.make_room()
        for chunk in set(chunks).difference(known):
            if self.chunks.recall(chunk) is None:
                words = LATIN_WORD.findall(chunk) if chunk.isascii() else [chunk[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(chunk)]
                self.chunks.keep(chunk, words, 2 * len(chunk))
        found = [w for c in chunks for w in known[c]]
        self.chunks.forget_long()
        return found

    def _learn(self, words: list[str]) -> None:
        short: list[tuple[str, bytes]] = []
        for word in words:
            raw = word.encode("utf-8", "surrogatepass")
            if len(raw) <= SHORT:
                short.append((word, raw))
                continue
            bounds = self._scanned(raw) if len(raw) <= LONG else self._heaped(raw)
            ids = self._packed([self.ids[raw[a:b]] for a, b in zip(bounds, bounds[1:], strict=False)])
            self.words.keep(word, ids, len(ids))
        short.sort(key=lambda w: len(w[1]))
        for at in range(0, len(short), TOGETHER):
            some = short[at : at + TOGETHER]
            self.words.keep_all([word for word, _ in some], self._scanned_together([raw for _, raw in some]))

    def _ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where((self.pairs[at] == key) & (right >= 0), self.pair_ranks[at], self.never)

    def _scanned_together(self, raws: list[bytes]) -> list[bytes]:
        """As ``_scanned``, a row per word: its parts (-1 behind the last) and their ranks."""
        sizes = np.fromiter(map(len, raws), np.int64, len(raws))
        width = int(sizes.max())
        letters = np.frombuffer(b"".join([r.ljust(width, b"\0") for r in raws]), np.uint8).reshape(len(raws), width)
        parts = np.where(np.arange(width) < sizes[:, None], self.one[letters], -1)
        parts = np.concatenate([parts, np.full((len(raws), 1), -1)], axis=1)
        ranks = self._ranks_of(parts[:, :-1], parts[:, 1:])
        out: list[bytes] = [b""] * len(raws)
        rows, columns = np.arange(len(raws)), np.arange(width)
        while len(rows):
            each = np.arange(len(rows))
            at = ranks.argmin(axis=1)
            least = ranks[each, at]
            done = np.flatnonzero(least == self.never)
            if len(done):
                counts = (parts[done] >= 0).sum(axis=1)
                flat = parts[done].astype("<u4")
                for row, ids, n in zip(rows[done].tolist(), flat, counts.tolist(), strict=True):
                    out[row] = ids[:n].tobytes()
                go = np.flatnonzero(least != self.never)
                rows, parts, ranks, at, least = rows[go], parts[go], ranks[go], at[go], least[go]
                each = np.arange(len(rows))
                if not len(rows):
                    break
            # Delete the boundary inside the pair: all behind it moves up by one.
            behind = columns >= at[:, None]
            ranks = np.where(behind, np.concatenate([ranks[:, 1:], np.full((len(rows), 1), self.never, ranks.dtype)], axis=1), ranks)
            parts[:, 1:width] = np.where(behind[:, : width - 1], parts[:, 2:], parts[:, 1:width])
            parts[each, at] = self.made[least]
            ranks[each, at] = self._ranks_of(parts[each, at], parts[each, at + 1])
            first = np.maximum(at - 1, 0)
            ranks[each, first] = np.where(at > 0, self._ranks_of(parts[each, first], parts[each, at]), ranks[each, first])
        return out

    def _rank(self, raw: bytes, a: int, b: int, c: int) -> int:
        """Rank of the merge of ``raw[a:b]`` and ``raw[b:c]``."""
        rank = self.ranks.get(raw[a:c], self.never)
        return rank if self.cut[rank] == b - a else self.never

    def _scanned(self, raw: bytes) -> list[int]:
        never, cut, get = self.never, self.cut, self.ranks.get
        bounds = list(range(len(raw) + 1))
        ranks = [get(raw[i : i + 2], never) for i in bounds[:-2]]
        while ranks:
            least = min(ranks)
            if least == never:
                break
            at = ranks.index(least)
            del ranks[at], bounds[at + 1]
            # The ranks beside the new part, as ``_rank`` finds them.
            if at < len(ranks):
                a, b, c = bounds[at : at + 3]
                rank = get(raw[a:c], never)
                ranks[at] = rank if cut[rank] == b - a else never
            if at:
                a, b, c = bounds[at - 1 : at + 2]
                rank = get(raw[a:c], never)
                ranks[at - 1] = rank if cut[rank] == b - a else never
        return bounds

    def _heaped(self, raw: bytes) -> list[int]:
        n, never = len(raw), self.never
        after, before = list(range(1, n + 2)), list(range(-1, n))
        ranks = [self.ranks.get(raw[i : i + 2], never) for i in range(n - 1)] + [never, never]
        heap = [(r, i) for i, r in enumerate(ranks) if r < never]
        heapify(heap)

        def refresh(i: int) -> None:
            b = after[i]
            ranks[i] = self._rank(raw, i, b, after[b]) if b < n else never
            if ranks[i] < never:
                heappush(heap, (ranks[i], i))

        while heap:
            rank, i = heappop(heap)
            if ranks[i] != rank:
                continue
            gone = after[i]
            ranks[gone] = never
            after[i] = after[gone]
            before[after[gone]] = i
            refresh(i)
            if before[i] >= 0:
                refresh(before[i])
        bounds = [0]
        while bounds[-1] < n:
            bounds.append(after[bounds[-1]])
        return bounds

    @staticmethod
    def _packed(ids: list[int]) -> bytes:
        found = array("I", ids)
        if sys.byteorder == "big":
            found.byteswap()
        return found.tobytes()

    def spelled(self, ids: list[int]) -> bytes:
        """The bytes that ids stand for."""
        try:
            return b"".join(map(self.bytes.__getitem__, ids))
        except IndexError:
            return b"".join(self.bytes[i] for i in ids if i < len(self.bytes))

    def decode(self, ids: list[int]) -> str:
        return self.spelled(ids).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def coder_of(path: str, plain_specials: bool = False) -> RankBpe:
    """One per Python worker, which Spark keeps for later tasks, with what it remembers."""
    return RankBpe(path, plain_specials)


def round_trip(docs: DataFrame, path: str | None = None, plain_specials: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded`` of every whole text; ``ids`` are little-endian
    unsigned 32-bit integers, ``decoded`` is read from them."""
    path = path or model_path()

    def setup():
        coder = coder_of(path, plain_specials)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids = coder.encode_all(batch.column("text").to_pylist())
            return record(
                doc_id=batch.column("doc_id"),
                n_tokens=pa.array([len(i) // 4 for i in ids], pa.int64()),
                ids=pa.array(ids, pa.binary()),
                decoded=pa.array([coder.decode(np.frombuffer(i, "<u4").tolist()) for i in ids], pa.string()),
            )

        return work

    return map_slices(docs.select("doc_id", "text"), None, f"doc_id {key_type(docs)}, n_tokens long, ids binary, decoded string", setup, SLICE_BYTES)


def encoded(docs: DataFrame, path: str | None = None, plain_specials: bool = False) -> DataFrame:
    """``doc_id, ids``: the ids of every whole text as a list."""
    path = path or model_path()

    def setup():
        coder = coder_of(path, plain_specials)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids = [np.frombuffer(i, "<u4").astype(np.int64) for i in coder.encode_all(batch.column("text").to_pylist())]
            return record(doc_id=batch.column("doc_id"), ids=pa.array(ids, pa.list_(pa.int64())))

        return work

    return map_slices(docs.select("doc_id", "text"), None, f"doc_id {key_type(docs)}, ids array<long>", setup, SLICE_BYTES)


def decoded(rows: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, text`` of rows with ``doc_id`` and ``ids`` (a list); null ids give a null text."""
    path = path or model_path()

    def setup():
        coder = coder_of(path)

        def work(batches):
            for batch in batches:
                texts = [None if i is None else coder.decode([x for x in i if x is not None and x >= 0]) for i in batch.column("ids").to_pylist()]
                yield record(doc_id=batch.column("doc_id"), text=pa.array(texts, pa.string()))

        return work

    def run(batches):
        yield from setup()(batches)

    return rows.select("doc_id", "ids").mapInArrow(run, f"doc_id {key_type(rows)}, text string")
