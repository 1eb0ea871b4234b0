"""Tokens of two tokenizers over the same bytes: overlaps, groups, links and their counts.

Side A is a byte-level BPE file over a space and the text, side B a sentencepiece model over
the text, before which it puts the space itself. Both spell the same bytes. A text is cut
where no token of either side crosses, and each distinct run between such cuts is encoded
once for both. Per Arrow slice, ``pandas.merge_asof`` finds for each token start the token of
the other side that covers it, its key the byte in the slice, which names the document too;
both directions together are all overlapping pairs. Places where a token of either side ends
cut both sequences into groups, and pairs that end together are links.

Counts of id pairs cover the corpus. Links are counted within a slice first, so a pair costs
one row per slice, however often it occurs: these rows are summed by pair, joined back by
pair (AQE splits common pairs), and gathered by slice, whose size is bounded. Then each slice
reads the counts of its own links. The slices are staged in between; texts are encoded once.

Defined cases: a text that is null, empty, or that either side spells differently has no
tokens and no links; special strings inside texts are plain text; very long texts are taken
whole; repeated rows count one by one; rows without ``doc_id`` are aligned alike; an empty
table gives an empty result; columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import hashlib
import re
import sys
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, filterfalse

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factgraph.llm.common import Memory, frugal, key_type, map_slices, record, slices, staged
from factgraph.llm.rank_bpe import LATIN, SPACE, RankBpe, model_path

MODEL_A, MODEL_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
# Bytes of runs that a worker remembers for both sides, of words on side A, of chunks on side B.
REMEMBERED, WORDS_REMEMBERED, CHUNKS_REMEMBERED = 80 << 20, 24 << 20, 16 << 20
# Bytes of text aligned at once.
SLICE_BYTES = 512 << 10
# Runs that no piece of the model crosses: its pieces hold a space at their start only.
CHUNK = re.compile(r" *[^ \n]+|\n| +")
# Runs that no token of either side crosses: side A joins a space to what follows, and white
# space to white space, but nothing to the white space behind it.
RUN = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
# Behind white space that is not in ``CUT`` there is no cut for side A.
WHITE, CUT = frozenset(re.findall(f"[{SPACE}]", "".join(map(chr, range(0x3001))))), frozenset(" \n")
# Set in the ids of side B where both sides stand together.
SIDE_B = 1 << 31
BYTE = re.compile(r"<0x([0-9A-F]{2})>")


class PieceIds:
    """Ids of whole texts under one sentencepiece model, each distinct chunk encoded once."""

    def __init__(self, path: str, remembered: int = CHUNKS_REMEMBERED):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        self.bytes = [
            bytes([int(BYTE.fullmatch(p)[1], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        probe = "a  b\n c"
        self.cuts = not any("▁" in p.lstrip("▁") or "\n" in p for p in pieces) and self.model.decode(self.model.encode(probe)) == probe
        self.chunks = Memory(remembered)

    def encode_all(self, texts: list[str]) -> list[bytes | None]:
        """Ids of each text as little-endian unsigned 32-bit integers; None if they spell
        something else than a space and the text."""
        if not self.cuts:
            found = self.model.encode(texts, num_threads=1)
            return [self.packed(i) if self.spelled(i) == (" " + t).encode("utf-8", "surrogatepass") else None for t, i in zip(texts, found, strict=True)]
        lists = [CHUNK.findall(" " + t) for t in texts]
        known = self.chunks.make_room()
        new = set(filterfalse(known.__contains__, chain.from_iterable(lists)))
        missing = [c for c in new if self.chunks.recall(c) is None]
        odd = set()
        # The model puts a space before a text; the line break keeps it away from the chunk.
        for chunk, ids in zip(missing, self.model.encode(["\n" + c for c in missing], num_threads=1), strict=True):
            packed = self.packed(ids[2:])
            self.chunks.keep(chunk, packed, len(packed))
            if self.spelled(ids[2:]) != chunk.encode("utf-8", "surrogatepass"):
                odd.add(chunk)
        get = known.__getitem__
        out = [None if odd and not odd.isdisjoint(chunks) else b"".join(map(get, chunks)) for chunks in lists]
        for chunk in odd:  # found odd again when it comes again
            known.pop(chunk, None)
        self.chunks.forget_long()
        return out

    @staticmethod
    def packed(ids: list[int]) -> bytes:
        return array("I", ids).tobytes() if sys.byteorder == "little" else np.array(ids, "<u4").tobytes()

    def spelled(self, ids: list[int]) -> bytes:
        return b"".join([self.bytes[i] for i in ids])


class Sides:
    """Both tokenizers, and the tokens of a slice of texts as one table per side."""

    def __init__(self, path_a: str, path_b: str, remembered: int = REMEMBERED):
        self.a, self.b = RankBpe(path_a, plain_specials=True, remembered=WORDS_REMEMBERED), PieceIds(path_b)
        self.size_a, self.size_b = (np.array([len(t) for t in side.bytes], np.int64) for side in (self.a, self.b))
        self.runs = Memory(remembered)
        # Decimal digits of every id, zeros before them.
        ids = np.arange(max(len(self.size_a), len(self.size_b)))
        places = 10 ** np.arange(len(str(len(ids))))[::-1]
        self.digits = np.where((ids[:, None] >= places) | (places == 1), 48 + ids[:, None] // places % 10, 0).astype(np.uint8)

    def _ids(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers, those of side B marked;
        each side's are in order. None of a text that either side spells differently."""
        if not self.b.cuts:
            return self._whole(texts)
        lists = [RUN.findall(" " + t) if t else [] for t in texts]
        runs = list(chain.from_iterable(lists))
        known = self.runs.make_room()
        found = list(map(known.get, runs))
        missing = [i for i, ids in enumerate(found) if ids is None]
        if missing:
            self._learn(self.runs.recall_all({runs[i] for i in missing}))
            for i in missing:
                found[i] = known[runs[i]]
            self.runs.forget_long()
        ends = np.cumsum([len(x) for x in lists]).tolist()
        own = [found[s:e] for s, e in zip([0, *ends], ends, strict=False)]
        out = [b"".join(x) for x in own]
        alone = [i for i, x in enumerate(own) if not all(x)]
        for i, ids in zip(alone, self._whole([texts[i] for i in alone]), strict=True):
            out[i] = ids
        return out

    def _learn(self, runs: list[str]) -> None:
        """Remember the ids of runs; nothing for a run whose texts are to be encoded whole."""
        joined, alone = [], []
        for r in runs:
            (joined if r[-1] not in WHITE and (r.isascii() or LATIN.fullmatch(r)) else alone).append(r)
        runs = joined + alone
        raws = [r.encode("utf-8", "surrogatepass") for r in runs]
        ends = np.cumsum([len(r) for r in raws])
        # A run begins with a space or a line break, so behind another it stays what it is.
        ids_a = np.frombuffer(b"".join(self.a.encode_all(["".join(joined), *alone])), "<u4")
        n_a = np.diff(np.searchsorted(np.cumsum(self.size_a[ids_a]), ends, side="right"), prepend=0)
        # The model puts a space before a text; the line break keeps it away from the run.
        found_b = self.b.model.encode(["\n" + r for r in runs], num_threads=1)
        n_b = np.fromiter(map(len, found_b), np.int64, len(runs))
        ids_b = np.fromiter(chain.from_iterable(found_b), np.int64, int(n_b.sum()))
        first = np.cumsum(n_b) - n_b
        ids_b, n_b = np.delete(ids_b, np.concatenate([first, first + 1])), n_b - 2
        # Both sides of a run one after the other.
        n = n_a + n_b
        both = np.empty(int(n.sum()), "<u4")
        both[np.arange(len(ids_a)) + np.repeat(np.cumsum(n_b) - n_b, n_a)] = ids_a
        both[np.arange(len(ids_b)) + np.repeat(np.cumsum(n_a), n_b)] = ids_b | SIDE_B
        cuts, whole = np.cumsum(4 * n).tolist(), both.tobytes()
        ids = [whole[s:e] for s, e in zip([0, *cuts], cuts, strict=False)]
        spelled = b"".join(map(self.b.bytes.__getitem__, ids_b.tolist()))
        ends_b = np.concatenate([[0], np.cumsum(self.size_b[ids_b])])[np.cumsum(n_b)]
        if spelled != b"".join(raws) or (ends_b != ends).any():
            cuts = ends_b.tolist()
            ids = [i if spelled[s:e] == r else b"" for i, s, e, r in zip(ids, [0, *cuts], cuts, raws, strict=False)]
        for i in range(len(joined), len(runs)):
            if runs[i][-1] in WHITE - CUT:
                ids[i] = b""
        self.runs.keep_all(runs, ids)

    @staticmethod
    def _marked(ids: list[int]) -> bytes:
        return PieceIds.packed([i | SIDE_B for i in ids])

    def _whole(self, texts: list[str | None]) -> list[bytes]:
        filled = [t or "" for t in texts]
        found_b = self.b.encode_all(filled)
        # The words of side A are cut out of the text's bytes and so spell it.
        found_a = self.a.encode_all([" " + t if t and b is not None else None for t, b in zip(filled, found_b, strict=True)])
        return [a + self._marked(np.frombuffer(b, "<u4").tolist()) if t and b is not None else b"" for t, a, b in zip(filled, found_a, found_b, strict=True)]

    def tokens(self, texts: list[str | None]) -> tuple[pd.DataFrame, pd.DataFrame]:
        """``doc, id, start, end`` per token; ``doc`` is the place in the slice, and bytes are
        counted over the whole slice, so that starts ascend."""
        found = self._ids(texts)
        ids = np.frombuffer(b"".join(found), "<u4")
        doc = np.repeat(np.arange(len(texts)), [len(f) // 4 for f in found])
        frames = []
        for own, sizes in ((np.flatnonzero(ids < SIDE_B), self.size_a), (np.flatnonzero(ids >= SIDE_B), self.size_b)):
            of_side = (ids[own] & (SIDE_B - 1)).astype(np.int64)
            size = sizes[of_side]
            end = np.cumsum(size)
            frames.append(pd.DataFrame({"doc": doc[own], "id": of_side, "start": end - size, "end": end}))
        return frames[0], frames[1]


@lru_cache(maxsize=1)
def sides_of(path_a: str, path_b: str) -> Sides:
    """One per Python worker, which Spark keeps for later tasks, with what it remembers."""
    return Sides(path_a, path_b)


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
    """``doc, a, b``: rows of ``a`` and ``b`` whose byte ranges overlap, in order.

    Of an overlapping pair, one token covers the start of the other; a pair that starts
    together is found from both sides and kept once. Both sides spell the same bytes of a
    document, so the token that covers a start stands in the same document.
    """
    starts_a, starts_b = a["start"].to_numpy(), b["start"].to_numpy()
    from_a = pd.merge_asof(a[["start"]], pd.DataFrame({"start": starts_b, "b": np.arange(len(b))}), on="start")["b"].to_numpy(np.int64)
    from_b = pd.merge_asof(b[["start"]], pd.DataFrame({"start": starts_a, "a": np.arange(len(a))}), on="start")["a"].to_numpy(np.int64)
    new = np.flatnonzero(starts_b != starts_a[from_b])
    # Both parts are in order already: a new pair stands behind those that start before it.
    at = from_b[new] + 1 + np.arange(len(new))
    in_a, in_b = np.empty(len(a) + len(new), np.int64), np.empty(len(a) + len(new), np.int64)
    old = np.ones(len(in_a), bool)
    old[at] = False
    in_a[at], in_b[at] = from_b[new], new
    in_a[old], in_b[old] = np.arange(len(a)), from_a
    return pd.DataFrame({"doc": a["doc"].to_numpy()[in_a], "a": in_a, "b": in_b})


class Aligned:
    """A slice of texts aligned: tokens, overlaps, links (pairs that end together)."""

    def __init__(self, sides: Sides, texts: list[str | None]):
        self.n, self.digits = len(texts), sides.digits
        self.a, self.b = sides.tokens(texts)
        self.pairs = overlaps(self.a, self.b)
        a, b = self.pairs["a"].to_numpy(), self.pairs["b"].to_numpy()
        together = self.a["end"].to_numpy()[a] == self.b["end"].to_numpy()[b]
        self.links = self.pairs[together]
        self.link_a, self.link_b = a[together], b[together]

    def counts(self, doc) -> np.ndarray:
        return np.bincount(doc, minlength=self.n)

    def keys(self) -> np.ndarray:
        """One number per link for its pair of ids."""
        return self.a["id"].to_numpy()[self.link_a] << 32 | self.b["id"].to_numpy()[self.link_b]

    def spelled_groups(self) -> list[bytes]:
        """Per text ``a1,a2|b1;a3|b2``: the ids of each group."""
        n_a, n_b = len(self.a), len(self.b)
        if not n_a:
            return [b""] * self.n
        # A group ends with a link; its tokens of A come first, then those of B.
        ends_a, ends_b = np.zeros(n_a, np.int64), np.zeros(n_b, np.int64)
        ends_a[self.link_a], ends_b[self.link_b] = 1, 1
        at_a = np.arange(n_a) + np.concatenate([[0], self.link_b + 1])[np.cumsum(ends_a) - ends_a]
        at_b = np.arange(n_b) + (self.link_a + 1)[np.cumsum(ends_b) - ends_b]
        ids, marks = np.empty(n_a + n_b, np.int64), np.full(n_a + n_b, ord(","), np.uint8)
        ids[at_a], ids[at_b] = self.a["id"].to_numpy(), self.b["id"].to_numpy()
        marks[at_a[self.link_a]], marks[at_b[self.link_b]] = ord("|"), ord(";")
        # Decimal digits and the mark behind them; the zeros before them go.
        spelled = np.concatenate([self.digits[ids], marks[:, None]], axis=1)
        last = np.cumsum(self.counts(self.a["doc"]) + self.counts(self.b["doc"])).tolist()
        return [spelled[s:e].tobytes().translate(None, b"\0")[:-1] for s, e in zip([0, *last], last, strict=False)]


def alignments(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """``doc_id, a, b, overlaps, groups`` of every text.

    ``a`` and ``b`` are ids; ``overlaps`` pairs places in both, and ``groups`` holds the
    places in both after which each group ends.
    """
    path_a, path_b = path_a or model_path(MODEL_A), path_b or model_path(MODEL_B)
    pairs = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))

    def setup():
        sides = sides_of(path_a, path_b)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = Aligned(sides, batch.column("text").to_pylist())
            offsets = {c: np.concatenate([[0], np.cumsum(found.counts(f["doc"]))]) for c, f in (("a", found.a), ("b", found.b), ("p", found.pairs), ("l", found.links))}
            ids = {c: pa.ListArray.from_arrays(pa.array(offsets[c], pa.int32()), pa.array(f["id"], pa.int64())) for c, f in (("a", found.a), ("b", found.b))}

            def places(rows: pd.DataFrame, of: str, more: int) -> pa.Array:
                values = [pa.array(rows[c].to_numpy() - offsets[c][rows["doc"]] + more, pa.int64()) for c in "ab"]
                return pa.ListArray.from_arrays(pa.array(offsets[of], pa.int32()), pa.StructArray.from_arrays(values, ["a", "b"])).cast(pairs)

            return record(doc_id=batch.column("doc_id"), **ids, overlaps=places(found.pairs, "p", 0), groups=places(found.links, "l", 1))

        return work

    pair = "array<struct<a:long,b:long>>"
    return map_slices(docs.select("doc_id", "text"), None, f"doc_id {key_type(docs)}, a array<long>, b array<long>, overlaps {pair}, groups {pair}", setup, SLICE_BYTES)


def _blocks(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per slice: its documents, its distinct pairs with their counts, and its links
    as places among these pairs."""
    key = key_type(docs)
    schema = (
        f"block string, doc_ids array<{key}>, n_a array<long>, n_b array<long>, n_links array<long>, "
        "groups_sha256 array<string>, pairs array<long>, counts array<long>, links binary"
    )

    longs = pa.list_(pa.int64())

    def block(sides: Sides, rows: pa.RecordBatch, name: str) -> pa.RecordBatch:
        found = Aligned(sides, rows.column("text").to_pylist())
        pairs, links, counts = np.unique(found.keys(), return_inverse=True, return_counts=True)
        return record(
            block=pa.array([name]),
            doc_ids=pa.ListArray.from_arrays(pa.array([0, rows.num_rows], pa.int32()), rows.column("doc_id")),
            n_a=pa.array([found.counts(found.a["doc"])], longs),
            n_b=pa.array([found.counts(found.b["doc"])], longs),
            n_links=pa.array([found.counts(found.links["doc"])], longs),
            groups_sha256=pa.array([[hashlib.sha256(g).hexdigest() if g else "" for g in found.spelled_groups()]], pa.list_(pa.string())),
            pairs=pa.array([pairs], longs),
            counts=pa.array([counts], longs),
            # Two bytes per link where the slice has few pairs, else four.
            links=pa.array([links.astype("<u2" if len(pairs) <= 1 << 16 else "<u4").tobytes()], pa.binary()),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        sides, part, number = sides_of(path_a, path_b), TaskContext.get().partitionId(), 0
        for batch in batches:
            for rows in slices(batch, limit=SLICE_BYTES):
                yield block(sides, rows, f"{part}-{number}")
                number += 1

    return docs.select("doc_id", "text").mapInArrow(frugal(run), schema)


def pair_counts(blocks: DataFrame, ids_b: int) -> DataFrame:
    """``pair, n, best``: links of each pair of ids over all slices, and whether no pair with
    the same B id has more. The broadcast side holds a row per B id, at most ``ids_b``."""
    one = blocks.select(F.explode(F.arrays_zip("pairs", "counts")).alias("p"))
    sums = staged(one.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.counts").alias("n")))
    b = F.col("pair").bitwiseAND((1 << 32) - 1)
    most = sums.groupBy(b.alias("b")).agg(F.max("n").alias("most"))
    # A vocabulary bounds the rows of ``most``.
    most = F.broadcast(most) if ids_b <= 1 << 20 else most
    return sums.join(most, b == most["b"]).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def link_report(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` per document."""
    import sentencepiece

    path_a, path_b = path_a or model_path(MODEL_A), path_b or model_path(MODEL_B)
    blocks = staged(_blocks(docs, path_a, path_b))
    known = pair_counts(blocks, sentencepiece.SentencePieceProcessor(model_file=path_b).vocab_size())
    wanted = blocks.select("block", F.explode("pairs").alias("pair"))
    found = (
        wanted.join(known, "pair")
        .groupBy("block")
        # The distinct pairs of one slice, as many as its tokens at most.
        .agg(F.collect_list(F.struct("pair", "n", "best")).alias("found"))
        .select("block", F.transform("found", lambda f: f["pair"]).alias("pair"), F.transform("found", lambda f: f["n"]).alias("n"), F.transform("found", lambda f: f["best"]).alias("best"))
    )
    rows = blocks.drop("pairs", "counts").join(found, "block", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                values = {c: batch.column(c)[i] for c in batch.schema.names}
                n_links = values["n_links"].values.to_numpy()
                best, total = np.zeros(len(n_links), np.int64), np.zeros(len(n_links), np.int64)
                if values["pair"].is_valid:
                    order = np.argsort(values["pair"].values.to_numpy())
                    links = np.frombuffer(values["links"].as_py(), "<u2" if len(order) <= 1 << 16 else "<u4")
                    doc = np.repeat(np.arange(len(n_links)), n_links)
                    n = values["n"].values.to_numpy()[order][links]
                    np.add.at(total, doc, n)
                    best = np.bincount(doc[values["best"].values.to_numpy(zero_copy_only=False)[order][links]], minlength=len(n_links))
                yield record(
                    doc_id=values["doc_ids"].values, n_a=values["n_a"].values, n_b=values["n_b"].values,
                    n_groups=values["n_links"].values, n_links=values["n_links"].values,
                    n_best=pa.array(best, pa.int64()), count_sum=pa.array(total, pa.int64()), groups_sha256=values["groups_sha256"].values,
                )

    longs = ", ".join(f"{c} long" for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"))
    return rows.mapInArrow(frugal(run), f"doc_id {key_type(docs)}, {longs}, groups_sha256 string")
