"""Token ids on disk: one zstandard frame per document, one dictionary for all.

The store is a folder with three Parquet tables. ``blocks`` holds, in ascending order of
``doc_id``, runs of documents: their ids, the offsets of their frames in ``payload``,
their token counts and the ids before the block within its shard. ``shards`` holds the
ids before each shard. ``dictionary`` holds the dictionary, trained on serialized id
arrays of a bounded sample, and its hash, which every block repeats. One document is read
from one block by its offset, without its neighbours.

Defined cases: a null text counts as empty and stores the end id alone; repeated rows are
stored one by one; rows without ``doc_id`` come first; an empty table gives a store with
no blocks. Texts are encoded whole, whatever their length.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factgraph.llm.common import Memory, map_slices, record, staged

MODEL = "word_bpe_49k.json"
END_ID = 1
# The dictionary is trained on at most so many documents, of which at most so many ids each.
SAMPLE_DOCUMENTS, SAMPLE_IDS, DICTIONARY_BYTES = 2000, 2048, 64 << 10
LEVEL = 3
# A block closes at so many documents or payload bytes.
BLOCK_DOCUMENTS, BLOCK_BYTES = 1000, 4 << 20
# Half of the bytes of words and of chunks beyond Latin letters that a worker remembers.
REMEMBERED = 80 << 20

# Bytes of text encoded at once.
SLICE_BYTES = 2 << 20
# Stands between the ids of chunks that are encoded together.
BREAK = b"\xff" * 4

# The split of the tokenizer file whose parts may be encoded one by one.
WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def model_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordEncoder:
    """Ids of whole texts as little-endian bytes, each distinct word encoded once while remembered.

    Where the tokenizer file normalises and splits as expected, no token crosses ASCII
    white space, so the ids of a text are those of its chunks. Chunks of plain Latin
    letters are split by the same pattern, all those of a slice together, and their parts go
    to the library's model; all others go to the library whole. Any other file is used on
    whole texts.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        spec = json.loads(self.tokenizer.to_str())
        steps = [s["type"] for s in (spec.get("normalizer") or {}).get("normalizers", [])]
        splits = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        self.by_word = (
            steps == ["NFC", "Replace", "Lowercase"]
            and [s.get("type") for s in splits] == ["Split", "ByteLevel"]
            and splits[0]["pattern"].get("Regex") == WORD_SPLIT
            and splits[0]["invert"]
            and not splits[1]["add_prefix_space"]
            and spec.get("post_processor") is None
        )
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.by_word = self.by_word and not any(re.search(r"\s", s) or t["lstrip"] or t["rstrip"] for s, t in zip(self.special, spec["added_tokens"], strict=True))
        # Letters of Latin-1 whose lower case stays there; the rest goes to the library.
        letters = "".join(c for c in map(chr, range(256)) if c.isalpha() and c not in "ªµº")
        small = "".join(c for c in letters if c == c.lower())
        self.plain = re.compile(f"[\n!-~{letters}]*")
        # A line break stands between chunks.
        self.parts = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{small}]+|[0-9]|\n|[^\n0-9{small}]+")
        self.model = self.tokenizer.model
        self.chunks, self.words = Memory(remembered // 2), Memory(remembered * 3 // 2)
        kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
        extra = iter(range(256, 512))
        # The byte-level alphabet: printable bytes stand for themselves, others follow from 256.
        alphabet = {b: chr(b) if b in kept else chr(next(extra)) for b in range(256)}
        self.alphabet = {c: "".join([alphabet[b] for b in chr(c).encode()]) for c in range(256)}

    def encode(self, text: str | None) -> bytes:
        return self.encode_all([text])[0]

    def encode_all(self, texts: Sequence[str | None] | pa.Array) -> list[bytes]:
        """The ids of each text. Arrow cuts the texts and tells their chunks apart, so what is
        done in Python is done once for each distinct chunk of a slice, for all of them together."""
        if not self.by_word:
            texts = texts.to_pylist() if isinstance(texts, pa.Array) else texts
            return [self._bytes(self.tokenizer.encode(t, add_special_tokens=False).ids) if t else b"" for t in texts]
        if not isinstance(texts, pa.Array):
            texts = pa.array([(t or "").encode("utf-8", "surrogatepass") for t in texts], pa.large_binary()).view(pa.large_string())
        lists = pc.ascii_split_whitespace(texts.fill_null(""))
        ends = lists.offsets.to_numpy()
        # Arrow gives an empty chunk beside white space at either end.
        cut = lists.values.slice(ends[0], ends[-1] - ends[0]).dictionary_encode()
        if not len(cut):
            return [b""] * len(texts)
        chunks = pa.ListArray.from_arrays([0, len(cut.dictionary)], cut.dictionary.cast(pa.large_binary()))
        text = pc.binary_join(chunks, pa.scalar(b"\n", pa.large_binary()))[0].as_py().decode("utf-8", "surrogatepass")
        _, bounds, data = pa.array(self._chunk_ids(text), pa.large_binary()).take(cut.indices).buffers()
        whole = data.to_pybytes() if data else b""
        at = np.frombuffer(bounds, np.int64)[ends - ends[0]].tolist()
        return [whole[s:e] for s, e in zip(at, at[1:], strict=False)]

    def _chunk_ids(self, text: str) -> list[bytes]:
        """The ids of chunks, which line breaks part."""
        if self._all_plain(text):
            return self._plain_ids(text)
        chunks = text.split("\n")
        plain = {c: None for c in chunks if self._all_plain(c)}
        found = dict(zip(plain, self._plain_ids("\n".join(plain)), strict=False))
        known = self.chunks.make_room()
        for c in self.chunks.recall_all([c for c in chunks if c not in found and c not in known]):
            ids = self._bytes(self.tokenizer.encode(c, add_special_tokens=False).ids)
            self.chunks.keep(c, ids, len(ids))
        ids = [found[c] if c in found else known[c] for c in chunks]
        self.chunks.forget_long()
        return ids

    def _plain_ids(self, text: str) -> list[bytes]:
        words = self.parts.findall(text.lower())
        known, tokenize = self.words.make_room(), self.model.tokenize
        known["\n"] = BREAK
        new = self.words.recall_all(set(words).difference(known))
        self.words.keep_all(new, [self._bytes([t.id for t in tokenize(w if w.isascii() else w.translate(self.alphabet))]) for w in new])
        # No id has a byte of 255 at its end, so the breaks are found where they stand.
        ids = b"".join(map(known.__getitem__, words)).split(BREAK)
        self.words.forget_long()
        return ids

    def _all_plain(self, text: str) -> bool:
        return self.plain.fullmatch(text) is not None and not any(s in text for s in self.special)

    @staticmethod
    def _bytes(ids: list[int]) -> bytes:
        found = array("I", ids)
        if sys.byteorder == "big":
            found.byteswap()
        return found.tobytes()


@lru_cache(maxsize=1)
def encoder_of(path: str) -> WordEncoder:
    """One per Python worker, which Spark keeps for later tasks, with what it remembers."""
    return WordEncoder(path)


def _id_type(path: str) -> str:
    from tokenizers import Tokenizer

    return "<u2" if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else "<u4"


def train_dictionary(docs: DataFrame, path: str, kind: str) -> bytes:
    """A dictionary from the serialized ids of a bounded sample of documents."""
    import zstandard

    filled = docs.filter(F.length("text") > 0)
    ids = filled.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCUMENTS).distinct()
    sample = filled.join(F.broadcast(ids), "doc_id").select(F.substring("text", 1, 8 * SAMPLE_IDS).alias("text"))

    def setup():
        encoder = encoder_of(path)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids = [i[: 4 * SAMPLE_IDS] for i in encoder.encode_all(batch.column("text"))]
            return record(ids=pa.array(ids, pa.binary()))

        return work

    rows = [bytes(r.ids) for r in map_slices(sample, None, "ids binary", setup, SLICE_BYTES).collect()]
    serial = [np.frombuffer(r, "<u4").astype(kind).tobytes() for r in rows]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, [s for s in serial if len(s) >= 8]).as_bytes()
    except zstandard.ZstdError:  # too little to learn from
        return b""


def _dictionary(data: bytes):
    import zstandard

    return zstandard.ZstdCompressionDict(data) if data else None


def frames(docs: DataFrame, path: str, data: bytes, kind: str, end_id: int) -> DataFrame:
    """``doc_id, n_tokens, frame`` of every whole text."""
    key = docs.schema["doc_id"].dataType.simpleString()

    def setup():
        import zstandard

        encoder = encoder_of(path)
        end = np.array([end_id], "<u4").tobytes()
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(data), write_checksum=False)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids = [np.frombuffer(i + end, "<u4") for i in encoder.encode_all(batch.column("text"))]
            return record(
                doc_id=batch.column("doc_id"),
                n_tokens=pa.array([len(i) for i in ids], pa.int64()),
                frame=pa.array([press.compress(i.astype(kind).tobytes()) for i in ids], pa.binary()),
            )

        return work

    return map_slices(docs.select("doc_id", "text"), None, f"doc_id {key}, n_tokens long, frame binary", setup, SLICE_BYTES)


def write_store(docs: DataFrame, folder: str, path: str | None = None, end_id: int = END_ID) -> str:
    """Encode whole texts and write the store; returns ``folder``.

    Frames are staged, then dealt by ranges of ``doc_id`` and packed into blocks. Every
    write goes through Spark's committer, so a lost executor repeats its own part.
    """
    spark, path = docs.sparkSession, path or model_path(MODEL)
    kind = _id_type(path)
    data = train_dictionary(docs, path, kind)
    digest = hashlib.sha256(data).hexdigest()
    done = staged(frames(docs, path, data, kind, end_id))
    key = done.schema["doc_id"].dataType.simpleString()
    schema = f"shard int, block long, before long, doc_ids array<{key}>, offsets array<long>, n_tokens array<long>, payload binary, dictionary_sha256 string"
    kinds = done.select("doc_id").schema

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_type

        arrow_key = to_arrow_type(kinds["doc_id"].dataType)
        shard, block, before = TaskContext.get().partitionId(), 0, 0
        ids, counts, parts, held = [], [], [], 0

        def close() -> pa.RecordBatch:
            offsets = [0]
            for p in parts:
                offsets.append(offsets[-1] + len(p))
            return record(
                shard=pa.array([shard], pa.int32()),
                block=pa.array([block], pa.int64()),
                before=pa.array([before], pa.int64()),
                doc_ids=pa.array([ids], pa.list_(arrow_key)),
                offsets=pa.array([offsets], pa.list_(pa.int64())),
                n_tokens=pa.array([counts], pa.list_(pa.int64())),
                payload=pa.array([b"".join(parts)], pa.binary()),
                dictionary_sha256=pa.array([digest], pa.string()),
            )

        for batch in batches:
            for doc, n, frame in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                ids.append(doc), counts.append(n), parts.append(frame)
                held += len(frame)
                if len(ids) >= BLOCK_DOCUMENTS or held >= BLOCK_BYTES:
                    yield close()
                    block, before = block + 1, before + sum(counts)
                    ids, counts, parts, held = [], [], [], 0
        if ids:
            yield close()

    ordered = done.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), "frame"
    )
    ordered.select("doc_id", "n_tokens", "frame").mapInArrow(pack, schema).write.parquet(f"{folder}/blocks")
    blocks = spark.read.parquet(f"{folder}/blocks")
    size = F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, n: a + n)
    # One row per shard; shards number as the tasks of the write.
    totals = blocks.groupBy("shard").agg(F.max(F.col("before") + size).alias("n")).withColumn("_one", F.lit(1))
    from pyspark.sql import Window

    ahead = Window.partitionBy("_one").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    totals.select("shard", F.coalesce(F.sum("n").over(ahead), F.lit(0)).cast("long").alias("start")).write.parquet(f"{folder}/shards")
    spark.createDataFrame([(digest, bytearray(data), kind)], "sha256 string, dictionary binary, id_type string").coalesce(1).write.parquet(f"{folder}/dictionary")
    return folder


def read_store(spark: SparkSession, folder: str, doc_ids: DataFrame | None = None, with_ids: bool = True) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` and, unless told not to, ``ids`` from the files.

    ``doc_ids`` (one column ``doc_id``) reads chosen documents: blocks are joined on the
    ids they list and only the chosen frames are decompressed.
    """
    row = spark.read.parquet(f"{folder}/dictionary").first()
    data, digest, kind = bytes(row.dictionary), row.sha256, row.id_type
    blocks = spark.read.parquet(f"{folder}/blocks")
    key = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    base = spark.read.parquet(f"{folder}/shards")
    rows = blocks.join(F.broadcast(base), "shard").withColumn("start", F.col("start") + F.col("before"))
    if doc_ids is not None:
        listed = rows.select("shard", "block", F.explode("doc_ids").alias("doc_id"))
        chosen = listed.join(doc_ids.select("doc_id").distinct(), "doc_id").groupBy("shard", "block").agg(F.collect_set("doc_id").alias("chosen"))
        rows = rows.join(chosen, ["shard", "block"])
    else:
        rows = rows.withColumn("chosen", F.lit(None).cast(f"array<{key}>"))
    rows = rows.select("doc_ids", "offsets", "n_tokens", "payload", "dictionary_sha256", "start", "chosen")

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        import zstandard

        press = zstandard.ZstdDecompressor(dict_data=_dictionary(data))
        for batch in batches:
            key_type = batch.schema.field("doc_ids").type.value_type
            for i in range(batch.num_rows):
                get = lambda c, i=i, batch=batch: batch.column(c)[i].as_py()
                if get("dictionary_sha256") != digest:
                    raise ValueError("a block was written with another dictionary")
                payload, offsets, at, chosen = get("payload"), get("offsets"), get("start"), get("chosen")
                wanted = None if chosen is None else set(chosen)
                out = {"doc_id": [], "start": [], "n_tokens": [], "ids_crc32": [], "ids": []}
                for k, (doc, n) in enumerate(zip(get("doc_ids"), get("n_tokens"), strict=True)):
                    if wanted is None or doc in wanted:
                        size = np.dtype(kind).itemsize * n
                        frame = press.decompress(payload[offsets[k] : offsets[k + 1]], max_output_size=size)
                        ids = np.frombuffer(frame, kind).astype("<u4")
                        for c, v in zip(out, (doc, at, n, zlib.crc32(ids.tobytes()), ids), strict=True):
                            out[c].append(v)
                    at += n
                columns = {
                    "doc_id": pa.array(out["doc_id"], key_type),
                    **{c: pa.array(out[c], pa.int64()) for c in ("start", "n_tokens", "ids_crc32")},
                }
                if with_ids:
                    columns["ids"] = pa.array([v.astype(np.int64) for v in out["ids"]], pa.list_(pa.int64()))
                yield record(**columns)

    ids = ", ids array<long>" if with_ids else ""
    return rows.mapInArrow(unpack, f"doc_id {key}, start long, n_tokens long, ids_crc32 long{ids}")
