"""Fill-in-the-middle forms of whole texts, cut at units by a wavelet matrix.

The code points of a slice of texts are put into classes of characters, and one wavelet
matrix over the classes answers for all texts of the slice at once. A unit (a line, a
sentence, a word, a character) ends after a character of its closing classes. The number of
units before a place is the sum of the ranks of these classes. The place where the k-th unit
ends is a select where one class closes a unit, and a bisection on the summed ranks where
several do.

The cuts and the form come from a hash of the seed and ``doc_id``, so a repeated task gives
the same rows. ``restored`` rebuilds the exact text from the output and its form alone.

Defined cases: a null or empty text has no units and is ``plain``, its output is empty; a
text that holds a mark is ``plain`` and comes out as it is; rows without ``doc_id`` hash as
if it were empty; repeated rows are cut alike, one by one; very long texts are taken whole;
an empty table gives an empty result; columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import re
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factgraph.llm.common import key_type, map_slices, record

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

# Classes of characters; all that is not named is LETTER.
LETTER, NEWLINE, SPACE, STOP, DIGIT, MARK = range(6)
LEVELS = 3
NAMED = {NEWLINE: "\n", SPACE: "\t\x0b\x0c\r ", STOP: ".!?", DIGIT: "0123456789", MARK: "\"#$%&'()*+,-/:;<=>@[\\]^_`{|}~"}
# Classes that end a unit.
UNITS = {"lines": [NEWLINE], "sentences": [NEWLINE, STOP], "words": [NEWLINE, SPACE], "characters": [*range(6)]}


def classes(points: np.ndarray) -> np.ndarray:
    """The class of every code point."""
    table = np.full(129, LETTER, np.uint8)  # the last stands for all beyond ASCII
    for kind, chars in NAMED.items():
        table[[ord(c) for c in chars]] = kind
    return table[np.minimum(points, 128)]


class BitRanks:
    """Bits with ranks and selects in about one step: words of 64 and the ones before each."""

    def __init__(self, bits: np.ndarray):
        self.n = len(bits)
        padded = np.zeros((self.n // 64 + 1) * 64, np.uint8)
        padded[: self.n] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])
        self.zeros = self.n - int(self.before[-1])

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        below = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[word] + np.bitwise_count(below)

    def place(self, k: np.ndarray, one: bool) -> np.ndarray:
        """Place of the one, or zero, that has ``k`` such bits before it."""
        before = self.before if one else np.arange(len(self.before)) * 64 - self.before
        word = np.searchsorted(before, k, side="right") - 1
        words = self.words[word] if one else ~self.words[word]
        bits = np.unpackbits(words.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        found = np.cumsum(bits, axis=1, dtype=np.int16) > (k - before[word])[:, None]
        return word * 64 + found.argmax(axis=1)


class WaveletMatrix:
    """Rank and select over a sequence of small codes, one bit vector per bit of a code."""

    def __init__(self, codes: np.ndarray, levels: int = LEVELS):
        self.n, self.levels = len(codes), []
        for shift in range(levels - 1, -1, -1):
            bits = (codes >> shift) & 1
            self.levels.append((shift, BitRanks(bits)))
            codes = np.concatenate([codes[bits == 0], codes[bits == 1]])

    def _down(self, code: int, at: np.ndarray) -> np.ndarray:
        for shift, bits in self.levels:
            ones = bits.ones(at)
            at = bits.zeros + ones if code >> shift & 1 else at - ones
        return at

    def rank(self, code: int, at: np.ndarray) -> np.ndarray:
        """How often ``code`` stands before each place."""
        return self._down(code, at) - self._down(code, np.zeros(1, np.int64))

    def select(self, code: int, k: np.ndarray) -> np.ndarray:
        """Place of the occurrence of ``code`` that has ``k`` before it."""
        at = self._down(code, np.zeros(1, np.int64)) + k
        for shift, bits in reversed(self.levels):
            at = bits.place(at - bits.zeros, True) if code >> shift & 1 else bits.place(at, False)
        return at


class UnitCuts:
    """Units of many texts that stand one after the other."""

    def __init__(self, texts: list[str], unit: str):
        self.closing = UNITS[unit]
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.end = np.cumsum(sizes)
        self.start = self.end - sizes
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
        self.matrix = WaveletMatrix(classes(points))
        self.before = self.closed(self.start)
        closed = self.closed(self.end) - self.before
        last = np.maximum(self.end - 1, self.start)
        open_end = (sizes > 0) & (self.closed(self.end) == self.closed(last))
        self.n = closed + open_end

    def closed(self, at: np.ndarray) -> np.ndarray:
        """Units that end before each place, over all texts."""
        return reduce(np.add, [self.matrix.rank(c, at) for c in self.closing])

    def cut(self, k: np.ndarray) -> np.ndarray:
        """Code points of the first ``k`` units of each text."""
        places = np.where(k <= 0, self.start, self.end)
        inside = np.flatnonzero((k > 0) & (k < self.n))
        if len(inside):
            wanted = self.before[inside] + k[inside]
            if len(self.closing) == 1:
                places[inside] = self.matrix.select(self.closing[0], wanted - 1) + 1
            else:
                places[inside] = self._bisected(wanted, self.start[inside], self.end[inside])
        return places - self.start

    def _bisected(self, wanted: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The least places before which ``wanted`` units end."""
        while (low < high).any():
            middle = (low + high) >> 1
            enough = self.closed(middle) >= wanted
            low, high = np.where(enough, low, middle + 1), np.where(enough, middle, high)
        return low


def draws(key: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers from the hash of seed and key."""
    text = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(text, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def filled(docs: DataFrame, unit: str = "lines", seed: int = 7, rate: int = 100, spm_rate: int = 50) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of every whole text.

    ``n`` are its units. Of a hundred texts ``rate`` are cut into prefix, middle and suffix,
    and of these ``spm_rate`` put the suffix first.
    """
    h1, h2, h3, h4 = draws(F.col("doc_id"), seed)
    text = F.coalesce("text", F.lit(""))
    marked = F.contains(text, F.lit(PREFIX)) | F.contains(text, F.lit(SUFFIX)) | F.contains(text, F.lit(MIDDLE))
    plain = (text == "") | marked | (h3 % 100 >= rate)
    form = F.when(plain, "plain").when(h4 % 100 < spm_rate, "spm").otherwise("psm")
    rows = docs.select("doc_id", text.alias("text"), form.alias("form"), h1.alias("h1"), h2.alias("h2"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, forms = batch.column("text").to_pylist(), batch.column("form").to_pylist()
        units = UnitCuts(texts, unit)
        drawn = [batch.column(c).to_numpy() % (units.n + 1) for c in ("h1", "h2")]
        first, second = units.cut(np.minimum(*drawn)), units.cut(np.maximum(*drawn))
        output = []
        for t, f, a, b in zip(texts, forms, first.tolist(), second.tolist(), strict=True):
            if f == "psm":
                t = f"{PREFIX}{t[:a]}{SUFFIX}{t[b:]}{MIDDLE}{t[a:b]}"
            elif f == "spm":
                t = f"{SUFFIX}{t[b:]}{PREFIX}{t[:a]}{MIDDLE}{t[a:b]}"
            output.append(t)
        no_cut = np.array([f == "plain" for f in forms], bool)
        return record(
            doc_id=batch.column("doc_id"),
            n=pa.array(units.n, pa.int64()),
            form=batch.column("form"),
            prefix_chars=pa.array(first, pa.int64(), mask=no_cut),
            middle_chars=pa.array(second - first, pa.int64(), mask=no_cut),
            output=pa.array(output, pa.string()),
        )

    schema = f"doc_id {key_type(docs)}, n long, form string, prefix_chars long, middle_chars long, output string"
    return map_slices(rows, work, schema)


def restored(output: Column | str, form: Column | str) -> Column:
    """The exact text of an output and its form: a cut text holds each mark once."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    parts = F.split(output, "|".join(map(re.escape, (PREFIX, SUFFIX, MIDDLE))))
    return (
        F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
        .when(form == "spm", F.concat(parts[2], parts[3], parts[1]))
        .otherwise(output)
    )
