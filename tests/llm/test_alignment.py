"""Brute force against rank-array BPE, fill-in-the-middle and token alignment."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from factgraph.llm import fill_in_middle, rank_bpe, token_alignment
from factgraph.llm.fill_in_middle import UnitCuts, WaveletMatrix
from factgraph.llm.queries import QUERIES
from factgraph.llm.rank_bpe import RankBpe
from pyspark.sql import functions as F
from tokenizers import Tokenizer

TEXTS = [
    None, "", " ", "\n", "a", " a", "a ", "a  b\n c", "  lead", "tail  ", "x\n\ny", "▁a ▁", "\ta\tb\r\n;\r\r", "Don't I'LL we've 's'tx 'S", "it''s\n\n\n  'll",
    "Ünïcode ÀÉ ß naïve é ﬁ x y z ​w \x1c\x85　", "<|endoftext|> a<|endoftext|>b <s> </s>", "a <|endoftext|>  ", "日本語 текст 1234 ½ ²\U0001F600\U00010940",
    "a_b-c!!! ###", "word " * 3000, "q" * 3000, "abcinter" * 300, "the same the same the same", "<0x41>&<unk>", "x<P>y", "<<S>", "line\n" * 50 + "<P", "\x00 nul",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "clash", 7) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "again", 1), (4, TEXTS[13], "other text", 1), (None, "no id, but words", None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, n string, ids int")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(rank_bpe.model_path())


@pytest.mark.parametrize("remembered", [80 << 20, 1])
def test_rank_bpe_equals_the_library(library, remembered):
    coder = RankBpe(rank_bpe.model_path(), remembered=remembered)
    rng = random.Random(5)
    letters = " \t\n\r  'stremvlld'abAB09,.<|éß日\x85　\U0001F600 "
    made = ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(1500)]
    for text in [*TEXTS, *made, *(m[:4] + "<|endoftext|>" + m[4:] for m in made[:200])]:
        want = library.encode(text or "", add_special_tokens=False).ids
        got = np.frombuffer(coder.encode(text), "<u4").tolist()
        assert got == want
        assert coder.decode(got) == library.decode(want, skip_special_tokens=False)


def test_rank_bpe_of_code_points(library):
    """All but the inner parts of the large blocks (Han, Hangul, private, unassigned planes)."""
    coder = RankBpe(rank_bpe.model_path())
    blocks = [(0, 0x3500), (0x9F00, 0xAC10), (0xD790, 0xD800), (0xE000, 0xE010), (0xF8F0, 0x12600), (0x16A00, 0x17010), (0x18CC0, 0x20010), (0x2A6D0, 0x2A710), (0x2FA00, 0x30010), (0x33470, 0x33490), (0xE0000, 0xE0200), (0x10FFF0, 0x110000)]
    points = [chr(c) for a, b in blocks for c in range(a, b)]
    for at in range(0, len(points), 5000):
        text = "".join(f"a{c}1{c}! {c}\t{c}{c}  {c}" for c in points[at : at + 5000])
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_scan_and_heap_agree():
    coder, rng = RankBpe(rank_bpe.model_path()), random.Random(6)
    for _ in range(300):
        raw = "".join(rng.choice("einrstaé ") for _ in range(rng.randrange(1, 120))).encode()
        assert coder._scanned(raw) == coder._heaped(raw)


def test_plain_specials_and_odd_ids(library):
    coder = RankBpe(rank_bpe.model_path(), plain_specials=True)
    plain = Tokenizer.from_file(rank_bpe.model_path())
    plain.encode_special_tokens = True
    text = "a<|endoftext|> b"
    assert np.frombuffer(coder.encode(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids
    rng = random.Random(7)
    for _ in range(200):  # halves of characters, ids beyond the vocabulary
        ids = [rng.randrange(50400) for _ in range(12)]
        assert coder.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_files_of_another_kind_are_refused():
    with pytest.raises(ValueError):
        RankBpe(rank_bpe.model_path("word_bpe_49k.json"))


def test_op13_rows(spark, docs, library, sf):
    for r in rank_bpe.round_trip(docs).filter("doc_id is not null and doc_id not in (3, 4)").collect():
        text = TEXTS[r.doc_id] or ""
        ids = library.encode(text, add_special_tokens=False).ids
        assert (r.n_tokens, bytes(r.ids), r.decoded) == (len(ids), np.array(ids, "<u4").tobytes(), text)
    lists = rank_bpe.encoded(docs)
    back = rank_bpe.decoded(lists.withColumn("text", F.lit("clash")))
    assert sorted(str(r.text) for r in back.collect()) == sorted(str(r.text or "") for r in docs.collect())
    assert rank_bpe.round_trip(docs.limit(0)).count() == rank_bpe.decoded(lists.limit(0)).count() == 0
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op13_rank_bpe"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest() and r.n_tokens == len(ids)
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_wavelet_matrix_equals_counting():
    rng = np.random.default_rng(3)
    for n in (0, 1, 63, 64, 65, 700):
        codes = rng.integers(0, 6, n).astype(np.uint8)
        matrix, places = WaveletMatrix(codes), np.arange(n + 1)
        for code in range(6):
            assert matrix.rank(code, places).tolist() == [int((codes[:i] == code).sum()) for i in places]
            at = np.flatnonzero(codes == code)
            assert matrix.select(code, np.arange(len(at))).tolist() == at.tolist()


PATTERNS = {
    "lines": r"[^\n]*\n|[^\n]+", "sentences": r"[^\n.!?]*[\n.!?]|[^\n.!?]+",
    "words": r"[^\n\t\x0b\x0c\r ]*[\n\t\x0b\x0c\r ]|[^\n\t\x0b\x0c\r ]+", "characters": r"(?s:.)",
}


@pytest.mark.parametrize("unit", list(PATTERNS))
def test_cuts_equal_a_pattern(unit):
    rng = random.Random(8)
    texts = [t or "" for t in TEXTS] + ["".join(rng.choice("ab\n .é!1\t") for _ in range(rng.randrange(200))) for _ in range(200)] + ["x y.\n" * 20_000]
    units, parts = UnitCuts(texts, unit), [re.findall(PATTERNS[unit], t) for t in texts]
    assert units.n.tolist() == [len(p) for p in parts]
    for _ in range(8):
        k = np.array([rng.randrange(len(p) + 1) for p in parts])
        assert units.cut(k).tolist() == [len("".join(p[:i])) for p, i in zip(parts, k, strict=True)]


def brute_fill(doc_id, text, unit, seed, rate, spm_rate):
    text = text or ""
    parts = re.findall(PATTERNS[unit], text)
    hexes = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(hexes[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted(x % (len(parts) + 1) for x in h[:2])
    p, m, s = ("".join(x) for x in (parts[:a], parts[a:b], parts[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(parts), "plain", None, None, text
    if h[3] % 100 < spm_rate:
        return len(parts), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(parts), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize(("unit", "seed", "rate", "spm_rate"), [("lines", 7, 100, 50), ("words", 1, 50, 30), ("characters", 2, 90, 100), ("sentences", 3, 100, 0)])
def test_forms_equal_brute_force(spark, docs, unit, seed, rate, spm_rate):
    rows = fill_in_middle.filled(docs, unit, seed, rate, spm_rate).withColumn("back", fill_in_middle.restored("output", "form"))
    got = sorted(map(repr, (tuple(r)[:6] for r in rows.collect())))
    want = sorted(repr((r.doc_id, *brute_fill(r.doc_id, r.text, unit, seed, rate, spm_rate))) for r in docs.collect())
    assert got == want
    assert sorted(r.back for r in rows.collect()) == sorted(r.text or "" for r in docs.collect())
    assert fill_in_middle.filled(docs.limit(0)).count() == 0


def brute_tokens(text, library_a, library_b):
    """Ids and ends of both sides; nothing where a side spells another text."""
    if not text:
        return [], []
    alphabet, whole = rank_bpe.byte_alphabet(), (" " + text).encode()
    a = [(i, bytes(alphabet[c] for c in library_a.id_to_token(i))) for i in library_a.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in library_b.encode(text):
        piece = library_b.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if library_b.is_byte(i) else piece.replace("▁", " ").encode()))
    if any(b"".join(t for _, t in side) != whole for side in (a, b)):
        return [], []
    out = []
    for side in (a, b):
        at, rows = 0, []
        for i, t in side:
            rows.append((i, at, at + len(t)))
            at += len(t)
        out.append(rows)
    return out


def brute_groups(a, b):
    ends = {e for *_, e in a} & {e for *_, e in b}
    groups = {end: ([], []) for end in sorted(ends)}
    for which, side in enumerate((a, b)):
        waiting = []
        for i, _, e in side:
            waiting.append(i)
            if e in ends:
                groups[e][which].extend(waiting)
                waiting = []
    return list(groups.values())


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece

    a = Tokenizer.from_file(rank_bpe.model_path())
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=rank_bpe.model_path(token_alignment.MODEL_B))


def check_report(rows, texts, libraries):
    """``texts``: a list of (doc_id, text) that the report covers."""
    tokens = [brute_tokens(t, *libraries) for _, t in texts]
    links = []
    for a, b in tokens:
        by_end = {e: j for j, _, e in b}
        links.append([(i, by_end[e]) for i, _, e in a if e in by_end])
    counts = Counter(x for doc in links for x in doc)
    most: dict[int, int] = {}
    for (_, j), n in counts.items():
        most[j] = max(most.get(j, 0), n)
    want = []
    for (doc_id, _), (a, b), own in zip(texts, tokens, links, strict=True):
        spelled = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in brute_groups(a, b))
        digest = hashlib.sha256(spelled.encode()).hexdigest() if spelled else ""
        best = sum(counts[x] == most[x[1]] for x in own)
        want.append((doc_id, len(a), len(b), len(own), len(own), best, sum(counts[x] for x in own), digest))
    assert sorted(repr(tuple(r)) for r in rows) == sorted(map(repr, want))


def test_op11_equals_brute_force(docs, libraries):
    report = token_alignment.link_report(docs)
    assert report.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    check_report(report.collect(), [(r.doc_id, r.text) for r in docs.collect()], libraries)
    assert token_alignment.link_report(docs.limit(0)).count() == 0
    only_empty = token_alignment.link_report(docs.filter("text is null or text = ''")).collect()
    assert [tuple(r)[1:] for r in only_empty] == [(0, 0, 0, 0, 0, 0, "")] * 2


def test_op11_of_a_whole_table(spark, sf, libraries):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    check_report(QUERIES["op11_token_alignment"](spark, sf).collect(), texts, libraries)


def test_overlaps_and_groups_equal_brute_force(docs, libraries):
    small = docs.filter("length(text) < 200 and doc_id is not null and doc_id not in (3, 4)")
    for r in token_alignment.alignments(small).collect():
        a, b = brute_tokens(TEXTS[r.doc_id], *libraries)
        assert (list(r.a), list(r.b)) == ([i for i, *_ in a], [i for i, *_ in b])
        pairs = [(i, j) for i, (_, s, e) in enumerate(a) for j, (_, t, f) in enumerate(b) if s < f and t < e]
        assert [tuple(p) for p in r.overlaps] == pairs
        ends = [(i + 1, j + 1) for i, (*_, e) in enumerate(a) for j, (*_, f) in enumerate(b) if e == f]
        assert [tuple(p) for p in r.groups] == ends


def test_slices_do_not_change_the_counts(docs, libraries):
    many = docs.repartition(3)
    check_report(token_alignment.link_report(many).collect(), [(r.doc_id, r.text) for r in docs.collect()], libraries)


def test_a_run_is_encoded_once_for_both_sides(libraries, monkeypatch):
    """Also of a text whose white space side A takes together across a cut of side B."""
    sides = token_alignment.Sides(rank_bpe.model_path(), rank_bpe.model_path(token_alignment.MODEL_B))
    asked = []
    encode = sides.a.encode_all
    monkeypatch.setattr(sides.a, "encode_all", lambda texts: asked.extend(texts) or encode(texts))
    texts = ["the words, once.\n\n  é and the ends \n ", "the words, once. and the ends \n ", " the  words", None, "a\t\n x\t y\u3000 z", "▁ the", "the ▁a"] * 2
    for again in range(2):
        a, b = sides.tokens(texts)
        for i, text in enumerate(texts):
            want = brute_tokens(text, *libraries)
            assert ([x[0] for x in want[0]], [x[0] for x in want[1]]) == (a["id"][a["doc"] == i].tolist(), b["id"][b["doc"] == i].tolist())
        again_asked, asked = asked, []
        assert not again or not any("words" in t for t in again_asked if t)
    sides._learn([])
