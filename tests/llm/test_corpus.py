"""Brute force against the operators that compare texts, and against the pipeline."""

from __future__ import annotations

import hashlib
import random
import re

import corpus_pipeline
import pytest
from factgraph.llm import common, compression_quality, decontaminate, near_dedup, sampled_encoding, substring_dedup
from factgraph.llm.common import fold, table
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string, edge string, wid string"


def make(rng: random.Random, vocabulary: int, n: int) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def corpus() -> list[tuple[int | None, str | None]]:
    """Copies, near copies, chains of them, shared passages, odd and empty texts."""
    rng = random.Random(3)
    base = [make(rng, 4000, rng.choice([3, 30, 120, 300])) for _ in range(40)]
    texts: list[str | None] = list(base)
    for b in base[:12]:
        words = b.split()
        for _ in range(rng.randrange(1, 5)):
            changed = list(words)
            for _ in range(rng.randrange(0, max(2, len(words) // 40))):
                changed[rng.randrange(len(changed))] = f"x{rng.randrange(99)}"
            texts.append(" ".join(changed))
    chain = make(rng, 4000, 200).split()
    for i in range(8):  # neighbours are alike, the ends are not
        texts.append(" ".join(chain[i * 6 : i * 6 + 150]))
    passage, hot = make(rng, 4000, 70), make(rng, 4000, 55)
    for i in range(25):
        own = [make(rng, 4000, rng.randrange(20, 80)), hot, make(rng, 4000, 20)]
        texts.append("\n".join(own if i % 2 else [*own, passage.upper() if i % 3 == 0 else passage]))
    texts += [None, "", " \n ", "one", "the the the " * 60, "the the the " * 61, "a b c d e", "A b\tC d e", "é " * 55, make(rng, 50, 4000)]
    texts += [texts[1], texts[1], texts[14]]
    rng.shuffle(texts)
    rows: list[tuple[int | None, str | None]] = [(i * 3, t) for i, t in enumerate(texts)]
    return [*rows, rows[4], (None, texts[3]), (None, None)]


ITEMS = [(0, None), (1, ""), (2, "short item"), (None, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11")]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, None, "s", 5, "x", None, "y") for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def items(rows):
    found = list(ITEMS)
    rng = random.Random(5)
    for k, (_, t) in enumerate(rows[:40]):
        words = (t or "").split()
        if len(words) > 30:
            at = rng.randrange(len(words) - 25)
            found.append((10 + k, "Foreign, words " + ", ".join(words[at : at + rng.randrange(8, 25)]) + " end."))
    return [*found, (10, "again w1"), (11, "one")]


def set_of(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute_components(rows, percent):
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    known = [(i, s) for i, t in rows if i is not None and (s := set_of(t))]
    for k, (i, a) in enumerate(known):
        for j, b in known[:k]:
            same = len(a & b)
            if 100 * same >= percent * (len(a) + len(b) - same):
                x, y = top(i), top(j)
                up[max(x, y)] = min(x, y)
    return {i: top(i) for i, _ in known}


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates_equal_brute_force(docs, rows, percent):
    want = brute_components(rows, percent)
    got = near_dedup.near_duplicates(docs, percent).collect()
    assert len(got) == len(rows)
    assert len(set(want.values())) < len(want) - 20
    for r in got:
        assert r.component_id == (want.get(r.doc_id, r.doc_id) if r.doc_id is not None else None)
        assert r.kept == (r.doc_id == r.component_id)
    sizes = {i: len(set_of(t)) for i, t in rows}
    assert all(r.n_shingles == sizes[r.doc_id] for r in got if r.doc_id is not None)


def test_a_bucket_with_several_components_is_compared_in_full(spark, monkeypatch):
    """With one row per band, texts far apart share buckets; the star alone would miss links."""
    monkeypatch.setattr(near_dedup, "band_keys", lambda s, bands=30, rows=5, f=near_dedup.band_keys: f(s, 150, 1))
    rng = random.Random(8)
    common = make(rng, 9000, 60)
    rows = []
    for g in range(6):
        base = (common + " " + make(rng, 9000, 60)).split()
        for _ in range(4):
            words = list(base)
            words[rng.randrange(60, 120)] = f"z{rng.randrange(99)}"
            rows.append((len(rows), " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_components(rows, 85)
    assert {r.doc_id: r.component_id for r in near_dedup.near_duplicates(df, 85).collect()} == want


def test_classes_whose_sizes_do_not_fit_their_leader_keep_their_links(spark, monkeypatch):
    """One bucket of 84, 86 and 100 shingles: the third is too large for the leader, not for the second."""
    monkeypatch.setattr(near_dedup, "band_keys", lambda s: s[:, :1] * 0)
    second = [f"w{i}" for i in range(90)]
    texts = [[*second[:74], *(f"x{i}" for i in range(14))], second, [*second, *(f"y{i}" for i in range(14))]]
    assert [len(near_dedup.shingles(" ".join(t))) for t in texts] == [84, 86, 100]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near_dedup.near_duplicates(df, 85).collect()} == {0: 0, 1: 1, 2: 1}


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i + 1, i) for i in range(200)] + [(500, 400), (400, 500), (450, 500)], "a long, b long").repartition(7)
    got = {r.node: r.component for r in near_dedup.components(links).collect()}
    assert got == {i: 0 for i in range(201)} | {400: 400, 450: 400, 500: 400}
    assert near_dedup.components(links.limit(0)).count() == 0


def test_super_min_hash_estimates_similarity():
    import numpy as np

    rng = np.random.default_rng(2)
    pool = rng.integers(0, 2**63, 1500, dtype=np.uint64)
    a, b = np.sort(pool[:1000]), np.sort(pool[250:1250])
    sets = [a, b, a[:3], a[:0]]
    both = near_dedup.super_min_hash(np.concatenate(sets), np.repeat(np.arange(4), [len(s) for s in sets]), 4)
    assert abs((both[0] == both[1]).mean() - 750 / 1250) < 0.15
    alone = near_dedup.super_min_hash(a[:3], np.zeros(3, int), 1)
    assert (alone[0] == both[2]).all()
    # Every rank of a permutation once per element: early stopping may only leave larger ones out.
    assert sorted((alone[0] >> 40).tolist())[-1] < 150


def brute_removal(rows):
    first: dict = {}
    for i, t in rows:
        words = (t or "").encode().split()
        for p in range(len(words) - 49):
            if i is not None:
                w = tuple(words[p : p + 50])
                first[w] = min(first.get(w, i), i)
    out = []
    for i, t in rows:
        words = (t or "").encode().split()
        gone = set()
        for p in range(len(words) - 49):
            if i is not None and first[tuple(words[p : p + 50])] < i:
                gone |= set(range(p, p + 50))
        kept = [w for k, w in enumerate(words) if k not in gone]
        out.append((i, t, len(words), len(gone), kept))
    return out


def test_substring_report_equals_brute_force(docs, rows):
    want = sorted((str(i), n, g, hashlib.sha256(b" ".join(k)).hexdigest()) for i, _, n, g, k in brute_removal(rows))
    got = sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.report(docs).collect())
    assert got == want
    assert sum(w[2] > 0 for w in want) > 20


def test_substring_texts_and_other_columns(docs, rows):
    out = substring_dedup.deduplicated(docs)
    assert out.schema.names == docs.schema.names
    want = sorted((str(i), t if not g else b" ".join(k).decode()) for i, t, _, g, k in brute_removal(rows) if t is not None)
    got = [r for r in out.collect() if r.text is not None]
    assert sorted((str(r.doc_id), r.text) for r in got) == want
    assert all(r.n_chars == len(r.text) and r.edge is None and r.n_words == "x" for r in got)


def words_of(text):
    fold_az = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", fold_az)


def brute_hits(rows, items):
    windows = set()
    for i, t in items:
        w = words_of(t)
        k = min(10, len(w))
        windows |= {(i, tuple(w[p : p + k])) for p in range(len(w) - k + 1) if k}
    by: dict = {}
    for i, w in windows:
        by.setdefault(w, set()).add(i)
    sizes = {len(w) for w in by}
    out = []
    for i, t in rows:
        w = words_of(t)
        hit, own = set(), set()
        for k in sizes:
            for p in range(len(w) - k + 1):
                if tuple(w[p : p + k]) in by:
                    hit |= set(range(p, p + k))
                    own |= by[tuple(w[p : p + k])]
        names = sorted(str(x) for x in own if x is not None)
        out.append((str(i), len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return out


def test_contamination_equals_brute_force(spark, docs, rows, items):
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(docs, bench)
    want = sorted(brute_hits(rows, items))
    found = sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got.collect())
    assert found == want
    assert 10 < sum(w[5] for w in want) < len(want) - 10
    kept = decontaminate.clean(docs, bench)
    assert kept.schema.names == docs.schema.names
    assert kept.count() == sum(not w[5] for w in want)


def test_contamination_with_many_keys_equals_brute_force(spark, docs, rows, items, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_KEYS", 0, raising=False)
    monkeypatch.setattr(decontaminate, "broadcast_if_small", lambda df: df)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(docs, bench)
    found = sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got.collect())
    assert found == sorted(brute_hits(rows, items))


@pytest.mark.parametrize("most", [0, 1_000_000])
def test_places_leave_the_whole_text(spark, docs, items, monkeypatch, most):
    monkeypatch.setattr(decontaminate, "BROADCAST_KEYS", most, raising=False)
    bench = spark.createDataFrame(items, "item_id long, text string")
    keys = decontaminate.window_shingles(decontaminate.windows(bench))
    todo = [decontaminate.places(docs, keys, 3, 10)._jdf.queryExecution().optimizedPlan()]
    seen = 0
    while todo:  # what is made per place by a join or an explode holds no words of a whole text
        node = todo.pop()
        todo += [node.children().apply(i) for i in range(node.children().size())]
        names = [node.output().apply(i).name() for i in range(node.output().size())]
        if node.nodeName() in ("Generate", "Join") and "text_hash" in names:
            seen += 1
            assert "w" not in names
    assert seen > 1


def test_contamination_plan_is_native(spark, docs, items):
    bench = spark.createDataFrame(items, "item_id long, text string")
    plan = decontaminate.contamination(docs, bench)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_words_fold_only_a_to_z(spark):
    odd = spark.createDataFrame([(1, "É K straße İx \U0001d400b _a-b 9"), (2, "é k strasse")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "é k STRASSE"), (2, "É K")], "item_id long, text string")
    want = sorted(brute_hits([tuple(r) for r in odd.collect()], [tuple(r) for r in bench.collect()]))
    got = decontaminate.contamination(odd, bench).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got) == want


def test_empty_tables(spark, docs, items):
    none = docs.limit(0)
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert decontaminate.contamination(none, bench).count() == 0
    assert decontaminate.contamination(docs, bench.limit(0)).filter("contaminated or n_items > 0").count() == 0
    assert near_dedup.near_duplicates(none).count() == 0
    assert substring_dedup.report(none).count() == 0
    assert sampled_encoding.segmentations(none).count() == 0


def test_pipeline_equals_brute_force(spark, sf):
    documents, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    model = compression_quality.fit(documents, labels, fold("doc_id", 4) != 2)
    score = model.scorer()
    rows = [(r.doc_id, r.text) for r in documents.collect() if score(r.text) >= compression_quality.THRESHOLD]
    assert rows
    components = brute_components(rows, 80)
    rows = [(i, t) for i, t in rows if components.get(i, i) == i]
    rows = [(i, t if not g else b" ".join(k).decode()) for i, t, _, g, k in brute_removal(rows)]
    bench = [tuple(r) for r in table(spark, sf, "benchmark").select("item_id", "text").collect()]
    bad = {int(h[0]) for h in brute_hits(rows, bench) if h[5]}
    assert bad
    want = {i: t for i, t in rows if i not in bad}
    got = corpus_pipeline.run(spark, sf)
    texts = sampled_encoding.decoded(got).select("doc_id", "sample", "decoded").collect()
    assert {r.doc_id for r in texts} == set(want)
    assert all(r.decoded == want[r.doc_id] for r in texts)
    assert {r.sample for r in texts} == {0, 1}


def test_stages_keep_the_columns(spark, sf):
    documents = table(spark, sf, "documents").withColumn("extra", F.lit(1))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, documents, sf).schema.names == documents.schema.names


def test_a_worker_drops_what_other_operators_kept():
    dropped = []
    common.keep_between_tasks("one", lambda: dropped.append("one"))
    list(common.frugal(iter, "one")(iter([])))
    assert dropped == []
    model = sampled_encoding.model_path(sampled_encoding.MODEL)
    sampled_encoding.sampler_of(model, 2, 0.5, 0)
    list(common.frugal(iter, sampled_encoding.OWNER)(iter([])))
    assert dropped == ["one"] and sampled_encoding.sampler_of.cache_info().currsize == 1
    list(common.frugal(iter)(iter([])))
    assert sampled_encoding.sampler_of.cache_info().currsize == 0


def test_memory_of_a_worker_changes_no_segmentation(spark, docs):
    some = docs.select("doc_id", "text")
    plain = sampled_encoding.segmentations(some).collect()
    little = sampled_encoding.segmentations(some, remembered=50, limit=500).collect()
    assert len(plain) and sorted(map(str, plain)) == sorted(map(str, little))


def test_decoding_in_arrow():
    """Pieces of a row were joined in Python, and the hashes of all single characters met in one slot."""
    import numpy as np

    vocabulary = sampled_encoding.Vocabulary(sampled_encoding.model_path(sampled_encoding.MODEL))
    rng = np.random.default_rng(3)
    rows = [rng.integers(0, len(vocabulary.text), n).astype(np.int32) for n in (0, 5, 0, 1, 400, 0)]
    got = [sampled_encoding.decode(vocabulary.bytes_of, r) for r in rows]
    assert got == [sampled_encoding.decode(vocabulary.text, r) for r in rows]
    singles = [i for i, t in enumerate(vocabulary.text) if len(t) == 1 and t.isalpha() and not vocabulary.bytes[t[0]] == i]
    assert len(singles) > 40 and len({int(np.flatnonzero(vocabulary.ids == i)[0]) for i in singles}) == len(singles)
    assert len({int(vocabulary.hashes[vocabulary.ids == i][0]) >> 64 - sampled_encoding.TABLE for i in singles}) > 40
