"""Held-out accuracy of the trained operators, and the sampler against enumeration."""

from __future__ import annotations

import math
import zlib

import numpy as np
import pytest
from factgraph.llm import byte_cnn_language, compression_quality, pu_toxicity, sampled_encoding
from factgraph.llm.common import fold, table
from factgraph.llm.sampled_encoding import Sampler
from factgraph.llm.token_counts import model_path
from pyspark.sql import functions as F

ODD = [(None, None), (1, None), (2, ""), (3, "   "), (4, "1234 --"), (4, "1234 --"), (5, "x"), (6, "word " * 50_000)]


@pytest.fixture(scope="module")
def large():
    return "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, "clash") for i, t in ODD], "doc_id long, text string, score string")


def held_out(spark, large, found, folds, held, label):
    labels = table(spark, large, "labels").filter(fold("doc_id", folds) == held)
    return [(r[0], r[1], r[2]) for r in found.join(labels, "doc_id").select(label, "predicted", "score").collect()]


def test_quality_on_held_out_labels(spark, large, odd):
    docs, labels = table(spark, large, "documents"), table(spark, large, "labels")
    model = compression_quality.fit(docs, labels, fold("doc_id", 4) != 2)
    rows = held_out(spark, large, compression_quality.scores(docs, model), 4, 2, "quality")
    assert np.mean([y == p for y, p, _ in rows]) > 0.93
    got = compression_quality.scores(odd, model).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in got if r.doc_id in (None, 1, 2)} == {model.share}
    kept = compression_quality.accepted(odd, model)
    assert kept.schema.names == odd.schema.names
    assert kept.count() == sum(r.predicted for r in got)
    assert compression_quality.scores(odd.limit(0), model).count() == 0


def test_quality_without_both_labels(spark, large, odd):
    docs, labels = table(spark, large, "documents"), table(spark, large, "labels")
    one = compression_quality.fit(docs, labels.filter("quality = 1"), F.lit(True))
    assert {r.score for r in compression_quality.scores(odd, one).collect()} == {1.0}
    none = compression_quality.fit(docs, labels.limit(0), F.lit(True))
    assert {r.score for r in compression_quality.scores(odd, none).collect()} == {0.5}


def test_toxicity_on_held_out_labels(spark, large, odd):
    docs, labels = table(spark, large, "documents"), table(spark, large, "labels")
    model = pu_toxicity.fit(docs, labels, fold("doc_id", 5) != 0)
    rows = held_out(spark, large, pu_toxicity.scores(docs, model), 5, 0, "toxic")
    assert np.mean([y == p for y, p, _ in rows]) > 0.93
    got = pu_toxicity.scores(odd, model).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    nothing = pu_toxicity.fit(docs, labels.filter("toxic = 0"), F.lit(True))
    assert {r.score for r in pu_toxicity.scores(odd, nothing).collect()} == {0.0}


def test_non_negative_risk_finds_the_feature_of_hidden_positives():
    rng = np.random.default_rng(4)
    texts = [np.unique(rng.integers(100, 400, 30)) for _ in range(1200)]
    toxic = rng.random(1200) < 0.15
    texts = [np.unique(np.r_[t, 7]) if y else t for t, y in zip(texts, toxic, strict=True)]
    model = pu_toxicity.train([t for t, y in zip(texts, toxic, strict=True) if y][:80], texts[200:], 0.15)
    weight = dict(zip(model.names.tolist(), model.weights.tolist(), strict=True))
    assert weight[7] == max(weight.values())
    z = np.array([model.bias + sum(weight.get(f, 0.0) for f in t.tolist()) for t in texts])
    assert ((z >= 0) == toxic).mean() > 0.95


def test_languages_on_held_out_rows(spark, large, odd):
    docs = table(spark, large, "documents")
    network = byte_cnn_language.fit(docs, fold("doc_id", 5) != 0)
    found = byte_cnn_language.languages(docs, network).join(docs.select("doc_id", "lang"), "doc_id").filter(fold("doc_id", 5) == 0)
    assert found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.95
    got = byte_cnn_language.languages(odd, network).collect()
    assert len(got) == len(ODD)
    assert all((r.lang_pred == "und") == (r.doc_id not in (5, 6)) for r in got)
    nothing = byte_cnn_language.fit(docs.limit(0), F.lit(True))
    assert nothing is None
    assert {r.lang_pred for r in byte_cnn_language.languages(odd, nothing).collect()} == {"und"}


def test_every_language_is_learnt(spark, monkeypatch):
    """300 languages; 256 of them have two documents, the others one."""
    monkeypatch.setattr(byte_cnn_language, "STEPS", 1)
    rows = [(i, f"text {i}", f"l{i % 300}") for i in range(556)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    network = byte_cnn_language.fit(docs, F.lit(True))
    assert network.languages == sorted({r[2] for r in rows}) and network.out.shape[1] == 300
    assert byte_cnn_language.languages(docs, network).filter("score > 0").count() == len(rows)


def paths(sampler: Sampler, text: str) -> dict[tuple[int, ...], float]:
    """All segmentations with their log probabilities, from piece weights alone."""
    v = sampler.lattices.vocabulary
    full = " " + text
    pieces = {v.text[i]: i for i in range(len(v.text)) if v.text[i] and v.bytes[v.text[i][0]] != i}
    raw: dict = {}

    def go(at: int, path: tuple, total: float) -> None:
        if at == len(full):
            raw[path] = total
        one = full[at : at + 1].encode()
        for size in range(1, len(full) - at + 1):
            if (i := pieces.get(full[at : at + size].encode())) is not None:
                go(at + size, (*path, i), total + v.weights[i])
        if one and one not in pieces:
            ids = [int(v.bytes[b]) for b in one]
            go(at + 1, (*path, *ids), total + sum(v.weights[i] for i in ids))

    go(0, (), 0.0)
    whole = np.logaddexp.reduce(list(raw.values()))
    return {p: w - whole for p, w in raw.items()}


@pytest.mark.parametrize("text", ["hey you", "日\nab", "a  b"])
def test_probabilities_equal_enumeration(text):
    sampler = Sampler(model_path(sampled_encoding.MODEL), samples=6, alpha=0.2)
    want = paths(sampler, text)
    for key in range(20):
        found = sampler.sample([key], [text])[0]
        ids = [tuple(f[3].tolist()) for f in found]
        assert len(set(ids)) == len(ids) == min(6, len(want))
        for path, f in zip(ids, found, strict=True):
            assert f[0] == pytest.approx(want[path], abs=2e-4)
        values = [f[1] for f in found]
        assert values == sorted(values, reverse=True)


def test_all_paths_come_out_when_there_are_few():
    sampler = Sampler(model_path(sampled_encoding.MODEL), samples=400, alpha=0.1)
    want = paths(sampler, "the cat")
    found = sampler.sample([1], ["the cat"])[0]
    assert {tuple(f[3].tolist()) for f in found} == set(want) and len(found) == len(want)
    assert all(f[2] == 0.0 for f in found)


def test_no_path_is_lost_at_the_default_weights():
    """Every text with up to 400 segmentations gives all of them, however unlikely some are."""
    sampler = Sampler(model_path(sampled_encoding.MODEL), samples=450)
    rng = np.random.default_rng(4)
    texts = ["tee", "exs", "hello", "the", " a", "日a", "a\nb", "é!", "zz z", "x"]
    texts += ["".join(rng.choice(list("abcdeinorst"), rng.integers(2, 7))) for _ in range(250)]
    checked = 0
    for key, text in enumerate(texts):
        want = paths(sampler, text)
        if len(want) > 400:
            continue
        found = sampler.sample([key], [text])[0]
        ids = [tuple(f[3].tolist()) for f in found]
        assert set(ids) == set(want) and len(ids) == len(want), text
        assert all(f[2] == 0.0 for f in found)
        assert all(f[0] == pytest.approx(want[p], abs=1e-9) for p, f in zip(ids, found, strict=True))
        checked += 1
    assert checked > 200


def test_samples_follow_the_probabilities():
    """First draws follow the distribution; second draws follow it without the first."""
    sampler = Sampler(model_path(sampled_encoding.MODEL), samples=2, alpha=0.25)
    want = paths(sampler, "the cat")
    n = 4000
    found = sampler.sample(list(range(n)), ["the cat"] * n)
    first, second = ([tuple(f[i][3].tolist()) for f in found] for i in (0, 1))
    for path, logp in sorted(want.items(), key=lambda x: -x[1])[:6]:
        p = math.exp(logp)
        other = sum(math.exp(q) * p / (1 - math.exp(q)) for r, q in want.items() if r != path)
        for draws, share in ((first, p), (second, other)):
            assert abs(draws.count(path) / n - share) < 5 * math.sqrt(share * (1 - share) / n) + 1e-3


def test_samples_depend_on_the_key_alone(spark, odd):
    rows = spark.createDataFrame([(i, f"some text {i % 7} to be cut into pieces, naïve 日本") for i in range(60)], "doc_id long, text string")
    one = {(r.doc_id, r.sample): (list(r.ids), r.log_inclusion) for r in sampled_encoding.segmentations(rows.repartition(7)).collect()}
    two = {(r.doc_id, r.sample): (list(r.ids), r.log_inclusion) for r in sampled_encoding.segmentations(rows.coalesce(1)).collect()}
    assert one == two
    got = sampled_encoding.decoded(sampled_encoding.segmentations(odd)).collect()
    texts = {i: t or "" for i, t in ODD}
    assert {r.doc_id for r in got} == set(texts)
    assert all(r.decoded == texts[r.doc_id] for r in got)
    library = Sampler(model_path(sampled_encoding.MODEL))
    assert library.sample([2], [""])[0][0][:3] == (0.0, pytest.approx(library.sample([2], [""])[0][0][1]), 0.0)


def test_segmentations_are_decoded_where_they_are_drawn(spark, odd, monkeypatch):
    texts = {i: (t or "").replace("▁", " ") for i, t in ODD}
    got = sampled_encoding.segmentations(odd, with_ids=False).collect()
    assert {r.doc_id for r in got} == set(texts)
    assert all(r.decodes and r.decoded_crc32 == zlib.crc32(texts[r.doc_id].encode()) for r in got)
    monkeypatch.setattr(sampled_encoding, "decode", lambda text_of, pieces: "other")
    assert not any(r.decodes for r in sampled_encoding.segmentations(odd, with_ids=False).collect())


def test_sampled_encoding_query_gives_the_ids(spark, sf):
    """The query kept sums of the drawn segmentations only, not the segmentations."""
    from zlib import crc32

    from factgraph.llm import queries

    rows = queries.op4_sampled_encoding(spark, sf).limit(50).collect()
    assert rows and all(len(r.ids) == r.n_pieces for r in rows)
    assert all(crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in rows)


def test_only_what_follows_a_leaving_place_is_drawn(monkeypatch):
    """A text of one segmentation draws once, a second path nothing before the place where it leaves."""
    sampler = sampled_encoding.Sampler(sampled_encoding.model_path(sampled_encoding.MODEL), samples=3)
    sizes = []
    draw = sampler.lattices.draw
    monkeypatch.setattr(sampler.lattices, "draw", lambda chunk, key: sizes.append(len(chunk)) or draw(chunk, key))
    found = sampler.sample([1, 2], ["\n", "the " * 9])
    chunks = [len(sampler.chunks(t)) for t in ("\n", "the " * 9)]
    assert sizes[0] == sum(chunks) and max(sizes[1:]) < chunks[1] and len(found[1]) == 3
    held = len(sampler.lattices.cum)
    sampler.lattices.clear()
    assert len(sampler.lattices.cum) == held and not sampler.lattices.index
    again = sampler.sample([1, 2], ["\n", "the " * 9])
    assert [[(*f[:3], f[3].tolist()) for f in own] for own in again] == [[(*f[:3], f[3].tolist()) for f in own] for own in found]
    x = np.array([0, 1, 2**64 - 1, 0x9E3779B97F4A7C15], np.uint64)
    assert [sampled_encoding.uniform_of(int(i)) for i in x] == sampled_encoding.uniform(x).tolist()
