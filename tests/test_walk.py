"""The walk over nested documents against a plain recursive one."""

from __future__ import annotations

import json
import random

import pytest
from factgraph.functions import sqlexpr as S
from factgraph.functions.variants import depth_of, walked
from factgraph.operators import extract
from pyspark.sql import functions as F


def brute(value, ref, keys=(), lists=0, at_index=False, named=False):
    if isinstance(value, str):
        return [(ref, list(keys), lists, at_index, named, value.strip(), None)] if value.strip() else []
    if isinstance(value, list):
        return [n for i, v in enumerate(value) for n in brute(v, f"{ref}[{i}]", keys, lists + 1, True, named)]
    if isinstance(value, dict):
        fields = {k: v.strip() for k, v in value.items() if isinstance(v, str) and v.strip()}
        below = named or "name" in fields
        own = [(ref, list(keys), lists, at_index, named, None, fields)]
        return own + [n for k in sorted(value) for n in brute(value[k], f"{ref}.{k}", (*keys, k), lists, False, below)]
    return []


def nesting(value):
    inner = value.values() if isinstance(value, dict) else value if isinstance(value, list) else None
    return 0 if inner is None else 1 + max(map(nesting, inner), default=0)


def documents():
    rng = random.Random(2)
    words = ["name", "a", "Z", "é", "path", " x ", "", "  ", 'q"[{', "b\\", "line\nline", "]}"]

    def make(depth):
        kind = rng.randrange(6) if depth else rng.randrange(3)
        if kind < 2:
            return rng.choice(words)
        if kind == 2:
            return rng.choice([None, True, 3, 2.5])
        if kind == 3:
            return [make(depth - 1) for _ in range(rng.randrange(4))]
        return {rng.choice(words): make(depth - 1) for _ in range(rng.randrange(4))}

    chain = "deep"
    for i in range(12):
        chain = {"k": chain} if i % 2 else [chain]
    return [*(make(4) for _ in range(150)), chain, {}, [], "", {"name": "n", "b": [{"c": "d"}]}, ["w" * 100_000] * 3]


@pytest.fixture(scope="module")
def values(spark):
    rows = list(enumerate(map(json.dumps, documents())))
    return spark.createDataFrame([*rows, (-1, None)], "id int, text string").select("id", F.parse_json("text").alias("v"))


def test_depth_counts_brackets_outside_texts(values):
    got = {r.id: r.d for r in values.select("id", depth_of(F.col("v")).alias("d")).collect()}
    assert [got[i] for i in range(len(documents()))] == [nesting(d) for d in documents()] and got[-1] is None


def test_walk_equals_recursion(values):
    rows = values
    for step in walked(S.col("v"), S.lit("base"), max(map(nesting, documents()))):
        rows = rows.select("id", "v", F.explode(F.array(step(S.col("nodes")).column())).alias("nodes"))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    rest = F.exists("nodes", lambda n: n["rest"].isNotNull())
    assert rows.filter(rest).count() == 0
    for r in rows.select("id", F.transform("nodes", lambda n: n.dropFields("rest")).alias("nodes")).collect():
        want = brute(documents()[r.id], "base") if r.id >= 0 else []
        assert [tuple(n) for n in r.nodes] == want


def test_extraction_plans_hold_no_python(spark):
    body = json.dumps({"languages": ["Py"], "integrations": "webhook", "quick_reference": {"topic": "t"}, "api_structure": {"rest": [{"a": [{"path": "/x/y"}]}]}})
    docs = spark.createDataFrame([("n", "s", "p", "2024-01-01", body)], "node_id string, shard string, path string, as_of string, body string")
    facts = extract.section_facts(extract.document_sections(docs.withColumn("body", F.parse_json("body"))))
    assert "Python" not in facts._jdf.queryExecution().executedPlan().toString()
    assert {r.object_value for r in facts.collect()} >= {"Py", "/x/y", "rest".upper(), "t"}
