"""Gates and metrics observed while tables are written, probes, sized files, keys of documents."""

from __future__ import annotations

import pytest
from factgraph.operators import keypaths
from factgraph.operators.observed import Watch, none_broken, none_of
from factgraph.operators.gates import edge_rules
from factgraph.operators.setdiff import content_hash
from factgraph.plans import build
from factgraph.sources import snapshots
from pyspark.sql import functions as F


def test_watch_sees_what_is_written(spark):
    watch = Watch()
    rows = spark.range(100).withColumn("odd", F.col("id") % 2 == 1).repartition(7)
    out = watch.staged(rows, {"n": F.count("*"), "odd": F.count_if("odd")}, small=none_of(F.col("id") > 98), plain=none_of(F.col("id") < 0), nulls=none_of(F.lit(None).cast("boolean")))
    assert out.count() == 100 and watch.values == {"n": 100, "odd": 50}
    empty = watch.staged(rows.limit(0), {"none": F.count("*")}, nothing=none_of(F.lit(True)))
    watch.holds("given", False)
    got = {r.gate: r.passed for r in watch.results(spark).collect()}
    assert empty.count() == 0 and watch.values["none"] == 0
    assert got == {"small": False, "plain": True, "nulls": True, "nothing": True, "given": False}
    edges = spark.createDataFrame([("a", "b", "repo", "depends_on", "x"), ("", "b", "repo", "depends_on", "x")], "src_id string, dst_id string, dst_kind string, relation string, as_of string")
    watch.staged(edges, rules=none_broken(edge_rules()))
    watch.staged(edges.filter("src_id <> ''"), good_rules=none_broken(edge_rules()))
    assert (watch.gates["rules"], watch.gates["good_rules"]) == (False, True)


def test_measures_equal_queries(spark):
    rows = spark.createDataFrame([(f"n{i}", f"l{i % 5}" if i % 7 else None, 0.5 * i) for i in range(300)] + [(None, "x", None)], "node_id string, label string, weight double")
    kept, found = snapshots.measured("nodes", rows.repartition(5))
    again = snapshots.measured("nodes", rows.orderBy(F.desc("node_id")).coalesce(1))[1]
    digest = content_hash(rows, sorted(rows.columns)).head()
    assert (found.rows, found.digest) == (digest["rows"], digest["digest"]) == (301, again.digest)[:1] + (digest["digest"],)
    assert found.probes == again.probes and len(found.probes) == snapshots.PROBES
    assert kept.count() == 301
    nothing = snapshots.measured("nodes", rows.limit(0))[1]
    assert (nothing.rows, nothing.digest, nothing.bytes, nothing.probes) == (0, "0", 0, [])


def test_files_follow_bytes_and_split_a_hot_key(spark, tmp_path):
    rows = spark.createDataFrame([("hot" if i % 3 else f"k{i:04d}", "v" * 50, i) for i in range(3000)], "node_id string, label string, n long")
    _, found = snapshots.measured("x", rows)
    for parts in (1, 12):
        folder = str(tmp_path / f"p{parts}")
        snapshots.sized_write(rows, folder, ["node_id"], found.bytes, target=-(-found.bytes // parts))
        read = spark.read.parquet(folder)
        files = read.groupBy(F.col("_metadata.file_path").alias("f")).agg(F.count("*").alias("n"), F.count_if(F.col("node_id") == "hot").alias("hot")).collect()
        assert read.count() == 3000 and len(files) == parts
        assert max(r.n for r in files) <= 2.5 * 3000 / parts
    assert sum(r.hot > 0 for r in files) >= 5  # two thirds of the rows hold one key


def test_empty_tables_publish(spark, tmp_path):
    tables = {
        "repos": spark.createDataFrame([("a", "n")], "node_id string, name string"),
        "nodes": spark.createDataFrame([("a", "repo")], "node_id string, kind string"),
        "edges": spark.createDataFrame([], "src_id string, dst_id string, relation string"),
        "facts": spark.createDataFrame([], "fact_id string, node_id string, predicate string"),
    }
    done = snapshots.publish(spark, str(tmp_path), tables)
    assert done.passed and {t: snapshots.read_table(spark, str(tmp_path), t).count() for t in tables} == {"repos": 1, "nodes": 1, "edges": 0, "facts": 0}
    model = build.open_model(spark, str(tmp_path))
    assert model.mode == "snapshot" and model.tables["facts"].columns == ["fact_id", "node_id", "predicate"]
    with pytest.raises(FileNotFoundError):
        build.open_model(spark, str(tmp_path / "none"))


def test_keys_at_any_depth(spark):
    deep = '{"a": ' * 9 + '{"repo": 1}' + "}" * 9
    rows = [("d", deep), ("l", '[{"repo": [[{"x.y": "t"}]]}, 3]'), ("s", '"text"'), ("n", None), ("e", "{}"), ("t", '{"repo": {}, "troubleshooting": null}')]
    docs = spark.createDataFrame(rows, "path string, j string").select("path", F.parse_json("j").alias("body"))
    keys = keypaths.key_paths(docs)
    got = {(r.path, r.key_path, r.depth, r.kind) for r in keys.collect()}
    assert ("d", "a." * 9 + "repo", 10, "BIGINT") in got and len([g for g in got if g[0] == "d"]) == 10
    assert {g for g in got if g[0] != "d"} == {
        ("l", "[].repo", 1, "ARRAY"), ("l", "[].repo[][].x.y", 2, "STRING"), ("t", "repo", 1, "OBJECT"), ("t", "troubleshooting", 1, "VOID"),
    }
    found = {(r.path, r.rule, r.key_path) for r in keypaths.key_findings(keys, keypaths.key_rules(spark)).collect()}
    assert found == {("l", "legacy_key", "[].repo"), ("t", "legacy_key", "repo"), ("t", "forbidden_section", "troubleshooting")}
    assert keypaths.key_paths(docs.limit(0)).count() == 0


def test_small_files_need_no_range_each(spark, tmp_path, monkeypatch):
    """Every file was a range, and keys sampled for each met on the driver."""
    from pyspark.sql import functions as F
    from factgraph.sources import snapshots

    monkeypatch.setattr(snapshots, "MOST_RANGES", 4)
    asked = []
    dealt = type(spark.range(1)).repartitionByRange
    monkeypatch.setattr(type(spark.range(1)), "repartitionByRange", lambda self, n, *c: asked.append(n) or dealt(self, n, *c))
    rows = spark.range(4000).selectExpr("concat('n', id % 900) AS node_id", "id AS v")
    folder = str(tmp_path / "out")
    snapshots.sized_write(rows, folder, ["node_id"], 40_000, target=1000, rows=4000)
    got = spark.read.parquet(folder)
    files = got.groupBy(F.col("_metadata.file_path").alias("f")).agg(F.count("*").alias("n"), F.min("node_id").alias("low"), F.max("node_id").alias("high")).collect()
    assert asked == [4] and got.exceptAll(rows).isEmpty() and got.count() == 4000
    assert 40 <= len(files) <= 44 and max(f.n for f in files) <= 100
    spans = sorted((f.low, f.high) for f in files)
    assert all(b[0] >= a[1] for a, b in zip(spans, spans[1:]))


def test_master_facts_are_read_from_the_files_by_record(spark, sf, monkeypatch):
    from factgraph.plans import publish_queries

    given, write = [], snapshots.write_master_facts
    monkeypatch.setattr(snapshots, "write_master_facts", lambda facts, *rest: given.append(facts) or write(facts, *rest))
    assert {r.sink for r in publish_queries.fact_files(spark, sf).collect()} == {"by record", "master"}
    assert given and all("/by-record/" in f for f in given[0].inputFiles())
