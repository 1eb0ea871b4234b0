"""Lookups, briefs, counts and traversals over the driver-table bindings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factgraph.operators import aggregates, briefs, lookup, traversal
from factgraph.plans import bindings as b
from factgraph.plans.registry import query
from factgraph.plans.sqltext import ascii_fold, fold, term_test


def joined(df: DataFrame, *columns: str) -> DataFrame:
    """Array columns as text, so that results are flat."""
    for c in columns:
        df = df.withColumn(c, F.array_join(c, "; "))
    return df


# --- pattern ----------------------------------------------------------------------

FREQUENCY_SQL = b.with_views(b.REPOS_SQL, b.FACTS_SQL) + f""",
pairs AS (
  SELECT DISTINCT object_value, r.node_id, r.name, r.full_name
  FROM facts f JOIN repos r ON f.node_id = r.node_id
  WHERE predicate = '{{predicate}}' AND object_value IS NOT NULL AND {{scope}} AND {{value}}),
scope AS (
  SELECT count(DISTINCT r.node_id) AS n FROM facts f JOIN repos r ON f.node_id = r.node_id
  WHERE predicate = '{{predicate}}' AND {{scope}}),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY object_value ORDER BY name, node_id) AS rn FROM pairs),
grouped AS (
  SELECT object_value, count(*) AS repo_count,
         string_agg(coalesce(nullif(full_name, ''), nullif(name, ''), node_id), '; ' ORDER BY rn)
           FILTER (WHERE rn <= 3) AS example_repos
  FROM ranked GROUP BY object_value ORDER BY repo_count DESC, {fold('object_value')}, object_value LIMIT {{limit}})
SELECT object_value, repo_count, example_repos, n AS scope_repo_count,
       CASE WHEN n > 0 THEN round_even(repo_count / n, 4) ELSE 0.0 END AS repo_fraction
FROM grouped, scope"""


@query(
    "pattern_frequency",
    FREQUENCY_SQL.format(
        predicate="has_failure_mode", scope=f"{ascii_fold('category')} = 'building'", value="true", limit=50
    ),
)
def pattern_frequency(spark, sf):
    out = briefs.pattern_frequency(
        b.facts(spark, sf, ["has_failure_mode"]), b.repos(spark, sf), "has_failure_mode", "Building", limit=50
    )
    return joined(out, "example_repos")


@query(
    "pattern_frequency_value",
    FREQUENCY_SQL.format(
        predicate="implements_pattern", scope="true", value=f"{ascii_fold('object_value')} LIKE '%ring%'", limit=20
    ),
)
def pattern_frequency_value(spark, sf):
    out = briefs.pattern_frequency(
        b.facts(spark, sf, ["implements_pattern"]), b.repos(spark, sf), "implements_pattern", value="RING"
    )
    return joined(out, "example_repos")


@query(
    "pattern_flat",
    b.with_views(b.REPOS_SQL, b.FACTS_SQL)
    + f"""
SELECT DISTINCT r.node_id, r.name, r.category, object_value, object_kind
FROM facts f JOIN repos r ON f.node_id = r.node_id
WHERE predicate = 'uses_protocol' AND {ascii_fold('category')} = 'machinery'
  AND {ascii_fold('object_value')} LIKE '%a_d%'
ORDER BY r.name, object_value, r.node_id, object_kind LIMIT 200""",
)
def pattern_flat(spark, sf):
    return briefs.pattern(
        b.facts(spark, sf, ["uses_protocol"]), b.repos(spark, sf), "uses_protocol", "machinery", "A_D", limit=200
    )


# --- search and lookups -----------------------------------------------------------

SEARCH_SQL = b.with_views(b.FACTS_SQL) + """
SELECT fact_id, node_id, predicate, object_kind, object_value, note FROM facts
WHERE {where} ORDER BY node_id, predicate, fact_id LIMIT {limit}"""


@query(
    "search_both",
    SEARCH_SQL.format(
        where=f"{ascii_fold('object_value')} LIKE '%widget%' OR {ascii_fold('note')} LIKE '%widget%'", limit=500
    ),
)
def search_both(spark, sf):
    return lookup.search(b.facts(spark, sf), "Widget", limit=500)


@query("search_value", SEARCH_SQL.format(where=f"{ascii_fold('object_value')} LIKE '%brand#1_%'", limit=300))
def search_value(spark, sf):
    return lookup.search(b.facts(spark, sf), "brand#1_", "object_value", 300)


@query("search_note", SEARCH_SQL.format(where=f"{ascii_fold('note')} LIKE '%r-f prom%'", limit=300))
def search_note(spark, sf):
    return lookup.search(b.facts(spark, sf), "R-F Prom", "note", 300)


@query(
    "facts_for",
    b.with_views(b.FACTS_SQL)
    + "SELECT fact_id, predicate, object_kind, object_value, note, confidence FROM facts "
    "WHERE node_id = 'repo::c7' AND predicate = 'implements_pattern'",
)
def facts_for(spark, sf):
    found = lookup.facts_for(b.facts(spark, sf), "repo::c7", "implements_pattern")
    return found.select("fact_id", "predicate", "object_kind", "object_value", "note", "confidence")


NEIGHBORS_SQL = b.with_views(b.EDGES_SQL) + "SELECT src_id, dst_id, dst_kind, relation, note FROM edges WHERE "


@query("neighbors_both", NEIGHBORS_SQL + "src_id = 'concept::n3' OR dst_id = 'concept::n3'")
def neighbors_both(spark, sf):
    found = lookup.neighbors(b.edges(spark, sf), "concept::n3")
    return found.select("src_id", "dst_id", "dst_kind", "relation", "note")


@query("neighbors_in_relation", NEIGHBORS_SQL + "dst_id = 'repo::c4' AND relation = 'placed_by'")
def neighbors_in_relation(spark, sf):
    found = lookup.neighbors(b.edges(spark, sf), "repo::c4", "in", "placed_by")
    return found.select("src_id", "dst_id", "dst_kind", "relation", "note")


def _requests(spark, sf):
    """One identifier per order, cycling through the ways to name a customer."""
    key = F.col("o_custkey").cast("string")
    ways = [
        F.concat(F.lit("repo::c"), key),
        F.concat(F.lit("Customer#"), F.lpad(key, 9, "0")),
        F.upper(F.concat(F.lit("customer#"), F.lpad(key, 9, "0"))),
        F.concat(F.lit("owner3/c"), key),
        F.concat(F.lit("no such "), key),
    ]
    pick = F.element_at(F.array(*ways), (F.col("o_orderkey") % 5 + 1).cast("int"))
    return b.table(spark, sf, "orders").select(pick.alias("identifier"))


REQUESTS_SQL = """
requests AS (
  SELECT DISTINCT CASE o_orderkey % 5
    WHEN 0 THEN 'repo::c' || o_custkey WHEN 1 THEN 'Customer#' || lpad(o_custkey::VARCHAR, 9, '0')
    WHEN 2 THEN upper('customer#' || lpad(o_custkey::VARCHAR, 9, '0'))
    WHEN 3 THEN 'owner3/c' || o_custkey ELSE 'no such ' || o_custkey END AS identifier
  FROM orders)"""


@query(
    "identifier_resolution",
    b.with_views(b.REPOS_SQL, REQUESTS_SQL)
    + f""",
hits AS (
  SELECT identifier, 1 AS rank, ordinal AS turn, node_id FROM requests JOIN repos ON identifier = node_id
  UNION ALL SELECT identifier, 2, -ordinal, node_id FROM requests JOIN repos ON identifier = name
  UNION ALL SELECT identifier, 3, -ordinal, node_id FROM requests JOIN repos ON identifier = full_name
  UNION ALL SELECT identifier, 4, ordinal, node_id FROM requests JOIN repos ON {fold('identifier')} = {fold('name')}
  UNION ALL SELECT identifier, 5, ordinal, node_id
  FROM requests JOIN repos ON {fold('identifier')} = {fold('full_name')}),
best AS (
  SELECT *, row_number() OVER (PARTITION BY identifier ORDER BY rank, turn, node_id) AS rn FROM hits)
SELECT q.identifier, best.node_id FROM requests q LEFT JOIN best ON q.identifier = best.identifier AND rn = 1""",
)
def identifier_resolution(spark, sf):
    return lookup.resolve_identifiers(_requests(spark, sf), b.repos(spark, sf))


@query(
    "repo_records",
    b.with_views(b.REPOS_SQL, REQUESTS_SQL)
    + f""",
hits AS (
  SELECT identifier, 1 AS rank, node_id FROM requests JOIN repos ON identifier = node_id
  UNION ALL SELECT identifier, 2, node_id FROM requests JOIN repos ON {ascii_fold('identifier')} = {ascii_fold('name')}
  UNION ALL SELECT identifier, 2, node_id
  FROM requests JOIN repos ON {ascii_fold('identifier')} = {ascii_fold('full_name')}),
best AS (SELECT *, row_number() OVER (PARTITION BY identifier ORDER BY rank, node_id) AS rn FROM hits)
SELECT q.identifier, r.node_id, r.name, r.full_name, r.category, r.node_id IS NOT NULL AS found
FROM requests q LEFT JOIN best ON q.identifier = best.identifier AND rn = 1
LEFT JOIN repos r ON best.node_id = r.node_id""",
)
def repo_records(spark, sf):
    found = lookup.repo_records(_requests(spark, sf), b.repos(spark, sf))
    return found.select("identifier", "node_id", "name", "full_name", "category", "found")


# --- counts -----------------------------------------------------------------------


@query(
    "stats",
    b.with_views(b.REPOS_SQL, b.FACTS_SQL, b.EDGES_SQL, b.NODES_SQL)
    + """
SELECT 'repos' AS "table", count(*) AS n FROM repos UNION ALL SELECT 'nodes', count(*) FROM nodes
UNION ALL SELECT 'edges', count(*) FROM edges UNION ALL SELECT 'deep_facts', count(*) FROM facts""",
)
def stats(spark, sf):
    return aggregates.stats(
        {
            "repos": b.repos(spark, sf),
            "nodes": b.nodes(spark, sf),
            "edges": b.edges(spark, sf),
            "deep_facts": b.facts(spark, sf),
        }
    )


GROUP_SQL = """
, grouped AS (SELECT {key} AS key, count(*) AS count FROM {source} GROUP BY 1)
SELECT key, count, (SELECT count(*) FROM grouped) AS total_groups FROM grouped
ORDER BY count DESC, key NULLS FIRST LIMIT {top}"""


@query("aggregate_predicate", b.with_views(b.FACTS_SQL) + GROUP_SQL.format(key="predicate", source="facts", top=3))
def aggregate_predicate(spark, sf):
    return aggregates.group_counts(b.facts(spark, sf), "predicate", 3)


@query("aggregate_fact_type", b.with_views(b.FACTS_SQL) + GROUP_SQL.format(key="fact_type", source="facts", top=20))
def aggregate_fact_type(spark, sf):
    return aggregates.group_counts(b.facts(spark, sf), "fact_type")


@query("aggregate_object_kind", b.with_views(b.FACTS_SQL) + GROUP_SQL.format(key="object_kind", source="facts", top=20))
def aggregate_object_kind(spark, sf):
    return aggregates.group_counts(b.facts(spark, sf), "object_kind")


@query("aggregate_relation", b.with_views(b.EDGES_SQL) + GROUP_SQL.format(key="relation", source="edges", top=20))
def aggregate_relation(spark, sf):
    return aggregates.group_counts(b.edges(spark, sf), "relation")


@query(
    "aggregate_category",
    b.with_views(b.REPOS_SQL, b.FACTS_SQL)
    + """,
fc AS (SELECT category, count(*) AS n FROM facts f JOIN repos r ON f.node_id = r.node_id GROUP BY 1),
rc AS (SELECT category, count(*) AS count FROM repos GROUP BY 1)
SELECT rc.category AS key, count, coalesce(fc.n, 0) AS fact_count, (SELECT count(*) FROM rc) AS total_groups
FROM rc LEFT JOIN fc ON rc.category = fc.category ORDER BY count DESC, key NULLS FIRST LIMIT 4""",
)
def aggregate_category(spark, sf):
    return aggregates.category_counts(b.repos(spark, sf), b.facts(spark, sf), 4)


@query(
    "category_shard_counts",
    b.with_views(b.REPOS_SQL) + "SELECT category, shard, count(*) AS n FROM repos GROUP BY 1, 2",
)
def category_shard_counts(spark, sf):
    return aggregates.counts_by(b.repos(spark, sf), "category", "shard")


@query(
    "scope_counts",
    b.with_views(b.REPOS_SQL, b.FACTS_SQL)
    + f"""
SELECT count(DISTINCT r.node_id) AS scope_repo_count FROM facts f JOIN repos r ON f.node_id = r.node_id
WHERE predicate = 'has_component' AND {ascii_fold('category')} = 'automobile'""",
)
def scope_counts(spark, sf):
    return briefs.scope_repo_count(
        b.facts(spark, sf, ["has_component"]), b.repos(spark, sf), "has_component", "Automobile"
    )


@query(
    "field_presence",
    b.with_views(b.REPOS_SQL)
    + "".join(
        ("" if i == 0 else " UNION ALL ")
        + f"SELECT shard, '{f}' AS field, count(*) AS total, count(nullif(trim({f}), '')) AS present, "
        f"round_even(count(nullif(trim({f}), '')) / count(*) * 100.0, 3) AS present_pct FROM repos GROUP BY shard"
        for i, f in enumerate(["name", "full_name", "category", "summary"])
    ),
)
def field_presence(spark, sf):
    return aggregates.field_presence(b.repos(spark, sf), ["shard"], ["name", "full_name", "category", "summary"])


@query(
    "snapshot_time",
    "SELECT strftime(greatest((SELECT max(o_orderdate) FROM orders), TIMESTAMP '2024-02-28', "
    "(SELECT max(l_shipdate) FROM lineitem)), '%Y-%m-%dT%H:%M:%SZ') AS generated_at_utc",
)
def snapshot_time(spark, sf):
    return aggregates.snapshot_time(b.repos(spark, sf), b.edges(spark, sf), b.facts(spark, sf, ["implements_pattern"]))


@query(
    "snapshot_skew",
    """
WITH sources AS (
  SELECT max(o_orderdate) AS ts FROM orders UNION ALL SELECT max(l_shipdate) FROM lineitem
  UNION ALL SELECT max(date_trunc('second', ts)) FROM events)
SELECT CAST(epoch(max(ts)) - epoch(min(ts)) AS BIGINT) AS skew_seconds,
       epoch(max(ts)) - epoch(min(ts)) > 300 AS warning FROM sources""",
)
def snapshot_skew(spark, sf):
    def newest(name, column):
        text = F.date_format(F.max(column), "yyyy-MM-dd'T'HH:mm:ss'Z'")
        return b.table(spark, sf, name).agg(text.alias("generated_at_utc"))

    sources = newest("orders", "o_orderdate").unionByName(newest("lineitem", "l_shipdate"))
    return aggregates.snapshot_skew(sources.unionByName(newest("events", "ts")))


# --- briefs -----------------------------------------------------------------------


def _failure_sql(category: str, terms: list[str], limit: int) -> str:
    hits = " UNION ALL ".join(
        f"SELECT {i} AS term_no, '{t}' AS term, * FROM rows WHERE "
        + term_test(t, ["object_value", "note"], briefs.TERM_ALIASES.get(t, ()))
        for i, t in enumerate(terms)
    )
    return f""",
rows AS (
  SELECT DISTINCT r.node_id, r.name, r.full_name, object_value, note FROM facts f JOIN repos r ON f.node_id = r.node_id
  WHERE predicate = 'has_failure_mode' AND {ascii_fold('category')} = '{category}' AND object_value IS NOT NULL),
fscope AS (SELECT count(DISTINCT node_id) AS n FROM rows),
hits AS ({hits}),
counts AS (SELECT term_no, term, object_value, count(DISTINCT node_id) AS repo_count FROM hits GROUP BY 1, 2, 3),
top AS (
  SELECT *, row_number() OVER (PARTITION BY term_no ORDER BY repo_count DESC, {fold('object_value')}, object_value)
    AS rank FROM counts QUALIFY rank <= {limit}),
records AS (SELECT DISTINCT term_no, object_value, node_id, name, full_name FROM hits),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY term_no, object_value ORDER BY name, node_id) AS rn FROM records),
examples AS (
  SELECT term_no, object_value, string_agg(coalesce(nullif(full_name, ''), name), '; ' ORDER BY rn) AS example_repos
  FROM ranked WHERE rn <= 3 GROUP BY 1, 2),
cuts AS (
  SELECT term_no, object_value, trim(note) AS cut, min((name, node_id, note)) AS first
  FROM hits WHERE note <> '' GROUP BY 1, 2, 3),
cutrank AS (SELECT *, row_number() OVER (PARTITION BY term_no, object_value ORDER BY first, cut) AS rn FROM cuts),
notes AS (
  SELECT term_no, object_value, string_agg(cut, '; ' ORDER BY rn) AS evidence_notes
  FROM cutrank WHERE rn <= 2 GROUP BY 1, 2),
brief AS (
  SELECT t.term_no, t.term, t.rank, t.object_value AS failure_mode, t.repo_count,
         round_even(t.repo_count / n, 4) AS repo_fraction, example_repos,
         coalesce(evidence_notes, '') AS evidence_notes, n AS scope_repo_count
  FROM top t JOIN examples e ON t.term_no = e.term_no AND t.object_value = e.object_value
  LEFT JOIN notes o ON t.term_no = o.term_no AND t.object_value = o.object_value, fscope)"""


@query(
    "preflight",
    b.with_views(b.REPOS_SQL, b.FACTS_SQL) + _failure_sql("household", ["", "SMALL Ring", "r-f.", "zzz"], 10)
    + " SELECT * FROM brief",
)
def preflight(spark, sf):
    out = briefs.failure_brief(
        b.facts(spark, sf, ["has_failure_mode"]), b.repos(spark, sf), "HOUSEHOLD", ["", "SMALL Ring", "r-f.", "zzz"], 10
    )
    return joined(out, "example_repos", "evidence_notes")


@query(
    "preflight_reliability",
    b.with_views(b.REPOS_SQL, b.FACTS_SQL)
    + f""",
s AS (SELECT count(DISTINCT r.node_id) AS n FROM facts f JOIN repos r ON f.node_id = r.node_id
      WHERE predicate = 'has_failure_mode' AND {ascii_fold('category')} = 'furniture')
SELECT n AS scope_repo_count, CASE WHEN n <= 0 THEN 'empty' WHEN n < 5 THEN 'thin' ELSE 'normal' END AS scope_assessment,
       CASE WHEN n <= 0 THEN '{briefs.EMPTY_NOTE}' WHEN n < 5 THEN '{briefs.THIN_NOTE}' END AS note FROM s""",
)
def preflight_reliability(spark, sf):
    return briefs.failure_reliability(b.facts(spark, sf, ["has_failure_mode"]), b.repos(spark, sf), "furniture")


RISK = {
    "patterns": ["red widget", "BOLT", "quantum drive"],
    "components": ["brand 1", "Brand#7", "Brand#23"],
    "protocols": ["standard", "promo", "gRPC"],
}


def _risk_sql(category: str) -> str:
    asked = [("pattern", t) for t in RISK["patterns"]] + [("component", t) for t in RISK["components"]]
    asked += [("protocol", t) for t in RISK["protocols"]]
    predicates = briefs.SIGNAL_PREDICATES
    values = ", ".join(f"({i}, '{k}', '{t}', '{predicates[k]}', '{fold_py(t)}')" for i, (k, t) in enumerate(asked))
    hits = " UNION ALL ".join(
        f"SELECT {i} AS pos, * FROM srows WHERE predicate = '{predicates[k]}' AND " + term_test(t, ["object_value"])
        for i, (k, t) in enumerate(asked)
    )
    return f""",
signals(pos, input_kind, input_term, predicate, folded) AS (VALUES {values}),
members AS (SELECT * FROM repos WHERE {ascii_fold('category')} = '{category}'),
srows AS (
  SELECT DISTINCT predicate, r.node_id, name, full_name, object_value FROM facts f JOIN members r ON f.node_id = r.node_id
  WHERE (predicate IN ('implements_pattern', 'uses_protocol') OR (predicate = 'has_component' AND object_kind <> 'path'))
    AND object_value IS NOT NULL),
shits AS ({hits}),
per_repo AS (SELECT pos, node_id, name, full_name, min(object_value) AS v FROM shits GROUP BY 1, 2, 3, 4),
ex AS (
  SELECT *, row_number() OVER (PARTITION BY pos ORDER BY name, v, node_id) AS rn FROM per_repo),
c AS (
  SELECT pos, count(*) AS matched_repo_count,
         string_agg(coalesce(nullif(full_name, ''), name), '; ' ORDER BY rn) FILTER (WHERE rn <= 3) AS example_repos
  FROM ex GROUP BY pos),
pv AS (
  SELECT pos, object_value, row_number() OVER (PARTITION BY pos ORDER BY min(name), object_value) AS rn
  FROM shits GROUP BY pos, object_value),
v AS (
  SELECT pos, string_agg(object_value, '; ' ORDER BY rn) AS matched_values FROM pv WHERE rn <= 3 GROUP BY pos),
scored AS (
  SELECT s.pos, input_kind, input_term, predicate, folded, coalesce(matched_repo_count, 0) AS matched_repo_count,
         coalesce(round_even(matched_repo_count / (SELECT count(*) FROM members), 4), 0.0) AS matched_repo_fraction,
         coalesce(matched_values, '') AS matched_values, coalesce(example_repos, '') AS example_repos,
         (SELECT count(*) FROM members) AS scope_repo_count
  FROM signals s LEFT JOIN c ON s.pos = c.pos LEFT JOIN v ON s.pos = v.pos),
risk AS (
  SELECT *, CASE WHEN matched_repo_count = 0 THEN 'absent'
                 WHEN matched_repo_count >= 2 AND matched_repo_fraction >= 0.2 THEN 'established' ELSE 'rare' END AS bucket
  FROM scored),
cut AS (
  SELECT * FROM risk
  ORDER BY CASE bucket WHEN 'established' THEN 1 WHEN 'rare' THEN 2 ELSE 3 END, matched_repo_count DESC, folded, pos
  LIMIT {{limit}})"""


def fold_py(term: str) -> str:
    return term.lower().replace("ß", "ss")


RISK_COLUMNS = (
    "pos, bucket, input_kind, input_term, predicate, matched_repo_count, matched_repo_fraction, "
    "matched_values, example_repos, scope_repo_count"
)
RISK_PREDICATES = ["implements_pattern", "has_component", "uses_protocol"]


@query(
    "riskcheck",
    b.with_views(b.REPOS_SQL, b.FACTS_SQL) + _risk_sql("building").format(limit=100) + f"SELECT {RISK_COLUMNS} FROM cut",
)
def riskcheck(spark, sf):
    out = briefs.riskcheck(b.facts(spark, sf, RISK_PREDICATES), b.repos(spark, sf), "building", **RISK)
    return joined(out, "matched_values", "example_repos")


@query(
    "riskcheck_counts",
    b.with_views(b.REPOS_SQL, b.FACTS_SQL)
    + _risk_sql("machinery").format(limit=5)
    + """
SELECT count(*) FILTER (WHERE bucket = 'established') AS established_in_category,
       count(*) FILTER (WHERE bucket = 'rare') AS rare_in_category,
       count(*) FILTER (WHERE bucket = 'absent') AS absent_from_category FROM cut""",
)
def riskcheck_counts(spark, sf):
    out = briefs.riskcheck(b.facts(spark, sf, RISK_PREDICATES), b.repos(spark, sf), "Machinery", **RISK, limit=5)
    return briefs.riskcheck_counts(out)


@query(
    "riskcheck_preflight",
    b.with_views(b.REPOS_SQL, b.FACTS_SQL)
    + _risk_sql("building").format(limit=100)
    + _failure_sql("building", [t for terms in RISK.values() for t in terms], 3)
    + """,
warn AS (
  SELECT term, string_agg(failure_mode || '=' || repo_count, '; ' ORDER BY rank) AS warnings FROM brief GROUP BY term)
SELECT input_kind, input_term, bucket, CASE WHEN bucket <> 'established' THEN coalesce(warnings, '') END AS warnings
FROM cut LEFT JOIN warn ON input_term = term""",
)
def riskcheck_preflight(spark, sf):
    out = briefs.riskcheck(b.facts(spark, sf), b.repos(spark, sf), "building", **RISK, preflight=True)
    shown = F.transform(
        "preflight_warnings", lambda w: F.concat(w["failure_mode"], F.lit("="), w["repo_count"].cast("string"))
    )
    return out.select("input_kind", "input_term", "bucket", F.array_join(shown, "; ").alias("warnings"))


@query(
    "corpus_health",
    b.with_views(b.REPOS_SQL, b.FACTS_SQL)
    + f"""
SELECT (SELECT count(*) FROM repos WHERE {ascii_fold('category')} = 'building') AS scope_repo_count,
       count(*) AS fact_count_in_scope
FROM facts f JOIN repos r ON f.node_id = r.node_id
WHERE {ascii_fold('category')} = 'building'
  AND (predicate IN ('implements_pattern', 'uses_protocol') OR (predicate = 'has_component' AND object_kind <> 'path'))""",
)
def corpus_health(spark, sf):
    return briefs.corpus_health(b.facts(spark, sf, RISK_PREDICATES), b.repos(spark, sf), "building")


# --- traversal --------------------------------------------------------------------


def _walk_sql(starts: str, ways: str, relation: str = "true") -> str:
    """Three hops written out: levels d0..d3, hop edges e1..e3."""
    text = b.with_views(b.EDGES_SQL, b.NODES_SQL) + f""",
steps AS ({ways.format(where=relation)}),
d0 AS ({starts})"""
    for h in (1, 2, 3):
        seen = " UNION ALL ".join(f"SELECT start_id, node_id FROM d{i}" for i in range(h))
        text += f""",
e{h} AS (
  SELECT start_id, {h} AS hop, src_id, dst_id, relation, min(note) AS note
  FROM d{h - 1} JOIN steps USING (node_id) GROUP BY 1, 2, 3, 4, 5),
d{h} AS (
  SELECT DISTINCT start_id, neighbor AS node_id FROM d{h - 1} JOIN steps USING (node_id)
  EXCEPT (SELECT * FROM ({seen})))"""
    return text


BOTH_WAYS = """
  SELECT src_id AS node_id, dst_id AS neighbor, * FROM edges WHERE {where}
  UNION ALL SELECT dst_id, src_id, * FROM edges WHERE {where}"""
IN_WAY = "SELECT dst_id AS node_id, src_id AS neighbor, * FROM edges WHERE {where}"
CUSTOMER_START = "SELECT node_id AS start_id, node_id FROM nodes WHERE label = 'Customer#000000005'"
REGION_STARTS = "SELECT node_id AS start_id, node_id FROM nodes WHERE kind = 'external_tool'"


def _from_customer(spark, sf):
    starts = b.nodes(spark, sf).filter("label = 'Customer#000000005'").select(F.col("node_id").alias("start_id"))
    return traversal.traverse(starts, b.edges(spark, sf))


def _into_regions(spark, sf):
    starts = b.nodes(spark, sf).filter("kind = 'external_tool'").select(F.col("node_id").alias("start_id"))
    return traversal.traverse(starts, b.edges(spark, sf), direction="in")


ALL_EDGES = "SELECT * FROM e1 UNION ALL SELECT * FROM e2 UNION ALL SELECT * FROM e3"


@query("graph_edges", _walk_sql(CUSTOMER_START, BOTH_WAYS) + ALL_EDGES)
def graph_edges(spark, sf):
    return _from_customer(spark, sf).edges


@query(
    "graph_nodes",
    _walk_sql(CUSTOMER_START, BOTH_WAYS)
    + """,
reached AS (SELECT *, 1 AS hop FROM d1 UNION ALL SELECT *, 2 FROM d2 UNION ALL SELECT *, 3 FROM d3)
SELECT start_id, node_id, hop, kind, label FROM reached JOIN nodes USING (node_id)""",
)
def graph_nodes(spark, sf):
    return _from_customer(spark, sf).details(b.nodes(spark, sf))


@query(
    "graph_layers",
    _walk_sql(REGION_STARTS, IN_WAY)
    + "".join(
        (" UNION ALL " if h > 1 else "")
        + f"""SELECT f.start_id, {h} AS hop, coalesce(e, 0) AS edges_found, coalesce(n, 0) AS new_nodes
FROM (SELECT DISTINCT start_id FROM d{h - 1}) f
LEFT JOIN (SELECT start_id, count(*) AS e FROM e{h} GROUP BY 1) x ON f.start_id = x.start_id
LEFT JOIN (SELECT start_id, count(*) AS n FROM d{h} GROUP BY 1) y ON f.start_id = y.start_id"""
        for h in (1, 2, 3)
    ),
)
def graph_layers(spark, sf):
    return _into_regions(spark, sf).layers


@query(
    "graph_summary",
    _walk_sql(REGION_STARTS, IN_WAY)
    + """,
reached AS (SELECT * FROM d1 UNION ALL SELECT * FROM d2 UNION ALL SELECT * FROM d3),
walked AS (SELECT start_id FROM e1 UNION ALL SELECT start_id FROM e2 UNION ALL SELECT start_id FROM e3)
SELECT start_id, (SELECT count(*) FROM reached r WHERE r.start_id = d0.start_id) AS nodes_reached,
       (SELECT count(*) FROM walked w WHERE w.start_id = d0.start_id) AS edges_traversed FROM d0""",
)
def graph_summary(spark, sf):
    return _into_regions(spark, sf).summary()


@query(
    "graph_relation_out",
    _walk_sql("SELECT node_id AS start_id, node_id FROM nodes WHERE kind = 'repo'",
              "SELECT src_id AS node_id, dst_id AS neighbor, * FROM edges WHERE {where}", "relation = 'located_in'")
    + ALL_EDGES,
)
def graph_relation_out(spark, sf):
    starts = b.nodes(spark, sf, ["repo"]).select(F.col("node_id").alias("start_id"))
    return traversal.traverse(starts, b.edges(spark, sf), relation="located_in", direction="out").edges
