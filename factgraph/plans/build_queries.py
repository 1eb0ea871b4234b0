"""Consolidation, graph tables, gates, hashes and audits over the bindings."""

from __future__ import annotations

from pyspark.sql import functions as F

from factgraph.operators import aggregates, audit, consolidate, gates, graph_tables, setdiff
from factgraph.plans import bindings as b
from factgraph.plans.read_queries import joined
from factgraph.plans.registry import query

# --- candidates -------------------------------------------------------------------


def candidates(spark, sf):
    """Order lines as derived facts; returned lines as drafts."""
    draft = F.col("l_returnflag") == "R"
    tool = F.col("p_brand") == "Brand#7"
    lines = (
        b.table(spark, sf, "lineitem")
        .join(b.table(spark, sf, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(b.table(spark, sf, "part").select("p_partkey", "p_name", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    )

    def padded(col, size):
        return F.lpad(F.col(col).cast("string") if isinstance(col, str) else col.cast("string"), size, "0")

    file = F.concat(F.lit("file"), F.col("l_suppkey") % 10)
    line = F.col("l_linenumber")
    none_text, none_int = F.lit(None).cast("string"), F.lit(None).cast("int")

    def item(kind, ref, start):
        return F.struct(
            F.lit(kind).alias("kind"), ref.alias("ref"), file.alias("source_file"), none_text.alias("excerpt"),
            start.alias("start_line"), none_int.alias("end_line"),
        )

    first = item("file_line", F.concat(F.lit("line "), line), line)
    second = item("file_block", F.col("p_name"), none_int)
    return lines.select(
        F.concat(F.lit("repo::c"), "o_custkey").alias("node_id"),
        F.lit("implementation_pattern").alias("fact_type"),
        F.lit("implements_pattern").alias("predicate"),
        F.when(tool, "external_tool").otherwise("concept").alias("object_kind"),
        F.when(~tool, F.col("p_name")).alias("object_value"),
        F.when(tool, F.concat(F.lit("external_tool::"), "p_brand")).alias("object_node_id"),
        F.when(draft, F.concat(F.lit("draft "), line)).otherwise(F.concat(F.lit("status "), "l_linestatus")).alias("note"),
        F.when(draft, 0.9).otherwise(0.8).alias("confidence"),
        F.date_format("l_shipdate", "yyyy").alias("as_of"),
        file.alias("source_file"),
        F.lit("code_patterns").alias("source_section"),
        F.when(draft, "draft").otherwise("derived").alias("extraction_mode"),
        F.when(draft, F.array(first, second)).otherwise(F.array(first)).alias("evidence"),
        F.concat(
            padded("l_orderkey", 12), padded("l_linenumber", 4), padded("l_partkey", 12), padded("l_suppkey", 10),
            F.date_format("l_shipdate", "yyyyMMdd"), padded(F.round(F.col("l_extendedprice") * 100).cast("bigint"), 14),
            padded(F.col("l_quantity").cast("int"), 4),
        ).alias("pos"),
    )


SEP = "chr(31)"
CANDIDATES_SQL = """
cands AS (
  SELECT 'repo::c' || o_custkey AS node_id, 'implementation_pattern' AS fact_type, 'implements_pattern' AS predicate,
         CASE WHEN p_brand = 'Brand#7' THEN 'external_tool' ELSE 'concept' END AS object_kind,
         CASE WHEN p_brand <> 'Brand#7' THEN p_name END AS object_value,
         CASE WHEN p_brand = 'Brand#7' THEN 'external_tool::' || p_brand END AS object_node_id,
         CASE WHEN l_returnflag = 'R' THEN 'draft ' || l_linenumber ELSE 'status ' || l_linestatus END AS note,
         CASE WHEN l_returnflag = 'R' THEN 0.9 ELSE 0.8 END AS confidence, strftime(l_shipdate, '%Y') AS as_of,
         'file' || (l_suppkey % 10) AS source_file, 'code_patterns' AS source_section,
         CASE WHEN l_returnflag = 'R' THEN 'draft' ELSE 'derived' END AS mode, l_linenumber, p_name,
         lpad(l_orderkey::VARCHAR, 12, '0') || lpad(l_linenumber::VARCHAR, 4, '0') || lpad(l_partkey::VARCHAR, 12, '0')
           || lpad(l_suppkey::VARCHAR, 10, '0') || strftime(l_shipdate, '%Y%m%d')
           || lpad(CAST(round(l_extendedprice * 100) AS BIGINT)::VARCHAR, 14, '0')
           || lpad(CAST(l_quantity AS INT)::VARCHAR, 4, '0') AS pos
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
keyed AS (
  SELECT *, CASE WHEN object_kind = 'external_tool' THEN object_node_id ELSE object_value END AS okey,
         concat_ws('~', node_id, object_kind, okey) AS ckey, concat_ws('~', ckey, note, as_of, mode) AS mkey FROM cands),
merged AS (
  SELECT mkey, ckey, count(*) AS copies, min(pos) AS pos, arg_min(source_file, pos) AS source_file
  FROM keyed WHERE mode = 'derived' GROUP BY 1, 2),
slots AS (SELECT ckey, arg_max(mkey, pos) AS mkey FROM merged GROUP BY 1),
dkeys AS (SELECT ckey, min(pos) AS first_draft, max(pos) AS last_draft FROM keyed WHERE mode = 'draft' GROUP BY 1),
final AS (
  SELECT k.*, m.copies FROM merged m JOIN keyed k ON m.pos = k.pos
  WHERE m.mkey NOT IN (SELECT s.mkey FROM slots s JOIN dkeys USING (ckey))
  UNION ALL SELECT k.*, 1 FROM dkeys d JOIN keyed k ON d.last_draft = k.pos),
items AS (
  SELECT DISTINCT f.mkey, 'file_line' AS kind, 'line ' || k.l_linenumber AS ref, k.source_file, k.l_linenumber AS start_line
  FROM final f JOIN keyed k ON f.mkey = k.mkey AND (f.mode = 'derived' OR f.pos = k.pos)
  UNION ALL SELECT mkey, 'file_block', p_name, source_file, NULL FROM final WHERE mode = 'draft'),
proof AS (
  SELECT mkey, count(*) AS evidence_count,
         sum(('0x' || substr(sha256(concat_ws(chr(31), kind, ref, source_file, '', coalesce(start_line, 0), 0)), 1, 15))
             ::BIGINT)::HUGEINT AS evidence_digest FROM items GROUP BY 1),
facts AS (
  SELECT f.*, evidence_count, evidence_digest,
         'fact::' || substr(sha256(concat_ws(chr(31), node_id, fact_type, predicate, object_kind,
           coalesce(object_value, ''), coalesce(object_node_id, ''), note,
           CAST(round(confidence * 1000000) AS BIGINT), as_of, source_file, source_section, mode, evidence_count,
           evidence_digest)), 1, 24) AS fact_id
  FROM final f JOIN proof USING (mkey)),
ledger AS (
  SELECT 'duplicate_derived_merged' AS reason, k.* FROM keyed k JOIN merged m ON k.mkey = m.mkey AND k.pos > m.pos
  WHERE k.mode = 'derived'
  UNION ALL SELECT 'draft_precedence_override', k.* FROM keyed k JOIN dkeys d USING (ckey)
  LEFT JOIN slots s USING (ckey) WHERE k.mode = 'draft' AND (s.mkey IS NOT NULL OR k.pos > d.first_draft))"""


@query(
    "consolidated_facts",
    b.with_views(CANDIDATES_SQL)
    + """SELECT fact_id, node_id, object_kind, object_value, object_node_id, note, confidence, as_of, source_file,
mode AS extraction_mode, copies, evidence_count, evidence_digest::VARCHAR AS evidence_digest FROM facts""",
)
def consolidated_facts(spark, sf):
    return consolidate.consolidate(candidates(spark, sf)).facts.select(
        "fact_id", "node_id", "object_kind", "object_value", "object_node_id", "note", "confidence", "as_of",
        "source_file", "extraction_mode", "copies", "evidence_count", F.col("evidence_digest").cast("string"),
    )


@query(
    "consolidated_evidence",
    b.with_views(CANDIDATES_SQL)
    + "SELECT fact_id, i.kind, i.ref, i.source_file, i.start_line FROM facts JOIN items i USING (mkey)",
)
def consolidated_evidence(spark, sf):
    # A low threshold here sends the busiest keys down the path made for hot ones.
    result = consolidate.consolidate(candidates(spark, sf), hot_rows=5)
    return result.evidence.select("fact_id", "kind", "ref", "source_file", "start_line")


@query(
    "dropped_facts",
    b.with_views(CANDIDATES_SQL)
    + "SELECT reason, node_id, source_file, object_kind, okey AS object, pos FROM ledger",
)
def dropped_facts(spark, sf):
    ledger = consolidate.consolidate(candidates(spark, sf)).ledger
    return ledger.select("reason", "node_id", "source_file", "object_kind", "object", "pos")


@query(
    "consolidation_summary",
    b.with_views(CANDIDATES_SQL)
    + """SELECT count(*) AS total_facts, count(DISTINCT node_id) AS repos_with_facts,
(SELECT count(*) FROM ledger WHERE reason = 'draft_precedence_override') AS draft_overrides,
(SELECT count(*) FROM ledger WHERE reason = 'duplicate_derived_merged') AS derived_dedupe_merges FROM facts""",
)
def consolidation_summary(spark, sf):
    return consolidate.consolidation_summary(consolidate.consolidate(candidates(spark, sf)))


BEST_SQL = b.with_views(b.FACTS_SQL) + """,
best AS (
  SELECT * FROM facts
  QUALIFY row_number() OVER (PARTITION BY source_file, predicate, object_value ORDER BY confidence DESC, position) = 1)"""


@query("best_confidence", BEST_SQL + "SELECT fact_id, source_file, predicate, object_value, confidence FROM best")
def best_confidence(spark, sf):
    facts = b.facts(spark, sf).withColumnRenamed("position", "pos")
    best = consolidate.best_confidence(facts)
    return best.select("fact_id", "source_file", "predicate", "object_value", "confidence")


@query(
    "best_confidence_report",
    BEST_SQL
    + """,
n AS (SELECT source_file, count(*) AS before FROM facts GROUP BY 1),
k AS (SELECT source_file, count(*) AS after FROM best GROUP BY 1)
SELECT source_file, before, after, before - after AS removed FROM n JOIN k USING (source_file)""",
)
def best_confidence_report(spark, sf):
    facts = b.facts(spark, sf).withColumnRenamed("position", "pos")
    return consolidate.best_confidence_report(facts, consolidate.best_confidence(facts))


@query(
    "fact_quality",
    "SELECT count(*) AS facts, 100.0 AS evidence_coverage_pct, 100.0 AS confidence_coverage_pct FROM lineitem",
)
def fact_quality(spark, sf):
    return aggregates.fact_quality(candidates(spark, sf))


# --- graph tables -----------------------------------------------------------------


def raw_edges(spark, sf):
    """The edge view with the older key for one source and an unusable row kind."""
    old = F.col("shard") == "nation"
    return (
        b.edges(spark, sf)
        .withColumn("type", F.when(old, F.col("relation")))
        .withColumn("relation", F.when(~old, F.col("relation")))
        .withColumn("dst_kind", F.when(F.col("note") == "5-LOW", "order").otherwise(F.col("dst_kind")))
        .withColumn("source_relation", F.lit(None).cast("string"))
    )


def mapping(spark, sf):
    """Mapping rows for the labels the edges show, one label left unmapped."""
    label = F.col("observed_label")
    return (
        graph_tables.observed_relations(raw_edges(spark, sf))
        .filter(label != "placed_by")
        .withColumn("canonical_relation", F.when(label == "part_of", "extends").otherwise("related_to"))
    )


CANON_SQL = b.with_views(b.EDGES_SQL) + """,
canon AS (
  SELECT src_id, dst_id, CASE WHEN note = '5-LOW' THEN 'order' ELSE dst_kind END AS dst_kind,
         CASE relation WHEN 'part_of' THEN 'extends' WHEN 'located_in' THEN 'related_to' ELSE relation END AS relation,
         nullif(note, '') AS note, as_of, shard, source_file, relation AS source_relation, source_edge_index,
         relation = 'placed_by' AS unmapped, CASE WHEN note = '5-LOW' THEN 'invalid dst_kind ''order''' ELSE '' END AS errors
  FROM edges)"""


@query("canonical_edges", CANON_SQL + "SELECT * FROM canon")
def canonical_edges(spark, sf):
    out = graph_tables.canonical_edges(raw_edges(spark, sf), mapping(spark, sf))
    return joined(out.drop("observed_relation"), "errors")


@query("observed_relations", b.with_views(b.EDGES_SQL) + "SELECT DISTINCT shard, relation AS observed_label FROM edges")
def observed_relations(spark, sf):
    return graph_tables.observed_relations(raw_edges(spark, sf))


EXTERNAL_SQL = CANON_SQL + """,
ext AS (SELECT * FROM canon WHERE dst_kind IN ('external_tool', 'concept')),
externals AS (
  SELECT dst_id AS node_id, arg_min(dst_kind, (shard, source_edge_index)) AS kind,
         regexp_replace(dst_id, '^[^:]*::', '') AS label,
         coalesce(arg_min(as_of, (-epoch(try_cast(as_of AS TIMESTAMP)), shard, source_edge_index))
                    FILTER (WHERE try_cast(as_of AS TIMESTAMP) IS NOT NULL),
                  arg_min(as_of, (shard, source_edge_index))) AS as_of,
         count(DISTINCT source_file) AS source_count
  FROM ext GROUP BY 1)"""


@query("external_nodes", EXTERNAL_SQL + """
SELECT *, CASE WHEN kind = 'external_tool' THEN label END AS external_ref FROM externals""")  # fmt: skip
def external_nodes(spark, sf):
    return graph_tables.external_nodes(graph_tables.canonical_edges(raw_edges(spark, sf), mapping(spark, sf)))


@query("external_node_sources", EXTERNAL_SQL + "SELECT DISTINCT dst_id AS node_id, source_file FROM ext")
def external_node_sources(spark, sf):
    return graph_tables.external_node_sources(graph_tables.canonical_edges(raw_edges(spark, sf), mapping(spark, sf)))


@query(
    "graph_nodes_built",
    EXTERNAL_SQL.replace("WITH", "WITH " + b.REPOS_SQL + ",", 1)
    + """
SELECT node_id, 'repo' AS kind, coalesce(nullif(full_name, ''), name) AS label,
       CASE WHEN coalesce(nullif(full_name, ''), name) <> name THEN name ELSE '' END AS aliases, as_of FROM repos
UNION ALL SELECT node_id, kind, label, NULL, as_of FROM externals""",
)
def graph_nodes_built(spark, sf):
    edges = graph_tables.canonical_edges(raw_edges(spark, sf), mapping(spark, sf))
    nodes = graph_tables.graph_nodes(b.repos(spark, sf), edges)
    return joined(nodes.select("node_id", "kind", "label", "aliases", "as_of"), "aliases")


@query(
    "mapping_coverage",
    b.with_views(b.EDGES_SQL)
    + """
SELECT DISTINCT shard, relation AS observed_label, 'missing' AS side FROM edges WHERE relation = 'placed_by'
UNION ALL SELECT DISTINCT o_orderpriority, 'ranked_as', 'extra' FROM orders""",
)
def mapping_coverage(spark, sf):
    unseen = b.table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("shard"), F.lit("ranked_as").alias("observed_label")
    )
    declared = mapping(spark, sf).select("shard", "observed_label").unionByName(unseen)
    return setdiff.missing_and_extra(
        graph_tables.observed_relations(raw_edges(spark, sf)), declared, ["shard", "observed_label"]
    )


@query(
    "compile_coverage",
    CANON_SQL
    + """
SELECT 'edge_records' AS record_type, count(*) AS input_total, count(*) FILTER (WHERE errors = '') AS compiled_total,
       round_even(count(*) FILTER (WHERE errors = '') / count(*) * 100.0, 3) AS coverage_pct FROM canon""",
)
def compile_coverage(spark, sf):
    raw = raw_edges(spark, sf)
    done = graph_tables.canonical_edges(raw, mapping(spark, sf)).filter(F.size("errors") == 0)
    return aggregates.coverage(raw, done, "edge_records")


# --- referential gates ------------------------------------------------------------

KINDS_LEFT = ["repo", "external_tool"]
SOME_NODES_SQL = b.with_views(b.EDGES_SQL, b.NODES_SQL) + ", kept AS (SELECT * FROM nodes WHERE kind <> 'concept')"


@query(
    "orphan_edges",
    SOME_NODES_SQL
    + """
SELECT 'src_id' AS missing, src_id AS node_id, count(*) AS edges FROM edges
WHERE src_id NOT IN (SELECT node_id FROM kept) GROUP BY 2
UNION ALL SELECT 'dst_id', dst_id, count(*) FROM edges WHERE dst_id NOT IN (SELECT node_id FROM kept) GROUP BY 2""",
)
def orphan_edges(spark, sf):
    return gates.orphan_edges(b.edges(spark, sf), b.nodes(spark, sf, KINDS_LEFT))


@query(
    "unknown_repo_refs",
    b.with_views(b.EDGES_SQL, b.REPOS_SQL)
    + """
SELECT dst_id, count(*) AS edges FROM edges
WHERE dst_kind = 'repo' AND dst_id NOT IN (SELECT node_id FROM repos WHERE category <> 'BUILDING') GROUP BY 1""",
)
def unknown_repo_refs(spark, sf):
    return gates.unknown_repo_refs(b.edges(spark, sf), b.repos(spark, sf).filter("category <> 'BUILDING'"))


POLICY_SQL = SOME_NODES_SQL + """,
kinds AS (SELECT node_id, CASE WHEN label = 'ASIA' THEN 'concept' ELSE kind END AS kind FROM kept),
seen AS (
  SELECT dst_id AS node_id, dst_kind, kind, count(*) AS edges FROM edges LEFT JOIN kinds ON dst_id = node_id GROUP BY 1, 2, 3)
SELECT 'missing_src_node' AS reason, src_id AS node_id, NULL AS dst_kind, count(*) AS edges FROM edges
WHERE src_id NOT IN (SELECT node_id FROM kinds) GROUP BY 2
UNION ALL SELECT CASE WHEN kind IS NULL THEN 'missing_dst_node' ELSE 'dst_kind_mismatch' END, node_id, dst_kind, edges
FROM seen WHERE {absent} OR kind <> dst_kind"""


def _policy(spark, sf, policy):
    kind = F.when(F.col("label") == "ASIA", "concept").otherwise(F.col("kind"))
    nodes = b.nodes(spark, sf, KINDS_LEFT).withColumn("kind", kind)
    return gates.edge_policy_findings(b.edges(spark, sf), nodes, policy)


@query("edge_policy_first_class", POLICY_SQL.format(absent="kind IS NULL"))
def edge_policy_first_class(spark, sf):
    return _policy(spark, sf, "first_class")


@query("edge_policy_label_only", POLICY_SQL.format(absent="(kind IS NULL AND dst_kind = 'repo')"))
def edge_policy_label_only(spark, sf):
    return _policy(spark, sf, "label_only")


@query(
    "graph_findings",
    CANON_SQL.replace("WITH", "WITH " + b.REPOS_SQL + ",", 1)
    + """,
rules AS (
  SELECT CASE WHEN dst_kind = 'order' THEN 'invalid_dst_kind' ELSE 'invalid_relation' END AS reason,
         CASE WHEN dst_kind = 'order' THEN dst_kind ELSE relation END AS detail FROM canon
  WHERE dst_kind = 'order' OR relation = 'placed_by')
SELECT reason, detail, count(*) AS edges FROM rules GROUP BY 1, 2
UNION ALL SELECT 'unknown_src_repo', src_id, count(*) FROM canon
WHERE src_id NOT IN (SELECT node_id FROM repos WHERE category = 'BUILDING') GROUP BY 2
UNION ALL SELECT 'unknown_dst_repo', dst_id, count(*) FROM canon
WHERE dst_kind = 'repo' AND dst_id NOT IN (SELECT node_id FROM repos WHERE category = 'BUILDING') GROUP BY 2""",
)
def graph_findings(spark, sf):
    edges = graph_tables.canonical_edges(raw_edges(spark, sf), mapping(spark, sf))
    return gates.graph_findings(edges, b.repos(spark, sf).filter("category = 'BUILDING'"))


@query(
    "stale_records",
    b.with_views(b.REPOS_SQL, b.EDGES_SQL)
    + """
SELECT 'repo' AS record_type, node_id AS id, as_of FROM repos WHERE as_of = 'unknown'
UNION ALL SELECT 'edge', src_id, as_of FROM edges WHERE as_of = 'not a date'""",
)
def stale_records(spark, sf):
    repos = b.repos(spark, sf).withColumnRenamed("node_id", "id")
    edges = b.edges(spark, sf).withColumnRenamed("src_id", "id")
    return gates.stale_records(repos, "repo", ["id"]).unionByName(gates.stale_records(edges, "edge", ["id"]))


@query(
    "compile_gates",
    CANON_SQL.replace("WITH", "WITH " + b.REPOS_SQL + ",", 1)
    + """
SELECT 'compile_errors_zero' AS gate, count(*) FILTER (WHERE errors <> '') = 0 AS passed FROM canon
UNION ALL SELECT 'unmapped_relations_empty', count(*) FILTER (WHERE unmapped) = 0 FROM canon
UNION ALL SELECT 'duplicate_repo_node_ids_zero', count(*) = count(DISTINCT node_id) FROM repos
UNION ALL SELECT 'stale_records_zero', count(*) FILTER (WHERE as_of = 'unknown') = 0 FROM repos
UNION ALL SELECT 'unknown_repo_refs_zero',
  count(*) FILTER (WHERE dst_kind = 'repo' AND dst_id NOT IN (SELECT node_id FROM repos)) = 0 FROM canon
UNION ALL SELECT 'repo_coverage_100pct', count(*) FILTER (WHERE name <> '') = count(*) FROM repos""",
)
def compile_gates(spark, sf):
    edges = graph_tables.canonical_edges(raw_edges(spark, sf), mapping(spark, sf))
    repos = b.repos(spark, sf)
    return gates.gate_results(
        {
            "compile_errors_zero": (edges, F.count_if(F.size("errors") > 0) == 0),
            "unmapped_relations_empty": (edges, F.count_if("unmapped") == 0),
            "duplicate_repo_node_ids_zero": (aggregates.duplicate_keys(repos, ["node_id"]), gates.none_left()),
            "stale_records_zero": (gates.stale_records(repos, "repo", ["node_id"]), gates.none_left()),
            "unknown_repo_refs_zero": (gates.unknown_repo_refs(edges, repos), gates.none_left()),
            "repo_coverage_100pct": (repos, F.count_if(F.col("name") != "") == F.count("*")),
        }
    )


@query(
    "duplicate_keys",
    "SELECT l_orderkey, l_linenumber, count(*) AS occurrences FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def duplicate_keys(spark, sf):
    return aggregates.duplicate_keys(b.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "duplicate_occurrences",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) "
    "AS occurrences FROM lineitem QUALIFY occurrences > 1",
)
def duplicate_occurrences(spark, sf):
    return aggregates.duplicate_occurrences(
        b.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"]
    )


@query(
    "linked_pair_conflicts",
    """
SELECT o_custkey, count(*) AS rows, count(DISTINCT o_orderpriority) > 1 AS names_differ,
       max(n) AS max_per_kind FROM (
  SELECT *, count(*) OVER (PARTITION BY o_custkey, o_orderstatus) AS n FROM orders)
GROUP BY 1 HAVING count(*) > 2 OR max(n) > 1 OR count(DISTINCT o_orderpriority) > 1""",
)
def linked_pair_conflicts(spark, sf):
    return aggregates.linked_pair_conflicts(b.table(spark, sf, "orders"), "o_custkey", "o_orderpriority", "o_orderstatus")


def claims(spark, sf):
    """One identity claim per order, some with a changed or missing field."""
    key = F.col("o_orderkey")
    people = b.repos(spark, sf).withColumn("html_url", F.concat(F.lit("https://example.org/"), "name"))
    orders = b.table(spark, sf, "orders").select(
        "o_orderkey", F.concat(F.lit("repo::c"), "o_custkey").alias("node_id"), F.col("o_orderpriority").alias("source_file")
    )
    rows = orders.join(people.select("node_id", "name", "full_name", "html_url"), "node_id")
    return rows.select(
        "node_id",
        F.concat("source_file", F.lit("/"), key.cast("string")).alias("source_file"),
        F.when(key % 3 == 0, F.upper("name")).otherwise(F.col("name")).alias("name"),
        "full_name",
        F.when(key % 5 == 0, F.lit("  ")).otherwise(F.col("html_url")).alias("html_url"),
    ), people


@query(
    "identity_parity",
    b.with_views(b.REPOS_SQL)
    + """,
c AS (
  SELECT node_id, o_orderpriority || '/' || o_orderkey AS source_file, o_orderkey AS k, name, full_name,
         'https://example.org/' || name AS url FROM orders JOIN repos ON node_id = 'repo::c' || o_custkey)
SELECT node_id, source_file, 'name' AS field, name AS expected, upper(name) AS actual, 'identity_mismatch' AS reason
FROM c WHERE k % 3 = 0
UNION ALL SELECT node_id, source_file, 'html_url', url, '', 'identity_missing_field' FROM c WHERE k % 5 = 0
UNION ALL SELECT node_id, source_file, 'full_name', full_name, full_name, 'identity_missing_field'
FROM c WHERE full_name IS NULL""",
)
def identity_parity(spark, sf):
    rows, people = claims(spark, sf)
    return gates.identity_parity(rows, people)


@query(
    "shallow_deep_findings",
    """
WITH s AS (
  SELECT 'repo::' || p_partkey AS node_id, 'shard' || (p_partkey % 3) AS shard, p_name AS name,
         CASE WHEN p_size % 4 = 0 THEN 'remote' ELSE 'shard' || (p_partkey % 3) END AS source FROM part),
d AS (
  SELECT DISTINCT 'repo::' || l_partkey AS node_id, 'shard' || ((l_partkey + (l_partkey % 5 = 0)::INT) % 3) AS shard,
         CASE WHEN p_size % 7 = 0 THEN upper(p_name) ELSE p_name END AS name, p_size % 4 = 0 AS remote
  FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_quantity >= 48),
j AS (
  SELECT coalesce(s.node_id, d.node_id) AS node_id, coalesce(s.shard, d.shard) AS shard, s.node_id IS NOT NULL AS i,
         d.node_id IS NOT NULL AS o, s.name AS sn, d.name AS dn, s.source AS ss,
         CASE WHEN remote THEN 'remote' ELSE d.shard END AS ds
  FROM s FULL JOIN d ON s.node_id = d.node_id AND s.shard = d.shard)
SELECT shard, node_id, 'blocking' AS severity, 'deep_without_shallow' AS reason FROM j WHERE NOT i
UNION ALL SELECT shard, node_id, 'blocking', 'name_mismatch' FROM j WHERE i AND o AND sn <> dn
UNION ALL SELECT shard, node_id, 'blocking', 'source_mismatch' FROM j WHERE i AND o AND ss <> ds
UNION ALL SELECT shard, node_id, 'blocking', 'local_record_without_deep' FROM j WHERE NOT o AND ss = shard""",
)
def shallow_deep_findings(spark, sf):
    part, same = b.table(spark, sf, "part"), F.lit("x")

    def shard(col):
        return F.concat(F.lit("shard"), (col % 3).cast("string"))

    def source(own):
        return F.when(F.col("p_size") % 4 == 0, F.lit("remote")).otherwise(own)

    own = shard(F.col("p_partkey"))
    node = F.concat(F.lit("repo::"), "p_partkey")
    shallow = part.select(
        node.alias("node_id"), own.alias("shard"), F.col("p_name").alias("name"), same.alias("full_name"),
        same.alias("html_url"), source(own).alias("source"),
    )
    moved = shard(F.col("p_partkey") + (F.col("p_partkey") % 5 == 0).cast("int"))
    bought = b.table(spark, sf, "lineitem").filter("l_quantity >= 48").select(F.col("l_partkey").alias("p_partkey")).distinct()
    name = F.when(F.col("p_size") % 7 == 0, F.upper("p_name")).otherwise(F.col("p_name"))
    deep = part.join(bought, "p_partkey").select(
        node.alias("node_id"), moved.alias("shard"), name.alias("name"), same.alias("full_name"),
        same.alias("html_url"), source(moved).alias("source"),
    )
    return gates.shallow_deep_findings(shallow, deep).drop("detail")


@query(
    "fact_findings",
    """
WITH f AS (
  SELECT 'repo::' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS node_id,
         l_returnflag = 'N' AS bad_predicate, l_quantity >= 49 AS bad_confidence, l_tax < 0.01 AS bad_kind,
         l_discount > 0.095 AS blank, l_linestatus FROM lineitem)
SELECT node_id, 'non_blocking' AS severity, 'unknown_predicate' AS reason, 'unknown predicate ''mystery''' AS detail
FROM f WHERE bad_predicate
UNION ALL SELECT node_id, 'blocking', 'invalid_confidence', 'confidence must be in [0,1], got ''2.5''' FROM f WHERE bad_confidence
UNION ALL SELECT node_id, 'blocking', 'unknown_object_kind', 'unknown object_kind ''hook''' FROM f WHERE bad_kind
UNION ALL SELECT node_id, 'blocking', 'missing_object_value', '' FROM f WHERE blank""",
)
def fact_findings(spark, sf):
    line = b.table(spark, sf, "lineitem")
    rows = line.select(
        F.concat(F.lit("repo::"), F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")).alias("node_id"),
        F.lit("component").alias("fact_type"),
        F.when(F.col("l_returnflag") == "N", "mystery").otherwise("has_component").alias("predicate"),
        F.when(F.col("l_tax") < 0.01, "hook").otherwise("concept").alias("object_kind"),
        F.when(F.col("l_quantity") >= 49, 2.5).otherwise(0.5).alias("confidence"),
        F.when(F.col("l_discount") > 0.095, "\t ").otherwise(F.col("l_linestatus")).alias("object_value"),
        F.lit(None).cast("string").alias("object_node_id"),
    )
    return gates.rule_findings(rows, gates.fact_rules(strict_predicates=False), ["node_id"])


@query(
    "repo_findings",
    b.with_views(b.REPOS_SQL)
    + """
SELECT node_id, 'blocking' AS severity, 'missing_full_name' AS reason, '' AS detail FROM repos WHERE full_name IS NULL
UNION ALL SELECT node_id, 'blocking', 'missing_summary', '' FROM repos WHERE summary = ''
UNION ALL SELECT node_id, 'blocking', 'empty_core_concepts', '' FROM repos WHERE ordinal % 4 = 0
UNION ALL SELECT node_id, 'blocking', 'missing_language', '' FROM repos WHERE ordinal % 6 = 1
UNION ALL SELECT node_id, 'blocking', 'invalid_full_name', 'invalid full_name '''  || full_name || '/x''' FROM repos WHERE ordinal % 7 = 1 AND full_name IS NOT NULL
UNION ALL SELECT node_id, 'blocking', 'invalid_html_url', 'invalid html_url ''ftp://example.org/' || name || '''' FROM repos WHERE ordinal % 5 = 0
UNION ALL SELECT node_id, 'blocking', 'invalid_source', 'invalid source ''odd''' FROM repos WHERE ordinal % 4 = 1
UNION ALL SELECT node_id, 'blocking', 'invalid_shard', 'invalid shard ''' || shard || '''' FROM repos WHERE ordinal % 3 = 2
UNION ALL SELECT node_id, 'blocking', 'missing_source_file', '' FROM repos WHERE ordinal % 6 = 0""",
)
def repo_findings(spark, sf):
    n = F.col("ordinal")
    rows = b.repos(spark, sf).select(
        "*",
        F.concat(F.when(n % 5 == 0, "ftp").otherwise("https"), F.lit("://example.org/"), "name").alias("html_url"),
        F.when(n % 4 == 1, "odd").otherwise("repos").alias("source"),
        F.when(n % 6 == 0, " ").otherwise("a.yaml").alias("source_file"),
        F.when(n % 4 != 0, F.array("name")).otherwise(F.array().cast("array<string>")).alias("core_concepts"),
        F.array("category").alias("key_entry_points"),
        F.create_map(F.when(n % 6 == 1, "tool").otherwise("language"), F.lit("sql")).alias("build_run"),
    )
    rows = rows.withColumn("full_name", F.when(n % 7 == 1, F.concat("full_name", F.lit("/x"))).otherwise(F.col("full_name")))
    rows = rows.withColumn("shard", F.when(n % 3 == 0, "merged").when(n % 3 == 1, "repos").otherwise(F.col("shard")))
    return gates.rule_findings(rows, [*gates.repo_rules(), *gates.provenance_rules()], ["node_id"])


@query(
    "node_findings",
    b.with_views(b.NODES_SQL)
    + """
SELECT node_id, 'blocking' AS severity, 'unknown_kind' AS reason, 'unknown kind ''place''' AS detail FROM nodes WHERE label = 'ASIA'
UNION ALL SELECT node_id, 'blocking', 'missing_repo_ref', '' FROM nodes WHERE kind = 'repo' AND label LIKE 'Order %1'
UNION ALL SELECT node_id, 'blocking', 'missing_external_ref', '' FROM nodes WHERE kind = 'concept'
UNION ALL SELECT node_id, 'blocking', 'missing_label', '' FROM nodes WHERE label = 'EUROPE'""",
)
def node_findings(spark, sf):
    """Graph nodes with faults of several kinds against the node contract."""
    label, kind = F.col("label"), F.col("kind")
    nodes = b.nodes(spark, sf).select(
        "node_id",
        F.when(label == "ASIA", "place").otherwise(kind).alias("kind"),
        F.when(label != "EUROPE", label).alias("label"),
        F.when((kind == "repo") & ~label.like("Order %1"), F.col("node_id")).alias("repo_ref"),
        F.when(kind != "concept", "r").alias("external_ref"),
    )
    return gates.rule_findings(nodes, gates.node_rules(), ["node_id"])


@query(
    "edge_findings",
    b.with_views(b.EDGES_SQL)
    + """
SELECT shard, source_edge_index, 'blocking' AS severity, 'invalid_relation' AS reason, 'invalid relation ''placed_by''' AS detail
FROM edges WHERE relation = 'placed_by'
UNION ALL SELECT shard, source_edge_index, 'blocking', 'invalid_dst_kind', 'invalid dst_kind ''region''' FROM edges WHERE shard = 'nation'
UNION ALL SELECT shard, source_edge_index, 'blocking', 'missing_as_of', '' FROM edges WHERE shard = 'customer'""",
)
def edge_findings(spark, sf):
    """Graph edges with faults of several kinds against the edge contract."""
    edges = b.edges(spark, sf)
    edges = edges.withColumn("as_of", F.when(F.col("shard") != "customer", F.col("as_of")))
    edges = edges.withColumn("dst_kind", F.when(F.col("shard") == "nation", "region").otherwise(F.col("dst_kind")))
    return gates.rule_findings(edges, gates.edge_rules(["located_in", "part_of"]), ["shard", "source_edge_index"])


@query(
    "audit_verdict",
    """
WITH s AS (
  SELECT o_orderpriority, CASE WHEN o_totalprice > 470000 THEN 'high' ELSE 'low' END AS severity FROM orders)
SELECT count(*) FILTER (WHERE severity = 'critical') AS critical, count(*) FILTER (WHERE severity = 'high') AS high,
  CASE WHEN count(*) FILTER (WHERE severity = 'high') > 5 THEN 'FIX_REQUIRED'
       WHEN count(*) FILTER (WHERE severity = 'high') > 0 THEN 'READY_WITH_NOTES' ELSE 'READY_FOR_PRODUCTION' END AS verdict
FROM s""",
)
def audit_verdict(spark, sf):
    severity = F.when(F.col("o_totalprice") > 470000, "high").otherwise("low")
    return gates.verdict(b.table(spark, sf, "orders").select(severity.alias("severity")))


@query(
    "allow_list_findings",
    b.with_views(b.REPOS_SQL)
    + """
SELECT name AS full_name, lower(category) AS hint, CASE WHEN lower(category) = 'building' THEN 'AUTOMOBILE' END AS target,
       CASE WHEN lower(category) = 'building' THEN 'alias' ELSE 'unknown' END AS reason
FROM repos WHERE ordinal % 2 = 0""",
)
def allow_list_findings(spark, sf):
    hint = F.when(F.col("ordinal") % 2 == 0, F.lower("category")).otherwise(F.col("category"))
    records = b.repos(spark, sf).select(F.col("name").alias("full_name"), hint.alias("hint"))
    allowed = b.repos(spark, sf).select(F.col("category").alias("value")).distinct()
    aliases = allowed.filter("value IN ('BUILDING', 'MACHINERY')").select(
        F.lower("value").alias("alias"),
        F.when(F.col("value") == "BUILDING", "AUTOMOBILE").otherwise("gone").alias("target"),
    )
    return gates.allow_list_findings(records, allowed, aliases)


@query(
    "fixed_hints",
    b.with_views(b.REPOS_SQL)
    + """
SELECT name AS full_name, CASE WHEN ordinal % 2 = 0 AND category = 'BUILDING' THEN 'AUTOMOBILE'
       WHEN ordinal % 2 = 0 THEN lower(category) ELSE category END AS hint FROM repos""",
)
def fixed_hints(spark, sf):
    hint = F.when(F.col("ordinal") % 2 == 0, F.lower("category")).otherwise(F.col("category"))
    records = b.repos(spark, sf).select(F.col("name").alias("full_name"), hint.alias("hint"))
    allowed = b.repos(spark, sf).select(F.col("category").alias("value")).distinct()
    aliases = allowed.filter("value = 'BUILDING'").select(F.lower("value").alias("alias"), F.lit("AUTOMOBILE").alias("target"))
    return gates.fix_hints(records, aliases, allowed)


# --- hashes and differences -------------------------------------------------------


def _digest_sql(table: str, columns: list[str]) -> str:
    parts = ", ".join(f"coalesce('=' || {c}, '-')" for c in columns)
    return (
        f"SELECT '{table}' AS \"table\", count(*) AS rows, coalesce(sum(('0x' || substr(sha256(concat_ws(chr(31), {parts})), 1, 15))"
        f"::BIGINT)::HUGEINT, 0)::VARCHAR AS digest FROM {table}"
    )


NODE_COLUMNS = ["node_id", "kind", "label"]
EDGE_COLUMNS = ["src_id", "dst_id", "dst_kind", "relation", "note", "as_of"]


@query(
    "snapshot_hash",
    b.with_views(b.NODES_SQL, b.EDGES_SQL)
    + _digest_sql("nodes", NODE_COLUMNS)
    + " UNION ALL "
    + _digest_sql("edges", EDGE_COLUMNS),
)
def snapshot_hash(spark, sf):
    return setdiff.hash_ledger(
        {"nodes": b.nodes(spark, sf).select(NODE_COLUMNS), "edges": b.edges(spark, sf).select(EDGE_COLUMNS)}
    )


@query(
    "table_difference",
    """
WITH a AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2),
c AS (
  SELECT user_id, CASE WHEN value > 40 THEN upper(event_type) ELSE event_type END AS event_type, count(*) AS n
  FROM events GROUP BY 1, 2)
SELECT user_id, event_type, coalesce(a.n, 0) - coalesce(c.n, 0) AS surplus,
       CASE WHEN coalesce(a.n, 0) > coalesce(c.n, 0) THEN 'left' ELSE 'right' END AS side
FROM a FULL JOIN c USING (user_id, event_type) WHERE coalesce(a.n, 0) <> coalesce(c.n, 0)""",
)
def table_difference(spark, sf):
    left = b.table(spark, sf, "events").select("user_id", "event_type", "value")
    kind = F.when(F.col("value") > 40, F.upper("event_type")).otherwise(F.col("event_type"))
    return setdiff.multiset_diff(left, left.withColumn("event_type", kind), ignore=["value"])


# --- coverage audit ---------------------------------------------------------------

# Archetypes for the categories of the driver tables, in the shape of the fixed list.
TABLE_ARCHETYPES = [
    ("builders", ["BUILDING", "MACHINERY"], ["structure", "failures"], "uses_protocol"),
    ("makers", ["FURNITURE", "BUILDING"], ["structure", "protocols"], None),
    ("homes", ["HOUSEHOLD"], ["structure", "tasks"], "has_extension_point"),
]
AUDIT_SQL = b.with_views(b.REPOS_SQL, b.FACTS_SQL) + """,
flags AS (
  SELECT node_id, count(*) AS n, bool_or(predicate = 'has_component') AS st, bool_or(predicate = 'has_failure_mode') AS fa,
         bool_or(predicate = 'uses_protocol') AS pr FROM facts GROUP BY 1),
matched AS (
  SELECT r.node_id, r.full_name, category, coalesce(n, 0) AS total_facts, coalesce(st, false) AS st,
         coalesce(fa, false) AS fa, coalesce(pr, false) AS pr,
         CASE WHEN category IN ('BUILDING', 'MACHINERY') THEN 'builders' WHEN category = 'FURNITURE' THEN 'makers'
              WHEN category = 'HOUSEHOLD' THEN 'homes' END AS archetype
  FROM repos r LEFT JOIN flags USING (node_id)),
audit AS (
  SELECT *, CASE WHEN archetype IS NOT NULL THEN concat_ws('; ', CASE WHEN st THEN 'structure' END,
              CASE WHEN fa THEN 'failures' END, CASE WHEN pr THEN 'protocols' END) ELSE '' END AS families_present,
         CASE archetype
           WHEN 'builders' THEN concat_ws('; ', CASE WHEN NOT st THEN 'structure' END, CASE WHEN NOT fa THEN 'failures' END)
           WHEN 'makers' THEN concat_ws('; ', CASE WHEN NOT st THEN 'structure' END, CASE WHEN NOT pr THEN 'protocols' END)
           WHEN 'homes' THEN concat_ws('; ', CASE WHEN NOT st THEN 'structure' END, 'tasks') ELSE '' END AS families_missing,
         CASE WHEN archetype = 'homes' AND pr THEN 'has_extension_point' ELSE '' END AS predicate_check_failures
  FROM matched),
classed AS (
  SELECT *, CASE WHEN archetype IS NULL THEN 'unmatched' WHEN families_missing || predicate_check_failures <> '' THEN 'thin'
                 ELSE 'full' END AS behavioral_coverage FROM audit)"""


def _audit(spark, sf):
    rules = audit.archetype_rules(spark, TABLE_ARCHETYPES)
    return audit.coverage_audit(b.repos(spark, sf), b.facts(spark, sf), rules)


@query(
    "archetype_audit",
    AUDIT_SQL
    + """SELECT node_id, category, archetype, total_facts, families_present, families_missing, predicate_check_failures,
behavioral_coverage, total_facts = 0 AS no_facts FROM classed""",
)
def archetype_audit(spark, sf):
    out = joined(_audit(spark, sf), "families_present", "families_missing", "predicate_check_failures")
    return out.drop("full_name", "name")


@query(
    "archetype_summary",
    AUDIT_SQL
    + """SELECT coalesce(archetype, 'unmatched') AS archetype, count(*) AS total,
count(*) FILTER (WHERE behavioral_coverage = 'full') AS "full", count(*) FILTER (WHERE behavioral_coverage = 'thin') AS thin
FROM classed GROUP BY 1""",
)
def archetype_summary(spark, sf):
    return audit.audit_summary(_audit(spark, sf))


@query(
    "thin_records",
    AUDIT_SQL
    + """SELECT archetype, full_name, node_id, families_missing, predicate_check_failures FROM classed
WHERE behavioral_coverage = 'thin' AND archetype = 'homes'""",
)
def thin_records(spark, sf):
    return joined(audit.thin_records(_audit(spark, sf), "homes"), "families_missing", "predicate_check_failures")


@query(
    "unmapped_sections",
    b.with_views(b.FACTS_SQL)
    + "SELECT DISTINCT node_id, source_section FROM facts WHERE predicate = 'has_component'",
)
def unmapped_sections(spark, sf):
    return audit.unmapped_sections(b.facts(spark, sf))
