"""The graph tables as views over the star-schema tables, in Spark and in SQL.

Each view exists twice: as a lazy DataFrame and as a common table expression of the
same name, so that a query and its check start from equal rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FACT_TYPES = {
    "implements_pattern": "implementation_pattern",
    "has_failure_mode": "failure_mode",
    "has_component": "component",
    "uses_protocol": "protocol_usage",
}
SECTIONS = {
    "implements_pattern": "code_patterns",
    "has_failure_mode": "troubleshooting",
    "has_component": "modules",
    "uses_protocol": "supported_protocols",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _id(prefix: str, col: str) -> Column:
    return F.concat(F.lit(prefix), F.col(col).cast("string"))


# --- repos ------------------------------------------------------------------------


def repos(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as records; every second one has no full name."""
    key = F.col("c_custkey")
    owner = F.concat(F.lit("owner"), F.col("c_nationkey"))
    return table(spark, sf, "customer").select(
        _id("repo::c", "c_custkey").alias("node_id"),
        F.col("c_name").alias("name"),
        F.when(key % 2 == 1, F.concat(owner, F.lit("/C"), key)).alias("full_name"),
        F.col("c_mktsegment").alias("category"),
        F.concat(F.lit("n"), F.col("c_nationkey")).alias("shard"),
        F.when(F.col("c_acctbal") < 0, F.lit("")).otherwise(F.concat(F.lit("Record of "), "c_name")).alias("summary"),
        F.when(key % 3 == 0, F.lit("unknown"))
        .otherwise(F.concat(F.lit("2024-02-"), F.lpad((key % 28 + 1).cast("string"), 2, "0")))
        .alias("as_of"),
        key.alias("ordinal"),
    )


REPOS_SQL = """
repos AS (
  SELECT 'repo::c' || c_custkey AS node_id, c_name AS name,
         CASE WHEN c_custkey % 2 = 1 THEN 'owner' || c_nationkey || '/C' || c_custkey END AS full_name,
         c_mktsegment AS category, 'n' || c_nationkey AS shard,
         CASE WHEN c_acctbal < 0 THEN '' ELSE 'Record of ' || c_name END AS summary,
         CASE WHEN c_custkey % 3 = 0 THEN 'unknown'
              ELSE '2024-02-' || lpad((c_custkey % 28 + 1)::VARCHAR, 2, '0') END AS as_of,
         c_custkey AS ordinal
  FROM customer)"""


# --- facts ------------------------------------------------------------------------


def _fact_rules() -> dict[str, tuple[Column, str]]:
    """Predicate → (row condition on lineitem, value column of part)."""
    qty, tax = F.col("l_quantity"), F.col("l_tax")
    return {
        "implements_pattern": (F.lit(True), "p_name"),
        "has_failure_mode": ((F.col("l_returnflag") == "R") & (qty >= 45), "p_name"),
        "has_component": (F.col("l_discount") >= 0.09, "p_brand"),
        "uses_protocol": ((tax >= 0.08) & (qty <= 5), "p_type"),
    }


def facts(spark: SparkSession, sf: str, predicates: Sequence[str] = tuple(FACT_TYPES)) -> DataFrame:
    """Order lines as facts about customers; only the asked predicates are built.

    The row conditions reach the scan; one line gives up to four facts in one pass.
    """
    rules = {p: _fact_rules()[p] for p in predicates}
    wanted = F.lit(False)
    for condition, _ in rules.values():
        wanted = wanted | condition
    lines = (
        table(spark, sf, "lineitem")
        .filter(wanted)
        .join(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(
            table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type"),
            F.col("l_partkey") == F.col("p_partkey"),
        )
    )
    as_of = F.date_format("l_shipdate", "yyyy-MM-dd")
    position = F.concat_ws(
        "|", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", as_of,
        F.round(F.col("l_extendedprice") * 100).cast("bigint"), F.col("l_quantity").cast("int"),
    )
    options = [
        F.when(
            condition,
            F.struct(
                F.lit(p).alias("predicate"),
                F.lit(FACT_TYPES[p]).alias("fact_type"),
                F.col(value).alias("object_value"),
                F.concat(F.lit(SECTIONS[p] + "["), F.col("l_linenumber"), F.lit("]")).alias("source_section")
                if p == "has_component"
                else F.lit(SECTIONS[p]).alias("source_section"),
            ),
        )
        for p, (condition, value) in rules.items()
    ]
    rows = lines.select(
        _id("repo::c", "o_custkey").alias("node_id"),
        F.when(F.col("p_brand") == "Brand#7", F.lit("path")).otherwise(F.lit("concept")).alias("object_kind"),
        F.concat(F.col("l_returnflag"), F.lit("-"), F.col("l_linestatus"), F.lit(" "), F.col("p_type")).alias("note"),
        F.round(1 - F.col("l_discount"), 2).alias("confidence"),
        as_of.alias("as_of"),
        F.concat(F.lit("file"), F.col("l_suppkey") % 10).alias("source_file"),
        F.col("l_linenumber").alias("start_line"),
        position.alias("position"),
        F.explode(F.array(*options)).alias("f"),
    ).filter("f IS NOT NULL")
    fact_id = F.concat(
        F.lit("fact::"),
        F.substring(F.sha2(F.concat_ws("|", "f.predicate", "node_id", "position"), 256), 1, 24),
    )
    return rows.select(fact_id.alias("fact_id"), "*", "f.*").drop("f")


_FACT_BRANCH = """
  SELECT 'fact::' || substr(sha256('{p}' || '|' || node_id || '|' || position), 1, 24) AS fact_id, lines.*,
         '{p}' AS predicate, '{t}' AS fact_type, {value} AS object_value, {section} AS source_section
  FROM lines WHERE {condition}"""

FACTS_SQL = """
lines AS (
  SELECT 'repo::c' || o_custkey AS node_id,
         CASE WHEN p_brand = 'Brand#7' THEN 'path' ELSE 'concept' END AS object_kind,
         l_returnflag || '-' || l_linestatus || ' ' || p_type AS note,
         round(1 - l_discount, 2) AS confidence, strftime(l_shipdate, '%Y-%m-%d') AS as_of,
         'file' || (l_suppkey % 10) AS source_file, l_linenumber AS start_line,
         concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y-%m-%d'),
                   CAST(round(l_extendedprice * 100) AS BIGINT), CAST(l_quantity AS INT)) AS position,
         p_name, p_brand, p_type, l_returnflag, l_quantity, l_discount, l_tax, l_linenumber
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
facts AS (""" + " UNION ALL ".join(
    _FACT_BRANCH.format(p=p, t=FACT_TYPES[p], value=value, condition=condition, section=section)
    for p, value, condition, section in [
        ("implements_pattern", "p_name", "true", "'code_patterns'"),
        ("has_failure_mode", "p_name", "l_returnflag = 'R' AND l_quantity >= 45", "'troubleshooting'"),
        ("has_component", "p_brand", "l_discount >= 0.09", "'modules[' || l_linenumber || ']'"),
        ("uses_protocol", "p_type", "l_tax >= 0.08 AND l_quantity <= 5", "'supported_protocols'"),
    ]
) + ")"


# --- edges and nodes --------------------------------------------------------------


def edges(spark: SparkSession, sf: str) -> DataFrame:
    """supplier/customer → nation → region and order → customer."""

    def branch(name: str, src: Column, dst: Column, kind: str, relation: str, note: Column, as_of: Column, ordinal: str):
        return table(spark, sf, name).select(
            src.alias("src_id"),
            dst.alias("dst_id"),
            F.lit(kind).alias("dst_kind"),
            F.lit(relation).alias("relation"),
            note.alias("note"),
            as_of.alias("as_of"),
            F.lit(name).alias("shard"),
            F.concat(F.lit(name + "/part"), (F.col(ordinal) % 4).cast("string")).alias("source_file"),
            F.col(ordinal).cast("bigint").alias("source_edge_index"),
        )

    none = F.lit(None).cast("string")
    return (
        branch("supplier", _id("repo::s", "s_suppkey"), _id("concept::n", "s_nationkey"), "concept", "located_in",
               F.col("s_name"), F.concat(F.lit("2024-01-"), F.lpad((F.col("s_suppkey") % 28 + 1).cast("string"), 2, "0")),
               "s_suppkey")
        .unionByName(branch("nation", _id("concept::n", "n_nationkey"), _id("external_tool::r", "n_regionkey"),
                            "external_tool", "part_of", F.col("n_name"), F.lit("2023-12-31"), "n_nationkey"))
        .unionByName(branch("customer", _id("repo::c", "c_custkey"), _id("concept::n", "c_nationkey"), "concept",
                            "located_in", none, F.lit("not a date"), "c_custkey"))
        .unionByName(branch("orders", _id("repo::o", "o_orderkey"), _id("repo::c", "o_custkey"), "repo", "placed_by",
                            F.col("o_orderpriority"), F.date_format("o_orderdate", "yyyy-MM-dd"), "o_orderkey"))
    )


EDGES_SQL = """
edges AS (
  SELECT 'repo::s' || s_suppkey AS src_id, 'concept::n' || s_nationkey AS dst_id, 'concept' AS dst_kind,
         'located_in' AS relation, s_name AS note,
         '2024-01-' || lpad((s_suppkey % 28 + 1)::VARCHAR, 2, '0') AS as_of, 'supplier' AS shard,
         'supplier/part' || (s_suppkey % 4) AS source_file, s_suppkey::BIGINT AS source_edge_index
  FROM supplier
  UNION ALL SELECT 'concept::n' || n_nationkey, 'external_tool::r' || n_regionkey, 'external_tool', 'part_of',
         n_name, '2023-12-31', 'nation', 'nation/part' || (n_nationkey % 4), n_nationkey::BIGINT FROM nation
  UNION ALL SELECT 'repo::c' || c_custkey, 'concept::n' || c_nationkey, 'concept', 'located_in', NULL,
         'not a date', 'customer', 'customer/part' || (c_custkey % 4), c_custkey::BIGINT FROM customer
  UNION ALL SELECT 'repo::o' || o_orderkey, 'repo::c' || o_custkey, 'repo', 'placed_by', o_orderpriority,
         strftime(o_orderdate, '%Y-%m-%d'), 'orders', 'orders/part' || (o_orderkey % 4), o_orderkey::BIGINT
  FROM orders)"""


def nodes(spark: SparkSession, sf: str, kinds: Sequence[str] = ("repo", "concept", "external_tool")) -> DataFrame:
    """Node rows of the kinds asked for; leave one out to get dangling edges."""

    def branch(name: str, node_id: Column, kind: str, label: Column) -> DataFrame:
        return table(spark, sf, name).select(node_id.alias("node_id"), F.lit(kind).alias("kind"), label.alias("label"))

    order_label = F.concat(F.lit("Order "), F.col("o_orderkey"))
    return (
        branch("customer", _id("repo::c", "c_custkey"), "repo", F.col("c_name"))
        .unionByName(branch("supplier", _id("repo::s", "s_suppkey"), "repo", F.col("s_name")))
        .unionByName(branch("orders", _id("repo::o", "o_orderkey"), "repo", order_label))
        .unionByName(branch("nation", _id("concept::n", "n_nationkey"), "concept", F.col("n_name")))
        .unionByName(branch("region", _id("external_tool::r", "r_regionkey"), "external_tool", F.col("r_name")))
        .filter(F.col("kind").isin(list(kinds)))
    )


NODES_SQL = """
nodes AS (
  SELECT 'repo::c' || c_custkey AS node_id, 'repo' AS kind, c_name AS label FROM customer
  UNION ALL SELECT 'repo::s' || s_suppkey, 'repo', s_name FROM supplier
  UNION ALL SELECT 'repo::o' || o_orderkey, 'repo', 'Order ' || o_orderkey FROM orders
  UNION ALL SELECT 'concept::n' || n_nationkey, 'concept', n_name FROM nation
  UNION ALL SELECT 'external_tool::r' || r_regionkey, 'external_tool', r_name FROM region)"""


def with_views(*views: str) -> str:
    """``WITH`` clause of the given view texts."""
    return "WITH " + ",".join(views)
