"""Quality gates: rules per row, referential checks, verdicts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factgraph.functions.text import is_blank, parse_as_of, trim_ws
from factgraph.operators.graph_tables import NODE_KINDS, RELATIONS

# Vocabularies of the fact contract.
FACT_TYPES = [
    "component", "config_option", "api_endpoint", "implementation_pattern", "extension_point", "operational_task",
    "failure_mode", "protocol_usage",
]
PREDICATES = [
    "has_component", "has_config_option", "exposes_api_endpoint", "implements_pattern", "has_extension_point",
    "supports_task", "has_failure_mode", "uses_protocol",
]
OBJECT_KINDS = [
    "text", "repo", "external_tool", "concept", "path", "config_key", "api_route", "command", "protocol", "issue",
]
EVIDENCE_KINDS = ["file_line", "file_block", "doc_url", "command_output"]

Rule = tuple[str, str, Column, Column]


def rule_findings(df: DataFrame, rules: Sequence[Rule], keep: Sequence[str]) -> DataFrame:
    """One row per broken rule ``(reason, severity, condition, detail)``; a null condition holds nothing against a row."""
    hits = [
        F.when(condition, F.struct(F.lit(severity).alias("severity"), F.lit(reason).alias("reason"), detail.alias("detail")))
        for reason, severity, condition, detail in rules
    ]
    return df.select(*keep, F.explode(F.array(*hits)).alias("f")).filter("f IS NOT NULL").select(*keep, "f.*")


def blocking(reason: str, condition: Column, detail: Column | str = "") -> Rule:
    return reason, "blocking", condition, F.lit(detail) if isinstance(detail, str) else detail


def _quoted(text: str, col: str) -> Column:
    return F.concat(F.lit(text + " '"), F.coalesce(F.col(col).cast("string"), F.lit("")), F.lit("'"))


def fact_rules(strict_predicates: bool = True) -> list[Rule]:
    """Vocabulary, confidence and object rules of a fact."""
    node_kind = F.col("object_kind").isin("repo", "external_tool")
    severity = "blocking" if strict_predicates else "non_blocking"
    return [
        blocking("unknown_fact_type", ~_in("fact_type", FACT_TYPES), _quoted("unknown fact_type", "fact_type")),
        ("unknown_predicate", severity, ~_in("predicate", PREDICATES), _quoted("unknown predicate", "predicate")),
        blocking("unknown_object_kind", ~_in("object_kind", OBJECT_KINDS), _quoted("unknown object_kind", "object_kind")),
        blocking(
            "invalid_confidence",
            ~F.coalesce(F.col("confidence").between(0.0, 1.0), F.lit(False)),
            _quoted("confidence must be in [0,1], got", "confidence"),
        ),
        blocking("missing_object_node_id", F.coalesce(node_kind, F.lit(False)) & is_blank("object_node_id")),
        blocking("missing_object_value", ~F.coalesce(node_kind, F.lit(False)) & is_blank("object_value")),
    ]


def _in(col: str, values: Sequence[str]) -> Column:
    return F.coalesce(F.col(col), F.lit("")).isin(list(values))


def repo_rules() -> list[Rule]:
    """Required texts and lists of a record, forms of name and address, and the language rule."""
    texts = ["node_id", "full_name", "html_url", "name", "category", "summary", "as_of"]
    rules = [blocking("missing_" + c, is_blank(c)) for c in texts]
    for c in ("core_concepts", "key_entry_points", "build_run"):
        rules.append(blocking("empty_" + c, F.coalesce(F.size(c), F.lit(0)) <= 0))
    rules.append(blocking("invalid_full_name", ~is_blank("full_name") & ~F.col("full_name").rlike("^[^/]+/[^/]+$"), _quoted("invalid full_name", "full_name")))
    rules.append(blocking("invalid_html_url", ~is_blank("html_url") & ~F.col("html_url").rlike("^https://"), _quoted("invalid html_url", "html_url")))
    spoken = F.coalesce(F.col("build_run").getItem("language"), F.lit("")) == ""
    rules.append(blocking("missing_language", spoken & (F.coalesce("category", F.lit("")) != "documentation")))
    return rules


# Sources and shards of the contract.
SOURCES = ["repos", "remote_metadata", "remote_api", "compiled_master"]
SHARDS = ["repos", "merged"]


def provenance_rules() -> list[Rule]:
    """Source and shard vocabulary and the file of a record with ``source, shard, source_file``."""
    return [
        blocking("invalid_source", ~_in("source", SOURCES), _quoted("invalid source", "source")),
        blocking("invalid_shard", ~_in("shard", SHARDS), _quoted("invalid shard", "shard")),
        blocking("missing_source_file", is_blank("source_file")),
    ]


def node_rules() -> list[Rule]:
    return [
        blocking("missing_node_id", is_blank("node_id")),
        blocking("missing_label", is_blank("label")),
        blocking("unknown_kind", ~_in("kind", NODE_KINDS), _quoted("unknown kind", "kind")),
        blocking("missing_repo_ref", (F.col("kind") == "repo") & is_blank("repo_ref")),
        blocking("missing_external_ref", F.col("kind").isin("external_tool", "concept") & is_blank("external_ref")),
    ]


def edge_rules(relations: Sequence[str] = RELATIONS) -> list[Rule]:
    return [
        blocking("missing_src_id", is_blank("src_id")),
        blocking("missing_dst_id", is_blank("dst_id")),
        blocking("invalid_dst_kind", ~_in("dst_kind", NODE_KINDS), _quoted("invalid dst_kind", "dst_kind")),
        blocking("invalid_relation", ~_in("relation", relations), _quoted("invalid relation", "relation")),
        blocking("missing_as_of", is_blank("as_of")),
    ]


def stale_records(df: DataFrame, record_type: str, keys: Sequence[str]) -> DataFrame:
    """Rows whose ``as_of`` is neither a date nor a date with time."""
    return df.filter(parse_as_of("as_of").isNull()).select(F.lit(record_type).alias("record_type"), *keys, "as_of")


def orphan_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges with an end that is no node; ``missing`` names the end.

    Edges are counted per end before the anti join, so a hub costs one row there. The join
    only asks whether a node is there, so copies of one need no table of distinct ids.
    """
    ids = nodes.select("node_id")

    def side(end: str) -> DataFrame:
        ends = edges.groupBy(F.col(end).alias("node_id")).agg(F.count("*").alias("edges"))
        return ends.join(ids, "node_id", "left_anti").select(F.lit(end).alias("missing"), "node_id", "edges")

    return side("src_id").unionByName(side("dst_id"))


def unknown_repo_refs(edges: DataFrame, repos: DataFrame) -> DataFrame:
    """Record destinations that no record has, with the number of edges."""
    ends = edges.filter("dst_kind = 'repo'").groupBy("dst_id").agg(F.count("*").alias("edges"))
    return ends.join(repos.select(F.col("node_id").alias("dst_id")).distinct(), "dst_id", "left_anti")


def edge_policy_findings(edges: DataFrame, nodes: DataFrame, policy: str) -> DataFrame:
    """Ends that break the node policy, one row per (end, id, kind) with its edges.

    ``first_class`` wants every destination as a node of the edge's kind;
    ``label_only`` lets external destinations be absent, but not differ in kind.
    """
    kinds = nodes.groupBy("node_id").agg(F.max("kind").alias("kind"))
    sources = edges.groupBy(F.col("src_id").alias("node_id")).agg(F.count("*").alias("edges"))
    lost = sources.join(kinds, "node_id", "left_anti").select(
        F.lit("missing_src_node").alias("reason"), "node_id", F.lit(None).cast("string").alias("dst_kind"), "edges"
    )
    targets = edges.groupBy(F.col("dst_id").alias("node_id"), "dst_kind").agg(F.count("*").alias("edges"))
    seen = targets.join(kinds, "node_id", "left")
    absent = F.col("kind").isNull()
    must_exist = absent if policy == "first_class" else absent & (F.col("dst_kind") == "repo")
    reason = F.when(must_exist, "missing_dst_node").when(F.col("kind") != F.col("dst_kind"), "dst_kind_mismatch")
    broken = seen.withColumn("reason", reason).filter("reason IS NOT NULL")
    return lost.unionByName(broken.select("reason", "node_id", "dst_kind", "edges"))


def graph_findings(edges: DataFrame, repos: DataFrame, relations: Sequence[str] = RELATIONS) -> DataFrame:
    """Broken edges: unknown source record, kind, relation or target record, empty time.

    Counted per (reason, detail). A bad kind hides the later rules of its edge.
    """
    known = repos.select(F.col("node_id").alias("id")).distinct()
    good_kind = _in("dst_kind", NODE_KINDS)
    rules = [
        ("invalid_dst_kind", "blocking", ~good_kind, F.coalesce("dst_kind", F.lit(""))),
        ("invalid_relation", "blocking", good_kind & ~_in("relation", relations), F.coalesce("relation", F.lit(""))),
        ("empty_as_of", "blocking", good_kind & is_blank("as_of"), F.lit("")),
    ]
    plain = rule_findings(edges, rules, []).groupBy("reason", "detail").agg(F.count("*").alias("edges"))
    src = edges.groupBy(F.col("src_id").alias("id")).agg(F.count("*").alias("edges"))
    dst = edges.filter("dst_kind = 'repo'").groupBy(F.col("dst_id").alias("id")).agg(F.count("*").alias("edges"))

    def unknown(ends: DataFrame, reason: str) -> DataFrame:
        lost = ends.join(known, "id", "left_anti")
        return lost.select(F.lit(reason).alias("reason"), F.col("id").alias("detail"), "edges")

    return plain.unionByName(unknown(src, "unknown_src_repo")).unionByName(unknown(dst, "unknown_dst_repo"))


def identity_parity(claims: DataFrame, records: DataFrame, fields: Sequence[str] = ("name", "full_name", "html_url")) -> DataFrame:
    """Fields that are missing or differ between a claim and its record, joined on ``node_id``."""
    expected = records.select("node_id", *[F.col(f).alias("expected_" + f) for f in fields])
    pairs = claims.join(expected, "node_id")
    rows = F.array(
        *[F.struct(F.lit(f).alias("field"), F.col("expected_" + f).alias("expected"), trim_ws(f).alias("actual")) for f in fields]
    )
    out = pairs.select("node_id", "source_file", F.explode(rows).alias("c")).select("node_id", "source_file", "c.*")
    missing = F.coalesce("actual", F.lit("")) == ""
    reason = F.when(missing, "identity_missing_field").when(~F.col("actual").eqNullSafe(F.col("expected")), "identity_mismatch")
    return out.withColumn("reason", reason).filter("reason IS NOT NULL")


def shallow_deep_findings(shallow: DataFrame, deep: DataFrame) -> DataFrame:
    """Deep documents without their record, differing fields, local records without a deep document."""
    fields = ["name", "full_name", "html_url", "source"]
    s = shallow.select("node_id", F.col("shard").alias("s_shard"), *[F.col(f).alias("s_" + f) for f in fields])
    d = deep.select("node_id", F.col("shard").alias("d_shard"), *[F.col(f).alias("d_" + f) for f in fields])
    both = s.join(d, (s["node_id"] == d["node_id"]) & (s["s_shard"] == d["d_shard"]), "full_outer").select(
        F.coalesce(s["node_id"], d["node_id"]).alias("node_id"),
        F.coalesce("s_shard", "d_shard").alias("shard"),
        s["node_id"].isNotNull().alias("in_s"),
        d["node_id"].isNotNull().alias("in_d"),
        *["s_" + f for f in fields],
        *["d_" + f for f in fields],
    )
    paired = F.col("in_s") & F.col("in_d")
    rules = [blocking("deep_without_shallow", ~F.col("in_s"))]
    rules += [blocking(f"{f}_mismatch", paired & ~F.col("s_" + f).eqNullSafe(F.col("d_" + f))) for f in fields]
    rules.append(blocking("local_record_without_deep", ~F.col("in_d") & (F.col("s_source") == F.col("shard"))))
    return rule_findings(both, rules, ["shard", "node_id"])


def gate_results(checks: Mapping[str, tuple[DataFrame, Column]]) -> DataFrame:
    """One row per gate: an aggregate over a table, passed when it is true.

    ``checks`` maps a gate to (table, boolean aggregate); tables are shared lazily.
    """
    parts = [df.agg(F.coalesce(test, F.lit(True)).alias("passed")).select(F.lit(name).alias("gate"), "passed") for name, (df, test) in checks.items()]
    return reduce(DataFrame.unionByName, parts)


def none_left() -> Column:
    """Aggregate that holds when the table is empty."""
    return F.count("*") == 0


def ready(gates: DataFrame) -> DataFrame:
    return gates.agg(F.coalesce(F.bool_and("passed"), F.lit(True)).alias("gate_ready"))


def verdict(severities: DataFrame) -> DataFrame:
    """Content audit verdict from issue severities."""
    critical = F.count_if(F.col("severity") == "critical")
    high = F.count_if(F.col("severity") == "high")
    return severities.agg(critical.alias("critical"), high.alias("high")).select(
        "critical",
        "high",
        F.when((F.col("critical") > 0) | (F.col("high") > 5), "FIX_REQUIRED")
        .when(F.col("high") > 0, "READY_WITH_NOTES")
        .otherwise("READY_FOR_PRODUCTION")
        .alias("verdict"),
    )


def row_count_parity(expected: DataFrame, published: DataFrame) -> DataFrame:
    """Expected against published counts per table; both are ``(table, n)``."""
    return (
        expected.select("table", F.col("n").alias("expected"))
        .join(published.select("table", F.col("n").alias("actual")), "table", "full_outer")
        .withColumn("passed", F.col("expected").eqNullSafe(F.col("actual")))
    )


def type_default_sample(options: DataFrame, doc_order: str = "doc", docs: int = 5, per_doc: int = 3) -> DataFrame:
    """First options of the first documents with whether default and type agree.

    ``options(doc, idx, name, type, default_kind, default_value)``; a sampling operator,
    so its two limits are the feature.
    """
    first_docs = options.select(doc_order).distinct().orderBy(doc_order).limit(docs)
    # At most ``docs`` rows.
    picked = options.join(F.broadcast(first_docs), doc_order).filter(F.col("idx") < per_doc)
    kind, typ, value = F.col("default_kind"), trim_ws("type"), F.col("default_value")
    number = typ.isin(INT_TYPES)
    absent = kind.isNull() | (kind == "null") | ((kind == "string") & (value == ""))
    agree = (
        absent
        | ((kind == "string") & (value == "required"))
        | (number & kind.isin("int", "bool"))
        | (typ.isin(STRING_TYPES) & (kind == "string"))
        | (typ.isin(BOOL_TYPES) & (kind == "bool"))
        | (typ != "")
    )
    return picked.withColumn("agrees", F.coalesce(agree, F.lit(False)))


# Type names that count as numbers, texts and flags.
INT_TYPES = [
    "int", "integer", "i8", "i16", "i32", "i64", "isize", "u8", "u16", "u32", "u64", "usize", "number", "float",
    "f32", "f64", "double", "RangeInclusive<u16>", "Guid",
]
STRING_TYPES = ["string", "String", "str", "Path", "IpAddr", "Option<String>", "Option<&str>", "&str"]
BOOL_TYPES = ["bool", "boolean", "flag"]


def allow_list_findings(records: DataFrame, allowed: DataFrame, aliases: DataFrame) -> DataFrame:
    """Hints outside the allow-list: ``alias`` when an alias leads to an allowed value, else ``unknown``.

    ``records(full_name, hint)``, ``allowed(value)``, ``aliases(alias, target)``.
    Distinct hints are looked up once; records are joined to the answers.
    """
    hints = records.select("hint").filter("hint IS NOT NULL").distinct()
    ok = allowed.select(F.col("value").alias("hint")).distinct()
    odd = hints.join(ok, "hint", "left_anti")
    known = aliases.select(F.col("alias").alias("hint"), "target").join(
        ok.withColumnRenamed("hint", "target"), "target", "left_semi"
    )
    answers = odd.join(known, "hint", "left").withColumn(
        "reason", F.when(F.col("target").isNotNull(), "alias").otherwise("unknown")
    )
    return records.join(answers, "hint").select("full_name", "hint", "target", "reason")


def fix_hints(records: DataFrame, aliases: DataFrame, allowed: DataFrame) -> DataFrame:
    """Records with alias hints rewritten to their allowed target."""
    ok = allowed.select(F.col("value").alias("target")).distinct()
    known = aliases.join(ok, "target", "left_semi").select(F.col("alias").alias("hint"), "target")
    return records.join(known, "hint", "left").withColumn("hint", F.coalesce("target", "hint")).drop("target")


def alias_table_findings(aliases: DataFrame, allowed: DataFrame) -> DataFrame:
    """Aliases whose target is not allowed, and aliases that are allowed values themselves."""
    ok = allowed.select("value").distinct()
    lost = aliases.join(ok, aliases["target"] == ok["value"], "left_anti").withColumn("reason", F.lit("target_not_allowed"))
    own = aliases.join(ok, aliases["alias"] == ok["value"], "left_semi").withColumn("reason", F.lit("alias_is_allowed"))
    return lost.unionByName(own)


def status_findings(progress: DataFrame) -> DataFrame:
    """Contradictions of status documents, one row per broken rule.

    ``progress(doc, parsed, present, mapping, status, phases map<string, struct<status,
    pending, current_batch>>, audit_present, audit_parsed, overall_verdict, critical
    array, high array)``.
    """

    def complete(c: Column) -> Column:
        return F.coalesce(F.lower(trim_ws(c)).isin(COMPLETE), F.lit(False))

    def filled(c: Column) -> Column:
        return F.coalesce(F.size(c), F.lit(0)) > 0

    phases = F.col("phases")
    usable = F.col("present") & F.col("parsed") & F.col("mapping")
    deep, audit = phases.getItem("deepening"), phases.getItem("audit")
    done = complete(F.col("status"))
    open_phases = F.filter(F.map_entries(phases), lambda e: ~complete(e["value"]["status"]))
    verdict_ready = F.col("overall_verdict").isin(READY_VERDICTS)
    audited = usable & complete(audit["status"])
    rules = [
        blocking("progress.parse", F.col("present") & ~F.col("parsed")),
        blocking("progress.missing", ~F.col("present")),
        blocking("progress.shape", F.col("present") & F.col("parsed") & ~F.col("mapping")),
        blocking("progress.complete_requires_phases", usable & done & phases.isNull()),
        blocking("progress.deepening_pending_must_be_empty", usable & complete(deep["status"]) & filled(deep["pending"])),
        blocking(
            "progress.deepening_current_batch_must_be_empty",
            usable & complete(deep["status"]) & filled(deep["current_batch"]),
        ),
        blocking("progress.audit_requires_parseable_audit_report", audited & F.col("audit_present") & ~F.col("audit_parsed")),
        blocking("progress.audit_requires_audit_report", audited & ~F.col("audit_present")),
        blocking(
            "audit.ready_verdict_forbidden_with_critical_issues",
            F.col("audit_parsed") & verdict_ready & filled(F.col("critical")),
        ),
        blocking(
            "audit.ready_verdict_forbidden_with_high_issues", F.col("audit_parsed") & verdict_ready & filled(F.col("high"))
        ),
    ]
    single = rule_findings(progress, rules, ["doc"])
    per_phase = (
        progress.filter(usable & done & phases.isNotNull())
        .select("doc", F.explode(open_phases).alias("p"))
        .select(
            "doc",
            F.lit("blocking").alias("severity"),
            F.lit("progress.complete_requires_all_phases_complete").alias("reason"),
            F.col("p.key").alias("detail"),
        )
    )
    return single.unionByName(per_phase)


# Status words that mean done, and verdicts that mean ready.
COMPLETE = ["complete", "completed"]
READY_VERDICTS = ["READY_FOR_PRODUCTION", "VERIFIED_DEEP"]


def overall_verdict(gates: DataFrame, production: bool = False) -> DataFrame:
    """PASS, WARN, FAIL or BLOCKED over ``gates(gate, status)``, and whether ready is allowed.

    A failed parse or status gate blocks; a failed scope gate fails; warnings warn.
    """

    def has(gate: list[str], status: str) -> Column:
        return F.coalesce(F.bool_or(F.col("gate").isin(gate) & (F.col("status") == status)), F.lit(False))

    state = (
        F.when(has(["parse", "status"], "FAIL"), "BLOCKED").when(has(["scope"], "FAIL"), "FAIL")
        .when(has(["scope"], "WARN"), "WARN").otherwise("PASS")
    )
    out = gates.agg(state.alias("overall_status"))
    allowed = (F.col("overall_status") == "PASS") | ((F.col("overall_status") == "WARN") & F.lit(not production))
    return out.withColumn("ready_state_allowed", allowed)
