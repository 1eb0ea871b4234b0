"""Document extraction over narrative documents that Spark writes from the part and documents tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from factgraph.functions import classify, text
from factgraph.operators import extract
from factgraph.plans import bindings as b
from factgraph.plans.registry import query
from factgraph.session import spread

# --- documents --------------------------------------------------------------------

# One narrative document per part. Marked words are replaced by the part's columns, none
# of which holds a character that JSON would escape.
_TEMPLATE = """{
 "name": "@name", "summary": "@type",
 "architecture": {
   "module_breakdown": [
     {"module": "@module", "responsibility": "@type  of @brand", "key_files": ["a.py", " ", "@type"]},
     {"key_files": ["@brand/x"]}, "no mapping"],
   "key_abstractions": [{"purpose": "@type"}],
   "components": [{"component": "@brand", "description": "@name"}]},
 "key_features": ["@name", "@NAME", {"feature": "@type", "description": "@brand"}],
 "type": "@type, @brand\\n/route, @type",
 "languages": ["@type", "@lowtype", "@brand,@name"],
 "ports": {"http": @size, "rpc": {"port": 1@size}, "none": [1]},
 "configuration": {"options": [{"key": "@brand", "type": "str", "default": "@type"}], "size": @size,
                   "group": {"options": [{"name": "@name"}]}, "flat": [{"@lowtype": 1}]},
 "environment_variables": [{"name": "@type", "default": "@brand"}],
 "environment": {"base": ["@type", " ", 3]},
 "cli_arguments": [{"flag": "--@type", "default": @size}, {"name": "--@lowtype"}],
 "common_tasks": [{"task": "make @type", "steps": ["one", "@brand"]}, "@name"],
 "commands": {"start": "docker run @brand", "tell": "@name", "skip": 4},
 "testing": {"framework": "@name", "notes": {"run": "pytest @brand\\nplain @type"}},
 "quick_reference": [{"topic": "@name", "content": "pip install @type"}, {"topic": "@brand", "content": "@type"}],
 "integrations": {"api_hooks": {"a": "/v1/@type", "path": "/v2/@size"}, "tools": ["@type", "@name", "@lowtype"]},
 "api_structure": {"rest": [{"path": "/p/@size", "method": "GET", "operations": "/skipped"}]},
 "api_surface": {"http_endpoints": {"v1": [{"route": "/r/@size", "purpose": "@type"}]},
                 "public_functions": [{"name": "@name", "signature": "@type()"}]},
 "extension_points": [{"location": "hooks/@type.py", "hook": "@name", "example": "@brand"}, {"hook": "@type"}],
 "sdk_usage": {"py_client": "pip install @lowtype==1.0"},
 "cross_references": {"external": ["@type>=2", {"name": "@lowtype"}]},
 "supported_protocols": ["@type", {"name": "@brand", "role": "@name"}],
 "related_repos": "@name, @NAME",
 "implementation_patterns": [{"pattern": "@name", "description": "@type", "location": "@type.go:3"}],
 "troubleshooting": [{"symptom": "@name", "cause": "@type", "confidence": @sure}],
 "mystery": "@odd"
}"""


def fill(template):
    """The template, a text or a text column, with the part row's values in place of its marks."""
    out = F.lit(template) if isinstance(template, str) else template
    marks = [
        ("@module", F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("src/"), "p_type", F.lit(".py"))).otherwise(F.col("p_name"))),
        ("@odd", F.when(F.col("p_size") % 5 == 0, F.lit("")).otherwise(F.col("p_name"))),
        ("@sure", F.when(F.col("p_size") % 2 == 0, F.lit("0.5")).otherwise(F.lit("7"))),
        ("@lowtype", F.lower("p_type")),
        ("@NAME", F.upper("p_name")),
        ("@name", F.col("p_name")),
        ("@brand", F.col("p_brand")),
        ("@type", F.col("p_type")),
        ("@size", F.col("p_size").cast("string")),
        ("@key", F.col("p_partkey").cast("string")),
    ]
    for mark, value in marks:
        out = F.replace(out, F.lit(mark), value)
    return out


def filled(spark, sf, template):
    """One document per part; the parts are dealt over tasks before documents are made of them."""
    parts = spread(b.table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size"))
    return parts.select(
        F.concat(F.lit("repo::p"), "p_partkey").alias("node_id"),
        F.concat(F.lit("shard"), F.col("p_partkey") % 3).alias("shard"),
        F.concat(F.lit("deep/p"), "p_partkey", F.lit(".yaml")).alias("path"),
        F.lit("2024-01-01").alias("as_of"),
        F.parse_json(fill(template)).alias("body"),
    )


def documents(spark, sf):
    return filled(spark, sf, _TEMPLATE)


SHOWN = ["node_id", "predicate", "object_kind", "object_value", "note", "confidence", "source_section"]


def extracted(spark, sf, sections):
    return extract.section_facts(extract.document_sections(documents(spark, sf)), sections).select(SHOWN)


def _facts_sql(rows: list[tuple]) -> str:
    """Expected facts: predicate, kind, value, note, confidence, section, optional condition."""
    parts = []
    for predicate, kind, value, note, confidence, section, *where in rows:
        parts.append(
            f"SELECT 'repo::p' || p_partkey AS node_id, '{predicate}' AS predicate, {kind} AS object_kind, {value} AS object_value, "
            f"{note} AS note, {confidence} AS confidence, '{section}' AS source_section FROM part"
            + (f" WHERE {where[0]}" if where else "")
        )
    return " UNION ALL ".join(parts)


LOW = "lower(p_type)"
# p_type is one upper-case word, so it differs from its lower-case form, the brand and the name.
COMPONENTS_SQL = _facts_sql(
    [
        ("has_component", "CASE WHEN p_partkey % 3 = 0 THEN 'path' ELSE 'concept' END",
         "CASE WHEN p_partkey % 3 = 0 THEN 'src/' || p_type || '.py' ELSE p_name END",
         "'responsibility: ' || p_type || ' of ' || p_brand || '; key_files: a.py, ' || p_type", 0.78, "architecture.module_breakdown[0]"),
        ("has_component", "'path'", "p_brand || '/x'", "'key_files: ' || p_brand || '/x'", 0.78, "architecture.module_breakdown[1]"),
        ("has_component", "'concept'", "p_type", "p_type", 0.74, "architecture.key_abstractions[0]"),
        ("has_component", "'concept'", "p_brand", "p_name", 0.72, "architecture.components[0]"),
        ("has_component", "'concept'", "p_name", "NULL", 0.67, "key_features[0]"),
        ("has_component", "'concept'", "p_type", "p_brand", 0.67, "key_features[2]"),
        ("has_component", "'concept'", "p_type", "'repository type classification'", 0.6, "type.line[0]"),
        ("has_component", "'concept'", "p_brand", "'repository type classification'", 0.6, "type.line[0]"),
        ("has_component", "'concept'", "p_type", "'language ecosystem'", 0.61, "languages[0].line[0]"),
        ("has_component", "'concept'", "p_brand", "'language ecosystem'", 0.61, "languages[2].line[0]"),
        ("has_component", "'concept'", "p_name", "'language ecosystem'", 0.61, "languages[2].line[0]"),
    ]
)


@query("extract_components", COMPONENTS_SQL)
def extract_components(spark, sf):
    return extracted(spark, sf, ["architecture", "key_features", "type", "languages"])


CONFIG_SQL = _facts_sql(
    [
        ("has_config_option", "'config_key'", "'http'", "'port: ' || p_size", 0.7, "ports.http"),
        ("has_config_option", "'config_key'", "'rpc'", "'port: 1' || p_size", 0.7, "ports.rpc"),
        ("has_config_option", "'config_key'", "p_brand", "'type: str; default: ' || p_type", 0.72, "configuration.options[0]"),
        ("has_config_option", "'config_key'", "'size'", "'default: ' || p_size || '; configuration default for size'", 0.72,
         "configuration.size"),
        ("has_config_option", "'config_key'", "p_name", "NULL", 0.72, "configuration.group.options[0]"),
        ("has_config_option", "'config_key'", LOW, "NULL", 0.72, "configuration.flat[0]"),
        ("has_config_option", "'config_key'", "p_type", "'default: ' || p_brand", 0.7, "environment_variables[0]"),
        ("has_config_option", "'config_key'", "p_type", "'environment group: base'", 0.68, "environment.base[0]"),
        ("has_config_option", "'command'", "'--' || p_type", "'default: ' || p_size", 0.7, "cli_arguments[0]"),
    ]
)


@query("extract_config_options", CONFIG_SQL)
def extract_config_options(spark, sf):
    return extracted(spark, sf, ["ports", "configuration", "environment_variables", "environment", "cli_arguments"])


TASKS_SQL = _facts_sql(
    [
        ("supports_task", "'command'", "'make ' || p_type", "'one, ' || p_brand", 0.68, "common_tasks[0]"),
        ("supports_task", "'text'", "p_name", "NULL", 0.68, "common_tasks[1]"),
        ("supports_task", "'command'", "'docker run ' || p_brand", "'command group: start'", 0.66, "commands.start"),
        ("supports_task", "'text'", "p_name", "'command group: tell'", 0.66, "commands.tell"),
        ("supports_task", "'command'", "'pytest ' || p_brand", "'testing command'", 0.67, "testing.notes.run.line[0]"),
        ("implements_pattern", "'concept'", "p_name", "'testing metadata: framework'", 0.64, "testing.framework.line[0]"),
        ("supports_task", "'command'", "'pip install ' || p_type", "'topic: ' || p_name", 0.67, "quick_reference[0].line[0]"),
        ("supports_task", "'text'", "p_brand", "'quick reference topic'", 0.58, "quick_reference[1]"),
    ]
)


@query("extract_tasks", TASKS_SQL)
def extract_tasks(spark, sf):
    return extracted(spark, sf, ["common_tasks", "commands", "testing", "quick_reference"])


INTERFACES_SQL = _facts_sql(
    [
        ("exposes_api_endpoint", "'api_route'", "'/v2/' || p_size", "NULL", 0.73, "integrations.api_hooks"),
        ("exposes_api_endpoint", "'api_route'", "'/v1/' || p_type", "NULL", 0.73, "integrations.api_hooks.a"),
        ("has_extension_point", "'concept'", "p_type", "'integration group: tools'", 0.64, "integrations.tools[0].line[0]"),
        ("has_extension_point", "'concept'", "p_name", "'integration group: tools'", 0.64, "integrations.tools[1].line[0]"),
        ("exposes_api_endpoint", "'api_route'", "'/p/' || p_size", "'GET'", 0.73, "api_structure.rest[0]"),
        ("uses_protocol", "'protocol'", "'REST'", "'inferred from api_structure section key'", 0.8, "api_structure.rest"),
        ("exposes_api_endpoint", "'api_route'", "'/r/' || p_size", "p_type", 0.8, "api_surface.http_endpoints.v1[0]"),
        ("has_extension_point", "'concept'", "p_name", "p_type || '()'", 0.73, "api_surface.public_functions[0]"),
        ("has_extension_point", "'path'", "'hooks/' || p_type || '.py'", "p_brand || '; ' || p_name", 0.71, "extension_points[0]"),
        ("has_extension_point", "'concept'", "p_type", "NULL", 0.71, "extension_points[1]"),
        ("has_extension_point", "'external_tool'", LOW, "'Py Client SDK; pip install ' || lower(p_type) || '==1.0'", 0.7,
         "sdk_usage.py_client"),
        ("has_extension_point", "'external_tool'", "p_type", "NULL", 0.69, "cross_references.external[0]"),
        ("uses_protocol", "'protocol'", "least(p_type, p_brand)", "NULL", 0.7, "supported_protocols[0]"),
        ("uses_protocol", "'protocol'", "greatest(p_type, p_brand)", "NULL", 0.7, "supported_protocols[1]"),
        ("has_extension_point", "'concept'", "p_name", "'related repository'", 0.59, "related_repos.line[0]"),
    ]
)


@query("extract_interfaces", INTERFACES_SQL)
def extract_interfaces(spark, sf):
    return extracted(
        spark, sf,
        ["integrations", "api_structure", "api_surface", "extension_points", "sdk_usage", "cross_references",
         "supported_protocols", "related_repos"],
    )


PATTERNS_SQL = _facts_sql(
    [
        ("implements_pattern", "'concept'", "p_name", "'description: ' || p_type || '; location: ' || p_type || '.go:3'", 0.8,
         "implementation_patterns[0]"),
        ("has_failure_mode", "'issue'", "p_name", "'cause: ' || p_type", "CASE WHEN p_size % 2 = 0 THEN 0.5 ELSE 0.74 END",
         "troubleshooting[0]"),
    ]
)


@query("extract_patterns_and_failures", PATTERNS_SQL)
def extract_patterns_and_failures(spark, sf):
    return extracted(spark, sf, ["implementation_patterns", "troubleshooting"])


@query(
    "extracted_by_predicate",
    "SELECT predicate, object_kind, count(*) AS facts, count(DISTINCT node_id) AS records FROM ("
    + " UNION ALL ".join([COMPONENTS_SQL, CONFIG_SQL, TASKS_SQL, INTERFACES_SQL, PATTERNS_SQL])
    + ") GROUP BY 1, 2",
)
def extracted_by_predicate(spark, sf):
    facts = extract.section_facts(extract.document_sections(documents(spark, sf)))
    return facts.groupBy("predicate", "object_kind").agg(
        F.count("*").alias("facts"), F.countDistinct("node_id").alias("records")
    )


@query(
    "unmapped_section_findings",
    """SELECT 'repo::p' || p_partkey AS repo_node_id, 'mystery' AS section, 'unmapped_section' AS reason,
'non_blocking' AS severity FROM part WHERE p_size % 5 <> 0""",
)
def unmapped_section_findings(spark, sf):
    found = extract.unmapped_section_findings(extract.document_sections(documents(spark, sf)))
    return found.select("repo_node_id", "section", "reason", "severity")


# --- whole texts ------------------------------------------------------------------

_BREAKS = r"\r\n|[\n\r\x0B\x0C\x1C\x1D\x1E\x{85}\x{2028}\x{2029}]"


def _quoted(pattern: str) -> str:
    return pattern.replace("'", "''")


LINES_SQL = rf"""
cut AS (
  SELECT doc_id, unnest(regexp_split_to_array(regexp_replace(text, '^{text.WS}+|{text.WS}+$', '', 'g'), '{_BREAKS}')) AS raw,
         generate_subscripts(regexp_split_to_array(regexp_replace(text, '^{text.WS}+|{text.WS}+$', '', 'g'), '{_BREAKS}'), 1) AS n
  FROM documents),
kept AS (
  SELECT doc_id, n, trim(regexp_replace(raw, '{text.WS}+', ' ', 'g')) AS line FROM cut),
numbered AS (
  SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id ORDER BY n) - 1 AS i FROM kept
  WHERE NOT regexp_matches(line, '^\|(.*\|)?$') AND NOT regexp_matches(line, '^[-|: ]*$')
    AND line NOT IN ('```', '```bash', '```sh', '```shell', '```zsh')),
prose AS (
  SELECT * FROM numbered
  WHERE NOT regexp_matches(line, '{_quoted(classify.COMMAND_RE)}')
    AND NOT (NOT regexp_matches(line, '{classify.VERB_RE}') AND regexp_matches(line, '{classify.CLI_FIRST_WORD_RE}'))
    AND NOT regexp_matches(line, '{classify.ROUTE_RE}')
  QUALIFY row_number() OVER (PARTITION BY doc_id, lower(line) ORDER BY i) = 1)"""


def text_documents(spark, sf):
    """Each document's whole text as the one section of a narrative document."""
    body = F.parse_json(F.to_json(F.struct(F.col("text").alias("tech_stack"))))
    return b.table(spark, sf, "documents").select(
        F.concat(F.lit("repo::d"), "doc_id").alias("node_id"), F.col("source").alias("shard"),
        F.concat("source", F.lit("/"), "doc_id").alias("path"), F.lit("2024-01-01").alias("as_of"), body.alias("body"),
    )


@query(
    "extract_text_lines",
    "WITH "
    + LINES_SQL
    + "SELECT 'repo::d' || doc_id AS node_id, line AS object_value, 'tech_stack.line[' || i || ']' AS source_section FROM prose",
)
def extract_text_lines(spark, sf):
    sections = extract.document_sections(text_documents(spark, sf))
    return extract.section_facts(sections, ["tech_stack"]).select("node_id", "object_value", "source_section")


# --- drafts -----------------------------------------------------------------------

_DRAFT = """{"facts": [
 {"fact_type": "component", "predicate": "has_component", "object_kind": "concept", "object_value": " @name ",
  "note": "@type   @brand", "confidence": "0.9", "as_of": "2024-05-01",
  "evidence": [{"kind": "file_line", "ref": "@type", "start_line": @size}, {"kind": "doc_url", "ref": "@brand"},
               {"kind": "doc_url", "ref": "@brand"}]},
 {"fact_type": "component", "predicate": "@odd", "object_kind": "concept", "object_value": "@brand", "confidence": 0.5,
  "evidence": [{"kind": "file_block", "ref": "r"}]},
 {"fact_type": "extension_point", "predicate": "has_extension_point", "object_kind": "external_tool",
  "object_value": "@name", "confidence": @sure, "evidence": [{"kind": "@lowtype", "ref": "r"}]},
 "no mapping"]}"""


def judged_drafts(spark, sf):
    return extract.judge_facts(extract.draft_facts(filled(spark, sf, _DRAFT)))


@query(
    "draft_facts_valid",
    """SELECT 'repo::p' || p_partkey AS node_id, p_name AS object_value, p_type || ' ' || p_brand AS note, 0.9 AS confidence,
'2024-05-01' AS as_of, 'facts[0]' AS source_section,
'doc_url ' || p_brand || '; file_line ' || p_type || CASE WHEN p_size >= 1 THEN ' ' || p_size ELSE '' END AS evidence FROM part""",
)
def draft_facts_valid(spark, sf):
    shown = F.transform("evidence", lambda e: F.concat_ws(" ", e["kind"], e["ref"], e["start_line"].cast("string")))
    rows = judged_drafts(spark, sf).valid.withColumn("evidence", F.array_join(shown, "; "))
    return rows.select("node_id", "object_value", "note", "confidence", "as_of", "source_section", "evidence")


@query(
    "draft_findings",
    """SELECT 'repo::p' || p_partkey AS node_id, 'facts[1]' AS source_section, 'unknown_predicate' AS reason FROM part
UNION ALL SELECT 'repo::p' || p_partkey, 'facts[2]', 'missing_object_node_id' FROM part
UNION ALL SELECT 'repo::p' || p_partkey, 'facts[2]', 'unknown_evidence_kind' FROM part
UNION ALL SELECT 'repo::p' || p_partkey, 'facts[2]', 'invalid_confidence' FROM part WHERE p_size % 2 = 1""",
)
def draft_findings(spark, sf):
    return judged_drafts(spark, sf).findings.select("node_id", "source_section", "reason")


# --- further sections ---------------------------------------------------------------

_FURTHER = """{
 "key_sections": [{"title": "@name", "summary": "@type", "location": "doc/@brand"}, "@brand", "@NAME"],
 "content_coverage": {"topics": [{"name": "@name", "depth": "@type", "resources": @size}, {"depth": "no name"}]},
 "key_files": [{"path": "lib/@lowtype.py", "description": "@name"}, "@brand/main.go"],
 "core_modules": {"b": {"path": "core/@lowtype", "description": "@name..", "submodules": ["@brand", " "]},
                  "a": {"path": "core/a", "description": "@type"}, "c": {"description": "no path"}},
 "supplementary_files": [{"file": "x/@lowtype.md", "type": "@type", "purpose": "@name"}, "skipped"],
 "primary_language": "@type, @brand",
 "vpn_protocols": ["@type", ["@brand", "@type"]],
 "api_protocols": {"name": "@name", "inner": {"name": "hidden"}},
 "code_patterns": [{"title": "@name", "description": "@type", "file_reference": "@brand.go"}],
 "cli_commands": {"go": "docker run @brand", "skip": 3},
 "procedures": [{"task": "@name", "gotchas": ["@type"]}, 7]
}"""


@query(
    "extract_further_sections",
    _facts_sql(
        [
            ("has_component", "'concept'", "p_name", "p_type", 0.69, "key_sections[0]"),
            ("has_component", "'concept'", "p_brand", "NULL", 0.69, "key_sections[1]"),
            ("has_component", "'concept'", "p_name", "'depth: ' || p_type || ', resources: ' || p_size", 0.69, "content_coverage.topics[0]"),
            ("has_component", "'path'", f"'lib/' || {LOW} || '.py'", "p_name", 0.72, "key_files[0]"),
            ("has_component", "'path'", "p_brand || '/main.go'", "NULL", 0.72, "key_files[1]"),
            ("has_component", "'path'", "'core/a'", "p_type", 0.74, "core_modules.a"),
            ("has_component", "'path'", f"'core/' || {LOW}", "p_name || '. Submodules: ' || p_brand", 0.74, "core_modules.b"),
            ("has_component", "'path'", f"'x/' || {LOW} || '.md'", "'[' || p_type || '] ' || p_name", 0.72, "supplementary_files[0]"),
            ("has_component", "'concept'", "p_type", "'primary language'", 0.66, "primary_language.line[0]"),
            ("has_component", "'concept'", "p_brand", "'primary language'", 0.66, "primary_language.line[0]"),
            ("uses_protocol", "'protocol'", "p_brand", "NULL", 0.7, "vpn_protocols[0]"),
            ("uses_protocol", "'protocol'", "p_type", "NULL", 0.7, "vpn_protocols[1]"),
            ("uses_protocol", "'protocol'", "p_name", "NULL", 0.7, "api_protocols[0]"),
            ("implements_pattern", "'concept'", "p_name", "'description: ' || p_type || '; location: ' || p_brand || '.go'", 0.8, "code_patterns[0]"),
            ("supports_task", "'command'", "'docker run ' || p_brand", "'command group: go'", 0.66, "cli_commands.go"),
            ("supports_task", "'text'", "p_name", "p_type", 0.68, "procedures[0]"),
        ]
    ),
)
def extract_further_sections(spark, sf):
    sections = extract.document_sections(filled(spark, sf, _FURTHER))
    return extract.section_facts(sections).select(SHOWN)
