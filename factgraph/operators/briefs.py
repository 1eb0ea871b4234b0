"""Pattern, failure and typicality briefs over facts joined to records.

Rows with a null ``object_value`` carry no value to report and are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factgraph.functions.text import casefold, fraction, matches_term, norm_term, py_casefold, py_norm_term, trim_ws
from factgraph.operators.lookup import in_category, pattern_scope
from factgraph.operators.shaping import first_n, listed
from factgraph.session import BROADCAST_ROW_LIMIT

# Wordings that count as the same term in failure briefs.
TERM_ALIASES = {
    "batch upsert": ("batch writes", "batch insertions"),
    "batch upserts": ("batch writes", "batch insertions"),
}
# Limits of the briefs.
RELIABLE_SCOPE = 5
EXAMPLES = 3
NOTES = 2
ESTABLISHED_COUNT, ESTABLISHED_FRACTION = 2, 0.20
THIN_NOTE = (
    "Fewer than 5 repos contribute failure modes in this category; treat preflight as "
    "directional rather than representative."
)
EMPTY_NOTE = "No failure-mode-bearing repos exist in this category scope yet."

SIGNAL_PREDICATES = {"pattern": "implements_pattern", "component": "has_component", "protocol": "uses_protocol"}


def _display() -> Column:
    """Full name, else name, else id; empty text counts as missing."""
    return F.coalesce(F.nullif("full_name", F.lit("")), F.nullif("name", F.lit("")), F.col("node_id"))


def _bounded(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast a result whose row count cannot exceed ``rows``."""
    return F.broadcast(df) if rows <= BROADCAST_ROW_LIMIT else df


def _folded(rows: DataFrame, *texts: str) -> DataFrame:
    """Rows with the folded and the normalised form of each text, empty when missing."""
    forms = {}
    for t in texts:
        filled = F.coalesce(t, F.lit(""))
        forms |= {f"folded_{t}": casefold(filled), f"normal_{t}": norm_term(filled)}
    return rows.withColumns(forms)


def _pairs(*texts: str) -> list[tuple[str, str]]:
    return [(f"folded_{t}", f"normal_{t}") for t in texts]


def _numbers(conditions: Sequence[str]) -> Column:
    """One row per condition that holds, with its number; other conditions give null rows."""
    return F.expr("explode(array(" + ", ".join(f"CASE WHEN {c} THEN {i} END" for i, c in enumerate(conditions)) + "))")


def scope_repo_count(facts: DataFrame, repos: DataFrame, predicate: str, category: str | None = None) -> DataFrame:
    """Distinct records with a fact of the predicate; a value filter never applies here."""
    scope = pattern_scope(facts, repos, predicate, category)
    return scope.agg(F.countDistinct("node_id").alias("scope_repo_count"))


def pattern(
    facts: DataFrame,
    repos: DataFrame,
    predicate: str,
    category: str | None = None,
    value: str | None = None,
    limit: int = 20,
) -> DataFrame:
    """Distinct (record, value, kind) rows by name and value."""
    return (
        pattern_scope(facts, repos, predicate, category, value)
        .select("node_id", "name", "category", "object_value", "object_kind")
        .distinct()
        .orderBy("name", "object_value", "node_id", "object_kind")
        .limit(limit)
    )


def pattern_frequency(
    facts: DataFrame,
    repos: DataFrame,
    predicate: str,
    category: str | None = None,
    value: str | None = None,
    limit: int = 20,
) -> DataFrame:
    """Values by the number of records that show them, with three example records."""
    pairs = (
        pattern_scope(facts, repos, predicate, category, value)
        .filter("object_value IS NOT NULL")
        .select("object_value", "node_id", "name", "full_name")
        .distinct()
    )
    top = (
        pairs.groupBy("object_value")
        .agg(F.count("*").alias("repo_count"))
        .orderBy(F.desc("repo_count"), casefold("object_value"), "object_value")
        .limit(limit)
    )
    shown = pairs.join(_bounded(top.select("object_value"), limit), "object_value")
    examples = listed(
        first_n(shown, ["object_value"], ["name", "node_id"], EXAMPLES).withColumn("shown", _display()),
        ["object_value"],
        "shown",
        "example_repos",
    )
    scope = scope_repo_count(facts, repos, predicate, category).scalar()
    return (
        top.join(_bounded(examples, limit), "object_value")
        .withColumn("scope_repo_count", scope)
        .withColumn("repo_fraction", fraction(F.col("repo_count"), F.col("scope_repo_count")))
        .orderBy(F.desc("repo_count"), casefold("object_value"), "object_value")
    )


def scope_assessment(count: Column) -> Column:
    return F.when(count <= 0, "empty").when(count < RELIABLE_SCOPE, "thin").otherwise("normal")


def failure_reliability(facts: DataFrame, repos: DataFrame, category: str) -> DataFrame:
    """One row: how many records carry failure modes and what that allows to say."""
    count = F.col("scope_repo_count")
    return scope_repo_count(facts, repos, "has_failure_mode", category).select(
        "scope_repo_count",
        scope_assessment(count).alias("scope_assessment"),
        F.when(count <= 0, EMPTY_NOTE).when(count < RELIABLE_SCOPE, THIN_NOTE).alias("note"),
    )


def failure_brief(
    facts: DataFrame,
    repos: DataFrame,
    category: str,
    terms: Sequence[str] = ("",),
    limit: int = 10,
    note_chars: int | None = None,
) -> DataFrame:
    """Failure modes of a category per term, all terms in one job.

    Notes differ when their whole texts do; ``note_chars`` shortens what is shown.

    A term matches value or note, in any known wording. Every row is tested against
    the given terms inside a projection, so no term × row join is planned.
    """
    rows = (
        pattern_scope(facts, repos, "has_failure_mode", category)
        .filter("object_value IS NOT NULL")
        .select("node_id", "name", "full_name", "object_value", "note")
        .distinct()
    )
    tests = [matches_term(t, _pairs("object_value", "note"), TERM_ALIASES.get(py_norm_term(t), ())) for t in terms]
    hits = _folded(rows, "object_value", "note").withColumn("term_no", _numbers(tests)).filter("term_no IS NOT NULL")
    counts = (
        hits.select("term_no", "object_value", "node_id").distinct().groupBy("term_no", "object_value")
        .agg(F.count("*").alias("repo_count"))
    )
    key = ["term_no", "object_value"]
    by_count = [F.desc("repo_count"), casefold("object_value"), "object_value"]
    top = first_n(counts, ["term_no"], by_count, limit, "rank")
    bound = len(terms) * limit
    shown = hits.join(_bounded(top.select(*key), bound), key)

    records = shown.select(*key, "node_id", "name", "full_name").distinct()
    examples = listed(
        first_n(records, key, ["name", "node_id"], EXAMPLES).withColumn("shown", _display()),
        key, "shown", "example_repos",
    )
    cut = shown.filter("note <> ''").withColumn("cut", trim_ws("note"))
    firsts = cut.groupBy(*key, "cut").agg(F.min(F.struct("name", "node_id", "note")).alias("first"))
    chosen = first_n(firsts, key, ["first", "cut"], NOTES)
    if note_chars is not None:
        chosen = chosen.withColumn("cut", F.substring("cut", 1, note_chars))
    notes = listed(chosen, key, "cut", "evidence_notes")

    scope = scope_repo_count(facts, repos, "has_failure_mode", category).scalar()
    term = F.element_at(F.array(*[F.lit(t) for t in terms]), F.col("term_no") + 1)
    return (
        top.join(_bounded(examples, bound), key)
        .join(_bounded(notes, bound), key, "left")
        .select(
            "term_no",
            term.alias("term"),
            "rank",
            F.col("object_value").alias("failure_mode"),
            "repo_count",
            fraction(F.col("repo_count"), scope).alias("repo_fraction"),
            "example_repos",
            F.coalesce("evidence_notes", F.array().cast("array<string>")).alias("evidence_notes"),
            scope.alias("scope_repo_count"),
        )
        .orderBy("term_no", "rank")
    )


def signal_facts(facts: DataFrame, repos: DataFrame, category: str) -> DataFrame:
    """Facts that count for typicality: patterns, protocols and components that are no path."""
    wanted = F.col("predicate").isin("implements_pattern", "uses_protocol") | (
        (F.col("predicate") == "has_component") & (F.col("object_kind") != "path")
    )
    members = repos.filter(in_category(category)).select("node_id", "name", "full_name")
    return facts.filter(wanted).join(members, "node_id")


def corpus_health(facts: DataFrame, repos: DataFrame, category: str) -> DataFrame:
    """One row: records in the category and facts that count for typicality."""
    members = repos.filter(in_category(category)).agg(F.count("*")).scalar()
    return signal_facts(facts, repos, category).agg(
        F.count("*").alias("fact_count_in_scope"),
    ).select(members.alias("scope_repo_count"), "fact_count_in_scope")


def riskcheck(
    facts: DataFrame,
    repos: DataFrame,
    category: str,
    patterns: Sequence[str] = (),
    components: Sequence[str] = (),
    protocols: Sequence[str] = (),
    limit: int = 0,
    preflight: bool = False,
) -> DataFrame:
    """How usual each term is among the records of a category.

    The fraction is over all records of the category. Terms without a match stay as
    ``absent``. ``limit > 0`` cuts the ordered list; ``preflight`` adds up to three
    failure modes to every term that is not established.
    """
    asked = [("pattern", t) for t in patterns] + [("component", t) for t in components] + [("protocol", t) for t in protocols]
    if not asked:
        raise ValueError("give at least one pattern, component or protocol")
    spark = facts.sparkSession
    signals = spark.createDataFrame(
        [(i, kind, term, SIGNAL_PREDICATES[kind], py_casefold(term)) for i, (kind, term) in enumerate(asked)],
        "pos int, input_kind string, input_term string, predicate string, folded string",
    )
    rows = (
        signal_facts(facts, repos, category)
        .filter("object_value IS NOT NULL")
        .select("predicate", "node_id", "name", "full_name", "object_value")
        .distinct()
    )
    tests = [f"predicate = '{SIGNAL_PREDICATES[kind]}' AND {matches_term(term, _pairs('object_value'))}" for kind, term in asked]
    hits = _folded(rows, "object_value").withColumn("pos", _numbers(tests)).filter("pos IS NOT NULL")
    per_repo = hits.groupBy("pos", "node_id", "name", "full_name").agg(F.min("object_value").alias("first_value"))
    counts = per_repo.groupBy("pos").agg(F.count("*").alias("matched_repo_count"))
    examples = listed(
        first_n(per_repo, ["pos"], ["name", "first_value", "node_id"], EXAMPLES).withColumn("shown", _display()),
        ["pos"], "shown", "example_repos",
    )
    per_value = hits.groupBy("pos", "object_value").agg(F.min("name").alias("first_name"))
    values = listed(
        first_n(per_value, ["pos"], ["first_name", "object_value"], EXAMPLES), ["pos"], "object_value", "matched_values"
    )
    scope = repos.filter(in_category(category)).agg(F.count("*")).scalar()
    none = F.array().cast("array<string>")
    count = F.coalesce("matched_repo_count", F.lit(0).cast("bigint"))
    share = F.col("matched_repo_fraction")
    bounded = [_bounded(t, len(asked)) for t in (counts, examples, values)]
    out = _bounded(signals, len(asked))
    for part in bounded:
        out = out.join(part, "pos", "left")
    out = (
        out.withColumn("matched_repo_count", count)
        .withColumn("scope_repo_count", scope)
        .withColumn("matched_repo_fraction", fraction(F.col("matched_repo_count"), F.col("scope_repo_count")))
        .withColumn("matched_values", F.coalesce("matched_values", none))
        .withColumn("example_repos", F.coalesce("example_repos", none))
        .withColumn(
            "bucket",
            F.when(F.col("matched_repo_count") == 0, "absent")
            .when((F.col("matched_repo_count") >= ESTABLISHED_COUNT) & (share >= ESTABLISHED_FRACTION), "established")
            .otherwise("rare"),
        )
        .withColumn("bucket_order", F.when(F.col("bucket") == "established", 1).when(F.col("bucket") == "rare", 2).otherwise(3))
    )
    order = ["bucket_order", F.desc("matched_repo_count"), "folded", "pos"]
    out = out.orderBy(*order)
    if limit > 0:
        out = out.limit(limit)
    columns = ["pos", "bucket", "input_kind", "input_term", "predicate", "matched_repo_count", "matched_repo_fraction",
               "matched_values", "example_repos", "scope_repo_count", "bucket_order", "folded"]
    out = out.select(*columns)
    if preflight:
        unique = list(dict.fromkeys(term for _, term in asked))
        brief = failure_brief(facts, repos, category, unique, 3)
        warnings = (
            brief.groupBy("term")
            .agg(F.array_sort(F.collect_list(F.struct("rank", "failure_mode", "repo_count", "repo_fraction"))).alias("w"))
            .select(F.col("term").alias("input_term"), "w")
        )
        empty = F.array().cast("array<struct<rank:int,failure_mode:string,repo_count:bigint,repo_fraction:double>>")
        out = out.join(_bounded(warnings, len(unique)), "input_term", "left").withColumn(
            "preflight_warnings", F.when(F.col("bucket") != "established", F.coalesce("w", empty))
        ).drop("w")
    return out.orderBy(*order).drop("bucket_order", "folded")


def riskcheck_counts(signals: DataFrame) -> DataFrame:
    """Signals per bucket after any cut."""
    return signals.agg(
        F.count_if(F.col("bucket") == "established").alias("established_in_category"),
        F.count_if(F.col("bucket") == "rare").alias("rare_in_category"),
        F.count_if(F.col("bucket") == "absent").alias("absent_from_category"),
    )
