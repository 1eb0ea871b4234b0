"""Fact consolidation: merge keys, duplicates, precedence, ids.

Candidates are flat rows: ``node_id, fact_type, predicate, object_kind, object_value,
object_node_id, note, confidence, as_of, source_file, source_section,
extraction_mode, evidence, pos``. ``pos`` orders them as they were extracted and is
unique. Merged evidence stays in a table of its own, one row per distinct item, so
that no group of copies is ever gathered in one cell.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factgraph.functions.text import compact_ws
from factgraph.operators.shaping import HOT_ROWS, digest_number, first_row, join_hot_apart
from factgraph.session import staged

SEP = "\x1f"
NODE_KINDS = ["repo", "external_tool"]
EVIDENCE_FIELDS = ["kind", "ref", "source_file", "excerpt", "start_line", "end_line"]
CONTENT = [
    "node_id", "fact_type", "predicate", "object_kind", "object_value", "object_node_id", "note", "confidence",
    "as_of", "source_file", "source_section", "extraction_mode",
]


def _text(*columns: str) -> Column:
    return F.concat_ws(SEP, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])


def object_key() -> Column:
    """The node for node kinds, else the value."""
    node, value = (F.coalesce(c, F.lit("")) for c in ("object_node_id", "object_value"))
    return F.when(F.col("object_kind").isin(NODE_KINDS), node).otherwise(value)


def confidence_text() -> Column:
    """Six digits as a whole number."""
    return F.bround(F.coalesce("confidence", F.lit(0.0)) * 1_000_000, 0).cast("bigint").cast("string")


def key_of(*parts: Column) -> Column:
    """The first 16 bytes of a SHA-256: short enough to move with every row, and never equal by chance."""
    return F.unhex(F.substring(F.sha2(F.concat_ws(SEP, *parts), 256), 1, 32))


def collision_text() -> list[Column]:
    return [_text("node_id", "fact_type", "predicate", "object_kind"), object_key()]


def with_collision_key(candidates: DataFrame) -> DataFrame:
    """Add ``collision_key`` (record, type, predicate and object)."""
    return candidates.withColumn("collision_key", key_of(*collision_text()))


def with_merge_key(candidates: DataFrame) -> DataFrame:
    """Add ``merge_key`` (content without section and evidence) and ``draft``."""
    key = key_of(*collision_text(), _text("note"), confidence_text(), _text("as_of", "extraction_mode"))
    return candidates.withColumn("merge_key", key).withColumn("draft", F.col("extraction_mode").eqNullSafe(F.lit("draft")))


def evidence_rows(rows: DataFrame, key: str) -> DataFrame:
    """Distinct evidence items per key."""
    return rows.select(key, F.explode("evidence").alias("e")).select(key, "e.*").distinct()


def evidence_text(of: str = "") -> Column:
    strings = [F.coalesce(F.col(of + c), F.lit("")) for c in EVIDENCE_FIELDS[:4]]
    numbers = [F.coalesce(F.col(of + c), F.lit(0)).cast("string") for c in EVIDENCE_FIELDS[4:]]
    return F.concat_ws(SEP, *strings, *numbers)


def fact_id() -> Column:
    """Stable id over content and the set of evidence, whatever the order of its items."""
    first = _text("node_id", "fact_type", "predicate", "object_kind", "object_value", "object_node_id", "note")
    last = _text("as_of", "source_file", "source_section", "extraction_mode", "evidence_count", "evidence_digest")
    return F.concat(F.lit("fact::"), F.substring(F.sha2(F.concat_ws(SEP, first, confidence_text(), last), 256), 1, 24))


@dataclass(frozen=True)
class Consolidated:
    """``facts`` with ids, their ``evidence(fact_id, ...)``, the ``ledger`` of dropped rows, and the
    ``fates(node_id, is_fact, reason)`` of all candidates for those who only count."""

    facts: DataFrame
    evidence: DataFrame
    ledger: DataFrame
    fates: DataFrame


# Keys are counted in so many buckets first; those of full buckets are counted one by one.
BUCKETS = 1 << 16


def busy_keys(keyed: DataFrame, hot_rows: int) -> DataFrame:
    """Collision keys with over ``hot_rows`` candidates.

    A bucket of keys holds at least as many rows as each of its keys, so only keys of
    buckets over the threshold are sent anywhere.
    """
    bucket = F.pmod(F.xxhash64("collision_key"), F.lit(BUCKETS))
    counted = keyed.select("collision_key", bucket.alias("bucket"))
    full = staged(counted.groupBy("bucket").agg(F.count("*").alias("n")).filter(F.col("n") > hot_rows).select("bucket"))
    if full.isEmpty():
        return full.select(F.lit(None).cast("binary").alias("collision_key")).limit(0)
    near = counted.join(F.broadcast(full), "bucket", "left_semi")
    return staged(near.groupBy("collision_key").agg(F.count("*").alias("n")).filter(F.col("n") > hot_rows).select("collision_key"))


def of_key() -> dict[str, Column]:
    """What a collision key holds: the last of its derived firsts, its first and its last draft."""
    return {
        "last_first": F.max(F.when(~F.col("draft"), F.col("first"))),
        "first_draft": F.min(F.when(F.col("draft"), F.col("first"))),
        "last_draft": F.max(F.when(F.col("draft"), F.col("last"))),
    }


def judged(rows: DataFrame) -> DataFrame:
    """Candidates, with ``first`` and ``copies`` of their merge key and ``of_key`` of their collision
    key, with their fate: ``alive`` (its evidence counts), ``is_fact`` (it stands for its key) and
    ``reason`` (why it stands in the ledger).

    Of derived rows with one merge key the earliest stands for all. A draft takes the place of
    the last of them with its collision key; of several drafts the last stays.
    """
    draft, pos = F.col("draft"), F.col("pos")
    replaced = F.col("last_draft").isNotNull() & (F.col("first") == F.col("last_first"))
    alive = F.when(draft, pos == F.col("last_draft")).otherwise(~replaced)
    reason = (
        F.when(~draft & (pos > F.col("first")), "duplicate_derived_merged")
        .when(draft & (F.col("last_first").isNotNull() | (pos > F.col("first_draft"))), "draft_precedence_override")
    )
    rows = rows.withColumn("alive", alive).withColumn("is_fact", F.col("alive") & (draft | (pos == F.col("first"))))
    return rows.withColumn("copies", F.when(draft, F.lit(1).cast("bigint")).otherwise(F.col("copies"))).withColumn("reason", reason)


def ledger_rows(rows: DataFrame) -> DataFrame:
    summary = ["node_id", "source_file", "fact_type", "predicate", "object_kind", object_key().alias("object"), "pos"]
    return rows.filter("reason IS NOT NULL").select("reason", *summary)


def consolidated_together(candidates: DataFrame) -> Consolidated:
    """Consolidation of candidates whose collision keys each fit a task.

    One exchange on the collision key; a merge key and its evidence lie within one collision key, so
    everything else is windows over that. Each of the tables is planned by itself and moves its own
    columns only; merge keys are made after the exchange, but for fates, which need nothing else of
    the content and move the key instead.
    """
    same = Window.partitionBy("collision_key", "draft", "merge_key")
    key = Window.partitionBy("collision_key")

    def fated(keyed: DataFrame) -> DataFrame:
        counted = keyed.select(
            "*", F.min("pos").over(same).alias("first"), F.max("pos").over(same).alias("last"), F.count("*").over(same).alias("copies")
        )
        return judged(counted.select("*", *[c.over(key).alias(n) for n, c in of_key().items()]))

    rows = fated(with_merge_key(candidates.repartition("collision_key")))
    narrow = with_merge_key(candidates).select("collision_key", "draft", "merge_key", "pos", "node_id")
    fates = fated(narrow.repartition("collision_key")).select("node_id", "is_fact", "reason")
    items = rows.filter("alive").select("collision_key", "merge_key", "pos", *CONTENT, "copies", "is_fact", F.posexplode_outer("evidence").alias("at", "e"))
    item = Window.partitionBy("collision_key", "merge_key", *[F.col(f"e.{f}") for f in EVIDENCE_FIELDS]).orderBy("pos", "at")
    merged = Window.partitionBy("collision_key", "merge_key")
    items = items.withColumn("new", F.col("at").isNotNull() & (F.row_number().over(item) == 1))
    items = items.withColumns({
        "evidence_count": F.sum(F.col("new").cast("bigint")).over(merged),
        "evidence_digest": F.coalesce(F.sum(F.when(F.col("new"), digest_number(evidence_text("e.")))).over(merged), F.lit(0).cast("decimal(38,0)")),
    })
    stands = F.col("is_fact") & (F.coalesce("at", F.lit(0)) == 0)
    facts = items.filter(stands).withColumn("fact_id", fact_id())
    evidence = items.withColumn("fact_id", F.max(F.when(stands, fact_id())).over(merged)).filter("new").select("fact_id", "e.*")
    return Consolidated(facts.select("fact_id", *CONTENT, "copies", "evidence_count", "evidence_digest"), evidence, ledger_rows(rows), fates)


def consolidated_apart(candidates: DataFrame, hot_rows: int) -> Consolidated:
    """Consolidation of candidates whose collision keys may be too large for a task: counts are
    combined before they are exchanged and joined back by merge key. The candidates are written
    once with their fate."""
    keyed = with_merge_key(candidates)
    merged = staged(keyed.groupBy("collision_key", "draft", "merge_key").agg(F.min("pos").alias("first"), F.max("pos").alias("last"), F.count("*").alias("copies")))
    # Keys above the threshold number at most the rows over it.
    per_key = F.broadcast(merged.groupBy("collision_key").agg(*[c.alias(n) for n, c in of_key().items()]))
    joined = join_hot_apart(keyed, merged.select("merge_key", "first", "copies"), ["merge_key"], "copies", hot_rows)
    rows = staged(judged(joined.join(per_key, "collision_key")).select("merge_key", "pos", *CONTENT, "evidence", "copies", "alive", "is_fact", "reason"))
    items = evidence_rows(rows.filter("alive"), "merge_key")
    proof = items.groupBy("merge_key").agg(
        F.count("*").alias("evidence_count"), F.sum(digest_number(evidence_text())).alias("evidence_digest")
    )
    facts = (
        rows.filter("is_fact").select("merge_key", "copies", *CONTENT)
        .join(proof, "merge_key", "left")
        .withColumn("evidence_count", F.coalesce("evidence_count", F.lit(0).cast("bigint")))
        .withColumn("evidence_digest", F.coalesce("evidence_digest", F.lit(0).cast("decimal(38,0)")))
        .withColumn("fact_id", fact_id())
    )
    evidence = join_hot_apart(
        items, facts.select("merge_key", "fact_id", "evidence_count"), ["merge_key"], "evidence_count", hot_rows
    ).drop("merge_key", "evidence_count")
    fates = rows.select("node_id", "is_fact", "reason")
    return Consolidated(facts.select("fact_id", *CONTENT, "copies", "evidence_count", "evidence_digest"), evidence, ledger_rows(rows), fates)


def consolidate(candidates: DataFrame, hot_rows: int = HOT_ROWS) -> Consolidated:
    """Merge equal derived facts, let drafts override, assign ids.

    The candidates are written once as they come. Those of collision keys with over ``hot_rows``
    are worked on apart (``consolidated_apart``), all others over one exchange
    (``consolidated_together``). A further merge of the result is not needed: derived rows are
    unique by merge key, drafts by collision key, and the extraction mode keeps the two apart.
    """
    keyed = with_collision_key(staged(candidates.select(*CONTENT, "evidence", "pos")))
    busy = busy_keys(keyed, hot_rows)
    if busy.isEmpty():
        return consolidated_together(keyed)
    # Keys above the threshold number at most the rows over it.
    busy = F.broadcast(busy)
    cold = consolidated_together(keyed.join(busy, "collision_key", "left_anti"))
    hot = consolidated_apart(keyed.join(busy, "collision_key", "left_semi"), hot_rows)
    return Consolidated(*(getattr(cold, n).unionByName(getattr(hot, n)) for n in ("facts", "evidence", "ledger", "fates")))


def consolidation_summary(result: Consolidated) -> DataFrame:
    """Facts out, records with facts, merges and overrides, in one row and one pass over the fates."""
    reason = F.col("reason")
    return result.fates.agg(
        F.count_if("is_fact").alias("total_facts"),
        F.countDistinct(F.when(F.col("is_fact"), F.col("node_id"))).alias("repos_with_facts"),
        F.count_if(reason == "draft_precedence_override").alias("draft_overrides"),
        F.count_if(reason == "duplicate_derived_merged").alias("derived_dedupe_merges"),
    )


def repo_counters(candidates: DataFrame, result: Consolidated, rejected: DataFrame, findings: DataFrame) -> DataFrame:
    """Per record: raw, merged, overridden, blocked and emitted facts, files and unmapped sections."""
    draft = F.col("extraction_mode") == "draft"
    files = (
        candidates.groupBy("node_id", "source_file", draft.alias("draft")).agg(F.count("*").alias("n"))
        .groupBy("node_id")
        .agg(
            F.count_if(~F.col("draft")).alias("narrative_files"),
            F.count_if("draft").alias("draft_files"),
            F.sum(F.when(~F.col("draft"), F.col("n")).otherwise(0)).alias("narrative_facts_raw"),
            F.sum(F.when(F.col("draft"), F.col("n")).otherwise(0)).alias("draft_facts_raw"),
        )
    )
    emitted = result.facts.groupBy("node_id").agg(F.count("*").alias("facts_emitted"))
    dropped = result.ledger.groupBy("node_id").agg(
        F.count_if(F.col("reason") == "draft_precedence_override").alias("draft_overrides"),
        F.count_if(F.col("reason") == "duplicate_derived_merged").alias("evidence_merges"),
    )
    blocked = rejected.groupBy("node_id").agg(F.count("*").alias("blocked_facts"))
    unmapped = (
        findings.filter("reason = 'unmapped_section'").groupBy(F.col("repo_node_id").alias("node_id"))
        .agg(F.count("*").alias("unmapped_sections_count"))
    )
    out = files
    for part in (emitted, dropped, blocked, unmapped):
        out = out.join(part, "node_id", "full_outer")
    out = out.na.fill(0)
    after = F.col("narrative_facts_raw") - F.col("evidence_merges")
    return out.withColumn("derived_facts_after_dedupe", after)


def best_confidence(facts: DataFrame, keys: tuple[str, ...] = ("source_file", "predicate", "object_value")) -> DataFrame:
    """Highest confidence per key, the earliest on ties; rows without predicate or value stay.

    Rows that stay anyway take their place as a key of their own, so one pass ranks all.
    """
    whole = F.col("predicate").isNotNull() & F.col("object_value").isNotNull()
    order = [F.desc(F.coalesce("confidence", F.lit(0.0))), "pos"]
    marked = facts.withColumn("_own", F.when(~whole, F.col("pos")))
    return first_row(marked, [*keys, "_own"], order).drop("_own")


def best_confidence_report(facts: DataFrame, kept: DataFrame) -> DataFrame:
    """Facts per file before and after, and how many went."""
    before = facts.groupBy("source_file").agg(F.count("*").alias("before"))
    after = kept.groupBy("source_file").agg(F.count("*").alias("after"))
    return before.join(after, "source_file").withColumn("removed", F.col("before") - F.col("after"))


def normalized_evidence(evidence: Column, source_file: Column, kinds: list[str]) -> Column:
    """Struct of the cleaned, sorted, distinct items and the first error, if any.

    ``evidence`` is the list of one fact: missing lists, incomplete rows and unknown
    kinds reject the fact.
    """
    present = F.filter(F.coalesce(evidence, F.array().cast(_EVIDENCE_ARRAY)), lambda e: e.isNotNull())

    def clean(e: Column) -> Column:
        def text(c: Column) -> Column:
            return F.trim(F.coalesce(c, F.lit("")))

        def line(c: Column) -> Column:
            return F.when(c >= 1, c)

        file = F.coalesce(F.nullif(text(e["source_file"]), F.lit("")), source_file)
        return F.struct(
            text(e["kind"]).alias("kind"),
            text(e["ref"]).alias("ref"),
            file.alias("source_file"),
            F.nullif(compact_ws(F.coalesce(e["excerpt"], F.lit(""))), F.lit("")).alias("excerpt"),
            line(e["start_line"]).alias("start_line"),
            line(e["end_line"]).alias("end_line"),
        )

    items = F.transform(present, clean)
    faults = F.transform(
        items,
        lambda e: F.when((e["kind"] == "") | (e["ref"] == "") | (F.coalesce(e["source_file"], F.lit("")) == ""),
                         F.lit("invalid_evidence_required_fields"))
        .when(~e["kind"].isin(kinds), F.concat(F.lit("unknown_evidence_kind:"), e["kind"])),
    )
    error = F.when(F.size(present) == 0, F.lit("missing_or_invalid_evidence")).otherwise(
        F.get(F.filter(faults, lambda f: f.isNotNull()), F.lit(0))
    )
    return F.struct(F.array_sort(F.array_distinct(items)).alias("items"), error.alias("error"))


_EVIDENCE_ARRAY = (
    "array<struct<kind:string,ref:string,source_file:string,excerpt:string,start_line:int,end_line:int>>"
)
EVIDENCE_ARRAY = _EVIDENCE_ARRAY
