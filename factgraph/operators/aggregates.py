"""Counts, frequencies and coverage figures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factgraph.functions.text import iso_seconds, non_blank, parse_as_of, percentage


def stats(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per table."""
    counts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table"), "n") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def group_counts(df: DataFrame, column: str, top: int = 20) -> DataFrame:
    """Largest groups first with the number of all groups; null is a group."""
    groups = df.groupBy(F.col(column).alias("key")).agg(F.count("*").alias("count"))
    total = groups.agg(F.count("*")).scalar()
    return groups.orderBy(F.desc("count"), F.asc_nulls_first("key")).limit(top).withColumn("total_groups", total)


def category_counts(repos: DataFrame, facts: DataFrame, top: int = 20) -> DataFrame:
    """Records and facts per category; facts are summed per record before the join."""
    per_repo = facts.groupBy("node_id").agg(F.count("*").alias("n"))
    fact_counts = (
        repos.select("node_id", "category").join(per_repo, "node_id").groupBy("category").agg(F.sum("n").alias("fact_count"))
    )
    groups = repos.groupBy("category").agg(F.count("*").alias("count"))
    total = groups.agg(F.count("*")).scalar()
    top_groups = groups.orderBy(F.desc("count"), F.asc_nulls_first("category")).limit(top)
    return (
        top_groups.join(fact_counts, top_groups["category"].eqNullSafe(fact_counts["category"]), "left")
        .select(
            top_groups["category"].alias("key"),
            "count",
            # A null category never gets facts, as a lookup by null finds none.
            F.coalesce("fact_count", F.lit(0).cast("bigint")).alias("fact_count"),
        )
        .withColumn("total_groups", total)
        .orderBy(F.desc("count"), F.asc_nulls_first("key"))
    )


def counts_by(df: DataFrame, *columns: str) -> DataFrame:
    """Plain grouped counts, keys in order."""
    return df.groupBy(*columns).agg(F.count("*").alias("n")).orderBy(*columns)


def coverage(inputs: DataFrame, compiled: DataFrame, record_type: str) -> DataFrame:
    """Input rows, rows that came through, and the share in percent."""
    done = compiled.agg(F.count("*")).scalar()
    return inputs.agg(F.count("*").alias("input_total")).select(
        F.lit(record_type).alias("record_type"),
        "input_total",
        done.alias("compiled_total"),
        percentage(done, F.col("input_total")).alias("coverage_pct"),
    )


def field_presence(df: DataFrame, group: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Per group and field: rows with a non-blank value, all rows, percent."""
    flags = [F.count(non_blank(f)).alias(f) for f in fields]
    wide = df.groupBy(*group).agg(F.count("*").alias("total"), *flags)
    return wide.unpivot([*group, "total"], list(fields), "field", "present").withColumn(
        "present_pct", percentage(F.col("present"), F.col("total"))
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with the count."""
    return df.groupBy(*keys).agg(F.count("*").alias("occurrences")).filter("occurrences > 1")


def duplicate_occurrences(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Every row of a duplicated key as its own row, so no group is gathered in one cell."""
    return df.select(*keys, *columns).join(duplicate_keys(df, keys), list(keys))


def linked_pair_conflicts(df: DataFrame, key: str, name: str, kind: str) -> DataFrame:
    """Keys linking more than one name, a kind twice, or more than two rows."""
    per_kind = df.groupBy(key, kind).agg(
        F.count("*").alias("n"), F.min(name).alias("low"), F.max(name).alias("high"), F.count(name).alias("named")
    )
    return (
        per_kind.groupBy(key)
        .agg(
            F.sum("n").alias("rows"),
            F.max("n").alias("max_per_kind"),
            (F.min("low") != F.max("high")).alias("names_differ"),
        )
        .withColumn("names_differ", F.coalesce("names_differ", F.lit(False)))
        .filter((F.col("rows") > 2) | (F.col("max_per_kind") > 1) | F.col("names_differ"))
    )


def fact_quality(facts: DataFrame) -> DataFrame:
    """Share of facts with evidence and with a valid confidence, 100.0 when there are none."""
    total = F.count("*")
    evident = F.count_if(F.size("evidence") > 0)
    confident = F.count_if(F.col("confidence").between(0.0, 1.0))
    return facts.agg(
        total.alias("facts"),
        percentage(evident, total, 100.0).alias("evidence_coverage_pct"),
        percentage(confident, total, 100.0).alias("confidence_coverage_pct"),
    )


def snapshot_time(*frames: DataFrame, column: str = "as_of") -> DataFrame:
    """Newest parsable instant over the frames as text; the epoch when there is none."""
    newest = [df.agg(F.max(parse_as_of(column)).alias("ts")) for df in frames]
    return reduce(DataFrame.unionByName, newest).agg(
        F.coalesce(iso_seconds(F.max("ts")), F.lit("1970-01-01T00:00:00Z")).alias("generated_at_utc")
    )


def snapshot_skew(sources: DataFrame, column: str = "generated_at_utc", limit_seconds: int = 300) -> DataFrame:
    """Largest distance between source times; above the limit only a warning."""
    ts = parse_as_of(column)
    skew = F.unix_timestamp(F.max(ts)) - F.unix_timestamp(F.min(ts))
    return sources.agg(F.coalesce(skew, F.lit(0).cast("bigint")).alias("skew_seconds")).withColumn(
        "warning", F.col("skew_seconds") > limit_seconds
    )


def subtree_counts(files: DataFrame, group: Sequence[str], path: str = "path") -> DataFrame:
    """Files below every directory: each file counts once for every ancestor."""
    depth = F.size(F.split(F.col(path), "/")) - 1
    levels = F.when(depth > 0, F.sequence(F.lit(1), depth))
    rows = files.select(*group, F.col(path).alias("_path"), F.explode(levels).alias("_level"))
    rows = rows.select(*group, F.expr("substring_index(_path, '/', _level)").alias("dir"))
    return rows.groupBy(*group, "dir").agg(F.count("*").alias("files"))


def flag_counts(df: DataFrame, **flags: Column) -> DataFrame:
    """One row with the total and the count of each named condition."""
    return df.agg(F.count("*").alias("total"), *[F.count_if(c).alias(n) for n, c in flags.items()])
