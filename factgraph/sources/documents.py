"""Document and tree scans."""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factgraph.sources import filescan

# Directories never listed in a source tree.
IGNORED_DIRS = [
    ".git", ".hg", ".svn", "__pycache__", ".mypy_cache", ".pytest_cache", ".ruff_cache", ".tox", ".venv", "venv",
    "node_modules", "dist", "build", "coverage", ".next", ".turbo", ".cache", "target", "out", "tmp", "vendor",
]


def listed_paths(files: DataFrame) -> DataFrame:
    """``path`` of every file a scan was planned over, files of no bytes included; only for
    stores that Spark alone can open, see ``binary_files``."""
    paths = [unquote(p) for p in files.inputFiles()]
    rows = [(re.sub("^file:///", "file:/", p),) for p in paths]
    spark = files.sparkSession
    return spark.createDataFrame(rows, "path string") if rows else files.select("path").limit(0)


def binary_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """``path, length, content`` of the files of a folder (or of a pattern of folders) whose
    names fit ``pattern``; empty ones have content of no bytes.

    As in all of Spark, names that begin with ``_`` or ``.`` are hidden. Tasks list and read
    the folders themselves (``filescan``). Where only Spark's readers reach a store, they
    read it, and its empty files come from the index that the driver holds for that read.
    """
    if filescan.scheme_of(folder) in filescan.SCHEMES:
        base, below = filescan.split_pattern(folder)
        listed = filescan.list_files(spark, base, below, pattern, deep=False, hidden=False)
        rows = filescan.read_files(spark, base, listed)
        local = filescan.scheme_of(folder) == "file"
        return rows.select(F.concat(F.lit("file:" if local else ""), "path").alias("path"), F.col("size").alias("length"), "content")
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path", "length", "content")
    empty = listed_paths(files).join(files.select("path"), "path", "left_anti")
    return files.unionByName(empty.select("path", F.lit(0).cast("long").alias("length"), F.lit(b"").alias("content")))


def plain_value(value, above: tuple = ()):
    """A parsed YAML value in JSON's terms: text keys at every level, dates as one-key
    objects, numbers that JSON lacks as text. An anchor that holds itself is an error."""
    import datetime

    if isinstance(value, (dict, list, set, tuple)):
        if any(value is v for v in above):
            raise ValueError("an anchor contains itself")
        inner = (*above, value)
        if isinstance(value, dict):
            return {str(k): plain_value(v, inner) for k, v in value.items()}
        return [plain_value(v, inner) for v in value]
    if isinstance(value, (datetime.date, datetime.datetime)):
        return {"date": value.isoformat()}
    if isinstance(value, float) and (value != value or value in (float("inf"), float("-inf"))):
        return str(value)
    return value if value is None or isinstance(value, (bool, int, float, str)) else str(value)


class Plain:
    """Parsed YAML as ``plain_value`` gives it, without building PyYAML's values first.

    Mappings with text keys, lists and scalars are read off the composed nodes; what a scalar
    stands for is remembered. Anything else (merge keys, other keys or tags, anchors that hold
    themselves, faults) goes the whole way, so values and errors are those of PyYAML.
    """

    # Short scalars remembered, and the longest of them.
    MOST, LONGEST = 100_000, 64

    class Other(Exception):
        """A document that goes the whole way."""

    def __init__(self):
        import yaml

        self.yaml, self.base = yaml, getattr(yaml, "CSafeLoader", yaml.SafeLoader)
        self.scalars, resolved = {}, {}
        most, longest = self.MOST, self.LONGEST

        class Loader(self.base):
            def resolve(self, kind, value, implicit):
                if kind is not yaml.ScalarNode or len(value) > longest:
                    return super().resolve(kind, value, implicit)
                key = (value, implicit)
                tag = resolved.get(key)
                if tag is None:
                    if len(resolved) >= most:
                        resolved.clear()
                    tag = resolved[key] = super().resolve(kind, value, implicit)
                return tag

        self.loader = Loader

    def load(self, text: str):
        loader = self.loader(text)
        try:
            node = loader.get_single_node()
            return None if node is None else self.of(node, loader, ())
        except Exception:  # also faults of the text, for PyYAML's own words
            value = self.yaml.load(text, Loader=self.base)  # noqa: S506 (a safe loader)
            return plain_value(value) if isinstance(value, dict) else value
        finally:
            loader.dispose()

    def of(self, node, loader, above: tuple):
        tag, kind = node.tag, type(node)
        if kind is self.yaml.ScalarNode:
            if tag == "tag:yaml.org,2002:str":
                return node.value
            key = (tag, node.value)
            if key not in self.scalars:
                if len(self.scalars) >= self.MOST:
                    self.scalars.clear()
                value = plain_value(loader.construct_object(node, deep=True))
                if len(node.value) > self.LONGEST:
                    return value
                self.scalars[key] = value
            return self.scalars[key]
        if any(node is a for a in above):
            raise self.Other
        inner = (*above, node)
        if kind is self.yaml.SequenceNode and tag == "tag:yaml.org,2002:seq":
            return [self.of(v, loader, inner) for v in node.value]
        if kind is self.yaml.MappingNode and tag == "tag:yaml.org,2002:map":
            out = {}
            for k, v in node.value:
                if k.tag != "tag:yaml.org,2002:str" or type(k) is not self.yaml.ScalarNode:
                    raise self.Other
                out[k.value] = self.of(v, loader, inner)
            return out
        raise self.Other


def yaml_documents(spark: SparkSession, folder: str, kind: str = "document", pattern: str = "*.yaml") -> DataFrame:
    """One row per file: ``kind, path, file, body VARIANT, error, sha256``.

    Files are split over tasks by Spark. A file that does not parse, whose top level is no
    mapping, or that is too large for a VARIANT becomes a row with ``error`` and a null
    body; an empty file is an empty mapping. Dates written without quotes turn into a
    one-key object, so that they read as missing text later on.
    """
    files = binary_files(spark, folder, pattern).select("path", "content", F.sha2("content", 256).alias("sha256"))

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import json

        import pandas

        plain = Plain()

        def one(content):
            try:
                value = plain.load(bytes(content).decode("utf-8"))
                if value is None:
                    return "{}", None
                if not isinstance(value, dict):
                    return None, "invalid_payload_shape"
                return json.dumps(value, ensure_ascii=False, allow_nan=False), None
            except Exception as exc:
                return None, f"parse_error: {exc}"

        for batch in batches:
            parsed = [one(c) for c in batch["content"]]
            yield pandas.DataFrame(
                {
                    "path": batch["path"],
                    "sha256": batch["sha256"],
                    "json": [p[0] for p in parsed],
                    "error": [p[1] for p in parsed],
                }
            )

    rows = files.mapInPandas(parse, "path string, sha256 string, json string, error string")
    return rows.select(
        F.lit(kind).alias("kind"),
        "path",
        F.element_at(F.split("path", "/"), -1).alias("file"),
        F.try_parse_json("json").alias("body"),
        F.coalesce("error", F.when(F.col("json").isNotNull() & F.try_parse_json("json").isNull(), "parse_error: no variant")).alias("error"),
        "sha256",
    )


def narrative_and_drafts(spark: SparkSession, narrative_dir: str, draft_dir: str) -> DataFrame:
    """Both document directories, tagged by kind."""
    return yaml_documents(spark, narrative_dir, "narrative").unionByName(yaml_documents(spark, draft_dir, "draft"))


def entries(documents: DataFrame, key: str, keep: tuple[str, ...] = ("path",)) -> DataFrame:
    """Entries of one list of every document with their index; entries that are no mapping are flagged."""
    items = F.try_variant_get("body", f"$.{key}", "array<variant>")
    return documents.select(*keep, F.posexplode(items).alias("idx", "entry")).withColumn(
        "is_mapping", F.startswith(F.schema_of_variant("entry"), F.lit("OBJECT"))
    )


def field(col: Column | str, path: str, kind: str = "string") -> Column:
    """A field of a VARIANT; text fields are null unless the value is text."""
    value = F.try_variant_get(col, path, "variant")
    if kind != "string":
        return F.try_variant_get(col, path, kind)
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(col, path, "string"))


def entry_findings(documents: DataFrame, key: str) -> DataFrame:
    """``path, idx, reason``: entries of a list that are no mappings, and documents where the
    key holds no list at all (``idx`` null)."""
    odd = entries(documents, key).filter("NOT is_mapping").select("path", F.col("idx").cast("int").alias("idx"), F.lit("entry_no_mapping").alias("reason"))
    value = F.schema_of_variant(F.try_variant_get("body", f"$.{key}", "variant"))
    other = documents.filter(value.isNotNull() & ~F.startswith(value, F.lit("ARRAY")) & (value != "VOID"))
    return odd.unionByName(other.select("path", F.lit(None).cast("int").alias("idx"), F.lit("no_list").alias("reason")))


def edge_entries(documents: DataFrame, shard: Column | str) -> DataFrame:
    """Edge rows with their source index from documents that hold an ``edges`` list."""
    rows = entries(documents.withColumn("shard", F.col(shard) if isinstance(shard, str) else shard), "edges", ("shard", "path"))
    text = {c: field("entry", f"$.{c}") for c in ("src_id", "dst_id", "dst_kind", "relation", "type", "note", "as_of")}
    return rows.filter("is_mapping").select(
        "path",
        F.coalesce(field("entry", "$.provenance.shard"), "shard").alias("shard"),
        F.coalesce(field("entry", "$.provenance.source_edge_index", "int"), "idx").alias("source_edge_index"),
        *[c.alias(n) for n, c in text.items()],
        field("entry", "$.provenance.source_file").alias("source_file"),
        field("entry", "$.provenance.source_relation").alias("source_relation"),
    )


def relation_mapping(documents: DataFrame) -> DataFrame:
    """``(shard, observed_label, canonical_relation)`` rows of a contract document."""
    rows = entries(documents, "mappings").filter("is_mapping")
    names = ("shard", "observed_label", "canonical_relation")
    return rows.select(*[field("entry", f"$.{n}").alias(n) for n in names]).na.drop()


def contract_enums(documents: DataFrame) -> DataFrame:
    """``(enum, value)`` rows of every ``*_enums`` list of a contract document."""
    top = documents.select("path", F.explode(F.try_variant_get("body", "$", "map<string,variant>")).alias("key", "value"))
    listed = top.filter(F.endswith("key", F.lit("_enums"))).select(
        F.regexp_replace("key", "_enums$", "").alias("enum"),
        F.explode(F.try_variant_get("value", "$", "array<string>")).alias("value"),
    )
    return listed.distinct()


def manifest(documents: DataFrame) -> DataFrame:
    """Manifest rows with their index; header defaults stand beside each row."""
    head = documents.withColumn("default_shard", field("body", "$.defaults.target_shard")).withColumn(
        "default_as_of", field("body", "$.defaults.as_of")
    )
    return entries(head, "repos", ("path", "default_shard", "default_as_of"))


def repo_files(spark: SparkSession, root: str, repo_depth: int = 1, with_content: bool = True, **sizes: int) -> DataFrame:
    """Source-tree listing ``repo, path, size, content``, ignored directories left out.

    ``root`` holds one directory per repository, ``repo_depth`` levels deep; it is taken as
    it is, without patterns. Tasks list the trees, empty and hidden-looking files included,
    and read them in runs of about equal bytes, so that one large repository is split as
    well. Bytes that are no UTF-8 are left out of ``content``. ``sizes`` go to
    ``filescan.plan_scan``.
    """
    listed = filescan.list_files(spark, root, ["*"] * repo_depth, ignored=IGNORED_DIRS)
    _, base = filescan.open_store(root)
    inner = F.split(F.substr("path", F.lit(len(base.rstrip("/")) + 2)), "/")
    repo = F.array_join(F.slice(inner, 1, repo_depth), "/")
    path = F.array_join(F.slice(inner, F.lit(repo_depth + 1), F.size(inner) - repo_depth), "/")
    kept = prune_tree(listed.select(F.col("path").alias("at"), "size", path.alias("path")))
    if not with_content:
        rows = listed.select(repo.alias("repo"), path.alias("path"), "size", F.lit(None).cast("string").alias("content"))
        return prune_tree(rows)
    rows = filescan.read_files(spark, root, kept.select(F.col("at").alias("path"), "size"), **sizes)
    return rows.select(repo.alias("repo"), path.alias("path"), "size", valid_text("content").alias("content"))


def _readable(values: pd.Series) -> pd.Series:
    return values.map(lambda v: None if v is None else bytes(v).decode("utf-8", "ignore"))


def valid_text(content: str) -> Column:
    """Bytes as text; what is no UTF-8 is left out. Only content with such bytes goes to Python."""
    text = F.col(content).cast("string")
    odd = F.when(~F.is_valid_utf8(text), F.col(content))
    return F.coalesce(F.try_validate_utf8(text), F.pandas_udf(_readable, "string")(odd))


def prune_tree(files: DataFrame) -> DataFrame:
    """Drop files below ignored or ``.terraform*`` directories."""
    dirs = F.filter(F.split("path", "/"), lambda p, i: i < F.size(F.split("path", "/")) - 1)
    ignored = F.arrays_overlap(dirs, F.array(*[F.lit(d) for d in IGNORED_DIRS]))
    return files.filter(~ignored & ~F.exists(dirs, lambda d: F.startswith(d, F.lit(".terraform"))))
