"""Benchmark passages in documents: a prefix-filtered set join, then exact containment.

Items are cut into windows of ten words (a shorter item is one window). A window is the
ordered set of its three-word shingles, and a text that contains the window contains all
of them, so one shingle is a sufficient prefix: the one that is rarest in the documents.
Places of documents that hold any benchmark shingle are staged with the words around
them, shingles are counted there, and each window is joined on its rarest shingle only.
The place of the shingle in the window bounds where the window could start and end in
the document; what remains is compared word by word.

All steps are DataFrame operations. Sets of the benchmark are broadcast when a count
shows them to be small; larger ones are joined by shuffle. No row of a place carries the
words of its whole text, in an exchange or before it.

Defined cases: a null or empty text has no words and is clean; documents that repeat with
the same id and text give one row each; rows without ``doc_id`` are judged alike; an item
without words has no window; an item without ``item_id`` marks words but is not counted
or named; rows that repeat an ``item_id`` are one item. Empty tables give an empty
result, or no hit. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factgraph.llm.common import staged
from factgraph.session import broadcast_if_small

WINDOW = 10
SHINGLE = 3
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Places that share one copy of the words around them.
BLOCK = 64
# Distinct shingles of one size that are broadcast, a hash each.
BROADCAST_KEYS = 1_000_000


def words(text: Column | str) -> Column:
    """Words in their own case; A-Z count as letters."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def folded(found: Column) -> Column:
    return F.transform(found, lambda w: F.translate(w, UPPER, LOWER))


def shingle(of: Column, at: Column, size: int) -> Column:
    """Key of ``size`` words from place ``at``. It folds more case than the rule does, so
    equal words have equal keys; the comparison that follows is exact."""
    return F.xxhash64(F.lit(size), *[F.lower(F.get(of, at + i)) for i in range(size)])


def windows(benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """``wid, words, size, item_id``: the distinct windows of every item."""
    own = benchmark.select("item_id", folded(words("text")).alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - width, F.lit(0)))
    cut = own.select("item_id", "w", F.explode(starts).alias("at")).select(
        "item_id", F.slice("w", F.col("at") + 1, F.least(F.size("w"), F.lit(width))).alias("words")
    )
    return cut.distinct().select(F.xxhash64(F.size("words"), "words").alias("wid"), "words", F.size("words").alias("size"), "item_id")


def window_shingles(found: DataFrame, longest: int = SHINGLE) -> DataFrame:
    """``wid, words, size, k, at, key``: the shingles of every distinct window and their places."""
    distinct = found.select("wid", "words", "size").distinct().withColumn("k", F.least("size", F.lit(longest)))
    places = distinct.withColumn("at", F.explode(F.sequence(F.lit(0), F.col("size") - F.col("k"))))
    key = F.lit(None).cast("long")
    for k in range(1, longest + 1):
        key = F.when(F.col("k") == k, shingle(F.col("words"), F.col("at"), k)).otherwise(key)
    return places.withColumn("key", key)


def blocks(own: DataFrame, width: int) -> DataFrame:
    """``doc_id, text_hash, n_words, s, part``: runs of ``BLOCK`` places and the words around them.

    What is made of a place carries the words of its block, not those of the whole text,
    so memory follows the length of a text and not its square.
    """
    n = F.size("w")
    cut = F.transform(
        F.sequence(F.lit(0), n, F.lit(BLOCK)),
        lambda s: F.struct(
            n.cast("long").alias("n_words"), s.alias("s"),
            F.slice("w", F.greatest(s - (width - 1), F.lit(0)) + 1, F.lit(BLOCK + 2 * width)).alias("part"),
        ),
    )
    # Never empty; the outer form keeps Spark from cutting texts once more to test that.
    return own.select("doc_id", "text_hash", F.explode_outer(cut).alias("b")).select("doc_id", "text_hash", "b.*")


def places(docs: DataFrame, keys: DataFrame, k: int, width: int) -> DataFrame:
    """One row per place whose ``k`` words are a key, with the words around it, and one
    closing row per document (``key`` null) with its number of words."""
    own = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words("text").alias("w"))
    run = blocks(own, width)
    last = F.least(F.col("s") + (BLOCK - 1), F.col("n_words").cast("int"))
    each = run.select("doc_id", "text_hash", "n_words", "s", "part", F.explode(F.sequence("s", last)).alias("p"))
    ahead = F.greatest(F.col("s") - (width - 1), F.lit(0))
    each = each.withColumn("probe", F.when(F.col("p") + k <= F.col("n_words"), shingle(F.col("part"), F.col("p") - ahead, k)))
    first = F.greatest(F.col("p") - (width - 1), F.lit(0))
    known = keys.filter(F.col("k") == k).select("key").distinct()
    shown = ["doc_id", "text_hash", "n_words", "key", F.lit(k).alias("k"), "p", "around", first.alias("first")]
    if known.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS:
        hit = each.join(F.broadcast(known), F.col("probe") == F.col("key"), "left")
        hit = hit.filter(F.col("key").isNotNull() | (F.col("p") == F.col("n_words")))
        around = folded(F.slice("part", first - ahead + 1, F.lit(2 * width)))
        return hit.withColumn("around", F.when(F.col("key").isNotNull(), around)).select(*shown)
    # Too many keys to broadcast: places move without words, which are read again for the hits.
    found = each.select("doc_id", "text_hash", "p", "probe").join(known, F.col("probe") == F.col("key"))
    # The hits of one text: as many as it has words.
    per_text = found.groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).agg(F.collect_set(F.struct("p", "key")).alias("hits"))
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    again = texts.join(per_text, texts["doc_id"].eqNullSafe(per_text["_id"]) & (texts["text_hash"] == per_text["_hash"]))
    again = again.select("doc_id", "text_hash", "hits", words("text").alias("w"))

    def with_words(h: Column) -> Column:
        start = F.greatest(h["p"] - (width - 1), F.lit(0)) + 1
        near = folded(F.slice("w", start, F.lit(2 * width)))
        return F.struct(F.size("w").cast("long").alias("n_words"), h["p"].alias("p"), h["key"].alias("key"), near.alias("around"))

    hit = again.select("doc_id", "text_hash", F.explode_outer(F.transform("hits", with_words)).alias("h"))
    none = F.lit(None)
    closing = own.select(
        "doc_id", "text_hash", F.size("w").cast("long").alias("n_words"), F.size("w").alias("p"),
        none.cast("long").alias("key"), none.cast("array<string>").alias("around"),
    )
    return hit.select("doc_id", "text_hash", "h.*").unionByName(closing).select(*shown)


def occurrences(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """``(closing rows per document, exact occurrences)``.

    Occurrences hold ``doc_id, text_hash, start, size, wid``.
    """
    found = staged(windows(benchmark, width))
    keyed = staged(window_shingles(found))
    sizes = sorted(r.k for r in keyed.select("k").distinct().collect()) or [SHINGLE]  # at most three
    near = None
    for k in sizes:
        one = places(docs, keyed, k, width)
        near = one if near is None else near.unionByName(one.filter(F.col("key").isNotNull()))
    near = staged(near)
    counts = near.filter(F.col("key").isNotNull()).groupBy("k", "key").agg(F.count(F.lit(1)).alias("n"))
    rarest = (
        keyed.join(counts, ["k", "key"], "left")
        .groupBy("wid", "words", "size")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "at", "k", "key")).alias("prefix"))
        .filter(F.col("prefix.n") > 0)  # a window with a shingle in no document occurs in none
        .select("wid", "words", "size", "prefix.at", "prefix.k", "prefix.key")
    )
    joined = near.filter(F.col("key").isNotNull()).join(broadcast_if_small(staged(rarest)), ["k", "key"])
    start = F.col("p") - F.col("at")
    bounded = joined.filter((start >= 0) & (start + F.col("size") <= F.col("n_words")))
    exact = bounded.filter(F.slice("around", start - F.col("first") + 1, F.col("size")) == F.col("words"))
    hits = exact.select("doc_id", "text_hash", start.alias("start"), "size", "wid")
    items = broadcast_if_small(found.select("wid", "item_id"))
    return near.filter(F.col("key").isNull()).select("doc_id", "text_hash", "n_words"), hits.join(items, "wid")


def covered(spans: Column) -> Column:
    """Words under the union of spans sorted by start."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def step(acc, s):
        end = s["start"] + s["size"]
        return F.struct(
            F.greatest(acc["end"], end).alias("end"),
            (acc["n"] + F.greatest(end - F.greatest(acc["end"], s["start"]), F.lit(0))).alias("n"),
        )

    return F.aggregate(spans, zero, step, lambda acc: acc["n"])


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """``doc_id, text_hash, n_words, n_hit, n_items, items_sha256, contaminated`` per document."""
    whole, hits = occurrences(docs, benchmark, width)
    none = F.lit(None)
    rows = whole.select(
        "doc_id", "text_hash", "n_words", F.lit(1).alias("copy"), none.cast("struct<start:int,size:int>").alias("span"), none.cast("string").alias("item")
    ).unionByName(
        hits.select(
            "doc_id", "text_hash", none.cast("long").alias("n_words"), F.lit(0).alias("copy"),
            F.struct("start", "size").alias("span"), F.col("item_id").cast("string").alias("item"),
        )
    )
    # Sets of one document: as many spans as it has words, as many items as occur in it.
    judged = rows.groupBy("doc_id", "text_hash").agg(
        F.max("n_words").alias("n_words"),
        F.sum("copy").alias("copies"),
        covered(F.array_sort(F.collect_set("span"))).alias("n_hit"),
        F.array_sort(F.collect_set("item")).alias("items"),
    )
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return judged.withColumn("_copy", copies).select(
        "doc_id", "text_hash", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """Rows of ``docs``, all columns as they are, that hold no benchmark window."""
    _, hits = occurrences(docs, benchmark, width)
    bad = hits.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["__id"]) & (F.xxhash64(docs["text"]) == bad["__hash"]), "left_anti")
