"""Near duplicates by SuperMinHash, verified on whole sets and grouped by union-find.

The elements of a text are its distinct word shingles. Every element walks one random
permutation of the signature's slots; at step j it offers its slot the value j plus a
random fraction. The ranks of one element are thus correlated over the slots, which
lowers the variance of the signature, and a text stops as soon as no later step could
change a slot. Signatures are cut into bands; texts that share a band are candidates.

Texts with equal sets are one class from the start. In a bucket every class is compared
with one leader, the one that shares most buckets with others, so a group of thousands of
near copies costs one comparison per copy. Where a bucket still holds several components
afterwards, its classes of different components are compared with each other, unless a
bound excludes a link: their sizes; their distances to the leader (Jaccard distance is a
metric); or what they can share at most, which is the smaller of their shares of the
leader's set and the smaller of their other elements that some further class has too. For
these bounds all classes of such a bucket are compared with the leader, whatever their size.
Nothing is left out, so the links found give the components that all links would.

Links are reduced to a forest by a union-find in every task and joined by alternating
star contraction; links never meet on the driver.

Defined cases: texts without words, null ones included, are linked with nothing; shorter
texts than a shingle are one shingle; ties go to the smaller ``doc_id``; rows without
``doc_id`` are linked with nothing and kept; repeated rows share one class; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factgraph.llm.common import frugal, key_type, map_slices, record, slices, staged
from factgraph.session import broadcast_if_small

SHINGLE = 5
BANDS, ROWS = 30, 5
# Similarity as a whole percentage.
LEAST_PERCENT = 80
# Elements whose permutations are in memory at once.
ELEMENTS = 1 << 16


def shingles(text: str | None, size: int = SHINGLE):
    """Sorted distinct hashes of the word shingles of a whole text, A-Z folded."""
    import numpy as np
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    own = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    k = min(size, n)
    h = np.full(n - k + 1, k, np.uint64)
    for i in range(k):
        h = (h ^ own[i : n - k + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        h = h ^ (h >> np.uint64(29))
    return np.unique(h)


def super_min_hash(elements, owner, n_texts: int, slots: int = BANDS * ROWS):
    """Signatures of ``n_texts`` sets; ``owner`` says whose each element is."""
    import numpy as np

    found = np.full(n_texts * slots, np.iinfo(np.int64).max)
    by_text = found.reshape(n_texts, slots)
    for at in range(0, len(elements), ELEMENTS):
        e, o = elements[at : at + ELEMENTS], owner[at : at + ELEMENTS]
        walk = np.tile(np.arange(slots, dtype=np.uint8), (len(e), 1))
        for j in range(slots):
            # A text is ready when all its slots hold values below step j.
            texts = np.unique(o)
            ready = texts[by_text[texts].max(1) < (j << 40)]
            if len(ready):
                live = np.flatnonzero(~np.isin(o, ready))
                if not len(live):
                    break
                if len(live) < len(e):
                    e, o, walk = e[live], o[live], walk[live]
            x = (e ^ np.uint64(j + 1)) * np.uint64(0xD6E8FEB86659FD93)
            x = (x ^ (x >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
            x = x ^ (x >> np.uint64(29))
            rank = (x >> np.uint64(24)).astype(np.int64) | (j << 40)
            k = j + (((x & np.uint64(0xFFFFFF)) * np.uint64(slots - j)) >> np.uint64(24)).astype(np.int64)
            rows = np.arange(len(e))
            slot = walk[rows, k].astype(np.int64)
            walk[rows, k] = walk[:, j]
            np.minimum.at(found, o * slots + slot, rank)
    return by_text


def band_keys(signatures, bands: int = BANDS, rows: int = ROWS):
    import numpy as np

    keys = np.empty((len(signatures), bands), np.uint64)
    for b in range(bands):
        h = np.full(len(signatures), b + 1, np.uint64)
        for i in range(rows):
            h = (h ^ signatures[:, b * rows + i].view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            h = h ^ (h >> np.uint64(31))
        keys[:, b] = h
    return keys.view(np.int64)


def signed(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``doc_id, n_shingles, set_key, bands``; the last two are null without words."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        import numpy as np
        import xxhash

        sets = [shingles(t, size) for t in batch.column("text").to_pylist()]
        sizes = np.array([len(s) for s in sets])
        owner = np.repeat(np.arange(len(sets)), sizes)
        keys = band_keys(np.ascontiguousarray(super_min_hash(np.concatenate(sets), owner, len(sets))))
        bands = [k if n else None for k, n in zip(keys, sizes, strict=True)]
        return record(
            doc_id=batch.column("doc_id"),
            n_shingles=pa.array(sizes, pa.int64()),
            set_key=pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
            bands=pa.array(bands, pa.list_(pa.int64())),
        )

    return map_slices(docs.select("doc_id", "text"), work, f"doc_id {key_type(docs)}, n_shingles long, set_key binary, bands array<long>")


def verified(pairs: DataFrame, docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``a, b, same, both, own``: sizes of the intersection and the union of the whole sets,
    and the elements of ``a`` that ``b`` lacks.

    Texts of the documents in ``pairs`` travel, not sets; one exchange of them serves both
    sides. Rows of one leader ``b`` come one after the other where they meet in a task, so
    its set is made once.
    """
    kind = key_type(docs)
    ids = staged(pairs.select(F.explode(F.array("a", "b")).alias("__id")).distinct())
    texts = docs.select("doc_id", "text")
    texts = texts.join(broadcast_if_small(ids), texts["doc_id"] == ids["__id"], "left_semi")
    one = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text")), "a")
    two = one.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        last, held = None, None
        for whole in batches:
            for batch in slices(whole):
                same, both, rest = [], [], []
                for b, text, text_b in zip(*(batch.column(c).to_pylist() for c in ("b", "text", "text_b")), strict=True):
                    if last is None or last != (b, text_b):
                        last, held = (b, text_b), shingles(text_b, size)
                    own = shingles(text, size)
                    lacks = np.setdiff1d(own, held, assume_unique=True)
                    same.append(len(own) - len(lacks)), both.append(len(held) + len(lacks)), rest.append(lacks.view(np.int64))
                yield record(
                    a=batch.column("a"), b=batch.column("b"), same=pa.array(same, pa.int64()), both=pa.array(both, pa.int64()),
                    own=pa.array(rest, pa.list_(pa.int64())),
                )

    return two.select("a", "b", "text", "text_b").mapInArrow(frugal(run), f"a {kind}, b {kind}, same long, both long, own array<long>")


def forest(links: DataFrame) -> DataFrame:
    """A union-find over the links of every task: its nodes with their smallest."""
    kinds = links.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up: dict = {}

        def top(x):
            while (y := up.setdefault(x, x)) != x:
                up[x] = up[y] if y in up else y
                x = y
            return x

        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
                a, b = top(a), top(b)
                if a != b:
                    up[max(a, b)] = min(a, b)
        rows = [(x, top(x)) for x in list(up)]
        rows = [r for r in rows if r[0] != r[1]]
        kind = None
        if rows:
            from pyspark.sql.pandas.types import to_arrow_type

            kind = to_arrow_type(kinds["a"].dataType)
            yield record(a=pa.array([r[0] for r in rows], kind), b=pa.array([r[1] for r in rows], kind))

    kind = links.schema["a"].dataType.simpleString()
    return links.select("a", "b").mapInArrow(frugal(run), f"a {kind}, b {kind}")


def _sum(edges: DataFrame):
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node with a link; the component is its smallest node.

    Large-star and small-star steps alternate until nothing changes. Edges lead from the
    larger node ``a`` to the smaller ``b``; every round is written to the shared folder.
    """
    edges = staged(forest(links).distinct())
    before = None
    while (now := _sum(edges)) != before:
        before = now
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = staged(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct())
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def near_duplicates(docs: DataFrame, percent: int = LEAST_PERCENT, size: int = SHINGLE) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row of ``docs``.

    Two texts are linked when 100 times the size of the intersection of their shingle
    sets is at least ``percent`` times that of the union.
    """
    rows = staged(signed(docs, size))
    full = rows.filter(F.col("set_key").isNotNull() & F.col("doc_id").isNotNull())
    # Equal sets have equal bands: any will do.
    classes = staged(
        full.groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
    )
    each = classes.select("rep", "n", F.posexplode("bands").alias("band", "key"))
    shared = each.groupBy("band", "key").agg(F.count(F.lit(1)).alias("held")).filter("held > 1")
    # Sides made by a grouping are dealt anew, so that AQE can split a hot bucket in the join.
    members = staged(each.join(shared.hint("rebalance"), ["band", "key"]))
    weight = members.groupBy("rep").agg(F.sum("held").alias("weight"))
    leaders = (
        members.join(weight, "rep").groupBy("band", "key")
        .agg(F.max_by(F.struct("rep", "n"), F.struct("weight", (-F.col("rep")).alias("r"))).alias("top"))
        .select("band", "key", F.col("top.rep").alias("leader"), F.col("top.n").alias("leader_n"))
    )
    led = staged(members.drop("held").join(leaders.hint("rebalance"), ["band", "key"]))

    def sizes_fit(a: str, b: str):
        return 100 * F.least(a, b) >= percent * F.greatest(a, b)

    first = led.filter((F.col("rep") != F.col("leader")) & sizes_fit("n", "leader_n"))
    first = staged(first.select(F.col("rep").alias("a"), F.col("leader").alias("b")).distinct())
    found = staged(verified(first, docs, size))
    link = 100 * F.col("same") >= percent * F.col("both")
    links = found.filter(link).select("a", "b")
    grouped = staged(components(links))

    # Buckets that still hold several components.
    joined = led.join(grouped, led["rep"] == grouped["node"], "left").select(
        "band", "key", "rep", "n", "leader", F.coalesce("component", "rep").alias("component")
    )
    open_ = joined.groupBy("band", "key").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x < y").select("band", "key")
    rest = staged(joined.join(open_.hint("rebalance"), ["band", "key"], "left_semi"))
    # What a class has beside its leader's elements, less what it shares with no other
    # class of that leader, is all that two of them can share beside the leader's. That
    # holds when all of them are compared with the leader, those of other sizes too.
    to_leader = staged(rest.filter("rep != leader").select(F.col("rep").alias("a"), F.col("leader").alias("b")).distinct())
    unfit = staged(to_leader.join(found.select("a", "b"), ["a", "b"], "left_anti"))
    near = found.join(to_leader, ["a", "b"]).unionByName(staged(verified(unfit, docs, size)))
    alone = near.select("a", "b", F.explode("own").alias("element")).groupBy("b", "element").agg(F.min("a").alias("a"), F.count(F.lit(1)).alias("n"))
    alone = alone.filter("n = 1").groupBy("a", "b").agg(F.count(F.lit(1)).alias("alone"))
    known = staged(
        near.join(alone, ["a", "b"], "left").select(
            F.col("a").alias("rep"), F.col("b").alias("leader"), "same",
            (F.size("own") - F.coalesce("alone", F.lit(0))).alias("spare"), (1 - F.col("same") / F.col("both")).alias("far"),
        )
    )
    rest = rest.join(known, ["rep", "leader"], "left")
    columns = ("rep", "n", "component", "far", "same", "spare", "leader")
    left, right = (rest.select("band", "key", *[F.col(c).alias(f"{c}_{s}") for c in columns]) for s in "ab")
    # F.least passes over nulls; a bound needs both sides.
    both_known = F.col("same_a").isNotNull() & F.col("same_b").isNotNull()
    most = F.when(both_known, F.least("same_a", "same_b") + F.least("spare_a", "spare_b"))
    pairs = left.join(right, ["band", "key"]).filter(
        (F.col("rep_a") < F.col("rep_b"))
        & (F.col("component_a") != F.col("component_b"))
        & sizes_fit("n_a", "n_b")
        & (F.col("rep_a") != F.col("leader_a"))
        & (F.col("rep_b") != F.col("leader_a"))
        & F.coalesce(F.abs(F.col("far_a") - F.col("far_b")) <= 1 - percent / 100 + 1e-9, F.lit(True))
        & F.coalesce(100 * most >= percent * (F.col("n_a") + F.col("n_b") - most), F.lit(True))
    )
    pairs = pairs.select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")).distinct()
    more = staged(verified(staged(pairs), docs, size)).filter(link).select("a", "b")
    if more.limit(1).count():
        tree = grouped.filter("node != component").select(F.col("node").alias("a"), F.col("component").alias("b"))
        grouped = staged(components(tree.unionByName(more)))

    named = staged(
        classes.select("set_key", "rep").join(grouped, F.col("rep") == F.col("node"), "left")
        .select("set_key", F.coalesce("component", "rep").alias("component"))
    )
    out = rows.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("set_key")).alias("set_key")).join(named, "set_key", "left")
    out = out.withColumn("component_id", F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def one_of_each(docs: DataFrame, percent: int = LEAST_PERCENT, size: int = SHINGLE) -> DataFrame:
    """Rows of ``docs``, all columns as they are, without those that a component's smallest
    document stands for."""
    gone = near_duplicates(docs, percent, size).filter("not kept").select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["__id"], "left_anti")
