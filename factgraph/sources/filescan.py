"""Files of folders as a Spark data source, listed and planned by tasks.

Tasks walk the folders and hand what is left of a large walk to the next round, so a tree of
any width is listed by many. The listing is ranged by path, running sums of bytes are taken
within the ranges, and every partition of the scan is one run of paths with about
``TARGET_BYTES``. The plan lies in the shared folder by partition number: the driver passes
that number only, never a path. Spark's own readers pass over empty files; this scan
does not, and bytes of any kind come as they are.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator, Sequence
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from factgraph.session import shared_dir, staged

FORMAT = "factgraph_files"
# Bytes of one partition, what opening a file counts for, and the most partitions of a scan,
# beyond which partitions grow.
TARGET_BYTES, OPEN_BYTES, MOST_PARTS = 64 << 20, 32 << 10, 50_000
# A scan of fewer bytes is still dealt over the cores, in parts of so many files at least.
LEAST_FILES = 64
# Entries that a task lists before it hands the rest on; the first round only fans out.
FIRST_ENTRIES, ENTRIES = 1000, 100_000
# Entries of a local folder that a task holds at once.
LISTED = 10_000
# Bytes and files of one Arrow batch.
BATCH_BYTES, BATCH_FILES = 4 << 20, 2000
# Stores that tasks open themselves.
SCHEMES = ("file", "hdfs", "s3", "s3a", "gs", "gcs")


def scheme_of(address: str) -> str:
    found = re.match("([a-zA-Z][a-zA-Z0-9+.-]*):/", address)
    return found[1].lower() if found else "file"


def open_store(address: str):
    """File system and inner path of an address or a local path (as Spark writes it, unquoted)."""
    from pyarrow import fs

    if scheme_of(address) != "file":
        return fs.FileSystem.from_uri(re.sub("^s3a:", "s3:", address))
    return fs.LocalFileSystem(), re.sub("^file:/+", "/", address).rstrip("/") or "/"


def split_pattern(folder: str) -> tuple[str, list[str]]:
    """The folder above the first part with a wildcard, and the parts from there."""
    parts = folder.rstrip("/").split("/")
    first = next((i for i, p in enumerate(parts) if re.search(r"[*?\[{]", p)), len(parts))
    return "/".join(parts[:first]) or "/", parts[first:]


def name_test(pattern: str):
    """A test of names for a pattern with ``* ? [...]`` and ``{a,b}``."""
    import fnmatch

    def spread(text: str) -> list[str]:
        found = re.search(r"\{([^{}]*)\}", text)
        if not found:
            return [text]
        return [x for choice in found[1].split(",") for x in spread(text[: found.start()] + choice + text[found.end() :])]

    tests = [re.compile(fnmatch.translate(x)).fullmatch for x in spread(pattern)]
    return lambda name: any(t(name) for t in tests)


def entries(store, at: str) -> Iterator[list[tuple[str, str, bool, bool, int | None]]]:
    """Path, name, whether folder, whether file, and size of what a folder holds, so many at a time.

    A local folder is read as it is gone through, so a flat one of any width takes no memory.
    """
    from pyarrow import fs

    if not isinstance(store, fs.LocalFileSystem):
        here = store.get_file_info(fs.FileSelector(at, allow_not_found=True))
        yield [(f.path, f.base_name, f.type == fs.FileType.Directory, f.type == fs.FileType.File, f.size) for f in here]
        return
    try:
        found = os.scandir(at)
    except FileNotFoundError:
        return
    with found:
        while some := list(islice(found, LISTED)):
            rows = []
            for e in some:
                file = e.is_file()
                rows.append((f"{at.rstrip('/')}/{e.name}", e.name, not file and e.is_dir(), file, e.stat().st_size if file else None))
            yield rows


def list_files(
    spark: SparkSession, base: str, below: Sequence[str] = (), names: str = "*", deep: bool = True,
    ignored: Sequence[str] = (), hidden: bool = True,
) -> DataFrame:
    """``path, size`` of the files under ``base``; paths are those of the store.

    ``below`` are patterns of the folders to go down first, one per level. From there the
    walk goes ``deep`` or stays. Folders in ``ignored`` are left out below that level, and
    with ``hidden`` off all names that begin with ``_`` or ``.``.
    """
    _, top = open_store(base)
    waiting = spark.createDataFrame([(top, 0)], "path string, level int")
    found: list[DataFrame] = []
    below, ignored = list(below), set(ignored)

    def walk(limit: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            store, _ = open_store(base)
            tests, keep = [name_test(p) for p in below], name_test(names)
            shown = (lambda n: True) if hidden else (lambda n: n[:1] not in ("_", "."))
            todo = [(r["path"], r["level"]) for batch in batches for r in batch.to_pylist()]
            seen = 0
            while todo and seen < limit:
                at, level = todo.pop()
                seen += 1
                for here in entries(store, at):
                    here = [f for f in here if shown(f[1])]
                    seen += len(here)
                    folders = [(path, name) for path, name, folder, _, _ in here if folder]
                    if level < len(tests):
                        todo += [(path, level + 1) for path, name in folders if tests[level](name)]
                        continue
                    if deep:
                        todo += [(path, level) for path, name in folders if name not in ignored]
                    files = [(path, size) for path, name, _, file, size in here if file and keep(name)]
                    if files:
                        yield pa.RecordBatch.from_pydict(
                            {"path": [f[0] for f in files], "size": pa.array([f[1] for f in files], pa.int64()), "level": pa.nulls(len(files), pa.int32())}
                        )
            if todo:
                yield pa.RecordBatch.from_pydict(
                    {"path": [p for p, _ in todo], "size": pa.nulls(len(todo), pa.int64()), "level": pa.array([x for _, x in todo], pa.int32())}
                )

        return run

    while True:
        step = staged(waiting.mapInArrow(walk(ENTRIES if found else FIRST_ENTRIES), "path string, size long, level int"))
        found.append(step.filter("level IS NULL").select("path", "size"))
        # The number of tasks follows the number of folders left.
        left = step.filter("level IS NOT NULL").select("path", "level")
        n = left.count()
        if n == 0:
            break
        waiting = left.repartition(min(n, max(spark.sparkContext.defaultParallelism * 4, n // 1000)), "path")
    whole = found[0]
    for part in found[1:]:
        whole = whole.unionByName(part)
    return whole


def plan_scan(files: DataFrame, target: int = TARGET_BYTES, opening: int = OPEN_BYTES, most: int = MOST_PARTS) -> tuple[str, int]:
    """Write the plan of a scan of ``files(path, size)``; its folder and number of partitions."""
    spark = files.sparkSession

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        from pyspark import TaskContext

        shard, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            weight = batch.column("size").to_numpy() + opening
            ends = before + np.cumsum(weight)
            yield pa.RecordBatch.from_pydict(
                {"path": batch.column("path"), "size": batch.column("size"), "shard": pa.array([shard] * batch.num_rows, pa.int32()), "before": ends - weight}
            )
            before = int(ends[-1]) if len(ends) else before

    ranged = files.select("path", "size").repartitionByRange("path").sortWithinPartitions("path")
    summed = staged(ranged.mapInArrow(sums, "path string, size long, shard int, before long"))
    # One row per range, of which there are as many as shuffle partitions.
    totals = summed.groupBy("shard").agg(F.max(F.col("before") + F.col("size") + opening).alias("total"), F.lit(1).alias("one"))
    ahead = Window.partitionBy("one").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = staged(totals.select("shard", "total", F.coalesce(F.sum("total").over(ahead), F.lit(0)).alias("start")))
    whole = starts.agg(F.coalesce(F.sum("total"), F.lit(0)).alias("n")).head()["n"]
    cores = spark.sparkContext.defaultParallelism
    width = max(min(target, max(-(-whole // (4 * cores)), LEAST_FILES * opening)), -(-whole // most), 1)
    place = F.floor((F.col("start") + F.col("before")) / width).cast("long")
    folder = f"{shared_dir(spark).rstrip('/')}/factgraph-scans/{uuid.uuid4().hex}"
    planned = summed.join(F.broadcast(starts.select("shard", "start")), "shard").select("path", "size", place.alias("part"))
    planned.repartition("part").sortWithinPartitions("part", "path").write.partitionBy("part").parquet(folder)
    return folder, int(-(-whole // width))


class Range(InputPartition):
    """One run of paths of the plan."""

    def __init__(self, number: int):
        self.number = number


class PlannedReader(DataSourceReader):
    def __init__(self, options: dict):
        self.base, self.plan, self.parts = options["base"], options["plan"], int(options["parts"])

    def partitions(self) -> list[InputPartition]:
        return [Range(i) for i in range(max(1, self.parts))]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq
        from pyarrow import fs

        plans, folder = open_store(self.plan)
        store, _ = open_store(self.base)
        listing = plans.get_file_info(fs.FileSelector(f"{folder}/part={partition.number}", allow_not_found=True))
        rows: dict[str, list] = {"path": [], "size": [], "content": []}

        def batch() -> pa.RecordBatch:
            out = pa.RecordBatch.from_pydict(
                {"path": pa.array(rows["path"], pa.string()), "size": pa.array(rows["size"], pa.int64()), "content": pa.array(rows["content"], pa.binary())}
            )
            for values in rows.values():
                values.clear()
            return out

        held = 0
        for part in sorted(f.path for f in listing if f.path.endswith(".parquet")):
            with plans.open_input_file(part) as source:
                for some in pq.ParquetFile(source).iter_batches(BATCH_FILES, columns=["path"]):
                    for path in some.column(0).to_pylist():
                        with store.open_input_stream(path) as stream:
                            content = stream.read()
                        rows["path"].append(path), rows["size"].append(len(content)), rows["content"].append(content)
                        held += len(content)
                        if held >= BATCH_BYTES or len(rows["path"]) >= BATCH_FILES:
                            yield batch()
                            held = 0
        if rows["path"]:
            yield batch()


class PlannedFiles(DataSource):
    """``path, size, content`` of the files of a plan that ``plan_scan`` wrote."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "path string, size long, content binary"

    def reader(self, schema) -> DataSourceReader:
        return PlannedReader(dict(self.options))


def read_files(spark: SparkSession, base: str, files: DataFrame, **sizes: int) -> DataFrame:
    """``path, size, content`` of the listed files of a store, split by bytes."""
    folder, parts = plan_scan(files, **sizes)
    spark.dataSource.register(PlannedFiles)
    return spark.read.format(FORMAT).option("base", base).option("plan", folder).option("parts", str(parts)).load()


def write_files(files: DataFrame, folder: str) -> DataFrame:
    """Write ``files(path, content)`` below ``folder``; ``path, size`` of what was written.

    Tasks write a file in a folder of their own and then put it in place, so a task that
    runs again replaces its files by equal ones, and tasks meet in a folder only to do that.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = open_store(folder)
        made, own = set(), ""
        for batch in batches:
            sizes = []
            if not own:
                own = f"{top}/.{uuid.uuid4().hex}"
                store.create_dir(own)
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                at = f"{top}/{path}"
                above = at.rpartition("/")[0]
                if above not in made:
                    store.create_dir(above)
                    made.add(above)
                with store.open_output_stream(f"{own}/file") as out:
                    out.write(content or b"")
                store.move(f"{own}/file", at)
                sizes.append(len(content or b""))
            yield pa.RecordBatch.from_pydict({"path": batch.column("path"), "size": pa.array(sizes, pa.int64())})
        if own:
            store.delete_dir(own)

    return staged(files.select("path", "content").mapInArrow(run, "path string, size long"))
