"""What the operators share: text batches, written tables, connected components."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

#: Code points that separate words in every contract: space and TAB to CR.
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, else one in the warehouse.

    The warehouse is only used where the setting is missing and the master is local.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
    return folder.rstrip("/")


def small_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Send texts to Python workers a few megabytes at a time in this session.

    Queries and the pipeline call it; the operators work with any batch size.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def new_path(spark: SparkSession, kind: str) -> str:
    """A fresh path, with its scheme, in the shared folder; it goes when the session's JVM ends."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/{kind}-{uuid.uuid4().hex}")
    store = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    store.deleteOnExit(where)
    path = store.makeQualified(where).toString()
    return path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path


def written(df: DataFrame, kind: str = "table") -> DataFrame:
    """Write a result to the shared folder and go on from the written table."""
    spark = df.sparkSession
    path = new_path(spark, kind)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_path = path
    return out


def drop_written(df: DataFrame) -> None:
    """Delete a table made by :func:`written` that no later step reads."""
    spark = df.sparkSession
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df._written_path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def lean(run):
    """A task function that hands freed memory back to the system when it ends.

    Python workers are reused and wait between tasks; what they keep counts against the
    executor while others work.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return task


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; null counts as empty."""
    return ["" if t is None else t for t in batch.column(column).to_pylist()]


class Forest:
    """Union-find over integers; the smallest member is the root."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        r = x
        while (p := up.get(r, r)) != r:
            r = p
        while x != r:
            up[x], x = r, up.get(x, x)
        return r

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        if a > b:
            a, b = b, a
        self.up[b] = a
        self.up.setdefault(a, a)
        return True

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """Each member that is not a root, with its root."""
        pairs = [(x, r) for x in list(self.up) if (r := self.root(x)) != x]
        both = np.array(pairs, dtype=np.int64).reshape(-1, 2)
        return both[:, 0], both[:, 1]


EDGES = "u long, v long"


def edge_batch(u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


def _local_forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of one partition as stars, in pieces of bounded size."""
    forest, n = Forest(), 0
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            forest.join(a, b)
        n += batch.num_rows
        if n >= 500_000:
            yield edge_batch(*forest.edges())
            forest, n = Forest(), 0
    yield edge_batch(*forest.edges())


def components(edges: DataFrame, combine: bool = True, most_rounds: int = 60) -> DataFrame:
    """Connected components of (u, v): one row (node, root) per node that has an edge.

    root is the smallest node reachable. Partitions first shrink their edges to stars (not with
    ``combine`` off, for edges that tasks have combined already, so that a task needs one Python
    worker, not two); then large-star and small-star steps alternate until nothing changes, a
    few rounds even for long chains. Each round is written to the shared folder, so a lost
    executor costs one round. No node's neighbours meet in one task: minima are combined before
    the shuffle and the joins are ones that Spark can split. Self loops and repeated edges are
    fine; null ends are ignored; no edges give no rows.
    """
    spark = edges.sparkSession
    e = edges.select(F.col("u").cast("long").alias("u"), F.col("v").cast("long").alias("v")).where("u <> v")
    e = (e.mapInArrow(lean(_local_forest), EDGES) if combine else e).distinct()
    now, before = written(e, "edges"), None
    for _ in range(most_rounds):
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        following = written(small.union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "edges")
        digest = F.struct(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)")))
        mark = following.agg(digest).first()[0]
        drop_written(now)
        now = following
        if mark == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = mark
    raise RuntimeError("components did not settle")


def with_roots(nodes: DataFrame, found: DataFrame, key: str, name: str) -> DataFrame:
    """Add the root of each node's component; a node without edges is its own."""
    # A column that the caller's table already has by this name is left alone.
    return nodes.join(found.select(F.col("node").alias(key), F.col("root").alias("__root")), key, "left").withColumn(
        name, F.coalesce("__root", key)).drop("__root")


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Groups of rows with equal keys, from batches that are sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [np.asarray(batch.column(k)) for k in keys]
        new = np.zeros(batch.num_rows, dtype=bool)
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        first = tuple(c[0] for c in cols)
        new[0] = last is not None and first != last
        cuts = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if new[a] and held:
                yield pa.Table.from_batches(held)
                held = []
            if b > a:
                held.append(batch.slice(a, b - a))
        last = tuple(c[-1] for c in cols)
    if held:
        yield pa.Table.from_batches(held)
