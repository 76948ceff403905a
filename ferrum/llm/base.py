"""Reading, scratch output and small grouping helpers that the operators share."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrum.session import scratch_path, table
from ferrum.sinks.writers import remove_folders

__all__ = ["connected_components", "counters", "discard", "documents", "possible", "rarity", "release", "stored", "table", "trim", "unused"]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared scratch folder and read it back: cuts lineage, outlives executors."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    release(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a ``stored`` frame that nothing reads any more."""
    files = df.inputFiles()
    folder = files[0].rsplit("/", 1)[0] if files else ""
    if "/ferrum/llm-" in folder:
        remove_folders(df.sparkSession, [folder])


def release(spark: SparkSession) -> None:
    """Drop what finished plans have left. Spark deletes shuffle files and broadcasts once the driver has collected the
    plans they belong to, which a driver with a large heap does late; a long query does it between its steps."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()  # noqa: SLF001 - the JVM's own collection, no Python getter
    trim(spark)


def trim(spark: SparkSession, command: str = "systemTrimNativeHeap") -> str:
    """Have the driver's JVM give native memory that it has freed back to the system; its answer.

    Planning and compiling many queries leaves hundreds of threads' malloc arenas behind, which glibc keeps. The JDK's management
    command for it is in 17.0.9 and later; a JVM or a system without it leaves things as they are, and the answer is "".
    """
    jvm, array = spark.sparkContext._jvm, spark.sparkContext._gateway.new_array  # noqa: SLF001 - as above
    kinds = ("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")
    try:
        types, args = array(jvm.java.lang.Class, len(kinds)), array(jvm.java.lang.Object, len(kinds))
        for i, kind in enumerate(kinds):
            types[i] = jvm.java.lang.Class.forName(kind)
        args[0], args[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), command
        call = jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethod("invoke", types)
        return str(call.invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), args))
    except Py4JError:
        return ""


def unused(df: DataFrame, name: str) -> str:
    """A column name based on ``name`` that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


#: Edges that one task joins by union-find, so a task's memory is bounded.
EDGES_A_TASK = 20_000


def _forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Union-find over the edges of one partition, sent on as edges to each set's smallest node."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while parent.setdefault(root, root) != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for part in batches:
        for u, v in zip(part["u"].to_numpy().tolist(), part["v"].to_numpy().tolist(), strict=True):
            a, b = find(u), find(v)
            if a != b:
                parent[max(a, b)] = min(a, b)
    got = [(x, find(x)) for x in parent]
    yield pd.DataFrame({"u": np.array([x for x, _ in got], dtype=np.int64),
                        "v": np.array([r for _, r in got], dtype=np.int64)}).query("u != v")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) of every node that has an edge (u, v of longs); component = smallest node.

    Edges are first dealt to tasks, ``EDGES_A_TASK`` each, and joined there by union-find; one task has then
    found the components. Of several, stars are grown and flattened (large star, small star) until no
    edge changes. Every step is an aggregate and an equi-join on a node, so a node with very many edges is combined
    before the shuffle and its join can be split; no component is gathered anywhere. Each round is written
    to the shared folder.
    """
    edges = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = stored(edges, "edges")
    tasks = max(1, -(-edges.count() // EDGES_A_TASK))
    dealt = edges.repartition(tasks).mapInPandas(_forest, "u long, v long")
    before = (0, None)
    if tasks == 1:
        edges = stored(dealt, "edges")
    else:
        edges = stored(dealt.distinct(), "edges")
        before = _state(edges)
    for _ in range(most_rounds):
        if before[0] == 0:
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                              F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
        edges = stored(small.where("u <> v").distinct(), "edges")
        after = _state(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components still changed after {most_rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


#: Counters of ``rarity`` and cells of ``possible``; arrays of 1 MB, whatever the corpus.
RARITY_BITS = 18


def rarity(items: DataFrame, column: str) -> np.ndarray:
    """How often the values of a long column occur, counted over all rows in 2**RARITY_BITS counters.

    Values that share a counter share its count, so a count is never too small: a count of 1 means that
    the value occurs once. Ordering by (count, value) is the same total order everywhere.
    """
    size = 1 << RARITY_BITS
    counts = items.groupBy(F.pmod(F.col(column), F.lit(size)).cast("int").alias("i")).agg(F.count("*").alias("n"))
    return np.minimum(counters(counts, size), 2**31 - 1).astype(np.int32)


def counters(counts: DataFrame, size: int) -> np.ndarray:
    """Rows (i, n), at most ``size`` of them, as an array of counts."""
    got = counts.select("i", "n").toArrow()
    out = np.zeros(size, dtype=np.int64)
    out[got.column("i").to_numpy()] = got.column("n").to_numpy()
    del got
    pa.default_memory_pool().release_unused()  # the driver keeps the counters only
    return out


def possible(df: DataFrame, ids: DataFrame, column: str, others: bool = False,
             then: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]] | None = None, schema: str | None = None) -> DataFrame:
    """Rows of ``df`` whose ``column`` may be among that of ``ids``: all that are, and a few others.
    With ``others`` the rest: rows whose ``column`` is surely not among them. ``then`` is run on what is left, in the
    same Python worker, and gives rows of ``schema``.

    A filter of 2**RARITY_BITS cells (whatever the corpus) that keeps most of the other rows out of
    the shuffle of an exact join that follows.
    """
    size = 1 << RARITY_BITS
    cell = lambda: F.pmod(F.xxhash64(F.col(column)), F.lit(size)).cast("int")
    hit = counters(ids.select(cell().alias("i")).distinct().withColumn("n", F.lit(1)), size) > 0
    shared = df.sparkSession.sparkContext.broadcast(hit)
    names = df.columns

    def left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            b = b.filter(pa.array(shared.value[b.column("cell_").to_numpy()] != others))
            if len(b):
                yield b.select(names)

    run = (lambda batches: then(left(batches))) if then else left
    return df.withColumn("cell_", cell()).mapInArrow(run, schema if then else df.schema)
