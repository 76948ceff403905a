"""Loads by key: given landed files are loaded once each, remembered in a durable manifest.

The manifest is a ``VersionedTable``: one row per attempt with the file's key, length and modification time, its
target, batch, outcome and error. A run lists the landed files, leaves out those that the manifest has
as loaded with the same length and time (anti-join), and loads the rest in batches per target table:

1. The batch is committed to the manifest as ``started``; a file that another run has started is left to it.
2. Its files are read with the columns of the target table by position, each row with its file's key, and written
   as the partition ``load_batch=<batch>`` of the table.
3. The outcome of every file is committed.

A batch that fails is split in halves until the files that fail stand alone; the others load. A crash between
2 and 3 leaves ``started`` rows; the next run drops their partitions and loads their files again, so no
file is ever in a table twice. A file that has changed since is a new file: it loads again beside the rows of its former
content, as a queue of landed files does (``replace_all`` routes keep the newest file only).
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrum.session import scratch_path
from ferrum.sinks.versions import CommitConflict, VersionedTable
from ferrum.sinks.writers import commit_version
from ferrum.sources.routing import landed_files, reader_for, resolve_routes

MANIFEST_SCHEMA = ("key string, length long, modified timestamp, target_table string, load_batch string, "
                   "outcome string, n_rows long, error string, attempt_at timestamp, seq long")
STARTED, LOADED, FAILED, REPLACED = "started", "loaded", "failed", "replaced"
_SAME = ["key", "length", "modified"]


def manifest(spark: SparkSession, root: str) -> VersionedTable:
    return VersionedTable(spark, root, MANIFEST_SCHEMA)


def latest(rows: DataFrame) -> DataFrame:
    """The newest attempt of every file (key, length, modified)."""
    fields = [c for c in rows.columns if c not in _SAME]
    got = rows.groupBy(*_SAME).agg(F.max(F.struct("seq", *[c for c in fields if c != "seq"])).alias("last"))
    return got.select(*_SAME, *[F.col(f"last.{c}").alias(c) for c in fields])


def pending(spark: SparkSession, base_path: str, routes: DataFrame, known: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """Landed files with a route that ``known`` (manifest rows) has not as loaded or started; with ``keys`` (column
    ``key``) only those. A file whose length or time has changed is pending again; a failed one too."""
    files = resolve_routes(landed_files(spark, base_path), routes).filter(F.col("status") == "routed").drop("status")
    if keys is not None:
        files = files.join(keys.select("key").distinct(), "key", "left_semi")
    done = latest(known).filter(F.col("outcome") != FAILED).select(*_SAME)
    return files.join(done, _SAME, "left_anti")


def _claim(store: VersionedTable, files: DataFrame, as_of: str, tries: int = 20) -> DataFrame:
    """Commit ``files`` (with ``load_batch``) as started, less those that the manifest has got meanwhile; the claimed ones."""
    spark = files.sparkSession
    for _ in range(tries):
        version, rows = store.read()
        taken = latest(rows).filter(F.col("outcome") != FAILED).select(*_SAME)
        path = scratch_path(spark, "claimed")
        mine = files.join(taken, _SAME, "left_anti")
        mine.write.parquet(path)
        mine = spark.read.schema(mine.schema).parquet(path)
        started = mine.select("key", "length", "modified", "target_table", "load_batch", F.lit(STARTED).alias("outcome"),
                              F.lit(None).cast("long").alias("n_rows"), F.lit(None).cast("string").alias("error"),
                              F.to_timestamp(F.lit(as_of)).alias("attempt_at"), F.lit(version + 1).cast("long").alias("seq"))
        try:
            store.commit(version, rows.unionByName(started))
            return mine
        except CommitConflict:
            continue
    raise CommitConflict(f"no claim after {tries} tries")


def drop_unfinished(spark: SparkSession, store: VersionedTable, database: str, before: str) -> int:
    """Undo batches that were started before ``before`` and have no outcome: their partitions go and their files
    count as failed, so they are pending again. Returns the number of files."""
    rows = latest(store.read()[1]).filter((F.col("outcome") == STARTED) & (F.col("attempt_at") < F.to_timestamp(F.lit(before))))
    lost = rows.select("target_table", "load_batch").distinct().collect()  # one row per crashed batch
    for r in lost:
        table = f"{database}.{r['target_table']}"
        if spark.catalog.tableExists(table) and "load_batch" in spark.table(table).columns:
            have = [p[0].split("=", 1)[1] for p in spark.sql(f"SHOW PARTITIONS {table}").collect()]  # metadata
            for name in have:  # a batch that was split has the parts <batch>.0 and <batch>.1
                if name == r["load_batch"] or name.startswith(f"{r['load_batch']}."):
                    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (load_batch = '{name}')")
            spark.catalog.refreshTable(table)
    n = rows.count()
    if n:
        path = scratch_path(spark, "unfinished")
        rows.withColumns({"outcome": F.lit(FAILED), "error": F.lit("no outcome")}).write.parquet(path)
        gone = spark.read.schema(MANIFEST_SCHEMA).parquet(path)
        store.update(lambda version, known: known.unionByName(gone.withColumn("seq", F.lit(version + 1).cast("long"))))
    return n


def _plain(key: str) -> str:
    """A key as a path without patterns."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", key)


def _read_batch(spark: SparkSession, base_path: str, route: dict, keys: list[str], columns: list[str] | None) -> DataFrame:
    """The rows of some files of one route with ``source_key``. A delimited file is read into ``columns`` (the
    target's) by position, and a row of another width is an error."""
    base = base_path.rstrip("/")
    reader = reader_for(spark, route)
    if route["format"] == "csv" and columns:
        reader = reader.schema(", ".join(f"`{c}` string" for c in columns)).option("mode", "FAILFAST").option("enforceSchema", True)
    df = reader.load([f"{base}/{_plain(k)}" for k in keys])
    if columns and df.columns != columns:
        raise ValueError(f"columns {df.columns} instead of {columns}")
    plain = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return df.withColumn("source_key", F.regexp_extract(plain, re.escape(base.split(":", 1)[-1]) + "/(.*)$", 1))


def _columns(spark: SparkSession, base_path: str, route: dict, table: str, key: str) -> list[str]:
    """The target's columns: those of the table, or of a file for a new table."""
    if spark.catalog.tableExists(table):
        return [c for c in spark.table(table).columns if c not in ("source_key", "load_batch")]
    return reader_for(spark, route).load(f"{base_path.rstrip('/')}/{_plain(key)}").columns


def _load(spark: SparkSession, base_path: str, route: dict, table: str, path: str, batch: str, keys: list[str]) -> list[tuple]:
    """Write files as one partition of ``table``; on a failure in two halves. [(key, batch, outcome, rows, error)]."""
    folder = f"{path.rstrip('/')}/load_batch={batch}"
    try:
        columns = _columns(spark, base_path, route, table, keys[0])
        _read_batch(spark, base_path, route, keys, columns).write.mode("overwrite").parquet(folder)
        if not spark.catalog.tableExists(table):
            names = ", ".join(f"`{c}` string" for c in columns) if route["format"] == "csv" else ", ".join(
                f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(folder).schema if f.name != "source_key")
            spark.sql(f"CREATE TABLE {table} ({names}, source_key string, load_batch string) USING parquet "
                      f"PARTITIONED BY (load_batch) LOCATION '{path}'")
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION (load_batch = '{batch}') LOCATION '{folder}'")
        spark.catalog.refreshTable(table)
    except Exception as e:  # noqa: BLE001 - a file that fails is reported and the others load
        if len(keys) == 1:
            return [(keys[0], batch, FAILED, 0, str(e))]
        half = len(keys) // 2
        return [r for name, part in ((f"{batch}.0", keys[:half]), (f"{batch}.1", keys[half:]))
                for r in _load(spark, base_path, route, table, path, name, part)]
    counts = spark.read.parquet(folder).groupBy("source_key").agg(F.count(F.lit(1)).alias("n")).collect()  # one row per file
    n = {r["source_key"]: r["n"] for r in counts}
    return [(k, batch, LOADED, n.get(k, 0), None) for k in keys]


def load_keys(spark: SparkSession, base_path: str, routes: DataFrame, store: VersionedTable, database: str, tables_root: str, as_of: str, *,
              keys: DataFrame | None = None, files_per_batch: int = 500) -> DataFrame:
    """Load every pending landed file (or those of ``keys``) into its table of ``database``, once; the manifest rows of this run.

    A second run loads nothing; a changed file loads again; a file that fails is reported with its error while
    the others load. ``replace_all`` routes take their newest pending file as the table's new version and report
    the older ones as ``replaced``.
    """
    found = pending(spark, base_path, routes, store.read()[1], keys)
    # Batches of a bounded number of files, by target; a batch's name is its own, so its partition is too.
    per = F.floor(F.pmod(F.xxhash64("key"), F.lit(1 << 20)) * F.col("__n") / F.lit((1 << 20) * files_per_batch))
    sized = found.join(found.groupBy("target_table").agg(F.count(F.lit(1)).alias("__n")), "target_table")
    named = sized.withColumn("load_batch", F.concat(F.lit(uuid.uuid4().hex[:12]), F.lit("_"), F.when(F.col("replace_all"), F.lit(0)).otherwise(per).cast("string")))
    mine = _claim(store, named.drop("__n"), as_of)
    batches = mine.groupBy("target_table", "load_batch", "format", "sep", "header", "quote", "compression", "replace_all").agg(
        F.max(F.struct("modified", "key")).alias("newest"))
    for b in batches.collect():  # one row per batch
        route, batch, target = b.asDict(), b["load_batch"], b["target_table"]
        members = [r["key"] for r in mine.filter(F.col("load_batch") == batch).filter(F.col("target_table") == target).select("key").collect()]
        table, path = f"{database}.{target}", f"{tables_root.rstrip('/')}/{target}"
        if b["replace_all"]:
            results = _replace(spark, base_path, route, table, path, batch, sorted(members), b["newest"]["key"])
        else:
            results = _load(spark, base_path, route, table, path, batch, sorted(members))
        done = spark.createDataFrame(results, "key string, batch_ string, outcome string, n_rows long, error string")
        rows = mine.filter(F.col("load_batch") == batch).filter(F.col("target_table") == target).join(done, "key").select(
            "key", "length", "modified", "target_table", F.col("batch_").alias("load_batch"), "outcome", "n_rows", "error",
            F.to_timestamp(F.lit(as_of)).alias("attempt_at"))
        store.update(lambda version, known, rows=rows: known.unionByName(rows.withColumn("seq", F.lit(version + 1).cast("long"))))
    ours = mine.select("key", "length", "modified")
    return latest(store.read()[1]).join(ours, _SAME, "left_semi")


def _replace(spark: SparkSession, base_path: str, route: dict, table: str, path: str, batch: str, keys: list[str], newest: str) -> list[tuple]:
    """Give a replace-all table the content of its newest file, as a new version."""
    try:
        columns = _columns(spark, base_path, route, table, newest)
        df = _read_batch(spark, base_path, route, [newest], columns).drop("source_key")
        commit_version(spark, table, df, path)
        n = spark.table(table).count()
    except Exception as e:  # noqa: BLE001 - reported
        return [(k, batch, FAILED, 0, str(e)) for k in keys]
    return [(k, batch, LOADED if k == newest else REPLACED, n if k == newest else 0, None) for k in keys]
