"""Sinks: partitioned appends, CSV, date layouts, idempotent replaces, upserts.

A table that is rewritten from itself (range replace, retention, upsert) is
never overwritten in place: the new content goes to a fresh version folder and
the catalog table is then pointed at it. A table without partitions is switched by
its location; one with partitions by a second catalog table with the complete list of
partitions that takes its name. A job that fails before the switch leaves the previous
version whole; one that fails within it is finished by the next commit (``recover_switch``).
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ferrum.sinks.versions import CommitConflict, exclusive

MAX_RECORDS_PER_FILE = 5_000_000


def partitioned_write(df: DataFrame, path: str, partition_cols: list[str], *, mode: str = "append",
                      dynamic_overwrite: bool = False, max_records_per_file: int = MAX_RECORDS_PER_FILE) -> None:
    """Write ``df`` partitioned by ``partition_cols``, rows of one value clustered.

    The ``rebalance`` hint shuffles by the partition columns and lets AQE split large
    partitions and join small ones at the advisory size, so the number of tasks that
    write one value follows from its data: a hot value is split, a small one is one file.
    """
    w = df.hint("rebalance", *[F.col(c) for c in partition_cols]).write.mode(mode)
    w = w.option("maxRecordsPerFile", max_records_per_file)
    if dynamic_overwrite:
        w = w.option("partitionOverwriteMode", "dynamic")
    w.partitionBy(*partition_cols).parquet(path)


def write_csv(df: DataFrame, path: str, *, header: bool = True, mode: str = "overwrite",
              sep: str = ",", compression: str | None = None) -> None:
    w = df.write.mode(mode).option("header", header).option("sep", sep)
    if compression:
        w = w.option("compression", compression)
    w.csv(path)


def with_date_parts(df: DataFrame, day: Column | str) -> DataFrame:
    """Add ``year``, ``month``, ``day`` text columns (``YYYY``, ``MM``, ``DD``) for a
    ``root/YYYY/MM/DD`` style layout."""
    d = F.col(day) if isinstance(day, str) else day
    return df.withColumns({
        "year": F.date_format(d, "yyyy"), "month": F.date_format(d, "MM"), "day": F.date_format(d, "dd")})


def date_layout_key(root: str, file_name: Column | str, day: Column | str) -> Column:
    """``root/YYYY/MM/DD/file`` as a column."""
    d = F.col(day) if isinstance(day, str) else day
    f = F.col(file_name) if isinstance(file_name, str) else file_name
    return F.concat_ws("/", F.lit(root), F.date_format(d, "yyyy/MM/dd"), f)


def replace_range(current: DataFrame, new_rows: DataFrame, id_col: str, lo, hi) -> DataFrame:
    """``DELETE WHERE id BETWEEN lo AND hi`` then ``INSERT new_rows``, as one frame.

    Re-running with the same range and rows gives the same result (no duplicates).
    Rows of ``current`` with a NULL id are kept.
    """
    keep = current.filter(~F.coalesce(F.col(id_col).between(lo, hi), F.lit(False)))
    return keep.unionByName(new_rows)


def replace_keyed_ranges(current: DataFrame, new_rows: DataFrame, ranges: DataFrame, *,
                         key: str, id_col: str, lo: str = "from_id", hi: str = "to_id") -> DataFrame:
    """Per-key range replace for many keys at once.

    ``ranges`` holds ``(key, lo, hi)`` rows (any number per key). Rows of
    ``current`` inside one of their key's ranges are dropped (anti join on
    the key with the range as condition, see ``in_ranges``), then the new rows are appended.
    """
    from ferrum.operators.joins import in_ranges
    kept = in_ranges(current, ranges, key=key, id_col=id_col, lo=lo, hi=hi, how="left_anti")
    return kept.unionByName(new_rows)


def overwrite_partitions(df: DataFrame, path: str, partition_cols: list[str]) -> None:
    """Replace only the partitions present in ``df`` (dynamic partition overwrite)."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition_cols).parquet(path))


def overwrite_all(spark: SparkSession, table_name: str, df: DataFrame, root: str) -> str:
    """Replace the whole table ``table_name`` by ``df``: a new version under ``root``, so the old
    content stays readable until the new one is complete, and for good if the write fails."""
    return commit_version(spark, table_name, df, root)


def merge_non_null(current: DataFrame, updates: DataFrame, key: str | list[str], order_by: str | None = None) -> DataFrame:
    """Upsert: unknown keys are inserted; for known keys every column takes the
    update's value where it is non-NULL, else keeps the current value.

    Several updates of one key are reduced first: each column takes its non-NULL value
    with the greatest ``order_by`` (without it, the greatest value). Update columns that
    the table lacks are added (NULL for untouched rows). NULL keys match nothing: such
    updates are inserted one by one. One full outer join on the key.
    """
    keys = [key] if isinstance(key, str) else list(key)
    fresh = [c for c in updates.columns if c not in keys and c != order_by]
    cols = [c for c in current.columns if c not in keys]
    cols += [c for c in fresh if c not in cols]

    def last(c: str) -> Column:
        if order_by is None:
            return F.max(c)
        return F.max_by(c, F.when(F.col(c).isNotNull(), F.struct(F.col(order_by).isNotNull(), F.col(order_by), F.col(c))))

    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    u = updates.filter(known).groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), *[last(c).alias(f"__u_{c}") for c in fresh]).drop("__n")
    j = current.join(u, keys, "full_outer")

    def merged(c: str) -> Column:
        if c not in fresh:
            return F.col(c)
        return F.coalesce(F.col(f"__u_{c}"), F.col(c)).alias(c) if c in current.columns else F.col(f"__u_{c}").alias(c)

    loose = updates.filter(~known).select(*keys, *[F.col(c) for c in fresh])
    return j.select(*keys, *[merged(c) for c in cols]).unionByName(loose, allowMissingColumns=True)


def new_version_path(root: str) -> str:
    return f"{root.rstrip('/')}/v-{uuid.uuid4().hex[:16]}"


@dataclass
class Layout:
    """How a catalog table is stored."""

    location: str | None
    partition_cols: list[str]
    buckets: int
    bucket_cols: list[str]
    sort_cols: list[str]
    managed: bool = False


def table_layout(spark: SparkSession, table_name: str) -> Layout:
    info = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table_name}").collect()}
    names = lambda text: re.findall("`([^`]+)`", text or "")
    return Layout(info.get("Location"), [c.name for c in spark.catalog.listColumns(table_name) if c.isPartition],
                  int(info.get("Num Buckets", 0) or 0), names(info.get("Bucket Columns")), names(info.get("Sort Columns")),
                  info.get("Type") == "MANAGED")


def _write_layout(spark: SparkSession, df: DataFrame, path: str, layout: Layout) -> None:
    """Write ``df`` to a new folder with the layout of its table."""
    if layout.partition_cols:
        df = df.hint("rebalance", *[F.col(c) for c in layout.partition_cols])
    elif layout.buckets:
        df = df.repartition(layout.buckets, *layout.bucket_cols)  # one writer per bucket file
    w = df.write.mode("errorifexists")
    if layout.partition_cols:
        w = w.partitionBy(*layout.partition_cols)
    if not layout.buckets:
        w.parquet(path)
        return
    # Only a catalog write makes bucket files; its own entry goes again, the files stay.
    w = w.format("parquet").bucketBy(layout.buckets, *layout.bucket_cols)
    if layout.sort_cols:
        w = w.sortBy(*layout.sort_cols)
    staging = f"staging_{uuid.uuid4().hex[:12]}"
    w.option("path", path).saveAsTable(staging)
    spark.sql(f"DROP TABLE {staging}")


def _partition_spec(cols: list[str], values: tuple) -> str:
    def lit(v) -> str:
        return "NULL" if v is None else "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"
    return ", ".join(f"`{c}` = {lit(v)}" for c, v in zip(cols, values, strict=True))


def file_folder() -> Column:
    """The folder of a row's file. ``_metadata.file_path`` is an escaped URI; this is the plain path."""
    plain = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return F.regexp_extract(plain, "^(.*)/[^/]*$", 1)


def partition_folders(files: list[str], cols: list[str]) -> dict[tuple, str]:
    """{partition values as text: folder} from the names of a partitioned frame's files (``DataFrame.inputFiles``,
    so no row is read). A null value has its own folder name; names escape special characters as %XX."""
    out: dict[tuple, str] = {}
    for uri in files:
        folder = unquote(uri).rsplit("/", 1)[0]  # the URI escapes the path, the path escapes the values
        parts = dict(p.split("=", 1) for p in folder.split("/") if "=" in p)
        values = tuple(None if parts[c] == "__HIVE_DEFAULT_PARTITION__" else unquote(parts[c]) for c in cols)
        out[values] = folder
    return out


def recover_switch(spark: SparkSession, table_name: str) -> bool:
    """Finish a switch that stopped between its two renames: the name is free and the complete next
    table (or, without one, the previous table) takes it. True where something was done."""
    if spark.catalog.tableExists(table_name):
        return False
    for suffix in ("__next", "__prev"):
        if spark.catalog.tableExists(table_name + suffix):
            spark.sql(f"ALTER TABLE {table_name}{suffix} RENAME TO {table_name}")
            spark.sql(f"DROP TABLE IF EXISTS {table_name}__prev")
            return True
    return False


PARTITIONS_PER_STATEMENT = 500


def _switch_partitions(spark: SparkSession, table_name: str, cols: list[str], folders: dict[tuple, str], root: str) -> None:
    """Give ``table_name`` exactly the partitions ``folders``, all at once for its readers: a second
    catalog table is given the complete list first and then takes the name."""
    following = f"{table_name}__next"
    spark.sql(f"DROP TABLE IF EXISTS {following}")  # left by a commit that failed while listing; external, so no files go
    spark.sql(f"CREATE TABLE {following} LIKE {table_name} LOCATION '{root}'")
    specs = [f"PARTITION ({_partition_spec(cols, v)}) LOCATION '{f}'" for v, f in sorted(folders.items(), key=str)]
    for k in range(0, len(specs), PARTITIONS_PER_STATEMENT):
        spark.sql(f"ALTER TABLE {following} ADD {' '.join(specs[k: k + PARTITIONS_PER_STATEMENT])}")
    spark.sql(f"DROP TABLE IF EXISTS {table_name}__prev")
    spark.sql(f"ALTER TABLE {table_name} RENAME TO {table_name}__prev")
    spark.sql(f"ALTER TABLE {following} RENAME TO {table_name}")
    spark.sql(f"DROP TABLE {table_name}__prev")


def commit_version(spark: SparkSession, table_name: str, df: DataFrame, root: str,
                   partition_cols: list[str] | None = None, touched: list[dict] | None = None,
                   seen: dict[tuple, str] | None = None) -> str:
    """Write ``df`` to a new version folder under ``root`` and point the catalog table
    ``table_name`` at it, in the table's own layout (partitions, buckets). Returns the folder.

    Readers see the whole old or the whole new version. With ``touched`` (partition values) ``df``
    holds the new content of those partitions only and the others keep their files; a touched
    partition without new rows goes. A partitioned table that the catalog owns the files of
    (managed) is rewritten whole once, as the switch would move its files; it is external then. With
    ``seen`` (``table_partitions`` as they were when ``df`` was derived) a partition of ``df`` or ``touched`` that
    another commit has changed since raises ``CommitConflict`` and nothing is switched.
    """
    path = new_version_path(root)
    recover_switch(spark, table_name)
    if not spark.catalog.tableExists(table_name):
        _write_layout(spark, df, path, Layout(None, partition_cols or [], 0, [], []))
        if partition_cols:
            _create_partitioned(spark, table_name, df, path, partition_cols)
            spark.catalog.recoverPartitions(table_name)
        else:
            spark.catalog.createTable(table_name, path=path, source="parquet")
        return path
    layout = table_layout(spark, table_name)
    cols = layout.partition_cols
    if cols and layout.managed and touched is not None:
        df = spark.table(table_name).filter(~partition_in(cols, touched)).unionByName(df)
        touched = None
    _write_layout(spark, df, path, layout)
    if not cols:
        spark.sql(f"ALTER TABLE {table_name} SET LOCATION '{path}'")
        spark.catalog.refreshTable(table_name)
        return path
    new = partition_folders(spark.read.parquet(path).inputFiles(), cols) if _has_files(spark, path) else {}
    # Two commits of other partitions must not both start from one list.
    with exclusive(spark, f"{root.rstrip('/')}/_switch.lock"):
        kept = {}
        if touched is not None:
            gone = {tuple(None if r[c] is None else str(r[c]) for c in cols) for r in touched}
            spark.catalog.refreshTable(table_name)
            now = table_partitions(spark, table_name, cols)
            if seen is not None and any(now.get(v) != seen.get(v) for v in gone | set(new)):
                remove_folders(spark, [path])
                raise CommitConflict(f"{table_name}: another commit has changed a partition since it was read")
            kept = {v: f for v, f in now.items() if v not in gone}
        _switch_partitions(spark, table_name, cols, {**kept, **new}, path)
    spark.catalog.refreshTable(table_name)
    return path


def _create_partitioned(spark: SparkSession, name: str, df: DataFrame, path: str, partition_cols: list[str]) -> None:
    rest = [f for f in df.schema if f.name not in partition_cols] + [df.schema[c] for c in partition_cols]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest)
    by = ", ".join(f"`{c}`" for c in partition_cols)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY ({by}) LOCATION '{path}'")


def partition_in(cols: list[str], touched: list[dict]) -> Column:
    """Whether a row's partition is one of ``touched`` (a list of partitions: metadata). The condition is on
    partition columns alone, so the others are pruned before any file is opened."""
    # Values become one text each; a null has a mark that no value has.
    text = lambda v: "n" if v is None else f"v{len(str(v))}:{v}"
    parts = [F.coalesce(F.concat(F.lit("v"), F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("n")) for c in cols]
    return F.concat(*parts).isin(["".join(text(r[c]) for c in cols) for r in touched]) if touched else F.lit(False)


def table_partitions(spark: SparkSession, table_name: str, cols: list[str]) -> dict[tuple, str]:
    """{partition values as text: folder} of a partitioned table, from its file names."""
    return partition_folders(spark.table(table_name).inputFiles(), cols)


def _has_files(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001 - Hadoop's public file API
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001
    return any(s.isDirectory() for s in fs.listStatus(hadoop) if not s.getPath().getName().startswith("_"))


def table_files(spark: SparkSession, table_name: str) -> list[str]:
    """Folders that a table's current rows are read from (one per partition)."""
    return sorted({unquote(f).rsplit("/", 1)[0] for f in spark.table(table_name).inputFiles()})


def remove_folders(spark: SparkSession, folders: list[str]) -> None:
    """Delete folders that no table reads any more, so that removed rows leave the disk."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs  # noqa: SLF001 - Hadoop's public file API
    for folder in folders:
        path = hadoop.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)  # noqa: SLF001


def append_partitions(df: DataFrame, name: str, path: str, partition_cols: list[str]) -> list[dict]:
    """Append ``df`` to the partitioned catalog table ``name`` at ``path`` (created on first use) and make the
    partitions of this write readable, and no others: the write itself reports which values it has (an
    observed set, one entry per partition), so no folder is listed. Returns them."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        _create_partitioned(spark, name, df, path, partition_cols)
    seen = Observation(f"partitions_{uuid.uuid4().hex[:12]}")
    values = F.collect_set(F.struct(*[F.coalesce(F.concat(F.lit("v"), F.col(c).cast("string")), F.lit("n")).alias(c) for c in partition_cols]))
    partitioned_write(df.observe(seen, values.alias("found")), path, partition_cols)
    found = [tuple(None if r[c] == "n" else r[c][1:] for c in partition_cols) for r in seen.get["found"]]
    specs = [f"PARTITION ({_partition_spec(partition_cols, v)})" for v in sorted(found, key=str)]
    for k in range(0, len(specs), PARTITIONS_PER_STATEMENT):
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(specs[k: k + PARTITIONS_PER_STATEMENT])}")
    spark.catalog.refreshTable(name)
    return [dict(zip(partition_cols, v, strict=True)) for v in found]


def write_per_source_file(df: DataFrame, path: str, file_col: str = "filename", mode: str = "append") -> None:
    """One output folder per input file (``filename=<stem>``). With
    ``mode="overwrite"`` (dynamic partition overwrite) a re-delivered file
    replaces only its own folder."""
    stem = F.regexp_replace(F.element_at(F.split(F.col(file_col), "/"), -1), "\\.[^.]*$", "")
    partitioned_write(df.withColumn(file_col, stem), path, [file_col], mode=mode, dynamic_overwrite=True)


def append_to_table(df: DataFrame, name: str, path: str | None = None,
                    bucket_by: tuple[int, list[str]] | None = None) -> None:
    """Append to a catalog table, creating it (parquet, optionally at ``path``) on first use.

    ``bucket_by=(n, cols)`` creates the table bucketed (and sorted) by ``cols``:
    later joins and aggregations on those columns read it already partitioned,
    so only the other side of a join is shuffled. Appends keep the bucketing.
    """
    spark = df.sparkSession
    if spark.catalog.tableExists(name):
        layout = table_layout(spark, name)
        if layout.buckets:  # one writer per bucket, so one file per bucket and append
            df = df.repartition(layout.buckets, *layout.bucket_cols)
        df.write.insertInto(name)
        return
    w = df.write.format("parquet")
    if bucket_by:
        n, cols = bucket_by
        w = df.repartition(n, *cols).write.format("parquet").bucketBy(n, *cols).sortBy(*cols)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)


def replace_where(current: DataFrame, new_rows: DataFrame, predicate: Column) -> DataFrame:
    """Delete the rows matching ``predicate`` (NULL counts as not matching), then
    insert ``new_rows``: the general form of a partition replace with an extra
    condition. Commit the result with ``commit_version``."""
    return current.filter(~F.coalesce(predicate, F.lit(False))).unionByName(new_rows)
