"""Retention: delete rows past an age limit, erase columns past their limits,
and apply both to every table of a database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ferrum.functions.dates import day_age


def _age(ts_col: str, as_of: str):
    return day_age(F.col(ts_col), F.to_timestamp(F.lit(as_of)))


def expired(ts_col: str, as_of: str, days: int):
    """TRUE when the row's age is at least ``days``; NULL age -> FALSE (row kept)."""
    return F.coalesce(_age(ts_col, as_of) >= days, F.lit(False))


def retention_delete(df: DataFrame, ts_col: str, as_of: str, days: int) -> DataFrame:
    """Rows to keep: age below ``days`` calendar days, or unknown age."""
    return df.filter(~expired(ts_col, as_of, days))


def parse_erase_rules(rules: dict) -> dict[str, int]:
    """``{days: "c1,c2"}`` -> ``{column: smallest days}``."""
    out: dict[str, int] = {}
    for days, cols in rules.items():
        names = cols.split(",") if isinstance(cols, str) else list(cols)
        for c in (n.strip() for n in names):
            if c:
                out[c] = min(int(days), out.get(c, int(days)))
    return out


def erase_columns(df: DataFrame, ts_col: str, as_of: str, rules: dict) -> DataFrame:
    """Set listed columns to NULL once the row is at least their age limit old.

    Rules name columns per age limit (``{700: "email,tel"}``); columns not in the
    table are ignored. Types are kept (typed NULL).
    """
    limits = parse_erase_rules(rules)
    present = {c: d for c, d in limits.items() if c in df.columns}
    return df.withColumns({
        c: F.when(expired(ts_col, as_of, d), F.lit(None).cast(df.schema[c].dataType)).otherwise(F.col(c))
        for c, d in present.items()})


REPORT_SCHEMA = StructType([
    StructField("table_name", StringType()), StructField("rows_before", LongType()),
    StructField("rows_removed", LongType()), StructField("rows_after", LongType()),
    StructField("status", StringType()),
])


def apply_retention_to_table(spark: SparkSession, name: str, as_of: str, days: int, erase_rules: dict, version_root: str, *,
                             delete_ts_col: str, erase_ts_col: str | None = None, purge: bool = True) -> tuple[int, int]:
    """Delete expired rows of one table and erase its expired columns; (rows before, rows removed).

    ``delete_ts_col`` gives the age for deletion, ``erase_ts_col`` (default: the same) the
    age for erasure. One scan counts rows, expired rows and affected rows (per partition); only
    partitions that hold an affected row are rewritten, and a table without any keeps its files.
    With ``purge`` the replaced files are deleted once the new version is in place, so
    deleted rows and erased values do not stay on disk.
    """
    from ferrum.sinks.writers import commit_version, partition_in, remove_folders, table_files, table_layout, table_partitions

    df = spark.table(name)
    erase_ts_col = erase_ts_col or delete_ts_col
    rules = erase_rules if erase_ts_col in df.columns else {}
    limits = {c: d for c, d in parse_erase_rules(rules).items() if c in df.columns}
    gone = expired(delete_ts_col, as_of, days)
    # A value that is already erased needs no second rewrite.
    hit = gone
    for c, d in limits.items():
        hit = hit | (expired(erase_ts_col, as_of, d) & F.col(c).isNotNull())
    layout = table_layout(spark, name)
    cols = layout.partition_cols
    text = [F.col(c).cast("string").alias(c) for c in cols]
    counts = df.groupBy(*text).agg(F.count(F.lit(1)).alias("__n"), F.sum(gone.cast("long")).alias("__gone"), F.max(hit.cast("int")).alias("__hit"))
    found = counts.collect()  # one row per partition: metadata; one row without partitions
    before, removed = sum(r["__n"] for r in found), sum(r["__gone"] or 0 for r in found)
    touched = [{c: r[c] for c in cols} for r in found if r["__hit"]]
    if not touched:
        return before, 0
    work = df.filter(partition_in(cols, touched)) if cols else df
    if cols and not layout.managed:
        mine = {tuple(r[c] for c in cols) for r in touched}
        old = [f for v, f in table_partitions(spark, name, cols).items() if v in mine]
    else:
        old = table_files(spark, name)
    # Erasure first, so that its age column is still there; deletion keeps rows of unknown age.
    kept = erase_columns(work.filter(~gone), erase_ts_col, as_of, rules) if rules else work.filter(~gone)
    commit_version(spark, name, kept, version_root, touched=touched if cols else None)
    if purge:
        remove_folders(spark, old)
    return before, removed


def apply_retention_to_database(spark: SparkSession, database: str, delete_ts_col: str, as_of: str,
                                days: int, erase_rules: dict, version_root: str, *,
                                erase_ts_col: str | None = None, purge: bool = True) -> DataFrame:
    """Retention on every table of ``database``; one report row per table.

    Views and tables without ``delete_ts_col`` are reported and left alone, and a table
    that fails is reported with its error while the others go on.
    """
    report = []
    for t in spark.catalog.listTables(database):
        if t.isTemporary:  # session temp views are listed with every database
            continue
        name = f"{database}.{t.name}"
        if t.tableType == "VIEW":
            report.append((t.name, None, None, None, "skipped: view"))
            continue
        if delete_ts_col not in spark.table(name).columns:
            report.append((t.name, None, None, None, f"skipped: no column {delete_ts_col}"))
            continue
        try:
            before, removed = apply_retention_to_table(
                spark, name, as_of, days, erase_rules, f"{version_root}/{database}/{t.name}",
                delete_ts_col=delete_ts_col, erase_ts_col=erase_ts_col, purge=purge)
            report.append((t.name, before, removed, before - removed, "ok"))
        except Exception as e:  # noqa: BLE001 - reported per table
            report.append((t.name, None, None, None, f"failed: {e}"))
    return spark.createDataFrame(report, REPORT_SCHEMA)
