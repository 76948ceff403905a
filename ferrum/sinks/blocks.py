"""Range replace of a table laid out by (key, id block): only the blocks that a range meets are rewritten.

A block holds the ids ``block_size * n .. block_size * (n + 1) - 1`` of one key and is one partition, so a run that
replaces a few ranges reads and writes their blocks, whatever the size of the table; the files of
all other blocks stay as they are. Ids that are null have the null block.

With many keys, a partition for each of them is a file of a few rows and a partition list as long as the data. ``groups``
deals the keys to that many groups by hash, and a block then holds the ids of one group's keys. Writers of different
keys may meet in such a block: a commit that finds a block changed since it was read is refused, and the
replace is made again from the newer rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrum.operators.joins import in_ranges
from ferrum.sinks.versions import CommitConflict
from ferrum.sinks.writers import commit_version, partition_in, recover_switch, table_partitions

BLOCK_COLUMN, GROUP_COLUMN = "id_block", "key_group"
DEFAULT_BLOCK_SIZE = 100_000


def id_block(id_col: Column | str, block_size: int = DEFAULT_BLOCK_SIZE) -> Column:
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.floor(c / F.lit(block_size)).cast("long")


def key_group(key: str, groups: int) -> Column:
    """The group of a key (also of a null one), the same for every writer."""
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(groups)).cast("int")


def _partition_cols(key: str, groups: int | None) -> list[str]:
    return [GROUP_COLUMN if groups else key, BLOCK_COLUMN]


def _placed(rows: DataFrame, *, key: str, id_col: str, block_size: int, groups: int | None) -> DataFrame:
    """``rows`` with the columns that name their partition."""
    if groups:
        rows = rows.withColumn(GROUP_COLUMN, key_group(key, groups))
    return rows.withColumn(BLOCK_COLUMN, id_block(id_col, block_size))


def create_blocked_table(spark: SparkSession, table_name: str, rows: DataFrame, root: str, *, key: str, id_col: str,
                         block_size: int = DEFAULT_BLOCK_SIZE, groups: int | None = None) -> None:
    """A table of ``rows`` partitioned by (key, id block), or with ``groups`` by (key group, id block); these
    columns come last. Its writers have to give the same ``block_size`` and ``groups``."""
    commit_version(spark, table_name, _placed(rows, key=key, id_col=id_col, block_size=block_size, groups=groups), root,
                   partition_cols=_partition_cols(key, groups))


def affected_blocks(spark: SparkSession, table_name: str, ranges: DataFrame, *, key: str, block_size: int,
                    lo: str = "from_id", hi: str = "to_id", groups: int | None = None) -> list[dict]:
    """The table's partitions that one of ``ranges`` meets. Partitions and ranges meet in
    Spark; what comes back is a part of the partition list."""
    cols = _partition_cols(key, groups)
    have = list(table_partitions(spark, table_name, cols))
    have = spark.createDataFrame(have, "k string, b string").select("k", F.col("b").cast("long").alias("b"))
    of = key_group(key, groups) if groups else F.col(key)
    wanted = ranges.filter(F.col(key).isNotNull()).select(
        of.cast("string").alias("k"), id_block(lo, block_size).alias("first"), id_block(hi, block_size).alias("last"))
    found = in_ranges(have, wanted, key="k", id_col="b", lo="first", hi="last")
    return [{cols[0]: r["k"], BLOCK_COLUMN: r["b"]} for r in found.collect()]


def replace_ranges_in_blocks(spark: SparkSession, table_name: str, new_rows: DataFrame, ranges: DataFrame, root: str, *, key: str,
                             id_col: str, block_size: int = DEFAULT_BLOCK_SIZE, lo: str = "from_id", hi: str = "to_id",
                             groups: int | None = None, tries: int = 20) -> list[dict]:
    """Delete the rows of every key's ``[lo, hi]`` ranges, insert ``new_rows``, as one commit of the blocks
    concerned. Returns the blocks whose old files were replaced. The result is that of
    ``replace_keyed_ranges`` over the whole table; a second run gives the same rows. A block that another writer has
    changed meanwhile is read and replaced again."""
    cols = _partition_cols(key, groups)
    fresh = _placed(new_rows, key=key, id_col=id_col, block_size=block_size, groups=groups)
    more = [(r[0], r[1]) for r in fresh.select(*[F.col(c).cast("string") for c in cols]).distinct().collect()]
    for _ in range(tries):
        recover_switch(spark, table_name)
        spark.catalog.refreshTable(table_name)
        have = table_partitions(spark, table_name, cols)  # before any row is read
        hit = affected_blocks(spark, table_name, ranges, key=key, block_size=block_size, lo=lo, hi=hi, groups=groups)
        # A new row may also lie outside the ranges; its block is then extended, so it counts as concerned.
        known = {tuple(None if r[c] is None else str(r[c]) for c in cols) for r in hit}
        hit += [dict(zip(cols, v, strict=True)) for v in more if v in have and v not in known]
        old = spark.table(table_name).filter(partition_in(cols, hit))
        kept = in_ranges(old, ranges, key=key, id_col=id_col, lo=lo, hi=hi, how="left_anti")
        try:
            commit_version(spark, table_name, kept.unionByName(fresh.select(kept.columns)), root, touched=hit, seen=have)
            return hit
        except CommitConflict:
            continue
    raise CommitConflict(f"{table_name}: no commit after {tries} tries")
