"""Join building blocks with explicit null and size semantics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferrum.session import scratch_path


def not_in(left: DataFrame, right: DataFrame, left_key: str, right_key: str | None = None) -> DataFrame:
    """SQL ``left_key NOT IN (SELECT right_key FROM right)`` with its NULL rules.

    * empty set        -> every left row (NULL keys included)
    * set holds a NULL -> no row
    * otherwise        -> left rows with a non-NULL key that is not in the set

    Spark's own null-aware anti join needs the subquery side broadcast (or falls
    back to a nested-loop join). Here the set is reduced to distinct keys, its size and
    NULL flag are scalar subqueries of the same plan (nothing runs while the plan is
    built), and the anti join is an ordinary shuffle ``left_anti``.
    """
    keys = right.select(F.col(right_key or left_key).alias("__nin_key")).distinct()
    size = keys.agg(F.count(F.lit(1))).scalar()
    nulls = keys.agg(F.count(F.when(F.col("__nin_key").isNull(), 1))).scalar()
    rest = left.join(keys, F.col(left_key) == F.col("__nin_key"), "left_anti")
    return rest.filter((size == 0) | ((nulls == 0) & F.col(left_key).isNotNull()))


def is_in(left: DataFrame, right: DataFrame, left_key: str, right_key: str | None = None) -> DataFrame:
    """SQL ``left_key IN (SELECT right_key FROM right)``: a semi join (never multiplies rows).

    The right side is reduced to distinct keys before it is shuffled to the join."""
    keys = right.select(F.col(right_key or left_key).alias("__in_key")).distinct()
    return left.join(keys, F.col(left_key) == F.col("__in_key"), "left_semi")


def semi_on(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Keep left rows whose ``keys`` tuple exists in ``right`` (NULL never matches)."""
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys]).distinct()
    cond = None
    for k in keys:
        c = F.col(k) == F.col(f"__r_{k}")
        cond = c if cond is None else cond & c
    return left.join(r, cond, "left_semi")


def filtered_join_chain(base: DataFrame, base_filter: Column | None,
                        steps: list[tuple[DataFrame, str, str, Column | None]]) -> DataFrame:
    """Chain of inner equi-joins, each side filtered before it joins.

    ``steps`` = ``[(dim, left_key, dim_key, dim_filter)]``. Filters are applied
    before the joins (Catalyst would push them anyway; writing them here keeps the
    plan obvious). Small sides are broadcast by AQE from their runtime size.
    """
    out = base if base_filter is None else base.filter(base_filter)
    for dim, left_key, dim_key, dim_filter in steps:
        d = dim if dim_filter is None else dim.filter(dim_filter)
        out = out.join(d, out[left_key] == d[dim_key], "inner")
    return out


#: Above this many ranges of one key, rows are swept past the ranges instead of joined with them.
MANY_RANGES = 64


def in_ranges(df: DataFrame, ranges: DataFrame, *, key: str, id_col: str, lo: str = "from_id",
              hi: str = "to_id", how: str = "left_semi", sweep: bool | None = None) -> DataFrame:
    """Rows of ``df`` whose ``id_col`` lies in one of their key's ``[lo, hi]`` ranges
    (``how="left_semi"``) or in none of them (``how="left_anti"``).

    With few ranges per key: an equi-join on the key with the range as condition, whose cost
    follows rows x ranges of their key; AQE splits the left side of a hot key. With many ranges of a key:
    ``sweep_ranges``, near linear in rows and ranges. ``sweep`` chooses; without it the ranges are
    counted per key (one aggregate over the ranges). Ranges with a NULL end match nothing.
    Neither way multiplies rows.
    """
    if how not in ("left_semi", "left_anti"):
        raise ValueError("how must be left_semi or left_anti")
    r = ranges.filter(F.col(lo).isNotNull() & F.col(hi).isNotNull() & (F.col(lo) <= F.col(hi))).select(
        F.col(key).alias("__rk"), F.col(lo).alias("__lo"), F.col(hi).alias("__hi")).distinct()
    if sweep is None:
        most = r.groupBy("__rk").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
        sweep = (most or 0) > MANY_RANGES
    if sweep:
        return sweep_ranges(df, r, key=key, id_col=id_col, how=how)
    return df.join(r, (F.col(key) == F.col("__rk")) & F.col(id_col).between(F.col("__lo"), F.col("__hi")), how)


def sweep_ranges(df: DataFrame, r: DataFrame, *, key: str, id_col: str, how: str) -> DataFrame:
    """``in_ranges`` for ranges ``(__rk, __lo, __hi)`` by one sorted pass.

    A row lies in a range of its key exactly if, of the key's ranges that begin at or before its id, the
    one that reaches furthest reaches it. Range starts and rows are sorted together by
    (key, position) over ranges of partitions, so a hot key spans many of them. The furthest end is carried in two
    levels: from task to task (one row per key and task), then along the rows of each.
    """
    r = r.groupBy("__rk", "__lo").agg(F.max("__hi").alias("__hi"))
    cols = df.columns
    data = F.struct(*[F.col(c) for c in cols])
    empty = F.lit(None).cast(df.select(data.alias("d")).schema["d"].dataType)
    starts = r.select(F.col("__rk").alias("k"), F.col("__lo").alias("at"), F.lit(0).alias("kind"), F.col("__hi").alias("end"), empty.alias("row"))
    rows = df.select(F.col(key).alias("k"), F.col(id_col).alias("at"), F.lit(1).alias("kind"),
                     F.lit(None).cast(r.schema["__hi"].dataType).alias("end"), data.alias("row"))
    # Equal places of one key are parted by a salt, so that very many rows of one id do not share a task; a start
    # counts for its whole place: it is sorted before the rows there.
    salt = F.when(F.col("kind") == 0, F.lit(0)).otherwise(F.xxhash64("row"))
    both = starts.unionByName(rows).withColumn("salt", salt)
    order = ["k", "at", "kind", "salt"]
    placed = both.repartitionByRange(*order).withColumn("task", F.spark_partition_id())
    placed = placed.sparkSession.read.schema(placed.schema).parquet(_written(placed, "range-sweep"))
    by_task = Window.partitionBy("k").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    carried = placed.filter("kind = 0").groupBy("k", "task").agg(F.max("end").alias("end"))
    tasks = placed.select("k", "task").distinct().join(carried, ["k", "task"], "left")
    tasks = tasks.select(F.col("k").alias("__k"), F.col("task").alias("__task"), F.max("end").over(by_task).alias("before"))
    along = Window.partitionBy("k", "task").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)
    reach = placed.withColumn("here", F.max("end").over(along)).join(
        tasks, (F.col("k") == F.col("__k")) & (F.col("task") == F.col("__task")), "left")
    inside = F.coalesce(F.greatest("here", "before") >= F.col("at"), F.lit(False)) & F.col("k").isNotNull()
    hit = reach.filter(F.col("kind") == 1).filter(inside if how == "left_semi" else ~inside)
    return hit.select(*[F.col("row").getField(c).alias(c) for c in cols])


def _written(df: DataFrame, name: str) -> str:
    """``df`` under the shared scratch folder: its task numbers are read more than once and must not change."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return path
