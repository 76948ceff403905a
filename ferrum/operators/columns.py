"""Column-shape operators: fixed column lists, status normalisation, name casing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def align_columns(df: DataFrame, fixed: list[str], fill: str = "") -> DataFrame:
    """Project to ``fixed`` in order; a column the frame lacks becomes ``fill``;
    columns not in ``fixed`` follow at the end in their current order."""
    extras = [c for c in df.columns if c not in fixed]
    return df.select(*[F.col(c) if c in df.columns else F.lit(fill).alias(c) for c in fixed], *extras)


def union_aligned(frames: list[DataFrame], fixed: list[str], fill: str = "") -> DataFrame:
    """Union of record batches with different column sets, then aligned to ``fixed``.

    Columns missing from a batch are NULL in its rows; columns missing from every
    batch become ``fill``.
    """
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return align_columns(out, fixed, fill)


def normalize_status(df: DataFrame, columns: list[str]) -> DataFrame:
    """NULL, empty or non-numeric status text -> 0; numbers -> int."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("string").try_cast("int"), F.lit(0)) for c in columns})
