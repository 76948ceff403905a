"""Query scans: SQL text run by Spark, result columns named by the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def query_table(spark: SparkSession, sql: str, names: list[str] | None = None,
                views: dict[str, DataFrame] | None = None) -> DataFrame:
    """Run ``sql`` (with ``views`` registered as temp views for its analysis) and name the
    result columns ``names`` in order. The statement is planned by Catalyst like
    any DataFrame query (IN / NOT IN subqueries become semi / null-aware anti joins)."""
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    try:
        out = spark.sql(sql)  # analysed now: the plan keeps the resolved relations
    finally:
        for name in views or {}:
            spark.catalog.dropTempView(name)
    return out.toDF(*names) if names else out


def register_partitioned_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Catalog entry over partitioned parquet files, partitions discovered from
    the folder layout (a catalog refresh after new partitions were written)."""
    if spark.catalog.tableExists(name):
        spark.catalog.recoverPartitions(name)
        spark.catalog.refreshTable(name)
    else:
        spark.catalog.createTable(name, path=path, source="parquet")
        spark.catalog.recoverPartitions(name)
    return spark.table(name)

