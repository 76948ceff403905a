"""Catalog tables: DDL, literal inserts, key checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed DDL of the users table.
USERS_DDL = "id INT, name STRING, email STRING, tel STRING"


def create_users_table(spark: SparkSession, name: str, location: str) -> None:
    """``CREATE TABLE IF NOT EXISTS`` of the users table as parquet at ``location``.

    The primary key of the original DDL is not enforced by Spark; use
    ``duplicate_keys`` after loading.
    """
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({USERS_DDL}) USING parquet LOCATION '{location}'")


def insert_values(spark: SparkSession, name: str, rows: list[tuple]) -> None:
    """``INSERT INTO name VALUES (...)`` for a few literal rows."""
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return str(v)
    values = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    spark.sql(f"INSERT INTO {name} VALUES {values}")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def write_text_file(spark: SparkSession, path: str, text: str) -> None:
    """One small text file, replaced if it exists (a landed key, a marker)."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001 - Hadoop's public file API
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)  # noqa: SLF001
    out.write(bytearray(text.encode()))
    out.close()
