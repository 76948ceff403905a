"""File sources: JSON lines, all-string CSV, parquet, and input-file selection."""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ferrum.functions.text import anchored, file_stem
from ferrum.session import scratch_path


def read_json(spark: SparkSession, path: str, schema: StructType | str | None = None,
              sampling_ratio: float | None = None) -> DataFrame:
    """JSON lines. Without a schema the schema is inferred (one extra pass over
    the input, or over ``sampling_ratio`` of it); give a schema for large inputs."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    elif sampling_ratio is not None:
        reader = reader.option("samplingRatio", sampling_ratio)
    return reader.json(path)


def sample_schema(spark: SparkSession, sample_path: str) -> StructType:
    """The schema of a *sample message* file (an example document, not DDL)."""
    return spark.read.json(sample_path).schema


def sample_text_schema(spark: SparkSession, sample_json: str) -> StructType:
    """Schema of one example document given as text (inferred once from one tiny row)."""
    ddl = spark.range(1).select(F.schema_of_json(F.lit(sample_json))).first()[0]
    return spark.range(1).select(F.from_json(F.lit(sample_json), ddl).alias("s")).schema["s"].dataType


def read_json_with_sample(spark: SparkSession, path: str, sample_path: str) -> DataFrame:
    """Read messages with the fixed schema taken from a sample document.

    Fields absent from the sample are ignored; fields absent from a message are
    NULL; a line that ends with a trailing ``,`` still parses.
    """
    return spark.read.schema(sample_schema(spark, sample_path)).json(path)


def read_csv_strings(spark: SparkSession, path: str, sep: str = ",", quote: str = '"',
                     header: bool = True) -> DataFrame:
    """CSV with a header row, every column kept as text (no inference pass)."""
    return (spark.read.option("header", header).option("sep", sep).option("quote", quote)
            .option("inferSchema", False).csv(path))


def require_columns(df: DataFrame, needed: list[str]) -> DataFrame:
    """Project to ``needed`` in order; fail with the full list of missing names."""
    missing = [c for c in needed if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df.select(*needed)


def list_files(spark: SparkSession, folder: str, name_from: str = "file", pattern: str | None = None) -> list[str]:
    """Non-empty files under ``folder`` whose logical name matches ``pattern`` in full.

    One listing (the ``binaryFile`` source with path and length only: no content is read).
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", "length")
    if name_from == "file":
        name = F.element_at(F.split("path", "/"), -1)
    else:
        name = F.regexp_replace(F.element_at(F.split("path", "/"), -2), "^[^=]*=", "")
    files = files.filter(F.col("length") > 0)
    if pattern:
        files = files.filter(name.rlike(anchored(pattern)))
    return sorted(r["path"] for r in files.select("path").collect())  # file metadata, as any scan's listing


def read_csv_by_header(spark: SparkSession, files: list[str], sep: str = ",", quote: str = '"') -> DataFrame | None:
    """All-string rows of CSV files that each name their own columns.

    Files are grouped by their header line and read with its names, so columns meet by
    name whatever their order; a column that a file lacks is NULL. Files with a line break inside quotes
    are read by ``read_csv_records``. None without files.
    """
    if not files:
        return None
    lines = spark.read.option("lineSep", "\n").text(files).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("nth"), "value", _open_quote("value", quote).alias("odd"))
    head = lines.groupBy("path").agg(F.min(F.struct("block", "nth", "value")).alias("first"), F.max("odd").alias("odd"))
    groups: dict[str, list[str]] = {}
    broken = []
    for r in head.select("path", F.col("first.value").alias("header"), "odd").collect():  # one row per file
        if r["odd"]:
            broken.append(r["path"])
        else:
            groups.setdefault(r["header"].rstrip("\r"), []).append(r["path"])
    out = None
    for header in sorted(groups):
        names = next(csv.reader([header.lstrip("\ufeff")], delimiter=sep, quotechar=quote))
        schema = StructType([StructField(n, StringType()) for n in names])
        part = spark.read.schema(schema).option("header", True).option("sep", sep).option("quote", quote).csv(groups[header])
        part = part.select("*", F.col("_metadata.file_path").alias("__path"))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if broken:
        part = read_csv_records(spark, broken, sep, quote)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def _open_quote(line: str, quote: str):
    """1 where a line has an odd number of quotes."""
    return ((F.length(line) - F.length(F.replace(F.col(line), F.lit(quote), F.lit("")))) % 2).cast("int")


def read_csv_records(spark: SparkSession, files: list[str], sep: str = ",", quote: str = '"') -> DataFrame | None:
    """All-string rows of CSV files whose quoted values may hold line breaks, each file with its own header record.

    Files stay splittable. A line begins inside a quoted value exactly if an odd number of quotes stands before it in its
    file (a doubled quote counts twice), so quotes are summed per split, the sums carried from split to split (one
    row per split) and along the lines of each. A record is the lines from one that begins outside
    quotes up to the next such line, also where a split ends among them; only records of several lines are grouped.
    Columns meet by name; a column that a file lacks is NULL. A record with an open quote at the end of its file
    is that file's last. Adds ``__path``. None without files.
    """
    if not files:
        return None
    where = ["path", "block"]
    lines = spark.read.option("lineSep", "\n").text(files).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("nth"), F.col("value").alias("line"))
    root = scratch_path(spark, "csv-lines")
    lines.withColumn("quotes", _open_quote("line", quote)).write.parquet(root)  # the order of lines is read more than once
    lines = spark.read.parquet(root)
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = lines.groupBy(*where).agg(F.sum("quotes").alias("q")).select(*where, F.coalesce(F.sum("q").over(earlier), F.lit(0)).alias("carried"))
    along = Window.partitionBy(*where).orderBy("nth")
    before = F.coalesce(F.sum("quotes").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.col("carried")
    lines = lines.join(splits, where).withColumn("begins", before % 2 == 0)
    # The first line of a record, as (block, nth); a split that begins inside one takes the last first line before it.
    here = F.struct("block", "nth")
    last = lines.filter("begins").groupBy(*where).agg(F.max(here).alias("last"))
    last = splits.select(*where).join(last, where, "left").select(*where, F.max("last").over(earlier).alias("open"))
    first = F.max(F.when(F.col("begins"), here)).over(along.rowsBetween(Window.unboundedPreceding, 0))
    lines = lines.join(last, where).withColumn("first", F.coalesce(first, F.col("open")))
    lines = lines.withColumn("single", F.col("begins") & (F.col("quotes") == 0))
    one = lines.filter("single").select("path", "first", F.col("line").alias("record"))
    many = lines.filter(~F.col("single")).groupBy("path", "first").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "nth", "line"))), lambda x: x["line"]), "\n").alias("record"))
    records = one.unionByName(many).withColumn("record", F.regexp_replace("record", "\r\\z", ""))
    kept = scratch_path(spark, "csv-records")
    records.filter("record <> ''").write.parquet(kept)
    records = spark.read.parquet(kept)
    heads = records.groupBy("path").agg(F.min(F.struct("first", "record")).alias("h")).select("path", F.col("h.first").alias("head"), F.col("h.record").alias("names"))
    body = records.join(heads, "path").filter(F.col("first") > F.col("head"))
    out = None
    for r in heads.select("names").distinct().collect():  # one row per kind of header
        names = next(csv.reader([r["names"].lstrip("\ufeff")], delimiter=sep, quotechar=quote))
        options = {"sep": sep, "quote": quote, "escape": quote, "mode": "PERMISSIVE", "maxCharsPerColumn": "-1", "lineSep": _NO_BREAK}
        part = body.filter(F.col("names") == r["names"]).select(
            F.from_csv("record", _ddl(names), options).alias("c"), F.col("path").alias("__path"))
        part = part.select("c.*", "__path")
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


#: Records reach the parser one by one; this character never ends one.
_NO_BREAK = "\u0000"


def _ddl(names: list[str]) -> str:
    return ", ".join("`{}` string".format(n.replace("`", "``")) for n in names)


def select_input_files(spark: SparkSession, folder: str, day: str | None, prefix: str = "",
                       sep: str = ",", name_from: str = "file") -> DataFrame:
    """Rows of the non-empty CSV files of one day (name ``<prefix>YYYYMMDD_*.csv``) or of every day.

    The name is matched in full (``x.csv.bak`` does not match) before any file is opened,
    and columns are matched by each file's own header. Adds ``filename``.
    """
    pattern = f"{prefix}{day.replace('-', '')}_.*\\.csv" if day else ".*\\.csv"
    rows = read_csv_by_header(spark, list_files(spark, folder, name_from, pattern), sep)
    if rows is None:
        return spark.createDataFrame([], "filename string")
    part = F.element_at(F.split("__path", "/"), -1 if name_from == "file" else -2)
    return rows.withColumn("filename", file_stem(F.regexp_replace(part, "^[^=]*=", ""))).drop("__path")


def inline_rows(spark: SparkSession, rows: list, schema: StructType | str) -> DataFrame:
    """Small literal rows with an explicit schema (fixtures, route tables)."""
    return spark.createDataFrame(rows, schema=schema)
