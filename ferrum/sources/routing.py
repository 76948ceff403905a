"""Routed bulk loads: storage key -> target table and reader options.

Landed files are listed once and their keys resolved against the route table in
Spark. Each route is loaded by reading its key prefix, with all dated folders below
it, with its own reader options in one distributed read. Keys that no route takes
are reported with their number of files.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROUTE_SCHEMA = ("root string, sub string, target_table string, format string, sep string, header boolean, "
                "quote string, compression string, replace_all boolean")

# Route kinds: ``sub`` set -> two-level route (second key segment selects the
# entry); ``sub = '*'`` -> the second key segment *is* the target table; ``sub``
# NULL -> flat route keyed by the first segment only.
# A route of each kind and one per format; deployments pass their own.
EXAMPLE_ROUTES = [
    ("clicks", None, "page_clicks", "csv", ",", True, None, None, False),
    ("meters", "hourly", "meter_hourly", "csv", ",", True, None, None, False),
    ("meters", "daily", "meter_daily", "csv", ",", True, None, None, False),
    ("sensors", "raw", "sensor_raw", "csv", ",", True, None, None, False),
    ("feeds", "*", None, "csv", ",", True, None, None, False),
    ("reviews", None, "reviews", "csv", ",", True, '"', None, False),
    ("catalog", None, "catalog_items", "parquet", None, None, None, None, True),
    ("stations", None, "stations", "csv", ",", True, None, "gzip", True),
    ("vendors", None, "vendor_list", "csv", "|", True, None, "gzip", True),
]


def route_table(spark: SparkSession, routes: list | None = None) -> DataFrame:
    return spark.createDataFrame(routes or EXAMPLE_ROUTES, ROUTE_SCHEMA)


def resolve_routes(keys: DataFrame, routes: DataFrame, key_col: str = "key") -> DataFrame:
    """Attach the route of every storage key; unknown keys get status 'unrouted'.

    Two-level roots need a matching second segment (an unknown second segment is
    unrouted, like an unknown root). Output adds ``root, sub_key, target_table,
    format, sep, header, quote, compression, replace_all, status``.
    """
    parts = F.split(F.col(key_col), "/")
    k = keys.withColumns({"__root": F.element_at(parts, 1), "__sub": F.try_element_at(parts, F.lit(2))})
    r = routes.select(*[F.col(c).alias(f"__r_{c}") for c in routes.columns])
    cond = (F.col("__root") == F.col("__r_root")) & (
        F.col("__r_sub").isNull() | (F.col("__r_sub") == "*") | (F.col("__r_sub") == F.col("__sub")))
    j = k.join(r, cond, "left")
    target = F.when(F.col("__r_sub") == "*", F.col("__sub")).otherwise(F.col("__r_target_table"))
    out = j.select(
        *keys.columns, F.col("__root").alias("root"), F.col("__sub").alias("sub_key"), target.alias("target_table"),
        *[F.col(f"__r_{c}").alias(c) for c in ("format", "sep", "header", "quote", "compression", "replace_all")])
    return out.withColumn("status", F.when(F.col("target_table").isNotNull(), "routed").otherwise("unrouted"))


def reader_for(spark: SparkSession, route: dict):
    """DataFrameReader with a route's format options (gzip is transparent by extension)."""
    r = spark.read.format(route["format"])
    if route["format"] == "csv":
        r = r.option("header", bool(route.get("header"))).option("sep", route.get("sep") or ",")
        # Without a quote character, quotes are data; inside quotes a quote is doubled.
        r = r.option("quote", route.get("quote") or "").option("escape", route.get("quote") or "")
        r = r.option("mode", "PERMISSIVE").option("encoding", "UTF-8")
    return r


def landed_files(spark: SparkSession, base_path: str) -> DataFrame:
    """(key, length, modified) of every non-empty file under ``base_path``, keys relative to it.

    One listing through the ``binaryFile`` source without contents, which are never read.
    """
    base = re.escape(base_path.rstrip("/").split(":", 1)[-1])
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(base_path).select("path", "length", "modificationTime")
    return files.filter(F.col("length") > 0).select(
        F.regexp_extract("path", base + "/(.*)$", 1).alias("key"), "length", F.col("modificationTime").alias("modified"))


def landed_keys(spark: SparkSession, base_path: str) -> DataFrame:
    """(key, length) of every non-empty file under ``base_path``, keys relative to it."""
    return landed_files(spark, base_path).select("key", "length")


def unrouted(keys: DataFrame, routes: DataFrame) -> DataFrame:
    """(prefix, n_files) of the keys that no route takes: unknown root or unknown second segment."""
    left = resolve_routes(keys, routes).filter(F.col("status") == "unrouted")
    return left.groupBy(F.concat_ws("/", "root", F.when(F.size(F.split("key", "/")) > 2, F.col("sub_key"))).alias("prefix")).agg(
        F.count(F.lit(1)).alias("n_files"))


def load_routes(spark: SparkSession, base_path: str, routes: DataFrame) -> list[tuple[dict, DataFrame]]:
    """One reader per route (and per target of a wildcard route) over its key prefix
    ``base/root[/sub]/``, with every folder below it (``root[/sub]/YYYY/MM/DD/file``).

    Only prefixes that hold files are read. Returns ``[(route, frame)]``;
    ``route["target_table"]`` is always set and the frame has ``target_table`` and
    ``source_key`` columns.
    """
    found = resolve_routes(landed_keys(spark, base_path), routes).filter(F.col("status") == "routed")
    present = {(r["root"], r["target_table"]) for r in found.select("root", "target_table").distinct().collect()}
    out = []
    for row in routes.collect():  # configuration rows only
        route = row.asDict()
        root, sub = route["root"], route["sub"]
        targets = sorted(t for r, t in present if r == root) if sub == "*" else [route["target_table"]]
        for target in targets:
            if (root, target) not in present:
                continue
            folder = target if sub == "*" else sub
            df = reader_for(spark, route).option("recursiveFileLookup", True).load("/".join(filter(None, [base_path.rstrip("/"), root, folder])))
            rel = F.regexp_extract(F.col("_metadata.file_path"), f"{re.escape(root)}/.*$", 0)
            out.append((dict(route, target_table=target), df.withColumns({"target_table": F.lit(target), "source_key": rel})))
    return out


LOAD_RESULT_SCHEMA = "target_table string, action string, n_rows long, status string, error string"


def load_into_tables(spark: SparkSession, loaded: list[tuple[dict, DataFrame]], database: str, tables_root: str) -> DataFrame:
    """Load every routed frame into its table of ``database``, each as its own unit: replace-all
    routes commit a new version, the others append. Row counts are observed during the write;
    a failing route is reported with its whole error text and the others still load."""
    from pyspark.sql import Observation

    from ferrum.sinks.writers import append_to_table, overwrite_all

    results = []
    for i, (route, df) in enumerate(loaded):
        target = route["target_table"]
        action = "replace_all" if route["replace_all"] else "append"
        obs = Observation(f"load_{i}_{re.sub('[^A-Za-z0-9_]', '_', target)}")
        rows = df.drop("target_table", "source_key").observe(obs, F.count(F.lit(1)).alias("n"))
        path = f"{tables_root.rstrip('/')}/{target}"
        try:
            if action == "replace_all":
                overwrite_all(spark, f"{database}.{target}", rows, path)
            else:
                append_to_table(rows, f"{database}.{target}", path)
            results.append((target, action, int(obs.get["n"]), "loaded", None))
        except Exception as e:  # noqa: BLE001 - reported per route, like a per-file transaction
            results.append((target, action, 0, "failed", str(e)))
    return spark.createDataFrame(results, LOAD_RESULT_SCHEMA)
