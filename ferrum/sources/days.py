"""Day-parameterised pulls: which wanted days have a usable landed document."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrum.functions.dates import inclusive_days, trailing_days


def wanted_days(spark, from_day: str | None = None, to_day: str | None = None,
                days: int | None = None, as_of: str | None = None) -> DataFrame:
    """The day interval as a one-column frame ``day`` (ascending).

    Either both ends (inclusive; a reversed range is empty) or the last ``days``
    days ending the day before ``as_of`` (at least one day). No argument -> error.
    """
    if from_day and to_day:
        arr = inclusive_days(F.lit(from_day), F.lit(to_day), reversed_mode="empty")
    elif days:
        if as_of is None:
            raise ValueError("a trailing interval needs an explicit as_of")
        arr = trailing_days(F.lit(as_of), days)
    else:
        raise ValueError("need from_day and to_day, or days")
    return spark.range(1).select(F.explode(arr).alias("day"))


def day_pull_status(wanted: DataFrame, documents: DataFrame, *, day_col: str = "day",
                    clients_col: str = "n_clients",
                    processor: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Status of every wanted day: no document -> 'error'; a document with no
    clients -> 'empty' (skipped); otherwise 'loaded', with ``processor`` applied
    to the loaded days only (``DataFrame.transform``).

    ``documents`` has one row per landed day with either the client list itself
    (an array column ``clients``) or its size (``clients_col``).
    """
    n = F.size(F.col("clients")) if "clients" in documents.columns else F.col(clients_col)
    j = wanted.join(documents.select(F.col(day_col).alias("day"), n.alias("n_clients")), "day", "left")
    status = (F.when(F.col("n_clients").isNull(), "error").when(F.col("n_clients") == 0, "empty")
              .otherwise("loaded"))
    out = j.withColumn("status", status)
    if processor is None:
        return out
    loaded = out.filter(F.col("status") == "loaded").transform(processor)
    rest = out.filter(F.col("status") != "loaded")
    return loaded.unionByName(rest, allowMissingColumns=True)


DAY_DOCUMENT = "(\\d{4}-\\d{2}-\\d{2})[^/]*\\.json$"


def read_day_documents(spark: SparkSession, path: str, pattern: str = DAY_DOCUMENT) -> DataFrame:
    """One row (day, document) per landed file of a day; ``document`` is the whole JSON document as a variant, NULL where it
    is empty or does not parse. The day is the pattern's group in the file's path."""
    text = spark.read.option("wholetext", True).option("recursiveFileLookup", True).text(path)
    day = F.to_date(F.nullif(F.regexp_extract(F.col("_metadata.file_path"), pattern, 1), F.lit("")))
    return text.select(day.alias("day"), F.try_parse_json("value").alias("document")).filter("day IS NOT NULL")


def day_documents(wanted: DataFrame, documents: DataFrame) -> DataFrame:
    """(day, status, n_clients, message, clients) of every wanted day, from its nested document.

    A document is an object, or a list whose first element counts. Without a document, with an empty one or with one
    that has an ``error`` the day is ``error`` and ``message`` says what came back; without
    ``clients`` in it the day is ``empty``; else ``loaded`` with ``clients``, an array of variants.
    Several documents of one day: the greatest text counts.
    """
    one = documents.groupBy("day").agg(F.max(F.to_json("document")).alias("text"))
    j = wanted.join(one, "day", "left").withColumn("root", F.try_parse_json("text"))
    get = lambda at, kind: F.try_variant_get("root", at, kind)
    is_list = F.substring("text", 1, 1) == "["
    j = j.withColumn("body", F.when(is_list, get("$[0]", "variant")).otherwise(F.col("root")))
    error = F.try_variant_get("body", "$.error", "variant")
    said = F.to_json(error)
    # Falsy errors (null, empty, 0, false) are none, and only an object has one.
    failed = ~is_list & said.isNotNull() & ~said.isin("null", '""', "0", "false", "[]", "{}")
    clients = F.try_variant_get("body", "$.clients", "array<variant>")
    bad = F.col("text").isNull() | F.col("text").isin("[]", "{}", "null", '""') | failed
    status = F.when(bad, "error").when(F.coalesce(F.size(clients), F.lit(0)) < 1, "empty").otherwise("loaded")
    out = j.select("day", status.alias("status"), clients.alias("clients"), F.when(bad, F.coalesce(F.col("text"), F.lit(""))).alias("message"))
    return out.select("day", "status", F.when(F.col("status") != "error", F.coalesce(F.size("clients"), F.lit(0))).cast("long").alias("n_clients"),
                      "message", F.when(F.col("status") == "loaded", F.col("clients")).alias("clients"))


def client_records(days: DataFrame, fields: dict[str, str], processor: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The clients of the loaded days, one row each: ``day`` and ``fields`` ({column: "$.path type"}), then ``processor``
    on these records. A field that a client lacks, or has in another type, is NULL."""
    each = days.filter(F.col("status") == "loaded").select("day", F.explode("clients").alias("client"))
    cols = [F.try_variant_get("client", spec.split()[0], spec.split(None, 1)[1]).alias(name) for name, spec in fields.items()]
    rows = each.select("day", *cols)
    return rows.transform(processor) if processor else rows
