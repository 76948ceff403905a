"""Domain-shaped tables derived from the driver tables.

The catalogue runs the domain operators on the driver's parquet tables through
these projections. Every derivation is a per-row projection (or a bounded group
for nested messages), so its cost grows linearly with the input. The same rules
are written in SQL in ``ferrum.plans.catalogue`` for the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


ISO_Z = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def signals_from_events(events: DataFrame) -> DataFrame:
    """events -> raw signals ``(vin, eventDate, signalName, signalValue)``."""
    return events.select(
        F.col("user_id").cast("string").alias("vin"),
        F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ssXXX").alias("eventDate"),
        F.col("event_type").alias("signalName"),
        F.col("value").alias("signalValue"),
    )


def contracts_from_orders(orders: DataFrame) -> DataFrame:
    """orders -> raw all-string contract rows, one input file per order month.

    Low-priority orders carry an unparseable inception date and pending orders an
    unparseable duration, so the coercing casts are exercised on whole tables.
    """
    return orders.select(
        F.col("o_orderkey").alias("contract_id"),
        F.col("o_custkey").cast("string").alias("vehicleIdentificationNumber"),
        F.col("o_orderpriority").alias("subscriptionVehicleCategory"),
        F.col("o_orderstatus").alias("product"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("not-a-date"))
         .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("inceptionDate"),
        F.date_format(F.date_add(F.to_date("o_orderdate"), 365), "yyyy-MM-dd").alias("contractEndDate"),
        F.when(F.col("o_orderstatus") == "P", F.lit("n/a"))
         .otherwise(F.col("o_totalprice").cast("string")).alias("duration"),
        F.concat(F.date_format("o_orderdate", "yyyyMM"), F.lit("01_contracts.csv")).alias("filename"),
        F.col("o_orderdate").alias("event_timestamp"),
    )


def vehicles_from_orders(orders: DataFrame) -> DataFrame:
    """orders -> tracked vehicles; pending orders have not received a message yet."""
    return orders.select(
        F.col("o_custkey").cast("string").alias("commission_number"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey").cast("string")).alias("ifa_order_key"),
        F.col("o_orderdate").alias("event_timestamp"),
    )


def dealer_countries(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """customer x nation -> ``(commission_number, dealership_country)``.

    ``nation`` has 25 rows by definition of the schema, so broadcasting it is safe.
    """
    return customer.join(F.broadcast(nation), customer.c_nationkey == nation.n_nationkey).select(
        F.col("c_custkey").cast("string").alias("commission_number"),
        F.col("n_name").alias("dealership_country"),
    )


def _brand(priority):
    first = F.substring(priority, 1, 1)
    return (F.when(first == "1", "BRAND-C").when(first == "2", "BRAND-V")
            .when(first == "3", "BRAND-N").otherwise("Other"))


def general_information_messages(orders: DataFrame) -> DataFrame:
    """orders -> GENERAL_INFORMATION messages as JSON text (one per order)."""
    ts = F.date_format("o_orderdate", ISO_Z)
    msg = F.struct(
        F.lpad(F.col("o_custkey").cast("string"), 13, "0").alias("ifaOrderKey"),
        F.col("o_orderkey").cast("string").alias("commissionNumber"),
        F.lit(8).cast("bigint").alias("checkpointNumber"),
        ts.alias("reachedCheckpointAt"),
        F.concat(F.lit("VIN"), F.lpad(F.col("o_custkey").cast("string"), 14, "0")).alias("vin"),
        F.date_format("o_orderdate", ISO_Z).alias("orderDate"),
        _brand(F.col("o_orderpriority")).alias("brand"),
        F.col("o_orderstatus").alias("model"),
        F.year("o_orderdate").cast("bigint").alias("modelYear"),
        F.col("o_orderpriority").alias("modelGroup"),
        F.col("o_custkey").cast("string").alias("orderingDealerId"),
        F.date_format("o_orderdate", "yyyyDDD").alias("cp8Date"),
        F.lit("2T2T").alias("exteriorColorCode"),
        F.lit("2T").alias("roofColorCode"),
        F.lit("TO").alias("interiorColorCode"),
        ts.alias("sourceTimestamp"),
    )
    body = F.to_json(F.struct(
        F.lit("GENERAL_INFORMATION").alias("type"),
        F.col("o_orderkey").cast("string").alias("commissionNumber"),
        ts.alias("sourceTimestamp"),
        msg.alias("message"),
    ))
    return orders.select(body.alias("body"), F.lit("general_information.json").alias("filename"))


def checkpoint_messages(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """orders + lineitem -> CHECKPOINT messages, one per order; each line item is a checkpoint element, however
    many there are (a message is one document, so its elements are one row)."""
    elems = (lineitem.select("l_orderkey", "l_linenumber", "l_shipdate").groupBy("l_orderkey")
             .agg(F.collect_list(F.struct(
                 F.col("l_linenumber").cast("bigint").alias("checkpointNumber"),
                 F.date_format("l_shipdate", ISO_Z).alias("timestamp"))).alias("elements")))
    o = orders.select("o_orderkey", "o_custkey", "o_orderdate")
    j = o.join(elems, o.o_orderkey == elems.l_orderkey)
    ts = F.date_format("o_orderdate", ISO_Z)
    body = F.to_json(F.struct(
        F.lit("CHECKPOINT").alias("type"),
        F.col("o_orderkey").cast("string").alias("commissionNumber"),
        ts.alias("sourceTimestamp"),
        F.struct(
            F.lpad(F.col("o_custkey").cast("string"), 13, "0").alias("ifaOrderKey"),
            F.col("o_orderkey").cast("string").alias("commissionNumber"),
            F.lit("CHECKPOINT").alias("type"),
            ts.alias("sourceTimestamp"),
            F.col("elements"),
        ).alias("message"),
    ))
    return j.select(body.alias("body"), F.lit("checkpoint.json").alias("filename"))


def parts_messages(orders: DataFrame, lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """orders + lineitem + part -> PARTS messages, one per order; each line item's part is one element."""
    li = lineitem.select("l_orderkey", "l_linenumber", "l_partkey").join(
        part.select("p_partkey", "p_type", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    elems = (li.groupBy("l_orderkey")
             .agg(F.collect_list(F.struct(
                 F.col("p_type").alias("family"),
                 F.concat_ws("-", F.col("p_partkey").cast("string"),
                             F.col("l_linenumber").cast("string")).alias("number"),
                 F.col("p_brand").alias("origin"))).alias("parts")))
    o = orders.select("o_orderkey", "o_custkey", "o_orderdate")
    j = o.join(elems, o.o_orderkey == elems.l_orderkey)
    ts = F.date_format("o_orderdate", ISO_Z)
    body = F.to_json(F.struct(
        F.lit("PARTS").alias("type"),
        F.col("o_orderkey").cast("string").alias("commissionNumber"),
        ts.alias("sourceTimestamp"),
        F.struct(
            F.lpad(F.col("o_custkey").cast("string"), 13, "0").alias("ifaOrderKey"),
            F.col("o_orderkey").cast("string").alias("commissionNumber"),
            F.date_format("o_orderdate", ISO_Z).alias("itemizationDate"),
            ts.alias("sourceTimestamp"),
            F.col("parts"),
        ).alias("message"),
    ))
    return j.select(body.alias("body"), F.lit("parts.json").alias("filename"))


def queue_messages(events: DataFrame) -> DataFrame:
    """events -> queue message bodies; signup events carry no ``type`` field."""
    typed = F.to_json(F.struct(
        F.upper("event_type").alias("type"), F.col("event_id").alias("event_id"),
        F.col("user_id").alias("user_id"), F.col("value").alias("value")))
    untyped = F.to_json(F.struct(
        F.col("event_id").alias("event_id"), F.col("user_id").alias("user_id"),
        F.col("value").alias("value")))
    return events.select(
        "event_id", F.col("ts").cast("timestamp").alias("received_at"),
        F.when(F.col("event_type") == "signup", untyped).otherwise(typed).alias("body"))


# Job-ledger stand-in. Status thresholds are fixed parameters of the stand-in.
LEDGER_BLOCK = 100


def ledger_from_events(events: DataFrame) -> DataFrame:
    """events -> job ledger: every event is one attempt of a load job.

    kpi = user, from_id = the 100-id block of the event, attempts of the same
    (kpi, from_id) are numbered by event id (retries 0, 1, ...).
    """
    status = (F.when((F.col("event_type") == "view") & (F.col("value") < 3), "RUNNING")
              .when((F.col("event_type") == "error") & (F.col("value") < 10), "FAILED")
              .otherwise("SUCCESS"))
    from_id = (F.floor(F.col("event_id") / LEDGER_BLOCK) * LEDGER_BLOCK).cast("bigint")
    base = events.select(
        F.col("user_id").cast("string").alias("kpi"), from_id.alias("from_id"),
        F.col("event_id"), status.alias("status"),
        F.col("ts").cast("timestamp").alias("created_at"), F.col("event_type").alias("details"))
    w = Window.partitionBy("kpi", "from_id").orderBy("event_id")
    return base.select(
        "kpi", "from_id",
        F.when(F.col("status") == "SUCCESS", F.col("from_id") + (LEDGER_BLOCK - 1)).alias("to_id"),
        "status", "created_at",
        F.when(F.col("status") != "RUNNING", F.col("created_at") + F.expr("INTERVAL 5 MINUTES"))
         .alias("finished_at"),
        (F.row_number().over(w) - 1).cast("int").alias("retries"),
        "details",
    )


def kpi_registry(events: DataFrame, customer: DataFrame) -> DataFrame:
    """All KPIs that should be loaded: every user seen in events plus every
    AUTOMOBILE customer (those have no ledger rows yet: first run)."""
    return (events.select(F.col("user_id").cast("string").alias("kpi"))
            .unionByName(customer.filter(F.col("c_mktsegment") == "AUTOMOBILE")
                         .select(F.col("c_custkey").cast("string").alias("kpi")))
            .distinct())
