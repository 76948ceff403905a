"""Production-tracking messages: flatten the three nested message types, restrict
them to brand keys, derive subscription and header rows, route raw messages.

Input frames hold parsed messages (``type``, ``commissionNumber``,
``sourceTimestamp``, ``message`` struct) and optionally a ``filename`` column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrum.functions.dates import parse_day, parse_day_of_year, parse_iso_offset
from ferrum.functions.text import message_type
from ferrum.operators.joins import semi_on

BRAND_KEYS = ["commission_number", "ifa_order_key"]

# Sample documents: the message schemas are inferred from these example messages
# (fixed shapes of the three message types).
SAMPLE_CHECKPOINT = (
    '{"type": "CHECKPOINT", "commissionNumber": "000 XXX0000000", "sourceTimestamp": "2023-06-01T10:00:00Z",'
    ' "message": {"ifaOrderKey": "0000000000000", "commissionNumber": "000 XXX0000000", "type": "CHECKPOINT",'
    ' "sourceTimestamp": "2023-06-01T10:00:00Z",'
    ' "elements": [{"checkpointNumber": 1, "timestamp": "2023-06-01T10:00:00Z"}]}}')
SAMPLE_GENERAL_INFORMATION = (
    '{"type": "GENERAL_INFORMATION", "commissionNumber": "000 XXX0000000",'
    ' "sourceTimestamp": "2023-06-01T10:00:00Z",'
    ' "message": {"ifaOrderKey": "0000000000000", "commissionNumber": "000 XXX0000000", "checkpointNumber": 1,'
    ' "reachedCheckpointAt": "2023-06-01T10:00:00Z", "vin": "XXXXXXXXXXXXXXXXX", "orderDate": "2023-06-01T10:00:00Z",'
    ' "brand": "BRAND-V", "model": "X", "modelYear": 2023, "modelGroup": "X", "orderingDealerId": "0",'
    ' "cp8Date": "2023152", "exteriorColorCode": "X", "roofColorCode": "X", "interiorColorCode": "X",'
    ' "sourceTimestamp": "2023-06-01T10:00:00Z"}}')
SAMPLE_PARTS = (
    '{"type": "PARTS", "commissionNumber": "000 XXX0000000", "sourceTimestamp": "2023-06-01T10:00:00Z",'
    ' "message": {"ifaOrderKey": "0000000000000", "commissionNumber": "000 XXX0000000",'
    ' "itemizationDate": "2023-06-01T10:00:00Z", "sourceTimestamp": "2023-06-01T10:00:00Z",'
    ' "parts": [{"family": "X", "number": "0", "origin": "X"}]}}')


def _filename(df: DataFrame) -> Column:
    return F.col("filename") if "filename" in df.columns else F.lit(None).cast("string")


def _header(df: DataFrame, event_ts) -> list[Column]:
    return [
        F.col("type").alias("msg_type"),
        F.col("message.commissionNumber").alias("commission_number"),
        F.col("message.ifaOrderKey").alias("ifa_order_key"),
        parse_iso_offset(F.col("message.sourceTimestamp")).alias("source_timestamp"),
        parse_iso_offset(F.col("sourceTimestamp")).alias("msg_timestamp"),
        F.to_timestamp(F.lit(event_ts)).alias("event_timestamp"),
        _filename(df).alias("filename"),
    ]


def _restrict(df: DataFrame, brand_keys: DataFrame | None) -> DataFrame:
    """Semi join on (commission_number, ifa_order_key) at message level, before any
    explode, so fewer rows reach the shuffle. ``None`` means no restriction."""
    if brand_keys is None:
        return df
    keyed = df.withColumns({"commission_number": F.col("message.commissionNumber"),
                            "ifa_order_key": F.col("message.ifaOrderKey")})
    return semi_on(keyed, brand_keys, BRAND_KEYS).drop(*BRAND_KEYS)


def general_info(df: DataFrame, event_ts: str, brand_keys: DataFrame | None = None) -> DataFrame:
    """GENERAL_INFORMATION messages -> one flat row per message."""
    m = "message."
    return _restrict(df, brand_keys).select(
        *_header(df, event_ts),
        F.col(m + "checkpointNumber").alias("checkpoint_number"),
        parse_iso_offset(F.col(m + "reachedCheckpointAt")).alias("reached_checkpoint_at"),
        F.col(m + "vin").alias("vin"),
        parse_day(F.col(m + "orderDate")).alias("order_date"),
        F.col(m + "brand").alias("brand"),
        F.col(m + "model").alias("model"),
        F.col(m + "modelYear").alias("model_year"),
        F.col(m + "modelGroup").alias("model_group"),
        F.col(m + "orderingDealerId").alias("ordering_dealer_id"),
        F.to_date(parse_day_of_year(F.col(m + "cp8Date"))).alias("cp8_date"),
        F.col(m + "exteriorColorCode").alias("exterior_color_code"),
        F.col(m + "roofColorCode").alias("roof_color_code"),
        F.col(m + "interiorColorCode").alias("interior_color_code"),
    )


def checkpoints(df: DataFrame, event_ts: str, brand_keys: DataFrame | None = None) -> DataFrame:
    """CHECKPOINT messages -> one row per element of ``message.elements``."""
    x = _restrict(df, brand_keys).select(*_header(df, event_ts), F.explode("message.elements").alias("e"))
    return x.select(
        "msg_type", "commission_number", "ifa_order_key",
        F.col("e.checkpointNumber").alias("checkpoint_number"),
        parse_iso_offset(F.col("e.timestamp")).alias("checkpoint_timestamp"),
        "source_timestamp", "msg_timestamp", "event_timestamp", "filename")


def parts(df: DataFrame, event_ts: str, brand_keys: DataFrame | None = None) -> DataFrame:
    """PARTS messages -> one row per element of ``message.parts``."""
    x = _restrict(df, brand_keys).select(
        *_header(df, event_ts),
        parse_day(F.col("message.itemizationDate")).alias("itemization_date"),
        F.explode("message.parts").alias("p"))
    return x.select(
        "msg_type", "commission_number", "ifa_order_key", "itemization_date",
        F.col("p.family").alias("family"), F.col("p.number").alias("number"),
        F.col("p.origin").alias("origin"),
        "source_timestamp", "msg_timestamp", "event_timestamp", "filename")


def brand_keys(general: DataFrame, brands: list[str]) -> DataFrame:
    """``(commission_number, ifa_order_key)`` of vehicles of the selected brands (distinct)."""
    return general.filter(F.col("brand").isin(brands)).select(*BRAND_KEYS).distinct()


def subscription_key(commission_number="commission_number", ifa_order_key="ifa_order_key") -> Column:
    """Deterministic subscription id: the same on subscription and header rows, no join needed."""
    return F.xxhash64(F.col(commission_number), F.col(ifa_order_key))


def subscriptions(general: DataFrame, prefix: str | None = None) -> DataFrame:
    """Subscription rows in the fixed column order; ``msg_type`` comes from the data.

    Subscription start/end are not carried by the messages: typed NULLs.
    ``prefix`` is accepted for call compatibility and not used.
    """
    return general.select(
        subscription_key().alias("index"),
        "event_timestamp", "msg_type", "commission_number",
        F.lit(None).cast("timestamp").alias("start_of_subscription"),
        F.lit(None).cast("timestamp").alias("start_of_unsubscription"),
        "ifa_order_key")


def message_headers(general: DataFrame, prefix: str | None = None) -> DataFrame:
    """Message-header rows in the fixed column order, linked to their subscription."""
    return general.select(
        F.xxhash64("commission_number", "ifa_order_key", "msg_type", "source_timestamp").alias("index"),
        subscription_key().alias("fk_subscription"),
        "event_timestamp", "msg_type", "commission_number", "source_timestamp", "msg_timestamp",
        "ifa_order_key", "filename")


def union_final_partial(partial: DataFrame, final: DataFrame) -> DataFrame:
    """Bag union, final rows listed first (Spark keeps no order across partitions;
    the order holds for a collect of two single-partition inputs only)."""
    return final.unionByName(partial)


def route_messages(df: DataFrame, body: str = "body", received_at: str = "received_at",
                   country: str = "DE") -> DataFrame:
    """Raw queue messages -> type (default ``unknown``) and landing key
    ``country/yyyy-MM-dd/type/yyyy-MM-dd--HH:mm:ss.SSSSSS--type.json``.

    ``received_at`` is the processing time of each message, passed in as data.
    """
    t = message_type(F.col(body))
    ts = F.col(received_at)
    key = F.concat_ws("/", F.lit(country), F.date_format(ts, "yyyy-MM-dd"), t,
                      F.concat(F.date_format(ts, "yyyy-MM-dd--HH:mm:ss.SSSSSS"), F.lit("--"),
                               F.lower(t), F.lit(".json")))
    return df.withColumns({"msg_type": t, "country": F.lit(country),
                           "landing_date": F.date_format(ts, "yyyy-MM-dd"), "landing_key": key})
