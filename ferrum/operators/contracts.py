"""Contract-file normalisation: renames, coercing casts, load time, source file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrum.functions.dates import parse_timestamp
from ferrum.sources.files import require_columns

# The columns of a contract file and of the typed table.
RAW_CONTRACT_COLUMNS = [
    "vehicleIdentificationNumber", "subscriptionVehicleCategory", "product",
    "inceptionDate", "contractEndDate", "duration",
]
TYPED_CONTRACT_COLUMNS = [
    "vehicle_identification_number", "subscription_vehicle_category", "product",
    "inception_date", "contract_end_date", "duration", "event_timestamp", "filename",
]


def typed_contracts(raw: DataFrame, as_of: str, filename=None) -> DataFrame:
    """All-string contract rows -> typed rows in the fixed output order.

    Dates and the duration are coerced: text that does not parse becomes NULL.
    ``event_timestamp`` is the load time ``as_of`` truncated to the second;
    ``filename`` is a literal, or the ``filename`` column when ``None``.
    """
    needed = RAW_CONTRACT_COLUMNS + (["filename"] if filename is None else [])
    df = require_columns(raw, needed)
    fname = F.col("filename") if filename is None else F.lit(filename)
    return df.select(
        F.col("vehicleIdentificationNumber").alias("vehicle_identification_number"),
        F.col("subscriptionVehicleCategory").alias("subscription_vehicle_category"),
        F.col("product"),
        parse_timestamp("inceptionDate").alias("inception_date"),
        parse_timestamp("contractEndDate").alias("contract_end_date"),
        F.col("duration").try_cast("double").alias("duration"),
        F.date_trunc("second", F.to_timestamp(F.lit(as_of))).alias("event_timestamp"),
        fname.alias("filename"),
    )
