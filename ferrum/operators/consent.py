"""Consent checks: which contracts may be kept, and the vehicle counts around them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrum.functions.dates import same_day
from ferrum.operators.contracts import RAW_CONTRACT_COLUMNS
from ferrum.operators.joins import filtered_join_chain, is_in, not_in

def consent_vehicles(user_mgmt: DataFrame, consent_document: DataFrame, customer: DataFrame, *,
                     client_id: str, role: str = "PRIMARY") -> DataFrame:
    """Vehicles whose user has a latest consent document and is not deleted.

    Three-way inner join on the user's id (bag semantics: a vehicle appears once
    per matching document/customer row), with the four filters applied to their
    own tables before joining. Returns ``(vehicle_vin)``.
    """
    um = user_mgmt.filter((F.col("permission_userrole") == role)
                          & F.col("client_id_array").contains(client_id))
    out = filtered_join_chain(
        um, None,
        [(consent_document.select("cust_id", "is_latest").withColumnRenamed("cust_id", "doc_cust_id"),
          "aopuser_ssoid", "doc_cust_id", F.col("is_latest") == 1),
         (customer.select("cust_id", "is_deleted_flag"),
          "aopuser_ssoid", "cust_id", F.col("is_deleted_flag") == 0)])
    return out.select("vehicle_vin")


def filter_by_consent(contracts: DataFrame, consent: DataFrame, *,
                      contract_vin: str = "vehicleIdentificationNumber", consent_vin: str = "vehicle_vin",
                      columns: list[str] | None = None) -> DataFrame:
    """Contracts of consenting vehicles (inner join; duplicates in ``consent`` multiply rows).

    NULL vehicle ids never match (SQL semantics). An empty result is an empty
    frame with the projected schema.
    """
    cols = columns or RAW_CONTRACT_COLUMNS
    c = consent.select(F.col(consent_vin).alias("__consent_vin"))
    return contracts.join(c, F.col(contract_vin) == F.col("__consent_vin"), "inner").select(*cols)


def contracts_without_consent(contracts: DataFrame, consent: DataFrame, *,
                              contract_vin: str = "vehicle_identification_number",
                              consent_vin: str = "vehicle_vin") -> DataFrame:
    """Stored contracts whose vehicle is ``NOT IN`` the consent list (SQL NULL rules)."""
    return not_in(contracts, consent, contract_vin, consent_vin)


def _split_by_day(contracts: DataFrame, ts: str, as_of: str):
    day = same_day(F.col(ts), F.to_timestamp(F.lit(as_of)))
    return contracts.filter(day), contracts.filter(~day)


def newly_added_vehicles(contracts: DataFrame, as_of: str, *,
                         vin: str = "vehicle_identification_number", ts: str = "event_timestamp") -> DataFrame:
    """Distinct vehicles loaded on ``as_of``'s day that were never loaded on another day."""
    today, other = _split_by_day(contracts, ts, as_of)
    return not_in(today.select(vin), other.select(vin), vin).distinct()


def existing_vehicles(contracts: DataFrame, as_of: str, *,
                      vin: str = "vehicle_identification_number", ts: str = "event_timestamp") -> DataFrame:
    """Distinct vehicles loaded on ``as_of``'s day that were also loaded on another day."""
    today, other = _split_by_day(contracts, ts, as_of)
    return is_in(today.select(vin), other.select(vin), vin).distinct()


def file_kpis(contracts: DataFrame, consent: DataFrame, *, file_col: str = "filename",
              vin: str = "vehicleIdentificationNumber", consent_vin: str = "vehicle_vin") -> DataFrame:
    """Per input file: contract rows, distinct vehicles, distinct consenting vehicles
    in total, distinct vehicles of the file with consent, and without.

    Contracts are first counted per (file, vehicle), then the distinct consent set is
    left-joined to those pairs as a flag and the pairs are counted per file: no distinct
    aggregate expands the rows. The consent total is a scalar subquery of the same plan.
    """
    cset = consent.select(F.col(consent_vin).alias("__cv")).distinct()
    per_vin = contracts.groupBy(file_col, F.col(vin).alias("__vin")).agg(F.count(F.lit(1)).alias("__rows"))
    flagged = per_vin.join(cset.withColumn("__has", F.lit(1)), F.col("__vin") == F.col("__cv"), "left")
    per_file = flagged.groupBy(file_col).agg(
        F.sum("__rows").alias("n_contracts"), F.count("__vin").alias("n_unique_vins"),
        F.count("__has").alias("n_vins_with_consent"))
    total = cset.agg(F.count(F.lit(1))).scalar()
    return per_file.select(
        file_col, "n_contracts", "n_unique_vins", total.cast("long").alias("n_consent_total"),
        "n_vins_with_consent",
        (F.col("n_unique_vins") - F.col("n_vins_with_consent")).alias("n_vins_without_consent"),
    )


def stored_kpis(contracts: DataFrame, consent: DataFrame, as_of: str, *, vin: str = "vehicle_identification_number",
                ts: str = "event_timestamp", consent_vin: str = "vehicle_vin") -> DataFrame:
    """One row over the stored contracts: contract rows without consent, and the distinct vehicles of
    ``as_of``'s day that were never loaded on another day, and that were."""
    refused = contracts_without_consent(contracts, consent, contract_vin=vin, consent_vin=consent_vin)
    return refused.agg(F.count(F.lit(1)).alias("n_refused")).select(
        "n_refused", newly_added_vehicles(contracts, as_of, vin=vin, ts=ts).agg(F.count(F.lit(1))).scalar().alias("n_new"),
        existing_vehicles(contracts, as_of, vin=vin, ts=ts).agg(F.count(F.lit(1))).scalar().alias("n_known"))
