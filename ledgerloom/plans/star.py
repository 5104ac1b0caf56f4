"""Star schema: dimensions and facts from flattened clinical records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.keys import KeyFunction, person_token, wide_hash_key
from ..functions.numbers import money
from ..operators.rows import keep_first_by_key

# Encounter class codes of emergency and inpatient stays.
EMERGENCY_CLASSES = ("EMER",)
INPATIENT_CLASSES = ("IMP", "ACUTE", "NONAC")


def date_key(day: Column) -> Column:
    return F.date_format(day, "yyyyMMdd").cast("int")


def build_dim_date(facts: DataFrame, column: str) -> DataFrame:
    days = facts.select(F.col(column).cast("date").alias("full_date")).where(F.col("full_date").isNotNull()).distinct()
    return days.select(
        date_key(F.col("full_date")).alias("date_key"),
        "full_date",
        F.year("full_date").alias("year"),
        F.month("full_date").alias("month"),
        F.date_format("full_date", "MMMM").alias("month_name"),
    )


def build_dim_patient(patients: DataFrame, salt: str, key: KeyFunction = wide_hash_key) -> DataFrame:
    return patients.select(
        key(F.col("fhir_patient_id")).alias("patient_key"),
        person_token(F.col("fhir_patient_id"), salt).alias("patient_token"),
        "gender",
        F.col("state").alias("state_abbr"),
    )


def build_dim_condition(conditions: DataFrame, key: KeyFunction = wide_hash_key) -> DataFrame:
    coded = conditions.where(F.col("snomed_code").isNotNull())
    one_each = keep_first_by_key(
        coded.select("snomed_code", "snomed_display", "category", "fhir_condition_id"),
        ["snomed_code"],
        [F.col("fhir_condition_id")],
    )
    return one_each.select(
        key(F.col("snomed_code")).alias("condition_key"),
        F.col("category").alias("condition_category"),
        "snomed_code",
        "snomed_display",
    )


def build_dim_encounter_type(encounters: DataFrame, key: KeyFunction = wide_hash_key) -> DataFrame:
    kinds = encounters.where(F.col("class_code").isNotNull()).groupBy("class_code").agg(
        F.min("class_display").alias("class_display")
    )
    return kinds.select(
        key(F.col("class_code")).alias("encounter_type_key"),
        F.coalesce("class_display", "class_code").alias("class_display"),
        F.col("class_code").isin(*EMERGENCY_CLASSES).alias("is_emergency"),
        F.col("class_code").isin(*INPATIENT_CLASSES).alias("is_inpatient"),
    )


def build_fact_encounter(encounters: DataFrame, salt: str) -> DataFrame:
    return encounters.select(
        person_token(F.col("fhir_encounter_id"), salt).alias("encounter_token"),
        person_token(F.col("fhir_patient_id"), salt).alias("patient_token"),
        date_key(F.col("start_date").try_cast("date")).alias("date_key"),
        "encounter_type",
        "reason_code",
        F.col("reason_display").alias("reason_description"),
    )


def build_fact_claims(claims: DataFrame, encounters: DataFrame, salt: str, key: KeyFunction = wide_hash_key) -> DataFrame:
    """One row per claim, with the keys of its encounter."""
    visit = encounters.select(
        "fhir_encounter_id", "class_code", "reason_code", F.col("start_date").try_cast("date").alias("service_start")
    )
    joined = claims.join(visit, claims["encounter_id"] == visit["fhir_encounter_id"], "left")
    cost, paid = money(F.col("total_cost")), money(F.col("payment_amount"))
    return joined.select(
        person_token(F.col("encounter_id"), salt).alias("encounter_token"),
        key(F.col("patient_id")).alias("patient_key"),
        key(F.col("reason_code")).alias("condition_key"),
        key(F.col("class_code")).alias("encounter_type_key"),
        date_key(F.col("service_start")).alias("date_key"),
        "service_start",
        cost.alias("total_claim_cost"),
        paid.alias("payer_coverage"),
        money(cost - paid).alias("patient_out_of_pocket"),
    )
