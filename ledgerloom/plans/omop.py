"""Flattened clinical records to the common data model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.keys import KeyFunction, hash_mod_key, strip_reference, wide_hash_key
from ..functions.numbers import money
from ..operators.rows import keep_first_by_key

# Concept codes of the common data model.
MALE, FEMALE, UNKNOWN = 8507, 8532, 0
RACES = (("white", 8527), ("black", 8516), ("asian", 8515))
OUTPATIENT_VISIT, EHR_VISIT = 9202, 32035
CLAIM_COST, EHR_CONDITION = 32814, 32020


def gender_concept(gender: Column, legacy: bool = False) -> Column:
    """8507 male, 8532 female, else 0. ``legacy`` repeats the old substring test, where
    every text that contains ``male`` is male, ``female`` included."""
    word = F.lower(F.coalesce(gender, F.lit("")))
    if legacy:
        return F.when(F.contains(word, F.lit("male")), MALE).otherwise(UNKNOWN)
    return F.when(word == "male", MALE).when(word == "female", FEMALE).otherwise(UNKNOWN)


def race_concept(race: Column) -> Column:
    word = F.lower(F.coalesce(race, F.lit("")))
    code = F
    for part, concept in RACES:
        code = code.when(F.contains(word, F.lit(part)), concept)
    return code.otherwise(UNKNOWN)


def key_of(identifier: Column, key: KeyFunction = wide_hash_key) -> Column:
    """The key of a referenced record; ``hash_mod_key`` repeats the old 10^9 keys, which collide as data grow."""
    return key(strip_reference(identifier))


def build_person(patients: DataFrame, legacy_gender: bool = False, key: KeyFunction = wide_hash_key) -> DataFrame:
    return patients.select(
        key_of(F.col("fhir_patient_id"), key).alias("person_id"),
        gender_concept(F.col("gender"), legacy_gender).alias("gender_concept_id"),
        F.col("birth_year").try_cast("int").alias("year_of_birth"),
        race_concept(F.col("race")).alias("race_concept_id"),
        F.lit(0).alias("ethnicity_concept_id"),
        F.col("fhir_patient_id").alias("person_source_value"),
        F.col("gender").alias("gender_source_value"),
        F.col("race").alias("race_source_value"),
        "zip_3digit",
    )


def build_visit_occurrence(encounters: DataFrame, end_date_as_start: bool = False, key: KeyFunction = wide_hash_key) -> DataFrame:
    start = F.col("start_date").try_cast("date")
    end = start if end_date_as_start else F.col("end_date").try_cast("date")
    return encounters.select(
        key_of(F.col("fhir_encounter_id"), key).alias("visit_occurrence_id"),
        key_of(F.col("fhir_patient_id"), key).alias("person_id"),
        F.lit(OUTPATIENT_VISIT).alias("visit_concept_id"),
        start.alias("visit_start_date"),
        end.alias("visit_end_date"),
        F.lit(EHR_VISIT).alias("visit_type_concept_id"),
        F.col("fhir_encounter_id").alias("visit_source_value"),
    )


def build_cost(claims: DataFrame, keep_repeats: bool = False, key: KeyFunction = wide_hash_key) -> DataFrame:
    """One cost row per claim id; ``keep_repeats`` keeps every claim row."""
    if not keep_repeats:
        order = [F.col("created").asc_nulls_last(), *(F.col(c) for c in ("encounter_id", "total_cost", "payment_amount", "status"))]
        claims = keep_first_by_key(claims, ["claim_id"], order)
    charge, paid = money(F.col("total_cost")), money(F.col("payment_amount"))
    return claims.select(
        key_of(F.col("claim_id"), key).alias("cost_id"),
        key_of(F.col("patient_id"), key).alias("person_id"),
        key_of(F.col("encounter_id"), key).alias("cost_event_id"),
        F.lit("Visit").alias("cost_domain_id"),
        F.lit(CLAIM_COST).alias("cost_type_concept_id"),
        charge.alias("total_charge"),
        paid.alias("total_paid"),
        money(charge - paid).alias("paid_by_patient"),
    )


def build_concept(conditions: DataFrame, key: KeyFunction = wide_hash_key, name_length: int | None = None) -> DataFrame:
    """One concept per code; ``name_length`` cuts names for stores that need it."""
    named = conditions.where(F.col("snomed_code").isNotNull() & F.col("snomed_display").isNotNull())
    distinct = keep_first_by_key(
        named.select("snomed_code", "snomed_display", "fhir_condition_id"), ["snomed_code"], [F.col("fhir_condition_id")]
    )
    return distinct.select(
        key(F.col("snomed_code")).alias("concept_id"),
        (F.col("snomed_display") if name_length is None else F.left("snomed_display", F.lit(name_length))).alias("concept_name"),
        F.lit("Condition").alias("domain_id"),
        F.lit("SNOMED").alias("vocabulary_id"),
        F.lit("Clinical Finding").alias("concept_class_id"),
        F.lit("S").alias("standard_concept"),
        F.col("snomed_code").alias("concept_code"),
    )


def build_condition_occurrence(conditions: DataFrame, key: KeyFunction = wide_hash_key) -> DataFrame:
    return conditions.select(
        key_of(F.col("fhir_condition_id"), key).alias("condition_occurrence_id"),
        key_of(F.col("fhir_patient_id"), key).alias("person_id"),
        key(F.col("snomed_code")).alias("condition_concept_id"),
        F.col("onset_date").try_cast("date").alias("condition_start_date"),
        F.lit(EHR_CONDITION).alias("condition_type_concept_id"),
        F.col("snomed_code").alias("condition_source_value"),
    )


def hash_collision_report(identifiers: DataFrame, column: str) -> DataFrame:
    """Per key function: distinct ids, distinct keys, keys shared by several ids, ids involved."""
    ids = identifiers.where(F.col(column).isNotNull()).select(F.col(column).alias("_id")).distinct()
    both = ids.select(F.explode(F.array(*[F.struct(F.lit(name).alias("key_kind"), key(F.col("_id")).alias("_key")) for name, key in (("narrow", hash_mod_key), ("wide", wide_hash_key))])).alias("k"))
    per_key = both.groupBy("k.key_kind", "k._key").agg(F.count(F.lit(1)).alias("_ids"))
    shared = F.col("_ids") > 1
    return per_key.groupBy("key_kind").agg(
        F.sum("_ids").alias("source_ids"),
        F.count(F.lit(1)).alias("hashed_ids"),
        F.count_if(shared).alias("colliding_keys"),
        F.coalesce(F.sum(F.when(shared, F.col("_ids"))), F.lit(0)).alias("colliding_ids"),
    )
