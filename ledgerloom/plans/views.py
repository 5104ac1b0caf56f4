"""Patient summary, high-cost patients, readmissions, conditions, and their measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.dates import readmit_window_label
from ..functions.numbers import MONEY, money, ratio_pct, round_half_up, safe_ratio
from ..operators.order_stats import exact_percentiles
from ..operators.skew import heavy_key_joins
from ..operators.ranges import later_within_days, pairs_within_days
from ..session import settled

# Labels of the cost categories.
HIGH_COST, STANDARD = "High Cost (Top 10%)", "Standard"
READMIT_DAYS = 30
HIGH_COST_POINT = 0.9


def _sum_money(column: str) -> Column:
    return money(F.sum(F.coalesce(F.col(column), F.lit(0).cast(MONEY))))


def patient_summary(person: DataFrame, visit: DataFrame, cost: DataFrame) -> DataFrame:
    """One row per person; both facts are reduced to one row per person before they join."""
    visits = visit.groupBy("person_id").agg(F.count("visit_occurrence_id").alias("total_encounters"))
    costs = cost.groupBy("person_id").agg(
        F.count("cost_id").alias("total_claims"),
        _sum_money("total_charge").alias("total_spend"),
        _sum_money("total_paid").alias("total_payer"),
        _sum_money("paid_by_patient").alias("total_oop"),
    )
    zero, none = F.lit(0).cast("bigint"), F.lit(0).cast(MONEY)
    return (
        person.join(visits, "person_id", "left")
        .join(costs, "person_id", "left")
        .select(
            F.col("person_id").alias("patient_token"),
            F.col("gender_source_value").alias("gender"),
            F.col("year_of_birth").alias("birth_year"),
            F.col("race_source_value").alias("race"),
            "zip_3digit",
            F.coalesce("total_encounters", zero).alias("total_encounters"),
            F.coalesce("total_claims", zero).alias("total_claims"),
            *[F.coalesce(c, none).alias(c) for c in ("total_spend", "total_payer", "total_oop")],
        )
    )


def patient_totals(person: DataFrame, visit: DataFrame, cost: DataFrame) -> DataFrame:
    """Claims and money per person over the visits they had.

    Summed per person and claim id first: that counts distinct ids, and a person with
    very many claims is spread over them.
    """
    seen = visit.select("visit_occurrence_id", "person_id").join(person.select("person_id"), "person_id", "left_semi")
    charged = cost.where(F.col("total_charge").isNotNull()).drop("person_id")
    per_claim = (
        charged.join(seen, charged["cost_event_id"] == seen["visit_occurrence_id"])
        .groupBy("person_id", "cost_id")
        .agg(
            F.sum("total_charge").alias("total_spend"),
            F.sum("total_paid").alias("total_payer"),
            F.sum("paid_by_patient").alias("total_oop"),
        )
    )
    return per_claim.groupBy("person_id").agg(
        F.count("cost_id").alias("claim_count"),
        *[money(F.sum(c)).alias(c) for c in ("total_spend", "total_payer", "total_oop")],
    )


def spend_threshold(totals: DataFrame, point: float = HIGH_COST_POINT) -> DataFrame:
    """One row: the interpolated percentile of spend per patient."""
    return exact_percentiles(totals, F.col("total_spend"), {"threshold": point})


def high_cost_patients(person: DataFrame, visit: DataFrame, cost: DataFrame) -> DataFrame:
    # The totals rest on the large joins and are needed for the limit and for the rows.
    totals = settled(patient_totals(person, visit, cost))
    threshold = spend_threshold(totals).scalar()
    return totals.join(person, "person_id").select(
        F.col("person_id").alias("patient_token"),
        F.col("gender_source_value").alias("gender"),
        F.col("year_of_birth").alias("birth_year"),
        F.col("race_source_value").alias("race"),
        "zip_3digit",
        "claim_count",
        "total_spend",
        F.col("total_payer").alias("total_payer_covered"),
        F.col("total_oop").alias("total_out_of_pocket"),
        ratio_pct(F.col("total_oop"), F.col("total_spend")).alias("patient_burden_pct"),
        F.when(F.col("total_spend").cast("double") >= threshold, HIGH_COST).otherwise(STANDARD).alias("cost_category"),
    )


def readmissions_30d(person: DataFrame, visit: DataFrame) -> DataFrame:
    """Every later visit that starts 1 to 30 days after a discharge, per patient."""
    started = visit.where(F.col("visit_start_date").isNotNull())
    first = started.select(
        "person_id",
        F.col("visit_occurrence_id").alias("first_encounter"),
        F.col("visit_start_date").alias("first_date"),
        F.col("visit_end_date").alias("discharge_date"),
    )
    later = started.select(
        "person_id",
        F.col("visit_occurrence_id").alias("readmit_encounter"),
        F.col("visit_start_date").alias("readmit_date"),
    )
    pairs = pairs_within_days(first, later, "person_id", "discharge_date", "readmit_date", READMIT_DAYS).where(
        F.col("first_encounter") != F.col("readmit_encounter")
    )
    people = person.select("person_id", F.col("gender_source_value").alias("gender"), "zip_3digit")
    return pairs.join(people, "person_id").select(
        F.col("person_id").alias("patient_token"),
        "first_encounter",
        "readmit_encounter",
        "first_date",
        "readmit_date",
        F.col("days_between").cast("int").alias("days_between"),
        F.year("first_date").alias("first_year"),
        F.month("first_date").alias("first_month"),
        "gender",
        "zip_3digit",
        readmit_window_label(F.col("days_between")).alias("readmit_window"),
    )


def readmission_counts(visit: DataFrame) -> DataFrame:
    """``person_id, readmissions``: how many pairs the readmission view has per person.

    Counted from starts and discharges per calendar day, without forming the pairs.
    """
    started = visit.where(F.col("visit_start_date").isNotNull())
    zero, one = F.lit(0), F.lit(1)
    self_gap = F.datediff("visit_start_date", "visit_end_date")
    own = ((self_gap > 0) & (self_gap <= READMIT_DAYS)).cast("int")
    starts = started.select(
        "person_id", F.col("visit_start_date").alias("day"), one.alias("starts"), zero.alias("ends"), zero.alias("own")
    )
    ends = started.where(F.col("visit_end_date").isNotNull()).select(
        "person_id", F.col("visit_end_date").alias("day"), zero.alias("starts"), one.alias("ends"), own.alias("own")
    )
    per_day = starts.unionByName(ends).groupBy("person_id", "day").agg(
        F.sum("starts").alias("starts"), F.sum("ends").alias("ends"), F.sum("own").alias("own")
    )
    ahead = later_within_days(per_day, "person_id", "day", READMIT_DAYS, {"_later": F.sum("starts")})
    pairs = F.col("ends") * F.coalesce("_later", F.lit(0)) - F.col("own")
    return ahead.groupBy("person_id").agg(F.sum(pairs).cast("bigint").alias("readmissions"))


def next_readmission(visit: DataFrame) -> DataFrame:
    """Each visit with the patient's next one, where that starts 1 to 30 days after discharge.

    Next by start date, then id. Within a day the next id answers; for the last visit
    of a day it is the first visit of the patient's next day.
    """
    started = visit.where(F.col("visit_start_date").isNotNull()).select(
        "person_id", "visit_occurrence_id", "visit_start_date", "visit_end_date"
    )
    same_day = W.partitionBy("person_id", "visit_start_date").orderBy("visit_occurrence_id")
    days = started.groupBy("person_id", "visit_start_date").agg(F.min("visit_occurrence_id").alias("_first"))
    by_day = W.partitionBy("person_id").orderBy("visit_start_date")
    following = days.select(
        "person_id",
        "visit_start_date",
        F.lead("_first").over(by_day).alias("_next_id"),
        F.lead("visit_start_date").over(by_day).alias("_next_day"),
    )
    with_next = started.withColumn("_same", F.lead("visit_occurrence_id").over(same_day)).join(
        following, ["person_id", "visit_start_date"]
    )
    next_day = F.when(F.col("_same").isNotNull(), F.col("visit_start_date")).otherwise(F.col("_next_day"))
    found = with_next.select(
        F.col("person_id").alias("patient_token"),
        F.col("visit_occurrence_id").alias("first_encounter"),
        F.coalesce("_same", "_next_id").alias("readmit_encounter"),
        F.datediff(next_day, F.col("visit_end_date")).alias("days_between"),
    )
    return found.where(F.col("days_between").between(1, READMIT_DAYS))


def claims_with_conditions(condition: DataFrame, person: DataFrame, concept: DataFrame) -> DataFrame:
    """Every condition with its person and concept; frequent persons and concepts are joined in slices."""
    people = person.select("person_id", "gender_source_value", "year_of_birth", "race_source_value")
    concepts = concept.select(F.col("concept_id").alias("condition_concept_id"), "concept_name")
    rows = condition.select("condition_occurrence_id", "person_id", "condition_start_date", "condition_concept_id")
    return heavy_key_joins(rows, [(people, ["person_id"]), (concepts, ["condition_concept_id"])]).select(
        "condition_occurrence_id", "person_id", "condition_start_date", F.col("concept_name").alias("condition_name"),
        F.col("gender_source_value").alias("gender"), "year_of_birth", F.col("race_source_value").alias("race"),
    )


def burden_and_readmission_rate(person: DataFrame, visit: DataFrame, cost: DataFrame) -> DataFrame:
    """One row with the dashboard measures; a ratio over nothing is 0.

    The facts are needed by several measures: the columns they use are written once.
    """
    visit = settled(visit.select("person_id", "visit_occurrence_id", "visit_start_date", "visit_end_date"))
    cost = settled(cost.select("person_id", "cost_id", "cost_event_id", "total_charge", "total_paid", "paid_by_patient"))
    summary = patient_summary(person, visit, cost).agg(
        money(F.sum("total_spend")).alias("total_spend"),
        money(F.sum("total_oop")).alias("total_out_of_pocket"),
        F.sum("total_encounters").alias("total_encounters"),
    )
    totals = settled(patient_totals(person, visit, cost).select("person_id", "total_spend"))
    high = totals.agg(F.count_if(F.col("total_spend").cast("double") >= spend_threshold(totals).scalar()).alias("n")).scalar()
    known = readmission_counts(visit).join(person.select("person_id"), "person_id", "left_semi")
    again = known.agg(F.coalesce(F.sum("readmissions"), F.lit(0)).alias("n")).scalar()
    counted = summary.withColumns({"high_cost_patient_count": high, "readmissions_30d": again})

    def share(top: str, bottom: str) -> Column:
        return F.coalesce(round_half_up(safe_ratio(F.col(top), F.col(bottom)), 6).cast("double"), F.lit(0.0))

    return counted.withColumns(
        {
            "patient_burden": share("total_out_of_pocket", "total_spend"),
            "readmission_rate": share("readmissions_30d", "total_encounters"),
        }
    )


def geo_risk_by_zip3(person: DataFrame, visit: DataFrame, cost: DataFrame) -> DataFrame:
    """Patients, spend, burden and readmissions per 3-digit region."""
    summary = patient_summary(person, visit, cost)
    again = readmission_counts(visit).withColumnRenamed("person_id", "patient_token")
    return (
        summary.join(again, "patient_token", "left")
        .groupBy("zip_3digit")
        .agg(
            F.count(F.lit(1)).alias("patients"),
            money(F.sum("total_spend")).alias("total_spend"),
            money(F.sum("total_oop")).alias("total_oop"),
            F.coalesce(F.sum("readmissions"), F.lit(0)).cast("bigint").alias("readmissions"),
        )
        .withColumn("burden_pct", ratio_pct(F.col("total_oop"), F.col("total_spend")))
    )
