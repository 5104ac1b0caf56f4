"""Claims: bundles, common data model, views and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions import dates, keys, numbers
from ledgerloom.functions.variants import safe_path as safe_path_of
from ledgerloom.operators import allocate, integrity, merge, rows
from ledgerloom.plans import kpi, omop, star, views
from ledgerloom.sources import bundles

from .bindings import pick
from .oracle_frames import avg_money, dec, hash_mod, pct, wide_key
from .registry import query

SALT = "salt"

SUMMARY = """
    SELECT p.person_id AS patient_token, gender_source_value AS gender, year_of_birth AS birth_year, race_source_value AS race,
           zip_3digit, coalesce(v.n, 0) AS total_encounters, coalesce(c.n, 0) AS total_claims,
           CAST(coalesce(spend, 0) AS DECIMAL(18,2)) AS total_spend, CAST(coalesce(payer, 0) AS DECIMAL(18,2)) AS total_payer,
           CAST(coalesce(oop, 0) AS DECIMAL(18,2)) AS total_oop
    FROM person p LEFT JOIN (SELECT person_id, count(*) AS n FROM visit GROUP BY 1) v ON p.person_id = v.person_id
    LEFT JOIN (SELECT person_id, count(cost_id) AS n, sum(total_charge) AS spend, sum(total_paid) AS payer,
                      sum(paid_by_patient) AS oop FROM cost GROUP BY 1) c ON p.person_id = c.person_id"""

TOTALS = """
    SELECT owner AS person_id, count(*) AS claim_count, CAST(sum(spend) AS DECIMAL(18,2)) AS total_spend,
           CAST(sum(payer) AS DECIMAL(18,2)) AS total_payer, CAST(sum(oop) AS DECIMAL(18,2)) AS total_oop
    FROM (SELECT cost_id, (SELECT v.person_id FROM visit v WHERE v.visit_occurrence_id = cost_event_id) AS owner,
                 sum(total_charge) AS spend, sum(total_paid) AS payer, sum(paid_by_patient) AS oop
          FROM cost WHERE total_charge IS NOT NULL GROUP BY cost_id, cost_event_id)
    WHERE owner IN (SELECT person_id FROM person) GROUP BY owner"""

HIGH_COST = f"""
    WITH totals AS ({TOTALS}), limits AS (SELECT quantile_cont(CAST(total_spend AS DOUBLE), 0.9) AS threshold FROM totals)
    SELECT t.person_id AS patient_token, gender_source_value AS gender, year_of_birth AS birth_year,
           race_source_value AS race, zip_3digit, claim_count, total_spend, total_payer AS total_payer_covered,
           total_oop AS total_out_of_pocket, {pct('total_oop', 'total_spend')} AS patient_burden_pct,
           CASE WHEN CAST(total_spend AS DOUBLE) >= threshold THEN 'High Cost (Top 10%)' ELSE 'Standard' END AS cost_category
    FROM totals t JOIN person p ON t.person_id = p.person_id, limits"""

READMISSIONS = """
    SELECT a.person_id AS patient_token, a.visit_occurrence_id AS first_encounter, b.visit_occurrence_id AS readmit_encounter,
           a.visit_start_date AS first_date, b.visit_start_date AS readmit_date,
           CAST(date_diff('day', a.visit_end_date, b.visit_start_date) AS INTEGER) AS days_between,
           CAST(year(a.visit_start_date) AS INTEGER) AS first_year, CAST(month(a.visit_start_date) AS INTEGER) AS first_month,
           gender_source_value AS gender, zip_3digit,
           CASE WHEN date_diff('day', a.visit_end_date, b.visit_start_date) <= 7 THEN '0-7 days'
                WHEN date_diff('day', a.visit_end_date, b.visit_start_date) <= 14 THEN '8-14 days'
                WHEN date_diff('day', a.visit_end_date, b.visit_start_date) <= 21 THEN '15-21 days' ELSE '22-30 days' END AS readmit_window
    FROM visit a JOIN visit b ON a.person_id = b.person_id AND a.visit_occurrence_id <> b.visit_occurrence_id
     AND date_diff('day', a.visit_end_date, b.visit_start_date) BETWEEN 1 AND 30
    JOIN person p ON a.person_id = p.person_id"""

COVERAGE_OF_AVERAGES = pct(
    "(CAST(sum(payer_coverage) AS DOUBLE) / nullif(count(payer_coverage), 0))",
    "(CAST(sum(total_claim_cost) AS DOUBLE) / nullif(count(total_claim_cost), 0))",
)


# --- bundles --------------------------------------------------------------------


@query(
    "fhir_bundle_scan",
    """SELECT file, resource_type FROM (
         SELECT 'patient/' || person_id AS file, 'Patient' AS resource_type FROM person
         UNION ALL SELECT 'encounter/' || visit_occurrence_id, 'Encounter' FROM visit
         UNION ALL SELECT 'line/' || n, unnest(['Condition', 'ExplanationOfBenefit']) FROM bundle_line)""",
)
def fhir_bundle_scan(frames):
    return frames.over_bundles(lambda found: bundles.bundle_resources(found).select(F.col("bundle_id").alias("file"), "resource_type"))


@query(
    "fhir_bundle_quarantine",
    """SELECT 'document/' || doc_id AS file, 'unreadable' AS reason FROM documents
       UNION ALL SELECT 'page/' || page_id, 'not_a_bundle' FROM pages""",
)
def fhir_bundle_quarantine(frames):
    return bundles.quarantined_bundles(frames.odd_bundles.unionByName(frames.patient_bundles))


@query("fhir_patient", "SELECT * FROM fhir_patient")
def fhir_patient(frames):
    return bundles.parse_patients(frames.landed_resources("Patient"))


@query("fhir_encounter", "SELECT * FROM fhir_encounter")
def fhir_encounter(frames):
    return bundles.parse_encounters(frames.landed_resources("Encounter"))


@query("fhir_condition", "SELECT * FROM fhir_condition")
def fhir_condition(frames):
    return bundles.parse_conditions(frames.landed_resources("Condition"))


@query("fhir_claim", "SELECT * FROM fhir_claim")
def fhir_claim(frames):
    return bundles.parse_claims(frames.landed_resources("ExplanationOfBenefit"))


# --- common data model ------------------------------------------------------------


@query(
    "omop_person",
    f"""SELECT {wide_key('fhir_patient_id')} AS person_id,
               CASE lower(gender) WHEN 'male' THEN 8507 WHEN 'female' THEN 8532 ELSE 0 END AS gender_concept_id,
               CAST(birth_year AS INTEGER) AS year_of_birth,
               CASE WHEN race ILIKE '%white%' THEN 8527 WHEN race ILIKE '%black%' THEN 8516 WHEN race ILIKE '%asian%' THEN 8515
                    ELSE 0 END AS race_concept_id, 0 AS ethnicity_concept_id, fhir_patient_id AS person_source_value,
               gender AS gender_source_value, race AS race_source_value, zip_3digit FROM fhir_patient""",
)
def omop_person(frames):
    return omop.build_person(fhir_patient(frames))


@query(
    "omop_visit_occurrence",
    f"""SELECT {wide_key('fhir_encounter_id')} AS visit_occurrence_id, {wide_key('fhir_patient_id')} AS person_id,
               9202 AS visit_concept_id, CAST(start_date AS DATE) AS visit_start_date, CAST(end_date AS DATE) AS visit_end_date,
               32035 AS visit_type_concept_id, fhir_encounter_id AS visit_source_value FROM fhir_encounter""",
)
def omop_visit_occurrence(frames):
    return omop.build_visit_occurrence(fhir_encounter(frames))


@query(
    "omop_cost",
    f"""SELECT {wide_key('claim_id')} AS cost_id, {wide_key('patient_id')} AS person_id, {wide_key('encounter_id')} AS cost_event_id,
               'Visit' AS cost_domain_id, 32814 AS cost_type_concept_id, {dec('total_cost')} AS total_charge,
               {dec('payment_amount')} AS total_paid, {dec(dec('total_cost') + ' - ' + dec('payment_amount'))} AS paid_by_patient
        FROM fhir_claim
        QUALIFY row_number() OVER (PARTITION BY claim_id ORDER BY created, encounter_id, total_cost, payment_amount, status) = 1""",
)
def omop_cost(frames):
    return omop.build_cost(fhir_claim(frames))


@query(
    "omop_condition_occurrence",
    f"""SELECT {wide_key('fhir_condition_id')} AS condition_occurrence_id, {wide_key('fhir_patient_id')} AS person_id,
               {wide_key('snomed_code')} AS condition_concept_id, CAST(onset_date AS DATE) AS condition_start_date,
               32020 AS condition_type_concept_id, snomed_code AS condition_source_value FROM fhir_condition""",
)
def omop_condition_occurrence(frames):
    return omop.build_condition_occurrence(fhir_condition(frames))


@query(
    "concept_build",
    f"""SELECT {wide_key('code')} AS concept_id, p_name AS concept_name, 'Condition' AS domain_id,
               'SNOMED' AS vocabulary_id, 'Clinical Finding' AS concept_class_id, 'S' AS standard_concept, code AS concept_code
        FROM (SELECT DISTINCT code, p_name FROM bundle_line)""",
)
def concept_build(frames):
    return omop.build_concept(fhir_condition(frames))


@query("hash_mod_key", f"SELECT c_name AS source_id, {hash_mod('c_name')} AS key FROM customer")
def hash_mod_key(frames):
    return frames.table("customer").select(F.col("c_name").alias("source_id"), keys.hash_mod_key(F.col("c_name")).alias("key"))


@query(
    "hash_collision_report",
    f"""WITH i AS (SELECT DISTINCT o_orderkey || '-' || o_custkey AS id FROM orders),
             k AS (SELECT 'narrow' AS key_kind, {hash_mod('id')} AS key, count(*) AS n FROM i GROUP BY 1, 2
                   UNION ALL SELECT 'wide', {wide_key('id')}, count(*) FROM i GROUP BY 1, 2)
        SELECT key_kind, CAST(sum(n) AS BIGINT) AS source_ids, count(*) AS hashed_ids, count(*) FILTER (n > 1) AS colliding_keys,
               CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS colliding_ids FROM k GROUP BY 1""",
)
def hash_collision_report(frames):
    ids = frames.table("orders").select(F.concat_ws("-", "o_orderkey", "o_custkey").alias("id"))
    return omop.hash_collision_report(ids, "id")


@query(
    "strip_reference",
    """SELECT o_orderkey AS id, CAST(CASE o_orderkey % 4 WHEN 0 THEN o_custkey::VARCHAR WHEN 1 THEN o_custkey::VARCHAR
              WHEN 2 THEN o_custkey::VARCHAR ELSE 'Organization/' || o_custkey END AS VARCHAR) AS target FROM orders""",
)
def strip_reference(frames):
    prefix = pick(F.col("o_orderkey") % 4, "urn:uuid:", "Patient/", "Encounter/", "Organization/")
    reference = F.concat(prefix, F.col("o_custkey").cast("string"))
    return frames.table("orders").select(F.col("o_orderkey").alias("id"), keys.strip_reference(reference).alias("target"))


@query("first_coding", "SELECT n AS id, 'I' || code AS code, CAST(NULL AS VARCHAR) AS none FROM bundle_line")
def first_coding(frames):
    conditions = bundles._typed(frames.landed_resources("Condition"), "Condition", bundles.CONDITION_SCHEMA)
    return conditions.select(
        F.substr("id", F.lit(2)).alias("id"),
        bundles.first_coding(F.col("code"), "code").alias("code"),
        bundles.first_coding(bundles.first(F.slice("category", 1, 0)), "code").alias("none"),
    )


@query("safe_path", "SELECT CAST(props->>'$.k' AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS missing, event_id FROM events")
def safe_path(frames):
    props = F.col("props")
    return frames.table("events").select("event_id", safe_path_of(props, "$.k", "bigint").alias("k"), safe_path_of(props, "$.k.deeper[3]").alias("missing"))


@query("date_prefix", "SELECT event_id, left(CAST(ts AS VARCHAR), 10) AS day FROM events")
def date_prefix(frames):
    return frames.table("events").select("event_id", dates.date_prefix(F.col("ts").cast("string")).alias("day"))


@query("year_month_label", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS year_month FROM orders")
def year_month_label(frames):
    label = dates.year_month_label(F.year("o_orderdate"), F.month("o_orderdate"))
    return frames.table("orders").select("o_orderkey", label.alias("year_month"))


@query(
    "readmit_window_label",
    """SELECT l_orderkey, l_linenumber, l_quantity, CASE WHEN l_quantity <= 7 THEN '0-7 days' WHEN l_quantity <= 14 THEN '8-14 days'
              WHEN l_quantity <= 21 THEN '15-21 days' ELSE '22-30 days' END AS readmit_window FROM lineitem""",
)
def readmit_window_label(frames):
    return frames.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", dates.readmit_window_label(F.col("l_quantity")).alias("readmit_window")
    )


@query("safe_ratio_pct", f"SELECT l_orderkey, l_linenumber, {pct('own_part', 'charge')} AS pct, {pct('paid', '(l_linenumber - 1)')} AS odd FROM line_money")
def safe_ratio_pct(frames):
    return frames.line_money.select(
        "l_orderkey", "l_linenumber",
        numbers.ratio_pct(F.col("own_part"), F.col("charge")).alias("pct"),
        numbers.ratio_pct(F.col("paid"), F.col("l_linenumber") - 1).alias("odd"),
    )


# --- views ------------------------------------------------------------------------


@query("patient_summary", SUMMARY)
def patient_summary(frames):
    return views.patient_summary(frames.person, frames.visit, frames.cost)


@query("high_cost_patients", HIGH_COST)
def high_cost_patients(frames):
    return views.high_cost_patients(frames.person, frames.visit, frames.cost)


@query("spend_percentile_threshold", f"WITH totals AS ({TOTALS}) SELECT round(quantile_cont(CAST(total_spend AS DOUBLE), 0.9), 4) AS threshold FROM totals")
def spend_percentile_threshold(frames):
    totals = views.patient_totals(frames.person, frames.visit, frames.cost)
    return views.spend_threshold(totals).select(F.round("threshold", 4).alias("threshold"))


@query(
    "high_cost_percentile_inc",
    f"""WITH s AS ({SUMMARY}), t AS (SELECT quantile_cont(CAST(total_spend AS DOUBLE), 0.9) AS threshold FROM s)
        SELECT patient_token, total_spend FROM s, t WHERE CAST(total_spend AS DOUBLE) >= threshold""",
)
def high_cost_percentile_inc(frames):
    summary = patient_summary(frames).select("patient_token", "total_spend")
    threshold = views.spend_threshold(summary).scalar()
    return summary.where(F.col("total_spend").cast("double") >= threshold)


@query("readmissions_30d", READMISSIONS)
def readmissions_30d(frames):
    return views.readmissions_30d(frames.person, frames.visit)


@query(
    "next_readmission",
    """SELECT * FROM (SELECT person_id AS patient_token, visit_occurrence_id AS first_encounter,
              lead(visit_occurrence_id) OVER w AS readmit_encounter,
              CAST(date_diff('day', visit_end_date, lead(visit_start_date) OVER w) AS INTEGER) AS days_between
       FROM visit WINDOW w AS (PARTITION BY person_id ORDER BY visit_start_date, visit_occurrence_id)) WHERE days_between BETWEEN 1 AND 30""",
)
def next_readmission(frames):
    return views.next_readmission(frames.visit)


@query(
    "claims_with_conditions",
    """SELECT condition_occurrence_id, person_id, condition_start_date, concept_name AS condition_name,
              gender_source_value AS gender, year_of_birth, race_source_value AS race
       FROM condition JOIN person USING (person_id) JOIN concept ON condition_concept_id = concept_id""",
)
def claims_with_conditions(frames):
    return views.claims_with_conditions(frames.condition, frames.person, frames.concept)


@query(
    "burden_and_readmission_rate",
    f"""WITH s AS ({SUMMARY}), h AS ({HIGH_COST}), r AS ({READMISSIONS}),
        n AS (SELECT CAST(sum(total_spend) AS DECIMAL(18,2)) AS total_spend, CAST(sum(total_oop) AS DECIMAL(18,2)) AS total_out_of_pocket,
                     CAST(sum(total_encounters) AS BIGINT) AS total_encounters,
                     (SELECT count(*) FROM h WHERE cost_category LIKE 'High%') AS high_cost_patient_count,
                     (SELECT count(*) FROM r) AS readmissions_30d FROM s)
        SELECT *, coalesce(CAST(round(CAST(CAST(total_out_of_pocket AS DOUBLE) / nullif(CAST(total_spend AS DOUBLE), 0) AS DECIMAL(28,8)), 6) AS DOUBLE), 0) AS patient_burden,
               coalesce(CAST(round(CAST(CAST(readmissions_30d AS DOUBLE) / nullif(total_encounters, 0) AS DECIMAL(28,8)), 6) AS DOUBLE), 0) AS readmission_rate
        FROM n""",
)
def burden_and_readmission_rate(frames):
    return views.burden_and_readmission_rate(frames.person, frames.visit, frames.cost)


@query(
    "geo_risk_by_zip3",
    f"""WITH s AS ({SUMMARY}), r AS (SELECT patient_token, count(*) AS n FROM ({READMISSIONS}) GROUP BY 1)
        SELECT zip_3digit, count(*) AS patients, CAST(sum(total_spend) AS DECIMAL(18,2)) AS total_spend,
               CAST(sum(total_oop) AS DECIMAL(18,2)) AS total_oop, CAST(coalesce(sum(n), 0) AS BIGINT) AS readmissions,
               {pct('sum(total_oop)', 'sum(total_spend)')} AS burden_pct
        FROM s LEFT JOIN r USING (patient_token) GROUP BY 1""",
)
def geo_risk_by_zip3(frames):
    return views.geo_risk_by_zip3(frames.person, frames.visit, frames.cost)


# --- star reports -----------------------------------------------------------------


@query(
    "star_join_claims",
    """SELECT encounter_token, patient_key, condition_key, encounter_type_key, date_key, service_start, total_claim_cost, payer_coverage,
              patient_out_of_pocket, full_date, year, month, month_name, class_display, is_emergency, is_inpatient,
              condition_category, snomed_code, snomed_display, patient_token, gender, state_abbr
       FROM fact_claims JOIN dim_date USING (date_key) JOIN dim_encounter_type USING (encounter_type_key)
       JOIN dim_condition USING (condition_key) JOIN dim_patient USING (patient_key)""",
)
def star_join_claims(frames):
    return kpi.star_join_claims(frames.fact_claims, frames.dim_date, frames.dim_encounter_type, frames.dim_condition, frames.dim_patient)


@query(
    "claims_filters",
    """SELECT date_key, encounter_token, patient_key, condition_key, encounter_type_key, service_start, total_claim_cost, payer_coverage,
              patient_out_of_pocket, year FROM fact_claims JOIN dim_date USING (date_key)
       WHERE total_claim_cost > 0 AND payer_coverage IS NOT NULL AND patient_out_of_pocket IS NOT NULL AND year BETWEEN 1996 AND 2000""",
)
def claims_filters(frames):
    return kpi.claims_filters(frames.fact_claims, frames.dim_date, 1996, 2000)


@query(
    "claim_cost_by_condition",
    f"""SELECT condition_category, count(*) AS claim_count, {avg_money('total_claim_cost')} AS avg_total_claim,
               {avg_money('payer_coverage')} AS avg_payer_coverage, {avg_money('patient_out_of_pocket')} AS avg_patient_oop,
               {COVERAGE_OF_AVERAGES} AS payer_coverage_pct, {dec('sum(total_claim_cost)')} AS total_cost_all
        FROM fact_claims JOIN dim_condition USING (condition_key) WHERE total_claim_cost IS NOT NULL GROUP BY 1""",
)
def claim_cost_by_condition(frames):
    return kpi.claim_cost_by_condition(frames.fact_claims, frames.dim_condition)


@query(
    "monthly_encounter_volume",
    f"""SELECT year, month, month_name, class_display,
               CASE WHEN is_emergency THEN 'Emergency' WHEN is_inpatient THEN 'Inpatient' ELSE 'Outpatient' END AS encounter_category,
               count(*) AS encounter_count, {avg_money('total_claim_cost')} AS avg_claim_cost,
               year || '-' || lpad(CAST(month AS VARCHAR), 2, '0') AS year_month
        FROM fact_claims JOIN dim_date USING (date_key) JOIN dim_encounter_type USING (encounter_type_key)
        WHERE year BETWEEN 1995 AND 2025 GROUP BY year, month, month_name, class_display, is_emergency, is_inpatient""",
)
def monthly_encounter_volume(frames):
    return kpi.monthly_encounter_volume(frames.fact_claims, frames.dim_date, frames.dim_encounter_type, 1995, 2025)


@query(
    "payer_gap_by_condition",
    f"""SELECT condition_category, snomed_display, count(*) AS encounter_count, {dec('sum(total_claim_cost)')} AS total_cost,
               {dec('sum(payer_coverage)')} AS total_payer, {dec('sum(patient_out_of_pocket)')} AS total_patient_oop,
               {pct('sum(payer_coverage)', 'sum(total_claim_cost)')} AS payer_coverage_pct,
               {pct('sum(patient_out_of_pocket)', 'sum(total_claim_cost)')} AS patient_burden_pct
        FROM fact_claims JOIN dim_condition USING (condition_key)
        WHERE total_claim_cost > 0 AND payer_coverage IS NOT NULL AND patient_out_of_pocket IS NOT NULL
        GROUP BY 1, 2 HAVING count(*) >= 10""",
)
def payer_gap_by_condition(frames):
    return kpi.payer_gap_by_condition(frames.fact_claims, frames.dim_condition)


READMISSION_REPORT = f"""
    WITH lines AS (SELECT patient_key AS p, encounter_token AS e, date_key AS d, count(*) AS n, sum(coalesce(total_claim_cost, 0)) AS c
                   FROM fact_claims WHERE service_start IS NOT NULL GROUP BY ALL),
    dated AS (SELECT p, e, full_date AS day, n, c FROM lines JOIN dim_date ON d = date_key),
    followed AS (SELECT x.p, x.e, y.day - x.day AS gap, x.n * y.n AS pairs, x.n * y.c AS cost
                 FROM dated x, dated y WHERE x.p = y.p AND x.e <> y.e AND y.day > x.day AND y.day <= x.day + 30),
    totals AS (SELECT p, count(DISTINCT e) AS readmission_events, CAST(min(gap) AS INTEGER) AS min_days_to_readmit,
                      CAST(round(CAST(CAST(sum(gap * pairs) AS DOUBLE) / sum(pairs) AS DECIMAL(28,8)), 1) AS DOUBLE) AS avg_days_to_readmit,
                      {dec('sum(cost)')} AS total_readmit_cost FROM followed GROUP BY p)
    SELECT patient_key, patient_token, gender, state_abbr, readmission_events, min_days_to_readmit, avg_days_to_readmit, total_readmit_cost
    FROM dim_patient JOIN totals ON p = patient_key"""


@query("readmission_pairs_by_patient", READMISSION_REPORT)
def readmission_pairs_by_patient(frames):
    return kpi.readmission_pairs_by_patient(frames.fact_claims, frames.dim_date, frames.dim_patient)


@query(
    "multi_key_sort",
    f"SELECT *, row_number() OVER (ORDER BY readmission_events DESC, total_readmit_cost DESC, patient_key) AS place FROM ({READMISSION_REPORT})",
)
def multi_key_sort(frames):
    """The whole report in order, with each row's place."""
    report = readmission_pairs_by_patient(frames)
    order = [F.col("readmission_events").desc(), F.col("total_readmit_cost").desc(), F.col("patient_key")]
    return allocate.numbered_by(report, order, "place")


@query(
    "kpi_summary_card",
    f"""SELECT count(DISTINCT patient_key) AS total_patients, count(*) AS total_claims, {avg_money('total_claim_cost')} AS avg_claim_cost,
               {dec('sum(total_claim_cost)')} AS total_cost_all, {dec('sum(payer_coverage)')} AS total_payer_covered,
               {dec('sum(patient_out_of_pocket)')} AS total_patient_oop, {COVERAGE_OF_AVERAGES} AS overall_payer_coverage_pct
        FROM fact_claims WHERE total_claim_cost IS NOT NULL""",
)
def kpi_summary_card(frames):
    return kpi.kpi_summary_card(frames.fact_claims)


@query(
    "condition_visit_join",
    """SELECT f.*, d.* FROM fact_encounter f JOIN dim_condition d ON f.reason_code = d.snomed_code""",
)
def condition_visit_join(frames):
    return kpi.condition_visit_join(frames.fact_encounter, frames.dim_condition)


@query(
    "top_conditions",
    """SELECT snomed_display AS medical_condition, count(encounter_token) AS total_hospital_visits
       FROM fact_encounter JOIN dim_condition ON reason_code = snomed_code WHERE snomed_display IS NOT NULL
       GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
)
def top_conditions(frames):
    return kpi.top_conditions(frames.fact_encounter, frames.dim_condition)


@query(
    "latest_encounters",
    """SELECT encounter_token, patient_token, date_key, encounter_type, reason_description FROM fact_encounter
       ORDER BY date_key DESC, encounter_token LIMIT 5""",
)
def latest_encounters(frames):
    return kpi.latest_encounters(frames.fact_encounter)


@query("top_n", f"SELECT patient_token, total_spend FROM ({SUMMARY}) ORDER BY total_spend DESC, patient_token LIMIT 10")
def top_n(frames):
    summary = patient_summary(frames).select("patient_token", "total_spend")
    return rows.top_n(summary, 10, F.col("total_spend").desc(), F.col("patient_token"))


@query(
    "table_row_counts",
    """SELECT 'dim_patient' AS table_name, count(*) AS total_rows FROM dim_patient
       UNION ALL SELECT 'dim_condition', count(*) FROM dim_condition UNION ALL SELECT 'dim_date', count(*) FROM dim_date
       UNION ALL SELECT 'fact_encounter', count(*) FROM fact_encounter""",
)
def table_row_counts(frames):
    return integrity.table_row_counts(
        {name: getattr(frames, name) for name in ("dim_patient", "dim_condition", "dim_date", "fact_encounter")}
    )


@query(
    "spend_reconciliation",
    f"""WITH s AS (SELECT sum({dec('total_cost')}) AS a FROM fhir_claim), l AS (SELECT sum(total_charge) AS b FROM cost)
        SELECT CAST(a AS DECIMAL(28,2)) AS staged_total, CAST(b AS DECIMAL(28,2)) AS loaded_total,
               CAST(a - b AS DECIMAL(28,2)) AS difference, a = b AS reconciled FROM s, l""",
)
def spend_reconciliation(frames):
    staged = fhir_claim(frames).select(numbers.money(F.col("total_cost")).alias("total_charge"))
    return integrity.spend_reconciliation(staged, frames.cost, "total_charge")


# --- star builders ----------------------------------------------------------------


@query("star_dim_date", "SELECT * FROM dim_date")
def star_dim_date(frames):
    return star.build_dim_date(fhir_encounter(frames), "start_date")


@query(
    "star_dim_patient",
    f"""SELECT {wide_key('fhir_patient_id')} AS patient_key, sha256('salt' || fhir_patient_id) AS patient_token, gender,
               state AS state_abbr FROM fhir_patient""",
)
def star_dim_patient(frames):
    return star.build_dim_patient(fhir_patient(frames), SALT)


@query(
    "star_dim_condition",
    f"""SELECT {wide_key('snomed_code')} AS condition_key, category AS condition_category, snomed_code, snomed_display
        FROM (SELECT DISTINCT snomed_code, snomed_display, category FROM fhir_condition)""",
)
def star_dim_condition(frames):
    return star.build_dim_condition(fhir_condition(frames))


@query(
    "star_dim_encounter_type",
    f"""SELECT {wide_key('class_code')} AS encounter_type_key, class_display, class_code = 'EMER' AS is_emergency,
               class_code IN ('IMP', 'ACUTE', 'NONAC') AS is_inpatient FROM (SELECT DISTINCT class_code, class_display FROM fhir_encounter)""",
)
def star_dim_encounter_type(frames):
    return star.build_dim_encounter_type(fhir_encounter(frames))


@query(
    "star_fact_encounter",
    """SELECT sha256('salt' || fhir_encounter_id) AS encounter_token, sha256('salt' || fhir_patient_id) AS patient_token,
              CAST(replace(start_date, '-', '') AS INTEGER) AS date_key, encounter_type, reason_code,
              reason_display AS reason_description FROM fhir_encounter""",
)
def star_fact_encounter(frames):
    return star.build_fact_encounter(fhir_encounter(frames), SALT)


@query(
    "star_fact_claims",
    f"""SELECT sha256('salt' || encounter_id) AS encounter_token, {wide_key('patient_id')} AS patient_key, {wide_key('reason_code')} AS condition_key,
               {wide_key('class_code')} AS encounter_type_key, CAST(replace(start_date, '-', '') AS INTEGER) AS date_key,
               CAST(start_date AS DATE) AS service_start, {dec('total_cost')} AS total_claim_cost, {dec('payment_amount')} AS payer_coverage,
               {dec(dec('total_cost') + ' - ' + dec('payment_amount'))} AS patient_out_of_pocket
        FROM fhir_claim JOIN fhir_encounter ON encounter_id = fhir_encounter_id""",
)
def star_fact_claims(frames):
    frames.land("ExplanationOfBenefit", "Encounter")
    return star.build_fact_claims(fhir_claim(frames), fhir_encounter(frames), SALT)


# --- upsert -----------------------------------------------------------------------

MONEY_COLUMNS = ["total_claim_cost", "payer_coverage", "patient_out_of_pocket"]


@query(
    "merge_upsert",
    """SELECT coalesce(t.encounter_token, s.encounter_token) AS encounter_token, coalesce(t.patient_key, s.patient_key) AS patient_key,
              CASE WHEN s.encounter_token IS NOT NULL THEN s.total_claim_cost ELSE t.total_claim_cost END AS total_claim_cost,
              CASE WHEN s.encounter_token IS NOT NULL THEN s.payer_coverage ELSE t.payer_coverage END AS payer_coverage,
              CASE WHEN s.encounter_token IS NOT NULL THEN s.patient_out_of_pocket ELSE t.patient_out_of_pocket END AS patient_out_of_pocket
       FROM merge_target t FULL JOIN merge_staging s ON t.encounter_token = s.encounter_token""",
)
def merge_upsert(frames):
    return merge.merge_upsert(frames.merge_target, frames.merge_staging, "encounter_token", MONEY_COLUMNS)


@query("merge_source_unique_check", "SELECT encounter_token, count(*) AS source_rows FROM fact_claims GROUP BY 1 HAVING count(*) > 1")
def merge_source_unique_check(frames):
    return merge.duplicate_keys(frames.fact_claims, ["encounter_token"])


@query(
    "keep_first_by_key",
    """SELECT cost_id, cost_event_id, total_charge FROM cost
       QUALIFY row_number() OVER (PARTITION BY cost_id ORDER BY cost_event_id, total_charge, total_paid) = 1""",
)
def keep_first_by_key(frames):
    order = [F.col(c) for c in ("cost_event_id", "total_charge", "total_paid")]
    return rows.keep_first_by_key(frames.cost, ["cost_id"], order).select("cost_id", "cost_event_id", "total_charge")


@query(
    "batch_concat_dedupe",
    """SELECT * FROM merge_target UNION ALL
       SELECT * FROM merge_staging WHERE encounter_token NOT IN (SELECT encounter_token FROM merge_target)""",
)
def batch_concat_dedupe(frames):
    return rows.union_keep_existing(frames.merge_target, frames.merge_staging, ["encounter_token"], ["total_claim_cost"])


@query(
    "schema_evolution_union",
    """SELECT encounter_token, patient_key, total_claim_cost, payer_coverage, patient_out_of_pocket, 'UTC' AS upload_timezone, 1 AS version
       FROM merge_target UNION ALL
       SELECT encounter_token, patient_key, total_claim_cost, payer_coverage, patient_out_of_pocket, 'US/Pacific', 2 FROM merge_staging""",
)
def schema_evolution_union(frames):
    new = frames.merge_staging.withColumns({"upload_timezone": F.lit("US/Pacific"), "version": F.lit(2)})
    return rows.union_with_defaults(frames.merge_target, new, {"upload_timezone": "UTC", "version": 1})


@query(
    "batch_validate",
    """SELECT date_key, count(*) AS total_rows, count(*) FILTER (NOT (total_claim_cost > 20000)) AS cost_failures,
              count(*) FILTER (NOT (patient_out_of_pocket > 0)) AS oop_failures,
              count(*) FILTER (total_claim_cost > 20000 AND patient_out_of_pocket > 0) AS valid_rows FROM fact_claims GROUP BY 1""",
)
def batch_validate(frames):
    rules = {"cost": F.col("total_claim_cost") > 20000, "oop": F.col("patient_out_of_pocket") > 0}
    return integrity.batch_validate(frames.fact_claims, ["date_key"], rules)


# --- main path: bundles to results --------------------------------------------------


def _model(frames):
    """Person, visit and cost of the common data model, from landed bundles."""
    frames.land("Patient", "Encounter", "ExplanationOfBenefit")
    entries = frames.landed_resources
    person = omop.build_person(bundles.parse_patients(entries("Patient")))
    visit = omop.build_visit_occurrence(bundles.parse_encounters(entries("Encounter")))
    return person, visit, omop.build_cost(bundles.parse_claims(entries("ExplanationOfBenefit")))


def _from_bundles(sql: str) -> str:
    """The direct SQL over one cost row per claim id, with the model's keys."""
    once = sql.replace("FROM cost ", "FROM cost_once ")
    return f"SELECT * REPLACE ({wide_key('CAST(patient_token AS VARCHAR)')} AS patient_token) FROM ({once})"


@query("bundles_to_patient_summary", _from_bundles(SUMMARY))
def bundles_to_patient_summary(frames):
    return views.patient_summary(*_model(frames))


@query("bundles_to_high_cost", _from_bundles(HIGH_COST))
def bundles_to_high_cost(frames):
    return views.high_cost_patients(*_model(frames))


@query(
    "bundles_to_claim_cost_by_condition",
    f"""WITH reasons AS (SELECT l_orderkey AS o, min(l_partkey) AS part FROM lineitem GROUP BY 1),
             seen AS (SELECT DISTINCT l_partkey AS part FROM lineitem)
        SELECT 'encounter-diagnosis' AS condition_category, count(*) AS claim_count, {avg_money('charge')} AS avg_total_claim,
               {avg_money('paid')} AS avg_payer_coverage, {avg_money('own_part')} AS avg_patient_oop,
               {pct('sum(paid)', 'sum(charge)')} AS payer_coverage_pct, {dec('sum(charge)')} AS total_cost_all
        FROM line_money JOIN reasons ON l_orderkey = o JOIN seen USING (part)""",
)
def bundles_to_claim_cost_by_condition(frames):
    """Bundles to the star schema to the first report; a claim's condition is the reason of its encounter."""
    frames.land("ExplanationOfBenefit", "Encounter", "Condition")
    entries = frames.landed_resources
    fact = star.build_fact_claims(bundles.parse_claims(entries("ExplanationOfBenefit")), bundles.parse_encounters(entries("Encounter")), SALT)
    return kpi.claim_cost_by_condition(fact, star.build_dim_condition(bundles.parse_conditions(entries("Condition"))))


@query(
    "star_tokens_join",
    """SELECT sha256('salt' || fhir_patient_id) AS patient_token, count(*) AS encounters FROM fhir_encounter
       JOIN (SELECT fhir_patient_id FROM fhir_patient) USING (fhir_patient_id) GROUP BY 1""",
)
def star_tokens_join(frames):
    """Encounters per patient, joined by token: one salt for the whole build."""
    frames.land("Patient", "Encounter")
    patients = star_dim_patient(frames).select("patient_token")
    return star_fact_encounter(frames).join(patients, "patient_token").groupBy("patient_token").agg(F.count(F.lit(1)).alias("encounters"))
