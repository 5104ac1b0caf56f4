"""The frames of ``bindings.py`` as SQL for the checking engine, and small SQL helpers."""

from __future__ import annotations

import re

SQL_FRAMES = {
    "person": """
        SELECT c_custkey AS person_id,
               CASE c_custkey % 3 WHEN 0 THEN 'male' WHEN 1 THEN 'female' END AS gender_source_value,
               CAST(1930 + c_custkey % 80 AS INTEGER) AS year_of_birth,
               CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'White' WHEN 'BUILDING' THEN 'Black or African American'
                    WHEN 'FURNITURE' THEN 'Asian' WHEN 'HOUSEHOLD' THEN 'Other' END AS race_source_value,
               CAST(100 + c_nationkey AS VARCHAR) AS zip_3digit, c_nationkey, c_mktsegment
        FROM customer""",
    "visit": """
        SELECT o_orderkey AS visit_occurrence_id,
               CASE WHEN o_custkey % 25 = 0 THEN o_custkey + 1 ELSE o_custkey END AS person_id,
               CAST(o_orderdate AS DATE) AS visit_start_date,
               CAST(o_orderdate AS DATE) + CAST(o_orderkey % 6 AS INTEGER) AS visit_end_date,
               o_orderstatus, o_orderpriority
        FROM orders""",
    "line_money": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, charge, paid, CAST(charge - paid AS DECIMAL(18,2)) AS own_part
        FROM (SELECT *, CAST(charge * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,2)) AS paid
              FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(18,2)) AS charge FROM lineitem))""",
    "cost": """
        SELECT l_orderkey * 8 + l_linenumber AS cost_id, person_id, l_orderkey AS cost_event_id,
               charge AS total_charge, paid AS total_paid, own_part AS paid_by_patient
        FROM line_money JOIN visit ON l_orderkey = visit_occurrence_id""",
    "cost_once": """
        SELECT l_orderkey * 8 + l_linenumber AS cost_id, person_id, l_orderkey AS cost_event_id,
               charge AS total_charge, paid AS total_paid, own_part AS paid_by_patient
        FROM line_money JOIN visit ON l_orderkey = visit_occurrence_id
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY CAST(l_shipdate AS DATE), charge, paid) = 1""",
    "concept": "SELECT p_partkey AS concept_id, p_name AS concept_name, CAST(p_partkey AS VARCHAR) AS concept_code FROM part",
    "condition": """
        SELECT l_orderkey * 8 + l_linenumber AS condition_occurrence_id, person_id, l_partkey AS condition_concept_id,
               CAST(l_shipdate AS DATE) AS condition_start_date
        FROM lineitem JOIN visit ON l_orderkey = visit_occurrence_id""",
    "dim_patient": """
        SELECT c_custkey AS patient_key, sha256(c_name) AS patient_token,
               CASE c_custkey % 3 WHEN 0 THEN 'male' WHEN 1 THEN 'female' END AS gender, n_name AS state_abbr
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "dim_condition": """
        SELECT p_partkey AS condition_key, p_type AS condition_category, CAST(p_partkey AS VARCHAR) AS snomed_code,
               p_name AS snomed_display FROM part""",
    "dim_date": """
        SELECT DISTINCT CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key, CAST(o_orderdate AS DATE) AS full_date,
               CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
               monthname(o_orderdate) AS month_name FROM orders""",
    "dim_encounter_type": """
        SELECT DISTINCT CAST(left(o_orderpriority, 1) AS INTEGER) AS encounter_type_key, o_orderpriority AS class_display,
               o_orderpriority = '1-URGENT' AS is_emergency, o_orderpriority = '2-HIGH' AS is_inpatient FROM orders""",
    "fact_claims": """
        SELECT CAST(o_orderkey AS VARCHAR) AS encounter_token, o_custkey AS patient_key, l_partkey AS condition_key,
               CAST(left(o_orderpriority, 1) AS INTEGER) AS encounter_type_key,
               CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key, CAST(o_orderdate AS DATE) AS service_start,
               charge AS total_claim_cost, paid AS payer_coverage, own_part AS patient_out_of_pocket
        FROM line_money JOIN orders ON l_orderkey = o_orderkey""",
    "fact_encounter": """
        SELECT CAST(o_orderkey AS VARCHAR) AS encounter_token, sha256(CAST(o_custkey AS VARCHAR)) AS patient_token,
               CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key, o_orderpriority AS encounter_type,
               CAST(r.part AS VARCHAR) AS reason_code, p_name AS reason_description
        FROM orders LEFT JOIN (SELECT l_orderkey, min(l_partkey) AS part FROM lineitem GROUP BY 1) r ON o_orderkey = l_orderkey
        LEFT JOIN part ON r.part = p_partkey""",
    "claims_per_encounter": """
        SELECT encounter_token, patient_key, service_start, CAST(sum(total_claim_cost) AS DECIMAL(18,2)) AS total_claim_cost,
               CAST(sum(payer_coverage) AS DECIMAL(18,2)) AS payer_coverage,
               CAST(sum(patient_out_of_pocket) AS DECIMAL(18,2)) AS patient_out_of_pocket
        FROM fact_claims GROUP BY 1, 2, 3""",
    "merge_target": "SELECT * EXCLUDE (service_start) FROM claims_per_encounter WHERE service_start < DATE '2001-01-01'",
    "merge_staging": """
        SELECT encounter_token, patient_key, CAST(total_claim_cost * CAST(1.1 AS DECIMAL(2,1)) AS DECIMAL(18,2)) AS total_claim_cost,
               CAST(payer_coverage * CAST(1.1 AS DECIMAL(2,1)) AS DECIMAL(18,2)) AS payer_coverage,
               CAST(patient_out_of_pocket * CAST(1.1 AS DECIMAL(2,1)) AS DECIMAL(18,2)) AS patient_out_of_pocket
        FROM claims_per_encounter WHERE service_start >= DATE '2000-07-01'""",
    "fhir_patient": """
        SELECT CAST(person_id AS VARCHAR) AS fhir_patient_id, 'Patient' AS fhir_resource, gender_source_value AS gender,
               CAST(year_of_birth AS VARCHAR) AS birth_year,
               CAST(person_id % 7 = 0 OR person_id % 11 = 0 AS INTEGER) AS deceased, left(c_mktsegment, 1) AS marital_status,
               'en-US' AS language, race_source_value AS race, 'Not Hispanic' AS ethnicity,
               'S' || CAST(c_nationkey AS VARCHAR) AS state, zip_3digit, 'FHIR_R4' AS data_source FROM person""",
    "fhir_encounter": """
        SELECT 'e' || CAST(visit_occurrence_id AS VARCHAR) AS fhir_encounter_id, 'Encounter' AS fhir_resource,
               CAST(person_id AS VARCHAR) AS fhir_patient_id, o_orderstatus AS status, left(o_orderpriority, 1) AS class_code,
               o_orderpriority AS class_display, CAST(visit_occurrence_id % 100 AS VARCHAR) AS encounter_type_code,
               'type ' || CAST(visit_occurrence_id % 100 AS VARCHAR) AS encounter_type,
               strftime(visit_start_date, '%Y-%m-%d') AS start_date,
               CASE WHEN visit_occurrence_id % 10 <> 3 THEN strftime(visit_end_date, '%Y-%m-%d') END AS end_date,
               CASE WHEN visit_occurrence_id % 10 <> 3 THEN
                 CAST(round(CAST((date_diff('day', visit_start_date, visit_end_date) * 86400 + 4800) / 3600.0 AS DECIMAL(20,8)), 2) AS DOUBLE)
               END AS duration_hrs,
               CAST(r.part AS VARCHAR) AS reason_code, p_name AS reason_display,
               'Organization/' || CAST(visit_occurrence_id % 9 AS VARCHAR) AS service_provider, 'FHIR_R4' AS data_source
        FROM visit LEFT JOIN (SELECT l_orderkey, min(l_partkey) AS part FROM lineitem GROUP BY 1) r ON visit_occurrence_id = l_orderkey
        LEFT JOIN part ON r.part = p_partkey""",
    "bundle_line": """
        SELECT CAST(l_orderkey * 8 + l_linenumber AS VARCHAR) AS n, CAST(person_id AS VARCHAR) AS patient,
               'e' || CAST(l_orderkey AS VARCHAR) AS encounter, CAST(l_partkey AS VARCHAR) AS code, p_name,
               strftime(l_shipdate, '%Y-%m-%d') AS day, charge, paid
        FROM line_money JOIN visit ON l_orderkey = visit_occurrence_id JOIN part ON l_partkey = p_partkey""",
    "fhir_condition": """
        SELECT 'c' || n AS fhir_condition_id, 'Condition' AS fhir_resource, patient AS fhir_patient_id,
               encounter AS fhir_encounter_id, code AS snomed_code, p_name AS snomed_display, 'I' || code AS icd_code,
               'icd text' AS icd_display, 'active' AS clinical_status, 'confirmed' AS verification_status,
               'encounter-diagnosis' AS category, day AS onset_date, CAST(NULL AS VARCHAR) AS abatement_date,
               'FHIR_R4' AS data_source FROM bundle_line""",
    "fhir_claim": """
        SELECT 'k' || n AS claim_id, patient AS patient_id, encounter AS encounter_id, CAST(charge AS DOUBLE) AS total_cost,
               CAST(paid AS DOUBLE) AS payment_amount, 'active' AS status, day || 'T11:00:00Z' AS created FROM bundle_line""",
    "branch": "SELECT n_name AS branch_name, n_regionkey AS region FROM nation",
    "employee": """
        SELECT lpad(CAST(s_suppkey AS VARCHAR), 9, '0') AS ssn, s_name AS name,
               CASE WHEN s_suppkey > 0 THEN lpad(CAST(s_suppkey // 10 AS VARCHAR), 9, '0') END AS manager_ssn FROM supplier""",
    "dependent": "SELECT c_name AS name, lpad(CAST(c_custkey % 1200 AS VARCHAR), 9, '0') AS employee_ssn FROM customer",
    "users": "SELECT DISTINCT source AS user_id FROM documents WHERE lang = 'en' AND source <> 'src3'",
    "silver": "SELECT r_regionkey AS silver_id FROM region",
    "lineage_steps": """
        SELECT CASE WHEN doc_id % 10 = 0 THEN doc_id + 1000000000 ELSE doc_id END AS bronze_file_id, doc_id % 7 AS silver_aggregation_id
        FROM labels""",
    "employee_after": """
        SELECT lpad(CAST(s_suppkey AS VARCHAR), 9, '0') AS ssn,
               CASE WHEN s_suppkey = 0 THEN '000000001' WHEN s_nationkey = 1 THEN '000000000' WHEN s_nationkey = 2 THEN NULL
                    ELSE lpad(CAST(s_suppkey // 10 AS VARCHAR), 9, '0') END AS manager_ssn FROM supplier""",
    "bank_customer": """
        SELECT c_custkey AS customer_id,
               CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'Business' ELSE 'Individual' END AS customer_type,
               'Nation ' || CAST(c_nationkey AS VARCHAR) AS address FROM customer""",
    "individual": """
        SELECT c_custkey AS customer_id, c_name AS name,
               lpad(CAST(c_custkey % (SELECT count(*) FROM supplier) AS VARCHAR), 9, '0') AS personal_banker_ssn
        FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')""",
    "business": """
        SELECT c_custkey AS customer_id, c_name AS business_name FROM customer
        WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')""",
    "account": """
        SELECT c_custkey AS account_number, CAST(c_acctbal AS DECIMAL(15,2)) AS balance,
               CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'Business' WHEN c_mktsegment = 'AUTOMOBILE' THEN 'Checking'
                    ELSE 'Savings' END AS account_type FROM customer""",
    "account_after": """
        SELECT c_custkey AS account_number, CAST(CAST(c_acctbal AS DECIMAL(15,2)) -
               CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'FURNITURE') THEN 500 ELSE 0 END AS DECIMAL(15,2)) AS balance FROM customer""",
    "savings": "SELECT account_number, CAST(1.5 AS DECIMAL(5,2)) AS interest_rate FROM account WHERE account_type = 'Savings'",
    "checking": "SELECT account_number, CAST(500 AS DECIMAL(10,2)) AS overdraft_amount FROM account WHERE account_type = 'Checking'",
    "customer_account": """
        SELECT c_custkey AS customer_id, c_custkey AS account_number FROM customer
        UNION ALL SELECT c_custkey + 1, c_custkey FROM customer WHERE c_mktsegment = 'FURNITURE'""",
    "loan": """
        SELECT o_orderkey AS loan_number, CAST(o_totalprice AS DECIMAL(15,2)) AS amount, n_name AS branch_name
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "customer_loan": "SELECT o_custkey AS customer_id, o_orderkey AS loan_number FROM orders",
    "loan_payment": """
        SELECT l_orderkey AS loan_number, l_linenumber AS payment_number, CAST(l_shipdate AS DATE) AS payment_date,
               CAST(CAST(l_extendedprice AS DECIMAL(15,2)) * CAST(0.1 AS DECIMAL(2,1)) AS DECIMAL(15,2)) AS payment_amount
        FROM lineitem""",
    "applications": """
        SELECT s_suppkey AS application_id, CASE WHEN s_suppkey % 2 = 0 THEN 'Individual' ELSE 'Business' END AS customer_type,
               s_name AS name, lpad(CAST(s_suppkey AS VARCHAR), 9, '0') AS ssn,
               'Nation ' || CAST(s_nationkey AS VARCHAR) AS address, CAST(s_acctbal AS DECIMAL(15,2)) AS opening_balance
        FROM supplier""",
    "loan_requests": """
        SELECT event_id AS request_id, CASE WHEN event_type = 'error' THEN -user_id - 1 ELSE user_id END AS customer_id,
               'NATION_' || CAST(user_id % 30 AS VARCHAR) AS branch_name FROM events""",
    "uploads": """
        SELECT doc_id AS upload_id,
               CASE WHEN doc_id % 6 = 5 THEN 'channel_' || doc_id || '.csv'
                    ELSE 'file ' || doc_id || CASE doc_id % 6 WHEN 0 THEN '.csv' WHEN 1 THEN '.mat' WHEN 2 THEN '.pcd'
                         WHEN 3 THEN '.bin' ELSE '.txt' END END AS filename,
               n_chars AS file_size, sha256(text) AS file_hash, source AS user_id,
               CASE WHEN doc_id % 4 <> 0 THEN upper(left(source, 1)) || substr(source, 2) || ' O''Neil' END AS owner_name,
               source || '.x@Example.org' AS owner_email, CASE WHEN doc_id % 13 <> 0 THEN lang END AS dataset,
               TIMESTAMP '2024-01-01' + to_minutes(doc_id) AS upload_time_utc
        FROM documents""",
    "files": """
        SELECT upload_id, filename, file_size, file_hash, user_id || '/' || filename AS file_path,
               regexp_extract(filename, '[^.]*$') AS file_extension,
               CASE upload_id % 6 WHEN 0 THEN 'tabular' WHEN 1 THEN 'matlab' WHEN 2 THEN 'lidar' WHEN 3 THEN 'radar'
                    WHEN 4 THEN 'unknown' ELSE 'wifi' END AS modality,
               user_id, dataset AS dataset_name, upload_time_utc, file_size > 30000 AS is_deleted FROM uploads""",
    "lineage": """
        SELECT doc_id AS bronze_file_id, 'ingestion' AS transformation_type,
               CASE WHEN toxic = 1 THEN 'failed' ELSE 'success' END AS status FROM labels""",
    "file_quality": """
        SELECT doc_id AS upload_id, CAST(quality AS DOUBLE) AS score, toxic = 1 AS has_format_error FROM labels""",
    "gps_updates": """
        SELECT event_id, CAST(user_id % 50 AS INTEGER) AS route_no, ts,
               CASE WHEN event_id % 17 = 0 THEN '' WHEN event_id % 19 = 0 THEN 'n/a' WHEN island THEN '0.0'
                    ELSE CAST(CAST(value - 90 AS DECIMAL(9,4)) AS VARCHAR) END AS lat,
               CASE WHEN island THEN '0.0' ELSE CAST(CAST(value * 1.5::DOUBLE - 180 AS DECIMAL(9,4)) AS VARCHAR) END AS lon
        FROM (SELECT *, event_type = 'error' AND event_id % 5 = 0 AS island FROM events)""",
    "gps_checked": """
        SELECT *, CASE WHEN lat IS NULL OR lon IS NULL OR lat = '' OR lon = '' THEN 'empty'
                       WHEN y IS NULL OR x IS NULL THEN 'not_a_number' WHEN y = 0 AND x = 0 THEN 'null_island'
                       WHEN NOT (y BETWEEN -90 AND 90 AND x BETWEEN -180 AND 180) THEN 'out_of_bounds' ELSE 'ok' END AS reason
        FROM (SELECT *, TRY_CAST(trim(lat) AS DOUBLE) AS y, TRY_CAST(trim(lon) AS DOUBLE) AS x FROM gps_updates)""",
    "routes": """
        SELECT CAST(n_nationkey AS INTEGER) AS route_no, 'Driver ' || CAST(n_nationkey % 7 AS VARCHAR) AS driver_name,
               n_name AS source, CAST(CAST(n_nationkey AS DECIMAL(9,4)) AS VARCHAR) AS source_lat,
               CAST(CAST(-n_nationkey AS DECIMAL(9,4)) AS VARCHAR) AS source_long,
               'Region ' || CAST(n_regionkey AS VARCHAR) AS destination FROM nation""",
    "eye_pixels": """
        SELECT vec_id AS frame_id, k // 8 AS i, k % 8 AS j, 75.0::DOUBLE + CAST(embedding[k + 1] AS DOUBLE) * 200.0::DOUBLE AS intensity
        FROM embeddings, (SELECT unnest(range(64)) AS k)""",
    "gaze_counts": """
        SELECT frame_id, count(*) FILTER (dark AND j * 3 < 8) AS dark_left,
               count(*) FILTER (dark AND NOT (j * 3 < 8) AND NOT (j * 3 > 16)) AS dark_centre,
               count(*) FILTER (dark AND j * 3 > 16) AS dark_right, count(*) FILTER (dark AND i * 3 < 8) AS dark_top,
               count(*) FILTER (dark AND NOT (i * 3 < 8) AND NOT (i * 3 > 16)) AS dark_middle,
               count(*) FILTER (dark AND i * 3 > 16) AS dark_bottom
        FROM (SELECT *, intensity <= 75 AS dark FROM eye_pixels) GROUP BY 1""",
    "blink_frames": """
        SELECT event_id % 5 AS stream, event_id // 5 AS frame, CAST(min(CASE WHEN value > 40 THEN 0 ELSE 10 END) AS BIGINT) AS dark
        FROM events GROUP BY 1, 2""",
    "blink_runs": """
        SELECT stream, min(frame) AS first_position, max(frame) AS last_position, count(*) AS run_length
        FROM (SELECT stream, frame, frame - row_number() OVER (PARTITION BY stream ORDER BY frame) AS g
              FROM blink_frames WHERE dark = 0) GROUP BY stream, g""",
    "apartments": """
        SELECT p_name AS "Title",
               CASE p_size % 8 WHEN 0 THEN '$' || price WHEN 1 THEN grouped WHEN 2 THEN '$' || price || ' – $' || (price + 300)
                    WHEN 3 THEN price || '-' || (price + 50) WHEN 4 THEN 'Call for Rent' WHEN 5 THEN grouped || '+' WHEN 6 THEN '' END AS "Price",
               p_size || ' Main St, Springfield NY ' || (14200 + p_partkey % 20) AS "Address",
               CASE p_partkey % 7 WHEN 0 THEN 'Studio' WHEN 1 THEN '1 Bed' WHEN 2 THEN '2 Beds' WHEN 3 THEN 'Studio – 2 Beds'
                    WHEN 4 THEN '1-3 Beds' WHEN 6 THEN 'No beds info' END AS "Beds",
               'https://a.example/' || p_partkey AS "URL", p_partkey AS arrival
        FROM (SELECT *, '$' || (price // 1000) || ',' || lpad(CAST(price % 1000 AS VARCHAR), 3, '0') AS grouped
              FROM (SELECT *, CAST(floor(p_retailprice) AS BIGINT) AS price FROM part))""",
    "padmapper": """
        SELECT (o_orderkey % 5000) || ' Elm St' AS address,
               CASE o_orderkey % 4 WHEN 0 THEN '$' || price WHEN 1 THEN '$' || price || ' – $' || (price + 99) WHEN 2 THEN 'No price' END AS price,
               CASE o_orderkey % 5 WHEN 0 THEN '1–2' WHEN 1 THEN 'Studio' WHEN 2 THEN '3 ' WHEN 3 THEN '' ELSE '2' END AS bedrooms,
               'Area, Springfield ' || (14200 + o_orderkey % 25) AS area, 'https://p.example/' || o_orderkey AS url
        FROM (SELECT *, CAST(floor(o_totalprice / 100) AS BIGINT) AS price FROM orders)""",
    "listing_details": """
        SELECT o_orderkey AS listing_id,
               CASE o_orderkey % 4 WHEN 0 THEN (o_orderkey % 3 + 1) || '–4 Bedrooms Apartments · ' || o_orderpriority || ', Springfield'
                    WHEN 1 THEN 'Studio Apartment · ' || o_orderstatus || ' Park' WHEN 2 THEN 'House ' || o_orderstatus
                    ELSE '1 Bedroom Condo · ' || o_orderstatus || ' · top' END AS detail FROM orders""",
    "income": "SELECT CAST(14195 + n_nationkey AS VARCHAR) AS zip, CAST(30000 + 1000 * n_nationkey AS BIGINT) AS median_income FROM nation",
    "apartments_ranged": None,
    "padmapper_ranged": None,
    "event_texts": """
        SELECT event_id AS pos, unnest(['event_id', 'ts', 'user_id', 'event_type', 'value', 'props']) AS column_name,
               unnest([CAST(event_id AS VARCHAR), CAST(ts AS VARCHAR), CAST(user_id AS VARCHAR), event_type, CAST(value AS VARCHAR), props]) AS value
        FROM events""",
    "label_texts": """
        SELECT doc_id AS pos, unnest(['doc_id', 'quality', 'toxic']) AS column_name,
               unnest([CAST(doc_id AS VARCHAR), CAST(quality AS VARCHAR), CAST(toxic AS VARCHAR)]) AS value FROM labels""",
    "document_texts": """
        SELECT doc_id AS pos, unnest(['doc_id', 'text', 'lang', 'source', 'n_chars']) AS column_name,
               unnest([CAST(doc_id AS VARCHAR), text, lang, source, CAST(n_chars AS VARCHAR)]) AS value FROM documents""",
}


def range_columns(source: str, low: str, high: str, is_price: bool, frame: str) -> str:
    """``frame`` plus ``low`` and ``high`` parsed from the text column ``source``."""
    symbols = "[$,]" if is_price else "a^"
    number = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?$"
    return f"""
        SELECT * EXCLUDE (cleaned, sep, l, r, a, b), CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN a END AS {low},
               CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN b END AS {high}
        FROM (SELECT *, CASE WHEN regexp_matches(l, '{number}') THEN CAST(l AS DOUBLE) END AS a,
                     CASE WHEN regexp_matches(r, '{number}') THEN CAST(r AS DOUBLE) END AS b
              FROM (SELECT *, CASE WHEN contains(cleaned, sep) THEN split_part(cleaned, sep, 1) ELSE cleaned END AS l,
                           CASE WHEN contains(cleaned, sep) THEN substr(cleaned, strpos(cleaned, sep) + 1) ELSE cleaned END AS r
                    FROM (SELECT *, CASE WHEN contains(cleaned, '–') THEN '–' ELSE '-' END AS sep
                          FROM (SELECT *, replace(replace(regexp_replace(regexp_replace(lower(trim({source})), '{symbols}', '', 'g'),
                                       'beds|bed', '', 'g'), 'studio', '0'), ' ', '') AS cleaned FROM {frame}))))"""


SQL_FRAMES["apartments_ranged"] = range_columns(
    '"Beds"', "beds_min", "beds_max", False, "(" + range_columns('"Price"', "price_min", "price_max", True, "apartments") + ")"
)
SQL_FRAMES["padmapper_ranged"] = range_columns(
    "bedrooms", "beds_min", "beds_max", False, "(" + range_columns("price", "price_min", "price_max", True, "padmapper") + ")"
)


def with_frames(body: str) -> str:
    """``body`` preceded by the frames it names, directly or through others."""
    needed: set[str] = set()

    def visit(sql: str) -> None:
        for name, text in SQL_FRAMES.items():
            if name not in needed and re.search(rf"(FROM|JOIN)\s*\(*\s*{name}\b", sql):
                needed.add(name)
                visit(text)

    visit(body)
    ordered = _in_order(needed)
    if not ordered:
        return body
    frames = ",\n".join(f"{name} AS ({SQL_FRAMES[name].strip()})" for name in ordered)
    body = body.strip()
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {frames},\n{body[15:]}"
    if body.upper().startswith("WITH "):
        return f"WITH {frames},\n{body[5:]}"
    return f"WITH {frames}\n{body}"


def _in_order(names: set[str]) -> list[str]:
    placed: list[str] = []

    def place(name: str) -> None:
        if name in placed:
            return
        for other in names:
            if other != name and re.search(rf"(FROM|JOIN)\s*\(*\s*{other}\b", SQL_FRAMES[name]):
                place(other)
        placed.append(name)

    for name in sorted(names):
        place(name)
    return placed


def pct(top: str, bottom: str, places: int = 1) -> str:
    """A percentage rounded through a decimal."""
    return (
        f"CAST(round(CAST(CAST({top} AS DOUBLE) / nullif(CAST({bottom} AS DOUBLE), 0) * 100 AS DECIMAL(28,8)), {places}) AS DOUBLE)"
    )


def avg_money(column: str) -> str:
    return f"CAST(round(CAST(CAST(sum({column}) AS DOUBLE) / nullif(count({column}), 0) AS DECIMAL(28,8)), 2) AS DECIMAL(18,2))"


def dec(expr: str, kind: str = "DECIMAL(18,2)") -> str:
    return f"CAST({expr} AS {kind})"


def wide_key(expr: str) -> str:
    """The first 60 bits of the SHA-256 digest."""
    return f"CAST('0x' || substr(sha256({expr}), 1, 15) AS BIGINT)"


def hash_mod(expr: str) -> str:
    """The SHA-256 digest modulo 10^9, folded over its eight 32-bit pieces."""
    pieces = f"[CAST('0x' || substr(sha256({expr}), 1 + 8 * i, 8) AS BIGINT) for i in range(8)]"
    return f"list_reduce(list_concat([CAST(0 AS BIGINT)], {pieces}), lambda a, x: (a * 4294967296 + x) % 1000000000)"
