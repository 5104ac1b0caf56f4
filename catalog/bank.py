"""Bank: reports, integrity, alerts, batch openings."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.operators import allocate, integrity, merge
from ledgerloom.plans import bank, catalogue

from .registry import query

BRANCH_LOANS = """
    SELECT branch_name, customer_id, (SELECT customer_type FROM bank_customer k WHERE k.customer_id = held.customer_id) AS customer_type, amount
    FROM (SELECT * FROM customer_loan JOIN loan USING (loan_number)) held
    WHERE branch_name IN (SELECT branch_name FROM branch) AND customer_id IN (SELECT customer_id FROM bank_customer)"""

BANKER_ASSETS = """
    SELECT personal_banker_ssn, (SELECT name FROM employee w WHERE w.ssn = personal_banker_ssn) AS banker_name, customer_id, account_number, balance
    FROM (SELECT * FROM customer_account JOIN account USING (account_number)) owned
    JOIN (SELECT customer_id, personal_banker_ssn FROM individual WHERE personal_banker_ssn IN (SELECT ssn FROM employee)) advised USING (customer_id)"""

LOAN_DEBT = """
    WITH paid AS (SELECT loan_number, sum(payment_amount) AS done FROM loan_payment GROUP BY 1)
    SELECT loan_number, branch_name, CAST(amount - coalesce(done, 0) AS DECIMAL(18,2)) AS debt FROM loan LEFT JOIN paid USING (loan_number)"""


@query("branch_loans", BRANCH_LOANS)
def branch_loans(frames):
    return bank.branch_loans(frames.branch, frames.loan, frames.customer_loan, frames.bank_customer)


@query(
    "branch_loan_summary",
    """SELECT b.branch_name, count(loan_number) AS loan_count, CAST(coalesce(sum(amount), 0) AS DECIMAL(18,2)) AS total_amount,
              CAST(round(CAST(CAST(sum(amount) AS DOUBLE) / nullif(count(loan_number), 0) AS DECIMAL(28,8)), 2) AS DECIMAL(18,2)) AS avg_amount
       FROM branch b LEFT JOIN loan l ON b.branch_name = l.branch_name GROUP BY 1""",
)
def branch_loan_summary(frames):
    return bank.branch_loan_summary(frames.branch, frames.loan)


@query("banker_assets_join", BANKER_ASSETS)
def banker_assets_join(frames):
    return bank.banker_assets_join(frames.employee, frames.individual, frames.customer_account, frames.account)


@query(
    "top_bankers_by_assets",
    f"""SELECT personal_banker_ssn, banker_name, CAST(sum(balance) AS DECIMAL(18,2)) AS managed_assets FROM ({BANKER_ASSETS})
        GROUP BY 1, 2 ORDER BY 3 DESC, 1 LIMIT 5""",
)
def top_bankers_by_assets(frames):
    return bank.top_bankers_by_assets(frames.employee, frames.individual, frames.customer_account, frames.account)


@query(
    "top_bankers_distinct_accounts",
    f"""SELECT personal_banker_ssn, banker_name, CAST(sum(balance) AS DECIMAL(18,2)) AS managed_assets
        FROM (SELECT DISTINCT personal_banker_ssn, banker_name, account_number, balance FROM ({BANKER_ASSETS}))
        GROUP BY 1, 2 ORDER BY 3 DESC, 1 LIMIT 5""",
)
def top_bankers_distinct_accounts(frames):
    return bank.top_bankers_by_assets(
        frames.employee, frames.individual, frames.customer_account, frames.account, distinct_accounts=True
    )


@query("loan_debt_join", LOAN_DEBT)
def loan_debt_join(frames):
    return bank.loan_debt_join(frames.loan, frames.loan_payment)


@query("top_debt_loans", f"SELECT * FROM ({LOAN_DEBT}) ORDER BY debt DESC, loan_number LIMIT 5")
def top_debt_loans(frames):
    return bank.top_debt_loans(frames.loan, frames.loan_payment)


@query(
    "employee_manager",
    """SELECT e.ssn, e.name, e.manager_ssn, m.name AS manager_name FROM employee e LEFT JOIN employee m ON e.manager_ssn = m.ssn""",
)
def employee_manager(frames):
    return bank.employee_manager(frames.employee)


@query(
    "customer_subtypes",
    """SELECT c.customer_id, customer_type, coalesce(i.name, b.business_name) AS display_name,
              CASE WHEN customer_type = 'Individual' THEN i.customer_id IS NOT NULL AND b.customer_id IS NULL
                   ELSE b.customer_id IS NOT NULL AND i.customer_id IS NULL END AS exactly_one
       FROM bank_customer c LEFT JOIN individual i ON c.customer_id = i.customer_id LEFT JOIN business b ON c.customer_id = b.customer_id""",
)
def customer_subtypes(frames):
    return bank.customer_subtypes(frames.bank_customer, frames.individual, frames.business)


@query(
    "account_subtypes",
    """SELECT a.account_number, account_type, balance, interest_rate, overdraft_amount
       FROM account a LEFT JOIN savings s ON a.account_number = s.account_number
       LEFT JOIN checking c ON a.account_number = c.account_number""",
)
def account_subtypes(frames):
    return bank.account_subtypes(frames.account, frames.savings, frames.checking)


def _bank_frames(frames):
    names = (
        "employee", "individual", "business", "account", "savings", "checking", "customer_account", "branch", "loan", "customer_loan", "loan_payment",
        "dependent",
    )
    return {"customer": frames.bank_customer, **{name: getattr(frames, name) for name in names}}


def _orphans(name: str, child: str, column: str, parent: str, parent_column: str) -> str:
    return f"""SELECT '{name}' AS foreign_key, count(*) AS orphan_rows, count(DISTINCT {column}) AS orphan_values FROM {child}
               WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {parent_column} FROM {parent})"""


# Written out apart from the library's own list, so that a key missing there shows.
BANK_KEYS = (
    ("employee.manager_ssn", "employee", "manager_ssn", "employee", "ssn"),
    ("dependent.employee_ssn", "dependent", "employee_ssn", "employee", "ssn"),
    ("individual.customer_id", "individual", "customer_id", "bank_customer", "customer_id"),
    ("individual.personal_banker_ssn", "individual", "personal_banker_ssn", "employee", "ssn"),
    ("business.customer_id", "business", "customer_id", "bank_customer", "customer_id"),
    ("savings.account_number", "savings", "account_number", "account", "account_number"),
    ("checking.account_number", "checking", "account_number", "account", "account_number"),
    ("customer_account.customer_id", "customer_account", "customer_id", "bank_customer", "customer_id"),
    ("customer_account.account_number", "customer_account", "account_number", "account", "account_number"),
    ("loan.branch_name", "loan", "branch_name", "branch", "branch_name"),
    ("customer_loan.customer_id", "customer_loan", "customer_id", "bank_customer", "customer_id"),
    ("customer_loan.loan_number", "customer_loan", "loan_number", "loan", "loan_number"),
    ("loan_payment.loan_number", "loan_payment", "loan_number", "loan", "loan_number"),
)
CATALOGUE_KEYS = (
    ("file.user_id", "files", "user_id", "users", "user_id"),
    ("daily_uploads.user_id", "(SELECT DISTINCT CAST(upload_time_utc AS DATE) AS date, user_id, modality FROM files)", "user_id", "users", "user_id"),
    ("researcher_stats.user_id", "(SELECT DISTINCT user_id FROM files)", "user_id", "users", "user_id"),
    ("lineage.bronze_file_id", "lineage_steps", "bronze_file_id", "files", "upload_id"),
    ("lineage.silver_aggregation_id", "lineage_steps", "silver_aggregation_id", "silver", "silver_id"),
)


@query("fk_violations", " UNION ALL ".join(_orphans(*key) for key in BANK_KEYS))
def fk_violations(frames):
    return integrity.fk_violations(_bank_frames(frames), bank.FOREIGN_KEYS)


@query("fk_violations_catalogue", " UNION ALL ".join(_orphans(*key) for key in CATALOGUE_KEYS))
def fk_violations_catalogue(frames):
    tables = {
        "file": frames.files, "user": frames.users, "lineage": frames.lineage_steps, "silver": frames.silver,
        "daily_uploads": catalogue.gold_daily_uploads(frames.files), "researcher_stats": catalogue.gold_researcher_stats(frames.files, frames.file_quality),
    }
    return integrity.fk_violations(tables, catalogue.FOREIGN_KEYS)


ALERT = "'Alert: Account ' || account_number || ' balance dropped below $1000. Interest rate may change.'"
CHANGED = "account a JOIN account_after b USING (account_number) WHERE a.balance IS DISTINCT FROM b.balance AND b.balance < 1000"


@query("low_balance_alerts", f"SELECT account_number, b.balance AS balance, {ALERT} AS message FROM {CHANGED}")
def low_balance_alerts(frames):
    return bank.low_balance_alerts(frames.account, frames.account_after)


@query(
    "low_balance_crossings",
    f"SELECT account_number, b.balance AS balance, {ALERT} AS message FROM {CHANGED} AND (a.balance IS NULL OR a.balance >= 1000)",
)
def low_balance_crossings(frames):
    return bank.low_balance_alerts(frames.account, frames.account_after, on_crossing_only=True)


AUDIT = """SELECT ssn, 'Manager changed for Employee ' || ssn || ' from ' || coalesce(a.manager_ssn, 'none') || ' to ' ||
           coalesce(b.manager_ssn, 'none') AS message FROM employee a JOIN employee_after b USING (ssn)
           WHERE a.manager_ssn {test} b.manager_ssn"""


@query("manager_change_audit", AUDIT.format(test="<>"))
def manager_change_audit(frames):
    return bank.manager_change_audit(frames.employee, frames.employee_after)


@query("manager_change_audit_null_safe", AUDIT.format(test="IS DISTINCT FROM"))
def manager_change_audit_null_safe(frames):
    return bank.manager_change_audit(frames.employee, frames.employee_after, null_safe=True)


@query(
    "allocate_sequence_ids",
    """SELECT event_id, (SELECT max(account_number) FROM account) + row_number() OVER (ORDER BY event_id) AS account_number FROM events""",
)
def allocate_sequence_ids(frames):
    new = frames.table("events").select("event_id")
    return allocate.allocate_sequence_ids(new, "event_id", frames.account, "account_number", 1000)


@query(
    "open_accounts_batch",
    """WITH o AS (SELECT *, (SELECT max(customer_id) FROM bank_customer) + row_number() OVER (ORDER BY application_id) AS new_customer,
                         (SELECT max(account_number) FROM account) + row_number() OVER (ORDER BY application_id) AS new_account
                  FROM applications)
       SELECT new_customer AS customer_id, customer_type, address, new_account AS account_number, name AS display_name,
              CASE WHEN customer_type = 'Individual' THEN CAST(1000 AS DECIMAL(15,2)) ELSE opening_balance END AS balance,
              CASE WHEN customer_type = 'Individual' THEN 'Savings' ELSE 'Business' END AS account_type,
              CASE WHEN customer_type = 'Individual' THEN CAST(1.5 AS DECIMAL(5,2)) END AS interest_rate FROM o""",
)
def open_accounts_batch(frames):
    """All rows the batch adds, put together again by their keys."""
    added = bank.open_accounts_batch(frames.applications, frames.bank_customer, frames.account)
    people = added["individual"].select("customer_id", "name")
    firms = added["business"].select("customer_id", F.col("business_name").alias("name"))
    return (
        added["customer"].join(added["customer_account"], "customer_id")
        .join(added["account"], "account_number")
        .join(added["savings"], "account_number", "left")
        .join(people.unionByName(firms).withColumnRenamed("name", "display_name"), "customer_id")
    )


LOAN_CHECK = """
    SELECT request_id, r.customer_id, r.branch_name,
           CASE WHEN r.customer_id NOT IN (SELECT customer_id FROM bank_customer) THEN 'unknown_customer'
                WHEN r.branch_name NOT IN (SELECT branch_name FROM branch) THEN 'unknown_branch' END AS reason
    FROM loan_requests r"""


@query(
    "issue_loans_batch",
    f"""SELECT request_id, (SELECT max(loan_number) FROM loan) + row_number() OVER (ORDER BY request_id) AS loan_number,
               customer_id, branch_name, CAST(20000 AS DECIMAL(15,2)) AS amount FROM ({LOAN_CHECK}) WHERE reason IS NULL""",
)
def issue_loans_batch(frames):
    return bank.issue_loans_batch(frames.loan_requests, frames.bank_customer, frames.branch, frames.loan)[0]


@query("issue_loans_refused", f"SELECT * FROM ({LOAN_CHECK}) WHERE reason IS NOT NULL")
def issue_loans_refused(frames):
    return bank.issue_loans_batch(frames.loan_requests, frames.bank_customer, frames.branch, frames.loan)[1]


@query(
    "user_activation",
    """SELECT s_suppkey AS user_id, s_suppkey IN (SELECT user_id FROM events WHERE event_type = 'signup') AS is_active FROM supplier
       UNION ALL SELECT DISTINCT user_id, true FROM events
       WHERE event_type = 'signup' AND user_id NOT IN (SELECT s_suppkey FROM supplier)""",
)
def user_activation(frames):
    """Suppliers are registered inactive; a signup event activates, and adds who is missing."""
    registered = frames.table("supplier").select(F.col("s_suppkey").alias("user_id"), F.lit(False).alias("is_active"))
    signups = frames.table("events").where(F.col("event_type") == "signup")
    active = signups.select("user_id").distinct().withColumn("is_active", F.lit(True))
    return merge.merge_upsert(registered, active, "user_id", ["is_active"])
