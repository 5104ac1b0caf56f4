"""Bank reports, alerts, audits and batch openings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.allocate import allocate_sequence_ids
from ..operators.integrity import ForeignKey, updated_rows
from ..operators.rows import top_n

# Limits, opening terms and first numbers.
LOW_BALANCE = 1000
SAVINGS_OPENING, SAVINGS_RATE = "1000.00", "1.50"
LOAN_AMOUNT = "20000.00"
SAVINGS_BASE, BUSINESS_BASE, LOAN_BASE, CUSTOMER_BASE = 1000, 2000, 5000, 0
MONEY15 = "decimal(15,2)"

FOREIGN_KEYS = tuple(
    ForeignKey(f"{child}.{column}", child, column, parent, parent_column)
    for child, column, parent, parent_column in (
        ("employee", "manager_ssn", "employee", "ssn"),
        ("individual", "customer_id", "customer", "customer_id"),
        ("individual", "personal_banker_ssn", "employee", "ssn"),
        ("business", "customer_id", "customer", "customer_id"),
        ("savings", "account_number", "account", "account_number"),
        ("checking", "account_number", "account", "account_number"),
        ("customer_account", "customer_id", "customer", "customer_id"),
        ("customer_account", "account_number", "account", "account_number"),
        ("loan", "branch_name", "branch", "branch_name"),
        ("customer_loan", "customer_id", "customer", "customer_id"),
        ("customer_loan", "loan_number", "loan", "loan_number"),
        ("loan_payment", "loan_number", "loan", "loan_number"),
        ("dependent", "employee_ssn", "employee", "ssn"),
    )
)


def branch_loans(branch: DataFrame, loan: DataFrame, customer_loan: DataFrame, customer: DataFrame) -> DataFrame:
    return (
        branch.select("branch_name")
        .join(loan, "branch_name")
        .join(customer_loan, "loan_number")
        .join(customer.select("customer_id", "customer_type"), "customer_id")
        .select("branch_name", "customer_id", "customer_type", "amount")
    )


def branch_loan_summary(branch: DataFrame, loan: DataFrame) -> DataFrame:
    """Count, total and average per branch, branches without loans included."""
    totals = loan.groupBy("branch_name").agg(F.count("loan_number").alias("loans"), F.sum("amount").alias("total"))
    total = F.coalesce("total", F.lit(0)).cast("decimal(18,2)")
    count = F.coalesce("loans", F.lit(0))
    average = F.try_divide(F.col("total").cast("double"), F.col("loans").cast("double"))
    return branch.join(totals, "branch_name", "left").select(
        "branch_name",
        count.alias("loan_count"),
        total.alias("total_amount"),
        F.round(average.cast("decimal(28,8)"), 2).cast("decimal(18,2)").alias("avg_amount"),
    )


def banker_assets_join(employee: DataFrame, individual: DataFrame, customer_account: DataFrame, account: DataFrame) -> DataFrame:
    """One row per banker, customer and account; a joint account appears once per holder."""
    return (
        individual.where(F.col("personal_banker_ssn").isNotNull())
        .join(customer_account, "customer_id")
        .join(account.select("account_number", "balance"), "account_number")
        .join(employee.select(F.col("ssn").alias("personal_banker_ssn"), F.col("name").alias("banker_name")), "personal_banker_ssn")
        .select("personal_banker_ssn", "banker_name", "customer_id", "account_number", "balance")
    )


def top_bankers_by_assets(
    employee: DataFrame, individual: DataFrame, customer_account: DataFrame, account: DataFrame,
    n: int = 5, distinct_accounts: bool = False,
) -> DataFrame:
    """Bankers by the balances of their customers' accounts; with ``distinct_accounts`` a joint account counts once a banker.

    Balances are summed per customer, and these per banker, before names are joined.
    """
    held = customer_account.select("customer_id", "account_number").join(account.select("account_number", "balance"), "account_number")
    served = individual.where(F.col("personal_banker_ssn").isNotNull()).select("customer_id", "personal_banker_ssn")
    if distinct_accounts:
        rows = held.join(served, "customer_id").select("personal_banker_ssn", "account_number", "balance").distinct()
    else:
        rows = held.groupBy("customer_id").agg(F.sum("balance").alias("balance")).join(served, "customer_id")
    totals = rows.groupBy("personal_banker_ssn").agg(F.sum("balance").cast("decimal(18,2)").alias("managed_assets"))
    named = totals.join(employee.select(F.col("ssn").alias("personal_banker_ssn"), F.col("name").alias("banker_name")), "personal_banker_ssn")
    return top_n(named.select("personal_banker_ssn", "banker_name", "managed_assets"), n, F.col("managed_assets").desc(), F.col("personal_banker_ssn"))


def loan_debt_join(loan: DataFrame, payment: DataFrame) -> DataFrame:
    """Remaining debt of every loan; payments are summed per loan before the join."""
    paid = payment.groupBy("loan_number").agg(F.sum("payment_amount").alias("_paid"))
    return loan.join(paid, "loan_number", "left").select(
        "loan_number",
        "branch_name",
        (F.col("amount") - F.coalesce("_paid", F.lit(0))).cast("decimal(18,2)").alias("debt"),
    )


def top_debt_loans(loan: DataFrame, payment: DataFrame, n: int = 5) -> DataFrame:
    return top_n(loan_debt_join(loan, payment), n, F.col("debt").desc(), F.col("loan_number"))


def employee_manager(employee: DataFrame) -> DataFrame:
    manager = employee.select(F.col("ssn").alias("manager_ssn"), F.col("name").alias("manager_name"))
    return employee.select("ssn", "name", "manager_ssn").join(manager, "manager_ssn", "left").select(
        "ssn", "name", "manager_ssn", "manager_name"
    )


def customer_subtypes(customer: DataFrame, individual: DataFrame, business: DataFrame) -> DataFrame:
    """Every customer with its detail; ``exactly_one`` tells whether the detail fits the type."""
    people = individual.select("customer_id", F.col("name").alias("_person"), F.lit(True).alias("_is_person"))
    firms = business.select("customer_id", F.col("business_name").alias("_firm"), F.lit(True).alias("_is_firm"))
    joined = customer.join(people, "customer_id", "left").join(firms, "customer_id", "left")
    person, firm = F.coalesce("_is_person", F.lit(False)), F.coalesce("_is_firm", F.lit(False))
    fits = F.when(F.col("customer_type") == "Individual", person & ~firm).otherwise(firm & ~person)
    return joined.select("customer_id", "customer_type", F.coalesce("_person", "_firm").alias("display_name"), fits.alias("exactly_one"))


def account_subtypes(account: DataFrame, savings: DataFrame, checking: DataFrame) -> DataFrame:
    return (
        account.join(savings, "account_number", "left")
        .join(checking, "account_number", "left")
        .select("account_number", "account_type", "balance", "interest_rate", "overdraft_amount")
    )


def low_balance_message(account: Column) -> Column:
    return F.concat(
        # The message texts here and in the audit below.
        F.lit("Alert: Account "), account.cast("string"),
        F.lit(" balance dropped below $1000. Interest rate may change."),
    )


def is_low(new: Column, old: Column | None = None, on_crossing_only: bool = False) -> Column:
    low = new < LOW_BALANCE
    return low & (old.isNull() | (old >= LOW_BALANCE)) if on_crossing_only else low


def low_balance_alerts(old: DataFrame, new: DataFrame, on_crossing_only: bool = False) -> DataFrame:
    """A message per updated account below 1000, or only where it fell below it."""
    changed = updated_rows(old, new, "account_number", "balance")
    low = changed.where(is_low(F.col("new_value"), F.col("old_value"), on_crossing_only))
    return low.select(
        "account_number",
        F.col("new_value").alias("balance"),
        low_balance_message(F.col("account_number")).alias("message"),
    )


def manager_change_audit(old: DataFrame, new: DataFrame, null_safe: bool = False) -> DataFrame:
    """A message per changed manager. Without ``null_safe`` a change from or to none is not logged."""
    changed = updated_rows(old, new, "ssn", "manager_ssn")
    if not null_safe:
        changed = changed.where(F.col("old_value").isNotNull() & F.col("new_value").isNotNull())
    shown = [F.coalesce(c, F.lit("none")) for c in ("old_value", "new_value")]
    message = F.concat(
        F.lit("Manager changed for Employee "), F.col("ssn"), F.lit(" from "), shown[0], F.lit(" to "), shown[1]
    )
    return changed.select("ssn", message.alias("message"))


def open_accounts_batch(applications: DataFrame, customers: DataFrame, accounts: DataFrame) -> dict[str, DataFrame]:
    """Rows of all tables that a batch of applications adds.

    ``applications(application_id, customer_type, name, ssn, address, opening_balance)``.
    Savings open at a fixed amount and rate, business accounts at the amount stated.
    """
    known = allocate_sequence_ids(applications, "application_id", customers, "customer_id", CUSTOMER_BASE)
    individual = F.col("customer_type") == "Individual"
    # An empty account table starts from the base of the first application's kind.
    first_base = F.min_by(F.when(individual, SAVINGS_BASE).otherwise(BUSINESS_BASE), "application_id")
    base = applications.agg(first_base.alias("base")).scalar()
    opened = allocate_sequence_ids(known, "application_id", accounts, "account_number", base)
    balance = F.when(individual, F.lit(SAVINGS_OPENING).cast(MONEY15)).otherwise(F.col("opening_balance").cast(MONEY15))
    kind = F.when(individual, "Savings").otherwise("Business")
    people, firms = opened.where(individual), opened.where(~individual)
    return {
        "customer": opened.select("customer_id", "customer_type", "address"),
        "individual": people.select("customer_id", "ssn", "name", F.lit(None).cast("string").alias("personal_banker_ssn")),
        "business": firms.select("customer_id", F.col("name").alias("business_name")),
        "account": opened.select("account_number", balance.alias("balance"), kind.alias("account_type")),
        "savings": people.select("account_number", F.lit(SAVINGS_RATE).cast("decimal(5,2)").alias("interest_rate")),
        "customer_account": opened.select("customer_id", "account_number"),
    }


def issue_loans_batch(requests: DataFrame, customers: DataFrame, branches: DataFrame, loans: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Issued loans and refused requests. ``requests(request_id, customer_id, branch_name)``."""
    known_customer = customers.select("customer_id").distinct().withColumn("_customer", F.lit(True))
    known_branch = branches.select("branch_name").distinct().withColumn("_branch", F.lit(True))
    checked = requests.join(known_customer, "customer_id", "left").join(known_branch, "branch_name", "left")
    reason = F.when(F.col("_customer").isNull(), "unknown_customer").when(F.col("_branch").isNull(), "unknown_branch")
    checked = checked.select("request_id", "customer_id", "branch_name", reason.alias("reason"))
    accepted = checked.where(F.col("reason").isNull()).drop("reason")
    issued = allocate_sequence_ids(accepted, "request_id", loans, "loan_number", LOAN_BASE)
    issued = issued.select(
        "request_id", "loan_number", "customer_id", "branch_name", F.lit(LOAN_AMOUNT).cast(MONEY15).alias("amount")
    )
    return issued, checked.where(F.col("reason").isNotNull())
