"""Operators against small brute-force answers, hot keys included."""

import datetime as dt
import itertools
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from ledgerloom.operators import allocate, blinks, integrity, matrices, merge, profile, ranges, rows, running
from ledgerloom.operators.order_stats import exact_percentiles
from ledgerloom.plans import bank, kpi, privacy, views

FEW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
DAY0 = dt.date(2020, 1, 1)


def day(n):
    return DAY0 + dt.timedelta(days=n)


# --- percentiles --------------------------------------------------------------------


@FEW
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=60))
def test_percentiles_equal_numpy(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    points = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}
    got = exact_percentiles(df, F.col("v"), points).first()
    assert [got[k] for k in points] == pytest.approx([float(np.quantile(values, p)) for p in points.values()])


def test_percentiles_with_a_coarse_sketch_and_keys(spark):
    rng = random.Random(1)
    data = [("hot" if i % 3 else "cold", rng.choice([7.0, rng.uniform(0, 1000)])) for i in range(6000)]
    df = spark.createDataFrame(data, "k string, v double").repartition(7)
    got = {r.k: r for r in exact_percentiles(df, F.col("v"), {"m": 0.5, "h": 0.9}, ["k"], accuracy=50).collect()}
    for key in ("hot", "cold"):
        values = [v for k, v in data if k == key]
        assert got[key].m == pytest.approx(np.quantile(values, 0.5))
        assert got[key].h == pytest.approx(np.quantile(values, 0.9))


@pytest.mark.parametrize("ranked,accuracy", [(5, 30), (20, 1000), (100_000, 20_000)])
def test_brackets_are_narrowed(spark, ranked, accuracy):
    """However few values may be ranked; heavy values, ties and both ends."""
    rng = np.random.default_rng(8)
    sets = {"n": rng.normal(size=5000), "t": rng.integers(0, 6, 4000).astype(float), "h": np.concatenate((np.full(3000, 7.0), rng.normal(size=900))), "o": np.array([4.5])}
    rows_ = [(k, float(v)) for k, vs in sets.items() for v in vs]
    df = spark.createDataFrame(rows_, "k string, v double").repartition(6)
    points = {"lo": 0.0, "q": 0.25, "m": 0.5, "h": 0.901, "hi": 1.0}
    for r in exact_percentiles(df, F.col("v"), points, ["k"], accuracy=accuracy, ranked=ranked).collect():
        for name, p in points.items():
            assert r[name] == pytest.approx(float(np.quantile(sets[r.k], p)), rel=1e-12), (r.k, name)


def test_percentile_of_three(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (10.0,)], "v double")
    assert exact_percentiles(df, F.col("v"), {"p": 0.9}).first().p == pytest.approx(8.4)
    assert exact_percentiles(df.limit(0), F.col("v"), {"p": 0.9}).first().p is None


# --- running totals -----------------------------------------------------------------


def brute_runs(frames):
    found = []
    for stream, group in itertools.groupby(sorted(frames), key=lambda f: f[0]):
        last = None
        for _, frame, dark in group:
            if dark == 0 and last and last[2] == frame - 1:
                last[2] = frame
            elif dark == 0:
                last = [stream, frame, frame]
                found.append(last)
    return sorted((s, a, b, b - a + 1) for s, a, b in found)


def brute_toggles(runs):
    found = []
    for stream, group in itertools.groupby(runs, key=lambda r: r[0]):
        in_row, switches, end = 0, 0, None
        for _, first, last, length in group:
            if length >= blinks.HALT_FRAMES:
                in_row = 0
            else:
                in_row = in_row + 1 if end is not None and first - end <= blinks.BLINK_GAP else 1
                if in_row % blinks.SWITCH_BLINKS == 0:
                    switches += 1
                    found.append((stream, last, "OFF" if switches % 2 else "ON"))
            end = last
    return sorted(found)


@pytest.mark.parametrize("width", [7, 64, 100_000])
def test_runs_and_toggles_across_blocks(spark, width):
    rng = random.Random(width)
    frames = [(s, f, 0 if rng.random() < 0.45 else 9) for s in ("a", "b") for f in range(400) if rng.random() < 0.95]
    df = spark.createDataFrame(frames, "stream string, frame bigint, dark bigint")
    runs = running.consecutive_runs(df, ["stream"], "frame", F.col("dark") == 0, width)
    expected = brute_runs(frames)
    assert sorted(map(tuple, runs.select("stream", "first_position", "last_position", "run_length").collect())) == expected
    halts = blinks.blink_halts(df, ["stream"], "frame", "dark", width).select("stream", "halt_frame").collect()
    assert sorted(map(tuple, halts)) == sorted((s, a + 4) for s, a, _, n in expected if n >= 5)
    toggles = blinks.blink_toggles(df, ["stream"], "frame", "dark", width=width).collect()
    assert sorted(map(tuple, toggles)) == brute_toggles(expected)


def test_blink_rules(spark):
    def frames(*runs):
        out, at = [], 0
        for length in runs:
            out += [(1, at + i, 0) for i in range(length)] + [(1, at + length, 5)]
            at += length + 1
        return spark.createDataFrame(out, "stream int, frame bigint, dark bigint")

    assert [r.state for r in blinks.blink_toggles(frames(1, 4, 2, 3), ["stream"], "frame", "dark").collect()] == ["OFF"]
    assert blinks.blink_toggles(frames(1, 1, 1, 5, 1), ["stream"], "frame", "dark").count() == 0
    assert [r.run_length for r in blinks.blink_halts(frames(4, 5, 6, 1), ["stream"], "frame", "dark").orderBy("first_position").collect()] == [5, 6]


@pytest.mark.parametrize("values, expected", [([1, 2, 2, 9], True), ([1, 2, 1, 9], False), ([5], True), ([1, 9, 8, 10], False)])
def test_increasing(spark, values, expected):
    df = spark.createDataFrame([("k", i, float(v)) for i, v in enumerate(values)], "k string, p bigint, v double")
    assert running.is_increasing(df, ["k"], "p", "v", width=2).first().increasing is expected


def test_previous_value_across_blocks(spark):
    data = [("a", i, i * i) for i in (0, 1, 5, 6, 30, 31, 90)] + [("b", 3, 1)]
    df = spark.createDataFrame(data, "k string, p bigint, v bigint")
    got = running.previous_by_block(df, ["k"], running.position_block(F.col("p"), 5), ["p"], "v", "before").collect()
    before = {("a", 0): None, ("a", 1): 0, ("a", 5): 1, ("a", 6): 25, ("a", 30): 36, ("a", 31): 900, ("a", 90): 961, ("b", 3): None}
    assert {(r.k, r.p): r.before for r in got} == before


# --- ids ----------------------------------------------------------------------------


def test_ids_are_consecutive_in_order(spark):
    new = spark.createDataFrame([(i * 37 % 1009,) for i in range(1009)], "a bigint").repartition(5)
    empty = spark.createDataFrame([], "id bigint")
    got = allocate.allocate_sequence_ids(new, "a", empty, "id", 5000).collect()
    assert sorted((r.a, r.id) for r in got) == [(i, 5001 + i) for i in range(1009)]
    used = spark.createDataFrame([(7,), (41,)], "id bigint")
    assert allocate.allocate_sequence_ids(new.where("a < 2"), "a", used, "id", 5000).agg(F.max("id")).first()[0] == 43


@pytest.mark.parametrize("kinds, first", [(("Individual", "Business"), 1001), (("Business", "Individual"), 2001)])
def test_first_account_number_follows_the_first_application(spark, kinds, first):
    schema = "application_id bigint, customer_type string, name string, ssn string, address string, opening_balance decimal(15,2)"
    from decimal import Decimal

    batch = spark.createDataFrame([(i, k, f"n{i}", "s", "a", Decimal("77.50")) for i, k in enumerate(kinds)], schema)
    added = bank.open_accounts_batch(batch, spark.createDataFrame([], "customer_id bigint"), spark.createDataFrame([], "account_number bigint"))
    accounts = added["account"].orderBy("account_number").collect()
    assert [a.account_number for a in accounts] == [first, first + 1]
    assert {a.account_type: str(a.balance) for a in accounts} == {"Savings": "1000.00", "Business": "77.50"}
    assert added["savings"].count() == added["business"].count() == added["individual"].count() == 1


# --- merge and integrity ------------------------------------------------------------


def test_upsert(spark, tmp_path):
    target = spark.createDataFrame([("a", 1, 10), ("b", 2, 20), (None, 9, 90)], "k string, p int, v int")
    source = spark.createDataFrame([("b", 99, None), ("c", 3, 30)], "k string, p int, v int")
    merged = merge.merge_upsert(target, source, "k", ["v"])
    assert sorted(map(tuple, merged.collect()), key=str) == sorted([("a", 1, 10), ("b", 2, None), (None, 9, 90), ("c", 3, 30)], key=str)
    with pytest.raises(merge.DuplicateSourceKeys):
        merge.require_unique(source.unionByName(source), ["k"])


def test_batches_and_watermarks(spark, tmp_path):
    table = merge.BatchTable(spark, str(tmp_path / "t"))
    assert table.read() is None
    for number, values in ((3, [1, 2]), (4, [3]), (3, [1])):
        table.write(spark.createDataFrame([(v,) for v in values], "v int"), number)
    assert sorted(r.v for r in table.read().collect()) == [1, 3]
    assert [r.v for r in table.read(before=4).collect()] == [1] and table.read_batch(4).first().v == 3
    control = spark.createDataFrame([], merge.WATERMARKS)
    mark = lambda c: c.select(merge.watermark_read(c, "a").alias("w")).head()
    assert mark(control) is None
    early, late = dt.datetime(2020, 1, 1, 0, 0, 0, 7), dt.datetime(2020, 1, 2)
    once = merge.watermark_advance(merge.watermark_advance(control, "a", early), "b", early)
    twice = merge.watermark_advance(once, "a", late)
    assert mark(once).w == early and mark(twice).w == late and twice.count() == 2


def test_numbers_do_not_depend_on_gaps(spark):
    new = spark.range(5000).select((F.col("id") * 1_000_003).alias("k")).repartition(5)
    have = spark.createDataFrame([(7,)], "n bigint")
    numbered = allocate.allocate_sequence_ids(new, "k", have, "n", 1)
    assert sorted(tuple(r) for r in numbered.collect()) == [(i * 1_000_003, 8 + i) for i in range(5000)]
    assert sorted(r.n for r in allocate.allocate_sequence_ids(new.limit(0), "k", have, "n", 1).collect()) == []
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    window = plan[plan.index("Window") :]
    assert window.index("HashAggregate") < window.index("Scan parquet")  # one row a range is numbered, not the rows


def test_fact_is_reduced_below_the_dimension_join(spark):
    claims = spark.createDataFrame([(i % 3, i, i, 0) for i in range(9)], "condition_key bigint, total_claim_cost int, payer_coverage int, patient_out_of_pocket int")
    conditions = spark.createDataFrame([(0, "a"), (1, "a"), (2, "b")], "condition_key bigint, condition_category string")
    plan = kpi.claim_cost_by_condition(claims, conditions)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [condition_key" in plan[plan.index("Join") :]


def test_small_staging_leaves_the_target_unshuffled(spark, tmp_path):
    for name, count in (("target", 1000), ("source", 3)):
        spark.range(count).select(F.col("id").alias("k"), F.col("id").alias("v")).write.parquet(str(tmp_path / name))
    target, source = (spark.read.parquet(str(tmp_path / name)) for name in ("target", "source"))
    merged = merge.merge_upsert(target, source, "k", ["v"])
    assert merged.count() == 1000
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_keep_first_limits_rows_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, i) for i in range(100)], "k int, o int").repartition(4)
    first = rows.keep_first_by_key(df, ["k"], [F.col("o")])
    assert [tuple(r) for r in first.collect()] == [(1, 0)]
    assert "WindowGroupLimit" in first._jdf.queryExecution().executedPlan().toString()


def test_foreign_keys_and_reconcile(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,)], "x int")
    parent = spark.createDataFrame([(2,)], "y int")
    fk = integrity.ForeignKey("f", "c", "x", "p", "y")
    assert tuple(integrity.fk_violations({"c": child, "p": parent}, [fk]).first()) == ("f", 2, 1)
    both = integrity.manifest_reconcile(child.where("x is not null"), parent.withColumnRenamed("y", "x"), "x")
    assert {r.x: r.status for r in both.collect()} == {1: "catalogue_only", 2: "both"}
    staged = spark.createDataFrame([(1,), (2,)], "a int").withColumn("a", F.col("a").cast("decimal(18,2)"))
    assert integrity.spend_reconciliation(staged, staged.limit(0), "a").first().reconciled is False


@pytest.mark.parametrize("old, new, always, crossing", [(1500, 900, 1, 1), (900, 800, 1, 0), (2000, 1000, 0, 0), (900, 900, 0, 0), (1500, 999, 1, 1)])
def test_low_balance(spark, old, new, always, crossing):
    frame = lambda v: spark.createDataFrame([(1, v)], "account_number int, balance int")
    assert bank.low_balance_alerts(frame(old), frame(new)).count() == always
    assert bank.low_balance_alerts(frame(old), frame(new), on_crossing_only=True).count() == crossing


@pytest.mark.parametrize("old, new, plain, safe", [("a", "b", 1, 1), (None, "b", 0, 1), ("a", None, 0, 1), ("a", "a", 0, 0), (None, None, 0, 0)])
def test_manager_audit(spark, old, new, plain, safe):
    frame = lambda v: spark.createDataFrame([("1", v)], "ssn string, manager_ssn string")
    assert bank.manager_change_audit(frame(old), frame(new)).count() == plain
    assert bank.manager_change_audit(frame(old), frame(new), null_safe=True).count() == safe


def test_debt_without_and_over_payment(spark):
    from decimal import Decimal

    loans = spark.createDataFrame([(1, Decimal("100.00"), "b"), (2, Decimal("50.00"), "b")], "loan_number int, amount decimal(15,2), branch_name string")
    paid = spark.createDataFrame([(2, Decimal("80.00"))], "loan_number int, payment_amount decimal(15,2)")
    assert [(r.loan_number, str(r.debt)) for r in bank.top_debt_loans(loans, paid).collect()] == [(1, "100.00"), (2, "-30.00")]


# --- readmissions -------------------------------------------------------------------


def brute_pairs(visits):
    return sorted(
        (a[1], a[0], b[0], (b[2] - a[3]).days)
        for a in visits for b in visits
        if a[1] == b[1] and a[0] != b[0] and a[3] is not None and 0 < (b[2] - a[3]).days <= 30
    )


def visits_frame(spark, visits):
    return spark.createDataFrame(visits, "visit_occurrence_id bigint, person_id bigint, visit_start_date date, visit_end_date date")


def test_readmission_gaps(spark):
    gaps = (0, 1, 7, 8, 14, 15, 21, 22, 30, 31)
    for gap in gaps:
        pairs = ranges.pairs_within_days(
            spark.createDataFrame([(1, day(100))], "k int, a date"), spark.createDataFrame([(1, day(100 + gap))], "k int, b date"), "k", "a", "b", 30
        )
        assert pairs.count() == (1 if 1 <= gap <= 30 else 0)


@pytest.mark.parametrize("seed", [1, 2])
def test_readmissions_with_one_hot_patient(spark, seed):
    rng = random.Random(seed)
    visits = []
    for i in range(300):
        start = rng.randrange(0, 400)
        end = None if rng.random() < 0.05 else day(start + rng.choice([0, 0, 1, 5, 40, -3]))
        visits.append((i, 1 if rng.random() < 0.4 else rng.randrange(2, 40), day(start), end))
    frame = visits_frame(spark, visits)
    person = spark.createDataFrame([(p, "male", "142") for p in range(1, 40)], "person_id bigint, gender_source_value string, zip_3digit string")
    expected = brute_pairs(visits)
    got = views.readmissions_30d(person, frame).select("patient_token", "first_encounter", "readmit_encounter", "days_between").collect()
    assert sorted(map(tuple, got)) == expected
    counts = {r.person_id: r.readmissions for r in views.readmission_counts(frame).collect() if r.readmissions}
    want = {}
    for p, *_ in expected:
        want[p] = want.get(p, 0) + 1
    assert counts == want
    following = {}
    for p in {v[1] for v in visits}:
        mine = sorted((v for v in visits if v[1] == p), key=lambda v: (v[2], v[0]))
        for a, b in zip(mine, mine[1:]):
            if a[3] is not None and 0 < (b[2] - a[3]).days <= 30:
                following[a[0]] = (b[0], (b[2] - a[3]).days)
    found = {r.first_encounter: (r.readmit_encounter, r.days_between) for r in views.next_readmission(frame).collect()}
    assert found == following


@pytest.mark.parametrize("seed", [3, 4])
def test_readmission_report_for_encounters_over_several_days(spark, seed):
    """Encounters may have lines on several days; the report must still equal the plain pair join."""
    from decimal import Decimal

    rng = random.Random(seed)
    lines = [(f"e{rng.randrange(60)}", rng.randrange(4), rng.randrange(120), Decimal(rng.randrange(1, 999))) for _ in range(250)]
    lines = [(f"{p}-{t}", p, n, c) for t, p, n, c in lines]
    facts = spark.createDataFrame([(t, p, n, day(n), c) for t, p, n, c in lines],
                                  "encounter_token string, patient_key int, date_key int, service_start date, total_claim_cost decimal(18,2)")
    dates = spark.createDataFrame([(n, day(n)) for n in range(120)], "date_key int, full_date date")
    patients = spark.createDataFrame([(p, f"t{p}", "x", "s") for p in range(4)], "patient_key int, patient_token string, gender string, state_abbr string")
    got = {r.patient_key: r for r in kpi.readmission_pairs_by_patient(facts, dates, patients).collect()}
    for p in range(4):
        pairs = [(a[0], b[2] - a[2], b[3]) for a in lines for b in lines if a[1] == b[1] == p and a[0] != b[0] and 0 < b[2] - a[2] <= 30]
        r = got[p]
        assert r.readmission_events == len({x[0] for x in pairs})
        assert r.min_days_to_readmit == min(x[1] for x in pairs)
        assert r.avg_days_to_readmit == pytest.approx(sum(x[1] for x in pairs) / len(pairs), abs=0.051)
        assert r.total_readmit_cost == sum(x[2] for x in pairs)


def test_summary_keeps_one_row_per_person(spark):
    person = spark.createDataFrame([(1, "male", 1950, "White", "142"), (2, None, 1960, None, "142")],
                                   "person_id bigint, gender_source_value string, year_of_birth int, race_source_value string, zip_3digit string")
    visit = visits_frame(spark, [(i, 1, day(i), day(i)) for i in range(5)])
    cost = spark.createDataFrame([(i, 1, i % 5, 10, 4, 6) for i in range(20)],
                                 "cost_id bigint, person_id bigint, cost_event_id bigint, total_charge int, total_paid int, paid_by_patient int")
    money = {c: F.col(c).cast("decimal(18,2)") for c in ("total_charge", "total_paid", "paid_by_patient")}
    got = {r.patient_token: r for r in views.patient_summary(person, visit, cost.withColumns(money)).collect()}
    assert (got[1].total_encounters, got[1].total_claims, int(got[1].total_spend), int(got[1].total_oop)) == (5, 20, 200, 120)
    assert (got[2].total_encounters, got[2].total_claims, got[2].total_spend) == (0, 0, 0)


# --- profiles -----------------------------------------------------------------------


def test_column_types(spark):
    columns = {
        "nothing": lambda i: None, "flag": lambda i: str(i % 2), "answer": lambda i: ["yes", "No"][i % 2], "rising": lambda i: str(1_700_000_000 + i),
        "falling": lambda i: str(1_800_000_000 - i), "items": lambda i: str(i % 7), "time_ms": lambda i: str(i * 3 % 11),
        "many": lambda i: f"v{i % 51}", "few": lambda i: f"v{i % 50}", "day": lambda i: f"2020-01-{1 + i % 28:02d}", "id": lambda i: str(i),
    }
    data = [tuple(make(i) for make in columns.values()) for i in range(100)]
    df = spark.createDataFrame(data, ", ".join(f"{c} string" for c in columns)).withColumn("pos", F.col("id").cast("bigint"))
    got = {r.column_name: r.detected_type for r in profile.classify_columns(df, "pos", list(columns)).collect()}
    assert got == {
        "nothing": "empty", "flag": "boolean", "answer": "boolean", "rising": "timestamp", "falling": "numeric", "items": "numeric",
        "time_ms": "timestamp", "many": "text", "few": "categorical", "day": "timestamp", "id": "numeric",
    }
    summary = {r.detected_type: r for r in profile.profile_summary(df, "pos", list(columns)).collect()}
    assert summary["empty"].null_cells == 100 and summary["boolean"].column_count == 2
    nulls = {r.column_name: r for r in profile.null_counts(df).collect()}
    assert nulls["nothing"].null_count == 100 and nulls["nothing"].total_null_cells == 100


def test_approximate_profile_is_close(spark):
    df = spark.range(2000).select(F.col("id").alias("pos"), F.col("id").alias("v"))
    rows_ = profile.to_rows(df, "pos", ["v"])
    exact, near = profile.numeric_stats(rows_).first(), profile.numeric_stats(rows_, approximate=True).first()
    assert near.median == pytest.approx(exact.median, rel=0.02)
    assert profile.base_stats(rows_, approximate=True).first().unique_values == pytest.approx(2000, rel=0.1)


# --- de-identification --------------------------------------------------------------


def test_tokens_agree_and_identifiers_go(spark):
    a = spark.createDataFrame([("p1", "Ann", 5)], "patient string, NAME string, x int")
    b = spark.createDataFrame([("p1", 9)], "patient string, y int")
    ta, tb = (privacy.tokenise(df, "patient", "s") for df in (privacy.drop_identifiers(a), b))
    assert ta.columns == ["x", "patient_token"]
    assert ta.join(tb, "patient_token").count() == 1
    assert privacy.tokenise(b, "patient", "other").first().patient_token != tb.first().patient_token
    assert privacy.token_map(b, "patient", "s").first().patient_token == tb.first().patient_token


def test_missing_words_infinities_and_dates_over_all_rows(spark):
    values = [("1", "2024-01-01", "1"), ("2", "2024-01-02", "inf"), ("NaN", "2024-01-03", "2"), ("6", "", "3")]
    df = spark.createDataFrame([(i, *v) for i, v in enumerate(values)], "pos int, n string, d string, i string")
    got = {r.column_name: r for r in profile.classify_columns(df, "pos", ["n", "d", "i"]).collect()}
    assert {k: (r.detected_type, r.null_count) for k, r in got.items()} == {"n": ("numeric", 1), "d": ("timestamp", 1), "i": ("categorical", 0)}
    stats = profile.numeric_stats(profile.to_rows(df, "pos", ["n"])).first()
    assert (stats["median"], stats["max"], stats["mean"]) == (2.0, 6.0, 3.0)
    late = spark.createDataFrame([(i, "2024-01-01" if i < 20 else f"note {i}") for i in range(200)], "pos int, d string")
    assert profile.classify_columns(late, "pos", ["d"]).first().detected_type == "text"


def test_oldest_show_no_birth_year_and_dates_become_years(spark):
    people = spark.createDataFrame(
        [(1, "14201", dt.date(1925, 5, 5), dt.date(2020, 3, 3)), (2, "14201", dt.date(1980, 5, 5), None)], "person_id int, zip string, birth_date date, admission_date date"
    )
    regions = spark.createDataFrame([("142", 50_000)], "zip_3digit string, population int")
    got = sorted(map(tuple, privacy.generalise(people, regions, 2024).collect()))
    assert got == [(1, "142", None, "90+", 2020), (2, "142", 1980, "44", None)]
    tokens = privacy.tokenise_columns(spark.createDataFrame([("a", "a", 1)], "mrn string, account string, n int"), ["mrn", "account"], "s").first()
    assert tokens.mrn_token != tokens.account_token and tokens.n == 1


def test_arrays_of_any_depth(spark):
    deep = spark.createDataFrame([("a", [[1.0, 2.0], [3.0]]), ("a", [[4.0, 5.0, 6.0], None]), ("b", [[7.0]])], "name string, v array<array<double>>")
    got = {r["name"]: tuple(r)[1:] for r in matrices.array_variable_stats(deep, "name", "v").collect()}
    assert got == {"a": ("2x2x3", 3, 6, 1.0, 6.0, 3.5), "b": ("1x1x1", 3, 1, 7.0, 7.0, 7.0)}
    flat = spark.createDataFrame([("a", [1, 2])], "name string, v array<int>")
    assert tuple(matrices.array_variable_stats(flat, "name", "v").first()) == ("a", "1x2", 2, 2, 1.0, 2.0, 1.5)
