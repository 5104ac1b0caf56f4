import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import profile, sketches


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(2)
    rows = [(int(b), float(v), f"w{int(v * 10)}", None if b % 3 else 5, "NA") for b, v in zip(rng.integers(0, 70, 20_000), rng.normal(100, 30, 20_000))]
    return spark.createDataFrame(rows, "b int, v double, t string, gaps int, missing string").repartition(5)


COLUMNS = ["b", "v", "t", "gaps", "missing"]


def test_one_scan(frame):
    plan = sketches.batch_profiles(frame, COLUMNS, F.col("b"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == frame._jdf.queryExecution().executedPlan().toString().count("Exchange") + 1


@pytest.mark.parametrize("batches", [1, 70])
def test_merged_sketches_against_exact_figures(spark, frame, batches):
    parts = sketches.batch_profiles(frame, COLUMNS, F.col("b") % batches)
    assert parts.count() == batches * len(COLUMNS)
    found = {r.column_name: r for r in sketches.sketched_statistics(sketches.merged_profiles(parts)).collect()}
    exact = {r.column_name: r for r in profile.base_stats(profile.to_rows(frame.withColumn("p", F.lit(0)), "p", COLUMNS)).collect()}
    for name in COLUMNS:
        assert (found[name].total_values, found[name].null_count) == (exact[name].total_values, exact[name].null_count)
        assert found[name].unique_values == pytest.approx(exact[name].unique_values, rel=0.06, abs=0.5)
    values = np.array([r.v for r in frame.select("v").collect()])
    for point, name in ((25, "percentile_25"), (50, "median"), (75, "percentile_75")):
        rank = (values <= found["v"][name]).mean() * 100
        assert abs(rank - point) < 2.5
    assert found["v"]["mean"] == pytest.approx(values.mean(), abs=1e-5) and found["v"]["max"] == pytest.approx(values.max(), abs=1e-5)
    assert found["t"].median is None and found["missing"].min is None and found["gaps"].median == 5.0


def test_later_batches_are_merged_with_a_kept_profile(spark, frame):
    first = sketches.merged_profiles(sketches.batch_profiles(frame.where("b < 40"), COLUMNS, F.col("b"))).withColumn("batch", F.lit("upto 39"))
    later = sketches.batch_profiles(frame.where("b >= 40"), COLUMNS, F.col("b").cast("string"))
    both = sketches.sketched_statistics(sketches.merged_profiles(first.unionByName(later)))
    assert {r.column_name: r.total_values for r in both.collect()} == dict.fromkeys(COLUMNS, 20_000)


def test_no_rows(frame):
    empty = sketches.batch_profiles(frame.limit(0), COLUMNS, F.col("b"))
    assert empty.count() == 0 and sketches.sketched_statistics(sketches.merged_profiles(empty)).count() == 0
