import statistics

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import integrity, skew


@pytest.fixture(scope="module")
def facts(spark):
    """A third of the rows on one key, a tenth on null."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 5000)
    return spark.range(60_000).select(F.col("id").alias("row"), key.alias("k"), (F.col("id") % 40).alias("j"), F.lit("x").alias("v"))


@pytest.fixture(scope="module")
def dims(spark):
    return spark.range(5000).where("id % 11 <> 0").select(F.col("id").alias("k"), F.concat(F.lit("d"), F.col("id")).alias("name"))


def test_heavy_keys_are_found(facts):
    by_k, by_j, by_both = skew.heavy_keys(facts, [["k"], ["j"], ["k", "row"]])
    hashes = {r.h: r.n for r in facts.groupBy(F.xxhash64("k").alias("h")).agg(F.count("*").alias("n")).where("n > 600").collect()}
    assert set(by_k) == set(hashes) and len(by_k) == 2
    assert sorted(by_k.values()) == sorted(-(-n // 600) for n in hashes.values())
    assert len(by_j) == 40 and by_both == {}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_same_rows_as_a_plain_join(facts, dims, how):
    wanted = facts.join(dims, "k", how).select("row", "k", "name")
    got = skew.heavy_key_joins(facts, [(dims, ["k"])], how).select("row", "k", "name")
    assert got.count() == wanted.count() and got.exceptAll(wanted).isEmpty()


def test_several_dimensions_and_repeated_dimension_rows(spark, facts, dims):
    twice = dims.union(dims.where("k = 7"))
    other = spark.range(40).select(F.col("id").alias("j"), F.lit(1).alias("one"))
    got = skew.heavy_key_joins(facts, [(twice, ["k"]), (other, ["j"])])
    assert got.columns == ["j", "k", "row", "v", "name", "one"] or set(got.columns) == {"j", "k", "row", "v", "name", "one"}
    wanted = facts.join(twice, "k").join(other, "j").select(got.columns)
    assert got.count() == wanted.count() and got.exceptAll(wanted).isEmpty()


def test_no_task_holds_the_hot_key(spark, facts, dims):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        sizes = lambda df: [r.n for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
        sliced = sizes(skew.heavy_key_joins(facts, [(dims, ["k"])], share=0.002))
        plain = sizes(facts.join(dims, "k"))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert max(sliced) <= 3 * statistics.median(sliced) < max(plain)


def test_without_rows(facts, dims):
    assert skew.heavy_key_joins(facts.limit(0), [(dims, ["k"])]).count() == 0
    assert skew.heavy_key_joins(facts, [(dims.limit(0), ["k"])], "left").count() == 60_000


def test_foreign_keys_in_one_pass(spark):
    child = spark.createDataFrame([(1, "1", 5), (2, "x", 6), (2, None, None), (9, "2", 5)], "a bigint, b string, c int")
    parent = spark.createDataFrame([(1, 5), (2, 6), (3, None)], "id bigint, code bigint")
    keys = [integrity.ForeignKey(n, "c", n, "p", t) for n, t in (("a", "id"), ("b", "id"), ("c", "code"))]
    checked = integrity.fk_violations({"c": child, "p": parent}, keys)
    assert sorted(map(tuple, checked.collect())) == [("a", 1, 1), ("b", 1, 1), ("c", 0, 0)]
    own = integrity.ForeignKey("up", "p", "code", "p", "id")
    assert sorted(map(tuple, integrity.fk_violations({"c": child, "p": parent}, [*keys, own]).collect()))[-1] == ("up", 2, 2)
    plan = checked._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 3  # the child, the parent, the names
