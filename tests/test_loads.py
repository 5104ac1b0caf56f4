"""Incremental loads: touched parts only, all or nothing, watermark with the rows."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import loads, merge
from ledgerloom.sources import bundles

SCHEMA = "k bigint, v string, changed timestamp"


def at(day):
    return dt.datetime(2024, 1, day)


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


@pytest.fixture
def table(spark, tmp_path):
    return loads.LoadedTable(spark, str(tmp_path / "t"), "k", spark.createDataFrame([], SCHEMA).schema, 8)


def rows(frame):
    return sorted((r.k, r.v) for r in frame.collect())


def test_only_touched_parts_are_rewritten(spark, table):
    assert table.watermark() is None and table.read().count() == 0 and table.loads() == []
    first = spark.createDataFrame([(i, "old", at(1)) for i in range(200)], SCHEMA)
    assert table.upsert(first, ["v", "changed"], at(1)) == list(range(8))
    before = files(table.path)
    few = spark.createDataFrame([(3, "new", at(2)), (4, "new", at(2)), (1000, "new", at(2))], SCHEMA)
    parts = {r[0] for r in few.select(table.part_of()).collect()}
    assert set(table.upsert(few, ["v"], at(2))) == parts and len(parts) < 8
    assert before <= files(table.path)  # no file was changed or renamed
    used = {os.path.relpath(f[len("file:"):].lstrip("/"), table.path.lstrip("/")) for f in table.read().inputFiles()}
    assert {int(f.split("=")[2].split("/")[0]) for f in used if f.startswith("load=2")} == parts
    assert {int(f.split("=")[2].split("/")[0]) for f in used if f.startswith("load=1")} == set(range(8)) - parts
    assert rows(table.read()) == sorted([(i, "new" if i in (3, 4) else "old") for i in range(200)] + [(1000, "new")])
    assert {r.changed for r in table.read().where("k in (3, 4)").collect()} == {at(1)}  # not among the updated columns
    assert table.watermark() == at(2) and table.loads() == [1, 2]


def test_a_failed_load_leaves_rows_and_watermark(spark, table):
    table.upsert(spark.createDataFrame([(i, "old", at(1)) for i in range(20)], SCHEMA), ["v", "changed"], at(1))
    before = rows(table.read())
    failing = spark.createDataFrame([(i, "new", at(2)) for i in range(40)], SCHEMA)
    broken = F.when(F.col("k") == 7, F.raise_error(F.lit("broken row")).cast("string")).otherwise(F.col("v"))
    # The source is fine, the write of the load fails: the merged rows are spoilt after the source was read.
    whole = merge.merge_upsert(table.read(), failing, "k", ["v"]).withColumn("v", broken).withColumns({loads.MOMENT: F.lit(at(2)), loads.PART: table.part_of()})
    with pytest.raises(Exception, match="broken row"):
        whole.write.mode("overwrite").partitionBy(loads.PART).parquet(f"{table.path}/load=2")
    assert rows(table.read()) == before and table.watermark() == at(1) and table.loads() == [1]
    with pytest.raises(Exception, match="broken row"):
        table.upsert(failing.withColumn("v", broken), ["v"], at(2))
    assert rows(table.read()) == before and table.watermark() == at(1)
    table.upsert(failing, ["v"], at(3))
    assert rows(table.read()) == [(i, "new") for i in range(40)] and table.watermark() == at(3) and table.loads() == [1, 2]


def test_parts_without_a_success_mark_are_not_read(spark, table):
    table.upsert(spark.createDataFrame([(1, "a", at(1))], SCHEMA), ["v"], at(1))
    table.upsert(spark.createDataFrame([(1, "b", at(2))], SCHEMA), ["v"], at(2))
    os.remove(f"{table.path}/load=2/_SUCCESS")
    assert rows(table.read()) == [(1, "a")] and table.watermark() == at(1)
    assert table.vacuum() == 1 and not os.path.exists(f"{table.path}/load=2")


def test_vacuum_keeps_what_is_read(spark, table):
    for day in (1, 2, 3):
        table.upsert(spark.createDataFrame([(i, str(day), at(day)) for i in range(0, 60, day)], SCHEMA), ["v", "changed"], at(day))
    before, mark = rows(table.read()), table.watermark()
    assert table.vacuum() > 0 and rows(table.read()) == before and table.watermark() == mark
    assert table.vacuum() == 0


def test_repeated_keys_empty_loads_and_nulls(spark, table):
    with pytest.raises(merge.DuplicateSourceKeys):
        table.upsert(spark.createDataFrame([(1, "a", at(1)), (1, "b", at(1))], SCHEMA), ["v"], at(1))
    assert table.upsert(spark.createDataFrame([], SCHEMA), ["v"], at(1)) == [] and table.watermark() is None
    nulls = spark.createDataFrame([(None, "n", None), (None, "m", None), (5, None, None)], SCHEMA)
    table.upsert(nulls, ["v"], at(1))
    table.upsert(spark.createDataFrame([(5, "x", at(2))], SCHEMA), ["v"])  # no moment: the watermark stays
    assert table.watermark() == at(1)
    assert sorted((r.k is None, r.v) for r in table.read().collect()) == [(False, "x"), (True, "m"), (True, "n")]


def test_newer_rows(spark, table):
    first = [(1, "a", at(1)), (1, "b", at(3)), (2, "c", at(2))]
    loads.load_newer_rows(table, spark.createDataFrame(first, SCHEMA), "changed")
    assert rows(table.read()) == [(1, "b"), (2, "c")] and table.watermark() == at(3)
    later = first + [(2, "late", at(2)), (2, "d", at(4))]  # a change dated before the watermark is not seen
    loads.load_newer_rows(table, spark.createDataFrame(later, SCHEMA), "changed")
    assert rows(table.read()) == [(1, "b"), (2, "d")] and table.watermark() == at(4)
    assert loads.load_newer_rows(table, spark.createDataFrame(later, SCHEMA), "changed") == []


def test_newer_files(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    text = '{"resourceType": "Bundle", "entry": [{"resource": {"resourceType": "Patient", "id": "%s", "gender": "%s"}}]}'
    parse = lambda files: bundles.parse_patients(bundles.bundle_entries(files))
    read = lambda since: bundles.read_bundles(spark, str(landing), since)
    (landing / "a.json").write_text(text % ("a", "male"))
    os.utime(landing / "a.json", (1_700_000_000, 1_700_000_000))
    patients = loads.LoadedTable(spark, str(tmp_path / "t"), "fhir_patient_id", parse(read(None)).schema, 4)
    assert [r.fhir_patient_id for r in loads.load_newer_files(patients, str(landing), read, parse).collect()] == ["a"]
    assert loads.load_newer_files(patients, str(landing), read, parse) is None
    (landing / "b.json").write_text(text % ("b", "female"))
    (landing / "c.json").write_text(text % ("a", "other"))
    for name in "bc":
        os.utime(landing / f"{name}.json", (1_700_000_100, 1_700_000_100))
    assert sorted(r.fhir_patient_id for r in loads.load_newer_files(patients, str(landing), read, parse).collect()) == ["a", "b"]
    assert {r.fhir_patient_id: r.gender for r in patients.read().collect()} == {"a": "other", "b": "female"}
    assert patients.watermark().timestamp() == 1_700_000_100
