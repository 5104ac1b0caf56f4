import json
import os

from pyspark.sql import functions as F

from catalog.bindings import Frames
from catalog.claims import bundles_to_patient_summary, fhir_bundle_scan, fhir_patient
from ledgerloom.session import shuffles_freed
from ledgerloom.sources import bundles

SMALL = "/root/testdata/sf0.001"


def test_arrived_bundles_take_a_fraction_of_their_text(spark, monkeypatch):
    """As plain text they took 45 times the disk of the tables they come from."""
    monkeypatch.setattr("catalog.bindings.EXPORT_BUNDLES", 100)
    frames = Frames(spark, SMALL)
    monkeypatch.setattr(Frames, "_written", {})
    arrived = frames.arrived_bundles("patient", "line")
    want = [r.value for k in ("patient", "line") for r in getattr(frames, f"{k}_bundles").collect()]
    assert sorted(r.value for r in arrived.select("value").collect()) == sorted(want)
    files = [name.removeprefix("file:") for name in arrived.inputFiles()]
    assert sum(map(os.path.getsize, files)) < sum(map(len, want)) / 5
    assert len(files) >= len(want) / 100  # a compressed file is read by one task
    assert arrived.groupBy("file").count().agg(F.max("count")).first()[0] <= 100


def test_resources_are_landed_compressed(spark, monkeypatch):
    monkeypatch.setattr(Frames, "_written", {})
    frames = Frames(spark, SMALL)
    landed = frames.landed_resources("Patient")
    assert landed.count() == frames.table("customer").count()
    assert all(".zstd." in name for name in landed.inputFiles())


def tables(spark, folder):
    """Three orders: one of no line, one whose least part is unknown; a line, an order and a part that come twice; nulls."""
    day = F.lit("2001-02-03").cast("timestamp")
    rows = {
        "customer": ([(1, 5, "BUILDING"), (2, 6, None)], "c_custkey long, c_nationkey int, c_mktsegment string"),
        "orders": ([(10, 1, "O", "1-URGENT"), (11, 2, "F", "5-LOW"), (11, 2, "F", "5-LOW"), (12, 2, None, None), (None, 1, "O", "2-HIGH")],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string"),
        "lineitem": ([(10, 1, 7), (10, 1, 7), (10, 2, 8), (11, 1, 3), (11, 2, 8), (None, 1, 7), *((10, n, 7) for n in range(3, 8))],
                     "l_orderkey long, l_linenumber int, l_partkey long"),
        "part": ([(7, "seven"), (8, "eight"), (8, "eight")], "p_partkey long, p_name string"),
        "documents": ([(1, "plain")], "doc_id long, text string"),
        "pages": ([(1, "http://x")], "page_id long, url string"),
    }
    for name, (values, schema) in rows.items():
        df = spark.createDataFrame(values, schema)
        if name == "orders":
            df = df.withColumn("o_orderdate", day)
        if name == "lineitem":
            df = df.withColumn("l_shipdate", day).withColumn("l_extendedprice", F.lit(10.5)).withColumn("l_discount", F.lit(0.1))
        df.write.parquet(f"{folder}/{name}.parquet")
    return Frames(spark, str(folder))


def test_landing_holds_one_load_of_bundles_at_a_time(spark, monkeypatch, tmp_path):
    frames, made = tables(spark, tmp_path), {}
    monkeypatch.setattr(Frames, "_written", {})
    monkeypatch.setattr("catalog.bindings.shared_dir", lambda spark, name: made.setdefault(name, str(tmp_path / name)))
    for kind in ("Condition", "ExplanationOfBenefit"):
        got = frames.landed_resources(kind).groupBy("bundle_id").count().collect()
        assert {r.bundle_id: r["count"] for r in got} == {  # parts and orders that come twice count twice
            "line/81": 2, "line/82": 2, "line/90": 4, "line/83": 1, "line/84": 1, "line/85": 1, "line/86": 1, "line/87": 1}
    assert frames.landed_resources("Patient").count() == 2
    left = [r.value for r in spark.read.text(made["arriving"]).collect()]
    assert len(left) < 13 and all('"id":"line/' in v for v in left)
    assert set(made) == {"arriving", "resources"}


def test_reasons_of_encounters(spark, tmp_path):
    got = tables(spark, tmp_path).encounter_bundles.select("file", F.get_json_object("value", "$.entry[0].resource.reasonCode[0].coding[0].display").alias("why"))
    assert sorted(map(tuple, got.collect()), key=str) == [("encounter/10", "seven"), *[("encounter/11", None)] * 4, ("encounter/12", None)]


def test_shuffle_files_go_when_their_job_ends(spark, tmp_path):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    with shuffles_freed(spark):
        assert spark.conf.get(name) == "true"
        spark.range(9).repartition("id").write.parquet(str(tmp_path / "rows"))
    assert spark.conf.get(name) == "false" and spark.read.parquet(str(tmp_path / "rows")).count() == 9


def test_loads_follow_the_tables_and_hold_every_bundle_once(spark, monkeypatch, tmp_path):
    frames = tables(spark, tmp_path)
    assert len(frames._loads("encounter")) == 1 and len(frames._loads("line")) == 4
    want = {k: sorted(map(tuple, getattr(frames, f"{k}_bundles").collect()), key=str) for k in ("encounter", "line")}
    for rows, counts in ((2, {"encounter": 2, "line": 5}), (1, {"encounter": 5, "line": 7})):
        monkeypatch.setattr("catalog.bindings.LOAD_ROWS", rows)
        monkeypatch.setattr("catalog.bindings.MOST_LOADS", 7)
        for kind, number in counts.items():
            loads = frames._loads(kind)
            assert len(loads) == number
            assert sorted((tuple(r) for load in loads for r in load.collect()), key=str) == want[kind]


def test_a_scan_keeps_its_rows_and_no_bundle(spark, monkeypatch, tmp_path):
    frames, made = tables(spark, tmp_path), {}
    monkeypatch.setattr(Frames, "_written", {})
    monkeypatch.setattr("catalog.bindings.shared_dir", lambda spark, name: made.setdefault(name, str(tmp_path / name)))
    got = fhir_bundle_scan(frames).groupBy("file", "resource_type").count().collect()
    once = ["line/83", "line/84", "line/85", "line/86", "line/87"]
    lines = {"line/81": 2, "line/82": 2, "line/90": 4} | dict.fromkeys(once, 1)
    want = {("patient/1", "Patient"): 1, ("patient/2", "Patient"): 1, ("encounter/10", "Encounter"): 1, ("encounter/11", "Encounter"): 4, ("encounter/12", "Encounter"): 1}
    want |= {(name, kind): n for name, n in lines.items() for kind in ("Condition", "ExplanationOfBenefit")}
    assert {(r.file, r.resource_type): r["count"] for r in got} == want
    assert set(made) == {"arriving", "scanned"} and spark.read.text(made["arriving"]).count() == 0


def test_landed_text_shares_its_prefixes(spark, tmp_path):
    """Ids are most of what is landed; those in order mostly repeat the one before."""
    number = F.col("id").cast("string")
    condition = F.to_json(F.struct(
        F.lit("Condition").alias("resourceType"), F.concat(F.lit("c"), number).alias("id"),
        F.struct(F.concat(F.lit("Encounter/e"), number).alias("reference")).alias("encounter"),
    ))
    arrived = spark.range(0, 700_000, 7, 1).select(*Frames._bundle(F.concat(F.lit("line/"), number), condition))
    bundles.land_by_type(arrived, str(tmp_path / "landed"))
    landed = bundles.landed_entries(spark, str(tmp_path / "landed"), "Condition")
    landed.write.option("compression", "zstd").parquet(str(tmp_path / "plain"))
    size = lambda df: sum(os.path.getsize(name.removeprefix("file://").removeprefix("file:")) for name in df.inputFiles())
    plain = spark.read.schema(landed.schema).parquet(str(tmp_path / "plain"))
    assert size(landed) < 0.75 * size(plain)
    digest = F.sum(F.xxhash64(F.to_json("resource"), "bundle_id", "file").cast("decimal(38,0)"))
    assert landed.count() == 100_000 and landed.select(digest).first() == plain.select(digest).first()


def test_a_query_lands_the_types_it_reads_in_one_pass_over_all_bundles(spark, monkeypatch, tmp_path):
    """All types used to be landed for each query, ten times as much as a query of patients keeps."""
    frames, made, passes = tables(spark, tmp_path), [], []
    take, named = Frames._take_loads, lambda spark, name: made.append((name, str(tmp_path / f"{name}-{len(made)}"))) or made[-1][1]

    def noted(self, landed):
        passes.append(0)

        def counted(found):
            passes[-1] += found.count()
            landed(found)

        take(self, counted)

    monkeypatch.setattr(Frames, "_written", {})
    monkeypatch.setattr("catalog.bindings.shared_dir", named)
    monkeypatch.setattr(Frames, "_take_loads", noted)
    folders = lambda: [{x for x in os.listdir(path) if x.startswith("resource_type")} for name, path in made if name == "resources"]
    assert fhir_patient(frames).count() == 2 and folders() == [{"resource_type=Patient"}]
    whole = sum(getattr(frames, f"{k}_bundles").count() for k in ("patient", "encounter", "line", "odd"))
    assert passes == [whole]
    bundles_to_patient_summary(frames)
    assert passes == [whole] * 2 and folders()[1] == {"resource_type=Encounter", "resource_type=ExplanationOfBenefit"}
    assert bundles_to_patient_summary(frames).count() == 2 and passes == [whole] * 2


def test_bundle_texts_are_json_of_their_rows(spark, tmp_path):
    """Each bundle used to be generated as a whole per line; only names of parts and codes of orders need escapes."""
    name, day = 'a "b" \\ c\né', F.lit("2001-02-03").cast("timestamp")
    orders = [(10, 1, 'O"', "1-\\x"), (13, None, None, None), (-1, 3, "F", "2-HIGH")]
    lines = [(10, 1, 7, 10.5), (13, 2, 8, None), (-1, 1, 7, 0.0)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string").withColumn(
        "o_orderdate", F.when(F.col("o_orderkey") != 13, day)).write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_extendedprice double").withColumns(
        {"l_shipdate": F.when(F.col("l_orderkey") != 13, day), "l_discount": F.lit(0.1)}).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(7, name), (8, None)], "p_partkey long, p_name string").write.parquet(f"{tmp_path}/part.parquet")
    frames = Frames(spark, str(tmp_path))

    def coded(*codings):
        return {"coding": [dict(zip(("system", "code", "display"), c, strict=False)) for c in codings]}

    def line(key, number, code, shown, patient, day, charge, paid):
        reference = {"reference": f"Encounter/e{key}"}
        condition = {
            "resourceType": "Condition", "id": f"c{number}",
            "code": coded(("http://hl7.org/ICD-10", f"I{code}", "icd text"), ("http://SNOMED.info/sct", code, *shown)),
            "clinicalStatus": coded(("clinical", "active")), "verificationStatus": coded(("verification", "confirmed")),
            "category": [coded(("category", "encounter-diagnosis"))],
            **({"onsetDateTime": f"{day}T10:00:00Z"} if day else {}), "subject": patient, "encounter": reference,
        }
        claim = {
            "resourceType": "ExplanationOfBenefit", "id": f"k{number}", "status": "active",
            **({"created": f"{day}T11:00:00Z"} if day else {}), "patient": patient, "item": [{"encounter": [reference]}],
            "total": [{"amount": charge}], "payment": {"amount": paid},
        }
        return f"line/{number}", [condition, claim]

    def encounter(key, kind, hundredth, period, code, shown, subject, ninth):
        return f"encounter/{key}", [{
            "resourceType": "Encounter", "id": f"e{key}", **kind,
            "type": [coded(("http://snomed.info/sct", hundredth, f"type {hundredth}"))], "period": period,
            "reasonCode": [coded(("http://snomed.info/sct", code, *shown))], "subject": subject, "serviceProvider": {"reference": f"Organization/{ninth}"},
        }]

    def texts(found):
        plain = lambda x: json.dumps(x, ensure_ascii=False, separators=(",", ":"))
        bundles_of = {n: plain({"resourceType": "Bundle", "id": n, "entry": [{"resource": r} for r in rs]}) for n, rs in found}
        return {n: t.replace('"@', "").replace('@"', "") for n, t in bundles_of.items()}  # numbers keep their zeros

    amount = lambda value: {"value": f"@{value}@"}
    seen = lambda df: {r.file: r.value for r in df.collect()}
    assert seen(frames.line_bundles) == texts([
        line(10, 81, "7", [name], {"reference": "Patient/1"}, "2001-02-03", amount("10.50"), amount("9.45")),
        line(13, 106, "8", [], {}, None, {}, {}),
        line(-1, -7, "7", [name], {"reference": "Patient/3"}, "2001-02-03", amount("0.00"), amount("0.00")),
    ])
    both = lambda a, b: {"start": f"{a}T08:00:00-05:00", "end": f"{b}T09:20:00-05:00"}
    assert seen(frames.encounter_bundles) == texts([
        encounter(10, {"status": 'O"', "class": {"code": "1", "display": "1-\\x"}}, "10", both("2001-02-03", "2001-02-07"), "7", [name], {"reference": "urn:uuid:1"}, 1),
        encounter(13, {"class": {}}, "13", {}, "8", [], {}, 4),
        encounter(-1, {"status": "F", "class": {"code": "2", "display": "2-HIGH"}}, "-1", both("2001-02-03", "2001-02-02"), "7", [name], {}, -1),
    ])
    escaping = [x for x in frames.line_bundles._jdf.queryExecution().optimizedPlan().toString().splitlines() if "StructsToJson" in x]
    assert escaping and not any("l_orderkey" in x for x in escaping)  # names are escaped below their join


def test_large_loads_are_cut_into_many_tasks(spark, tmp_path, monkeypatch):
    """A load of nine million lines was read by eleven tasks: eight cores waited for the last three."""
    frames, seen = tables(spark, tmp_path), {"made": set(), "read": set()}
    export, made, read = Frames._export, "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(made), spark.conf.get(read)

    def noted(found, path, mode):
        seen["made"].add(spark.conf.get(made))
        export(found, path, mode)

    monkeypatch.setattr(Frames, "_export", staticmethod(noted))
    frames._take_loads(lambda found: seen["read"].add(spark.conf.get(read)))
    assert "16m" in seen["made"] and "48m" in seen["read"] and before == (spark.conf.get(made), spark.conf.get(read))
