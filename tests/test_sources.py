"""Real files: bundles, manifests, headers, delimited text, listings."""

import hashlib
import json
import os
import time

from pyspark.sql import functions as F

from ledgerloom.operators.merge import BatchTable
from ledgerloom.plans import omop
from ledgerloom.sources import bundles, datafiles, listings, sinks

CODING = {"coding": [{"system": "http://hl7.org/ICD-10", "code": "I1", "display": "icd"}, {"system": "http://SNOMED.info/sct", "code": "44", "display": "x" * 300}]}


def bundle(*resources):
    return json.dumps({"resourceType": "Bundle", "entry": [{"resource": r} for r in resources]}, indent=2)


def write(folder, **files):
    for name, text in files.items():
        (folder / f"{name}.json").write_text(text, encoding="utf-8")


def test_bundles_and_quarantine(spark, tmp_path):
    write(
        tmp_path,
        good=bundle(
            {"resourceType": "Patient", "id": "p1", "gender": "female", "birthDate": "1950-02-03", "deceasedBoolean": False,
             "address": [], "extension": [{"url": "x/us-core-race", "extension": [{"valueString": "White"}]}]},
            {"id": "p2", "resourceType": "Patient", "deceasedDateTime": "2020-01-01", "address": [{"state": "NY", "postalCode": "14201"}],
             "maritalStatus": {"coding": []}},
            {"resourceType": "Encounter", "id": "e1", "subject": {"reference": "urn:uuid:p1"}, "period": {"start": "2020-01-01T23:00:00-05:00"},
             "contained": [{"resourceType": "Patient", "id": "inner"}]},
            {"resourceType": "Condition", "id": "c1", "code": CODING, "subject": {"reference": "Patient/p1"}, "onsetDateTime": "2020-02-03T00:00:00Z"},
            {"resourceType": "ExplanationOfBenefit", "id": "k1", "item": [], "total": [], "patient": {"reference": "Patient/p1"}},
            {"resourceType": "ExplanationOfBenefit", "id": "k2", "item": [{"encounter": [{"reference": "Encounter/e1"}]}],
             "total": [{"amount": {"value": 12.5}}], "payment": {"amount": {"value": "oops"}}},
            {"resourceType": "Observation", "id": "o1"},
        ),
        empty="", broken="{\"resourceType\": ", single='{"resourceType": "Patient", "id": "alone"}', bare='{"resourceType": "Bundle"}',
    )
    files = bundles.read_bundles(spark, str(tmp_path))
    kinds = {r.resource_type: r.n for r in bundles.bundle_resources(files).groupBy("resource_type").agg(F.count("*").alias("n")).collect()}
    assert kinds == {"Patient": 2, "Encounter": 1, "Condition": 1, "ExplanationOfBenefit": 2, "Observation": 1}
    bad = {os.path.basename(r.file): r.reason for r in bundles.quarantined_bundles(files).collect()}
    assert bad == {"broken.json": "unreadable", "single.json": "not_a_bundle", "bare.json": "no_entries", **({"empty.json": "unreadable"} if "empty.json" in bad else {})}

    entries = bundles.bundle_entries(files)
    people = {r.fhir_patient_id: r for r in bundles.parse_patients(entries).collect()}
    assert set(people) == {"p1", "p2"}
    assert (people["p1"].deceased, people["p1"].race, people["p1"].zip_3digit, people["p1"].birth_year) == (0, "White", None, "1950")
    assert (people["p2"].deceased, people["p2"].state, people["p2"].zip_3digit, people["p2"].birth_year) == (1, "NY", "142", None)
    encounter = bundles.parse_encounters(entries).first()
    assert (encounter.fhir_patient_id, encounter.start_date, encounter.end_date, encounter.duration_hrs) == ("p1", "2020-01-01", None, None)
    condition = bundles.parse_conditions(entries).first()
    assert (condition.snomed_code, condition.icd_code, condition.onset_date) == ("44", "I1", "2020-02-03")
    claims = {r.claim_id: r for r in bundles.parse_claims(entries).collect()}
    assert (claims["k1"].encounter_id, claims["k1"].total_cost) == (None, 0.0)
    assert (claims["k2"].encounter_id, claims["k2"].total_cost, claims["k2"].payment_amount) == ("e1", 12.5, 0.0)

    person = omop.build_person(bundles.parse_patients(entries)).where("person_source_value = 'p1'").first()
    assert (person.gender_concept_id, person.year_of_birth, person.race_concept_id) == (8532, 1950, 8527)
    cost = {r.cost_id is not None: r for r in omop.build_cost(bundles.parse_claims(entries).where("claim_id = 'k1'")).collect()}[True]
    assert cost.cost_event_id is None
    concept = omop.build_concept(bundles.parse_conditions(entries)).first()
    assert len(concept.concept_name) == 300
    assert len(omop.build_concept(bundles.parse_conditions(entries), name_length=255).first().concept_name) == 255


def test_only_newer_bundles(spark, tmp_path):
    write(tmp_path, old=bundle({"resourceType": "Patient", "id": "old"}), new=bundle({"resourceType": "Patient", "id": "new"}))
    os.utime(tmp_path / "old.json", (time.time() - 10 * 86400,) * 2)
    since = time.strftime("%Y-%m-%dT%H:%M:%S", time.gmtime(time.time() - 86400))
    found = bundles.read_bundles(spark, str(tmp_path), modified_after=since)
    assert [r.file.split("/")[-1] for r in found.collect()] == ["new.json"]


def test_visit_end_date_flag(spark):
    rows = spark.createDataFrame([("e", "p", "2020-01-01", "2020-01-05")], "fhir_encounter_id string, fhir_patient_id string, start_date string, end_date string")
    assert str(omop.build_visit_occurrence(rows).first().visit_end_date) == "2020-01-05"
    assert str(omop.build_visit_occurrence(rows, end_date_as_start=True).first().visit_end_date) == "2020-01-01"


def test_manifest(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.b.CSV").write_bytes(b"x,y\n1,2\n")
    (tmp_path / "scan.pcd").write_bytes(b"VERSION 0.7\n\xff\xfe")
    rows = {r.filename: r for r in datafiles.read_manifest(spark, str(tmp_path)).collect()}
    assert rows["a.b.CSV"].file_hash == hashlib.sha256(b"x,y\n1,2\n").hexdigest()
    assert (rows["a.b.CSV"].file_size, rows["a.b.CSV"].file_extension, rows["a.b.CSV"].modality) == (8, "csv", "tabular")
    assert rows["scan.pcd"].modality == "lidar"


def test_point_cloud_headers(spark, tmp_path):
    (tmp_path / "a.pcd").write_bytes(
        b"# comment\nVERSION .7\nfields x y rgb\nSIZE 4 4\nTYPE F Q\nCOUNT 1 1 1\nWIDTH 10\nHEIGHT 1\nPOINTS 10\nDATA binary\n\xff\xfePOINTS 99\n"
    )
    (tmp_path / "b.pcd").write_bytes(b"VERSION .7\r\nFIELDS x\r\nSIZE 4\r\nTYPE I\r\n")
    headers = datafiles.pcd_headers(datafiles.read_point_headers(spark, str(tmp_path)))
    by_file = {r.file.split("/")[-1]: r for r in headers.collect()}
    assert (by_file["a.pcd"].version, by_file["a.pcd"].points, by_file["a.pcd"].data) == (".7", "10", "binary")
    assert by_file["b.pcd"].points is None and by_file["b.pcd"].fields == ["x"]
    fields = {(r.file.split("/")[-1], r.field): (r.points, r.dtype) for r in datafiles.pcd_schema(headers).collect()}
    assert fields == {
        ("a.pcd", "x"): (10, "Float (4 bytes)"), ("a.pcd", "y"): (10, "Q (4 bytes)"), ("a.pcd", "rgb"): (10, "Unknown (Unknown bytes)"),
        ("b.pcd", "x"): (0, "Integer (4 bytes)"),
    }


def test_separators(spark, tmp_path):
    texts = [("a,b\n1,2\n", ",", 2), ("a;b\n1;2", ";", 2), ("a\tb\n1\t2", "\t", 2), ("a|b|c", "|", 3), ("alone\n1\n", ";", 1), ("a,b;c\n1;2,3,4", ";", 2)]
    rows = spark.createDataFrame([(t,) for t, _, _ in texts], "text string")
    found = {r.text: (r.separator, r.column_count) for r in datafiles.detect_dialects(rows, "text").collect()}
    assert found == {t: (s, n) for t, s, n in texts}
    quoted = spark.createDataFrame([('a,b\n"x, y",1\n"two\nlines; |",2',)], "text string")
    assert tuple(datafiles.detect_dialects(quoted, "text").first()[1:]) == (",", 2)
    for name, content in (("x", "a|b\n1|2\n"), ("y", 'a,b\n"3",4\n5,6\n'), ("z", "a|b\n7|8\n")):
        (tmp_path / f"{name}.csv").write_text(content)
    rows = datafiles.read_by_dialect(spark, str(tmp_path), "a int, b int").collect()
    assert sorted((r.file[-5:], r.a, r.b) for r in rows) == [("x.csv", 1, 2), ("y.csv", 3, 4), ("y.csv", 5, 6), ("z.csv", 7, 8)]


def test_a_header_of_any_length(spark, tmp_path):
    comments = "# comment\n" * 20_000
    (tmp_path / "long.pcd").write_text(comments + "VERSION .7\nFIELDS x y\nSIZE 4 4\nTYPE F F\nPOINTS 3\nDATA ascii\n" + "1 2\nDATA binary\nPOINTS 9\n" * 1000)
    (row,) = datafiles.pcd_headers(datafiles.read_point_headers(spark, str(tmp_path))).collect()
    assert (row.fields, row.points, row.data) == (["x", "y"], "3", "ascii")


def test_listings_csv_and_cards(spark, tmp_path):
    (tmp_path / "c.csv").write_text('Title,Price,Bedrooms,Location,URL,Apartment_Name\nA,1250.0,1.0,"Buffalo, NY",u,"x ""y"""\nB,,,,v,z\n')
    rows = listings.read_listings(spark, str(tmp_path), "craigslist").orderBy("Title").collect()
    assert (rows[0].Price, rows[0].Location, rows[0].Apartment_Name, rows[1].Location) == (1250.0, "Buffalo, NY", 'x "y"', None)
    page = spark.createDataFrame([(1, '<p>x</p><div class="placard"><span class="property-title">T</span><a class="property-link" href="L">m</a></div>'), (2, "none")], "page_id int, html string")
    cards = listings.extract_cards(page, "page_id", "html").collect()
    assert [tuple(c) for c in cards] == [(1, 0, "T", "No price", "No address", "No beds info", "L")]
    odd = """<article id="a" class='placard placard-option-diamond'><p class="x property-title y"><b>T</b></p><a href='L' class="property-link">m</a>
             <div class="placards property-titles">no</div></article><section class="placard"><span class="property-titles">no</span></section>"""
    odd = listings.extract_cards(spark.createDataFrame([(1, odd)], "page_id int, html string"), "page_id", "html").collect()
    assert [tuple(c) for c in odd] == [(1, 0, "T", "No price", "No address", "No beds info", "L"), (1, 1, "No title", "No price", "No address", "No beds info", "No link")]


def test_append_unique_is_idempotent(spark, tmp_path):
    table = BatchTable(spark, str(tmp_path / "t"))
    first = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    second = spark.createDataFrame([(2, "changed"), (3, "c"), (3, "d")], "id int, v string")
    for number, batch in ((1, first), (2, second), (2, second)):
        sinks.append_unique(table, batch, "id", ["v"], number)
    assert sorted(map(tuple, table.read().drop("batch").collect())) == [(1, "a"), (2, "b"), (3, "c")]


def test_types_wanted_are_found_however_they_are_spelt(spark, tmp_path):
    """Bundles that cannot hold a wanted type used to be parsed for it."""
    texts = {
        "plain": bundle({"resourceType": "Encounter", "id": "1"}),
        "narrow": '{"resourceType":"Bundle","entry":[{"resource":{"id":"2","resourceType":"Encounter"}}]}',
        "single": "{'resourceType':'Bundle','entry':[{'resource':{'resourceType':'Encounter','id':'3'}}]}",
        "escaped": '{"resourceType":"Bundle","entry":[{"resource":{"resourceType":"\\u0045ncounter","id":"4"}}]}',
        "named": bundle({"resourceType": "Patient", "id": "Encounter", "note": "Encounter/e1"}),
        "other": bundle({"resourceType": "Claim", "encounter": {"reference": "Encounter/e1"}}),
        "bare": '{"resourceType":"Bundle","entry":[{"resource":{"resourceType":true,"id":"5"}}]}',
        "broken": '{"resourceType":"Bundle","entry":[{"resource":{"resourceType":"Encounter',
        "none": None,
    }
    found = spark.createDataFrame(list(texts.items()), "file string, value string")
    may = lambda *kinds: {r.file for r in found.where(bundles._may_hold(F.col("value"), kinds)).collect()}
    assert may("Encounter") == {"plain", "narrow", "single", "escaped", "named"}
    assert may("Claim", "Patient") == {"named", "other", "escaped"}
    assert may("Encounter", "true") == may("5") == set(texts)
    whole = bundles.bundle_resources(found)
    for kinds in (["Encounter"], ["Claim", "Patient"], ["true"], ["Encounter", "true"]):
        path = str(tmp_path / "-".join(kinds))
        bundles.land_by_type(found, path, kinds=kinds)
        landed = [r.file for kind in kinds for r in bundles.landed_entries(spark, path, kind).collect()]
        assert sorted(landed) == sorted(r.file for r in whole.where(F.col("resource_type").isin(*kinds)).collect()) and landed


def test_a_landed_type_is_read_by_the_fields_it_is_asked_for(spark, tmp_path):
    """Whole resources used to be put together from their columns, and all fields taken, for each query."""
    condition = {"resourceType": "Condition", "id": "c1", "code": CODING, "subject": {"reference": "Patient/p1"}, "onsetDateTime": "2020-02-03T00:00:00Z"}
    odd = [
        {"id": 7, "code": "text"}, {"id": None, "code": {"coding": "x"}}, {"id": {"a": 1}, "code": {"coding": ["y", None, {"system": 5, "code": True}]}},
        {"id": "c2", "subject": "p", "category": [None, {"coding": []}]}, {"id": "c3", "code": None, "category": {}, "onsetDateTime": 2020.5}, {},
    ]
    texts = [(str(i), bundle({**({} if i % 2 else condition), "resourceType": "Condition", **o})) for i, o in enumerate([{}, *odd, *odd])]
    found = spark.createDataFrame(texts, "file string, value string")
    bundles.land_by_type(found, str(tmp_path / "landed"), kinds=["Condition"])
    landed = bundles.parse_conditions(bundles.landed_entries(spark, str(tmp_path / "landed"), "Condition"))
    rows = lambda df: sorted(map(repr, df.collect()))
    assert rows(landed) == rows(bundles.parse_conditions(bundles.bundle_entries(found))) and landed.count() == 13
    plan = lambda *columns: landed.select(*columns)._jdf.queryExecution().executedPlan().toString().split("ReadSchema: ")[1]
    assert plan("fhir_condition_id").startswith("struct<resource:struct<0:string,1:string>>")
    assert "onsetDateTime" not in plan("snomed_code", "category") and "variant" not in plan("snomed_code", "onset_date")
