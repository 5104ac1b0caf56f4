"""Streams in several batches give what one batch gives."""

import datetime as dt
import random
import time
import types
from decimal import Decimal

import pandas as pd
from pyspark.sql.types import StructType

from ledgerloom.operators import blinks
from ledgerloom.operators.merge import BatchTable
from ledgerloom.plans import telemetry
from ledgerloom.sources import bundles
from ledgerloom.streaming import alerts, gaze, ingest, keyed, positions
from ledgerloom.streaming.jobs import file_stream, run_available, to_files


def at(minute):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute)


def feed(spark, folder, schema, batches, run):
    """Write each batch as a file of its own and run the job after each."""
    for i, batch in enumerate(batches):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(folder)
        run(file_stream(spark, folder, schema, files_per_batch=1))


GPS = "event_id bigint, route_no int, ts timestamp, lat string, lon string"


def test_latest_position_ignores_older_points(spark, tmp_path):
    routes = spark.createDataFrame([(1,), (2,)], "route_no int")
    batches = [
        [(1, 1, at(5), "10", "20"), (2, 9, at(5), "10", "20"), (3, 2, at(1), "0", "0")],
        [(4, 1, at(3), "11", "21"), (5, 2, at(2), "-78.8784005", "1")],
        [(6, 1, at(9), "95", "1"), (7, 1, at(7), "12", "22")],
    ]
    table = BatchTable(spark, str(tmp_path / "latest"))
    feed(spark, str(tmp_path / "in"), GPS, batches, lambda s: run_available(positions.keep_latest(s, routes, table), str(tmp_path / "progress")))
    got = {r.route_no: (r.ts, r.lat, r.lon) for r in positions.current(table).collect()}
    assert got == {1: (at(7), 12.0, 22.0), 2: (at(2), -78.8784, 1.0)}
    whole = spark.createDataFrame(sum(batches, []), GPS)
    assert {r.route_no: (r.ts, r.lat, r.lon) for r in telemetry.latest_positions(whole, routes).collect()} == got
    run_available(positions.keep_latest(file_stream(spark, str(tmp_path / "in"), GPS), routes, table), str(tmp_path / "again"))
    assert {r.route_no: (r.ts, r.lat, r.lon) for r in positions.current(table).collect()} == got


BALANCES = "account_number bigint, ts timestamp, update_id bigint, balance decimal(15,2)"


def crossing_rows(spark, path):
    rows = spark.read.parquet(path).collect()
    return [sorted(r.update_id for r in rows if r.kind == kind) for kind in ("crossing", "late")]


def test_compacted_batches_give_the_same_positions(spark, tmp_path):
    routes = spark.createDataFrame([(1,), (2,)], "route_no int")
    table = BatchTable(spark, str(tmp_path / "t"))
    assert table.read() is None
    table.compact(3)
    batches = [[(i, 1 + i % 2, at(i * 7 % 10), "1", str(i))] for i in range(6)]
    for number, batch in enumerate(batches):
        table.write(telemetry.latest_positions(spark.createDataFrame(batch, GPS), routes), number)
    before = sorted(map(tuple, positions.current(table).collect()))
    positions.compact_latest(table, 3)
    assert sorted(p.name for p in (tmp_path / "t").iterdir()) == ["batch=4", "batch=5", "upto=3"]
    assert sorted(map(tuple, positions.current(table).collect())) == before and table.read(before=4).count() == 2
    positions.compact_latest(table, 5)
    positions.compact_latest(table, 5)
    assert [p.name for p in (tmp_path / "t").iterdir()] == ["upto=5"]
    assert sorted(map(tuple, positions.current(table).collect())) == before


def test_crossings_over_batches_and_a_restart(spark, tmp_path):
    amounts = [1500, 900, 800, 1200, 999, 1000, 10]
    rows = [(1, at(i * 600), i, Decimal(a)) for i, a in enumerate(amounts)] + [(2, at(0), 100, Decimal(5))]
    out = str(tmp_path / "out")
    job = lambda s: run_available(to_files(alerts.crossings(s), out, "kind"), str(tmp_path / "progress"))
    feed(spark, str(tmp_path / "in"), BALANCES, [rows[:2], rows[2:5], rows[5:6], rows[6:]], job)  # a new query for each batch
    assert crossing_rows(spark, out) == [[1, 4, 6, 100], []]
    state = spark.read.format("statestore").load(str(tmp_path / "progress"))
    assert state.count() == 2  # a row per account
    # All batches again, from a lost checkpoint: the output keeps what it has.
    run_available(to_files(alerts.crossings(file_stream(spark, str(tmp_path / "in"), BALANCES, files_per_batch=1)), out, "kind"), str(tmp_path / "lost"))
    assert crossing_rows(spark, out) == [[1, 4, 6, 100], []]
    assert alerts.low_balances(spark.createDataFrame(rows, BALANCES)).count() == 5


def test_updates_of_one_second_and_late_ones(spark, tmp_path):
    batches = [[(1, at(5), 1, Decimal(1400)), (3, at(1), 7, None)], [(1, at(5), 2, Decimal(500)), (1, at(1), 0, Decimal(3)), (1, at(5), 1, Decimal(2))], [(3, at(2), 8, Decimal(1))]]
    out = str(tmp_path / "out")
    feed(spark, str(tmp_path / "in"), BALANCES, batches, lambda s: run_available(to_files(alerts.crossings(s), out, "kind"), str(tmp_path / "progress")))
    assert crossing_rows(spark, out) == [[2, 8], [0, 1]]


def test_a_key_of_few_rows_takes_little_time(monkeypatch):
    """A step took several milliseconds whatever its rows; here it meets 2,000 keys in each of two batches."""
    steps = {}
    monkeypatch.setattr(keyed, "with_state", lambda stream, keys, step, output, state: steps.setdefault("step", step))
    keyed.with_previous(types.SimpleNamespace(schema=StructType.fromDDL(BALANCES)), "account_number", ["ts", "update_id"], "balance")
    rows = pd.DataFrame({"account_number": [1] * 4, "ts": pd.to_datetime([at(3), at(1), at(1), at(2)]), "update_id": [4, 2, 1, 3], "balance": [Decimal(4), Decimal(2), None, Decimal(3)]})
    began = time.process_time()
    for _ in range(2000):
        first, state = steps["step"](rows, None)
        second, after = steps["step"](rows, (at(1), 2, Decimal(2)))
    assert time.process_time() - began < 4000 * 0.002
    assert list(first["update_id"]) == [1, 2, 3, 4] and list(first["before"]) == [None, None, Decimal(2), Decimal(3)] and not first["late"].any()
    assert list(second["late"]) == [True, True, False, False] and list(second["before"]) == [None, None, Decimal(2), Decimal(3)]
    assert state == after == (at(3), 4, Decimal(4))


def test_uploads_are_registered_once(spark, tmp_path):
    schema = """upload_id bigint, filename string, file_size bigint, file_hash string, user_id string, owner_name string,
                owner_email string, dataset string, upload_time_utc timestamp"""
    row = lambda i, h, minute: (i, f"f{i}.csv", 1, h, "u", "Ann Lee", "a@x", None, at(minute))
    batches = [[row(1, "h1", 0), row(2, "h1", 1)], [row(3, "h1", 2), row(4, "h2", 500)], [row(5, "h1", 1000), row(6, "h3", 1)]]  # h3 is very late
    catalogue, lineage = (BatchTable(spark, str(tmp_path / n)) for n in ("catalogue", "lineage"))
    feed(spark, str(tmp_path / "in"), schema, batches, lambda s: run_available(ingest.register_uploads(s, catalogue, lineage), str(tmp_path / "progress")))
    assert sorted(r.file_hash for r in catalogue.read().collect()) == ["h1", "h2", "h3"]
    ids = sorted(r.upload_id for r in catalogue.read().collect())
    assert sorted(r.bronze_file_id for r in lineage.read().collect()) == ids


def test_halt_over_batch_edges(spark, tmp_path):
    schema = "stream string, frame bigint, dark bigint"
    dark = [0, 0, 9, 0, 0, 0, 0, 0, 0, 9, 0, 0, 0, 0, 9] + [0] * 12
    rows = [("s", i, d) for i, d in enumerate(dark)]
    gap = [("t", i, 0) for i in (0, 1, 2, 4, 5, 6, 7, 8)]
    batches = [rows[:5] + gap[:3], rows[5:7] + gap[3:4], rows[7:18] + gap[4:], rows[18:22], rows[22:] + [("s", 3, 9), ("s", 26, 9)]]
    out = str(tmp_path / "out")
    feed(spark, str(tmp_path / "in"), schema, batches, lambda s: run_available(to_files(gaze.halts(s), out), str(tmp_path / "progress")))
    found = spark.read.parquet(out).collect()
    assert sorted((r.stream, r.halt_frame) for r in found if r.halt_frame is not None) == [("s", 7), ("s", 19), ("t", 8)]
    assert sorted((r.stream, r.late_frame) for r in found if r.late_frame is not None) == [("s", 3), ("s", 26)]
    assert spark.read.format("statestore").load(str(tmp_path / "progress")).count() == 2


def test_halts_in_any_batches_are_those_of_the_whole(spark, tmp_path):
    rng = random.Random(6)
    rows = [(s, f, rng.choice([0, 0, 0, 0, 9])) for s in ("a", "b") for f in range(120) if rng.random() < 0.97]
    rows.sort(key=lambda r: r[1])
    schema = "stream string, frame bigint, dark bigint"
    out = str(tmp_path / "out")
    feed(spark, str(tmp_path / "in"), schema, [rows[:31], rows[31:40], rows[40:41], rows[41:]], lambda s: run_available(to_files(gaze.halts(s), out), str(tmp_path / "progress")))
    whole = blinks.blink_halts(spark.createDataFrame(rows, schema), ["stream"], "frame", "dark")
    assert sorted((r.stream, r.halt_frame) for r in spark.read.parquet(out).collect()) == sorted((r.stream, r.halt_frame) for r in whole.collect())


def test_closed_windows_and_late_updates(spark, tmp_path):
    routes = spark.createDataFrame([(1,)], "route_no int")
    day = 24 * 60
    batches = [
        [(1, 1, at(0), "", ""), (2, 1, at(10), "1", "1")],
        [(3, 1, at(day + 30), "1", "1"), (4, 7, at(day + 31), "1", "1")],  # the first day is an hour past its end only below
        [(5, 1, at(3), "1", "1"), (6, 1, at(day + 90), "1", "1")],
        [(7, 1, at(5), "1", "1")],  # late
        [(8, 1, at(2 * day + 70), "", "")],
    ]
    out, table = str(tmp_path / "out"), BatchTable(spark, str(tmp_path / "all"))
    feed(spark, str(tmp_path / "in"), GPS, batches, lambda s: run_available(to_files(positions.closed_rates(s, routes, "1 hour"), out), str(tmp_path / "progress")))
    run_available(positions.count_rejects(file_stream(spark, str(tmp_path / "in"), GPS), routes, table), str(tmp_path / "counting"))
    closed = spark.read.parquet(out)
    got = sorted((r.window_start.day, r.reason, r.updates) for r in closed.collect())
    assert got == [(1, "empty", 1), (1, "ok", 2), (2, "ok", 2), (2, "unknown_route", 1)]
    assert [(r.window_start.day, r.reason, r.updates) for r in positions.late_rates(table, closed).collect()] == [(1, "ok", 1)]


def test_first_uploads_by_state(spark, tmp_path):
    schema = """upload_id bigint, filename string, file_size bigint, file_hash string, user_id string, owner_name string,
                owner_email string, dataset string, upload_time_utc timestamp"""
    row = lambda i, h, minute: (i, f"f{i}.csv", 1, h, "u", "Ann Lee", "a@x", None, at(minute))
    batches = [[row(1, "h1", 0), row(2, "h1", 1)], [row(3, "h1", 2), row(4, "h2", 50)], [row(5, "h4", 500)], [row(6, "h3", 1), row(7, "h2", 510)]]
    out = str(tmp_path / "out")
    feed(spark, str(tmp_path / "in"), schema, batches, lambda s: run_available(to_files(ingest.first_uploads(s, "60 minutes"), out), str(tmp_path / "progress")))
    catalogue = spark.read.parquet(out)
    assert sorted(r.file_hash for r in catalogue.collect()) == ["h1", "h2", "h2", "h4"]  # the second h2 came 460 minutes after the first
    every = spark.createDataFrame(sum(batches, []), schema)
    assert [r.file_hash for r in ingest.missed_uploads(every, catalogue).collect()] == ["h3"]


def test_bundle_files_arrive(spark, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    table = BatchTable(spark, str(tmp_path / "t"))
    for batch in (("a", "b"), ("b", "c")):
        for name in batch:
            text = '{"resourceType": "Bundle",\n "entry": [{"resource": {"resourceType": "Patient", "id": "%s"}}]}' % name
            (folder / f"{name}{len(list(folder.iterdir()))}.json").write_text(text)
        job = ingest.land_resources(ingest.bundle_stream(spark, str(folder)), bundles.parse_patients, table, "fhir_patient_id")
        run_available(job, str(tmp_path / "progress"))
    assert sorted(r.fhir_patient_id for r in table.read().collect()) == ["a", "b", "c"]


def test_first_resources_by_state(spark, tmp_path):
    folder, out = tmp_path / "landing", str(tmp_path / "out")
    folder.mkdir()
    for gender, batch in (("male", ("a", "b")), ("female", ("b", "c")), ("other", ("a",))):
        for name in batch:
            text = '{"resourceType": "Bundle", "entry": [{"resource": {"resourceType": "Patient", "id": "%s", "gender": "%s"}}]}' % (name, gender)
            (folder / f"{name}{len(list(folder.iterdir()))}.json").write_text(text)
        stream = ingest.first_resources(ingest.bundle_stream(spark, str(folder)), bundles.parse_patients, "fhir_patient_id")
        run_available(to_files(stream, out), str(tmp_path / "progress"))
    assert {r.fhir_patient_id: r.gender for r in spark.read.parquet(out).collect()} == {"a": "male", "b": "male", "c": "female"}


def test_rates_count_late_updates_and_the_open_window(spark, tmp_path):
    routes = spark.createDataFrame([(1,)], "route_no int")
    batches = [[(1, 1, at(0), "", ""), (2, 1, at(10), "1", "1")], [(3, 1, at(24 * 60 + 30), "1", "1"), (4, 7, at(24 * 60 + 31), "1", "1")], [(5, 1, at(3), "1", "1")]]
    table = BatchTable(spark, str(tmp_path / "out"))
    feed(spark, str(tmp_path / "in"), GPS, batches, lambda s: run_available(positions.count_rejects(s, routes, table), str(tmp_path / "progress")))
    got = sorted((r.window_start.day, r.reason, r.updates) for r in positions.rates(table).collect())
    assert got == [(1, "empty", 1), (1, "ok", 2), (2, "ok", 1), (2, "unknown_route", 1)]


def test_history_refuses_unknown_routes(spark, tmp_path):
    routes = spark.createDataFrame([(1,)], "route_no int")
    batches = [[(1, 1, at(0), "1", "2"), (2, 9, at(1), "1", "2")], [(3, 1, at(2), "", "")]]
    feed(spark, str(tmp_path / "in"), GPS, batches, lambda s: run_available(positions.history(s, routes, str(tmp_path / "out")), str(tmp_path / "progress")))
    assert [r.event_id for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [1]
