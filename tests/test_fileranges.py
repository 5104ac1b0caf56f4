import csv
import hashlib
import io
import os
import random

import pytest
from hypothesis import given, settings, strategies as st

from ledgerloom.sources import datafiles, fileranges as fr, sinks


def test_digests_in_chunks(spark, tmp_path, monkeypatch):
    (tmp_path / "sub").mkdir()
    large = os.urandom(fr.CHUNK_BYTES * 2 + 17)
    for name, data in (("sub/a.b.CSV", b"x,y\n1,2\n"), ("large.bin", large), ("empty.txt", b""), ("_hidden", b"no")):
        (tmp_path / name).write_bytes(data)
    rows = {r.filename: r for r in datafiles.read_manifest(spark, str(tmp_path)).collect()}
    assert set(rows) == {"a.b.CSV", "large.bin", "empty.txt"}
    assert rows["large.bin"].file_hash == hashlib.sha256(large).hexdigest() and rows["large.bin"].file_size == len(large)
    assert rows["empty.txt"].file_hash == hashlib.sha256(b"").hexdigest()
    assert rows["a.b.CSV"].modality == "tabular" and rows["a.b.CSV"].modified.timestamp() == pytest.approx(os.path.getmtime(tmp_path / "sub/a.b.CSV"), abs=1)
    assert [r.filename for r in datafiles.read_manifest(spark, str(tmp_path), "*.bin").collect()] == ["large.bin"]
    assert [r.filename for r in datafiles.read_manifest(spark, f"file://{tmp_path}", "*.CSV").collect()] == ["a.b.CSV"]


def test_a_file_beyond_the_limit_of_a_row(spark, tmp_path):
    """Three gigabytes of nothing (a sparse file): more than a row can hold."""
    with open(tmp_path / "huge.pcd", "wb") as file:
        file.write(b"VERSION .7\nFIELDS x\nSIZE 4\nTYPE F\nPOINTS 1\nDATA binary\n")
        file.truncate(3_000_000_000)
    (row,) = fr.read_digests(spark, str(tmp_path)).select("length", "file_hash").collect()
    digest = hashlib.sha256()
    with open(tmp_path / "huge.pcd", "rb") as file:
        while data := file.read(1 << 24):
            digest.update(data)
    assert (row.length, row.file_hash) == (3_000_000_000, digest.hexdigest())
    (header,) = datafiles.pcd_headers(datafiles.read_point_headers(spark, str(tmp_path))).collect()
    assert (header.points, header.data, header.fields) == ("1", "binary", ["x"])


def test_binary_points_without_a_line_feed(spark, tmp_path):
    (tmp_path / "a.pcd").write_bytes(b"VERSION .7\nFIELDS x y\nSIZE 4 4\nTYPE F F\nPOINTS 2\nDATA binary\n" + b"\x07" * 10_000_000)
    (tmp_path / "b.pcd").write_bytes(b"\x07" * 9_000_000)  # no header at all
    (tmp_path / "c.pcd").write_bytes(b"VERSION .7\r\nPOINTS 5" + b"\n" + b"z" * 5_000_000 + b"\n data ascii")
    rows = {r.file.split("/")[-1]: r for r in datafiles.pcd_headers(datafiles.read_point_headers(spark, str(tmp_path))).collect()}
    assert (rows["a.pcd"].points, rows["a.pcd"].data) == ("2", "binary")
    assert rows["b.pcd"].version is None and rows["b.pcd"].fields == []
    assert (rows["c.pcd"].version, rows["c.pcd"].points, rows["c.pcd"].data) == (".7", "5", "ascii")


@pytest.mark.parametrize("size", [1, 3, 7, 1000])
def test_keyword_lines_whatever_the_chunks(size):
    data = b"# x\nVERSION .7\r\n" + b"FIELDS " + b"a " * 200 + b"\n" + b"w" * 300 + b"\nPOINTS 3\nDATA binary\nPOINTS 4\n"
    pieces = (data[i:i + size] for i in range(0, len(data), size))
    assert fr.keyword_lines(pieces, ("version", "fields", "points"), "data") == ["VERSION .7", "FIELDS " + "a " * 200, "POINTS 3", "DATA binary"]


def ranges(path, size):
    total = os.path.getsize(path)
    data, parts, quoted = open(path, "rb").read(), [], 0
    for at in range(0, total, size):
        parts.append(fr.FilePart(path, total, 0.0, at, min(total, at + size), bool(quoted)))
        quoted = (quoted + data[at:at + size].count(b'"')) % 2
    return parts


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.text(alphabet='ab,;"\n é', max_size=12), min_size=1, max_size=4), min_size=1, max_size=8), st.integers(1, 40), st.integers(1, 9))
def test_records_of_any_ranges(tmp_path_factory, rows, size, chunk):
    text = io.StringIO()
    csv.writer(text, lineterminator="\n", quoting=csv.QUOTE_ALL).writerows(rows)
    path = str(tmp_path_factory.mktemp("r") / "f.csv")
    open(path, "wb").write(text.getvalue().encode())
    found = [(at, r.decode()) for part in ranges(path, size) for at, r in fr.records(part, chunk)]
    assert [next(csv.reader(io.StringIO(r, newline=""))) for _, r in found] == rows
    assert [at for at, _ in found] == sorted({at for at, _ in found})


def test_records_in_spark(spark, tmp_path):
    rng = random.Random(3)
    rows = [[str(i), rng.choice(["plain", "two\nlines", 'a "quoted" word', "x, y; z", "", "é" * 30])] for i in range(3000)]
    for name, sep in (("a.csv", ","), ("b.csv", "|")):
        with open(tmp_path / name, "w", newline="") as file:
            writer = csv.writer(file, delimiter=sep, lineterminator="\r\n" if name == "b.csv" else "\n")
            writer.writerow(["n", "words"])
            writer.writerows(rows)
    found = fr.read_records(spark, str(tmp_path), "*.csv", range_bytes=1000)
    assert found.rdd.getNumPartitions() > 100 if hasattr(found, "rdd") else True
    assert found.count() == 2 * 3001
    read = datafiles.read_by_dialect(spark, str(tmp_path), "n int, words string", range_bytes=1000).collect()
    for name in ("a.csv", "b.csv"):
        got = sorted((r.n, r.words) for r in read if r.file.endswith(name))
        assert got == sorted((int(n), w or None) for n, w in rows)
    dialects = {r.file[-5:]: (r.separator, r.column_count) for r in datafiles.file_dialects(found).collect()}
    assert dialects == {"a.csv": (",", 2), "b.csv": ("|", 2)}


def test_malformed_rows_and_empty_files(spark, tmp_path):
    (tmp_path / "e.csv").write_text("")
    (tmp_path / "m.csv").write_text('a;b\n1;2\nx;3\n4\n5;6;7\n\n"8";"9"')
    read = datafiles.read_by_dialect(spark, str(tmp_path), "a int, b int")
    assert sorted((r.a or 0, r.b or 0) for r in read.collect()) == [(0, 3), (1, 2), (4, 0), (5, 6), (8, 9)]


def test_small_files_are_packed(spark, tmp_path):
    """A task a file took 30 ms each."""
    for i in range(300):
        (tmp_path / f"{i:03d}.pcd").write_bytes(b"VERSION %d\nDATA ascii\n" % i)
    found = fr.read_headers(spark, str(tmp_path), ("version",), "data")
    assert sorted(r.header for r in found.collect()) == sorted(f"VERSION {i}\nDATA ascii" for i in range(300))
    assert found.rdd.getNumPartitions() <= 2 * spark.sparkContext.defaultParallelism


def test_packs_keep_the_parts_and_stay_bounded():
    parts = [fr.FilePart(str(i), size, 0.0, 0, size) for i, size in enumerate([0, 10, 3 * fr.RANGE_BYTES, 5, fr.RANGE_BYTES] + [1000] * 2000)]
    for tasks in (1, 8, 10_000):
        packs = fr.packed(parts, tasks)
        assert [p for pack in packs for p in pack.parts] == parts
        assert all(len(p.parts) == 1 or sum(x.end for x in p.parts) <= fr.RANGE_BYTES for p in packs)
    assert fr.packed([], 8) == []


def test_a_file_per_key(spark, tmp_path):
    rows = [(i, f"é {i}") for i in range(40)] + [(7, "more"), (None, "x"), (3, None)]
    sinks.write_file_per_key(spark.createDataFrame(rows, "k bigint, t string").coalesce(1), str(tmp_path / "out"), "k", "t")
    spark.createDataFrame(rows, "k bigint, t string").coalesce(1).write.partitionBy("k").text(str(tmp_path / "sink"))
    content = lambda folder: {d.name: [f.read_bytes() for f in d.glob("part-*")] for d in (tmp_path / folder).iterdir() if d.is_dir()}
    assert content("out") == content("sink") and len(content("out")) == 41
