"""Delivered files: every edge the contracts name, against Python's own reading."""

from __future__ import annotations

import csv
import datetime as dt
import hashlib
import io
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from replaykit.sources import blocks, landing
from replaykit.sources import deliveries as d
from replaykit.sources.landing import checksums, ingestion_outcomes, landing_conflicts
from replaykit.sources.registry import columns_of, raw_schema, with_registry

from .conftest import rows

HEADER = ",".join(columns_of("sellers"))
BODY = {
    "plain.csv": f"{HEADER}\n1,01310,sao paulo,SP\n2,02020,rio,RJ\n",
    "crlf_bom.csv": f"﻿{HEADER}\r\n3,01310,x,SP\r\n",
    "header_only.csv": f"{HEADER}\n",
    "blank_lines.csv": f"{HEADER}\n\n4,1,a,b\n\n\n5,1,a,b\n",
    "quoted.csv": f'{HEADER}\n6,1,"a, ""b""",SP\n',
    "multiline.csv": f'{HEADER}\n7,1,"two\nlines",SP\n8,1,"x\n\ny",SP\n',
    "stray_quote.csv": f'{HEADER}\n9,1,a"b,"c\nd"\n',
    "reordered.csv": "seller_state,seller_city,seller_id,seller_zip_code_prefix\nSP,sao,10,01310\n",
    "extra.csv": f"loaded_by,{HEADER}\nme,11,01310,sao,SP\n",
    "quoted_header.csv": '"' + HEADER.replace(",", '","') + '"\n12,1,a,b\n',
    "duplicates.csv": f"{HEADER}\n13,1,a,b\n13,1,a,b\n",
    "UPPER.CSV": f"{HEADER}\n14,1, a ,\n",
    "header_like_row.csv": f"{HEADER}\n{HEADER}\n",
}


def python_rows(text: str) -> list[tuple]:
    reader = csv.DictReader(io.StringIO(text.removeprefix("﻿"), newline=""))
    return [tuple(r[c] for c in columns_of("sellers")) for r in reader]


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    folder = tmp_path_factory.mktemp("delivered") / "sellers"
    folder.mkdir()
    for name, text in BODY.items():
        (folder / name).write_bytes(text.encode())
    return folder


@pytest.fixture(scope="module")
def facts(spark, root):
    return d.file_facts(spark, str(root))


def test_scan_equals_python(spark, root, facts):
    expected = [row for text in BODY.values() for row in python_rows(text)]
    got = rows(d.scan_csv(spark, str(root), "sellers", facts), *columns_of("sellers"))
    assert got == sorted(expected, key=repr)


def test_counts_equal_python(spark, root, facts):
    got = dict(rows(d.record_counts(spark, str(root), facts), "source_file_name", "record_count"))
    assert got == {name: len(python_rows(text)) for name, text in BODY.items()}


def test_one_layout_needs_no_header_join(spark, tmp_path):
    folder = tmp_path / "sellers"
    folder.mkdir()
    for n in range(3):
        (folder / f"{n}.csv").write_text(BODY["plain.csv"])
    scanned = d.scan_csv(spark, str(folder), "sellers")
    assert scanned.count() == 6
    assert "Join" not in scanned._jdf.queryExecution().executedPlan().toString()


def test_scan_of_lacking_column_fails(spark, tmp_path):
    folder = tmp_path / "sellers"
    folder.mkdir()
    (folder / "a.csv").write_text("seller_id,seller_city\n1,x\n")
    with pytest.raises(ValueError, match="seller_state, seller_zip_code_prefix"):
        d.scan_csv(spark, str(folder), "sellers")
    (folder / "b.csv").write_text(BODY["plain.csv"])
    with pytest.raises(Exception, match="missing required column"):
        d.scan_csv(spark, str(folder), "sellers").collect()


def python_records(body: str) -> list[list[str]]:
    return [r for r in csv.reader(io.StringIO(body, newline="")) if r]


HARD_PIECES = ['a', ',', '"', '""', '\n', '\r\n', '\r', 'b c', ',"', '",', ' ', '\n', ',,', '"x\ny"', 'é']


def test_walk_finds_the_records_of_python():
    rng = random.Random(1)
    for _ in range(3000):
        body = "".join(rng.choice(HARD_PIECES) for _ in range(rng.randint(1, 14)))
        found, inside, part = [], False, []
        for line in body.encode().split(b"\n"):
            pieces, ends = blocks.walk(line, inside)
            for k, piece in enumerate(pieces):
                part = [*part, piece] if inside and k == 0 else [piece]
                if not (ends and k == len(pieces) - 1):
                    found.append(b"\n".join(part))
            inside = ends
        if inside:
            found.append(b"\n".join(part))
        assert len([r for r in found if r]) == len(python_records(body)), repr(body)


@pytest.mark.parametrize("size", [60, 97, 1000])
def test_records_over_block_edges(spark, tmp_path, size):
    """Blocks of a few bytes, so that nearly every record crosses one, against Python's reader."""
    folder = tmp_path / "sellers"
    folder.mkdir()
    rng, expected = random.Random(size), []
    for n in range(2):
        out = io.StringIO(newline="")
        writer = csv.writer(out, lineterminator=rng.choice(["\n", "\r\n"]))
        writer.writerow(columns_of("sellers"))
        for k in range(25):
            field = "".join(rng.choice(["city", "\n", "\r\n", '"', ", ", "x" * 50, "é", ""]) for _ in range(rng.randint(0, 5)))
            row = (f"{n}-{k}", "01310", field, rng.choice(["SP", "a\nb"]))
            writer.writerow(row)
            expected.append(row)
        (folder / f"{n}.csv").write_bytes(out.getvalue().encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        facts = d.file_facts(spark, str(folder))
        assert facts.agg(F.sum(F.size("carried"))).first()[0] > (10 if size < 100 else 0)
        assert rows(d.scan_csv(spark, str(folder), "sellers", facts), *columns_of("sellers")) == sorted(expected, key=repr)
        assert d.record_counts(spark, str(folder), facts).agg(F.sum("record_count")).first()[0] == len(expected)
        monkey = blocks.SENT_BLOCKS
        blocks.SENT_BLOCKS = -1
        try:
            assert rows(d.scan_csv(spark, str(folder), "sellers", facts), *columns_of("sellers")) == sorted(expected, key=repr)
        finally:
            blocks.SENT_BLOCKS = monkey
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_plain_lines_cost_no_python_object(monkeypatch):
    """Only lines with quotes, returns or the header are taken out of a batch."""
    lines = [b"a,b", *[b"%d,x\r" % n for n in range(500)], b"", b" \t", b'7,"p"', b"8,\r9,q"]
    count = len(lines)
    columns = [pa.array([1] * count, pa.int64()), pa.array([0] * count, pa.int64()), pa.array(lines, pa.binary()), pa.array([True] * count)]
    batch = pa.RecordBatch.from_arrays(columns, names=["file_key", "block_start", "line", "valid"])
    taken, line = [], blocks.Lines.line
    monkeypatch.setattr(blocks.Lines, "line", lambda self, i: taken.append(i) or line(self, i), raising=False)
    monkeypatch.setattr(blocks.Lines, "lines", property(lambda self: pytest.fail("all lines taken")), raising=False)
    described = blocks._described(iter([batch]))
    assert [r["records_0"] for b in described for r in b.to_pylist()] == [1 + 500 + 1 + 1 + 2]
    assert taken == [0, 503, 504]


def test_facts_come_from_one_scan_without_a_sort_or_a_path_list(spark, root):
    plan = blocks.block_facts(spark, str(root))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1 and "Sort" not in plan and "Exchange" not in plan and "plain.csv" not in plan
    facts = d.file_facts(spark, str(root))
    plan = d.scan_csv(spark, str(root), "sellers", facts)._jdf.queryExecution().analyzed().toString()
    assert "multiline.csv" not in plan


def test_a_split_file_is_read_like_a_whole_one(spark, tmp_path):
    folder = tmp_path / "sellers"
    folder.mkdir()
    body = "".join(f"{n},0{n},city {n},SP\n" for n in range(20_000))
    (folder / "big.csv").write_text(f"{HEADER}\n{body}")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        facts = d.file_facts(spark, str(folder))
        assert rows(facts, "header_line", "n_records", "valid_utf8", "line_safe") == [(HEADER, 20_001, True, True)]
        scanned = d.scan_csv(spark, str(folder), "sellers", facts)
        assert scanned.rdd.getNumPartitions() > 5
        assert scanned.count() == 20_000 and scanned.select("seller_id").distinct().count() == 20_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_file_checks(spark, tmp_path):
    (tmp_path / "ok.csv").write_text("a\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "text.txt").write_text("a\n")
    (tmp_path / "folder.csv").mkdir()
    (tmp_path / "folder.csv" / "inner.csv").write_text("a\n")
    base = f"file://{tmp_path}"
    wanted = ["ok.csv", "empty.csv", "text.txt", "folder.csv", "gone.csv"]
    expected = spark.createDataFrame([(f"{base}/{n}",) for n in wanted], "path string")
    checked = d.file_checks(expected, d.list_files(spark, str(tmp_path)))
    assert rows(checked.select(F.element_at(F.split("path", "/"), -1), "file_check")) == [
        ("empty.csv", "empty"), ("folder.csv", "not_a_regular_file"), ("gone.csv", "missing"), ("ok.csv", "ok"),
        ("text.txt", "not_csv"),
    ]


def test_listing_reads_no_contents(spark, root):
    plan = d.list_files(spark, str(root))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_checksums(spark, tmp_path):
    bodies = {
        "plain.csv": b"a\nb\n", "open.csv": b"a\nb", "blank.csv": b"\n", "marked.csv": b"\xef\xbb\xbfa\r\nb\r\n",
        "marked_open.csv": b"\xef\xbb\xbfa", "only_mark.csv": b"\xef\xbb\xbf\n", "bytes.csv": b"\xff\x00\n\n\xfe",
        "large.csv": b"".join(b"%d,row\n" % n for n in range(30_000)),
    }
    for name, body in bodies.items():
        (tmp_path / name).write_bytes(body)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = {r.path.rsplit("/", 1)[1]: (r.checksum, r.file_size_bytes) for r in checksums(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {n: (hashlib.sha256(b).hexdigest(), len(b)) for n, b in bodies.items()}


def test_a_file_of_one_block_is_digested_where_it_is_read():
    """One row leaves the scan for a file of one block, and pieces of many lines for the blocks of others."""
    line, n = b"x" * 99, 30_000
    columns = {"path": ["whole"] * n + ["parted"] * n, "file_key": [1] * n + [2] * n, "file_size_bytes": [100 * n] * n + [200 * n] * n, "block_start": [0] * 2 * n, "block_length": [100 * n] * 2 * n}
    batch = pa.table({**columns, "value": pa.array([line] * 2 * n, pa.binary())}).to_batches(max_chunksize=7_000)
    rows = pa.Table.from_batches(landing._pieces(iter(batch))).to_pylist()
    whole = [r for r in rows if r["path"] == "whole"]
    assert [(r["value"], r["checksum"]) for r in whole] == [(None, hashlib.sha256((line + b"\n") * n).hexdigest())]
    parts = [r["value"] for r in rows if r["path"] == "parted"]
    assert 2 <= len(parts) <= 4 and b"\n".join(parts) == b"\n".join([line] * n)


def test_a_line_of_white_space_is_a_record(spark, tmp_path):
    folder = tmp_path / "sellers"
    folder.mkdir()
    (folder / "a.csv").write_text(f"{HEADER}\n1,1,a,b\n  \n2,2,a,b\n\n")
    facts = d.file_facts(spark, str(folder))
    assert d.scan_csv(spark, str(folder), "sellers", facts).count() == 3
    assert d.record_counts(spark, str(folder), facts).first().record_count == 3


def test_an_invalid_file_claims_no_landing_path(spark, tmp_path):
    for part, body in (("a", b"seller_id\n1\n"), ("b", BODY["plain.csv"].encode())):
        folder = tmp_path / part / "sellers" / "delivery_date=2021-03-08"
        folder.mkdir(parents=True)
        (folder / "same.csv").write_bytes(body)
    none = spark.createDataFrame([], "landing_path string")
    got = ingestion_outcomes(spark, str(tmp_path), F.col("delivery_date"), none)
    assert sorted(r.status for r in got.collect()) == ["failed", "success"]


def test_outcomes(spark, tmp_path):
    def put(name, data, day="2017-05-01"):
        folder = tmp_path / "in" / "sellers" / f"delivery_date={day}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / name).write_bytes(data)

    put("good.csv", BODY["plain.csv"].encode())
    put("landed.csv", BODY["plain.csv"].encode())
    put("latin.csv", f"{HEADER}\n1,1,S\xe3o,SP\n".encode("latin-1"))
    put("late.csv", (f"{HEADER}\n" + "1,1,a,b\n" * 5000).encode() + b"2,2,\xff,b\n")
    put("lacking.csv", b"seller_id\n1\n")
    put("empty.csv", b"")
    put("blank_header.csv", f"\n{HEADER}\n".encode())
    put("notes.txt", BODY["plain.csv"].encode())
    existing = spark.createDataFrame(
        [("raw/marketplace_platform/sellers/ingestion_date=2017-05-02/landed.csv",)], "landing_path string"
    )
    out = ingestion_outcomes(spark, str(tmp_path / "in"), F.date_add("delivery_date", 1), existing)
    got = {r.source_file_name: r for r in out.collect()}
    failed = {n: r.error_message.split()[0] for n, r in got.items() if r.status == "failed"}
    invalid = "category=source_validation_failed"
    assert failed == {
        "landed.csv": "category=storage_write_failed", "latin.csv": invalid, "late.csv": invalid, "lacking.csv": invalid,
        "empty.csv": invalid, "blank_header.csv": invalid, "notes.txt": invalid,
    }
    good = got["good.csv"]
    assert (good.status, good.record_count, good.file_size_bytes) == ("success", 2, len(BODY["plain.csv"]))
    assert good.landing_path == "raw/marketplace_platform/sellers/ingestion_date=2017-05-02/good.csv"
    assert good.checksum == hashlib.sha256(BODY["plain.csv"].encode()).hexdigest()
    assert got["landed.csv"].checksum is None
    text = " ".join(str(r) for r in out.select("error_message").collect())
    assert "S\xe3o" not in text and str(tmp_path) not in text


def test_conflicts_within_one_landing(spark):
    new = spark.createDataFrame([("a", "p1"), ("b", "p1"), ("c", "p2"), ("d", "p3")], "path string, landing_path string")
    old = spark.createDataFrame([("p2",)], "landing_path string")
    got = rows(landing_conflicts(new, old), "path", "conflict")
    assert got == [("a", False), ("b", True), ("c", True), ("d", False)]


def test_registry(spark):
    assert all(f.nullable and f.dataType.typeName() == "string" for f in raw_schema("products"))
    assert raw_schema("products").names[2] == "product_name_lenght"
    with pytest.raises(ValueError):
        raw_schema("nothing")
    unknown = spark.createDataFrame([("nothing", dt.date(2017, 5, 1))], "source_object string, d date")
    with pytest.raises(Exception, match="unsupported source_object: nothing"):
        with_registry(unknown).collect()
    with pytest.raises(Exception, match="unsupported source_object: nothing"):
        with_registry(unknown).select("d").collect()
    assert with_registry(unknown, strict=False).first().kind is None


def test_daily_rows_move_as_numbers(spark):
    """Texts of the daily rows are made behind the last move, and the writer has no texts to sort."""
    from workload import daily

    for source, rows_of in daily.daily_rows(spark, "/root/testdata/sf0.001", daily.by_day).items():
        plan = rows_of._jdf.queryExecution().optimizedPlan().toString()
        above, moved = plan.split("RebalancePartitions")
        assert "as string" in above and "as string" not in moved and "date_format" not in moved, source
        assert above.count("Sort ") == 1
        plain = daily.daily_rows(spark, "/root/testdata/sf0.001")[source]
        assert set(dict(rows_of.dtypes[:-1]).values()) == {"string"} and rows_of.columns == plain.columns
        assert rows(rows_of) == rows(plain)


def test_plain_lines_leave_in_runs(monkeypatch):
    """Only records with quotes are built one by one; the others stay in their batch, whatever their line ends and encoding."""
    lines = [b"name,x", *[b"n%d,1" % i for i in range(500)], b"ends\r", b"", b"\r", b"latin \xe9,2", b'"two', b'lines",3', b"last,4"]
    names = ["path", "block_start", "line", "owner"]
    columns = [["f"] * len(lines), [0] * len(lines), lines, [None] * len(lines)]
    whole = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, [pa.string(), pa.int64(), pa.binary(), pa.int64()])], names=names)
    single, build = [], blocks._records
    monkeypatch.setattr(blocks, "_records", lambda rows: single.extend(rows) or build(rows))
    for cut in (1, 250, 506, len(lines)):
        single.clear()
        found = [r for b in blocks._assembled(iter([whole[:cut], whole[cut:]])) for r in b.column("record").to_pylist()]
        expected = [f"n{i},1" for i in range(500)] + ["ends", "latin \ufffd,2", '"two\nlines",3', "last,4"]
        assert sorted(found) == sorted(expected)
        assert len(single) == 1


def test_all_sources_are_judged_in_one_scan(spark, monkeypatch):
    from workload import file_queries

    judged, facts = [], d.file_facts
    monkeypatch.setattr(d, "file_facts", lambda s, root: judged.append(root) or facts(s, root))
    scanned = file_queries.raw_csv_scan(spark, "/root/testdata/sf0.001")
    assert scanned.select("source_object").distinct().count() == 8
    assert len(judged) == 2
