"""Schema contract on CSV batches."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from lakeward.operators import contract as CT
from lakeward.plans.build import build_all
from lakeward.plans.validate import validate
from lakeward.sources.layout import read_layers, read_ledger
from lakeward.sources.batches import headers, parse_header, read_batches
from tests.conftest import GOLDEN_HEADER, write_csv


def row(n: int, amount: str = "4.25", status: str = "delivered", when: str = "2026-05-03 07:00:00") -> str:
    return f"e{n},o{n},c{n},north,{status},{amount},{when},2026-05-03 07:30:00"


def issue_set(spark, pattern) -> set[tuple[str, str, str]]:
    return {(i.file_name, i.column, i.issue) for i in CT.inspect(spark, str(pattern)).issues}


def test_additive_columns_pass(spark, tmp_path):
    write_csv(tmp_path, "wide.csv", "zone," + GOLDEN_HEADER + ",carrier", ["z1," + row(1) + ",post"])
    write_csv(tmp_path, "plain.csv", GOLDEN_HEADER, [row(2)])
    s = CT.inspect(spark, str(tmp_path / "*.csv"))
    assert s == CT.ContractSummary(2, {"plain.csv": [], "wide.csv": ["carrier", "zone"]}, [])


def test_missing_column_and_text_amount_are_rejected(spark, tmp_path):
    path = write_csv(tmp_path, "renamed.csv", GOLDEN_HEADER.replace("region", "area"), [row(1, amount="twelve"), row(2)])
    s = CT.inspect(spark, path)
    assert [(i.column, i.issue, i.observed) for i in s.issues] == [
        ("region", CT.MISSING, "missing"), ("order_amount", CT.INCOMPATIBLE, "VARCHAR")]
    assert s.issues[1].expected == "BIGINT, DECIMAL, DOUBLE, FLOAT, HUGEINT, INTEGER"
    assert s.additive_columns == {"renamed.csv": ["area"]}
    for gate in (lambda: CT.enforce(spark, path), lambda: build_all(spark, path, str(tmp_path / "wh"))):
        with pytest.raises(ValueError, match="raw schema compatibility failed: renamed.csv:region"):
            gate()


def two_folders(tmp_path, header: str, rows: list[str]):
    for folder in ("region=a", "region=b"):
        (tmp_path / folder).mkdir()
    write_csv(tmp_path / "region=a", "day.csv", GOLDEN_HEADER, [row(1), row(2)])
    return write_csv(tmp_path / "region=b", "day.csv", header, rows)


@pytest.mark.parametrize("pattern", ["*/day.csv", ""])
def test_files_of_one_name_are_checked_apart(spark, tmp_path, pattern):
    broken = two_folders(tmp_path, GOLDEN_HEADER.replace(",status", ""), ["e3,o3,c3,north,1.00,2026-05-03 07:00:00,2026-05-03 07:30:00"])
    s = CT.inspect(spark, str(tmp_path / pattern))
    assert s.files_checked == 2 and len(s.additive_columns) == 2
    assert [(i.file_name == "file:" + broken, i.column, i.issue) for i in s.issues] == [(True, "status", CT.MISSING)]
    with pytest.raises(ValueError, match="raw schema compatibility failed"):
        build_all(spark, str(tmp_path / pattern), str(tmp_path / "wh"))


def test_a_part_file_with_another_header_is_rejected(spark, tmp_path):
    (tmp_path / "b.csv").mkdir()
    write_csv(tmp_path / "b.csv", "part-00000.csv", GOLDEN_HEADER, [row(1)])
    write_csv(tmp_path / "b.csv", "part-00001.csv", GOLDEN_HEADER, [])  # rows in one part are enough
    write_csv(tmp_path / "b.csv", "part-00002.csv", GOLDEN_HEADER.replace("event_ts", "at"), [row(2)])
    s = CT.inspect(spark, str(tmp_path / "*.csv"))
    assert s.files_checked == 1 and [(i.file_name, i.column, i.issue) for i in s.issues] == [("b.csv", "event_ts", CT.MISSING)]


def test_files_that_land_after_the_gate_wait(spark, tmp_path):
    write_csv(tmp_path, "first.csv", GOLDEN_HEADER, [row(1)])
    seen = headers(spark, str(tmp_path / "*.csv"))
    write_csv(tmp_path, "later.csv", "order_id,event_id" + GOLDEN_HEADER[len("event_id,order_id"):], [row(9)])
    assert [r["event_id"] for r in read_batches(spark, str(tmp_path / "*.csv"), seen).collect()] == ["e1"]


@pytest.mark.parametrize("name", ["my batch.csv", "b[1].csv", "a+b%20.csv", "käse.csv"])
def test_special_characters_in_names(spark, tmp_path, name):
    path = write_csv(tmp_path, name, GOLDEN_HEADER, [row(1)])
    write_csv(tmp_path, "other.csv", GOLDEN_HEADER + ",extra", [row(2) + ",x"])
    assert CT.inspect(spark, str(tmp_path / "*.csv")) == CT.ContractSummary(2, {name: [], "other.csv": ["extra"]}, [])
    files = {r["event_id"]: r["source_file"] for r in read_batches(spark, str(tmp_path / "*.csv")).collect()}
    assert files["e1"] == "file:" + path


def test_quotes_and_quoted_line_breaks(spark, tmp_path):
    quoted = '"Acme ""North"", Inc"'
    write_csv(tmp_path, "q.csv", GOLDEN_HEADER, [row(1).replace("c1", quoted)])
    assert CT.inspect(spark, str(tmp_path / "q.csv")).issues == []
    assert read_batches(spark, str(tmp_path / "q.csv")).first()["customer_id"] == 'Acme "North", Inc'


def test_quoted_line_breaks_route_their_file_only(spark, tmp_path):
    # One file with a line break in a cell, one with a line break in the header, a plain one, a torn one.
    write_csv(tmp_path, "n.csv", GOLDEN_HEADER, [row(1).replace("c1", '"two\nlines"'), row(2)])
    write_csv(tmp_path, "h.csv", GOLDEN_HEADER + ',"extra\ncolumn"', [row(3) + ",x"])
    write_csv(tmp_path, "p.csv", GOLDEN_HEADER, [row(4)])
    hs = headers(spark, str(tmp_path / "*.csv"))
    found = CT.file_profiles(spark, hs)
    assert {r["file_path"].rsplit("/")[-1] for r in found.where("multiline").collect()} == {"n.csv", "h.csv"}
    summary = CT.summarise(spark, hs, found)
    assert summary.issues == [] and summary.additive_columns == {"h.csv": ["extra\ncolumn"], "n.csv": [], "p.csv": []}
    build_all(spark, str(tmp_path / "*.csv"), str(tmp_path / "wh"))
    bronze = read_layers(spark, str(tmp_path / "wh"))["bronze_orders"]
    assert {(r["event_id"], r["customer_id"]) for r in bronze.collect()} == {("e1", "two\nlines"), ("e2", "c2"), ("e3", "c3"), ("e4", "c4")}
    # A row that is torn in earnest is an issue whichever way its file is read.
    write_csv(tmp_path, "t.csv", GOLDEN_HEADER, [row(5).replace("c5", '"two\nlines"'), row(6) + ",surplus"])
    assert issue_set(spark, tmp_path / "t.csv") == {("t.csv", "*", CT.MALFORMED_ROWS)}


def test_the_ledger_spares_unchanged_files(spark, tmp_path, monkeypatch):
    write_csv(tmp_path, "a.csv", GOLDEN_HEADER, [row(1)])
    write_csv(tmp_path, "b.csv", "extra," + GOLDEN_HEADER, ["x," + row(2).replace("c2", '"c\n2"')])
    pattern, root = str(tmp_path / "*.csv"), str(tmp_path / "wh")
    build_all(spark, pattern, root)
    read = []
    whole = CT.cells_by_width
    monkeypatch.setattr(CT, "cells_by_width", lambda s, hs, m=False: read.append([h.label for h in hs]) or whole(s, hs, m))
    assert validate(spark, root, pattern).schema_additive_columns == {"a.csv": [], "b.csv": ["extra"]}
    assert sum(read, []) == []
    assert [h.known for h in headers(spark, pattern, read_ledger(spark, root))] == [True, True]
    # Another build takes the rows of unchanged files from the last version's ledger.
    write_csv(tmp_path, "c.csv", GOLDEN_HEADER, [row(3)])
    build_all(spark, pattern, root)
    assert sum(read, []) == ["c.csv"]
    assert sorted(r["event_id"] for r in read_layers(spark, root)["bronze_orders"].collect()) == ["e1", "e2", "e3"]
    # A file that changes is parsed again and its fault found.
    path = write_csv(tmp_path, "a.csv", GOLDEN_HEADER, [row(1, amount="none")])
    os.utime(path, (2_000_000_000, 2_000_000_000))
    read.clear()
    with pytest.raises(ValueError, match="a.csv:order_amount:incompatible_column_type"):
        validate(spark, root, pattern)
    assert sum(read, []) == ["a.csv"]


@pytest.mark.parametrize("bad", [row(2) + ",surplus", ",".join(row(2).split(",")[:4])])
def test_rows_of_another_width_are_rejected(spark, tmp_path, bad):
    write_csv(tmp_path, "r.csv", GOLDEN_HEADER, [row(1), bad, row(3)])
    s = CT.inspect(spark, str(tmp_path / "r.csv"))
    assert [(i.column, i.issue, i.observed) for i in s.issues if i.issue == CT.MALFORMED_ROWS] == [
        ("*", CT.MALFORMED_ROWS, "1 rows that differ")]


@pytest.mark.parametrize("text", ["", "\n" + GOLDEN_HEADER + "\n" + row(1) + "\n"])
def test_files_without_a_header_are_rejected(spark, tmp_path, text):
    write_csv(tmp_path, "good.csv", GOLDEN_HEADER, [row(1)])
    (tmp_path / "none.csv").write_text(text)
    s = CT.inspect(spark, str(tmp_path / "*.csv"))
    assert s.files_checked == 2
    assert {(i.file_name, i.column) for i in s.issues} == {("none.csv", c) for c in GOLDEN_HEADER.split(",")}


def test_impossible_times_are_rejected(spark, tmp_path):
    write_csv(tmp_path, "t.csv", GOLDEN_HEADER, [row(1, when="2026-02-30 09:00:00"), row(2)])
    assert issue_set(spark, tmp_path / "t.csv") == {("t.csv", "event_ts", CT.INCOMPATIBLE)}


@pytest.mark.parametrize("line,columns", [
    ("a,a,A", ("a", "a_1", "A_2")), ("a,,c", ("a", "column1", "c")), ('\ufeff"x, y",z\r\n', ("x, y", "z")), ("", ())])
def test_header_names(line, columns):
    assert parse_header(line) == columns


def test_columns_are_matched_by_name_across_files(spark, tmp_path):
    write_csv(tmp_path, "a.csv", GOLDEN_HEADER,
              ["evt-1,ord-1,cust-1,east,created,1.00,2026-04-20 09:00:00,2026-04-20 09:05:00"])
    write_csv(tmp_path, "b.csv", "ingestion_ts,event_ts,order_amount,status,region,customer_id,order_id,event_id,extra",
              ["2026-04-21 09:05:00,2026-04-21 09:00:00,2.50,delivered,west,cust-2,ord-2,evt-2,x"])
    rows = {r["event_id"]: r for r in read_batches(spark, str(tmp_path / "*.csv")).collect()}
    assert rows["evt-2"]["order_amount"] == "2.50" and rows["evt-2"]["region"] == "west"
    assert rows["evt-2"]["extra"] == "x" and rows["evt-1"]["extra"] is None
    assert CT.inspect(spark, str(tmp_path / "*.csv")).issues == []


def test_header_only_file_is_rejected(spark, tmp_path):
    write_csv(tmp_path, "empty.csv", GOLDEN_HEADER, [])
    s = CT.inspect(spark, str(tmp_path / "*.csv"))
    assert {(i.column, i.observed) for i in s.issues} == {
        ("order_amount", "VARCHAR"), ("event_ts", "VARCHAR"), ("ingestion_ts", "VARCHAR")}


@pytest.mark.parametrize("values,expected", [
    (["1", "2"], "BIGINT"),
    (["1", "99999999999999999999"], "HUGEINT"),
    (["1", "2.5"], "DOUBLE"),
    (["007"], "VARCHAR"),
    (["+5"], "VARCHAR"),
    (["1e3", "NaN", ".5"], "DOUBLE"),
    (["true", "false"], "BOOLEAN"),
    (["12:30:00"], "TIME"),
    (["2026-01-01"], "DATE"),
    (["2026-01"], "VARCHAR"),
    (["2026-02-29"], "VARCHAR"),
    (["25:00:00"], "VARCHAR"),
    (["2026-01-01 10:00", "2026-01-01T10:00:00.5"], "TIMESTAMP"),
    (["2026-01-01 10:00:00+02:00", "2026-01-01 10:00:00Z"], "TIMESTAMP WITH TIME ZONE"),
    (["2026-01-01 10:00:00", "2026-01-01 10:00:00+02:00"], "TIMESTAMP WITH TIME ZONE"),
    (["2026-01-01", "2026-01-01 10:00:00"], "VARCHAR"),
    (["2026-01-01", ""], "DATE"),
    ([""], "VARCHAR"),
])
def test_type_verdicts(spark, values, expected):
    df = spark.createDataFrame([(v if v != "" else None,) for v in values], "v string")
    masks = df.agg(F.expr(f"coalesce(bit_or({CT.value_class_bit('v')}), 0)").alias("m"))
    assert masks.select(F.expr(CT.verdict("m"))).first()[0] == expected


def test_values_are_trimmed_before_classification(spark, tmp_path):
    write_csv(tmp_path, "padded.csv", GOLDEN_HEADER,
              ["evt-1,ord-1,cust-1,east,created, 5 ,2026-04-20 09:00:00 , 2026-04-20 09:05:00"])
    obs = {r["column"]: r["observed_type"] for r in CT.observed_types(spark, str(tmp_path / "*.csv")).collect()}
    assert obs["order_amount"] == "BIGINT" and obs["event_ts"] == "TIMESTAMP" and obs["ingestion_ts"] == "TIMESTAMP"


def test_header_reader_ships_without_the_package():
    # Executors may not have this package installed: the mapInPandas body
    # must pickle by value and not import it.
    import subprocess
    import sys

    from pyspark import cloudpickle

    from lakeward.sources.batches import _first_lines_fn
    payload = cloudpickle.dumps(_first_lines_fn())
    code = ("import pickle, sys; f = pickle.loads(sys.stdin.buffer.read()); "
            "import importlib.util as u; assert u.find_spec('lakeward') is None; print(callable(f))")
    done = subprocess.run([sys.executable, "-c", code], input=payload, capture_output=True, cwd="/",
                          env={"PATH": "/usr/bin:/bin"}, timeout=120)
    assert done.returncode == 0, done.stderr.decode()[-500:]
    assert done.stdout.strip() == b"True"
