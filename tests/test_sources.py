"""Workbooks and committed refreshes."""

from __future__ import annotations

import datetime as dt
import io
import os
import zipfile

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quipu.sources import committed, workbook

KINDS = "i long, t string, x double, b boolean, d date, ts timestamp"
ROWS = [
    (1, "two\nlines & <tags>", 1.5, True, dt.date(2024, 2, 29), dt.datetime(2024, 2, 29, 13, 14, 15, 678901)),
    (None, None, None, None, None, None),
    (2**53 + 1, "_x0041_ \x07 \r tab\t", -1e-300, False, dt.date(1999, 1, 1), dt.datetime(1999, 1, 1)),
    (-7, "", 0.1, None, None, None),
    (8, " é 日本 😀 ", 1e300, True, dt.date(2100, 12, 31), dt.datetime(2030, 7, 8, 9, 10, 11)),
    (9, "12", 2.0, True, None, None),
]


def schema():
    return StructType.fromDDL(KINDS)


@pytest.mark.parametrize("parts", [1, 3])
def test_workbook_round_trip(spark, tmp_path, monkeypatch, parts):
    monkeypatch.setattr(workbook, "BATCH_ROWS", 2)
    monkeypatch.setattr(workbook, "SHEET_ROWS", 4)  # several sheets
    out = io.BytesIO()
    assert workbook.write_workbook(out, schema().names, ROWS) == len(ROWS)
    (tmp_path / "a.xlsx").write_bytes(out.getvalue())
    got = [r for p in range(parts) for r in workbook.sheet_rows(out.getvalue(), None, parts, p)]
    assert len(got) == len(ROWS)
    back = workbook.read_workbooks(spark, str(tmp_path), schema(), parts=parts).collect()
    assert sorted(map(tuple, back), key=repr) == sorted(ROWS, key=repr)


def test_shared_strings_other_calendars_and_odd_cells(spark, tmp_path):
    main = workbook._MAIN
    sheet = (
        f'<worksheet xmlns="{main}"><sheetData><row><c t="s"><v>0</v></c><c t="s"><v>1</v></c><c r="D1" t="s"><v>2</v></c></row>'
        '<row><c t="s"><v>3</v></c><c><v>5.0</v></c><c r="D2"><v>0</v></c></row>'
        '<row><c r="B3" t="e"><v>#N/A</v></c><c r="D3"><v>x</v></c></row><row/></sheetData></worksheet>'
    )
    strings = f'<sst xmlns="{main}"><si><t>name</t></si><si><t>n</t></si><si><t>day</t></si><si><r><t>rich </t></r><r><t>text</t></r><rPh><t>no</t></rPh></si></sst>'
    with zipfile.ZipFile(tmp_path / "odd.xlsx", "w") as book:
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{workbook._LINKS}"><workbookPr date1904="1"/><sheets><sheet name="S &amp; T" r:id="a"/></sheets></workbook>')
        book.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="a" Target="/xl/worksheets/one.xml"/></Relationships>')
        book.writestr("xl/worksheets/one.xml", sheet)
        book.writestr("xl/sharedStrings.xml", strings)
    wanted = StructType.fromDDL("n long, name string, day date, absent string")
    rows = workbook.read_workbooks(spark, str(tmp_path), wanted, sheet="S & T").collect()
    assert [tuple(r) for r in rows] == [(5, "rich text", dt.date(1904, 1, 1), None), (None, None, None, None), (None, None, None, None)]
    assert workbook.read_workbooks(spark, str(tmp_path), wanted, sheet="other").count() == 0


def test_a_failing_task_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    old = spark.range(100).withColumn("v", F.lit("old"))
    committed.refresh(old, path)
    bad = spark.range(0, 100, 1, 4).withColumn("v", F.when(F.col("id") == 99, F.raise_error(F.lit("lost"))).otherwise(F.lit("new")))
    with pytest.raises(PySparkException):
        committed.refresh(bad, path)
    assert committed.read_refreshed(spark, path, old.schema).groupBy("v").count().collect() == [("old", 100)]
    assert len(os.listdir(f"{path}/data")) == 1  # what the failed job wrote is gone
    committed.refresh(spark.range(5).withColumn("v", F.lit("new")), path)
    assert committed.read_refreshed(spark, path, old.schema).count() == 5


def test_a_task_that_outlives_its_failed_job_leaves_nothing(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(committed.TaskContext, "get", lambda: type("Late", (), {"partitionId": lambda self: 0})())
    writer = committed.CommittedWriter(str(tmp_path / "t"), "parquet", spark.range(1).schema)
    writer.abort([])
    with pytest.raises(OSError):
        writer.write(iter([]))
    assert os.listdir(tmp_path / "t/data") == []


def test_files_of_other_attempts_are_no_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(50).withColumn("v", F.lit("x"))
    committed.refresh(rows, path)
    folder = f"{path}/data/{os.listdir(f'{path}/data')[0]}"
    first = sorted(os.listdir(folder))[0]
    with open(f"{folder}/{first}", "rb") as file, open(f"{folder}/part-000000-twin.parquet", "wb") as twin:
        twin.write(file.read())
    os.makedirs(f"{path}/data/99999999999999999999-unfinished")
    assert committed.read_refreshed(spark, path, rows.schema).count() == 50


def test_columns_are_checked_by_position(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "a")], "k long, v string")
    committed.refresh(rows, path, columns="k bigint, v string")
    with pytest.raises(PySparkException, match="target has the columns"):
        committed.refresh(rows.select("v", "k"), path, columns="k bigint, v string")
    assert committed.read_refreshed(spark, path, rows.schema).collect() == [(1, "a")]


def test_an_empty_frame_empties_the_target(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a")], "k long, v string")
    for kind in ("parquet", "xlsx"):
        path = str(tmp_path / kind)
        committed.refresh(rows, path, kind)
        committed.refresh(rows.limit(0), path, kind)
        assert committed.read_refreshed(spark, path, rows.schema).count() == 0
