"""Quoted CSV cut at true record ends, against the reader that keeps a file in one task."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from starloom.sources import readers
from starloom.sources.quoted import header_names, quoted_records, split_states

DECLARED = "job_id bigint, title string, description string, views double"


def _write(path, rows, header=("job_id", "title", "description", "views"), end="\n"):
    text = io.StringIO(newline="")
    out = csv.writer(text, lineterminator=end)
    out.writerow(header)
    out.writerows(rows)
    path.write_text(text.getvalue(), encoding="utf-8", newline="")


def _rows(n, seed=3):
    draw = random.Random(seed)
    bits = ["plain", 'say "so"', "two\nlines", "a,b", '"', "\n\n", "é ü 日本", "", "end\n", '","', "x" * 300]
    return [(i, draw.choice(bits) or None, "".join(draw.choice(bits) for _ in range(draw.randrange(6))) or None, draw.randrange(100)) for i in range(n)]


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _plain(spark, path):
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').schema(DECLARED).csv(path)


def _key(rows):
    return sorted((tuple(r) for r in rows), key=str)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_like_the_multi_line_reader(spark, tmp_path, small_splits, end):
    rows = _rows(900)
    rows[400] = (400, "long", "line\n" * 3000, 1)  # a value over several splits
    _write(tmp_path / "a.csv", rows, end=end)
    path = str(tmp_path / "a.csv")
    found = readers._read_csv(spark, path, DECLARED, True)
    assert split_states(spark, path).count() > 20
    expected = [(i, t, d, float(v)) for i, t, d, v in rows]
    assert _key(found.collect()) == _key(expected)
    if end == "\n":
        assert _key(found.collect()) == _key(_plain(spark, path).collect())


def test_several_files_headers_and_blank_lines(spark, tmp_path, small_splits):
    _write(tmp_path / "a.csv", _rows(200, 1))
    _write(tmp_path / "b.csv", _rows(200, 2))
    _write(tmp_path / "c.csv", [(1000, "only\nthis", 5)], header=("job_id", 'Odd "name"\nof two lines', "views"))
    (tmp_path / "d.csv").write_text("job_id,title,description,views\n\n2000,t,d,1\n\n", encoding="utf-8")
    (tmp_path / "e.csv").write_text("", encoding="utf-8")
    (tmp_path / "f.csv").write_text("\n\r\njob_id,views\n3000,7\n", encoding="utf-8", newline="")
    long = "h\n" * 4000
    (tmp_path / "g.csv").write_text(f'job_id,"{long}"\n4000,"a\nb"\n', encoding="utf-8", newline="")
    found = readers._read_csv(spark, str(tmp_path), DECLARED, True)
    assert found.count() == 404
    assert found.where("job_id = 3000").first().views == 7.0 and found.where("job_id = 4000").first()[long] == "a\nb"
    odd = found.where("job_id = 1000").first()
    assert odd['Odd "name"\nof two lines'] == "only\nthis" and odd.description is None and odd.views == 5.0
    assert found.where("job_id = 2000").select("title", "description").first() == ("t", "d")


def test_records_keep_their_text(spark, tmp_path, small_splits):
    rows = _rows(300, 9)
    _write(tmp_path / "a.csv", rows)
    records, heads = quoted_records(spark, str(tmp_path))
    assert [r.header for r in heads.collect()] == ["job_id,title,description,views"]
    texts = sorted(r.text for r in records.where(~F.col("first")).collect())
    expected = []
    for row in rows:
        line = io.StringIO(newline="")
        csv.writer(line, lineterminator="").writerow(row)
        expected.append(line.getvalue())
    assert texts == sorted(expected)


def test_header_names():
    assert header_names('﻿a,"b ""x""",,a,c\r') == ["a", 'b "x"', "_c2", "a3", "c"]
