import csv
import random

import pytest

import plumbline as pl
from plumbline.functions import columns
from plumbline.sources import split_csv


@pytest.fixture
def small_blocks(spark):
    """Splits of some hundred bytes, one to a task."""
    keys = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "300"}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k in keys:
        spark.conf.unset(k)


def write(path, rows, end="\n", header=("id", "text", "note")):
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f, lineterminator=end)
        out.writerow(header)
        out.writerows(rows)


def made(n, seed):
    rng = random.Random(seed)
    cells = ["plain", 'say "hi"', "two\nlines", "a,b", "é\n\n\"x\"\n", "long " * 80 + "\n" + "tail " * 150, '"', "x\n" * 300 + "y"]
    return [(i, rng.choice(cells), rng.choice(cells[:5])) for i in range(n)]


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_over_many_blocks_equal_the_file(spark, tmp_path, small_blocks, end):
    folder = tmp_path / "t.csv"
    folder.mkdir()
    want = []
    for k in range(2):
        rows = made(120, k)
        write(folder / f"part{k}.csv", rows, end)
        want += rows
    df = pl.read_table(spark, str(folder), multi_line="split", schema="id int, text string, note string")
    assert rows_of(df) == sorted(want)
    assert rows_of(df) == rows_of(pl.read_table(spark, str(folder), schema="id int, text string, note string"))
    lines = spark.read.option("lineSep", "\n").text(str(folder))
    assert lines.rdd.getNumPartitions() > 50
    assert rows_of(df.select("id")) == [(i,) for i in sorted(r[0] for r in want)]


def test_blocks_beyond_a_broadcast_are_sorted_back(spark, tmp_path, small_blocks, monkeypatch):
    path = tmp_path / "t.csv"
    write(path, made(60, 5))
    monkeypatch.setattr(split_csv, "small_rows", lambda df: None)
    assert rows_of(pl.read_table(spark, str(path), multi_line="split", schema="id int, text string, note string")) == sorted(made(60, 5))


def test_types_blank_lines_header_and_wrong_rows(spark, tmp_path, small_blocks):
    path = tmp_path / "t.csv"
    path.write_text('\n"a ""b""\nc",d\n1,x\n\n2,"NA"\n3,"y\n\nz"')
    df = pl.read_table(spark, str(path), multi_line="split")
    assert df.columns == ['a "b"\nc', "d"] and df.dtypes[0][1] == "bigint"
    assert rows_of(df.fillna("-")) == [(1, "x"), (2, "-"), (3, "y\n\nz")]
    path.write_text("a,b\n")
    assert pl.read_table(spark, str(path), multi_line="split").count() == 0
    path.write_text("a,b\n1,2\n3\n")
    with pytest.raises(Exception):
        pl.read_table(spark, str(path), multi_line="split", schema="a int, b int").select("a").collect()
    path.write_text('"a\n' + "b" * 900 + '\nc",d\n1,2\n')
    with pytest.raises(Exception, match="header"):
        pl.read_table(spark, str(path), multi_line="split", schema="a int, b int").collect()
