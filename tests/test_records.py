"""Multi-line CSV in many tasks against Python's csv module."""

import csv
import io
import random

import pytest
from pyspark.sql import types as T

from tradewind.schemas import RAW_SCHEMAS
from tradewind.sources import write_csv
from tradewind.sources.records import records
from tradewind.sources.tables import read_csv

SCHEMA = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.IntegerType()), T.StructField("c", T.StringType())])


@pytest.fixture(params=[7, 64, 1000, None])
def block_bytes(request, spark):
    """Blocks of so few bytes that borders fall everywhere."""
    keys = {"spark.sql.files.maxPartitionBytes": request.param, "spark.sql.files.openCostInBytes": 0}
    before = {key: spark.conf.get(key) for key in keys}
    if request.param:
        for key, value in keys.items():
            spark.conf.set(key, str(value))
    yield request.param
    for key, value in before.items():
        spark.conf.set(key, value)


def odd_rows(n, seed):
    rng = random.Random(seed)
    parts = ['"', '""', "\n", "\r\n", ",", "x", "words and more", "é", "日本", "\n\n", " ", "'"]
    return [("".join(rng.choice(parts) for _ in range(rng.randint(1, 8))).strip() or "y", i, f"t{i}") for i in range(n)]


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
@pytest.mark.parametrize("mark", ["", "﻿"])
def test_rows_are_those_of_a_csv_reader(spark, tmp_path, block_bytes, ending, mark):
    rows = odd_rows(60, len(ending) + 2 * len(mark))
    for i in range(2):
        out = io.StringIO()
        writer = csv.writer(out, lineterminator=ending)
        writer.writerow(["a", "b", "c"])
        writer.writerows(rows[i::2])
        text = mark + out.getvalue() + ("" if i else ending)
        (tmp_path / f"{i}.csv").write_bytes((text if i else text[:-len(ending)]).encode())
    df = read_csv(spark, str(tmp_path), SCHEMA, multi_line=True, missing_words=(), place="place")
    got = sorted(df.collect(), key=lambda r: r.b)
    expected = sorted(list(csv.reader(io.StringIO((tmp_path / "0.csv").read_bytes().decode("utf-8-sig"), newline="")))[1:]
                      + list(csv.reader(io.StringIO((tmp_path / "1.csv").read_bytes().decode("utf-8-sig"), newline="")))[1:],
                      key=lambda r: int(r[1]) if r else -1)
    expected = [row for row in expected if row]
    assert [(r.a, r.b, r.c) for r in got] == [(a, int(b), c) for a, b, c in expected]
    for i in range(2):
        places = [r.place for r in got[i::2]]
        assert places == sorted(places) and len(set(places)) == len(places)
    if block_bytes == 7:
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 8


def test_documents_in_eight_tasks(spark, sf_dir, tmp_path):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = str(tmp_path / "csv")
    write_csv(documents.coalesce(1), path)
    keys = {"spark.sql.files.maxPartitionBytes": "20000", "spark.sql.files.openCostInBytes": "0"}
    before = {key: spark.conf.get(key) for key in keys}
    try:
        for key, value in keys.items():
            spark.conf.set(key, value)
        assert spark.read.text(path).rdd.getNumPartitions() >= 8
        again = read_csv(spark, path, documents.schema, multi_line=True, missing_words=())
        assert sorted(map(tuple, again.collect())) == sorted(map(tuple, documents.collect()))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_only_pieces_are_shuffled(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b,c\n1,2,3\n")
    text = records(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_values_that_do_not_parse_and_short_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b,c\n"x\ny",no,z\nshort\n"open, to the\nend')
    got = sorted(map(tuple, read_csv(spark, str(tmp_path / "a.csv"), SCHEMA, multi_line=True).collect()), key=str)
    assert got == sorted([("x\ny", None, "z"), ("short", None, None), ("open, to the\nend", None, None)], key=str)


def test_no_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b,c\n")
    (tmp_path / "b.csv").write_text("")
    assert read_csv(spark, str(tmp_path), SCHEMA, multi_line=True, place="n").collect() == []
    assert RAW_SCHEMAS["reviews"]
