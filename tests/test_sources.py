import os
from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.functions import split_fields
from millrace.sources import quarantine, text
from millrace.sources import (
    adjacency_lines,
    parse_adjacency,
    parse_edges,
    parse_points,
    read_csv,
    read_lines,
    schema_report,
    scratch_path,
    write_adjacency,
    write_csv,
)


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_split_drops_trailing_empty_fields_only(spark):
    df = lines(spark, "a,,b", "a,b,,", "", ",,", ",a", 'x,"y,z"')
    got = [r.f for r in df.select(split_fields(F.col("value")).alias("f")).collect()]
    assert got == [["a", "", "b"], ["a", "b"], [""], [], ["", "a"], ["x", '"y', 'z"']]


def test_split_on_regex_characters(spark):
    df = lines(spark, "a|b||", "a.b")
    assert df.select(split_fields(F.col("value"), "|").alias("f")).first().f == ["a", "b"]


def test_edges(spark):
    got = parse_edges(lines(spark, "7,1", "17,2,ignored")).collect()
    assert [(r.src, r.dst) for r in got] == [(7, 1), (17, 2)]


@pytest.mark.parametrize("bad", ["7", "7,x", "x,1"])
def test_bad_edge_is_an_error_or_null(spark, bad):
    with pytest.raises(PySparkException):
        parse_edges(lines(spark, bad)).collect()
    row = parse_edges(lines(spark, bad), lenient=True).first()
    assert row.src is None or row.dst is None


def test_adjacency_rows(spark):
    df = lines(spark, "1,2,3", "2,4", "3,4,,", "5")
    whole = {r.node: r.neighbours for r in parse_adjacency(df).collect()}
    assert whole == {1: [2, 3], 2: [4], 3: [4], 5: []}
    short = {r.node: r.neighbours for r in parse_adjacency(df, drop_last=True).collect()}
    assert short == {1: [2], 2: [], 3: [], 5: []}


def test_adjacency_file_round_trip(spark):
    rows = [(1, [2, 3]), (2, [4]), (9, [])]
    df = spark.createDataFrame(rows, "node bigint, neighbours array<bigint>")
    path = scratch_path(spark, "test")
    write_adjacency(df, path)
    back = read_lines(spark, path)
    assert sorted(r.value for r in back.collect()) == ["1,2,3", "2,4", "9"]
    assert sorted(tuple(r) for r in parse_adjacency(back).collect()) == rows
    assert adjacency_lines(df).columns == ["value"]


def test_points(spark):
    df = lines(spark, "2001-01-01,1.5,-2,3e1,0", "d,1,2,3,4,more")
    got = [tuple(r) for r in parse_points(df).collect()]
    assert got == [("2001-01-01", 1.5, -2.0, 30.0, 0.0), ("d", 1.0, 2.0, 3.0, 4.0)]
    assert parse_points(df, {"a": 1}, label=None).columns == ["a"]
    with pytest.raises(PySparkException):
        parse_points(lines(spark, "d,1,2,3")).collect()


def test_header_is_dropped_from_every_file(spark):
    df = spark.range(10).withColumn("name", F.concat(F.lit("n, "), "id")).repartition(3)
    path = scratch_path(spark, "test")
    write_csv(df, path)
    back = read_csv(spark, path)
    assert [f.dataType.simpleString() for f in back.schema] in (["int", "string"], ["bigint", "string"])
    assert sorted(tuple(r) for r in back.collect()) == [(i, f"n, {i}") for i in range(10)]
    assert read_csv(spark, path, "id bigint, name string").count() == 10


def test_schema_report(spark):
    df = spark.createDataFrame(
        [(1, None, datetime(2000, 1, 1)), (2, "a", None)], "a bigint, `b c` string, t timestamp"
    )
    assert [tuple(r) for r in schema_report(df).collect()] == [
        (0, "a", "bigint", 0),
        (1, "b c", "string", 1),
        (2, "t", "timestamp", 1),
    ]


def test_quarantine_names_file_and_line(spark, tmp_path):
    fields = [quarantine.Field("label", 0), quarantine.Field("x", 1, "double"), quarantine.Field("n", 3, "int")]
    files = {
        "a.txt": ["a,1.5,z,7", "b", "", "c,x,z,1", "d,2,z,1.5", "e,3,z,8,more"],
        "b.txt": [f"r{i},{i},z,{i}" for i in range(5000)] + ["bad,1,z"] + [f"s{i},{i},z,{i}" for i in range(3000)] + ["worse,,z,3"],
    }
    for name, lines in files.items():
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        checked = quarantine.check_fields(quarantine.read_located_lines(spark, str(tmp_path)), fields)
        bad = sorted((os.path.basename(r.file), r.line, r.reason, r.value) for r in checked.bad.collect())
        good = checked.good.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert bad == [
        ("a.txt", 2, "no field 1", "b"),
        ("a.txt", 3, "no field 1", ""),
        ("a.txt", 4, "field 1 is no double", "c,x,z,1"),
        ("a.txt", 5, "field 3 is no int", "d,2,z,1.5"),
        ("b.txt", 5001, "no field 3", "bad,1,z"),
        ("b.txt", 8002, "field 1 is no double", "worse,,z,3"),
    ]
    assert len(good) == 8002 and ("a", 1.5, 7) in [tuple(r) for r in good] and checked.good.columns == ["label", "x", "n"]


def test_adjacency_of_names_and_bad_ids(spark):
    lines = spark.createDataFrame([("a,b,c",), ("1,2,x,3",), ("x",)], "value string")
    assert [tuple(r) for r in text.parse_adjacency(lines, names=True).collect()] == [("a", ["b", "c"]), ("1", ["2", "x", "3"]), ("x", [])]
    assert [tuple(r) for r in text.parse_adjacency(lines, lenient=True).collect()] == [(None, []), (1, [2, 3]), (None, [])]
