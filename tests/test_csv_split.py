"""CSV files read in many splits against Spark's one-task reader."""

import random

import pytest
from pyspark.sql import functions as F

from vitrina.sources.csv import _CORRUPT, read_csv_raw
from vitrina.sources.csv_split import csv_records, line_effect


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "400")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def both(spark, path, **opts):
    frames = [read_csv_raw(spark, path, split=s, **opts) for s in (True, False)]
    return [sorted(map(tuple, f.collect()), key=str) for f in frames]


def cell(rng):
    kind = rng.random()
    if kind < 0.5:
        return "".join(rng.choices("abc 5é", k=rng.randint(0, 8)))
    if kind < 0.6:
        return 'pipe 5" long'  # a quote that opens nothing
    body = "".join(rng.choices(["a", ",", "\n", '""', "x y", "\r\n"], k=rng.randint(0, 12)))
    return f'"{body}"'


@pytest.mark.parametrize("seed", range(4))
def test_like_one_task(spark, tmp_path, small_splits, seed):
    rng = random.Random(seed)
    for i in range(2):
        rows = ["a,b,\"c\nd\""] + [f"{n},{cell(rng)},{cell(rng)}" + (",more" if n % 37 == 5 else "") for n in range(400)]
        end = "\r\n" if seed == 3 else "\n"
        (tmp_path / f"f{i}.csv").write_bytes((end.join(rows) + end * (i + 1)).encode())
    assert csv_records(spark, str(tmp_path)).rdd.getNumPartitions() > 4
    split, one = both(spark, str(tmp_path))
    if seed == 3:  # where quoted cells hold plain newlines too, Spark's reader leaves the carriage returns at the ends
        bare = [tuple(x.rstrip("\r") if x else x for x in r) for r in one if r[0] != "\r"]
        assert sorted((tuple(x or None for x in r) for r in bare), key=str) == split
        return
    assert len(split) == 800 and split == one


def test_cell_over_many_splits(spark, tmp_path, small_splits):
    long = "\n".join("line, %d of ""a"" cell" % i for i in range(300))
    (tmp_path / "f.csv").write_text(f'id,text\n1,x\n2,"{long}"\n3,"y\nz"\n4,"{long}"')
    split, one = both(spark, str(tmp_path))
    assert split == one and [r[0] for r in split] == ["1", "2", "3", "4"] and split[1][1] == long


def test_never_closed_empty_and_without_header(spark, tmp_path, small_splits):
    (tmp_path / "open").mkdir()
    (tmp_path / "open" / "f.csv").write_text("a,b\n1,2\n\n3,\"never\n" + "closed\n" * 200)
    rows = csv_records(spark, str(tmp_path / "open")).orderBy(F.length("record")).collect()
    assert [r["first"] for r in rows] == [True, False, False] or sorted(r["first"] for r in rows) == [False, False, True]
    assert len(rows) == 3 and rows[2]["record"].count("closed") == 200
    (tmp_path / "none.csv").write_text("")
    assert read_csv_raw(spark, str(tmp_path / "none.csv"), ["a", "b"]).count() == 0
    (tmp_path / "plain.csv").write_text("1,2\n3\n4,5,6\n")
    split, one = both(spark, str(tmp_path / "plain.csv"), columns=["a", "b"])
    assert split == one and len(split) == 3
    assert read_csv_raw(spark, str(tmp_path / "plain.csv"), ["a", "b"]).where(F.col(_CORRUPT).isNotNull()).count() == 2


def test_line_effect():
    f = line_effect(",", '"')
    assert not f('a,"b",c', False) and f('a,"b', False) and not f('5" x', False) and f('"a""', False)
    assert f("plain", True) and not f('end"', True) and f('end","again', True) and f('a,"', False) and not f('a,"', True)
    assert not f('"a"b"c', False) and f('""', True) and not f('"""",x', False)
