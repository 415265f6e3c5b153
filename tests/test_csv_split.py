"""CSV with line ends inside quotes, split: equal to Spark's reader on odd files."""

import random

import pytest
from pyspark.sql import types as T

from eventlens.sources import connectors, csv_split

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("note", T.StringType())])


@pytest.fixture
def small_blocks(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def content(rows, end="\n", last=True):
    def quoted(v):
        return "" if v is None else '"' + v.replace('"', '""') + '"'
    lines = ["id,name,note"] + [f"{i},{quoted(n)},{quoted(t)}" for i, n, t in rows]
    return end.join(lines) + (end if last else "")


def some(seed, n=120):
    draw = random.Random(seed)
    word = ["a", '"', '""', "\n", "\n\n", "\r\n", ",", "é", "東京", " ", "x" * 40, "\n" * 30, '",\n"', "'"]
    return [(i, *(None if draw.random() < .1 else "".join(draw.choice(word) for _ in range(draw.randrange(9))) for _ in range(2)))
            for i in range(n)]


def same(spark, folder, several_tasks=True):
    path = str(folder)
    want = sorted(map(repr, connectors.read_csv(spark, path, SCHEMA).collect()))
    got = csv_split.read_csv_split(spark, path, SCHEMA)
    assert sorted(map(repr, got.collect())) == want
    if several_tasks:
        assert csv_split.lines(spark, path).rdd.getNumPartitions() > 3
    return want


@pytest.mark.parametrize("blocks", [csv_split.BLOCKS, 0])
def test_odd_files_equal_sparks_reader(spark, tmp_path, small_blocks, monkeypatch, blocks):
    monkeypatch.setattr(csv_split, "BLOCKS", blocks)
    folder = tmp_path / "files"
    folder.mkdir()
    (folder / "a.csv").write_bytes(content(some(1)).encode())
    (folder / "b.csv").write_bytes(content(some(2), "\r\n").encode())
    (folder / "c.csv").write_bytes(content(some(3), last=False).encode())
    (folder / "d.csv").write_bytes(b"id,name,note\n")
    (folder / "e.csv").write_bytes(b'id,"na\nme",note\n\n7,"","x"\n\n8,,\n')
    rows = same(spark, folder)
    assert len(rows) == 362


def test_one_file_with_one_long_value(spark, tmp_path, small_blocks):
    file = tmp_path / "long.csv"
    long = "\n".join(f"line {i}, \"said\"" for i in range(400))
    file.write_bytes(content([(1, "first", "a"), (2, long, None), (3, "", "z")]).encode())
    assert len(same(spark, file)) == 3


def test_what_the_writer_wrote(spark, tmp_path, small_blocks):
    folder = str(tmp_path / "out")
    rows = [(i, n, t) for i, n, t in some(5, 60) if (n, t) != ("", "")]
    connectors.write_csv(spark.createDataFrame(rows, SCHEMA).coalesce(1), folder)
    assert len(same(spark, folder)) == len(rows)
