"""CSV whose quoted values hold line ends, read by many tasks from one file.

Whether a line begins a record depends on the number of quotes before it. Each block of a
file is read as lines by its own task, which sums up the block for both cases, that it begins
outside or inside a value: its parity of quotes, and its last line that begins a record. The
blocks of a file, one short row each, are then gone through in order. With the case of its
block known, every task finds the records that begin in it. Only lines of records that go
over several lines are shuffled, to be put together; the others stay where they are.

Defined results, as by Spark's reader with ``multiLine``:
    the first record of each file is its header and is left out; columns go by position
    a quote inside a quoted value is written twice; quotes elsewhere are not allowed
    an unquoted nothing is NULL, a quoted one is empty text
    lines without anything are skipped outside of values; a file whose first line ends in CR LF
    has these line ends, which inside values become LF; any other file's line ends are LF, and
    a CR belongs to its value; the last line needs no end
    a value that is never closed goes to the end of its file; no rows: no rows
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from eventlens.operators.joins import fits
from eventlens.session import cut_lineage

#: Blocks whose cases are broadcast; more are joined by shuffle.
BLOCKS = 1_000_000
PARSING = {"quote": '"', "escape": '"', "emptyValue": "", "nullValue": r"\N", "multiLine": "true"}


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, at, quotes, cr, line): the lines of each block in order of ``at``."""
    text = spark.read.option("lineSep", "\n").text(path)
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                       F.monotonically_increasing_id().alias("at"), quotes.cast("long").alias("quotes"),
                       F.endswith("value", F.lit("\r")).cast("long").alias("cr"), F.col("value").alias("line"))


class _Running:
    """Goes through the lines of a task in order: quotes of the block before each line."""

    def __init__(self):
        self.block, self.before = None, 0

    def __call__(self, batch: pa.RecordBatch):
        """(start of each stretch of one block, its block, quotes before each of its lines)"""
        files, blocks = batch.column("file"), np.asarray(batch.column("block"))
        code = np.asarray(files.dictionary_encode().indices)
        new = np.ones(len(code), bool)
        new[1:] = (code[1:] != code[:-1]) | (blocks[1:] != blocks[:-1])
        quotes = np.asarray(batch.column("quotes"))
        for i, j in zip(np.flatnonzero(new), np.append(np.flatnonzero(new)[1:], len(new))):
            block = (files[int(i)].as_py(), int(blocks[i]))
            fresh = block != self.block
            if fresh:
                self.block, self.before = block, 0
            before = self.before + np.cumsum(quotes[i:j]) - quotes[i:j]
            self.before += int(quotes[i:j].sum())
            yield int(i), int(j), block, fresh, before


def _sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines to (file, block, odd, last_outside, last_inside, crlf) of each block: the last line
    that begins a record if the block begins outside or inside a value; ``crlf`` of a file's
    first block says whether its first line ends so."""
    running, found = _Running(), {}
    for batch in batches:
        at, cr = np.asarray(batch.column("at")), np.asarray(batch.column("cr"))
        for i, j, block, fresh, before in running(batch):
            row = found.setdefault(block, [0, None, None, 0])
            if fresh and block[1] == 0:
                row[3] = int(cr[i])
            for case in (0, 1):
                starts = np.flatnonzero(before % 2 == case)
                if len(starts):
                    row[1 + case] = int(at[i + starts[-1]])
            row[0] = running.before % 2
    yield pa.RecordBatch.from_arrays(
        [pa.array([b[0] for b in found], pa.string()), pa.array([b[1] for b in found], pa.int64()),
         *(pa.array([r[k] for r in found.values()], pa.int64()) for k in range(4))],
        ["file", "block", "odd", "last_outside", "last_inside", "crlf"])


def _begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines with their block's case to (at, record, whole, header, crlf, line)."""
    running, open_record = _Running(), None
    for batch in batches:
        at, quotes = np.asarray(batch.column("at")), np.asarray(batch.column("quotes"))
        record, whole, header = np.zeros(len(at), np.int64), np.zeros(len(at), bool), np.zeros(len(at), bool)
        for i, j, block, fresh, before in running(batch):
            if fresh:
                carried = batch.column("carried")[i].as_py()
                open_record = -1 if carried is None else carried
            outside = (before + batch.column("inside")[i].as_py()) % 2 == 0
            last = np.maximum.accumulate(np.where(outside, np.arange(j - i), -1))
            record[i:j] = np.where(last >= 0, at[i + np.maximum(last, 0)], open_record)
            open_record = int(record[j - 1])
            whole[i:j] = outside & (quotes[i:j] % 2 == 0)
            header[i] = fresh and block[1] == 0
        yield pa.RecordBatch.from_arrays(
            [batch.column("at"), pa.array(record), pa.array(whole), pa.array(header), batch.column("crlf"), batch.column("line")],
            ["at", "record", "whole", "header", "crlf", "line"])


def records(spark: SparkSession, path: str) -> DataFrame:
    """(record): the text of every record but the headers."""
    read = lines(spark, path)
    blocks = read.drop("line").mapInArrow(_sum_up, "file string, block long, odd long, last_outside long, last_inside long, crlf long")
    # one row for each block of a file
    ahead = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("odd").over(ahead), F.lit(0)) % 2
    cases = blocks.withColumn("inside", inside)
    last = F.when(F.col("inside") == 0, F.col("last_outside")).otherwise(F.col("last_inside"))
    cases = cases.withColumn("last", last).withColumn("carried", F.last("last", ignorenulls=True).over(ahead))
    cases = cases.withColumn("crlf", F.max("crlf").over(Window.partitionBy("file")))
    cases = cut_lineage(cases.select("file", "block", "inside", "carried", "crlf"))
    if fits(cases, BLOCKS):
        placed = read.join(F.broadcast(cases), ["file", "block"])
    else:       # the join by shuffle mixes the lines of a task
        placed = read.join(cases, ["file", "block"]).repartition("file", "block").sortWithinPartitions("file", "block", "at")
    begun = placed.select("file", "block", "at", "quotes", "line", "inside", "carried", "crlf").mapInArrow(
        _begin, "at long, record long, whole boolean, header boolean, crlf long, line string")
    alone = begun.where("whole AND NOT header").select("line", "crlf")
    joined = begun.where("NOT whole").groupBy("record").agg(
        F.array_sort(F.collect_list(F.struct("at", "line"))).alias("lines"), F.bool_or("header").alias("header"),
        F.max("crlf").alias("crlf"))
    several = joined.where("NOT header").select(F.array_join("lines.line", "\n").alias("line"), "crlf")
    plain = F.replace(F.regexp_replace("line", r"\r\z", ""), F.lit("\r\n"), F.lit("\n"))
    found = alone.unionByName(several).select(F.when(F.col("crlf") == 1, plain).otherwise(F.col("line")).alias("record"))
    return found.where("record <> ''")


def read_csv_split(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of the CSV files below ``path``, with any number of tasks for one file."""
    row = F.from_csv("record", schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), PARSING)
    return records(spark, path).select(row.alias("row")).select("row.*")
