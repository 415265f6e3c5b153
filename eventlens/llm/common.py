"""What several operators of this subpackage share: words, whole texts, connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eventlens.session import cut_lineage

#: A word is a run of anything but the space and the five ASCII control characters tab to CR.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").select(*columns)


def whole(text: Column | str) -> Column:
    """The text; empty for null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: Column | str) -> Column:
    """The words of a text in order; an empty array for null."""
    return F.filter(F.split(whole(text), GAP), lambda w: w != "")


def word_count(text: Column | str) -> Column:
    return F.regexp_count(whole(text), F.lit(WORD)).cast("long")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) for every id of ``edges``; the component is its smallest id.

    Each round every id takes the smallest label among itself and its neighbours, and the
    edges are carried over to the labels: an edge becomes one between the labels of its ends,
    so the graph shrinks to the roots still to be joined, and a star of any size is done in
    one round. Labels and edges are written to the shared folder in each round; only a row
    count comes to the driver. An id with very many neighbours is a hash aggregate with a
    partial step, and a join whose large side can be split.
    """
    both = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x <> y")
    both = cut_lineage(both.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
                       .distinct())
    nodes = both.select(F.col("x").alias("id")).union(both.select("y")).distinct()
    labels = cut_lineage(nodes.select("id", F.col("id").alias("component")))
    while True:
        step = roots(both)
        labels = cut_lineage(
            labels.join(step.withColumnRenamed("x", "component"), "component", "left")
                  .select("id", F.coalesce("root", "component").alias("component")))
        carried = (both.join(step, "x", "left").select("y", F.coalesce("root", "x").alias("x"))
                   .join(step.select(F.col("x").alias("y"), F.col("root").alias("r")), "y", "left")
                   .select("x", F.coalesce("r", "y").alias("y")).where("x <> y"))
        both = cut_lineage(carried.select(F.least("x", "y").alias("x"),
                                          F.greatest("x", "y").alias("y")).distinct())
        if both.isEmpty():
            return labels


def roots(both: DataFrame) -> DataFrame:
    """(x, root): the smallest id that ``x`` reaches by going to its smallest neighbour, again
    and again; ids that stay where they are have no row.

    Pointers go strictly down, so they form trees; doubling them reaches the root in a number
    of steps that grows with the logarithm of the depth.
    """
    up = both.groupBy(F.col("y").alias("x")).agg(F.min("x").alias("root"))
    up = cut_lineage(up)
    while True:
        far = up.join(up.select(F.col("x").alias("root"), F.col("root").alias("next")), "root", "left")
        up = cut_lineage(far.select("x", F.coalesce("next", "root").alias("root"),
                                    F.col("next").isNotNull().alias("moved")))
        if up.where("moved").isEmpty():
            return up.select("x", "root")
        up = up.select("x", "root")
