"""Mixing sources to target weights by capped water-filling.

A corpus-wide budget of words is shared between sources in proportion to their weights; no
source gives more than ``max_epochs`` times what it holds, and what it cannot give goes to
the others, again by weight, until none is above its cap. A target of 1.7 epochs means every
document once and, in a seeded order, whole further repetitions of documents until 0.7 of
the source's words are reached.

Defined results
    null or wordless text: size 0, and nothing is taken from it in words
    null source: a source of its own, last in the order
    repeated rows, equal ids: each row is a document; rows alike in id and size are
    interchangeable, so the multiset of results is the same in each run
    no rows, or only empty texts: targets are 0; a source of empty texts gives nothing
    other columns, also such as ``size``: neither read nor changed by :func:`plan`;
    :func:`mix` returns the columns of its input and nothing else
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from eventlens.operators.joins import lookup_join
from eventlens.session import cut_lineage
from eventlens.llm.common import word_count

RATIO = 1.5
MAX_EPOCHS = 2.0
WEIGHTS = (3, 1, 2)
SEED = 20
#: Rows of one source that a task orders together, about.
BLOCK = 4096


def cyclic_weights(sources: DataFrame, source: str = "source",
                   cycle: Sequence[float] = WEIGHTS) -> DataFrame:
    """(source, weight): weights dealt to the distinct sources in code-point order, null last.

    One row per source is ordered in one task; documents are not.
    """
    order = Window.orderBy(F.col(source).isNull(), F.col(source))
    dealt = F.array(*[F.lit(float(w)) for w in cycle])
    at = (F.row_number().over(order) - 1) % len(cycle) + 1
    return sources.select(source).distinct().select(source, F.element_at(dealt, at).alias("weight"))


def water_fill(sources: DataFrame, ratio: float = RATIO, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """Targets of (source, source_size, weight): min(cap, level * weight), filled to the budget.

    The level is raised until no source is newly capped. Each step is one aggregate over the
    sources, of which three numbers come to the driver.
    """
    cap = F.col("source_size") * F.lit(float(max_epochs))
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    budget, level, capped = ratio * total, 0.0, -1
    while True:
        above = cap <= F.lit(level) * F.col("weight")
        n, held, free = sources.agg(F.count_if(above), F.sum(F.when(above, cap)),
                                    F.sum(F.when(~above, F.col("weight")))).first()
        if n == capped or not free:
            break
        capped, level = n, (budget - (held or 0.0)) / free
    target = F.least(cap, F.lit(level) * F.col("weight"))
    return sources.withColumn("target", target if free else cap)


def seeded(seed: int, doc_id: Column) -> Column:
    """A text that orders documents at random, the same in each run and engine."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def plan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
         weights: DataFrame | None = None, ratio: float = RATIO, max_epochs: float = MAX_EPOCHS,
         seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, repetitions, taken), one row per row of ``docs``.

    The seeded order inside a source is a prefix sum: documents fall into blocks by the first
    hexadecimal digits of their seeded key, a block is ordered by itself, and the words before
    it are added from the sums of the blocks. A document whose middle lies within the words
    still wanted is repeated once more. A hot source has more rows in each block, not one
    larger block, and the number of blocks follows the number of documents.
    """
    sized = cut_lineage(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
                                    word_count(text).alias("size"))
                        .withColumn("key", seeded(seed, F.col("doc_id"))))
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    weights = weights if weights is not None else cyclic_weights(sources)
    dealt = weights.select(F.col("source").alias("s"), F.col("weight").cast("double").alias("w"))
    sources = cut_lineage(sources.join(dealt, F.col("source").eqNullSafe(F.col("s")), "left")
                          .select("source", "source_size", F.coalesce("w", F.lit(0.0)).alias("weight")))
    targets = cut_lineage(water_fill(sources, ratio, max_epochs))
    digits = max(1, math.ceil(math.log(max(sized.count(), 1) / BLOCK, 16)) if BLOCK else 1)
    sized = sized.withColumn("block", F.substring("key", 1, digits))

    blocks = sized.groupBy("source", "block").agg(F.sum("size").alias("n"))
    earlier = (Window.partitionBy("source").orderBy("block")
               .rowsBetween(Window.unboundedPreceding, -1))
    starts = blocks.select(F.col("source").alias("s"), F.col("block").alias("b"),
                           F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    epochs = F.coalesce(F.try_divide(F.col("target"), F.col("source_size").cast("double")), F.lit(0.0))
    whole = F.least(F.floor(epochs), F.lit(math.floor(max_epochs)))
    placed = starts.join(targets, F.col("s").eqNullSafe(F.col("source"))).select(
        "s", "b", "start", "source_size", "target",
        F.coalesce(whole, F.lit(0)).cast("long").alias("whole"))

    inside = (Window.partitionBy("source", "block").orderBy("key", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    before = sized.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = before.join(placed, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")))
    middle = F.col("start") + F.col("before") + F.col("size") / 2
    rest = F.col("target") - F.col("whole") * F.col("source_size")
    joined = joined.withColumn("repetitions", F.col("whole") + (middle < rest).cast("long"))
    return joined.select("doc_id", "source", "size", "source_size", "target", "repetitions",
                         (F.col("size") * F.col("repetitions")).alias("taken"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        weights: DataFrame | None = None, ratio: float = RATIO, max_epochs: float = MAX_EPOCHS,
        seed: int = SEED) -> DataFrame:
    """``docs`` with every row as often as :func:`plan` takes it; same columns.

    In a source's seeded order the rows that are taken once more come first, so the last of
    them, by key, id and size, decides every other row where it lies: texts are not shuffled.
    Rows alike with that one in id and size, if not all of them are taken once more, are
    numbered; as many come out as the plan holds for them together.
    """
    shares = plan(docs, doc_id, text, source, weights, ratio, max_epochs, seed)
    place = F.struct(seeded(seed, F.col("doc_id")).alias("key"), F.col("doc_id").alias("id"), "size")
    shares = shares.select(F.col("source").isNull().alias("__none"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("__named"),
                           place.alias("place"), "repetitions")
    shares = cut_lineage(shares)
    same = ["__none", "__named"]
    bounds = shares.groupBy(*same).agg(F.min("repetitions").alias("__least"), F.max("repetitions").alias("__most"))
    bounds = cut_lineage(bounds)        # one row per source
    more = lookup_join(shares, bounds, same, ["place"]).where("repetitions > __least")
    last = more.groupBy(*same).agg(F.max("place").alias("__last"))
    last = cut_lineage(bounds.join(last, same, "left"))
    alike = lookup_join(shares, last.select(*same, "__last", "__least"), same, ["place"]).where("place = __last").groupBy(*same).agg(
        F.count(F.lit(1)).alias("__rows"), F.count_if(F.col("repetitions") > F.col("__least")).alias("__more"))
    last = cut_lineage(last.join(alike, same, "left"))
    own = docs.select("*", F.col(source).isNull().alias("__none"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("__named"),
                      F.struct(seeded(seed, F.col(doc_id)).alias("key"), F.col(doc_id).alias("id"), word_count(text).alias("size")).alias("__place"))
    joined = lookup_join(own, last, same, ["__place"])
    tied = (F.col("__place") == F.col("__last")) & (F.col("__more") < F.col("__rows"))
    first = F.col("__last").isNotNull() & (F.col("__place") <= F.col("__last"))
    joined = joined.withColumn("__tied", F.coalesce(tied, F.lit(False)))
    plain = joined.where("NOT __tied").withColumn("__times", F.when(first, F.col("__most")).otherwise(F.col("__least")))
    number = F.row_number().over(Window.partitionBy("__none", "__named", "__place").orderBy(*docs.columns))
    numbered = joined.where("__tied").withColumn("__times", F.when(number <= F.col("__more"), F.col("__most")).otherwise(F.col("__least")))
    return (plain.unionByName(numbered).where("__times > 0")
            .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times").cast("int"))))
            .select(*docs.columns))


def op10_mix(spark, sf_dir):
    from eventlens.llm.common import table
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source")
    return plan(docs).select("doc_id", "source", "size", "source_size",
                             F.round("target", 3).alias("target"), "repetitions", "taken")


ORACLE = f"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS key
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source COLLATE "binary" NULLS LAST) - 1) % 3
              WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight
  FROM sized GROUP BY source),
filled AS (  -- by the order in which rising water reaches the caps
  SELECT *, sum(source_size) OVER () * {RATIO} AS budget, {MAX_EPOCHS} * source_size AS cap,
         coalesce(sum({MAX_EPOCHS} * source_size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
         sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free
  FROM sources WINDOW w AS (ORDER BY {MAX_EPOCHS} * source_size / weight, source NULLS LAST)),
level AS (
  SELECT (budget - held) / free AS level FROM filled WHERE (budget - held) / free < cap / weight
  ORDER BY cap / weight, source NULLS LAST LIMIT 1),
targets AS (
  SELECT source, source_size, least(cap, coalesce(weight * (SELECT level FROM level), cap))::DOUBLE AS target
  FROM filled),
ordered AS (
  SELECT s.doc_id, s.source, s.size, t.source_size, t.target,
         CASE WHEN t.source_size = 0 THEN 0 ELSE least(floor(t.target / t.source_size), {math.floor(MAX_EPOCHS)}) END::BIGINT AS whole,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id, s.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + s.size / 2 AS middle
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
taken AS (
  SELECT *, whole + (middle < target - whole * source_size)::BIGINT AS repetitions FROM ordered)
SELECT doc_id, source, size, source_size, round(target, 3) AS target, repetitions,
       (size * repetitions)::BIGINT AS taken
FROM taken
"""
