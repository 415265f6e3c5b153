"""Document fingerprints: a Merkle tree over units, paragraphs and sections of a text.

A text is tiled without gaps: a unit is a sentence (or 160 characters of one that goes on),
a paragraph ends with a line, and a section ends after a paragraph whose last unit's digest
begins with 0, 1, 2 or 3, so that an edit moves no section border but its own. A leaf is
the SHA-256 of a unit, cut to 128 bits; every node above is the SHA-256 of its children.
Equal roots mean equal texts; where roots differ, only branches with other digests are
looked into, which locates the edit.

The fingerprint is the tree as text: the root, then for each section ``/``, its digest and
the digests of its leaves, ``.`` after a leaf and ``,`` after one that ends a paragraph
(8 hexadecimal digits each).

Defined results
    null text: that of the empty text, whose tree has a root and no leaf
    likeness: 2 * common / (own + other) over distinct leaves; 1 for two trees without leaves
    following texts: rows in descending order of the id, null ids last, rows of one id by
    text; after the last comes the first; a single row follows itself
    very long texts: whole; repeated rows: each has its own place in the order
    no rows: no rows
    other columns: not read
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from eventlens.session import cut_lineage
from eventlens.llm.common import table, whole

# Fixed values of the format; other values give other fingerprints.
UNIT = r"[^.!?\n]{1,160}[.!?]*\n?|[.!?]+\n?|\n"
SECTION_ENDS = ("0", "1", "2", "3")
LEAF, SHORT = 32, 8
#: Distinct ids that one window group can hold.
WIDTH = 1024
#: Place of null ids, below those of all long ids.
NULL_BUCKET = -(1 << 54)


def leaves(text: Column) -> Column:
    """Leaf digests in order, each with the mark of what it ends: ``.``, ``,`` or ``;``."""
    def digest(unit):       # keeps the line end, so that each unit is hashed once
        return F.concat(F.left(F.sha2(unit, 256), F.lit(LEAF)), F.when(F.endswith(unit, F.lit("\n")), "\n").otherwise(""))

    def marked(leaf):
        ends = F.left(leaf, F.lit(1)).isin(*SECTION_ENDS)
        return F.concat(F.left(leaf, F.lit(LEAF)),
                        F.when(~F.endswith(leaf, F.lit("\n")), ".").when(ends, ";").otherwise(","))
    return F.transform(F.transform(F.regexp_extract_all(text, F.lit(UNIT), F.lit(0)), digest), marked)


def sections(marked: Column) -> Column:
    """array<struct<digest, leaves>>; ``leaves`` is the section's part of the marked leaves."""
    def node(part):
        paragraphs = F.transform(F.filter(F.split(part, ","), lambda p: p != ""),
                                 lambda p: F.sha2(p, 256))
        return F.struct(F.sha2(F.array_join(paragraphs, ""), 256).alias("digest"), part.alias("leaves"))
    parts = F.filter(F.split(F.array_join(marked, ""), ";"), lambda s: s != "")
    return F.transform(parts, node)


def root(tree: Column) -> Column:
    return F.sha2(F.array_join(F.transform(tree, lambda s: s["digest"]), ""), 256)


def fingerprint(tree: Column) -> Column:
    short = F.transform(tree, lambda s: F.concat(
        F.lit("/"), F.left(s["digest"], F.lit(SHORT)), F.lit("="),
        F.regexp_replace(s["leaves"], f"([0-9a-f]{{{SHORT}}})[0-9a-f]{{{LEAF - SHORT}}}", "$1")))
    return F.concat(root(tree), F.array_join(short, ""))


def short_leaves(print_: Column) -> Column:
    """The distinct leaf digests that a fingerprint holds."""
    tail = F.regexp_replace(F.substring(print_, 65, 1 << 30), "/[0-9a-f]+=", ",")
    return F.array_distinct(F.filter(F.split(tail, "[.,]"), lambda x: x != ""))


def likeness(a: Column, b: Column) -> Column:
    """Of two :func:`short_leaves`."""
    sizes = F.size(a) + F.size(b)
    return F.when(sizes == 0, 1.0).otherwise(2.0 * F.size(F.array_intersect(a, b)) / sizes)


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with the tree's text form in column ``name``."""
    held = f"__tree_{name}"
    return (df.withColumn(held, sections(leaves(whole(text))))
            .withColumn(name, fingerprint(F.col(held))).drop(held))


def parts(print_: Column) -> Column:
    """The sections of a fingerprint, each as digest and leaves."""
    return F.filter(F.split(F.substring(print_, 65, 1 << 30), "/"), lambda s: s != "")


def new_sections(a: Column, b: Column) -> Column:
    """The distinct sections of fingerprint ``b`` that ``a`` doesn't have; none where the roots
    are equal. Sections that both have are not looked into."""
    same = F.left(a, F.lit(64)) == F.left(b, F.lit(64))
    return F.when(same, F.array().cast("array<string>")).otherwise(F.array_except(parts(b), parts(a)))


def locate(df: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """``df`` plus ``name``: array<struct<section, leaves>>, the numbers (0-based) of the sections
    of fingerprint ``b`` that are not in ``a``, and the short leaf digests that are new there."""
    rows = df.withColumns({"__parts": parts(F.col(b)), "__known": short_leaves(F.col(a)),
                           "__new": new_sections(F.col(a), F.col(b))})
    at = lambda s: F.struct(
        (F.array_position(F.col("__parts"), s) - 1).cast("int").alias("section"),
        F.array_except(F.filter(F.split(F.substring_index(s, "=", -1), "[.,]"), lambda x: x != ""),
                       F.col("__known")).alias("leaves"))
    return rows.withColumn(name, F.transform("__new", at)).drop("__parts", "__known", "__new")


def following(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, next_text): each text with the one that follows it in descending id order.

    Ids fall into groups of WIDTH neighbouring values; a group is ordered by itself, and its
    last row takes the first text of the next group. Which group that is, is found on ids
    alone: neighbours inside blocks of WIDTH groups, and one row per block in one task. So
    texts are shuffled once, whole, and the first texts of the groups (one row in up to
    WIDTH) a second time.
    """
    bucket = F.coalesce(F.floor(F.col("doc_id") / WIDTH), F.lit(NULL_BUCKET)).cast("long")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole(text).alias("text")).withColumn(
        "bucket", bucket)
    heads = cut_lineage(rows.groupBy("bucket").agg(F.max("doc_id").alias("head"))
                        .withColumn("block", F.floor(F.col("bucket") / WIDTH)))
    tops = heads.groupBy("block").agg(F.max("bucket").alias("at"))
    below = Window.orderBy(F.desc("block"))
    tops = tops.select(F.col("block").alias("b"), F.lead("at").over(below).alias("b_next"),
                       F.max("at").over(Window.partitionBy()).alias("b_first"))
    inside = Window.partitionBy("block").orderBy(F.desc("bucket"))
    linked = (heads.withColumn("n", F.lead("bucket").over(inside))
              .join(tops, F.col("block") == F.col("b"))
              .select("bucket", F.coalesce("n", "b_next", "b_first").alias("next_bucket")))
    first = heads.select(F.col("bucket").alias("next_bucket"), "head")
    linked = cut_lineage(linked.join(first, "next_bucket").select(
        F.col("bucket").alias("for_bucket"), "next_bucket", "head"))
    # of rows that share the first id of a group, the first text comes first
    texts = rows.join(linked, (F.col("bucket") == F.col("next_bucket"))
                      & F.col("doc_id").eqNullSafe(F.col("head"))).groupBy("for_bucket").agg(
        F.min("text").alias("head_text"))
    order = Window.partitionBy("bucket").orderBy(F.desc_nulls_last("doc_id"), "text")
    return (rows.withColumn("lead", F.lead("text").over(order))
            .join(texts, F.col("bucket") == F.col("for_bucket"))
            .select("doc_id", "text", F.coalesce("lead", "head_text").alias("next_text")))


def edited(docs: DataFrame) -> DataFrame:
    """Adds ``edited_text``: the last third of the text's characters replaced by as many (or
    all) of the following text's first ones."""
    third = F.floor(F.length("text") / 3).cast("int")
    return docs.withColumn("edited_text", F.concat(
        F.left("text", F.length("text") - third), F.left("next_text", third)))


def op6_merkle(spark, sf_dir):
    rows = edited(following(table(spark, sf_dir, "documents", "doc_id", "text")))
    rows = rows.select("doc_id", F.length("text").cast("long").alias("n_chars"),
                       F.sha2("edited_text", 256).alias("edited_sha256"), "text", "edited_text", "next_text")
    rows = with_fingerprint(rows, "text", "fingerprint")
    rows = with_fingerprint(rows, "edited_text", "edited_fingerprint")
    rows = with_fingerprint(rows, "next_text", "next_fingerprint")
    rows = rows.withColumns({n: short_leaves(F.col(p)) for n, p in (
        ("__own", "fingerprint"), ("__edited", "edited_fingerprint"), ("__next", "next_fingerprint"))})
    return rows.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                       F.round(likeness(F.col("__own"), F.col("__edited")), 9).alias("near_edited"),
                       F.round(likeness(F.col("__own"), F.col("__next")), 9).alias("near_next"),
                       F.size(new_sections(F.col("fingerprint"), F.col("edited_fingerprint")))
                       .alias("n_new_sections"))


_ENDS = ", ".join(f"'{c}'" for c in SECTION_ENDS)
_MARKED = (f"array_to_string(list_transform(regexp_extract_all(@, '{UNIT}'), lambda u: left(sha256(u), {LEAF}) || "
           f"CASE WHEN right(u, 1) <> chr(10) THEN '.' WHEN left(sha256(u), 1) IN ({_ENDS}) THEN ';' ELSE ',' END), '')")
_TREE = ("list_transform(list_filter(string_split(@, ';'), lambda s: s <> ''), lambda s: {'digest': "
         "sha256(array_to_string(list_transform(list_filter(string_split(s, ','), lambda p: p <> ''), lambda p: sha256(p)), '')),"
         " 'leaves': s})")
_PRINT = ("sha256(array_to_string(list_transform(@, lambda s: s.digest), '')) || array_to_string(list_transform(@, lambda s: "
          f"'/' || left(s.digest, {SHORT}) || '=' || regexp_replace(s.leaves, '([0-9a-f]{{{SHORT}}})[0-9a-f]{{{LEAF - SHORT}}}', "
          "'\\1', 'g')), '')")
_LEAVES = ("list_distinct(list_filter(regexp_split_to_array(regexp_replace(@[65:], '/[0-9a-f]+=', ',', 'g'), '[.,]'), "
           "lambda x: x <> ''))")
_LIKE = ("CASE WHEN len(own) + len(@) = 0 THEN 1.0::DOUBLE ELSE round(2.0::DOUBLE * len(list_intersect(own, @)) "
         "/ (len(own) + len(@)), 9) END")
_PARTS = "list_filter(string_split(@[65:], '/'), lambda s: s <> '')"


def _of(expression: str, *columns: str) -> str:
    return ", ".join(f"{expression.replace('@', c.split()[0])} AS {c.split()[1]}" for c in columns)


ORACLE = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
followed AS (
  SELECT doc_id, text, coalesce(lead(text) OVER w, first_value(text) OVER w) AS next_text
  FROM texts WINDOW w AS (ORDER BY doc_id DESC NULLS LAST, text)),
edits AS (
  SELECT *, left(text, length(text) - length(text) // 3) || left(next_text, length(text) // 3) AS edited_text
  FROM followed),
marks AS (SELECT *, {_of(_MARKED, 'text m', 'edited_text e', 'next_text n')} FROM edits),
trees AS (SELECT *, {_of(_TREE, 'm mt', 'e et', 'n nt')} FROM marks),
prints AS (SELECT *, {_of(_PRINT, 'mt fingerprint', 'et edited_fingerprint', 'nt next_fingerprint')} FROM trees),
sets AS (
  SELECT *, {_of(_LEAVES, 'fingerprint own', 'edited_fingerprint other', 'next_fingerprint nxt')},
         {_of(_PARTS, 'fingerprint has', 'edited_fingerprint got')} FROM prints)
SELECT doc_id, length(text)::BIGINT AS n_chars, sha256(edited_text) AS edited_sha256, fingerprint, edited_fingerprint,
       {_of(_LIKE, 'other near_edited', 'nxt near_next')},
       CASE WHEN left(fingerprint, 64) = left(edited_fingerprint, 64) THEN 0
            ELSE len(list_distinct(list_filter(got, lambda s: NOT list_contains(has, s)))) END::INTEGER AS n_new_sections
FROM sets
"""
