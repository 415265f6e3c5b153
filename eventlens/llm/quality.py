"""Quality rules by weak supervision.

Each rule votes good or bad on a text, or abstains. Expectation-maximisation over the vote
patterns estimates how often each rule calls good and bad texts bad, and how many texts are
good; a text's quality is the posterior probability of being good given its votes. An
abstention says nothing. There are at most 3 ** rules patterns, so they are counted by a
hash aggregate and fitted in one row, whatever the number of texts.

Defined results
    null, empty or wordless text: no words, every rule abstains; the base test fails it
    very long texts: whole
    repeated rows: each row has its own result, and each counts in the estimates
    ties: a quality of exactly a half is kept
    no rows: no rows
    other columns: not read
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from eventlens.session import cut_lineage
from eventlens.llm.common import table, whole, words

ITERATIONS = 30


@dataclass(frozen=True)
class Rule:
    """Conditions, in SQL over :func:`measures`, for a bad and for a good vote."""
    name: str
    bad: str
    good: str


RULES = (
    Rule("symbols", "100 * n_symbols > 20 * n_words", "100 * n_symbols < 5 * n_words"),
    Rule("other_characters", "100 * n_others > 30 * word_chars", "100 * n_others < 15 * word_chars"),
    Rule("bare_words", "100 * n_bare > 30 * n_words", "100 * n_bare < 10 * n_words"),
    Rule("capitals", "100 * n_capitals > 50 * (word_chars - n_others)",
         "100 * n_capitals < 20 * (word_chars - n_others)"),
    Rule("exclamations", "100 * n_exclamations > 50 * n_words", "100 * n_exclamations < 10 * n_words"),
    Rule("repeated_lines", "100 * n_dup_lines > 50 * n_lines", "100 * n_dup_lines < 20 * n_lines"),
    Rule("repeated_words", "100 * n_repeat_words > 30 * n_words", "100 * n_repeat_words < 10 * n_words"),
    Rule("distinct_words", "100 * n_distinct < 15 * n_words", "100 * n_distinct > 30 * n_words"),
    Rule("sentences", "100 * n_ends > 60 * n_words",
         "100 * n_ends >= 1 * n_words AND 100 * n_ends < 30 * n_words"),
)
# Starting points, and the weight in texts that they keep: how often a rule calls good and
# bad texts bad, and the share of good texts.
FALSE_ALARM, DETECTION, GOOD_SHARE, WEIGHT = 0.01, 0.4, 0.8, 2.0
BASE_FAILS = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(w: str) -> Column:
    """Words of array column ``w`` that lie in three-word windows found at least twice.

    Windows are compared by 64-bit hashes. Where all differ, which costs one pass, there are
    none; else sorting brings equal ones together.
    """
    n = F.size(w)
    second, third = F.slice(w, F.lit(2), F.greatest(n - 2, F.lit(0))), F.slice(w, F.lit(3), F.greatest(n - 2, F.lit(0)))
    first = F.slice(w, F.lit(1), F.greatest(n - 2, F.lit(0)))
    windows = F.zip_with(F.zip_with(first, second, lambda a, b: F.struct(a.alias("a"), b.alias("b"))), third,
                         lambda p, c: F.xxhash64(p["a"], p["b"], c))
    pairs = lambda s: F.zip_with(
        F.slice(s, F.lit(1), F.size(s) - 1), F.slice(s, F.lit(2), F.size(s) - 1),
        lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>")))
    gaps = lambda p: F.aggregate(
        F.zip_with(F.slice(p, F.lit(1), F.size(p) - 1), F.slice(p, F.lit(2), F.size(p) - 1),
                   lambda a, b: F.least(F.lit(3), b - a)), F.lit(3), lambda s, x: s + x)
    covered = lambda h: let(F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))),
                            lambda s: let(F.array_sort(F.array_distinct(F.flatten(pairs(s)))), gaps))
    return F.when(n < 4, 0).otherwise(let(windows, lambda h: F.when(
        F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(covered(h)))).cast("long")


def measures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts of each row's whole text that the rules look at; no shuffle."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole(text).alias("t"))
    rows = rows.withColumn("w", words("t"))
    rows = rows.withColumn("lines", F.filter(F.split("t", "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]"))))
    count = lambda pattern: F.regexp_count("t", F.lit(pattern)).cast("long")
    return rows.select(
        "doc_id", F.size("w").cast("long").alias("n_words"),
        F.aggregate("w", F.lit(0).cast("long"), lambda s, x: s + F.length(x)).alias("word_chars"),
        count(r"[#*$%&|<>]").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words("w").alias("n_repeat_words"),
        F.size(F.array_distinct("w")).cast("long").alias("n_distinct"),
        F.size(F.filter("w", lambda x: ~F.rlike(x, F.lit(r"\p{L}")))).cast("long").alias("n_bare"),
        count(r"[^\p{L}\x20\x09-\x0D]").alias("n_others"), count(r"\p{Lu}").alias("n_capitals"),
        count("!").alias("n_exclamations"), count("[.!?]").alias("n_ends"))


def votes(rules=RULES) -> Column:
    """A digit for each rule: 0 bad, 1 good, 2 abstains."""
    return F.concat(*[F.when(F.col("n_words") == 0, "2").when(F.expr(r.bad), "0").when(F.expr(r.good), "1").otherwise("2")
                      for r in rules])


def posteriors(patterns: DataFrame, rules: int, iterations: int = ITERATIONS) -> DataFrame:
    """(pattern, quality) from (pattern, n): the whole fit is one expression over one row.

    The state holds the share of good texts, and for each rule how often it says bad of good
    and of bad texts. Starting points keep a small weight, so a rule that never speaks stays
    where it was and no probability becomes 0.
    """
    digit = lambda p, j: F.substring(p, j + 1, 1)
    one = patterns.agg(F.array_sort(F.collect_list(F.struct("pattern", F.col("n").cast("double").alias("n")))).alias("all"))

    def odds(p, s):
        """log P(votes, bad) - log P(votes, good)"""
        terms = F.ln(1 - s["good"]) - F.ln(s["good"])
        for j in range(rules):
            e, d = s["alarm"][j], s["hit"][j]
            terms = terms + F.when(digit(p, j) == "0", F.ln(d) - F.ln(e)).when(
                digit(p, j) == "1", F.ln(1 - d) - F.ln(1 - e)).otherwise(0.0)
        return terms

    def rated(s):
        return F.transform("all", lambda x: F.struct(
            x["pattern"].alias("p"), x["n"].alias("n"), (x["n"] / (1 + F.exp(odds(x["pattern"], s)))).alias("g")))

    total = lambda xs, f: F.aggregate(xs, F.lit(0.0), lambda a, x: a + f(x))

    def step(xs):
        def rate(j, start, of):
            said = lambda v: total(xs, lambda x: F.when(digit(x["p"], j) == v, of(x)).otherwise(0.0))
            bad = said("0") + WEIGHT * start
            return bad / (bad + said("1") + WEIGHT * (1 - start))
        good, everything = total(xs, lambda x: x["g"]), total(xs, lambda x: x["n"])
        return F.struct(
            ((good + WEIGHT * GOOD_SHARE) / (everything + WEIGHT)).alias("good"),
            F.array(*[rate(j, FALSE_ALARM, lambda x: x["g"]) for j in range(rules)]).alias("alarm"),
            F.array(*[rate(j, DETECTION, lambda x: x["n"] - x["g"]) for j in range(rules)]).alias("hit"))

    start = F.struct(F.lit(GOOD_SHARE).alias("good"), F.array_repeat(F.lit(FALSE_ALARM), rules).alias("alarm"),
                     F.array_repeat(F.lit(DETECTION), rules).alias("hit"))
    fitted = one.withColumn("state", F.aggregate(
        F.sequence(F.lit(1), F.lit(iterations)), start, lambda s, _: let(rated(s), step)))
    rows = fitted.select(F.explode(rated(F.col("state"))).alias("x"))
    return rows.select(F.col("x.p").alias("pattern"), F.round(F.col("x.g") / F.col("x.n"), 6).alias("quality"))


def rate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rules=RULES,
         iterations: int = ITERATIONS) -> DataFrame:
    """:func:`measures` plus base_failed, quality and kept, one row per row of ``docs``."""
    rows = cut_lineage(measures(docs, doc_id, text).withColumn("pattern", votes(rules)))
    patterns = rows.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
    # at most 3 ** rules rows
    fitted = F.broadcast(posteriors(patterns, len(rules), iterations))
    return (rows.withColumn("base_failed", F.expr(BASE_FAILS)).join(fitted, "pattern")
            .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= 0.5)))


def keep_good(docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """The rows of ``docs`` that are kept, as they are; no join by id, so ids may repeat."""
    whole_rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(text).alias("text"))
    return rate(whole_rows, "row", "text", rules).where("kept").select("doc_id.*")


def op2_quality(spark, sf_dir):
    return rate(table(spark, sf_dir, "documents", "doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


_RATES = []
for _i in range(ITERATIONS + 1):
    if not _i:
        _RATES.append(f"m0 AS MATERIALIZED (SELECT j, {FALSE_ALARM}::DOUBLE AS e, {DETECTION}::DOUBLE AS d, "
                      f"{GOOD_SHARE}::DOUBLE AS good FROM (SELECT unnest(range(1, {len(RULES) + 1})) AS j))")
    else:
        _w, _e, _d = WEIGHT, WEIGHT * FALSE_ALARM, WEIGHT * DETECTION
        _RATES.append(f"""m{_i} AS MATERIALIZED (
  SELECT j, (coalesce(sum(g) FILTER (v = '0'), 0) + {_e}) / (coalesce(sum(g) FILTER (v < '2'), 0) + {_w}) AS e,
         (coalesce(sum(n - g) FILTER (v = '0'), 0) + {_d}) / (coalesce(sum(n - g) FILTER (v < '2'), 0) + {_w}) AS d,
         (sum(g) + {_w * GOOD_SHARE}) / (sum(n) + {_w}) AS good
  FROM p{_i - 1} JOIN cast_votes USING (pattern) GROUP BY j)""")
    _RATES.append(f"""p{_i} AS MATERIALIZED (
  SELECT pattern, any_value(n) AS n, any_value(n) / (1 + exp(ln(1 - any_value(good)) - ln(any_value(good)) + sum(
    CASE v WHEN '0' THEN ln(d) - ln(e) WHEN '1' THEN ln(1 - d) - ln(1 - e) ELSE 0 END))) AS g
  FROM cast_votes JOIN m{_i} USING (j) GROUP BY pattern)""")
_VOTES = " || ".join(f"CASE WHEN n_words = 0 THEN '2' WHEN {r.bad} THEN '0' WHEN {r.good} THEN '1' ELSE '2' END" for r in RULES)
ORACLE = f"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS win FROM texts, LATERAL (SELECT unnest(range(1, len(w) - 1)) AS i)),
again AS (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS n FROM windows),
covered AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM again WHERE n > 1) GROUP BY r),
measures AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(lines) AS n_lines,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
         len(list_distinct(w)) AS n_distinct, len(list_filter(w, lambda x: NOT regexp_matches(x, '\\pL'))) AS n_bare, len(regexp_extract_all(t, '[^\\pL\\x20\\x09-\\x0D]')) AS n_others,
         len(regexp_extract_all(t, '\\p{{Lu}}')) AS n_capitals, len(regexp_extract_all(t, '!')) AS n_exclamations,
         len(regexp_extract_all(t, '[.!?]')) AS n_ends
  FROM texts LEFT JOIN covered c USING (r)),
rows AS (SELECT *, {_VOTES} AS pattern FROM measures),
patterns AS (SELECT pattern, count(*)::DOUBLE AS n FROM rows GROUP BY pattern),
cast_votes AS MATERIALIZED (
  SELECT pattern, n, j, pattern[j] AS v FROM (SELECT *, unnest(range(1, {len(RULES) + 1})) AS j FROM patterns)),
{", ".join(_RATES).replace("JOIN cast_votes USING (pattern)", "JOIN (SELECT pattern, j, v FROM cast_votes) USING (pattern)")}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, ({BASE_FAILS}) AS base_failed,
       NOT ({BASE_FAILS}) AND round(g / n, 6) >= 0.5 AS kept, round(g / n, 6) AS quality
FROM rows JOIN p{ITERATIONS} USING (pattern)
"""
