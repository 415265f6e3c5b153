"""Secret scans over an incremental ledger of blobs.

Every version of a text is addressed by its content (SHA-256). The ledger, a Parquet table
in a folder the caller names, holds one row per (blob, rule version) that was ever scanned,
with the spans found. A scan takes only blobs that the ledger does not have for the present
rule version, appends their findings, and findings are joined back to every path that holds
the blob. A new rule version scans everything again; a text that comes back is not scanned.

Defined results
    null text: the blob of the empty text, without spans
    repeated rows, equal ids: every row is a path and gets its blob's findings
    very long texts: scanned whole; positions are exact
    no rows: no rows
    other columns: not read by :func:`scan`; :func:`redact` keeps them as they are
A run that is broken off leaves either all or none of its ledger rows (Parquet commit), and
running it again adds what is missing. Two scans into one ledger at the same time may both
scan a blob; readers take each blob once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.errors import AnalysisException

from eventlens.session import cut_lineage, scratch_path
from eventlens.llm.common import table, whole


@dataclass(frozen=True)
class Rule:
    """A kind of secret: what matches, and which matches count.

    ``shortest`` is the least length of ``group`` (0: the whole match); shorter matches are
    consumed and dropped. ``hint``: a text that every match holds, looked for first. ``rest``:
    what the span takes in after the match; the SQL leaves it out.
    """
    kind: str
    pattern: str
    shortest: int = 0
    group: int = 0
    hint: str | None = None
    rest: str = ""


# The three base kinds, in their order.
BASE = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    # runs of these characters are whole matches, so the least length can stand in the pattern
    Rule("access", r"AKIA[A-Z0-9]{16,}", hint="AKIA"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
# After a key's first line: all up to its END line if no other BEGIN or END comes before, or
# else the header fields and base-64 lines; line ends may be written as \\n. All loops are
# possessive and without a bound: the matcher then goes round, not deeper, and a key of any
# number of lines, hyphens, fields or blanks goes whole.
_GAP = r"(?:[\x20\x09-\x0D]|\\[rn])*+"
_KEY = (r"(?:[^-]*+(?:-(?!----(?:BEGIN|END) )[^-]*+)*+-----END [A-Z ]{0,40}PRIVATE KEY-----|"
        rf"(?:{_GAP}(?:Proc-Type|DEK-Info):[^\r\n\\]*+)*+"
        rf"(?:(?:{_GAP}[A-Za-z0-9+/=]{{16,}}+)++"
        r"(?:(?:\r?\n|\\n)[\x20\x09]*+[A-Za-z0-9+/]{1,15}={0,2}(?=[\x20\x09]*+(?:[\r\n\\\"']|$)))?)?)")
ADDED = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", hint="PRIVATE KEY-----", rest=_KEY),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", hint="eyJ"),
    Rule("host_token", r"gh[oprsu]_[A-Za-z0-9]{36,}", hint="gh"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}", hint="xox"),
)
RULES = BASE + ADDED
VERSION = "4"
#: Largest table of spans that is broadcast, and what a blob and a span take in it.
BROADCAST_BYTES, BLOB_BYTES, SPAN_BYTES = 32 << 20, 160, 64


def spans(text: Column, rule: Rule, order: int) -> Column:
    """array<struct<start, kind_order, end, kind>>, leftmost and non-overlapping, in code points.

    The texts between matches and the matches themselves alternate, so their lengths give
    the positions.
    """
    pattern = rule.pattern + rule.rest
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    if rule.hint:
        found = F.when(F.contains(text, F.lit(rule.hint)), found).otherwise(F.array().cast("array<string>"))
    gaps = F.split(text, pattern, -1)
    counted = (F.regexp_extract_all(text, F.lit(pattern), F.lit(rule.group))
               if rule.group else found)
    steps = F.zip_with(F.zip_with(gaps, found, lambda g, m: F.struct(
        F.length(g).alias("gap"), F.length(m).alias("match"))),
        counted, lambda s, c: F.struct(s["gap"].alias("gap"), s["match"].alias("match"),
                                       (F.length(c) >= rule.shortest).alias("counts")))
    start = F.struct(F.lit(0).alias("at"), empty_spans().alias("out"))

    def step(state, s):
        begin, end = state["at"] + s["gap"], state["at"] + s["gap"] + s["match"]
        one = F.struct(begin.alias("start"), F.lit(order).alias("kind_order"), end.alias("end"),
                       F.lit(rule.kind).alias("kind"))
        return F.struct(F.coalesce(end, state["at"]).alias("at"),
                        F.when(s["counts"], F.concat(state["out"], F.array(one)))
                         .otherwise(state["out"]).alias("out"))
    return F.when(F.size(found) == 0, empty_spans()).otherwise(
        F.aggregate(steps, start, step, lambda s: s["out"]))


def empty_spans() -> Column:
    return F.array().cast("array<struct<start:int,kind_order:int,end:int,kind:string>>")


def blob(text: str) -> Column:
    return F.sha2(F.encode(whole(text), "utf-8"), 256)


def read_ledger(spark: SparkSession, ledger: str, version: str = VERSION) -> DataFrame | None:
    """(blob, spans) of one rule version, each blob once; None before the first scan."""
    try:
        rows = spark.read.parquet(ledger)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    return rows.where(F.col("rule_version") == version).select("blob", "spans").dropDuplicates(["blob"])


def scan(docs: DataFrame, ledger: str, text: str = "text", rules=RULES, version: str = VERSION) -> DataFrame:
    """Bring the ledger up to date with ``docs`` and return its (blob, spans) rows.

    Spans are found in the text's own row; what is shuffled is one blob with its spans per
    distinct unseen text and task, so no text moves, and one that a third of all rows hold
    costs one row per task.
    """
    spark = docs.sparkSession
    fresh = docs.select(blob(text).alias("blob"), whole(text).alias("text"))
    known = read_ledger(spark, ledger, version)
    if known is not None:
        fresh = fresh.join(known.select("blob"), "blob", "left_anti")
    found = F.array_sort(F.concat(*[spans(F.col("text"), r, i) for i, r in enumerate(rules)]))
    (fresh.select(F.lit(version).alias("rule_version"), "blob", found.alias("spans")).dropDuplicates(["blob"])
     .write.mode("append").parquet(ledger))
    return read_ledger(spark, ledger, version)


def findings(docs: DataFrame, ledger: str, doc_id: str = "doc_id", text: str = "text",
             rules=RULES, version: str = VERSION) -> DataFrame:
    """(doc_id, blob, spans) for every row of ``docs``; ``spans`` is empty where nothing was found.

    Only blobs with spans take part in the join, whose large side, the paths, can be split
    where one blob has very many.
    """
    paths = docs.select(F.col(doc_id).alias("doc_id"), blob(text).alias("blob"))
    # written first: a join straight on the deduplicated ledger could not be split
    hits = cut_lineage(scan(docs, ledger, text, rules, version).where(F.size("spans") > 0))
    return paths.join(hits, "blob", "left").select(
        "doc_id", "blob", F.coalesce("spans", empty_spans()).alias("spans"))


def redact(docs: DataFrame, ledger: str, text: str = "text", rules=RULES,
           version: str = VERSION, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every span replaced by ``mark``; overlapping spans are replaced together.

    Blobs with spans are few as a rule: up to BROADCAST_BYTES of them, counted first, are
    broadcast and the texts stay where they are. More are joined by shuffle.
    """
    hits = cut_lineage(scan(docs, ledger, text, rules, version).where(F.size("spans") > 0).select(
        F.col("blob").alias("__blob"), F.col("spans").alias("__spans")))
    size = hits.agg(F.coalesce(F.sum(F.size("__spans") * SPAN_BYTES + BLOB_BYTES), F.lit(0))).first()[0]
    hits = F.broadcast(hits) if size <= BROADCAST_BYTES else hits
    joined = docs.select(*docs.columns, blob(text).alias("__own")).join(
        hits, F.col("__own") == F.col("__blob"), "left")
    raw = F.col(text)
    done = F.aggregate(
        "__spans", F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")),
        lambda s, x: F.when(x["end"] <= s["at"], s).otherwise(F.struct(
            x["end"].alias("at"),
            F.concat(s["out"], F.when(
                x["start"] < s["at"], F.array().cast("array<string>")).otherwise(F.array(
                    raw.substr(s["at"] + 1, x["start"] - s["at"]), F.lit(mark)))).alias("out"))),
        lambda s: F.concat(F.array_join(s["out"], ""), raw.substr(s["at"] + 1, F.length(raw))))
    cleaned = F.when(F.col("__spans").isNotNull(), done).otherwise(raw)
    return joined.select(*[cleaned.alias(c) if c == text else F.col(c) for c in docs.columns])


def written(found: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op9_secrets(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = findings(docs, scratch_path(spark, "secret-ledger"))
    def of_kind(i):
        return F.size(F.filter("spans", lambda s: s["kind_order"] == i)).cast("long")
    count = {r.kind: of_kind(i) for i, r in enumerate(BASE)}
    base = F.filter("spans", lambda s: s["kind_order"] < len(BASE))
    return found.select("doc_id", *[n.alias(f"n_{kind}") for kind, n in count.items()],
                        F.sha2(written(base), 256).alias("base_sha256"),
                        written(F.col("spans")).alias("spans"))


def _sql_spans(rule: Rule, order: int) -> str:
    pattern = rule.pattern.replace("'", "''")
    if pattern.startswith("(?i)"):      # only ASCII letters in either case
        names = "password|passwd|secret|token|api_?key"
        either = "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in names)
        pattern = pattern.removeprefix("(?i)").replace(names, either)
    return f"""
      (SELECT list({{'start': b, 'kind_order': {order}, 'stop': b + n, 'kind': '{rule.kind}'}}) FROM (
         SELECT list_sum(gap[:i]) + coalesce(list_sum(hit[:i - 1]), 0) AS b, hit[i] AS n, own[i] AS o FROM (
           SELECT list_transform(regexp_split_to_array(text, '{pattern}'), lambda x: length(x)) AS gap,
                  list_transform(regexp_extract_all(text, '{pattern}'), lambda x: length(x)) AS hit,
                  list_transform(regexp_extract_all(text, '{pattern}', {rule.group}), lambda x: length(x)) AS own),
         LATERAL (SELECT unnest(range(1, len(hit) + 1)) AS i)) WHERE o >= {rule.shortest})"""


_ALL = ",\n".join(_sql_spans(r, i) for i, r in enumerate(RULES))
_TEXT = ("array_to_string(list_transform({0}, lambda s: s.kind || ':' || s.start || ':' || s.stop), ',')")
ORACLE = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
found AS (
  SELECT doc_id, list_sort(flatten(list_filter([{_ALL}], lambda x: x IS NOT NULL))) AS spans FROM texts)
SELECT doc_id, {', '.join(f"len(list_filter(spans, lambda s: s.kind_order = {i}))::BIGINT AS n_{r.kind}" for i, r in enumerate(BASE))},
       sha256({_TEXT.format(f"list_filter(spans, lambda s: s.kind_order < {len(BASE)})")}) AS base_sha256,
       {_TEXT.format("spans")} AS spans
FROM found
"""
