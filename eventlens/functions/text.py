"""Tokens, stopwords and weighted-word text."""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

from pyspark.sql import Column, functions as F

# What counts as a token.
TOKEN_PATTERN = r"[\p{L}\p{Nl}\p{No}_]+"
MIN_LENGTH = 2
MAX_LENGTH = 15

# The English stopwords of Spark's StopWordsRemover.
ENGLISH_STOPWORDS = tuple("""
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself
she her hers herself it its itself they them their theirs themselves what which who whom
this that these those am is are was were be been being have has had having do does did
doing a an the and but if or because as until while of at by for with about against
between into through during before after above below to from up down in out on off over
under again further then once here there when where why how all any both each few more
most other some such no nor not only own same so than too very s t can will just don
should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm
you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't weren't
haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't
couldn't cannot could here's how's let's ought that's there's what's when's where's who's
why's would
""".split())

WEIGHTED_WORD = r'([0-9.]+)\*"([^"]*)"'


@cache
def accent_table() -> tuple[str, str]:
    """(characters, replacements) for ``translate``, derived from Unicode itself.

    A character maps to its canonical decomposition without the non-spacing
    marks; the marks, put last, have no counterpart and so are deleted.
    """
    plain, marks = [], []
    for code in range(0x80, sys.maxunicode + 1):
        ch = chr(code)
        if unicodedata.category(ch) == "Mn":
            marks.append(ch)
            continue
        parts = unicodedata.normalize("NFD", ch)
        if parts == ch:
            continue
        kept = "".join(c for c in parts if unicodedata.category(c) != "Mn")
        bare = unicodedata.normalize("NFC", kept)
        if len(bare) == 1 and bare != ch:
            plain.append((ch, bare))
    return "".join(c for c, _ in plain) + "".join(marks), "".join(b for _, b in plain)


def strip_accents(text: Column) -> Column:
    """Remove accents; plain ASCII (as many bytes as characters) is passed through."""
    chars, bare = accent_table()
    return (F.when(F.octet_length(text) == F.length(text), text)
             .otherwise(F.translate(text, chars, bare)))


def tokens(text: Column, deaccent: bool = True) -> Column:
    """Lower-case alphabetic runs of 2 to 15 characters that do not start with ``_``."""
    lowered = F.lower(text)
    if deaccent:    # what is ASCII before is so after; asked of the text itself, it is lowered once
        lowered = F.when(F.octet_length(text) == F.length(text), lowered).otherwise(F.translate(lowered, *accent_table()))
    runs = F.regexp_extract_all(lowered, F.lit(TOKEN_PATTERN), F.lit(0))
    return F.filter(runs, lambda t: F.length(t).between(MIN_LENGTH, MAX_LENGTH)
                    & ~t.startswith("_"))


def without_stopwords(token_list: Column) -> Column:
    """Drop stopwords; the list is a constant set, so each test is one hash probe."""
    return F.filter(token_list, lambda t: ~t.isin(*ENGLISH_STOPWORDS))


def weighted_words_text(words: Column) -> Column:
    """``0.144*"word" + 0.086*"word"`` from an array of (thousandths, word)."""
    return F.array_join(
        F.transform(words, lambda w: F.format_string('%.3f*"%s"', w["thousandths"] / 1000,
                                                     w["word"])),
        " + ")


def weighted_words(text: Column) -> Column:
    """The inverse: an array of (thousandths, word) structs."""
    pattern = F.lit(WEIGHTED_WORD)
    pairs = F.arrays_zip(F.regexp_extract_all(text, pattern, F.lit(1)).alias("weight"),
                         F.regexp_extract_all(text, pattern, F.lit(2)).alias("word"))
    return F.transform(pairs, lambda p: F.struct(
        F.round(p["weight"].cast("double") * 1000).cast("long").alias("thousandths"),
        p["word"].alias("word")))


def tokens_sql(subject: str, stop: bool = True) -> str:
    """The same tokens as SQL text over an expression, without stopwords if ``stop``."""
    def quoted(s: str) -> str:
        return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"
    chars, bare = accent_table()
    lowered = f"lower({subject})"
    plain = (f"if(octet_length({subject}) = length({subject}), {lowered}, "
             f"translate({lowered}, {quoted(chars)}, {quoted(bare)}))")
    listed = ", ".join(quoted(w) for w in ENGLISH_STOPWORDS)
    return (f"filter(regexp_extract_all({plain}, {quoted(TOKEN_PATTERN)}, 0), "
            f"t -> length(t) between {MIN_LENGTH} and {MAX_LENGTH} "
            f"and not startswith(t, '_')" + (f" and t not in ({listed}))" if stop else ")"))
