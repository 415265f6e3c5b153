"""Tokens, bags of words, vocabulary, collocations, lemmas."""

from pyspark.sql import functions as F

from checks.messages import MESSAGES
from checks.registry import query
from eventlens.functions import text
from eventlens.operators import corpus
from eventlens.plans.classify import serving_tokens, with_tokens
from eventlens.session import cut_lineage, passing_tables
from eventlens.sources import standin

STOP = ", ".join("'" + w.replace("'", "''") + "'" for w in text.ENGLISH_STOPWORDS)


def runs(source):
    return (f"list_filter(regexp_extract_all({source}, '[\\p{{L}}\\p{{Nl}}\\p{{No}}_]+'), "
            "lambda t: length(t) between 2 and 15 and not starts_with(t, '_'))")


TOKENS = f"""
msg as materialized (
  select *, {runs('strip_accents(lower(message_subject))')} as spelled from ({MESSAGES})
  where message_subject is not null),
tok as materialized (
  select message_id, author_group,
         list_filter(spelled, lambda t: not list_contains([{STOP}], t)) as tokens
  from msg)"""
# one row per token; pos from 1
ROWS = TOKENS + """,
rows_ as materialized (
  select message_id, author_group, unnest(tokens) as token,
         generate_subscripts(tokens, 1) as pos
  from tok)"""


def _text(df, column="tokens"):
    return df.select("message_id", F.array_join(column, " ").alias("tokens"))


def tokens(spark, sf):
    return with_tokens(standin.spread_messages(spark, sf)).select(
        "message_id", "author_group", "tokens")


@query(f"with {TOKENS} select message_id, array_to_string(spelled, ' ') as tokens from msg")
def tokenize(spark, sf):
    """Lower case, accents stripped, alphabetic runs of 2 to 15 characters."""
    return _text(with_tokens(standin.spread_messages(spark, sf), stop=False))


@query(f"""select message_id, array_to_string({runs('lower(message_subject)')}, ' ') as tokens
           from ({MESSAGES}) where message_subject is not null""")
def tokenize_raw(spark, sf):
    """The same without accent stripping."""
    return _text(with_tokens(standin.spread_messages(spark, sf), deaccent=False, stop=False))


@query(f"with {TOKENS} select message_id, array_to_string(tokens, ' ') as tokens from tok")
def tokens_no_stopwords(spark, sf):
    return _text(tokens(spark, sf))


VOCAB = ROWS + """,
vocab as materialized (
  select token, count(distinct message_id) as doc_freq, count(*) as term_freq,
         row_number() over (order by token) - 1 as token_id
  from rows_ group by token)"""


@query(f"with {VOCAB} select token, doc_freq, term_freq, token_id from vocab")
def vocabulary(spark, sf):
    """Distinct tokens with ids, document and term frequency."""
    return corpus.number_vocabulary(corpus.vocabulary(tokens(spark, sf)))


@query(f"""with {VOCAB} select message_id, token_id, count(*) as n
           from rows_ join vocab using (token) group by 1, 2""")
def bow(spark, sf):
    """Bag of words by token id."""
    docs = tokens(spark, sf)
    numbered = cut_lineage(corpus.number_vocabulary(corpus.vocabulary(docs)))
    return corpus.encode_bag(corpus.bag_of_words(docs, "message_id"), "message_id", numbered)


@query(f"""with {ROWS} select (select count(*) from tok) as documents, count(*) as tokens,
                  count(distinct token) as distinct_tokens from rows_""")
def corpus_stats(spark, sf):
    return corpus.corpus_stats(tokens(spark, sf))


PAIRS = ROWS + """,
pairs as materialized (
  select x.message_id, x.pos, x.token as a, y.token as b
  from rows_ x join rows_ y on x.message_id = y.message_id and y.pos = x.pos + 1),
pair_n as materialized (select a, b, count(*) as n_ab from pairs group by 1, 2),
word_n as materialized (select token, count(*) as n from rows_ group by 1)"""


@query(f"with {PAIRS} select a, b, n_ab from pair_n")
def bigram_counts(spark, sf):
    """How often each pair of neighbours occurs."""
    return corpus.bigram_counts(tokens(spark, sf))


SCORES = PAIRS + """,
scored as materialized (
  select a, b, wa.n as n_a, wb.n as n_b, n_ab,
         cast((n_ab - 5) * ((select count(*) from word_n) + (select count(*) from pair_n))
              as double) / (wa.n * wb.n) as score
  from pair_n join word_n wa on wa.token = a join word_n wb on wb.token = b
  where n_ab > 5),
phrases as materialized (select * from scored where score > 100)"""


@query(f"with {SCORES} select a, b, n_a, n_b, n_ab, round(score, 4) as score from phrases")
def bigram_scores(spark, sf):
    """Collocation score above the threshold."""
    return corpus.bigram_scores(tokens(spark, sf)).withColumn("score", F.round("score", 4))


def phrases(docs):
    with passing_tables() as keep:
        return keep(cut_lineage(corpus.bigram_scores(docs).select("a", "b")))


MERGED = SCORES + """,
hits as (select message_id, pos, pos - row_number() over (partition by message_id order by pos) as run
         from pairs join phrases using (a, b)),
taken as (select message_id, pos from (
            select *, min(pos) over (partition by message_id, run) as first_pos from hits)
          where (pos - first_pos) % 2 = 0),
merged as materialized (
  select r.message_id, r.author_group, r.pos,
         case when t.pos is not null then r.token || '_' || nxt.token else r.token end as token
  from rows_ r
  left join taken t on t.message_id = r.message_id and t.pos = r.pos
  left join rows_ nxt on nxt.message_id = r.message_id and nxt.pos = r.pos + 1
  left join taken prev on prev.message_id = r.message_id and prev.pos = r.pos - 1
  where prev.pos is null)"""


@query(f"""with {MERGED}
select message_id, coalesce(string_agg(token, ' ' order by pos), '') as tokens
from merged group by 1
union all
select message_id, '' from tok where len(tokens) = 0""")
def bigram_apply(spark, sf):
    """Neighbours that form a phrase become one token, left to right, without overlap."""
    docs = cut_lineage(tokens(spark, sf))       # read three times
    return _text(corpus.apply_bigrams(docs, phrases(docs), "message_id"))


# The stand-in lexicon's parts of speech, by length of the token modulo 6.
POS = ("NOUN", "VERB", "ADJ", "ADV", "DET", "PRON")
LEMMA_SQL = "regexp_replace({0}, '(ing|ed|s)$', '')"
POS_SQL = f"[{', '.join(repr(p) for p in POS)}][length({{0}}) % 6 + 1]"


def lexicon(docs):
    """Stand-in lexicon of the corpus: it exercises the join and is no linguistics."""
    surface = F.col("surface")
    return (corpus.vocabulary(docs).select(F.col("token").alias("surface"))
            .withColumn("lemma", F.regexp_replace(surface, "(ing|ed|s)$", ""))
            .withColumn("pos", F.get(F.array(*[F.lit(p) for p in POS]), F.length(surface) % 6)))


@query(f"""with {MERGED},
kept as (select message_id, pos, {LEMMA_SQL.format('token')} as lemma from merged
         where {POS_SQL.format('token')} in ('NOUN', 'VERB', 'ADJ', 'ADV'))
select m.message_id, coalesce(string_agg(lemma, ' ' order by pos), '') as tokens
from tok m left join kept using (message_id) group by 1""")
def lemma_pos_filter(spark, sf):
    """Training order: stopwords, collocations, then lemmas of content words."""
    return _text(training_tokens(spark, sf))


def training_tokens(spark, sf):
    with passing_tables() as keep:
        docs = cut_lineage(tokens(spark, sf))
        merged = keep(cut_lineage(corpus.apply_bigrams(docs, phrases(docs), "message_id")))
    return corpus.lemmas(merged, cut_lineage(lexicon(merged)), "message_id")


@query(f"""with {TOKENS},
sp as (select message_id, unnest(spelled) as token, generate_subscripts(spelled, 1) as pos from msg),
kept as (select message_id, pos, {LEMMA_SQL.format('token')} as lemma from sp
         where {LEMMA_SQL.format('token')} not in ({STOP}))
select m.message_id, coalesce(string_agg(lemma, ' ' order by pos), '') as tokens
from tok m left join kept using (message_id) group by 1""")
def serving_lemmas(spark, sf):
    """Serving order: lemmas, then stopwords; no collocations, every part of speech."""
    messages = standin.spread_messages(spark, sf)
    spelled = with_tokens(messages, stop=False).select("message_id", "tokens")
    return _text(serving_tokens(messages, cut_lineage(lexicon(spelled))))


@query(f"""with {ROWS}
select author_group, string_agg(token, ', ' order by n desc, token) as keywords from (
  select author_group, token, count(*) as n,
         row_number() over (partition by author_group order by count(*) desc, token) as r
  from rows_ group by 1, 2)
where r <= 10 group by 1""")
def top_keywords(spark, sf):
    """Ten most frequent tokens per group, joined by commas."""
    top = corpus.top_tokens(tokens(spark, sf), "author_group", 10)
    return (top.groupBy("author_group")
            .agg(F.sort_array(F.collect_list(F.struct("rank", "token"))).alias("_w"))
            .select("author_group", F.array_join(F.col("_w.token"), ", ").alias("keywords")))
