import unicodedata
from datetime import datetime

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.errors import PySparkException
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F, types as T

from eventlens.functions import geo, records, text, times
from eventlens.plans.topic_report import share, thousandths


def one(spark, column, **values):
    names = list(values)
    row = spark.createDataFrame([tuple(values.values())], ", ".join(
        f"{n} {'double' if isinstance(values[n], float) else 'string'}" for n in names))
    return row.select(column.alias("x")).first().x


@pytest.mark.parametrize("subject, expected", [
    ("Re: Stateful functions", ["re", "stateful", "functions"]),
    ("Élan vital\nÀ côté", ["elan", "vital", "cote"]),
    ("x yz a1b2cd _lead trail_ snake_case", ["yz", "cd", "trail_", "snake_case"]),
    ("don't 'quoted'", ["don", "quoted"]),
    ("fifteenletterss sixteenletterssx", ["fifteenletterss"]),
    ("流处理 问题 Ünïcödé", ["流处理", "问题", "unicode"]),
    ("", []),
    ("1 2 3 !", []),
])
def test_tokens(spark, subject, expected):
    assert one(spark, text.tokens(F.col("m")), m=subject) == expected
    assert one(spark, F.expr(text.tokens_sql("m")), m=subject) == \
        [t for t in expected if t not in text.ENGLISH_STOPWORDS]


def test_tokens_keep_accents_if_asked(spark):
    assert one(spark, text.tokens(F.col("m"), deaccent=False), m="Élan vital") == ["élan", "vital"]


def test_stopwords_are_sparks(spark):
    assert list(text.ENGLISH_STOPWORDS) == StopWordsRemover.loadDefaultStopWords("english")
    kept = one(spark, text.without_stopwords(F.split("m", " ")), m="the job is the job")
    assert kept == ["job", "job"]


def test_strip_accents_follows_unicode(spark):
    sample = "".join(chr(c) for c in range(0xC0, 0x250)) + "ế Ấ ộ о́ й"
    def bare(s):
        marks_off = "".join(c for c in unicodedata.normalize("NFD", s)
                            if unicodedata.category(c) != "Mn")
        return unicodedata.normalize("NFC", marks_off)
    assert one(spark, text.strip_accents(F.col("m")), m=sample) == bare(sample)


def test_weighted_words_there_and_back(spark):
    line = '0.144*"stateful" + 0.086*"set" + 1.000*"a_b"'
    parsed = one(spark, text.weighted_words(F.col("m")), m=line)
    assert [(w.thousandths, w.word) for w in parsed] == [(144, "stateful"), (86, "set"), (1000, "a_b")]
    assert one(spark, text.weighted_words_text(text.weighted_words(F.col("m"))), m=line) == line


def test_haversine(spark):
    def miles(*p):
        return one(spark, geo.haversine_miles(*[F.col(c) for c in "abcd"]),
                   a=p[0], b=p[1], c=p[2], d=p[3])
    assert miles(44.8, 20.4, 44.8, 20.4) == 0
    assert miles(0.0, 0.0, 0.0, 180.0) == pytest.approx(3.141592653589793 * 3958.8)
    assert miles(0.0, 0.0, 1.0, 0.0) == pytest.approx(69.09, abs=0.01)


@pytest.mark.parametrize("lat, lon, inside", [
    (44.6, 20.3, True), (44.57, 20.3, False), (44.91, 20.3, False),
    (44.6, 20.20, False), (44.6, 20.62, False)])
def test_box_is_open(spark, lat, lon, inside):
    assert one(spark, geo.inside_box(F.col("lat"), F.col("lon"), **geo.RULE_BOX),
               lat=lat, lon=lon) is inside


@pytest.mark.parametrize("written, parsed", [
    ("2024-01-02T03:04:05Z", datetime(2024, 1, 2, 3, 4, 5)),
    ("2024-01-02T03:04:05.250Z", datetime(2024, 1, 2, 3, 4, 5, 250000)),
    ("2024-01-02T03:04:05.123456Z", datetime(2024, 1, 2, 3, 4, 5, 123456))])
def test_iso_text(spark, written, parsed):
    back = one(spark, times.from_iso_z(F.col("t")).cast("timestamp_ntz"), t=written)
    assert back == parsed
    assert one(spark, times.iso_z(times.from_iso_z(F.col("t"))), t=written) == \
        "2024-01-02T03:04:05Z"


def test_week_and_range(spark):
    ts = F.col("t").cast("timestamp")
    week = times.week_start(ts).cast("timestamp_ntz")
    assert one(spark, week, t="2024-01-07 23:59:59") == datetime(2024, 1, 1)
    assert one(spark, week, t="2024-01-08 00:00:00") == datetime(2024, 1, 8)
    inside = times.in_range(ts, "2024-01-01", "2024-01-08")
    assert one(spark, inside, t="2024-01-01 00:00:00") is True
    assert one(spark, inside, t="2024-01-08 00:00:00") is False


SCHEMA = T.StructType([T.StructField("customer", T.StringType()),
                       T.StructField("amount", T.DoubleType())])
GOOD = '{"customer":"a","amount":1.5}'
NULL = '{"customer":"a","amount":null}'
MISSING = '{"customer":"a"}'
BROKEN = '{"customer":"a",'
WRONG = '{"customer":"a","amount":"many"}'


def wire(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_strict_decode_takes_null_but_not_missing(spark):
    rows = records.decode_strict(wire(spark, GOOD, NULL), SCHEMA).collect()
    assert [tuple(r) for r in rows] == [("a", 1.5), ("a", None)]


@pytest.mark.parametrize("bad", [MISSING, BROKEN, WRONG, "plain", "[1]"])
def test_strict_decode_fails_even_if_the_field_is_not_read(spark, bad):
    decoded = records.decode_strict(wire(spark, GOOD, bad), SCHEMA)
    with pytest.raises(PySparkException):
        decoded.select("customer").collect()


def test_quarantine_loses_nothing(spark):
    good, bad = records.decode_or_quarantine(
        wire(spark, GOOD, NULL, MISSING, BROKEN, WRONG, "plain"), SCHEMA)
    assert sorted(map(tuple, good.collect()), key=repr) == [("a", 1.5), ("a", None)]
    reasons = {r.value: r.reason for r in bad.collect()}
    assert reasons == {MISSING: "missing: amount", BROKEN: "malformed", WRONG: "malformed",
                       "plain": "malformed"}


def test_encode_writes_every_field(spark):
    df = spark.createDataFrame([("a", None)], SCHEMA)
    assert df.select(records.encode("customer", "amount")).first()[0] == NULL


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**6), st.integers(1, 10**6)), min_size=1, max_size=20))
def test_whole_number_shares(spark, pairs):
    df = spark.createDataFrame([(min(a, b), b) for a, b in pairs], "n long, total long")
    for r in df.select("n", "total", thousandths(F.col("n"), F.col("total")).alias("t"),
                       share(F.col("n"), F.col("total")).alias("s")).collect():
        assert r.t == (r.n * 2000 + r.total) // (2 * r.total)
        assert r.s == pytest.approx(r.n / r.total, abs=0.5001e-4)
