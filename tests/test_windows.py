import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from eventlens.operators.windows import running_max_before, tumbling_totals
from eventlens.plans import transactions as rules
from eventlens.schemas import TRANSACTIONS

T0 = datetime(2024, 1, 1)


def tx(spark, *rows):
    """(customer, minute, online, store[, lat, lon, type])"""
    full = []
    for customer, minute, online, store, *rest in rows:
        lat, lon, kind = (list(rest) + [44.7, 20.4, "shopping"][len(rest):])
        full.append((customer, kind, float(online), float(store), lat, lon,
                     T0 + timedelta(minutes=minute)))
    return spark.createDataFrame(full, TRANSACTIONS)


def test_edge_row_belongs_to_the_later_window(spark):
    rows = tumbling_totals(tx(spark, ("a", 4.9, 1, 0), ("a", 5, 2, 0)), "5 minutes").collect()
    assert {(r.last_transaction_time, r.total_online_payment_amount) for r in rows} == {
        (T0 + timedelta(minutes=5), 1.0), (T0 + timedelta(minutes=10), 2.0)}


def test_count_skips_null_types_and_maxima_are_independent(spark):
    r = tumbling_totals(tx(spark, ("a", 0, 0, 1, 44.6, 20.5), ("a", 1, 0, 1, 44.8, 20.3, None)),
                        "5 minutes").first()
    assert (r.count_transactions, r.lat, r.lon) == (1.0, 44.8, 20.5)
    assert isinstance(r.count_transactions, float)


@pytest.mark.parametrize("n, online, store, hit", [
    (3, 1, 2, True), (2, 1, 2, False), (3, 2, 2, False), (3, 3, 2, False)])
def test_rule_code(spark, n, online, store, hit):
    rows = tx(spark, *[("a", i, online, store) for i in range(n)])
    assert (rules.rule_code(rows).count() == 1) is hit


@pytest.mark.parametrize("n, hit", [(5, False), (6, True)])
def test_documented_count_is_more_than_five(spark, n, hit):
    rows = tx(spark, *[("a", i / 2, 2, 1) for i in range(n)])
    assert (rules.rule_documented_basic(rows).count() == 1) is hit


def _busy(minute, lat=None):
    rows = [("a", minute + i / 10, 2, 0) for i in range(6)]
    return rows + ([("a", minute + 1, 0, 1, lat, 20.4)] if lat else [])


def test_documented_rule_looks_past_windows_without_a_point(spark):
    rows = tx(spark, *_busy(0, 44.6), *_busy(5), *_busy(10, 44.8), *_busy(15, 44.801))
    hits = rules.rule_documented(rows).collect()
    assert [(r.last_transaction_time, r.lat) for r in hits] == [(T0 + timedelta(minutes=15), 44.8)]
    assert hits[0].miles_moved == pytest.approx(13.82, abs=0.01)


def test_last_point_is_a_visited_one(spark):
    rows = tx(spark, ("a", 0, 0, 1, 44.9, 20.2), ("a", 1, 0, 1, 44.6, 20.6), ("a", 2, 1, 0, 44.7, 20.3))
    r = rules.windows_with_point(rows).first()
    assert (r.point_lat, r.point_lon) == (44.6, 20.6)


def test_box_readings_differ(spark):
    rows = tx(spark, *[("a", i, 0, 1) for i in range(3)], ("a", 4, 0, 1, 45.5, 20.4))
    assert rules.geo_box_prefilter(rows).first().count_transactions == 3
    assert rules.geo_box_having(rows).count() == 0


@pytest.mark.parametrize("block", [1, 7, 1000])
def test_running_max_equals_brute_force(spark, block):
    random.seed(block)
    rows = [(p, o, random.choice([None, *range(100)])) for p in "xy" for o in range(60)]
    df = spark.createDataFrame(rows, "p string, o long, v long").repartition(5)
    got = {(r.p, r.o): r.seen for r in
           running_max_before(df, "v", "o", "seen", block, ["p"]).collect()}
    for p, o, _ in rows:
        before = [v for q, i, v in rows if q == p and i < o and v is not None]
        assert got[p, o] == (max(before) if before else None)
    assert len(got) == len(rows)


def test_late_audit(spark):
    rows = [("a", 0, 1, 0), ("a", 10, 1, 0), ("a", 9.5, 1, 0), ("a", 8, 1, 0), ("a", 3, 1, 0)]
    offsets = F.create_map(*[x for i, (_, m, *_) in enumerate(rows)
                             for x in (F.lit(T0 + timedelta(minutes=m)), F.lit(i))])
    arrived = tx(spark, *rows).withColumn(
        "arrival_offset", offsets[F.col("transaction_datetime")])
    late = {r.arrival_offset: r.dropped for r in
            rules.late_rows_audit(arrived, rules.LateAudit(block=2)).collect()}
    # 9.5 is within the minute; 8 is late but its window ends at 10; 3 has lost its window
    assert late == {3: False, 4: True}
