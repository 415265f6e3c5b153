from datetime import datetime, timedelta

import pytest
from pyspark.errors import PySparkException, StreamingQueryException
from pyspark.sql import functions as F, types as T

from eventlens import schemas
from eventlens.functions.records import encode
from eventlens.plans import classify, transactions as rules
from eventlens.sources import connectors, standin
from eventlens.streaming import jobs
from tests.conftest import SF

ONCE = {"availableNow": True}
T0 = datetime(2024, 1, 1)


def rows(spark, *items):
    """(customer, minute, online, store, lat)"""
    return spark.createDataFrame(
        [(c, "shopping", float(o), float(s), float(lat), 20.4, T0 + timedelta(minutes=m))
         for c, m, o, s, lat in items], schemas.TRANSACTIONS)


def write_slice(df, folder, number):
    """One text file of JSON records; later slices have later names and times."""
    lines = [r.value for r in df.select(encode(*df.columns).alias("value")).collect()]
    folder.mkdir(exist_ok=True)
    file = folder / f"{number:03d}.txt"
    file.write_text("\n".join(lines) + "\n")
    stamp = 1_700_000_000 + number
    import os
    os.utime(file, (stamp, stamp))


def record_stream(spark, folder):
    return connectors.read_record_stream(spark, "text", {"maxFilesPerTrigger": "1"}, str(folder))


def run(df, path, progress):
    query = jobs.write_table_stream(df, str(path), str(progress), ONCE)
    query.awaitTermination()
    return query


def table(spark, path, schema=schemas.TRANSACTION_RESULTS):
    return spark.read.schema(schema).parquet(str(path))


CLOSING = ("z", 600, 1, 0, 44.7)


def test_stream_equals_batch_and_goes_on_from_its_checkpoint(spark, tmp_path):
    tx = standin.transactions(spark, SF).select(*schemas.TRANSACTIONS.names).cache()
    cuts = [T0 + timedelta(minutes=m) for m in (0, 13, 27, 44, 61)]
    stream = jobs.transactions_from_records
    out, progress, wire = tmp_path / "out", tmp_path / "cp", tmp_path / "wire"
    for i, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
        write_slice(tx.where((F.col("transaction_datetime") >= lo)
                             & (F.col("transaction_datetime") < hi)), wire, i)
        if i in (1, 3):     # two runs on the same checkpoint
            if i == 3:
                write_slice(rows(spark, CLOSING), wire, 9)
            run(rules.rule_code(stream(record_stream(spark, wire))), out, progress)
    cents = ["round(total_online_payment_amount, 2)", "round(total_in_store_payment_amount, 2)"]
    exact = ["customer", "count_transactions", *cents, "lat", "lon", "last_transaction_time"]
    got = sorted(map(tuple, table(spark, out).selectExpr(*exact).collect()))
    want = sorted(map(tuple, rules.rule_code(tx).selectExpr(*exact).collect()))
    assert want and got == want


def test_registered_streams_return_every_window(spark):
    import __spark_entry__ as entry
    queries = entry.queries()
    for name in ("rule_code", "rule_documented"):
        got = sorted(map(tuple, queries[f"stream_{name}_whole"](spark, SF).collect()))
        assert got and got == sorted(map(tuple, queries[name](spark, SF).collect()))


def test_late_row_is_dropped_and_counted(spark, tmp_path):
    wire = tmp_path / "wire"
    write_slice(rows(spark, *[("a", m, 0, 1, 44.7) for m in (0, 1, 2)], ("b", 20, 1, 0, 44.7)), wire, 0)
    write_slice(rows(spark, ("a", 21, 0, 1, 44.7)), wire, 1)
    write_slice(rows(spark, ("a", 3, 0, 50, 44.7)), wire, 2)
    write_slice(rows(spark, CLOSING), wire, 3)
    query = run(rules.rule_code(jobs.transactions_from_records(record_stream(spark, wire))),
                tmp_path / "out", tmp_path / "cp")
    got = table(spark, tmp_path / "out").collect()
    assert [(r.customer, r.total_in_store_payment_amount) for r in got] == [("a", 3.0)]
    dropped = sum(o.numRowsDroppedByWatermark for p in query.recentProgress for o in p.stateOperators)
    assert dropped == 1


def test_bad_record_fails_the_stream(spark, tmp_path):
    wire = tmp_path / "wire"
    wire.mkdir()
    (wire / "0.txt").write_text('{"customer":"a"}\n')
    with pytest.raises((StreamingQueryException, PySparkException)):
        run(rules.rule_code(jobs.transactions_from_records(record_stream(spark, wire))),
            tmp_path / "out", tmp_path / "cp")


def test_last_point_is_kept_across_batches(spark, tmp_path):
    def busy(customer, minute, lat):
        return ([(customer, minute + i / 10, 2, 0, 44.7) for i in range(6)]
                + ([(customer, minute + 1, 0, 1, lat)] if lat else []))
    items = [busy("a", 0, 44.6) + busy("b", 1, 44.6), busy("a", 5, None), busy("a", 10, 44.8),
             busy("a", 15, 44.801) + busy("b", 16, 44.7), [CLOSING]]
    wire = tmp_path / "wire"
    for i, part in enumerate(items):
        write_slice(rows(spark, *part), wire, i)
    points = rules.windows_with_point(jobs.transactions_from_records(record_stream(spark, wire)))
    run(points, tmp_path / "points", tmp_path / "cp1")
    windows = (spark.readStream.schema(jobs.WINDOW_POINTS).option("maxFilesPerTrigger", "1")
               .parquet(str(tmp_path / "points")))
    query = run(jobs.documented_rule(windows), tmp_path / "out", tmp_path / "cp2")
    assert sum(p.numInputRows > 0 for p in query.recentProgress) > 1
    result = schemas.TRANSACTION_RESULTS.names
    got = sorted(map(tuple, table(spark, tmp_path / "out").select(*result).collect()))
    batch = rules.rule_documented(rows(spark, *[r for part in items for r in part]))
    assert got == sorted(map(tuple, batch.select(*result).collect()))
    assert [(r[0], r[4]) for r in got] == [("a", 44.8), ("b", 44.7)]


def test_one_stream_keeps_the_last_point_and_forgets_the_silent(spark, tmp_path):
    def busy(customer, minute, lat):
        return ([(customer, minute + i / 10, 2, 0, 44.7) for i in range(6)]
                + ([(customer, minute + 1, 0, 1, lat)] if lat else []))
    items = [busy("a", 0, 44.6) + busy("b", 1, 44.6), busy("a", 5, None), busy("a", 10, 44.8),
             busy("a", 15, 44.801) + busy("b", 16, 44.7), busy("c", 100, 44.6), busy("a", 125, 44.6) + busy("c", 125, 44.7), [CLOSING]]
    wire = tmp_path / "wire"
    for i, part in enumerate(items):
        write_slice(rows(spark, *part), wire, i)
    result = schemas.TRANSACTION_RESULTS.names
    batch = rules.rule_documented(rows(spark, *[r for part in items for r in part]))
    want = sorted(map(tuple, batch.select(*result).collect()))
    for keep, left_out in ((7 * 86400, set()), (3600, {("a", 44.6)})):   # a is silent from minute 20 to 125, c for 25
        df = jobs.documented_rule_stream(jobs.transactions_from_records(record_stream(spark, wire)), keep_seconds=keep)
        run(df, tmp_path / f"out{keep}", tmp_path / f"cp{keep}")
        got = sorted(map(tuple, table(spark, tmp_path / f"out{keep}").select(*result).collect()))
        assert got == [r for r in want if (r[0], r[4]) not in left_out]
    assert {(r[0], r[4]) for r in want} == {("a", 44.8), ("b", 44.7), ("a", 44.6), ("c", 44.7)}


def test_bad_records_are_set_aside_also_after_a_restart(spark, tmp_path):
    wire, good, bad = tmp_path / "wire", tmp_path / "good", tmp_path / "bad"
    schema = T.StructType([T.StructField("k", T.LongType())])

    def go():
        jobs.start_decoding(record_stream(spark, wire), schema, str(good), str(bad), str(tmp_path / "cp"), ONCE).awaitTermination()
    wire.mkdir()
    (wire / "0.txt").write_text('{"k": 1}\nprose\n{"x": 2}\n')
    go()
    (wire / "1.txt").write_text('{"k": 3}\n{"k": "no number"}\n')
    go()
    again = jobs.split_each_batch(schema, str(good), str(bad))      # the last batch runs once more
    again(spark.createDataFrame([('{"k": 3}',), ('{"k": "no number"}',)], "value string"), 1)
    assert sorted(r.k for r in spark.read.parquet(str(good)).collect()) == [1, 3]
    assert sorted((r.value, r.reason) for r in spark.read.parquet(str(bad)).collect()) == [
        ("prose", "malformed"), ('{"k": "no number"}', "malformed"), ('{"x": 2}', "missing: k")]


def test_a_replayed_batch_sees_the_labels_it_first_saw(spark, tmp_path):
    weights = spark.createDataFrame([("0", "alpha", 500), ("1", "beta", 500)], "topic_id string, word string, thousandths long")
    labels = [("0", "old", datetime(2020, 1, 1)), ("1", "here", datetime(2020, 1, 1))]

    def versions(session):
        return session.createDataFrame(labels, "id string, topic string, valid_from timestamp")
    seen = {}

    def sink(df, batch_id):
        seen.setdefault(batch_id, []).append(sorted(map(tuple, df.collect())))
    run_batch = jobs.classify_each_batch_as_of(lambda s: weights, versions, sink, str(tmp_path / "times"))
    batch = spark.createDataFrame([(T0, k, None, "n", "e", s) for k, s in [("m1", "alpha"), ("m2", "beta"), ("m3", None)]], schemas.MESSAGES)
    run_batch(batch, 0)
    now = jobs.recorded_time(spark, str(tmp_path / "times"), 0)
    labels += [("0", "new", now + timedelta(microseconds=1)), ("1", None, now + timedelta(microseconds=1)), ("0", "older", datetime(2019, 1, 1))]
    run_batch(batch, 0)
    run_batch(batch, 1)
    assert seen[0][0] == seen[0][1]
    assert [(r[0], r[4], r[5]) for r in seen[0][0]] == [("m1", "old", now), ("m2", "here", now)]
    assert [(r[0], r[4]) for r in seen[1][0]] == [("m1", "new")]     # id 1 is gone by then


def test_versions(spark):
    from eventlens.operators.versions import lookup_as_of, with_valid_to
    day = lambda d: datetime(2024, 1, d)
    table = spark.createDataFrame([("a", "one", day(1)), ("a", "two", day(3)), ("a", "tie", day(3)), ("b", None, day(2)), ("b", "x", None)],
                                  "key string, name string, valid_from timestamp")
    facts = spark.createDataFrame([(i, k, t) for i, (k, t) in enumerate(
        [("a", day(1)), ("a", day(2)), ("a", day(9)), ("a", None), ("b", day(1)), ("b", day(5)), (None, day(5)), ("c", day(5))])],
        "id int, key string, at timestamp")
    for sizes in ({}, {"max_rows": 0}):     # broadcast, and by shuffle with salted hot keys
        left = lookup_as_of(facts, table, ["key"], "at", ["id"], how="left", **sizes).collect()
        assert sorted((r.id, r.name, r.valid_from) for r in left if r.valid_from) == [
            (0, "one", day(1)), (1, "one", day(1)), (2, "two", day(3)), (5, None, day(2))]
        assert len(left) == 8
        assert {r.id for r in lookup_as_of(facts, table, ["key"], "at", ["id"], **sizes).collect()} == {0, 1, 2, 5}
    ends = {(r.name, r.valid_to) for r in with_valid_to(table.where("key = 'a' and name <> 'tie'"), ["key"]).collect()}
    assert ends == {("one", day(3)), ("two", None)}


def test_json_sink(spark, tmp_path):
    wire = tmp_path / "wire"
    write_slice(rows(spark, ("a", 0, 0, 1, 44.7)), wire, 0)
    query = connectors.write_record_stream(
        jobs.transactions_from_records(record_stream(spark, wire)), "text", {},
        str(tmp_path / "cp"), ONCE, path=str(tmp_path / "out"), key="customer")
    query.awaitTermination()
    assert [r.value for r in spark.read.text(str(tmp_path / "out")).collect()] == [
        '{"customer":"a","transaction_type":"shopping","online_payment_amount":0.0,'
        '"in_store_payment_amount":1.0,"lat":44.7,"lon":20.4,'
        '"transaction_datetime":"2024-01-01T00:00:00.000000Z"}']


def test_messages_see_the_dimension_of_their_batch(spark, tmp_path):
    source, dim, out = tmp_path / "messages", tmp_path / "dim", tmp_path / "out"

    def arrive(number, *messages):
        spark.createDataFrame([(T0, k, None, "n", "e", s) for k, s in messages],
                              schemas.MESSAGES).coalesce(1).write.mode("append").parquet(str(source))

    def relabel(label):
        spark.createDataFrame([("0", label, '0.5*"alpha"')], schemas.DIM_TOPICS).coalesce(1) \
            .write.mode("overwrite").parquet(str(dim))

    def topics(session):
        return session.read.schema(schemas.DIM_TOPICS).parquet(str(dim))

    seen = []

    def sink(df, batch_id):
        seen.append(batch_id)
        for _ in range(2):      # a replay must not change the table
            connectors.upsert_files(df, batch_id, str(out), ["message_id"], ["message_date"])

    def go():
        stream = spark.readStream.schema(schemas.MESSAGES).parquet(str(source))
        jobs.start_classification(stream, lambda s: classify.topic_weights(topics(s)), topics, sink,
                                  str(tmp_path / "cp"), ONCE).awaitTermination()

    relabel("before")
    arrive(0, ("m1", "alpha"), ("m2", None))
    go()
    relabel("after")
    arrive(1, ("m3", "alpha"))
    go()
    arrive(2, ("m1", "alpha again"))
    go()
    got = connectors.read_upserted(spark, str(out), schemas.MESSAGE_TOPICS, ["message_id"]).collect()
    assert {r.message_id: r.topic_description for r in got} == {"m1": "after", "m3": "after"}
    assert seen == [0, 1, 2]


def test_slices_are_as_many_files_as_the_table_has_splits(spark, tmp_path, monkeypatch):
    """A slice is one micro-batch of several files, some perhaps empty; the rule's rows are those of the batch."""
    from checks import streams
    from eventlens.sources import standin
    own = spark.range(400).selectExpr(
        "id as event_id", "timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, 0, 0, cast(id * id div 4 as int)) as ts",
        "id % 7 as user_id", "'view' as event_type", "cast(id % 11 + 1 as double) as value", "'{}' as props")
    own.where("event_id < 300 or event_id >= 370").repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 30))     # a split for each file
    monkeypatch.setattr(streams, "scratch_path", lambda spark, name: str(tmp_path / name))
    try:
        stream = streams.closed_transactions(spark, str(tmp_path))
        path, progress = str(tmp_path / "out"), str(tmp_path / "progress")
        query = jobs.write_table_stream(jobs.documented_rule_stream(stream, "event_id"), path, progress, streams.ONCE)
        query.awaitTermination()
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    read = [p.numInputRows for p in query.recentProgress if p.numInputRows]
    assert len(list((tmp_path / "slices").glob("*.parquet"))) == 3 * streams.SLICES + 1
    assert len(read) == streams.SLICES and read[-1] == 1 and sum(read) == 331      # one slice has no rows
    names = streams.DISTANCE.names
    batch = rules.rule_documented(standin.transactions(spark, str(tmp_path)), "event_id").select(*names)
    got = spark.read.schema(streams.DISTANCE).parquet(path).select(*names)
    assert sorted(map(str, got.collect())) == sorted(map(str, batch.collect())) and batch.count() > 0
