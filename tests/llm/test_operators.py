"""Nulls, empty and repeated rows, and tables without rows, through the operators."""

import corpus_pipeline
from eventlens.llm import mixing, near_dups, passages, quality, secrets
from eventlens.session import scratch_path

WORDS = " ".join(f"word{i}" for i in range(60)) + "."
ROWS = [(1, WORDS, "a"), (1, WORDS, "a"), (2, WORDS + " more", None), (3, None, "b"), (4, "", "b"),
        (None, 'token = "abcdefgh1234" ' + "x" * 3000, "b")]


def docs(spark, rows=ROWS):
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_near_duplicates(spark):
    rows = near_dups.near_duplicates(docs(spark)).collect()
    found = {(r.doc_id, r.class_id, r.class_size) for r in rows}
    assert len(rows) == len(ROWS)
    assert found == {(1, 1, 3), (2, 1, 3), (3, 3, 1), (4, 4, 1), (None, None, 1)}


def test_short_paragraphs_are_compared(spark):
    line = " ".join(f"short{i}" for i in range(12))
    rows = [(1, f"one\n{line}\nfour words are few", "a"), (2, f"{line} more\nother", "a"), (3, "alone\n" + line, "a"),
            (4, "four words are few\nfive words are quite enough", "a"), (5, "five words are quite enough", "a")]
    found = {(r.doc_id, r.place, r.n_words, r.first_doc_id, r.removed) for r in passages.repeats(docs(spark, rows)).collect()}
    assert found == {(1, 1, 12, 1, False), (2, 0, 13, 1, True), (3, 1, 12, 1, True), (4, 1, 5, 4, False), (5, 0, 5, 4, True)}
    longer = passages.repeats(docs(spark, rows), least=10).collect()
    assert {r.doc_id for r in longer} == {1, 2, 3}


def test_passages_are_extended_to_where_texts_differ(spark):
    passage = " ".join(f"same{i}" for i in range(70))
    other = {i: " ".join(f"own{i}x{j}" for j in range(30)) for i in range(6)}
    rows = [(1, f"{other[1]} {passage} {other[1]}", "a"), (2, f"{other[2]} and {passage}", "a"), (2, f"{other[2]} and {passage}", "a"),
            (3, f"{passage}\n{other[3]}", "a"), (None, f"{other[4]} {passage} {other[5]}", "a"), (5, "x y z " * 60, "a")]
    found = {(r.doc_id, r.start, r.end, r.n_words, r.first_doc_id, r.removed) for r in passages.repeats(docs(spark, rows)).collect()}
    # the row without an id is the first
    assert found == {(None, 30, 100, 70, None, False), (1, 30, 100, 70, None, True), (2, 31, 101, 70, None, True),
                     (3, 0, 70, 70, None, True)} | {x for x in found if x[1] is None}


def test_mix_takes_what_is_planned(spark):
    shares = mixing.plan(docs(spark)).collect()
    assert len(shares) == len(ROWS) and all(r.taken <= 2 * r.size for r in shares)
    assert mixing.mix(docs(spark)).count() == sum(r.repetitions for r in shares)
    assert mixing.plan(docs(spark, [])).count() == 0


def test_ledger_scans_a_blob_once(spark):
    ledger = scratch_path(spark, "ledger")
    assert secrets.findings(docs(spark), ledger).where("size(spans) > 0").count() == 1
    before = spark.read.parquet(ledger).count()
    secrets.findings(docs(spark), ledger)
    assert spark.read.parquet(ledger).count() == before == 4   # null and empty are one blob
    clean = secrets.redact(docs(spark), ledger).where("doc_id IS NULL").first().text
    assert clean.startswith("[secret]") and "abcdefgh1234" not in clean


def test_private_keys_go_whole(spark):
    lines = [f"MIIE{i:02d}" + "aB3+/x" * 9 for i in range(30)]
    begin, end = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
    head = "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0011\n\n"
    body = "\n".join(lines) + "\nqQ=="
    texts = [f"{begin}\n{body}\n{end}", f"{begin}\n{head}{body}\n{end}", f"{begin}\n{body}", f"{begin}\n{head}{body}",
             f"{begin}\\n" + body.replace("\n", "\\n") + f"\\n{end}", f"{begin}\r\n" + body.replace("\n", "\r\n"),
             f"{begin}\n{body}\n\n{begin}\n{body}\n{end}"]
    rows = [(i, f"before {t}\nafter it - all stays", "a") for i, t in enumerate(texts)]
    clean = {r.doc_id: r.text for r in secrets.redact(docs(spark, rows), scratch_path(spark, "ledger")).collect()}
    one = "before [secret]\nafter it - all stays"
    assert clean == {i: one for i in range(6)} | {6: "before [secret]\n\n[secret]\nafter it - all stays"}


def test_keys_of_any_form_go_whole(spark):
    """Neither many lines nor odd fillings end the match, or the executor."""
    line = "aB3+/x" * 10
    begin, end = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
    many = "\n".join([line] * 100_000)
    fields = "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,00\n" * 5
    texts = [f"{begin}\n{many}", f"{begin}\n{many}\n{end}", f"{begin}\n{line}\n# {'-' * 1000}\n{line}\n{end}", f"{begin}\n{fields}\n{line}",
             f"{begin}{' ' * 60}\n\n{line}{' ' * 40}\n{line}", f"{begin}\n{line}\n-{end}", f"{begin}\n{'- ' * 50_000}{end}"]
    rows = [(i, f"before {t}\nafter it - all stays", "a") for i, t in enumerate(texts)]
    clean = {r.doc_id: r.text for r in secrets.redact(docs(spark, rows), scratch_path(spark, "ledger")).collect()}
    assert clean == dict.fromkeys(range(len(texts)), "before [secret]\nafter it - all stays")


def test_small_chunks_encode_as_the_library(spark):
    import public_tokenizers
    from eventlens.llm import codec
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    texts = [WORDS * 4, "a" * 2000, "é ünï 12 don't\n\n " * 90, "x " * 140 + "y" * 700 + " z" * 300, " " * 900, "short"]
    rows = [(i, t, "a") for i, t in enumerate(texts)]
    encoded = codec.encode(docs(spark, rows), ranks, chunk=300, overlap=64)
    library = codec.codec(ranks).encoding
    got = {r.doc_id: (list(r.ids), bytes(r.decoded)) for r in codec.decode(encoded, ranks).collect()}
    assert got == {i: (library.encode_ordinary(t), t.encode()) for i, t in enumerate(texts)}


def test_quality_keeps_prose(spark):
    kept = {(r.doc_id, r.kept) for r in quality.rate(docs(spark)).collect()}
    assert kept == {(1, True), (2, True), (3, False), (4, False), (None, False)}
    assert quality.keep_good(docs(spark)).columns == ["doc_id", "text", "source"]


def test_stages_are_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "secrets", "mixing", "encoding"]


def test_mix_takes_what_the_plan_holds(spark):
    """Also for rows alike, of which only some are taken once more, and clashing columns."""
    from collections import Counter
    from pyspark.sql import functions as F
    rows = ([(None, "one two three", None, 1)] * 60 + [(7, "a b", "s", 1)] * 40 + [(i, "w " * (i % 9), "s", 1) for i in range(50)]
            + [(i, "x y", "t", 1) for i in range(30)] + [(None, None, "u", 1), (3, "", "u", 1)])
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    for ratio in (0.4, 1.5, 1.9):
        held = Counter()
        for r in mixing.plan(frame, ratio=ratio).collect():
            held[r.doc_id, r.source, r.size] += r.repetitions
        mixed = mixing.mix(frame, ratio=ratio)
        assert mixed.columns == frame.columns
        got = Counter((r.doc_id, r.source, len((r.text or "").split())) for r in mixed.collect())
        assert got == +held and not any(source == "u" for _, source, _ in got)
    assert mixing.mix(frame.limit(0)).collect() == []
