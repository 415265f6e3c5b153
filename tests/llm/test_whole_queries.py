"""Registered queries without SQL, as a whole, against the libraries and plain loops."""

import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from eventlens.llm import codec, near_dups, passages, token_counts, token_store
from eventlens.session import scratch_path
from tests.conftest import SF

LONG = "It's a word, and 12 more… " * 9000
ROWS = [(5, "The cat sat. The cat ran."), (None, "no id"), (3, None), (3, ""), (9, "  two  blanks\n\n and\ttabs "),
        (5, "The cat sat. The cat ran."), (-4, "naïve Straße 東京タワー 🙂"), (2**40, LONG), (5, "Another of this id."),
        (None, None), (12, "x<|endoftext|>y <|endoftext|> z"), (7, " "), (2**40, LONG)]
#: Names that the operators use themselves.
EXTRA = ["seq", "ids", "file", "base", "n_tokens", "fp", "node", "key", "doc", "place", "component", "start"]


def folder(tmp_path, rows):
    table = pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": pa.array([r[1] for r in rows], pa.string()),
                      **{name: pa.array([None] * len(rows), pa.string()) for name in EXTRA}})
    pq.write_table(table, tmp_path / "documents.parquet")
    return str(tmp_path)


def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def sample(name="documents"):
    return [(r["doc_id"], r["text"]) for r in pq.read_table(f"{SF}/{name}.parquet", columns=["doc_id", "text"]).to_pylist()]


def test_token_counts(spark, tmp_path):
    rows = ROWS + sample()
    n = [len(e.ids) for e in library().encode_batch([t or "" for _, t in rows], add_special_tokens=False)]
    expected = Counter((d, len((t or "").encode()), k, k > 512) for (d, t), k in zip(rows, n))
    got = token_counts.op1_token_counts(spark, folder(tmp_path, rows))
    assert Counter(tuple(r) for r in got.select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()) == expected


def test_token_ids(spark, tmp_path):
    rows = sorted(ROWS + sample(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    lists = [[*e.ids, 2] for e in library().encode_batch([t or "" for _, t in rows], add_special_tokens=False)]
    expected, start = Counter(), 0
    for (doc, _), ids in zip(rows, lists):
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        expected[doc, start, len(ids), zlib.crc32(raw)] += 1
        start += len(ids)
    got = token_store.op5_token_ids(spark, folder(tmp_path, ROWS + sample()))
    assert Counter(tuple(r) for r in got.select("doc_id", "start", "n_tokens", "ids_crc32").collect()) == expected


def test_token_ids_are_looked_up_by_metadata(spark):
    path = scratch_path(spark, "ids")
    docs = spark.createDataFrame([(i * 3, f"text number {i}") for i in range(3000)], "doc_id long, text string")
    token_store.write_ids(docs, path, public_tokenizers.path("byte_bpe_50k.json"), stride=1000)
    one = token_store.read_ids(spark, path).where("doc_id = 2997")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,2997)]" in plan
    assert [r.ids for r in one.collect()] == [[*library().encode("text number 999").ids, 2]]
    assert token_store.read_ids(spark, path).where("doc_id = 2998").count() == 0      # between two ids
    files = [f for f in __import__("os").listdir(path) if f.endswith(".orc")]
    data = b"".join(open(f"{path}/{f}", "rb").read() for f in files)
    assert data.startswith(b"ORC") and token_store.read_ids(spark, path).count() == 3000


def test_merged_ids(spark, tmp_path):
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    plain = codec.codec(ranks).encoding
    rows, expected = ROWS + sample(), Counter()
    for doc, text in rows:
        ids = plain.encode_ordinary(text or "")
        expected[doc, len(ids), sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest(),
                 sha256((text or "").encode()).hexdigest()] += 1
    got = codec.op7_bpe(spark, folder(tmp_path, rows))
    assert Counter(tuple(r) for r in got.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()) == expected


def shingles(text, size=5):
    words = (text or "").split()
    return Counter(tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))) if words else Counter()


def linked(bags, least=0.8):
    """Class of each of ``bags`` by all pairs; empty ones are alone."""
    up = list(range(len(bags)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i
    sizes = [sum(b.values()) for b in bags]
    for i, a in enumerate(bags):
        for j in range(i):
            if not least * max(sizes[i], sizes[j]) <= min(sizes[i], sizes[j]) or not sizes[i]:
                continue
            common = sum((a & bags[j]).values())
            if common >= least * (sizes[i] + sizes[j] - common):
                x, y = top(i), top(j)
                up[max(x, y)] = min(x, y)
    return [top(i) for i in range(len(bags))]


def test_near_duplicates(spark, tmp_path):
    words = [f"w{i}" for i in range(120)]
    near = [(1000 + k, " ".join(words[:k] + ["other"] + words[k + 1:])) for k in range(0, 120, 7)]
    rows = [r for r in sample() if r[0] is not None] + near + near[:2] + [(2000, None), (2001, "")]
    group = linked([shingles(t) for _, t in rows])
    members = defaultdict(list)
    for (doc, _), g in zip(rows, group):
        members[g].append(doc)
    expected = Counter((doc, min(members[g]), len(members[g])) for (doc, _), g in zip(rows, group))
    got = near_dups.op4_near_dups(spark, folder(tmp_path, rows))
    assert Counter((r.doc_id, r.class_id, r.class_size) for r in got.collect()) == expected


def test_repeated_passages(spark, tmp_path):
    """Every word of a run of 51 that two documents share is in a passage, no passage is
    without a copy, and like lines of different documents are one class."""
    own = {i: [f"own{i}x{j}" for j in range(200)] for i in range(4)}
    shared = [f"same{j}" for j in range(55)]
    extra = [(3000 + i, " ".join(own[i][:20 * i] + shared + own[i][20 * i:])) for i in range(4)]
    rows = [r for r in sample() if r[0] is not None] + extra + [(3100, None), (3101, "")]
    ids = Counter(d for d, _ in rows)
    assert max(ids.values()) == 1
    found = passages.op8_passages(spark, folder(tmp_path, rows)).collect()
    covered, copies = defaultdict(set), defaultdict(set)
    for r in found:
        copies[r.kind, r.class_id].add(r.doc_id)
        if r.kind == "passage":
            covered[r.doc_id].update(range(r.start, r.end))
            assert r.n_words == r.end - r.start >= 32 or not r.removed
    assert all(len(docs) > 1 for docs in copies.values())
    where = defaultdict(set)
    words = {d: (t or "").split() for d, t in rows}
    for d, w in words.items():
        for i in range(len(w) - 50):
            where[tuple(w[i:i + 51])].add((d, i))
    runs = [x for x in where.values() if len({d for d, _ in x}) > 1]
    assert runs and all(i in covered[d] and i + 50 in covered[d] for x in runs for d, i in x)
    class_of = {(r.doc_id, r.place): r.class_id for r in found if r.kind == "paragraph"}
    lines = [(d, i, line) for d, t in rows for i, line in enumerate((t or "").split("\n")) if len(line.split()) >= 5]
    by_text = defaultdict(list)
    for d, i, line in lines:
        by_text[line].append((d, i))
    texts = list(by_text)
    for group in _groups(linked([shingles(t) for t in texts])):
        places = [p for i in group for p in by_text[texts[i]]]
        if len({d for d, _ in places}) > 1:
            assert len({class_of.get(p) for p in places}) == 1 and class_of.get(places[0])


def test_passages_of_a_pair_are_one_row_until_their_class_is_known(spark, tmp_path, monkeypatch):
    """Ten runs in each of three copies: the join with the first document's classes has a row for each pair."""
    runs = [[f"r{k}x{j}" for j in range(60)] for k in range(10)]
    rows = [(d, " ".join(w for k, r in enumerate(runs) for w in [*r, f"own{d}x{k}"])) for d in range(4)]
    written, cut = [], passages.cut_lineage

    def seen(df):
        written.append(cut(df))
        return written[-1]
    monkeypatch.setattr(passages, "cut_lineage", seen)
    found = passages.op8_passages(spark, folder(tmp_path, rows)).where("kind = 'passage'").collect()
    pairs, = [df.select("doc", "first_doc").collect() for df in written if "spans" in df.columns]
    assert len(set(pairs)) == len(pairs) < 30
    assert {(r.doc_id, r.start, r.end) for r in found} == {(d, 61 * k, 61 * k + 60) for d in range(4) for k in range(10)}
    assert len({r.class_id for r in found}) == 10


def _groups(group):
    members = defaultdict(list)
    for i, g in enumerate(group):
        members[g].append(i)
    return members.values()


@pytest.mark.parametrize("query", [token_counts.op1_token_counts, token_store.op5_token_ids, codec.op7_bpe,
                                   near_dups.op4_near_dups, passages.op8_passages])
def test_no_rows(spark, tmp_path, query):
    assert query(spark, folder(tmp_path, [])).collect() == []
