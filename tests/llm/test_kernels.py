"""The array kernels against brute force; no Spark."""

import collections
import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest

from eventlens.llm import bag_minhash, near_dups, passages, pieces, shingles, token_counts, token_store, warc

P = pytest.importorskip("public_tokenizers")
ODD = ["", " ", "  a  b", "a \n b\n\n c", "x<|endoftext|> y <|endoftext|>z", "\x1c a\x85 b　 c", "a  ",
       "é è\xa0 b 12 3's don't  ...", "\n\n", "a\t b", "a" * 999, "ab" * 500 + "!!!!!" * 99, " " * 300]


def test_token_counts_are_the_librarys():
    from tokenizers import Tokenizer
    path = P.path("byte_bpe_50k.json")
    library, own = Tokenizer.from_file(path), token_counts.Counter(path)
    expected = [len(library.encode(t, add_special_tokens=False).ids) for t in ODD]
    assert own.table.ordered and own(ODD) == expected
    own.table.ordered = False
    own.memory.clear()
    assert own(ODD) == expected


def test_stored_ids_are_the_librarys():
    encoder = token_store.Encoder(P.path("byte_bpe_50k.json"))
    texts = ODD + ["　wide \u2003 é́ ñ", " lead", "nul\x00 \x1c z", "end<|endoftext|>, ab!? ab,c. it's I'LL", *ODD]
    for rows in (pa.array(texts), pa.array(["not this", *texts]).slice(1), pa.array(texts)):
        borders, ids = token_store.encode(rows, encoder, 2)
        for text, start, end in zip(texts, borders, borders[1:]):
            assert ids[start:end].tolist() == [*encoder.tokenizer.encode(text, add_special_tokens=False).ids, 2]
    borders, ids = token_store.encode(pa.array([], pa.string()), encoder, 2)
    assert borders.tolist() == [0] and not len(ids)


def test_cut_pieces_make_up_the_text():
    for text in ODD:
        assert " ".join(pieces.cut(text)) == text


def test_signatures_estimate_weighted_jaccard():
    rng, errors = np.random.default_rng(1), []
    for _ in range(40):
        a = rng.integers(0, 6, 30)
        b = np.maximum(a + rng.integers(-1, 2, 30), 0)
        value = shingles.mix(np.arange(30, dtype=np.uint64) + np.uint64(rng.integers(1 << 40)))
        owner = np.concatenate([np.zeros((a > 0).sum(), int), np.ones((b > 0).sum(), int)])
        both = bag_minhash.signatures(2, owner, np.concatenate([value[a > 0], value[b > 0]]),
                                      np.concatenate([a[a > 0], b[b > 0]]), 336)
        errors.append((both[0] == both[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(errors)) < 0.015


def test_overlaps_are_those_of_multisets():
    texts = ["a b c d e f a b c d e f", "a b c d e f", "a b c d e f a b c d e f a b", "z", "z", ""]
    owner, value, count = shingles.bags(*shingles.shingles(pa.array(texts)))
    bag = [(value[owner == i], count[owner == i]) for i in range(len(texts))]

    def counts(t):
        w = t.split()
        return collections.Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else collections.Counter()
    for i, x in enumerate(texts[:5]):
        for j, y in enumerate(texts[:5]):
            if i == j:      # pairs of different texts only
                continue
            common = sum((counts(x) & counts(y)).values())
            right = common / (sum(counts(x).values()) + sum(counts(y).values()) - common)
            assert shingles.overlap(bag[i], bag[j]) == right == near_dups.overlaps(bag[:5])[i, j]


def test_equal_windows_have_equal_keys():
    text = "One two. " + " ".join(f"w{i}" for i in range(40))
    owner, place, key = passages.windows_of(pa.array([text, "Other start here. " + text, "short"]), 32)
    assert set(key[owner == 0]) & set(key[owner == 1]) and 2 not in owner
    assert place[owner == 0].tolist() == [0, 2]


def test_equal_runs_share_a_window_wherever_they_begin():
    rng = np.random.default_rng(3)
    for _ in range(40):
        run = [f"r{i}" for i in rng.integers(0, 1000, 51)]
        texts = [" ".join([f"{side}{i}" for i in rng.integers(0, 1000, 70)] + run + [f"{side}x"] * 9) for side in "ab"]
        owner, place, key = passages.windows_of(pa.array([*texts, "short"]), 32, 20)
        assert set(key[owner == 0]) & set(key[owner == 1]) and 2 not in owner


def test_spans_are_maximal():
    rng = np.random.default_rng(5)
    for _ in range(60):
        a, b = rng.integers(0, 2, 60), rng.integers(0, 2, 50)
        a[20:40] = b[5:25] = rng.integers(0, 2, 20)
        anchors = [(x, y) for x in range(53) for y in range(43) if (a[x:x + 8] == b[y:y + 8]).all()]
        want = {(x, y) for x, y in anchors if not x or not y or a[x - 1] != b[y - 1]}
        found = passages.equal_spans(a, b, [*anchors, (0, 49)], 8)
        assert {(s, f) for s, _, f in found} == want and len(found) == len(want)
        for s, e, f in found:
            assert (a[s:e] == b[f:f + e - s]).all() and (e == 60 or f + e - s == 50 or a[e] != b[f + e - s])


def test_least_of_every_run_is_taken():
    rng = np.random.default_rng(4)
    for top in (1, 3, 1000):
        owner = np.repeat(np.arange(5), [1, 19, 20, 21, 90])
        keys = rng.integers(0, top, len(owner)).astype(np.uint64)
        taken = passages.least_of(keys, owner, 20)
        for o in range(5):
            at = np.flatnonzero(owner == o)
            for i in range(max(1, len(at) - 19)):
                reach = at[i:i + 20]
                assert any(keys[t] == keys[reach].min() for t in taken if t in reach)
        if top == 1:        # equal keys are not all taken
            assert len(taken) < 12


def test_taken_keys_are_those_of_the_plain_scan():
    rng = np.random.default_rng(6)
    for top in (2, 9, 10**9):
        owner = np.repeat([0, 2, 3, 7], rng.integers(1, 90, 4))
        keys = rng.integers(0, top, len(owner)).astype(np.uint64)
        assert passages.least_of(keys, owner, 20).tolist() == passages.last_of_least(keys, owner, 20).tolist()


def test_sentences_end_as_the_pattern_says():
    text = 'One two. three?") four) ) ." x.y end!\' "q" [a.] .) é. 東京。'
    found = passages.byte_words.Words(pa.array([text, "", "a.b c.'"]), passages._CLASSES, lower=False)
    words = [w for t in (text, "a.b c.'") for w in t.split()]
    assert passages.ends_sentence(found).tolist() == [bool(re.search(r"""[.!?]["')\]]*$""", w)) for w in words]


LINES = ["", "\n\n", "one two three four five", " a b\tc d\x0be \n\nx y z u v w\r\n é è ü 東京 ñ o ", "a b c d\nf g h i\n", None,
         "l" * 70 + " m n o p\n" + "l" * 69 + "k m n o p q" * 3 + "\n a a a a a a a a", "\nno end of a line here\x0cor here"]


def long_lines(least):
    return [(i, place, line, len(line.split())) for i, text in enumerate(LINES) for place, line in enumerate((text or "").split("\n"))
            if len(re.findall(r"[^\x20\x09-\x0D]+", line)) >= least]


@pytest.mark.parametrize("part", [1, 4 << 20])
def test_lines_are_found_on_the_bytes(monkeypatch, part):
    monkeypatch.setattr(passages.byte_words, "PART_BYTES", part)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(LINES))), pa.array(range(50, 50 + len(LINES))), pa.array(LINES)],
                                       ["id", "hash", "text"])
    for least in (5, 7):
        want = [(hashlib.md5(line.encode()).hexdigest(), i, 50 + i, place, n) for i, place, line, n in long_lines(least)]
        for some in (batch, batch.slice(2, 5)):
            kept = [w for w in want if w[1] in some.column("id").to_pylist()]
            got = pa.Table.from_batches(passages.line_rows(least)(iter([some])))
            assert [tuple(r.values()) for r in got.to_pylist()] == kept


def test_lines_are_signed_like_texts(monkeypatch):
    """The bands of a line are those of the line as a text, also where lines are signed a few at a time."""
    lines = [line for *_, line, _ in long_lines(5)]
    fp = [hashlib.md5(x.encode()).hexdigest() for x in lines]
    want = pa.Table.from_batches(near_dups.signing(5, 3, 8)(iter([pa.RecordBatch.from_arrays(
        [pa.array(fp), pa.array(lines)], ["fp", "text"])])))
    for at_a_time in (1, 3, 1024):
        monkeypatch.setattr(passages, "LINES_AT_A_TIME", at_a_time)
        got = pa.Table.from_batches(passages.signing_lines(5, 5, 3, 8)(iter([pa.RecordBatch.from_arrays([pa.array(LINES)], ["text"])])))
        assert got.to_pylist() == want.to_pylist() and got.num_rows == len(lines)


def test_words_are_hashed_one_by_one_only_for_signatures(monkeypatch):
    """Likeness and equal runs ask for equality only."""
    a, b = " ".join(f"w{i}" for i in range(60)), "x " + " ".join(f"w{i}" for i in range(60)) + " y"
    monkeypatch.setattr(shingles.xxhash, "xxh3_64_intdigest", None)
    pair = pa.RecordBatch.from_pylist([{"a": 1, "b": 2, "text_a": a, "text_b": b}, {"a": 1, "b": 3, "text_a": a, "text_b": "z"}])
    assert [x.to_pylist() for x in near_dups.verifying(5, 0.8)(iter([pair]))] == [[{"a": 1, "b": 2}]]
    rows = pa.Table.from_pylist([{"key": 1, "node": n, "component": n, "text": t} for n, t in ((1, a), (2, b), (3, "z"))])
    assert near_dups.comparing(5, 0.8)(rows).to_pylist() == [{"a": 1, "b": 2}]
    shifts = pa.RecordBatch.from_pylist([{"doc": 2, "first_doc": 1, "own": False, "text": b, "first_text": a,
                                          "shifts": [{"shift": 1, "lo": 1, "hi": 1}]}])
    found, = passages.extending(32)(iter([shifts]))
    assert found.to_pylist() == [{"doc": 2, "first_doc": 1, "spans": [{"start": 1, "end": 61, "first_start": 0}]}]


def test_bags_count_equal_values_of_an_owner():
    rng = np.random.default_rng(8)
    for owners in (3, 70_000):
        owner, value = np.sort(rng.integers(0, owners, 400)), rng.integers(0, 9, 400).astype(np.uint64)
        owner[-1] = owners - 1
        want = sorted(collections.Counter(zip(owner.tolist(), value.tolist())).items())
        assert [((o, v), n) for o, v, n in zip(*(x.tolist() for x in shingles.bags(owner, value)))] == want


def test_anchors_along_a_shift():
    rng = np.random.default_rng(7)
    for _ in range(60):
        a, b = rng.integers(0, 2, 90), rng.integers(0, 2, 80)
        a[10:30] = b[4:24]
        a[40:70] = b[34:64]
        lo, hi, shift, window = 12, 55, 6, 8
        got = passages.along(a, b, shift, lo, hi, window)
        same = [a[x] == b[x - shift] for x in range(lo, hi + window)]
        want = [lo + i for i in range(len(same) - window + 1) if all(same[i:i + window]) and (i == 0 or not same[i - 1])]
        assert [x for x, _ in got] == want and all(x - y == shift for x, y in got)


def test_warc_records_are_read_back_and_skipped():
    rows = [{c: None for c in warc.COLUMNS} | {"record_type": k, "record_id": f"<urn:page:{i}>", "payload": p,
                                               "payload_length": 12, "target_uri": "http://a/\r\nX: y"}
            for i, (k, p) in enumerate([("response", b"WARC/1.1\r\n\r\n"), ("revisit", None), ("response", b"x" * 200_000)])]
    for data in (b"".join(warc.member(warc.record_bytes(r), 1) for r in rows), b"".join(map(warc.record_bytes, rows))):
        window = warc.Window(pa.BufferReader(data), len(data))
        found = [dict(zip(warc.COLUMNS, r)) for r in warc.records(window, [], False)]
        assert [r["record_type"] for r in found] == ["response", "revisit", "response"]
        assert all(r["payload"] is None for r in found) and found[1]["payload_length"] == 12
        only = list(warc.records(window, [lambda r: r["record_type"] == "revisit"], True))
        assert len(only) == 1
