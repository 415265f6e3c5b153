"""Alignment of tokens against the libraries on whole texts and plain counting."""

from collections import Counter
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest

from eventlens.llm import alignment

FIRST, SECOND = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["The cat sat. The cat ran.", "The cat sat. The cat ran.", None, "", " ", "  two  blanks\n\n and\ttabs ", "x▁y and z", "naïve Straße 東京タワー 🙂🙂 done",
         "<|endoftext|> <s> <unk> <0x41>", "a" * 3000, "-" * 997 + " " * 83 + "=" * 211, "é  nbsp　wide", "word " * 900, "nul\x00byte",
         "don't they're I'LL", "1234567 89.5 %"]


def brute(texts):
    """Contract's columns of each text, by the libraries and plain loops."""
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(FIRST)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=SECOND)
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte = {chr(c): c for c in shown} | {chr(0x100 + i): c for i, c in enumerate(c for c in range(256) if c not in shown)}
    rows = []
    for text in texts:
        groups = []
        if text:
            ids_a = a.encode(" " + text, add_special_tokens=False).ids
            ids_b = b.encode(text)
            bytes_a = [bytes(byte[c] for c in a.id_to_token(i)) for i in ids_a]
            bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
            if b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
                ends = set(np.cumsum([len(x) for x in bytes_a])) & set(np.cumsum([len(x) for x in bytes_b]))
                cut = {e: n for n, e in enumerate(sorted(ends))}
                groups = [([], []) for _ in cut]
                for side, ids, data in ((0, ids_a, bytes_a), (1, ids_b, bytes_b)):
                    n = at = 0
                    for i, x in zip(ids, data):
                        groups[n][side].append(i)
                        at += len(x)
                        n = cut[at] + 1 if at in cut else n
        rows.append(groups)
    links = [Counter((x, y) for g in groups for x in g[0] for y in g[1]) for groups in rows]
    held = Counter(p for c in links for p in c)
    most = {}
    for (x, _), n in held.items():
        most[x] = max(n, most.get(x, 0))
    out = []
    for groups, c in zip(rows, links):
        text = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in groups)
        out.append((sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), sum(c.values()),
                    sum(n for p, n in c.items() if held[p] == most[p[0]]), sum(n * held[p] for p, n in c.items()),
                    sha256(text.encode()).hexdigest() if groups else ""))
    return out


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("most", [alignment.PAIRS, 0])
def test_odd_texts_equal_brute_force(spark, most):
    rows = [(None if i == 3 else i, t, 7, "p") for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_a int, pair string")
    aligned = alignment.align(docs, FIRST, SECOND)
    found = alignment.weighed(aligned, alignment.pair_counts(aligned, alignment.entries(SECOND)), most).collect()
    want = Counter((r[0], *b) for r, b in zip(rows, brute(TEXTS)))
    assert Counter((r.doc_id, *(r[c] for c in COLUMNS)) for r in found) == want


def test_query_equals_brute_force(spark):
    import pyarrow.parquet as pq
    from tests.conftest import SF
    from eventlens.llm.queries import queries
    table = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    want = Counter((r["doc_id"], *b) for r, b in zip(table, brute([r["text"] for r in table])))
    found = queries()["op11_alignment"](spark, SF).collect()
    assert Counter((r.doc_id, *(r[c] for c in COLUMNS)) for r in found) == want


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    aligned = alignment.align(docs, FIRST, SECOND)
    assert alignment.weighed(aligned, alignment.pair_counts(aligned, 32000)).collect() == []


def test_overlap_links_count_shared_bytes(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    align = alignment.aligner(FIRST, SECOND)
    for row in alignment.token_links(docs, FIRST, SECOND).collect():
        owner_a = np.repeat(np.arange(len(row.a_ids)), align.bytes_a.length[row.a_ids]) if row.a_ids else []
        owner_b = np.repeat(np.arange(len(row.b_ids)), align.bytes_b.length[row.b_ids]) if row.b_ids else []
        assert {(x.a, x.b): x.bytes for x in row.links} == Counter(zip(map(int, owner_a), map(int, owner_b)))
        for link in row.links:      # overlapping tokens share a group
            assert row.a_groups[link.a] == row.b_groups[link.b]


def test_product_by_rows():
    rng = np.random.default_rng(3)
    for _ in range(30):
        left, right = rng.integers(0, 3, (4, 6)) * (rng.random((4, 6)) < .4), rng.integers(0, 3, (6, 5)) * (rng.random((6, 5)) < .4)

        def sparse(m):
            r, c = np.nonzero(m)
            return np.searchsorted(r, np.arange(len(m) + 1)), c, m[r, c]
        borders, column, value = alignment.product(sparse(left), sparse(right), 5)
        dense = np.zeros((4, 5), int)
        dense[np.repeat(np.arange(4), np.diff(borders)), column] = value
        assert (dense == left @ right).all()
