"""Alignment of two tokenizers' tokens against the tokenizers themselves and plain loops."""

import hashlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from kinfold.llm import alignment
from kinfold.llm.queries import QUERIES, op12_cross_tokenizer_alignment, tokenizer_file
from kinfold.llm.tokens import _byte_letters
from tests.llm.conftest import SF

PATHS = tokenizer_file(), tokenizer_file("piece_bpe_32k.model")
ODD = [
    None,
    "",
    " ",
    "  two  spaces   and\t\ttabs \n\n lines",
    "<|endoftext|> and <s> </s> <unk> <0x41> are text",
    "▁the mark itself",
    "naïve🙂don't 語のテスト é à ß  x​",
    "nul \x00 and \x7f \x85",
    "a" * 3000,
    "語" * 700,
    "ends in space ",
    "ﬁ ligature Å and Å",
    "one",
    "one",
]


@pytest.fixture(scope="module")
def plain():
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    byte = _byte_letters()
    byte_of = {i: bytes(byte[c] for c in t) for t, i in a.get_vocab(with_added_tokens=False).items() if all(c in byte for c in t)}
    b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])

    def bytes_b(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    def ends(tokens):
        return np.cumsum([len(t) for t in tokens]).tolist()

    def one(text):
        want = f" {text}".encode()
        left = a.encode(f" {text}", add_special_tokens=False).ids if text else []
        right = b.encode(text) if text else []
        spelt = [byte_of[i] for i in left], [bytes_b(i) for i in right]
        if not text or any(b"".join(s) != want for s in spelt):
            return [], []
        ends_a, ends_b = map(ends, spelt)
        cuts = sorted(set(ends_a) & set(ends_b))
        groups, i, j = [], 0, 0
        for cut in cuts:
            i1, j1 = ends_a.index(cut, i) + 1, ends_b.index(cut, j) + 1
            groups.append((left[i:i1], right[j:j1]))
            i, j = i1, j1
        return groups, [Counter((x, y) for p, q in groups for x in p for y in q)]

    def many(texts):
        found = [one(t) for t in texts]
        count = Counter(p for _, links in found for c in links for p in c)
        most = Counter()
        for (x, _), n in count.items():
            most[x] = max(most[x], n)
        out = []
        for groups, links in found:
            name = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
            all_links = [(p, n) for c in links for p, n in c.items()]
            out.append((
                sum(len(p) for p, _ in groups),
                sum(len(q) for _, q in groups),
                len(groups),
                sum(n for _, n in all_links),
                sum(n for p, n in all_links if count[p] == most[p[0]]),
                sum(n * count[p] for p, n in all_links),
                name,
            ))
        return out

    return many


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


@pytest.mark.parametrize("chunk", [32 << 20, 500])
def test_alignment_equals_plain_loops(spark, corpus, plain, monkeypatch, chunk):
    monkeypatch.setattr(alignment, "CHUNK", chunk)
    texts = [*corpus.values(), *ODD]
    rows = [(i, t, -1, "x") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_a int, lang string").repartition(3)
    got = {r.doc_id: r for r in alignment.with_pair_counts(alignment.align(df, *PATHS)).collect()}
    for i, want in enumerate(plain(texts)):
        r = got[i]
        assert tuple(r[c] for c in COLUMNS) == want[:6], texts[i]
        assert r.groups == want[6] and r.lang == "x"
    assert sum(r.n_a > 0 for r in got.values()) > 80


def test_alignments_are_one_row_per_document(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    rows = alignment.alignments(df, *PATHS).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(ODD)))


def test_no_rows(spark):
    df = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert alignment.with_pair_counts(alignment.align(df.where("false"), *PATHS)).count() == 0
    rows = alignment.with_pair_counts(alignment.align(df, *PATHS)).collect()
    assert [tuple(r[c] for c in COLUMNS) for r in rows] == [(0,) * 6] * 2


def test_windows_with_one_hash_are_told_apart(monkeypatch):
    both = alignment.tokenizers(*PATHS)
    texts = ["the cat sat on the mat", "a dog", "the cat"]
    want = alignment.align_texts(texts, both)
    monkeypatch.setattr(alignment.wd, "run_hashes", lambda ids, first, after: np.zeros(len(first), np.uint64))
    got = alignment.align_texts(texts, both)
    assert got.groups == want.groups and got.n_links.tolist() == want.n_links.tolist()


def test_packed_numbers_come_back():
    numbers, times = np.array([70_000, 3, 5]), np.array([1, 300, 2])
    at, often = alignment.unpack(alignment.pack(numbers, times))
    assert at.tolist() == [3, 5, 70_000] and often.tolist() == [300, 2, 1]


def test_query(spark, plain):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in op12_cross_tokenizer_alignment(spark, SF).collect()}
    assert len(got) == len(docs)
    for d, want in zip(docs, plain([d.text for d in docs]), strict=True):
        r = got[d.doc_id]
        assert tuple(r[c] for c in COLUMNS) == want[:6]
        assert r.groups_sha256 == (hashlib.sha256(want[6].encode()).hexdigest() if want[0] else "")
    assert "op12_cross_tokenizer_alignment" in QUERIES
