import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kinfold.llm import decontaminate as dc
from kinfold.llm import jaccard, line_dedup, repeats
from kinfold.llm import words as wd
from tests.llm import brute
from tests.llm.conftest import PASSAGE

TEXT = st.text(alphabet="aB1é語 \t\n\x1c .-", max_size=30)


@settings(max_examples=100, deadline=None)
@given(st.lists(TEXT | st.none(), max_size=6))
def test_words_equal_patterns(texts):
    data, offsets = wd.text_bytes(pa.array(texts, pa.string()))
    for kind, pattern, lower in ((wd.SPACED, brute.SPACED, False), (wd.ALPHANUMERIC, brute.ALNUM, True)):
        found = wd.split_words(data, offsets, kind, lower)
        fold = brute.lower if lower else str
        got = [(r, fold(data[a:b].tobytes().decode())) for r, a, b, _ in zip(*found, strict=True)]
        want = [(r, w) for r, t in enumerate(texts) for w in pattern.findall(fold(t or ""))]
        assert got == want
        words = [w for _, w in want]
        assert len(set(found.hash.tolist())) == len(set(words))


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=30), st.integers(1, 8))
def test_lowest_is_the_leftmost_minimum(values, width):
    got = wd.lowest(np.array(values, np.uint64), width).tolist()
    runs = [values[i : i + width] for i in range(len(values) - width + 1)]
    assert got == [i + r.index(min(r)) for i, r in enumerate(runs)]


def test_lines(table, corpus):
    got = line_dedup.dedup_lines(table)
    kept = line_dedup.kept_text(F.col("text"), F.col("keep_bitmap")).alias("kept")
    rows = got.select("doc_id", "n_lines", "n_dropped", F.coalesce(kept, F.lit("")).alias("kept"))
    assert {r[0]: tuple(r)[1:] for r in rows.collect()} == brute.lines(corpus)


def test_lines_of_one_hash_over_many_ranges(spark):
    """A hot line is split over ranges; counts and keeper still hold."""
    line = "x" * 50
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.lit(f"{line}\n{line}").alias("text"))
    dropped = {r.doc_id: r.n_dropped for r in line_dedup.dedup_lines(docs).collect()}
    assert dropped == {i: 0 if i == 399 else 2 for i in range(400)}


def test_lines_repeated_and_null_ids(spark):
    line = "y" * 50
    rows = [(i, line) for i in range(4)] + [(3, line), (None, line)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.n_dropped for r in line_dedup.dedup_lines(docs).collect()} == {0}  # 4 documents only


def test_jaccard(table, corpus):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar_documents(table).collect()}
    assert got == brute.jaccard(corpus)


@pytest.mark.parametrize("percent", [60, 85])
def test_signatures_lose_no_pair(percent):
    """Similar sets of all sizes share a signature, also those with empty sub-partitions."""
    rng = np.random.default_rng(percent)
    for size in [*range(1, 60), 150, 700]:
        a = wd.distinct(rng.integers(0, 1 << 62, size).astype(np.uint64))
        most = int(len(a) * (100 - percent) / 100)
        b = np.sort(np.concatenate([a[most:], rng.integers(0, 1 << 62, 0).astype(np.uint64)]))
        if not len(b) or 100 * len(b) < percent * len(a):
            continue
        row = np.r_[np.zeros(len(a), int), np.ones(len(b), int)]
        rows, sign = jaccard.signatures(row, np.r_[a, b], 2, percent)
        if len(a) != len(b):
            assert set(sign[rows == 0].tolist()) & set(sign[rows == 1].tolist()), size


@pytest.mark.parametrize("window", [1, 3, 7, 35])
def test_repeats(table, corpus, window):
    got = {r.id: (r.n_removed, r.kept) for r in repeats.remove_repeats(table, window).collect()}
    words = {r.doc_id: (r.n_words, r.plain) for r in repeats.plain_words(table).collect()}
    for i, (n, removed, kept) in brute.repeats(corpus, window).items():
        assert words[i][0] == n
        assert got.get(i, (0, words[i][1])) == (removed, kept)


def test_repeats_of_repeated_rows(spark):
    text = " ".join(f"w{i}" for i in range(50))
    docs = spark.createDataFrame([(None, text), (None, text)], "doc_id long, text string")
    assert [r.n_removed for r in repeats.remove_repeats(docs).collect()] == [50]


@pytest.mark.parametrize("block_bytes", [dc.BLOCK_BYTES, 200])
def test_leaks(spark, table, corpus, block_bytes):
    items = [(1, PASSAGE), (12, PASSAGE + " and more"), (3, "one"), (4, ""), (5, None), (None, "eta5 x")]
    items += [(100 + i, f"filler number {i} that occurs nowhere at all") for i in range(20)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = dc.decontaminate(table, benchmark, block_bytes=block_bytes)
    want = brute.leaks(corpus, items)
    rows = got.collect()
    named = {i: (n, h, [x for x in f if x is not None]) for i, (n, h, f) in want.items()}
    assert {r.doc_id: (r.n_words, r.n_hit, sorted(r["items"])) for r in rows} == named
    for r in rows:  # nothing is left of what was hit, and the rest is whole
        left = brute.ALNUM.findall(brute.lower(r.clean or ""))
        assert r.n_hit or r.clean == r.text
        assert len(left) <= r.n_words - r.n_hit + 1


def test_empty_tables(no_rows, spark):
    empty = spark.createDataFrame([], "item_id long, text string")
    assert line_dedup.dedup_lines(no_rows).count() == 0
    assert jaccard.similar_documents(no_rows).count() == 0
    assert repeats.remove_repeats(no_rows).count() == 0
    assert dc.decontaminate(no_rows, empty).count() == 0
