"""Which signatures, buckets and whole sets the Jaccard join looks at; none that a link needs is left out."""

import random
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
import pytest

from kinfold.llm import jaccard
from kinfold.llm import words as wd
from kinfold.session import scratch_root
from tests.llm import brute


@pytest.mark.parametrize("percent", [60, 80, 85])
def test_similar_sets_share_as_many_signatures_as_they_need(percent):
    rng = np.random.default_rng(percent)
    for size in [*range(2, 60), 150, 151, 700, 2000]:
        a = wd.distinct(rng.integers(0, 1 << 62, size).astype(np.uint64))
        for share in (0.3, 0.9, 1):  # of the differences that a link allows
            gone = int(share * size * (100 - percent) / (100 + percent))
            new = rng.integers(0, 1 << 62, gone).astype(np.uint64)
            b = np.sort(np.concatenate([rng.permutation(a)[gone:], new]))
            both = len(np.intersect1d(a, b))
            if not gone or 100 * both < percent * (len(a) + len(b) - both):
                continue
            row = np.r_[np.zeros(len(a), int), np.ones(len(b), int)]
            rows, sign, need = jaccard._signed(row, np.r_[a, b], 2, percent)
            shared = defaultdict(set)
            for side in (0, 1):
                for other in np.unique(need[rows == side]):
                    shared[side, other > 0] |= set(sign[(rows == side) & (need == other)].tolist())
            assert len(shared[0, True] & shared[1, True]) >= need.max() >= 1, (size, share)
    assert percent < 85 or need.max() > 3


@pytest.mark.parametrize("large", [3, 10_000])
@pytest.mark.parametrize("rows", [1, 2, 7, 1000])
def test_buckets_of_two_and_more(monkeypatch, large, rows):
    monkeypatch.setattr(jaccard, "LARGE", large)
    rng = random.Random(rows)
    pairs = sorted((rng.randrange(12), rng.randrange(9)) for _ in range(70))
    pairs = sorted([*pairs, (40, 1), (41, 5), (41, 5), (50, 2), (50, 3)])
    batches = [
        pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in zip(*[(s, m, s + 1) for s, m in pairs[i : i + rows]])],
            names=["sig", "sid", "need"],
        )
        for i in range(0, len(pairs), rows)
    ]
    got = pa.Table.from_batches(list(jaccard._buckets(iter(batches)))).to_pylist()
    size = Counter(s for s, _ in set(pairs))
    want = {(s, m, s + 1, min(size[s], large)) for s, m in pairs if size[s] > 1}
    assert {tuple(r.values()) for r in got} == want and len(got) == len(want)


def test_sets_leave_their_largest_buckets(spark):
    rows = [(1, 5, 3, 9), (2, 5, 3, 2), (3, 5, 3, 9), (3, 5, -2, 7), (4, 5, -2, 7), (8, 6, 2, 4), (8, 7, 1, 4)]
    members = spark.createDataFrame(rows, "sig long, sid long, need int, size long")
    got = sorted((r.sid, r.sig) for r in jaccard._telling(members).collect())
    assert got == [(5, 2), (5, 4), (7, 8)]


def test_only_likely_pairs_get_whole_sets(spark, monkeypatch):
    """A passage that many texts share brings them into buckets together, but none is similar to another."""
    draw = random.Random(3)
    passage = " ".join(f"p{i}" for i in range(60))
    text = lambda: " ".join(f"w{draw.randrange(10**6)}" for _ in range(60))
    corpus = {i: f"{text()} {passage} {text()}" for i in range(80)}
    near = text() + " " + text()
    corpus |= {100: near, 101: near + " one more", 102: near.upper(), 103: None}
    root = Path(scratch_root(spark).removeprefix("file:"))
    there = set(root.iterdir())
    table = spark.createDataFrame(list(corpus.items()), "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar_documents(table).collect()}
    assert got == brute.jaccard(corpus)
    made = [ds.dataset(p) for p in set(root.iterdir()) - there if list(p.glob("*.parquet"))]
    assert 2 <= sum(d.count_rows() for d in made if "shingles" in d.schema.names) <= 4
