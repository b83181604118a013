"""Waves of nearest partners: few rows a wave, and in the end the components of brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest

from kinfold.llm import jaccard
from tests.llm import brute


def bucket(members: int, seed: int) -> tuple[pa.RecordBatch, np.ndarray]:
    rng = np.random.default_rng(seed)
    sketch = np.full((members, jaccard.BINS), 4, np.uint8)
    for row in sketch:
        row[rng.choice(jaccard.BINS, 20, replace=False)] += rng.integers(0, 4, 20).astype(np.uint8)
    columns = {
        "sig": np.repeat([5, 9], [members - 3, 3]),
        "sid": np.arange(members) * 7,
        "n": sketch.sum(axis=1).astype(np.int64),
        "component": np.arange(members) // 2,
        "_own": np.zeros(members, np.int32),
        "_i": np.zeros(members, np.int32),
        "_j": np.zeros(members, np.int32),
    }
    arrays = {c: pa.array(v) for c, v in columns.items()}
    arrays["sketch"] = pa.array([r.tobytes() for r in sketch], pa.binary())
    return pa.RecordBatch.from_pydict(arrays), sketch


@pytest.mark.parametrize("held", [50, 200_000])
@pytest.mark.parametrize("most", [1, 4, 1000])
def test_every_member_names_its_nearest(monkeypatch, held, most):
    monkeypatch.setattr(jaccard, "HELD_PAIRS", held)
    monkeypatch.setattr(jaccard, "PAIRS_AT_ONCE", 100)
    batch, sketch = bucket(60, 3)
    wide, size, want, more = sketch.astype(int), sketch.astype(int).sum(axis=1), set(), set()
    rows = range(60)
    for i in rows:
        near = []
        for j in rows:
            far, total = abs(wide[i] - wide[j]).sum(), size[i] + size[j]
            if (i < 57) == (j < 57) and i // 2 != j // 2 and far * 185 <= total * 15:
                near.append((far / total, j))
        near.sort()
        pairs = {(min(i, j) * 7, max(i, j) * 7) for _, j in near[:most]}
        want |= pairs
        more |= {i * 7} if len(near) > most else set()
    out = pa.Table.from_batches(list(jaccard._near_pairs(85, most)(iter([batch])))).to_pylist()
    assert len(out) <= 2 * 60 * most
    assert {(r["a"], r["b"]) for r in out} == want
    marked = {r["a"] for r in out if r["more_a"]} | {r["b"] for r in out if r["more_b"]}
    assert marked == more
    assert more if most < 5 else not more


def test_families_near_the_threshold(spark, monkeypatch):
    """Many variants of one text, of which some link and some only just do not."""
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", 20)
    draw = random.Random(11)
    base = [f"w{draw.randrange(10_000)}" for _ in range(120)]
    corpus = {}
    for i in range(90):
        words = list(base)
        for at in draw.sample(range(120), draw.choice([1, 2, 3, 4])):
            words[at] = f"v{draw.randrange(10_000)}"
        corpus[i] = " ".join(words)
    table = spark.createDataFrame(list(corpus.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar_documents(table).collect()}
    assert got == brute.jaccard(corpus)
    assert 1 < len({c for _, c in got.values()}) < 90
