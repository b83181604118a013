"""Weights of one task against plain FTRL-proximal over a dictionary."""

import math

import numpy as np
import pyarrow as pa
import pytest

from kinfold.llm import toxicity
from tests.llm.conftest import SF


def plain_weights(rows, bits):
    """Follow-the-regularised-leader with a learning rate per coordinate, a row at a time."""
    z, n, bias = {}, {}, 1 << bits
    for text, label in rows:
        batch = pa.RecordBatch.from_pydict({"text": [text]})
        own = [*toxicity.features(batch, bits)[1].tolist(), bias]

        def weight(i):
            zi, ni = z.get(i, 0.0), n.get(i, 0.0)
            if i == bias:
                return -zi / ((toxicity.BETA + math.sqrt(ni)) / toxicity.ALPHA)
            if abs(zi) <= toxicity.L1:
                return 0.0
            rate = (toxicity.BETA + math.sqrt(ni)) / toxicity.ALPHA + toxicity.L2
            return -(zi - math.copysign(toxicity.L1, zi)) / rate

        w = {i: weight(i) for i in own}
        g = 1 / (1 + math.exp(-max(-35, min(35, sum(w.values()))))) - label
        for i in own:
            ni = n.get(i, 0.0)
            step = (math.sqrt(ni + g * g) - math.sqrt(ni)) / toxicity.ALPHA
            z[i] = z.get(i, 0.0) + g - step * w[i]
            n[i] = ni + g * g
    return {i: weight(i) for i in z if i != bias and weight(i)}, weight(bias)


def test_one_task_gives_the_weights_of_plain_ftrl(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "PARTS", 1)
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity._training_rows(docs, labels, 10_000).collect()
    assert len(rows) > 50
    model = toxicity.fit(docs, labels, bits=16, rounds=1)
    want, bias = plain_weights([(r.text, r.toxic) for r in rows], 16)
    got = dict(zip(model.index.tolist(), model.weight.tolist(), strict=True))
    near = [i for i in want.keys() ^ got.keys()]
    assert all(abs(want.get(i, got.get(i))) < 1e-4 for i in near) and len(want) > 20
    assert np.allclose([got.get(i, 0) for i in want], list(want.values()), atol=1e-4)
    assert model.bias == pytest.approx(bias, abs=1e-4)


def test_no_labels_and_no_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs.where("false"), labels)
    assert not len(model.index) and toxicity.score_texts(docs.where("false"), model).count() == 0
