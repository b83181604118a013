"""Sharding and packing move whole rows, whatever their columns are called, at any size."""

import zlib

import numpy as np

from kinfold.llm import packing, queries, sharding


def test_large_populations_are_drawn_by_their_law():
    rng = np.random.default_rng(4)
    good, bad, sample = 1_500_000_000, 4_500_000_000, 100_000
    drawn = np.array([sharding.draw_hypergeometric(rng, good, bad, sample) for _ in range(3000)])
    spread = (sample * 0.25 * 0.75 * (good + bad - sample) / (good + bad - 1)) ** 0.5
    assert abs(drawn.mean() - sample * 0.25) < 5 * spread / 3000**0.5
    assert abs(drawn.std() / spread - 1) < 0.08


def test_inversion_agrees_with_the_small_sampler(monkeypatch):
    small = np.random.default_rng(1).hypergeometric(40, 60, 30, 40_000)
    monkeypatch.setattr(sharding, "_SAMPLER_LIMIT", 1)
    rng = np.random.default_rng(2)
    drawn = [sharding.draw_hypergeometric(rng, 40, 60, 30) for _ in range(40_000)]
    parts = [np.bincount(x, minlength=31) / 40_000 for x in (small, drawn)]
    assert abs(parts[0] - parts[1]).max() < 0.012
    assert {sharding.draw_hypergeometric(rng, 5, 0, 5), sharding.draw_hypergeometric(rng, 5, 7, 12)} == {5}


def test_matrix_of_a_hundred_billion_rows():
    counts = [50_000_000_000, 1, 0, *[1_000_000_000] * 50]
    rows = sum(counts)
    sizes = sharding.shard_sizes(rows, 8)
    matrix = sharding.communication_matrix(counts, sizes, 3)
    assert [sum(row) for row in matrix] == counts
    assert [sum(column) for column in zip(*matrix, strict=True)] == sizes
    assert min(min(row) for row in matrix) >= 0
    assert max(abs(n - 1_000_000_000 / 8) for row in matrix[3:] for n in row) < 10 * 11_000


def test_clashing_columns_come_back(spark):
    names = ["id", "_id", "_rank", "_to", "_from", "_p", "_row", "_part", "_key", "inputs", "a.b"]
    rows = [tuple(100 * i + j for j in range(len(names))) for i in range(40)]
    table = spark.createDataFrame(rows, ", ".join(f"`{n}` long" for n in names))
    dealt = sharding.shard_rows(table)
    assert dealt.columns == [*names, "shard", "slot"]
    assert sorted(tuple(r)[: len(names)] for r in dealt.collect()) == rows
    packed = packing.pack(table.selectExpr("*", "cast(`_p` % 500 + 1 as long) AS length"))
    assert packed.columns == [*names, "length", "sequence_id", "offset"]
    assert sorted(tuple(r)[: len(names)] for r in packed.collect()) == rows


def test_queries_take_digests_from_whole_rows(spark, tmp_path):
    texts = ["alpha beta", None, "", "é ü", "word " * 3000, "alpha beta"]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    table.write.parquet(f"{tmp_path}/documents.parquet")
    want = {}
    for i, text in enumerate(texts):
        data = (text or "").encode()
        want[i] = (len(data) + 1, zlib.crc32(data), "rows")
    got = queries.op10_sharding(spark, str(tmp_path)).collect()
    assert {r.doc_id: (r.size, r.text_crc32, r.law) for r in got} == want
    assert len({(r.shard, r.slot) for r in got}) == len(texts)

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_file())
    pieces = queries.op2_best_fit_packing(spark, str(tmp_path)).collect()
    for i, text in enumerate(texts):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        own = sorted((r for r in pieces if r.doc_id == i), key=lambda r: r.piece)
        assert sum(r.length for r in own) == len(ids)
        for r in own:
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
            assert r.offset + r.length <= 1024
