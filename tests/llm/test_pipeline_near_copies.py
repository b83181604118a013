from pathlib import Path

import corpus_pipeline
from kinfold.session import scratch_root
from tests.llm.conftest import SF


def _docs(spark, rows):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
    return spark.createDataFrame(full, schema)


def _kept(spark, rows):
    got = corpus_pipeline.drop_near_copies(spark, _docs(spark, rows), "").collect()
    assert [len(r) for r in got] == [len(corpus_pipeline.COLUMNS)] * len(got)
    return sorted(((r.doc_id, r.text) for r in got), key=repr)


def _words(start, n):
    return " ".join(f"w{i}" for i in range(start, start + n))


def test_near_copies_are_four_fifths_of_five_words(spark):
    """104 words have 100 shingles: a copy with 24 more shares 100 of 124, one with 26 100 of 126."""
    base, other = _words(0, 104), _words(1000, 104)
    rows = [(1, base), (2, base + " " + _words(500, 24)), (3, other), (4, other + " " + _words(2000, 26))]
    assert _kept(spark, rows) == [(1, rows[0][1]), (3, rows[2][1]), (4, rows[3][1])]


def test_one_row_of_a_group_stays_whatever_the_ids(spark):
    a, b, c = _words(0, 104), _words(1000, 104), _words(3000, 104)
    group = [(1, a), (1, a), (None, a), (2, a), (2, a + " x"), (1, a + " y")]
    kept = _kept(spark, [*group, (1, b), (None, c), (None, c + " z"), (5, None), (5, None), (None, "")])
    assert len(kept) == 6 and {t for _, t in kept} >= {b, None, ""}
    assert sum(t is None for _, t in kept) == 2
    own = [(i, t) for i, t in kept if t and t.startswith(a)]
    assert len(own) == 1 and own[0][0] == 1 and own[0][1] in (a, a + " y")
    assert sum(bool(t) and t.startswith(c) for _, t in kept) == 1


def test_stages_on_empty_tables(spark, tmp_path):
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    docs = _docs(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, str(tmp_path)).count() == 0


def test_scratch_of_a_stage_goes_when_the_next_one_is_written(spark):
    root = Path(scratch_root(spark).removeprefix("file:"))
    there = {p.name for p in root.iterdir()}
    tables = {t.name for t in spark.catalog.listTables()}
    corpus_pipeline.run(spark, SF).count()
    left = {p.name.rsplit("-", 1)[0] for p in root.iterdir() if p.name not in there}
    assert not left & {"toxicity", "line_dedup", "ngram_jaccard", "similar", "copies", "sets", "buckets"}
    assert {t.name for t in spark.catalog.listTables()} <= tables | {t for t in left if t.startswith("scratch_")}
