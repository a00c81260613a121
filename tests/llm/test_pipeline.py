"""The stages of corpus_pipeline.py against brute force, each on what its predecessor kept."""

import corpus_pipeline as m
from tidemark.llm.common import stash
from tidemark.llm.quality import score_quality

from . import test_decontaminate, test_jaccard_join, test_line_dedup

DIR = "/root/testdata/sf0.001"


def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    labels = spark.read.parquet(f"{DIR}/labels.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
    rejected = {r.doc_id for r in score_quality(docs, labels).where("predicted = 0").collect()}
    want = {r.doc_id: r.text for r in docs.collect() if r.doc_id not in rejected}
    steps = dict(m.STAGES)
    for name in list(steps)[:-1]:
        docs = stash(steps[name](spark, docs, DIR), name)
        rows = docs.collect()
        if name == "line_dedup":
            want = {d: t for d, n, gone, t in test_line_dedup.brute(list(want.items())) if gone < n}
            assert all(r.n_chars == len(r.text or "") for r in rows)
        elif name == "near_duplicates":
            want = {d: want[d] for d, _, c in test_jaccard_join.brute(list(want.items()), 5, 80, 100) if c == d}
        elif name == "decontamination":
            leaks = {d for d, *_ in test_decontaminate.brute(list(want.items()), items)}
            want = {d: t for d, t in want.items() if d not in leaks}
        assert {r.doc_id: r.text or "" for r in rows} == {d: t or "" for d, t in want.items()}, name
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    pieces = steps["packing"](spark, docs, DIR).collect()
    assert {p.doc_id for p in pieces} == set(want)
    assert sum(p.length for p in pieces) == sum({p.doc_id: p.doc_tokens for p in pieces}.values())


def test_odd_rows_and_empty_tables(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, th string, word string"
    rows = [(None, "a b", "x", "y", 3, "t", "w"), (1, None, None, None, None, None, None), (1, "", "x", "y", 0, "t", "w"), (2, "q " * 9000, "x", "y", 1, "t", "w")]
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        n = docs.count()
        for name, stage in m.STAGES[1:]:
            docs = stash(stage(spark, docs, DIR), name)
        assert (docs.count() > 0) == (n > 0)


def test_quality_stage_on_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, x string, label string, predicted int, text_hash string"
    rows = [(None, "a b", "x", "y", 3, "t", "w", 0, "h"), (1, None, None, None, None, None, None, None, None), (1, "", "x", "y", 0, "t", "w", 0, "h"), (2, "the words of a sentence are here. " * 40, "x", "y", 1, "t", "w", 0, "h")]
    rows.append(rows[-1])
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        out = dict(m.STAGES)["quality"](spark, docs, DIR)
        assert out.columns == docs.columns
        want = {(r.doc_id, r.text_hash) for r in score_quality(docs, spark.read.parquet(f"{DIR}/labels.parquet")).where("predicted = 1").collect()}
        kept = out.selectExpr("doc_id", "xxhash64(text) as h").collect()
        assert {tuple(r) for r in kept} == want and (not want or len(kept) >= len(want))
