import zlib

import numpy as np

from tidemark.llm import quality as m


def test_held_out_accuracy_and_odd_rows(spark, docs_of):
    d = "/root/testdata/sf0.01"
    out = {r.doc_id: r for r in m.op9_quality(spark, d).collect()}
    labels = spark.read.parquet(f"{d}/labels.parquet").collect()
    held = [r for r in labels if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert all(out[r.doc_id].held_out for r in held)
    right = [out[r.doc_id].predicted == r.quality for r in held]
    assert sum(right) / len(right) > 0.95
    docs = docs_of([(None, "x"), (1, None), (1, ""), (2, "z" * 500_000)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (1, None), (None, 1)], "doc_id long, quality int")
    rows = m.score_quality(docs, labels).collect()
    assert len(rows) == 4 and all(0 <= r.score <= 1 for r in rows)
    assert m.score_quality(docs_of([]), labels).count() == 0


def test_scores_ignore_labels_of_the_held_out_fold(spark, docs_of):
    rows = [(i, ("good words here. " * (i % 7 + 1)) if i % 2 else "| x " * (i % 5 + 3)) for i in range(80)]
    one = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, quality int")
    two = one.selectExpr("doc_id", "case when crc32(cast(doc_id as string)) % 4 = 2 then 1 - quality else quality end as quality")
    score = lambda y: {r.doc_id: round(r.score, 9) for r in m.score_quality(docs_of(rows), y).collect()}
    assert score(one) == score(two)


def test_scores_equal_a_direct_discriminant(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    y = {r.doc_id: r.quality for r in labels.collect()}
    rows = docs.collect()
    x = np.array([m.statistics(r.text) for r in rows])
    train = [i for i, r in enumerate(rows) if r.doc_id in y and zlib.crc32(str(r.doc_id).encode()) % 4 != 2]
    label = np.array([y[rows[i].doc_id] for i in train])
    groups = [x[[i for i, c in zip(train, label, strict=True) if c == k]] for k in (0, 1)]
    n = np.array([len(g) for g in groups])
    cov = [np.cov(g.T, bias=True) for g in groups]
    pooled = (n[0] * cov[0] + n[1] * cov[1]) / n.sum()
    logs = []
    for k in (0, 1):
        c = 0.9 * cov[k] + 0.05 * pooled + 0.05 * np.diag(np.diag(pooled) + 1e-6)
        z = x - groups[k].mean(0)
        logs.append(np.log(n[k] / n.sum()) - 0.5 * np.linalg.slogdet(c)[1] - 0.5 * np.einsum("ij,jk,ik->i", z, np.linalg.inv(c), z))
    want = 1 / (1 + np.exp(-np.clip(logs[1] - logs[0], -40, 40)))
    got = {(r.doc_id, r.text_hash): r for r in m.score_quality(docs, labels).collect()}
    assert len(got) == len(rows)
    for r, s in zip(docs.selectExpr("doc_id", "xxhash64(text) as h").collect(), want, strict=True):
        out = got[r.doc_id, r.h]
        assert abs(out.score - s) < 1e-6 and (out.predicted == int(s >= 0.7) or abs(s - 0.7) < 1e-6)


def test_columns_of_clashing_names(spark):
    rows = [(i, "good words here. " * (i % 7 + 1) if i % 2 else "| x " * (i % 5 + 3), 1.5, 2, "h", 7) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, x double, label long, text_hash string, quality int")
    labels = spark.createDataFrame([(i, i % 2, "t", 0.5) for i in range(40)], "doc_id long, quality int, text string, x double")
    out = m.score_quality(docs, labels)
    assert out.columns == ["doc_id", "held_out", "score", "predicted", "text_hash"] and out.count() == 40
