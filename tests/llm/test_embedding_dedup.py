import math

import numpy as np

from tidemark.llm import embedding_dedup as m

from .test_jaccard_join import groups


def brute(rows, cosine=0.9):
    ok = {r: (u := np.array(v) / np.abs(v).max()) / np.linalg.norm(u) for r, (_, v) in enumerate(rows) if v and None not in v and np.isfinite(v).all() and np.abs(v).max() > 0}
    links = {r: [s for s, y in ok.items() if s != r and len(x) == len(y) and x @ y >= cosine] for r, x in ok.items()}
    root = groups([(r, s) for r in links for s in links[r]], range(len(rows)))
    least = {}
    for r, (i, _) in enumerate(rows):
        if i is not None:
            least[root[r]] = min(i, least.get(root[r], i))
    return sorted(((i, len(links.get(r, ())), least.get(root[r]) if r in ok else i) for r, (i, _) in enumerate(rows)), key=str)


def test_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(30, 12))
    rows = [(i, rng.normal(size=12).tolist()) for i in range(150)]
    rows += [(200 + i, (base[i % 30] + rng.normal(size=12) * rng.choice([0, 0.02, 0.15, 0.35])).tolist()) for i in range(500)]
    rows += [(900 + i, (base[0] + rng.normal(size=12) * 0.02).tolist()) for i in range(200)]
    rows += [(i, rows[i - 4000][1]) for i in range(4000, 4040)]
    rows += [(5000, None), (5001, []), (5002, [0.0] * 12), (5003, [1.0, None]), (5004, [math.inf] * 12), (5005, [math.nan] * 12), (None, rows[3][1]), (5, rows[9][1])]
    rows += [(6000, [1.0, 2.0]), (6001, [2.0, 4.0]), (6002, [3e300, 6e300])]
    t = spark.createDataFrame([(*r, 1, 1) for r in rows], "vec_id long, embedding array<double>, cid int, k int")
    for block in (64, 4096):
        got = m.near_vectors(t, block=block).collect()
        assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str) == brute(rows)
        assert all(r.kept == (r.vec_id == r.component_id) for r in got if r.vec_id is not None)


def test_whole_table_and_empty(spark):
    t = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    got = m.op1_embedding_dedup(spark, "/root/testdata/sf0.01").collect()
    want = brute([(r.vec_id, [float(v) for v in r.embedding]) for r in t.collect()])
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str) == want
    assert m.near_vectors(t.limit(0)).count() == 0
