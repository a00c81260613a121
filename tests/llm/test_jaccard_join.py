import os
import random
import subprocess
import sys
from collections import defaultdict

import numpy as np
import pytest

from tidemark.llm import jaccard_join as m
from tidemark.llm.common import components


def grams(text, k):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def groups(edges, ids):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def brute(rows, k, num, den):
    sets = [(d, grams(t, k)) for d, t in rows]
    holders = defaultdict(list)
    for r, (d, s) in enumerate(sets):
        for g in s if d is not None else ():
            holders[g].append(r)
    pairs = {(a, b) for h in holders.values() for i, a in enumerate(h) for b in h[:i]}
    edges = [(sets[a][0], sets[b][0]) for a, b in pairs if den * len(sets[a][1] & sets[b][1]) >= num * len(sets[a][1] | sets[b][1])]
    comp = groups(edges, {d for d, _ in sets if d is not None})
    return sorted(((d, len(s), comp.get(d)) for d, s in sets), key=str)


def corpus(seed, n=220):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    base = [[rng.choice(vocab) for _ in range(rng.choice([2, 4, 6, 9, 15, 40, 90, 300]))] for _ in range(25)]
    hot = [rng.choice(vocab) for _ in range(60)]
    rows = []
    for i in range(n):
        w = list(rng.choice(base))
        for _ in range(int(rng.random() ** 2 * len(w) * 0.12)):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        if i % 4 == 0:
            w = [rng.choice(vocab) for _ in range(20)] + hot
        rows.append((i, " ".join(w)))
    return rows


@pytest.mark.parametrize("k,num,den", [(4, 85, 100), (5, 80, 100)])
def test_equals_brute_force(docs_of, k, num, den):
    rows = corpus(k) + [(None, "a b c d e"), (900, None), (901, " \n"), (902, "A b"), (903, "a B"), (3, "w1 w2 w3 w4 w5 w6"), (904, "w1 w2 w3 w4 w5 w6")]
    rows += [rows[5], (905, "x " * 70_000)]
    got = m.jaccard_classes(docs_of(rows), k, num, den, block=16).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows, k, num, den)


def test_spark_equals_brute_force_on_a_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = m.op2_jaccard_join(spark, "/root/testdata/sf0.01").collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows, 4, 85, 100)


def test_pigeonhole_and_bit_bound():
    rng = np.random.default_rng(0)
    scheme = m.bands(85, 100)
    for _ in range(400):
        n = int(rng.integers(8, 700))
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
        cut = int(len(a) * rng.random() * 0.15)
        b = np.unique(np.concatenate((a[cut:], rng.integers(0, 2**63, cut // 2, dtype=np.uint64))))
        both = len(np.intersect1d(a, b))
        x, y = np.frombuffer(m.bit_sketch(a), np.uint8), np.frombuffer(m.bit_sketch(b), np.uint8)
        width = min(len(x), len(y))
        assert np.bitwise_count(m.fold(x, width) ^ m.fold(y, width)).sum() <= len(a) + len(b) - 2 * both
        if 100 * both >= 85 * (len(a) + len(b) - both) and both < max(len(a), len(b)):
            assert len(np.intersect1d(m.sketch_keys(a, 85, 100, scheme), m.sketch_keys(b, 85, 100, scheme)))


def test_empty_table_and_clashing_columns(docs_of):
    schema = "doc_id long, text string, key long, id long, n long"
    assert m.jaccard_classes(docs_of([], schema)).count() == 0
    out = m.jaccard_classes(docs_of([(2, "a b c d e f", 1, 1, 1), (1, "A b c d e f", 1, 1, 1)], schema)).collect()
    assert {(r.doc_id, r.component_id) for r in out} == {(1, 1), (2, 1)}


def test_components_of_long_chains(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (None, 3)]
    rng.shuffle(edges)
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    want = {i: 0 for i in range(61)} | {100 + i: 100 for i in range(50)}
    assert {r.id: r.component for r in got} == want and len(got) == len(want)

_KEPT = """
import re
import numpy as np
import pyarrow as pa
from tidemark.llm import jaccard_join as m

def held():
    return int(re.search(r"Pss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read())[1]) / 1024

def batches(n):
    rng = np.random.default_rng(0)
    for lo in range(n):
        yield pa.record_batch({"doc_id": list(range(9000)), "text": [" ".join(rng.integers(0, 5000, 450).astype(str)) for _ in range(9000)]})

run = m._per_text(5, m._index(80, 100), [("key", pa.int64()), ("id", pa.int64()), ("left", pa.int32())])
for _ in run(batches(0)):
    pass
before = held()
rows = sum(b.num_rows for b in run(batches(2)))
print(rows, held() - before)
"""


def test_a_worker_returns_the_memory_of_its_texts():
    """Two batches of 19 MB of text: an idle worker would go on holding what its last task took."""
    done = subprocess.run([sys.executable, "-c", _KEPT], capture_output=True, text=True, check=True, cwd=os.path.dirname(m.__file__) + "/../..")
    rows, kept = done.stdout.split()
    assert int(rows) > 1_000_000 and float(kept) < 40, kept
