import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import line_dedup as m


def brute(rows, min_chars=40, min_docs=5):
    fold = lambda x: x.strip(m.BLANKS).encode().lower()
    holders = defaultdict(set)
    for d, t in rows:
        for line in (t or "").split("\n"):
            if d is not None and len(line.strip(m.BLANKS)) >= min_chars:
                holders[fold(line)].add(d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        keep = [x for x in lines if d is None or len(h := holders.get(fold(x), ())) < min_docs or d == max(h)]
        out.append((d, len(lines), len(lines) - len(keep), "\n".join(keep)))
    return sorted(out, key=str)


def result(docs, **kw):
    out = m.apply_keep_bitmaps(docs, m.keep_bitmaps(docs, **kw))
    return sorted(((r.row.doc_id, r.n_lines, r.n_dropped, r.kept_text or "") for r in out.collect()), key=str)


def test_equals_brute_force_with_hot_lines_nulls_and_repeats(docs_of):
    rng = random.Random(3)
    pool = ["x" * 45 + str(i) for i in range(30)]
    rows = [(i, "\n".join(rng.choice(pool + ["short", "", " \t" + pool[0].upper() + "\r"]) for _ in range(9))) for i in range(200)]
    rows += [(None, pool[0]), (500, None), (501, ""), (7, pool[1]), (7, pool[1]), (502, "y" * 300_000)]
    assert result(docs_of(rows).repartition(5)) == brute(rows)


def test_empty_table_and_clashing_columns(docs_of):
    schema = "doc_id long, text string, pos string, th string, `odd name` int, row string"
    assert result(docs_of([], schema)) == []
    line = "k" * 50
    out = m.apply_keep_bitmaps(d := docs_of([(i, line, "p", "t", i, "r") for i in range(6)], schema), m.keep_bitmaps(d))
    assert {(r.row["odd name"], r.row["row"], r.n_dropped) for r in out.collect()} == {(i, "r", int(i < 5)) for i in range(6)}


@pytest.mark.parametrize("cut", [1, 2, 3, 7, 1000])
def test_stream_over_any_partitions_and_batches(cut):
    """The pass over sorted rows gives the same drops wherever partitions and batches are cut."""
    rng = np.random.default_rng(cut)
    rows = sorted({(int(rng.integers(4)) ** 3, 0, -int(rng.integers(12)), 0, int(rng.integers(3))) for _ in range(150)})
    rows = [(a, b, -d, t, p) for a, b, d, t, p in rows]
    names = ["h1", "h2", "doc", "th", "pos"]
    bounds = sorted({0, len(rows), *(i for i in rng.integers(0, len(rows), 4).tolist())})
    bounds = [b for b in bounds if b in (0, len(rows)) or rows[b - 1][:3] != rows[b][:3]]
    found = []
    for lo, hi in zip(bounds, bounds[1:], strict=False):
        part = [rows[i : min(hi, i + cut)] for i in range(lo, hi, cut)]
        for out in m._stream(5)(pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in b]) for b in part):
            found += out.to_pylist()
    total, top = defaultdict(int), defaultdict(int)
    for r in found:
        if r["kind"] == m.SUMMARY:
            total[r["h1"]] += r["pos"]
            top[r["h1"]] = max(top[r["h1"]], r["doc"])
    docs_with = defaultdict(set)
    for a, _, d, _, p in rows:
        docs_with[a].add(d)
    want = sorted((d, p) for a, _, d, _, p in rows if len(docs_with[a]) >= 5 and d != max(docs_with[a]))
    got = [(r["doc"], r["pos"]) for r in found if r["kind"] == m.DROP]
    got += [(r["doc"], r["pos"]) for r in found if r["kind"] == m.OPEN and total[r["h1"]] >= 5 and r["doc"] != top[r["h1"]]]
    assert sorted(got) == want
