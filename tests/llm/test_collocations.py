"""Phrases against brute force, with few buckets so that hashes collide, runs cut anywhere, and odd rows."""

import random
import re
from collections import Counter

import pytest

from tidemark.llm import collocations as m

SCHEMA = "lang string, text string, doc_id long, phrase string, n string, a string"


def brute(rows, least, top):
    counts, total = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, 5):
                counts.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    live = {x: a for x, a in counts.items() if len(x[1]) > 1 and a >= least}
    outer = Counter()
    for (lang, w), a in live.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                outer[lang, w[i : i + k]] = max(outer[lang, w[i : i + k]], a)
    out = {}
    for (lang, w), a in live.items():
        if 100 * outer[lang, w] >= 80 * a:
            continue
        score, _, l, r = min((2_000_000 * a // (counts[lang, w[:k]] + counts[lang, w[k:]]), k, counts[lang, w[:k]], counts[lang, w[k:]]) for k in range(1, len(w)))
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), l, r))
    return sorted((lang, i, p.decode(), -a, l, r, total[lang], -s) for lang, xs in out.items() for i, (s, a, p, l, r) in enumerate(sorted(xs)[:top], 1))


def rows_of(df):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


@pytest.mark.parametrize("buckets", [1 << 6, 1 << 14])
def test_equals_brute_force(spark, buckets):
    rng = random.Random(buckets)
    words = ["a", "B", "c", "É", "new", "York", "times", "x\x00y", "\x1d", "日本"]
    text = lambda n: "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t ", ". ", ",", "\n", "?!", "\r"]) for _ in range(n))
    rows = [(rng.choice(["en", "fr", None]), text(rng.randrange(80))) for _ in range(60)]
    rows += [("en", "of the new york times " * 40), ("en", "of the new york times, " * 40), ("xx", None), ("yy", ""), ("zz", ".,; "), rows[0], rows[0]]
    docs = spark.createDataFrame([(*r, 1, "p", "n", "a") for r in rows], SCHEMA).repartition(3)
    for least, top in ((5, 2000), (3, 7)):
        want = brute(rows, least, top)
        assert len(want) > 10
        assert rows_of(m.collocations(docs, least, top, buckets=buckets, salts=3, run_bytes=300, held=20)) == want


def test_empty_and_rare(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert rows_of(m.collocations(empty, buckets=1 << 10)) == []
    once = spark.createDataFrame([("en", "each word here stands alone", 1, "p", "n", "a"), (None, None, None, None, None, None)], SCHEMA)
    assert rows_of(m.collocations(once, buckets=1 << 10)) == []
    assert [r[7] for r in rows_of(m.collocations(once, least=1, buckets=1 << 10))] == [1_000_000] * 2


def test_high_thresholds_and_wide_counts(spark):
    rows = [("en", "p q " * 700)] * 3
    docs = spark.createDataFrame([(*r, 1, "p", "n", "a") for r in rows], SCHEMA)
    assert rows_of(m.collocations(docs, least=1000, buckets=1 << 8)) == brute(rows, 1000, 2000)


def test_buckets_saturate_without_losing_the_threshold():
    import numpy as np

    b = m.Buckets(8, 30)
    for n in (10, 25, 300):
        b.add(np.full(n, 3, np.uint64))
    b.add(np.full(29, 5, np.uint64))
    assert b.count.tolist() == [0, 0, 0, 30, 0, 29, 0, 0]
