"""Counts against brute force, tails against exact sums, and what certificates allow."""

import hashlib
import random
import re
from fractions import Fraction
from math import comb

from pyspark.sql import functions as F

from tidemark.llm import quality_rules as m

SCHEMA = "doc_id long, text string, lang string"


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    g = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    hit = {i + j for i, x in enumerate(g) if g.count(x) > 1 for j in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit)


def test_counts_equal_brute_force_and_odd_rows(spark):
    rng = random.Random(4)
    texts = [None, "", " \n\t ", "a b c d e", "a a a a a a", "é# $|\x0b<x>\x0c" * 9, "x y z " * 4, "l\nl\n l\n\nl", "w " * 30000, "k" * 300000]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randrange(60))) + "\n" * rng.randrange(3) for _ in range(60)]
    rows = [(i // 2 if i else None, t, rng.choice(["en", None])) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({"label": F.lit(1), "w": F.lit("w"), "bins": F.lit("b"), "stratum": F.lit("s")})
    labels = spark.createDataFrame([(1, 0), (1, None), (None, 1), (2, 7)], "doc_id long, quality int")
    out = m.judge(docs, labels).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    want = sorted((str(d), *brute(t)) if t != "w " * 30000 else (str(d), 30000, 30000, 0, 0, 30000) for d, t, _ in rows)
    assert sorted((str(r.doc_id), *(r[c] for c in names)) for r in out) == want
    assert all(r.base_failed == (r.n_words < 10 or 5 * r.n_repeat_words > r.n_words) and r.kept != r.base_failed for r in out)
    assert m.judge(docs.where("false"), labels).count() == 0
    assert {r.kept for r in m.judge(docs, labels.where("false")).collect()} == {True, False}


def test_binomial_tails_are_exact(spark):
    cases = [(n, k, risk) for n in (1, 7, 90, 400, 3000) for k in (0, 1, 5, 37, 150) if k <= n for risk in (0.05, 0.01)]
    for risk in (0.05, 0.01):
        rows = [(n, k) for n, k, x in cases if x == risk]
        out = spark.createDataFrame(rows, "n long, k long").select("n", "k", m.tail_probability(F.col("n"), F.col("k"), risk).alias("p"))
        for n, k, p in out.collect():
            q = Fraction(risk)
            want = sum(comb(n, i) * q**i * (1 - q) ** (n - i) for i in range(k + 1))
            assert abs(p - float(want)) <= 1e-9 * max(float(want), 1e-300), (n, k, risk)


def _fit(doc_id):
    return hashlib.md5(str(doc_id).encode()).hexdigest()[0] < "4"


def test_cutoffs_hold_their_risk_and_need_labels(spark):
    rng = random.Random(9)
    words = "the old river runs below a quiet hill where nobody ever goes at night with lamps".split()
    clean = lambda: " ".join(rng.choice(words) + rng.choice(["", "", "s", "ing"]) for _ in range(40))
    rows, labels = [], []
    for i in range(1600):
        bad, lang = i % 4 == 0, ["en", "de", "xx"][i % 3]
        marked = bad or (lang == "de" and not _fit(i) and rng.random() < 0.3)  # de: the holdout has marks in clean texts too
        rows.append((i, re.sub(r" ", "*** ", clean()) if marked else clean(), lang))
        if lang != "xx":
            labels.append((i, 0 if bad else 1))
    out = m.judge(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    y, text = dict(labels), {r[0]: r[1] for r in rows}
    kept = lambda lang, want: [r.kept for r in out if r.stratum == lang and y.get(r.doc_id, 1) == want and not r.base_failed]
    assert not any(kept("en", 0)) and all(kept("en", 1))
    assert all(kept("de", 0)) and all(kept("de", 1)), "not certified: too many clean documents would go"
    assert all(r.kept or r.base_failed for r in out if r.stratum == "xx"), "no labels, no cutoff"
    assert {r.level for r in out if r.stratum == "en"} == {len(m.LEVELS)} and {r.level for r in out if r.stratum == "de"} == {0}
    assert all("***" in text[r.doc_id] for r in out if not r.kept and not r.base_failed)


def test_proposals_are_nested(spark):
    rng = random.Random(3)
    rows = [("s", int(rng.random() < 0.6), [rng.randrange(64) if rng.random() < 0.3 else rng.randrange(20) for _ in m.RULES]) for _ in range(1500)]
    (row,) = m.proposed(spark.createDataFrame(rows, "stratum string, label int, bins array<int>"), 1).collect()
    assert all(b <= a for x, y in zip(row.cuts, row.cuts[1:]) for a, b in zip(x, y))
    good = [r for r in rows if r[1] == 1]
    for t, cut in zip(m.LEVELS, row.cuts):
        for k, c in enumerate(cut):
            assert 10000 * sum(r[2][k] >= c for r in good) <= t * len(good)
