"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

One pass turns each text into counts (words, symbols, repeated lines and windows of words) and into nine rule values,
each a share in 0 to 1 of which a high value is suspicious, dealt into 64 bins of equal width on a square-root scale.
Labelled documents that pass the base rules are split by md5(doc_id): a quarter proposes cutoffs, three quarters are
the holdout.

* Proposal: by stratum (the language), rule and level (a share of label-1 documents that may lie beyond), the cutoff is
  the edge within that share that catches most label-0 documents, of equal ones the mildest, among those edges whose
  share of label-0 documents is at least ``lift`` times that of label-1 documents; without such an edge the rule is off.
  Cutoffs only get stricter from level to level, so the rejected sets are nested.
* Certificate: on the holdout, n label-1 documents of a stratum of which k are rejected at a level give the exact
  binomial tail P(Bin(n, risk) <= k). Levels are tested from the mildest on and testing ends at the first failure, which
  needs no correction within a stratum; across strata the error is divided by their number (Bonferroni). So with
  probability 1 - ``error`` no stratum rejects more than ``risk`` of its label-1 documents. The strictest certified level
  holds; a stratum without one (no or too few labels) rejects nothing beyond the base rules.

All counts are sums over histograms, so nothing but one row for each stratum is ever broadcast, and that only after its
rows are counted. Windows of words are compared by 64-bit hashes within one document.

Defined results: a null or empty text has no words and fails the base rules. A null lang is the stratum ``und``. Rows
with a null doc_id are judged but never calibrate. Several label rows of a document count as their largest; label rows
with nulls count for nothing. Repeated rows are returned as often as they come. Empty tables give an empty table. Only
doc_id, text, lang, and doc_id, quality of the labels are read, so other columns can't clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import let, stash, table

#: Shares, in units of 1/10,000, of label-1 documents that may lie beyond a proposed cutoff, from the mildest on.
LEVELS = (0, 10, 20, 50, 100, 200, 300)
#: The rule values, each high when suspicious.
RULES = ("symbols", "bars", "marks", "capitals", "digits", "repeats", "twins", "dup_lines", "long_words")
BINS = 64
#: A row of cutoffs is about 600 bytes; more rows than these are joined by a shuffle.
BROADCAST_ROWS = 20_000
_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _matches(pattern: str) -> Column:
    return F.regexp_count("text", F.lit(pattern)).cast("long")


def _repeated(words: Column, size: int = 5) -> Column:
    """How many words lie in windows of ``size`` words that occur twice or more."""

    def windows(hashes):
        at = F.sequence(F.lit(0), F.size(hashes) - size)
        return let(F.transform(at, lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(size)])), covered)

    def covered(hashes):
        rows = lambda: F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(let(rows(), twice))

    def twice(rows):
        same = lambda x, i: (F.get(rows, i - 1)["h"] == x["h"]) | (F.get(rows, i + 1)["h"] == x["h"])
        kept = F.filter(rows, lambda x, i: F.coalesce(same(x, i), F.lit(False)))
        return let(F.sort_array(F.transform(kept, lambda x: x["i"])), union)

    def union(at):
        gap = F.transform(at, lambda a, k: F.least(F.lit(size), F.coalesce(F.get(at, k + 1) - a, F.lit(size))))
        return F.aggregate(gap, F.lit(0), lambda x, y: x + y)

    return F.when(F.size(words) > size, let(F.transform(words, lambda w: F.xxhash64(w)), windows)).otherwise(F.lit(0))


def counts(docs: DataFrame) -> DataFrame:
    """(doc_id, stratum, the five counts, base_failed, bins): one row for each row of a documents table."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("und")).alias("stratum"), F.coalesce("text", F.lit("")).alias("text")
    )
    # Words and lines as columns of their own projection: each is split once.
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.withColumn("w", words).withColumn("l", lines)
    long = lambda c: c.cast("long")
    rows = rows.select(
        "doc_id", "stratum", long(F.size("w")).alias("n_words"), (F.length("text") - _matches(r"[\x20\x09-\x0D]")).alias("word_chars"),
        _matches(r"[#*$%&|<>]").alias("n_symbols"), long(F.size("l") - F.size(F.array_distinct("l"))).alias("n_dup_lines"),
        long(_repeated(F.col("w"))).alias("n_repeat_words"), long(F.size("l")).alias("n_lines"), _matches(r"[|]").alias("n_bars"),
        _matches(r"[!?]").alias("n_marks"), _matches(r"[A-Z]").alias("n_capitals"), _matches(r"[0-9]").alias("n_digits"),
        long(let(F.col("w"), lambda w: F.size(F.filter(w, lambda x, i: F.coalesce(F.get(w, i - 1) == x, F.lit(False)))))).alias("n_twins"),
    )
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return rows.select("doc_id", "stratum", *_COUNTS, base.alias("base_failed"), F.array(*[_bin(*map(F.expr, x)) for x in _SHARES]).alias("bins"))


#: Numerator and denominator of each rule value.
_SHARES = (
    ("n_symbols", "n_words"), ("n_bars", "n_words"), ("n_marks", "n_words"), ("n_capitals", "word_chars"), ("n_digits", "word_chars"),
    ("n_repeat_words", "n_words"), ("n_twins", "n_words"), ("n_dup_lines", "n_lines"), ("word_chars", "16 * n_words"),
)


def _bin(a: Column, b: Column) -> Column:
    return F.least(F.lit(BINS - 1), F.floor(F.lit(BINS) * F.sqrt(F.coalesce(F.try_divide(a, b), F.lit(0.0)))).cast("int"))


def proposed(fit: DataFrame, lift: int = 4) -> DataFrame:
    """(stratum, cuts): an array over levels of arrays over rules of the least rejected bin, ``BINS`` where a rule is off."""
    by = ["stratum", "rule"]
    hist = fit.select("stratum", "label", F.posexplode("bins").alias("rule", "bin"))
    hist = hist.groupBy(*by, "bin").agg(F.count_if(F.col("label") == 1).alias("good"), F.count_if(F.col("label") == 0).alias("bad"))
    mine = W.partitionBy(*by)
    tail = mine.orderBy(F.desc("bin"))
    tails = hist.select(
        *by, "bin", F.sum("good").over(tail).alias("good"), F.sum("bad").over(tail).alias("bad"),
        F.sum("good").over(mine).alias("all_good"), F.sum("bad").over(mine).alias("all_bad"),
    )
    levels = F.posexplode(F.array(*map(F.lit, LEVELS))).alias("level", "share")
    tails = tails.where("bin > 0").select("*", levels).where("good * 10000 <= share * all_good")
    tails = tails.where((F.col("bad") > 0) & (F.col("bad") * F.col("all_good") >= lift * F.col("good") * F.col("all_bad")))
    best = tails.groupBy(*by, "level").agg(F.max(F.struct("bad", "bin")).alias("b"))
    best = best.select("stratum", F.concat_ws(":", "level", "rule").alias("key"), F.col("b.bin").alias("bin"))
    cuts = best.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("key", "bin"))).alias("m"))  # at most levels x rules
    edge = lambda t, r: F.coalesce(F.try_element_at("m", F.lit(f"{t}:{r}")), F.lit(BINS))
    return cuts.select("stratum", F.array(*[F.array(*[edge(t, r) for r in range(len(RULES))]) for t in range(len(LEVELS))]).alias("cuts"))


def tail_probability(n: Column, k: Column, risk: float) -> Column:
    """P(Bin(n, risk) <= k), summed in logarithms from 0 up: log of each term from that of the one before."""
    odds, start = risk / (1 - risk), F.lit(1.0 - risk)
    first = n.cast("double") * F.log(start)

    def add(s, i):
        term = s["term"] + F.log((n - i + 1) / i * odds)
        high, low = F.greatest(term, s["total"]), F.least(term, s["total"])
        return F.struct(term.alias("term"), (high + F.log1p(F.exp(low - high))).alias("total"))

    steps = F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.least(F.lit(1.0), F.exp(F.aggregate(steps, F.struct(first.alias("term"), first.alias("total")), add, lambda s: s["total"])))


def _rejects(cuts: Column, bins: Column) -> Column:
    return F.exists(F.arrays_zip(cuts.alias("c"), bins.alias("b")), lambda x: x["b"] >= x["c"])


def _few(df: DataFrame) -> DataFrame:
    """A table read back from storage, broadcast if its rows, one for each stratum, are few enough."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def certified(holdout: DataFrame, cuts: DataFrame, risk: float = 0.05, error: float = 0.05) -> DataFrame:
    """(stratum, n, rejected, p, level, cut): the certificates of each stratum with a proposal and label-1 holdout documents.

    ``rejected`` and ``p`` are arrays over the levels; ``level`` is how many are certified, ``cut`` the cutoffs of the last.
    """
    good = holdout.where("label = 1").join(_few(cuts), "stratum")
    hit = lambda t: F.count_if(_rejects(F.get("cuts", F.lit(t)), F.col("bins")))
    # Sums by stratum, made in each task first; the cutoffs come back by their one row.
    g = good.groupBy("stratum").agg(F.count("*").alias("n"), *[hit(t).alias(f"k{t}") for t in range(len(LEVELS))])
    g = g.select("stratum", "n", F.array(*[f"k{t}" for t in range(len(LEVELS))]).alias("rejected"))
    g = g.join(cuts, "stratum").withColumn("p", F.transform("rejected", lambda k: tail_probability(F.col("n"), k, risk)))
    strata = F.broadcast(cuts.agg(F.count("*").alias("strata")))  # one row
    g = g.join(strata).withColumn("bad", F.transform("p", lambda p: p > error / F.col("strata")))
    level = F.when(F.exists("bad", lambda x: x), F.array_position("bad", True) - 1).otherwise(F.size("bad")).cast("int")
    return g.withColumn("level", level).select("stratum", "n", "rejected", "p", "level", F.get("cuts", F.col("level") - 1).alias("cut"))


def judge(docs: DataFrame, labels: DataFrame, risk: float = 0.05, error: float = 0.05, lift: int = 4) -> DataFrame:
    """(doc_id, the five counts, base_failed, kept, stratum, level) for each row of a documents table."""
    rows = stash(counts(docs), "rule-counts")
    known = labels.where("doc_id is not null and quality in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").alias("label"))
    known = rows.where("not base_failed").select("doc_id", "stratum", "bins").join(known, "doc_id")
    fit = F.substring(F.md5(F.col("doc_id").cast("string")), 1, 1) < "4"
    cuts = stash(proposed(known.where(fit), lift), "rule-proposals")
    verdicts = stash(certified(known.where(~fit), cuts, risk, error), "rule-verdicts")
    out = rows.join(_few(verdicts.select("stratum", "level", "cut")), "stratum", "left")
    thrown = F.coalesce(_rejects(F.col("cut"), F.col("bins")), F.lit(False))
    return out.select("doc_id", *_COUNTS, "base_failed", (~F.col("base_failed") & ~thrown).alias("kept"), "stratum", F.coalesce("level", F.lit(0)).alias("level"))


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _sql() -> str:
    gone = lambda cs: f"length(text) - length(translate(text, '{cs}', ''))"
    share = lambda a, b: f"CAST(least({BINS - 1}, floor({BINS} * sqrt(coalesce(CAST({a} AS DOUBLE) / nullif({b}, 0), 0)))) AS INT)"
    levels = ", ".join(f"({i}, {v})" for i, v in enumerate(LEVELS, 1))
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(lang, 'und') AS stratum, coalesce(text, '') AS text FROM documents),
s AS (SELECT *, list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM d),
g AS (SELECT r, i, array_to_string(list_slice(w, i, i + 4), ' ') AS g FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM s WHERE len(w) > 5)),
m AS (SELECT r, i FROM (SELECT *, count(*) OVER (PARTITION BY r, g) AS c FROM g) WHERE c > 1),
n AS (SELECT r, sum(least(5, coalesce(nxt - i, 5))) AS n_repeat_words FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM m) GROUP BY r),
c AS (SELECT s.r, doc_id, stratum, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
  CAST({gone('#*$%&|<>')} AS BIGINT) AS n_symbols, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
  len(l) AS n_lines, {gone('|')} AS n_bars, {gone('!?')} AS n_marks, {gone('ABCDEFGHIJKLMNOPQRSTUVWXYZ')} AS n_capitals, {gone('0123456789')} AS n_digits,
  len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_twins FROM s LEFT JOIN n ON n.r = s.r),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, [{', '.join(share(a, b) for a, b in _SHARES)}] AS bins FROM c),
y AS (SELECT doc_id, max(quality) AS label FROM labels WHERE doc_id IS NOT NULL AND quality IN (0, 1) GROUP BY 1),
k AS (SELECT r, stratum, bins, label, left(md5(CAST(b.doc_id AS VARCHAR)), 1) < '4' AS fit FROM b JOIN y ON y.doc_id = b.doc_id WHERE NOT base_failed),
h AS (SELECT stratum, rule, bins[rule] AS bin, count(*) FILTER (WHERE label = 1) AS good, count(*) FILTER (WHERE label = 0) AS bad FROM k, range(1, {len(RULES) + 1}) q(rule) WHERE fit GROUP BY ALL),
t AS (SELECT stratum, rule, bin, sum(good) OVER x AS good, sum(bad) OVER x AS bad, sum(good) OVER p AS all_good, sum(bad) OVER p AS all_bad FROM h
  WINDOW p AS (PARTITION BY stratum, rule), x AS (PARTITION BY stratum, rule ORDER BY bin DESC)),
u AS (SELECT stratum, rule, level, max({{'bad': bad, 'bin': bin}}).bin AS bin
  FROM t, (VALUES {levels}) v(level, share) WHERE bin > 0 AND good * 10000 <= share * all_good AND bad > 0 AND bad * all_good >= 4 * good * all_bad GROUP BY ALL),
x AS (SELECT k.r, k.stratum, v.level, bool_or(coalesce(k.bins[u.rule] >= u.bin, false)) AS hit
  FROM k JOIN (SELECT DISTINCT stratum FROM u) o ON o.stratum = k.stratum CROSS JOIN (SELECT unnest(range(1, {len(LEVELS) + 1})) AS level) v
  LEFT JOIN u ON u.stratum = k.stratum AND u.level = v.level WHERE NOT fit AND label = 1 GROUP BY ALL),
z AS (SELECT stratum, level, count(*) AS n, count(*) FILTER (WHERE hit) AS k FROM x GROUP BY ALL),
pv AS (SELECT stratum, level, list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(0.05) + (n - i) * ln(0.95)))) AS p FROM z),
ok AS (SELECT stratum, coalesce(min(level) FILTER (WHERE p > 0.05 / (SELECT count(DISTINCT stratum) FROM u)) - 1, {len(LEVELS)}) AS level FROM pv GROUP BY 1),
f AS (SELECT ok.stratum, list({{'rule': u.rule, 'bin': u.bin}}) AS cut FROM ok JOIN u ON u.stratum = ok.stratum AND u.level = ok.level GROUP BY ALL)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND len(list_filter(coalesce(cut, []), lambda q: bins[q.rule] >= q.bin)) = 0 AS kept, b.stratum, CAST(coalesce(ok.level, 0) AS INT) AS level
FROM b LEFT JOIN ok ON ok.stratum = b.stratum LEFT JOIN f ON f.stratum = b.stratum"""


QUERIES = {"op11_quality_rules": op11_quality_rules}
SQL = {"op11_quality_rules": _sql()}
