"""Personal data: fixed patterns, then bootstrapped contextual extraction, in DataFrame functions only.

The fixed patterns give the seed entities. Every word of at least five characters (outer punctuation
aside) that holds a digit or an at sign is an instance, as is a run of numbers with blanks between that touches no base
span. The two plain words before it, the one before and the one after are its lexical patterns. Long words of letters and
digits are seeds of a fifth kind, secret, which no fixed pattern finds. Spark scores the graph of patterns and instances round by round: a
pattern's confidence is the confidence of the instances that it introduces over all its occurrences in the corpus,
whatever follows; an instance's is the chance that at least one of its trusted patterns is right. A pattern is trusted
only if it introduces ``support`` different trusted instances with a confidence of at least ``trust``; instances
reached with that confidence are new identifiers and take part in the next round. Their occurrences behind a trusted
pattern become spans of the kind that their patterns vote for; base spans are never touched. Left out: shorter words,
occurrences of an accepted identifier in any other context, and instances without a plain word beside them.

Defined results: a null or empty text has no spans. Each row is searched by itself: null doc_ids and repeated rows
give a row each. An empty table gives an empty table. Only doc_id and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, lower_ascii, prefix_sums, stash, table
from .decontaminate import words_column

KINDS = ("email", "ip", "card", "phone")
ALL_KINDS = (*KINDS, "secret")

#: Fixed patterns of the four kinds. Possessive loops and the look-behinds only spare work: a run of the first class
#: that doesn't match from its start, or from where the match before it ended, matches from nowhere.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Words with a digit or an at sign, from their first character to their last.
WORD = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
_NUMBER = r"[(+]*+[0-9][0-9()./-]*+(?![^\x20\x09-\x0D,;:!?\"'])"
#: The same, but neighbouring numbers are one.
MARKED = rf"(?<![^\x20\x09-\x0D]){_NUMBER}(?:\x20++{_NUMBER})++[^\x20\x09-\x0D]*+|{WORD}"
#: Long words of letters and digits: seeds of the kind that no fixed pattern finds. They become spans only behind trusted patterns.
_SECRET = r"^(?=[^0-9]*[0-9])(?=[^a-z]*[a-z])[a-z0-9_./+=-]{20,}$"
#: Seen words and runs that may be identifiers although no fixed pattern finds them.
_FREE = "not taken and length(value) >= 5"
_BYTE = r"^0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])$"
#: Pattern tables of up to so many rows (some 30 bytes each) may be broadcast; larger ones are shuffled.
BROADCAST_ROWS = 200_000


def matches(text: Column, pattern: str) -> tuple[Column, Column]:
    """All leftmost matches of a pattern, and the gaps before, between and after them."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)


def starts(found: Column, gaps: Column) -> Column:
    """Where each match starts, in code points."""
    before = F.slice(gaps, 1, F.size(found))
    lengths = F.zip_with(before, found, lambda g, m: F.length(g) + F.length(m))
    return F.when(F.size(found) > 0, F.zip_with(prefix_sums(lengths), before, lambda s, g: s + F.length(g)))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    back = F.reverse(digits)
    value = lambda i: F.substring(back, i, F.lit(1)).cast("int")
    twice = lambda v: F.when(v > 4, v * 2 - 9).otherwise(v * 2)
    each = F.transform(F.sequence(F.lit(1), F.length(digits)), lambda i: F.when(i % 2 == 1, value(i)).otherwise(twice(value(i))))
    return F.aggregate(each, F.lit(0), lambda a, b: a + b) % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: p.rlike(_BYTE))
    if kind == "card":
        return F.when(F.length(_digits(m)).between(12, 19), _luhn(_digits(m))).otherwise(F.lit(False))
    return F.length(_digits(m)).between(9, 15) if kind == "phone" else F.lit(True)


_SPAN = "array<struct<start:int,kind:int,end:int>>"
_FOUND = "array<struct<start:int,kind:int,end:int,value:string>>"


def base_spans(kind: str, found: Column, gaps: Column) -> Column:
    at = starts(found, gaps)
    spans = F.zip_with(
        at, found, lambda s, m: F.struct(s.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), (s + F.length(m)).alias("end"), m.alias("value"))
    )
    return F.coalesce(F.filter(spans, lambda s: _valid(kind, s["value"])), F.array().cast(_FOUND)).cast(_FOUND)


def search(docs: DataFrame) -> DataFrame:
    """(doc_id, row_id, spans, seen): base spans, and the marked words with their context and the kind of base span that starts in them.

    Written once: ``row_id`` numbers the rows and stays as it is.
    """
    text = F.coalesce("text", F.lit(""))
    gate = {"email": text.contains("@"), "phone": text.contains("+")}
    digit = text.rlike("[0-9]")
    t = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("t"), *[gate.get(k, digit).alias(f"has_{k}") for k in PATTERNS])
    t = t.withColumn("has_mark", F.col("has_email") | F.col("has_ip"))
    cols = []
    for k in [*PATTERNS, "mark"]:
        found, gaps = matches(F.col("t"), PATTERNS.get(k, MARKED))
        cols += [F.when(F.col(f"has_{k}"), found).alias(f"found_{k}"), F.when(F.col(f"has_{k}"), gaps).alias(f"gaps_{k}")]
    t = t.select("doc_id", *cols)
    spans = F.array_sort(F.concat(*[base_spans(k, F.col(f"found_{k}"), F.col(f"gaps_{k}")) for k in PATTERNS]))
    words = lambda g: F.filter(F.split(lower_ascii(g), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    # The two words before, and the word after.
    two = lambda g: F.slice(F.concat(F.array(F.lit(""), F.lit("")), g), -2, 2)
    after = lambda g: F.coalesce(F.get(g, F.lit(0)), F.lit(""))
    lead = lambda m: F.regexp_replace(m, r"^[^\p{L}\p{N}]++", "")

    touching = lambda z, s, m: F.filter(z["spans"], lambda x: (x["start"] < s + F.length(m)) & (x["end"] > s))

    def items(z: Column, i: Column) -> Column:
        """A word or a run; of a run that holds base spans its words, the first with the pattern."""
        s, m = F.get(z["at"], i), F.get(z["found"], i)
        alone = F.size(touching(z, s, m)) == 0
        item = lambda at, text: F.struct(
            (s + at).alias("s"), text.alias("m"), (at == 0).alias("leads"), (at + F.length(text) == F.length(m)).alias("ends"),
            F.get(z["context"], i).alias("c"), F.get(z["next"], i).alias("next"),
        )
        words = matches(m, WORD)
        return F.when(~m.contains(" ") | alone, F.array(item(F.lit(0), m))).otherwise(F.zip_with(starts(*words), words[0], item))

    def seen(z: Column, item: Column) -> Column:
        s, m, c = item["s"], item["m"], item["c"]
        inside = touching(z, s, m)
        first = F.filter(inside, lambda x: x["start"] >= s)
        opened = F.when(m.contains(" "), m).otherwise(lead(m))  # a run's bracket or plus belongs to it
        cut = F.length(m) - F.length(opened)
        core = F.reverse(lead(F.reverse(opened)))
        return F.struct(
            (s + cut).alias("start"), (s + cut + F.length(core)).alias("end"),
            lower_ascii(F.coalesce(F.get(first, F.lit(0))["value"], core)).alias("value"),
            F.array_compact(F.array(
                F.when(item["leads"] & (F.get(c, F.lit(0)) != ""), two_before(F.get(c, F.lit(0)), F.get(c, F.lit(1)))),
                F.when(item["leads"] & (F.get(c, F.lit(1)) != ""), one_before(F.get(c, F.lit(1)))),
                F.when(item["ends"] & (item["next"] != ""), one_after(item["next"])),
            )).alias("patterns"),
            F.get(first, F.lit(0))["kind"].alias("kind"), (F.size(inside) > 0).alias("taken"),
        )

    gaps = F.transform("gaps_mark", words)
    context = F.transform(F.slice(gaps, F.lit(1), F.size("found_mark")), two)
    known = F.struct(
        starts(F.col("found_mark"), F.col("gaps_mark")).alias("at"), F.col("found_mark").alias("found"),
        context.alias("context"), F.transform(F.slice(gaps, F.lit(2), F.size("found_mark")), after).alias("next"), F.col("spans"),
    )
    marks = let(known, lambda z: F.transform(F.sequence(F.lit(0), F.size(z["found"]) - 1), lambda i: F.transform(items(z, i), lambda x: seen(z, x))))
    marks = F.flatten(marks)
    t = t.select("doc_id", spans.alias("spans"), "found_mark", "gaps_mark")
    marks = F.when(F.size("found_mark") > 0, marks)
    plain = F.transform("spans", lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end")))
    t = t.select("doc_id", F.monotonically_increasing_id().alias("row_id"), plain.cast(_SPAN).alias("spans"), marks.alias("seen"))
    return stash(t, "spans")


def two_before(one: Column, two: Column) -> Column:
    return F.xxhash64(F.lit("before"), one, two)


def one_before(word: Column) -> Column:
    return F.xxhash64(F.lit("before"), word)


def one_after(word: Column) -> Column:
    return F.xxhash64(F.lit("after"), word)


def pattern_counts(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """(pattern, total): how often the words of a pattern stand beside any word, over all texts."""
    w = docs.select(words_column(F.col("text")).alias("w")).where("size(w) > 1")
    beside = F.transform(
        F.sequence(F.lit(0), F.size("w") - 1),
        lambda i: F.array_compact(F.array(
            F.when(i < F.size("w") - 2, two_before(F.get("w", i), F.get("w", i + 1))),
            F.when(i < F.size("w") - 1, one_before(F.get("w", i))),
            F.when(i > 0, one_after(F.get("w", i))),
        )),
    )
    found = w.select(F.explode(beside).alias("each")).select(F.explode("each").alias("pattern"))
    few = patterns.count() <= BROADCAST_ROWS
    return found.join(F.broadcast(patterns) if few else patterns, "pattern").groupBy("pattern").agg(F.count("*").alias("total"))


def discover(docs: DataFrame, seen: DataFrame, rounds: int, support: int, trust: float, early_share: int = 16) -> DataFrame:
    """(row_id, start, kind, end): the occurrences of instances that trusted patterns introduce."""
    edges = seen.where(f"kind is not null or ({_FREE})").withColumn("pattern", F.explode("patterns"))
    secret = F.when(F.col("value").rlike(_SECRET), F.lit(ALL_KINDS.index("secret")))
    edges = edges.groupBy("pattern", "value").agg(F.coalesce(F.min("kind"), F.first(secret)).alias("seed"), F.count("*").alias("times"))
    edges = stash(edges, "edges")
    known = edges.groupBy("pattern").agg(F.count("*").alias("values"), F.sum("times").alias("most")).where(f"values >= {support}")
    known = stash(known.select("pattern", "most"), "patterns")
    # A pattern that some of the documents already show too often for any trust needs no count over all of them.
    early = pattern_counts(docs.where(F.pmod(F.xxhash64("text"), F.lit(early_share)) == 0), known.select("pattern"))
    hopeful = known.join(early, "pattern", "left").where(F.coalesce("total", F.lit(0)) * trust <= F.col("most"))
    hopeful = stash(hopeful.select("pattern"), "patterns")
    edges = stash(edges.join(pattern_counts(docs, hopeful), "pattern"), "edges")
    trusted = stash(edges.groupBy("value").agg(F.max("seed").alias("kind")).where("kind is not null").withColumn("c", F.lit(1.0)), "trusted")
    seeds = trusted
    for _ in range(rounds):
        by_kind = edges.join(trusted, "value").groupBy("pattern", "kind").agg(
            F.sum(F.col("times") * F.col("c")).alias("mass"), F.count("*").alias("values"), F.max("total").alias("total")
        )
        good = by_kind.groupBy("pattern").agg(
            F.sum("mass").alias("mass"), F.sum("values").alias("values"), F.max("total").alias("total"),
            F.max_by("kind", F.struct("mass", -F.col("kind"))).alias("kind"),
        )
        good = good.withColumn("p", F.least(F.lit(1.0), F.col("mass") / F.greatest("total", "mass")))
        votes = stash(good.where((F.col("values") >= support) & (F.col("p") >= trust)).select("pattern", "kind", "p"), "votes")
        found = edges.join(votes, "pattern").join(seeds.select("value"), "value", "left_anti")
        found = found.groupBy("value").agg(
            F.max_by("kind", F.struct("p", -F.col("kind"))).alias("kind"),
            (1 - F.exp(F.sum(F.log(F.greatest(F.lit(1e-9), 1 - F.col("p")))))).alias("c"),
        )
        trusted = stash(seeds.unionByName(found.where(F.col("c") >= trust)), "trusted")
    hits = seen.where(f"kind is null and {_FREE}").drop("kind").withColumn("pattern", F.explode("patterns"))
    hits = hits.join(votes.select("pattern"), "pattern", "left_semi").join(trusted.select("value", "kind"), "value")
    return hits.select("row_id", "start", "kind", "end").distinct()


def find_pii(docs: DataFrame, rounds: int = 3, support: int = 3, trust: float = 0.8) -> DataFrame:
    """(doc_id, base, spans): base spans and all spans of each row, sorted by start and kind."""
    rows = search(docs)
    seen = rows.where("seen is not null").select("row_id", F.inline("seen"))
    new = discover(docs, seen, rounds, support, trust)
    new = new.groupBy("row_id").agg(F.collect_list(F.struct("start", "kind", "end")).alias("new"))
    out = rows.drop("seen").join(new, "row_id", "left")
    both = F.array_sort(F.concat("spans", F.coalesce("new", F.array().cast(_SPAN))))
    return out.select("doc_id", F.col("spans").alias("base"), both.alias("spans"))


def _joined(spans: str) -> Column:
    name = F.array(*[F.lit(k) for k in ALL_KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"], s["end"])), ",")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = find_pii(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(k))).cast("long").alias(f"n_{k}")
    return out.select("doc_id", *map(count, KINDS), F.sha2(_joined("base"), 256).alias("base_sha256"), _joined("spans").alias("spans"))


QUERIES = {"op10_pii": op10_pii}
SQL: dict[str, str] = {}
