"""Phrase collocations by hash-filtered level-wise counting (PCY with the direct hashing of DHP).

Four passes over the texts, one for each phrase length k. A pass counts exactly the phrases of k words that can still be
frequent, and beside that deals the phrases of k + 1 words, both halves of which can still be, into a fixed number of
hash buckets. A phrase is counted in its own pass only if

* its two parts of k - 1 words are frequent (Apriori; the exact frequent set, hashed into a bitmap), and
* its bucket, filled in the pass before, reached ``least`` (PCY/DHP; a bitmap with one bit a bucket).

Both bitmaps have ``buckets`` bits at any size of the corpus and are all that is broadcast; neither can lose a frequent
phrase, so what is lost by colliding hashes is only time. Exact counts are keyed by the phrase itself. Within a task a
bucket saturates at ``least``, which leaves the comparison of its sum with ``least`` as it is, and a task sends one byte
a bucket at most. Partial counts are merged in each task before the shuffle and whenever a task holds ``HELD`` phrases.

Cuts, contained phrases and ranks are joins, sums and windows over the frequent phrases. Ranks are taken within salted
shares of a language first, so no language is ordered whole in one task.

Defined results: a null text has no words, a null lang is ``und``. Only lang and text are read: repeated rows count as
often as they come, null or repeated doc_ids and further columns count for nothing. An empty table gives an empty table.
Texts are worked on in runs of about 4 MB that end at a break, so a very long text is never held as one list of words
unless it has no break at all.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import drop_stash, stash, table

LONGEST = 4
RUN = 4 << 20
HELD = 400_000
_STEP = 4096
_MARK = b"\xff"  # no byte of UTF-8
_BREAKS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", _MARK * 10)
_PASS = "lang string, phrase binary, c long, chunk int, bits binary"


def _runs(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[str, bytes]]:
    """(lang, text): texts of one language joined by break marks, in runs of about ``most`` bytes that end at a break."""
    for b in batches:
        held: dict[str, list[bytes]] = defaultdict(list)
        size: dict[str, int] = defaultdict(int)
        for lang, text in zip(b["lang"], b["text"], strict=True):
            lang, data, at = lang.as_py(), text.as_py().lower().translate(_BREAKS), 0
            while at < len(data):
                cut = data.find(_MARK, at + most) if len(data) - at > most else -1
                part = data[at:] if cut < 0 else data[at:cut]
                at = len(data) if cut < 0 else cut
                held[lang].append(part)
                size[lang] += len(part)
                if size[lang] >= most:
                    yield lang, _MARK.join(held.pop(lang))
                    size[lang] = 0
        yield from ((lang, _MARK.join(parts)) for lang, parts in held.items())


def _seed(lang: str) -> int:
    return zlib.crc32(lang.encode("utf-8", "surrogatepass"))


def _mixed(words: list[np.ndarray]) -> np.ndarray:
    """The hash of phrases given by the hashes of their first, second, ... words."""
    h = words[0].copy()
    for w in words[1:]:
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + w
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class Buckets:
    """Saturating counts of hash buckets in one task."""

    def __init__(self, buckets: int, least: int):
        self.least, self.mask = least, np.uint64(buckets - 1)
        self.count = np.zeros(buckets, np.uint8 if least < 256 else np.uint32)

    def add(self, hashes: np.ndarray) -> None:
        at, n = np.unique(hashes & self.mask, return_counts=True)
        at = at.astype(np.int64)
        self.count[at] = np.minimum(self.count[at].astype(np.int64) + n, self.least).astype(self.count.dtype)

    def rows(self) -> Iterator[tuple[int, bytes]]:
        """(chunk, counts): each chunk with a count, sparse as offsets and counts where that is shorter."""
        for k, part in enumerate(self.count.reshape(-1, min(_STEP, self.count.size))):
            at = np.flatnonzero(part)
            if len(at):
                sparse = at.astype(np.uint16).tobytes() + part[at].tobytes()
                yield k, sparse if len(sparse) < part.nbytes else part.tobytes()


def _batch(counts=(), chunks=()) -> pa.RecordBatch:
    n, m = len(counts), len(chunks)
    columns = [
        pa.array([c[0] for c in counts] + [None] * m, pa.string()), pa.array([c[1] for c in counts] + [None] * m, pa.binary()),
        pa.array([c[2] for c in counts] + [None] * m, pa.int64()), pa.array([None] * n + [c[0] for c in chunks], pa.int32()),
        pa.array([None] * n + [c[1] for c in chunks], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["lang", "phrase", "c", "chunk", "bits"])


def _sent(buckets: Buckets) -> Iterator[pa.RecordBatch]:
    rows = []
    for row in buckets.rows():
        rows.append(row)
        if len(rows) == 256:
            yield _batch(chunks=rows)
            rows = []
    if rows:
        yield _batch(chunks=rows)


def _counted(k: int, least: int, buckets: int, parts, own, run_bytes: int, held: int) -> Callable:
    """The pass for phrases of ``k`` words. ``parts``, ``own``: broadcast bitmaps of frequent parts and of full buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        following = Buckets(buckets, least) if k < LONGEST else None
        found: dict[tuple[str, bytes], int] = defaultdict(int)
        for lang, data in _runs(batches, run_bytes):
            ids: defaultdict[bytes, int] = defaultdict()
            ids.default_factory = ids.__len__
            ids[_MARK] = 0
            words = data.replace(_MARK, b" \xff ").split()
            at = np.fromiter(map(ids.__getitem__, words), np.int64, len(words))
            words, seed = list(ids), _seed(lang)
            hashes = np.array([xxhash.xxh3_64_intdigest(w, seed) for w in words], np.uint64)[at]
            # live[i]: the phrase of k words from i on holds no break and passes both bitmaps.
            spans = lambda size: [hashes[j : len(at) - size + 1 + j] for j in range(size)]  # noqa: E731, B023
            live = np.ones(max(0, len(at) - k + 1), bool)
            for j in range(k):
                live &= (at[j : len(at) - k + 1 + j] if len(live) else live) != 0
            if k > 1 and len(live):
                ok = _set(parts, _mixed(spans(k - 1)))
                live &= ok[:-1] & ok[1:]
                live[live] = _set(own, _mixed([x[live] for x in spans(k)]))
            if following is not None and len(live) > 1:
                pair = live[:-1] & live[1:]
                following.add(_mixed([x[pair] for x in spans(k + 1)]))
            start = np.flatnonzero(live)
            key = at[start]
            for j in range(1, k):
                if j > 1:
                    key = np.unique(key, return_inverse=True)[1]
                key = key * len(words) + at[start + j]
            _, first, n = np.unique(key, return_index=True, return_counts=True)
            for p, c in zip(start[first].tolist(), n.tolist(), strict=True):
                found[lang, b" ".join([words[w] for w in at[p : p + k].tolist()])] += c
            if len(found) > held:
                yield _batch([(*x, c) for x, c in found.items()])
                found.clear()
        yield _batch([(*x, c) for x, c in found.items()])
        if following is not None:
            yield from _sent(following)

    return run


def _set(bitmap, hashes: np.ndarray) -> np.ndarray:
    bits = np.frombuffer(bitmap.value, np.uint8)
    at = (hashes & np.uint64(bits.size * 8 - 1)).astype(np.int64)
    return (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1


def _hashed(buckets: int) -> Callable:
    """Marks the buckets of (lang, phrase) rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = Buckets(buckets, 1)
        for b in batches:
            sets = defaultdict(list)
            for lang, phrase in zip(b["lang"].to_pylist(), b["phrase"].to_pylist(), strict=True):
                sets[lang].append(phrase.split(b" "))
            for lang, phrases in sets.items():
                seed = _seed(lang)
                h = np.array([[xxhash.xxh3_64_intdigest(w, seed) for w in p] for p in phrases], np.uint64)
                marks.add(_mixed([h[:, j] for j in range(h.shape[1])]))
        yield from _sent(marks)

    return run


def _bitmap(rows: DataFrame, least: int, buckets: int):
    """A broadcast bitmap of the buckets whose counts in (chunk, bits) rows sum to ``least`` or more."""
    step, kind = min(_STEP, buckets), np.uint8 if least < 256 else np.uint32
    width = np.dtype(kind).itemsize

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for chunk, bits in zip(b["chunk"].to_pylist(), b["bits"].to_pylist(), strict=True):
                sums = total.setdefault(chunk, np.zeros(step, np.int64))
                if len(bits) == step * width:
                    sums += np.frombuffer(bits, kind)
                else:
                    n = len(bits) // (2 + width)
                    sums[np.frombuffer(bits, np.uint16, n)] += np.frombuffer(bits, kind, n, 2 * n)
        yield _batch(chunks=[(k, np.packbits(v >= least).tobytes()) for k, v in total.items()])

    out = np.zeros((buckets // step, step // 8), np.uint8)
    merged = rows.select("chunk", "bits").repartition("chunk").mapInArrow(merge, _PASS)
    for r in merged.select("chunk", "bits").collect():  # one bit a bucket
        out[r["chunk"]] = np.frombuffer(r["bits"], np.uint8)
    return rows.sparkSession.sparkContext.broadcast(out.tobytes())


def frequent_phrases(docs: DataFrame, least: int = 30, buckets: int = 1 << 24, run_bytes: int = RUN, held: int = HELD) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, words, a) of all phrases of 1 to 4 words found ``least`` times or more; (lang, n) of word counts)."""
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    levels, words, parts, own = [], None, None, None
    for k in range(1, LONGEST + 1):
        passed = stash(rows.mapInArrow(_counted(k, least, buckets, parts, own, run_bytes, held), _PASS), f"phrases{k}", "zstd")
        counts = passed.where("chunk is null").groupBy("lang", "phrase").agg(F.sum("c").alias("a"))
        if k == 1:
            words = stash(passed.where("chunk is null").groupBy("lang").agg(F.sum("c").alias("n")), "words")
        levels.append(stash(counts.where(F.col("a") >= least).withColumn("words", F.lit(k)), f"frequent{k}"))
        if k < LONGEST:
            own = _bitmap(passed.where("chunk is not null"), least, buckets)
            parts = _bitmap(levels[-1].mapInArrow(_hashed(buckets), _PASS), 1, buckets)
        drop_stash(passed)
    out = levels[0]
    for x in levels[1:]:
        out = out.unionByName(x)
    return out.withColumn("phrase", F.col("phrase").cast("string")), words


def _wide(name: str):
    return F.col(name).cast("decimal(20,0)")


def collocations(docs: DataFrame, least: int = 30, top: int = 2000, num: int = 80, den: int = 100, buckets: int = 1 << 24, salts: int = 64, **runs: int) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of 2 to 4 words of each language. ``runs``: bytes of a run, phrases held by a task."""
    found, words = frequent_phrases(docs, least, buckets, **runs)
    some = found.where("words > 1").withColumn("w", F.split("phrase", " "))
    part = lambda at, size: F.array_join(F.slice("w", at, size), " ")

    # The cut with the lowest score, then the fewest words in front. Each part is frequent, since its phrase is.
    cuts = some.select("lang", "phrase", "a", "w", "words", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("first"), part(F.col("k") + 1, F.col("words")).alias("rest"))
    count = lambda on, name: found.select("lang", F.col("phrase").alias(on), F.col("a").alias(name))
    cuts = cuts.join(count("first", "l"), ["lang", "first"]).join(count("rest", "r"), ["lang", "rest"])
    cuts = cuts.withColumns({"up": F.lit(2_000_000).cast("decimal(7,0)") * _wide("a"), "down": _wide("l") + _wide("r")})
    cuts = cuts.withColumn("score", F.expr("up div down"))
    scored = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"), F.first("a").alias("a"))

    # The most frequent longer phrase around each phrase decides whether it is dropped.
    inner = [F.when((F.col("words") > size) & (at + size - 1 <= F.col("words")), part(F.lit(at), F.lit(size))) for size in range(2, LONGEST) for at in range(1, LONGEST - size + 2)]
    around = some.where("words > 2").select("lang", F.col("a").alias("outer"), F.explode(F.array(*inner)).alias("phrase"))
    around = around.where("phrase is not null").groupBy("lang", "phrase").agg(F.max("outer").alias("outer"))
    left = scored.join(around, ["lang", "phrase"], "left").where(
        F.col("outer").isNull() | (F.lit(den).cast("decimal(10,0)") * _wide("outer") < F.lit(num).cast("decimal(10,0)") * _wide("a"))
    )

    best = [F.desc("cut.score"), F.desc("a"), F.col("phrase")]
    left = left.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(salts)))
    left = left.withColumn("rank", F.row_number().over(W.partitionBy("lang", "salt").orderBy(*best))).where(F.col("rank") <= top)
    left = left.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*best))).where(F.col("rank") <= top)
    out = left.join(words, "lang")
    return out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


QUERIES = {"op13_collocations": op13_collocations}
SQL = {
    "op13_collocations": r"""
WITH p AS (SELECT row_number() OVER () AS piece, lang, w FROM (SELECT lang, list_filter(string_split_regex(unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')), '[\x20\x09]+'), lambda x: x <> '') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, text FROM documents)) WHERE len(w) > 0),
g AS (SELECT lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, (VALUES (1), (2), (3), (4)) v(k) WHERE len(w) >= k)),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY 1),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 30),
s AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
x AS (SELECT lang, phrase, k, a, c, array_to_string(w[1:c], ' ') AS first, array_to_string(w[c + 1:], ' ') AS rest FROM s, (VALUES (1), (2), (3)) v(c) WHERE c < k),
y AS (SELECT x.lang, x.phrase, x.a, c, f1.a AS l, f2.a AS r, CAST((CAST(2000000 AS HUGEINT) * x.a) // (CAST(f1.a AS HUGEINT) + f2.a) AS BIGINT) AS score
  FROM x JOIN f f1 ON f1.lang = x.lang AND f1.phrase = first JOIN f f2 ON f2.lang = x.lang AND f2.phrase = rest),
z AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) AS o FROM y) WHERE o = 1),
o AS (SELECT lang, phrase, max(a) AS a FROM (SELECT lang, a, array_to_string(w[i:i + m - 1], ' ') AS phrase FROM s, (VALUES (2), (3)) v(m), (VALUES (1), (2), (3)) u(i) WHERE m < k AND i + m - 1 <= k) GROUP BY ALL),
t AS (SELECT z.* FROM z LEFT JOIN o ON o.lang = z.lang AND o.phrase = z.phrase WHERE o.a IS NULL OR CAST(100 AS HUGEINT) * o.a < CAST(80 AS HUGEINT) * z.a)
SELECT * FROM (SELECT t.lang, row_number() OVER (PARTITION BY t.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM t JOIN n ON n.lang = t.lang) WHERE rank <= 2000
"""
}
