"""N-gram Jaccard join by parity sketches.

A document is the set of its distinct word shingles, as 64-bit hashes. Sets of equal content become one class
first. For the classes, size bands bound the symmetric difference D that a link allows. A band cuts the hash range
into more than D parts; the parity (XOR) of the fingerprints in a part is one sketch word, so differing words are at
most differing shingles, and two linked sets must agree in some part. Parts are therefore joined by equality:
every set enters the scheme of its own band and, as the smaller partner, that of the next.

A band has spare parts, E of them, so two linked sets agree in E + 1 parts at least. All parts stand in one order: empty
parts first, then parts by how many sets agree in them. Each set leaves its first E parts out, and no link is lost: of the
parts in which two sets agree the last one has E before it in both. So what many documents share by chance or by
quotation (a passage, a frequent shingle) costs nothing, and sets that agree in E parts or fewer go altogether.

A bucket of agreeing sets never emits its pairs. Its smallest member is verified against the others (exactly, on
shingle sets, after a bound by bit sketches), and components are formed. Only buckets that still hold several components go on: their members meet
in blocks of bounded size, where the Hamming distance of parity bit sketches drops every pair whose sets must
differ too much, and what is left across components is verified exactly. No link between components is lost.
Large groups of copies and the smallest members of large buckets are hot keys; they take a broadcast of checked size.

Defined results: a null or empty text has no shingles and links with nothing. Rows with a null doc_id take no part;
their component is null. Rows that repeat a doc_id stand for one document, linked through each of its texts. An
empty table gives an empty table. Only doc_id and text are read, whatever other columns are called.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import components, drop_stash, join_hot, stash, table, trimmed

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_TABLE = mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
_BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_BASE = _U(0x9E3779B97F4A7C15)
_BACK = _U(pow(int(_BASE), -1, 1 << 64))


class Powers:
    """Powers of a base and of its inverse modulo 2^64, as many as were asked for."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, _U)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            self.up, self.down = (np.cumprod(np.append(_U(1), np.full(n - 1, x, _U)), dtype=_U) for x in (_BASE, _BACK))
        return self.up, self.down


_POWERS = Powers()


def word_hashes(raw: bytes, piece: int = 1 << 16) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of a lower-cased text, and where each starts; long texts are read piece by piece."""
    out, first, at = [np.zeros(0, _U)], [np.zeros(0, np.int64)], 0
    while at < len(raw):
        end = at + piece
        while end < len(raw) and not _BLANK[raw[end]]:
            end += 1
        b = np.frombuffer(raw, np.uint8, min(end, len(raw)) - at, at)
        blank = np.concatenate(([True], _BLANK[b], [True]))
        starts = np.flatnonzero(blank[:-1] & ~blank[1:])
        ends = np.flatnonzero(~blank[:-1] & blank[1:])
        up, down = _POWERS(len(b))
        sums = np.append(_U(0), np.cumsum(_TABLE[b] * up[: len(b)], dtype=_U))
        out.append(mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(_U)))
        first.append(starts + at)
        at = end
    return np.concatenate(out), np.concatenate(first)


def distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.append(True, x[1:] != x[:-1])] if len(x) else x


def shingles(h: np.ndarray, words: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of ``words`` words; of all the words if there are fewer."""
    if not len(h):
        return h
    k = min(words, len(h))
    n = len(h) - k + 1
    out = h[:n].copy()
    for i in range(1, k):
        out *= _U(0xD6E8FEB86659FD93)
        out += h[i : n + i]
    return distinct(mix(out + _U(k)))


def shingle_sets(texts: list[str | None], words: int, most: int = 1 << 16) -> Iterator[np.ndarray]:
    """The shingle set of each text; short texts are hashed together."""
    lo = 0
    while lo < len(texts):
        raws, size = [], 0
        while lo < len(texts) and (not raws or size + len(texts[lo] or "") <= most):
            raws.append((texts[lo] or "").encode("utf-8", "surrogatepass").lower())
            size += len(raws[-1])
            lo += 1
        h, starts = word_hashes(b" ".join(raws))
        at = 0
        for end in np.searchsorted(starts, np.cumsum([len(r) + 1 for r in raws])).tolist():
            yield shingles(h[at:end], words)
            at = end


def bands(num: int, den: int, top: int = 1 << 40) -> list[tuple[int, int, int, int]]:
    """(least size, largest size, D, spare parts) of every band of sizes."""
    out, lo = [], 1
    while lo < top:
        hi = max(lo + 1, lo * 3 // 2) - 1
        d = (den - num) * 2 * hi // (den + num)
        out.append((lo, hi, d, (d + 1) // 6))
        lo = hi + 1
    return out


def sketch_parts(u: np.ndarray, num: int, den: int, scheme: list[tuple[int, int, int, int]]) -> Iterator[tuple[int, int, np.ndarray]]:
    """For each band that a set takes part in: its number, the parts that may still be left out, and the join keys of the
    parts of the set's parity sketch. The last 8 of a key's 56 bits are the band's number."""
    n = len(u)
    own = next(i for i, b in enumerate(scheme) if n <= b[1])
    fingerprints = mix(u ^ _U(0x5851F42D4C957F2D))
    for k in range(own, len(scheme)):
        lo, _, d, spare = scheme[k]
        if n * den < lo * num:  # too small for any set of this band
            break
        if d == 0:  # only equal sets, which are one class already
            continue
        m = d + 1 + spare
        part = ((u >> _U(32)) * _U(m) >> _U(32)).astype(np.int64)
        count = np.bincount(part, minlength=m)
        full = np.flatnonzero(count)
        words = np.zeros(m, _U)
        words[full] = np.bitwise_xor.reduceat(fingerprints, (np.cumsum(count) - count)[full])
        gone = min(spare, m - len(full))
        use = full if len(full) + gone == m else np.sort(np.append(full, np.flatnonzero(count == 0)[gone:]))
        yield k, spare - gone, (mix(words[use] ^ mix(use.astype(_U) * _U(4096) + _U(k + 1))) >> _U(16) << _U(8)) + _U(k)


def sketch_keys(u: np.ndarray, num: int, den: int, scheme: list[tuple[int, int, int, int]]) -> np.ndarray:
    """The join keys of a set for all bands that it takes part in."""
    return np.concatenate([np.zeros(0, _U), *(keys for _, _, keys in sketch_parts(u, num, den, scheme))])


def bit_sketch(u: np.ndarray) -> bytes:
    """Parity bits of a set, at least four for each shingle, a power of two of them."""
    bits = max(512, 1 << (4 * len(u) - 1).bit_length())
    return np.packbits(np.bincount((u % _U(bits)).astype(np.int64), minlength=bits) & 1).tobytes()


def fold(sketch: np.ndarray, n_bytes: int) -> np.ndarray:
    """The sketch with fewer bits: parities add."""
    while len(sketch) > n_bytes:
        half = len(sketch) // 2
        sketch = sketch[:half] ^ sketch[half:]
    return sketch


#: Bits of a table of document ids, at any size of the corpus.
_MARKS = 1 << 23


def _bit():
    return F.pmod(F.xxhash64("doc_id"), F.lit(_MARKS)).alias("at")


def marks_of(ids: DataFrame):
    """A broadcast of ``_MARKS`` bits, set where the ids (doc_id) of a table fall. Other ids may fall there too."""
    at = ids.select(_bit()).select(F.shiftright("at", 6).alias("word"), F.col("at").bitwiseAND(63).cast("int").alias("bit"))
    words = at.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("mask")).toArrow()  # at most _MARKS / 64 rows
    out = np.zeros(_MARKS // 64, np.int64)
    out[words["word"].to_numpy()] = words["mask"].to_numpy()
    return ids.sparkSession.sparkContext.broadcast(out)


def _on(marks, b: pa.RecordBatch) -> np.ndarray:
    at = b["at"].to_numpy()
    return (marks.value[at >> 6] >> (at & 63)) & 1 == 1


def _held(marks):
    """mapInArrow over (doc_id, text, at): the rows whose bit is set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(_on(marks, b))).select(["doc_id", "text"])

    return run


def _per_text(words: int, make, types: list[tuple[str, pa.DataType]], marks=None, inside: bool = True):
    """mapInArrow over (doc_id, text); ``make`` turns (doc_id, set) into any number of rows of columns. With ``marks`` over
    (doc_id, text, at), and only for rows whose bit is set, or with ``inside`` false isn't."""
    schema = pa.schema(types)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if marks is not None:
                b = b.filter(pa.array(_on(marks, b) == inside))
            docs, texts = b["doc_id"].to_pylist(), b["text"].to_pylist()
            for lo in range(0, len(docs), 500):
                sets = list(shingle_sets(texts[lo : lo + 500], words))
                yield pa.RecordBatch.from_arrays(make(docs[lo : lo + 500], sets), schema=schema)

    return trimmed(run)


def _signatures(docs, sets):
    u64 = lambda f: pa.array(np.array([f(u) for u in sets], dtype=_U).view(np.int64))
    n = pa.array([len(u) for u in sets], pa.int64())
    s1, s2 = u64(lambda u: u.sum(dtype=_U)), u64(lambda u: mix(u ^ _U(77)).sum(dtype=_U))
    bits = pa.array([bit_sketch(u) if len(u) else None for u in sets], pa.binary())
    return [pa.array(docs, pa.int64()), n, s1, s2, bits]


def _sets(docs, sets):
    return [pa.array(docs, pa.int64()), pa.array([u.tobytes() for u in sets], pa.binary())]


def _index(num: int, den: int):
    scheme = bands(num, den)

    def make(docs, sets):
        parts = [(doc, left, keys) for doc, u in zip(docs, sets, strict=True) for _, left, keys in sketch_parts(u, num, den, scheme)]
        sizes = [len(keys) for _, _, keys in parts]
        each = lambda at, kind: pa.array(np.repeat(np.array([p[at] for p in parts], kind), sizes))
        return [pa.array(np.concatenate([np.zeros(0, _U), *(keys for _, _, keys in parts)]).view(np.int64)), each(0, np.int64), each(1, np.int32)]

    return make


def likely(pairs: DataFrame, sketches: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) that the Hamming distance of their bit sketches doesn't rule out."""
    one, two = (sketches.select(F.col("doc_id").alias(x), F.col("n").alias(f"n{x}"), F.col("bits").alias(f"bits{x}")) for x in "ab")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            good = []
            for x, y, nx, ny in zip(*(b[c].to_pylist() for c in ("bitsa", "bitsb", "na", "nb")), strict=True):
                x, y = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
                width = min(len(x), len(y))
                far = int(np.bitwise_count(fold(x, width) ^ fold(y, width)).sum())
                good.append((den + num) * far <= (den - num) * (nx + ny) and den * min(nx, ny) >= num * max(nx, ny))
            keep = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([b["a"].filter(keep), b["b"].filter(keep)], names=["a", "b"])

    # A document with several texts has several sketches; the pair stays if any two of them are near.
    return _both(pairs, one, two, "bitsa").mapInArrow(trimmed(run), "a long, b long").distinct()


def _both(pairs: DataFrame, one: DataFrame, two: DataFrame, weight: str) -> DataFrame:
    """Pairs (a, b) with the columns of a and of b. The smallest member of a bucket, a, may have very many partners."""
    many = pairs.groupBy("a").count().where("count >= 1000").select("a")
    return join_hot(pairs, one, "a", many, weight).join(two, "b")


def verify(pairs: DataFrame, rows: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose shingle sets are similar enough, by exact intersection."""
    used = stash(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "used")
    few = used.count() <= _MARKS // 4  # else most bits are set, and texts are cheaper to move than sets
    texts = rows.select("doc_id", "text", _bit()) if few else rows.join(used.hint("merge"), "doc_id", "left_semi")
    types = [("doc_id", pa.int64()), ("u", pa.binary())]
    sets = texts.mapInArrow(_per_text(words, _sets, types, marks_of(used) if few else None), "doc_id long, u binary")
    one = sets.select(F.col("doc_id").alias("a"), F.col("u").alias("ua"))
    two = sets.select(F.col("doc_id").alias("b"), F.col("u").alias("ub"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            good = []
            for x, y in zip(b["ua"].to_pylist(), b["ub"].to_pylist(), strict=True):
                x, y = np.frombuffer(x, _U), np.frombuffer(y, _U)
                if min(len(x), len(y)) * den < max(len(x), len(y)) * num:
                    good.append(False)
                    continue
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(both > 0 and den * both >= num * (len(x) + len(y) - both))
            keep = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([b["a"].filter(keep), b["b"].filter(keep)], names=["a", "b"])

    return _both(pairs, one, two, "ua").select("a", "b", "ua", "ub").mapInArrow(trimmed(run), "a long, b long")


def _candidates(ids, comp, n, side, raw, small, same: bool, num: int, den: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of positions across components that the bit sketches can't rule out, and how far apart the sketches are.

    ``small`` marks the sets outside the largest component; every pair holds one of them.
    """
    size = np.array([len(x) for x in raw])
    out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    for width in np.unique(size):  # a pair is compared at the width of its smaller sketch
        at = np.flatnonzero(size >= width)
        at = at[np.argsort(~small[at], kind="stable")]
        bits = np.stack([fold(raw[r], int(width)) for r in at]).view(_U)
        for row in range(int(small[at].sum())):
            r, rest = at[row], at[row + 1 :]
            far = np.bitwise_count(bits[row + 1 :] ^ bits[row]).sum(1, dtype=np.int64)
            total = n[rest] + n[r]
            ok = ((den + num) * far <= (den - num) * total) & (comp[rest] != comp[r])
            ok &= np.minimum(n[rest], n[r]) * den >= np.maximum(n[rest], n[r]) * num
            ok &= (np.minimum(size[rest], size[r]) == width) & (ids[rest] != ids[r])
            if not same:
                ok &= side[rest] != side[r]
            if ok.any():
                out.append((np.full(ok.sum(), r), rest[ok], far[ok] / total[ok]))
    return tuple(map(np.concatenate, zip(*out, strict=True)))


def _blocks(num: int, den: int, most: int):
    """Within a block pair of one bucket: for each set outside the largest component the ``most`` likeliest partners in
    other components, as rows (a, b, key); a row with the key alone says that there are more."""

    def run(group: pa.Table) -> pa.Table:
        ids, comp, n, side = (group[c].to_numpy() for c in ("id", "component", "n", "side"))
        raw = [np.frombuffer(x, np.uint8) for x in group["bits"].to_pylist()]
        key, same = group["key"][0].as_py(), bool(group["i"][0].as_py() == group["j"][0].as_py())
        names, counts = np.unique(comp, return_counts=True)
        small = comp != names[counts.argmax()]
        x, y, far = _candidates(ids, comp, n, side, raw, small, same, num, den)
        who = np.concatenate((x[small[x]], y[small[y]]))
        pair = np.concatenate((np.flatnonzero(small[x]), np.flatnonzero(small[y])))
        order = np.lexsort((far[pair], who))
        who, pair = who[order], pair[order]
        opens = np.flatnonzero(np.append(True, who[1:] != who[:-1])) if len(who) else who
        rank = np.arange(len(who)) - np.repeat(opens, np.diff(np.append(opens, len(who))))
        use = np.unique(pair[rank < most])
        a, b = (np.append(least(ids[x[use]], ids[y[use]]), 0) for least in (np.minimum, np.maximum))
        more = bool((rank >= most).any())
        gone = np.append(np.zeros(len(use), bool), True)
        return pa.table({"a": pa.array(a, mask=gone), "b": pa.array(b, mask=gone), "key": pa.array([key] * len(a), pa.int64())}).slice(0, len(use) + more)

    return run


def jaccard_classes(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100, block: int = 512) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of a documents table."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    names = [("doc_id", pa.int64()), ("n", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("bits", pa.binary())]
    sets = rows.mapInArrow(_per_text(words, _signatures, names), "doc_id long, n long, s1 long, s2 long, bits binary")
    sets = stash(sets, "sets")
    real = sets.where("n > 0 and doc_id is not null")
    one_id = ["n", "s1", "s2"]
    copies = stash(real.groupBy(*one_id).agg(F.min("doc_id").alias("rep"), F.count("*").alias("g")).where("g > 1"), "copies")
    same = join_hot(real.select("doc_id", *one_id), copies, one_id, copies.where("g >= 1000").select(*one_id), None, "left")
    members = stash(same.select("doc_id", F.coalesce("rep", "doc_id").alias("rep")), "members")
    drop_stash(copies)
    # A document with several texts ties their classes together.
    ties = members.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a < b").select("a", "b")

    # Texts stay where they are, but for those of ids that may be no representative: only these are looked up.
    reps = members.select(F.col("rep").alias("doc_id")).distinct()
    others = marks_of(members.select("doc_id").distinct().join(reps, "doc_id", "left_anti"))
    texts = rows.where("doc_id is not null").select("doc_id", "text", _bit())
    unsure = texts.mapInArrow(trimmed(_held(others)), "doc_id long, text string").join(reps.hint("merge"), "doc_id", "left_semi")
    types, ddl = [("key", pa.int64()), ("id", pa.int64()), ("left", pa.int32())], "key long, id long, left int"
    index = texts.mapInArrow(_per_text(words, _index(num, den), types, others, False), ddl).unionByName(unsure.mapInArrow(_per_text(words, _index(num, den), types), ddl))
    index = index.repartition("key")  # one exchange serves both the buckets' sizes and the join with them
    sizes = index.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count("*").alias("g"), F.max("left").alias("most"))
    sizes = sizes.where("lo < hi and most >= 0")  # always so; the column keeps both readers of the exchange alike
    agree = index.join(sizes.select("key", "g").hint("shuffle_hash"), "key")
    band = W.partitionBy("id", F.col("key").bitwiseAND(255))
    agree = agree.withColumn("rank", F.row_number().over(band.orderBy(F.desc("g"), "key"))).withColumn("left", F.min("left").over(band))
    agree = stash(agree.where("rank > left").select("key", "id").distinct(), "agree")
    hubs = agree.groupBy("key").agg(F.min("id").alias("hub"), F.max("id").alias("last")).where("hub < last").select("key", "hub")
    shared = stash(agree.join(hubs.hint("shuffle_hash"), "key"), "buckets")
    drop_stash(agree)

    pairs = stash(shared.where("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct(), "pairs")
    sketches = real.select("doc_id", "n", "bits")
    stars = stash(likely(pairs, sketches, num, den), "stars")
    drop_stash(pairs)
    good = stash(verify(stars, rows, words, num, den).unionByName(ties), "links")
    drop_stash(stars)
    parts = stash(components(good), "parts")
    drop_stash(good)

    # Buckets that still hold several components, with more in them than the pairs seen so far. In the first round each
    # set meets others only in its largest bucket, later in all; each names its likeliest partners, in each round more.
    wide = sketches.withColumnRenamed("doc_id", "id")
    round_, cut = 0, None
    while True:
        inside = shared.join(parts, "id", "left").withColumn("component", F.coalesce("component", "id"))
        if cut is not None:
            inside = inside.join(cut, "key", "left_semi")
        held = [F.bit_xor(F.xxhash64("id", F.lit(salt))).alias(f"m{salt}") for salt in (1, 2)]
        open_ = inside.groupBy("key").agg(F.min("component").alias("c0"), F.max("component").alias("c1"), F.count("*").alias("g"), *held)
        # Sets that are alike agree in many parts: of the buckets with the same members one is enough.
        open_ = open_.where("c0 < c1 and g > 2").groupBy("g", "m1", "m2").agg(F.min("key").alias("key"))
        inside = inside.join(open_.select("key", "g"), "key").select("key", "id", "component", "g")
        if round_ == 0:
            largest = F.row_number().over(W.partitionBy("id").orderBy(F.desc("g"), "key"))
            inside = inside.withColumn("rank", largest).where("rank = 1").drop("rank")
        inside = stash(inside.withColumn("blocks", F.ceil(F.col("g") / block).cast("int")), "open")
        mine = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
        dealt = inside.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        dealt = dealt.select(
            "key", "id", "component", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
            (F.col("mine") > F.col("other")).cast("int").alias("side"),
        )
        run = _blocks(num, den, 4 * 16 ** (round_ - 1) if round_ else 1)
        near = stash(dealt.join(wide, "id").groupBy("key", "i", "j").applyInArrow(run, "a long, b long, key long"), "near")
        drop_stash(inside)
        more = stash(verify(near.where("a is not null").select("a", "b").distinct(), rows, words, num, den), "links")
        last, cut = cut, stash(near.where("a is null").select("key").distinct(), "cut") if round_ else None
        for used in (near, last):
            if used is not None:
                drop_stash(used)
        if more.limit(1).count():
            before, parts = parts, stash(components(parts.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(more)), "parts")
            drop_stash(before)
        drop_stash(more)
        if round_ and cut.limit(1).count() == 0:
            drop_stash(cut)
            break
        round_ += 1
    drop_stash(shared)
    final = parts

    found = members.distinct().join(final.withColumnRenamed("id", "rep"), "rep", "left")
    found = found.groupBy("doc_id").agg(F.min(F.coalesce("component", "rep")).alias("component_id"))
    out = sets.select("doc_id", F.col("n").alias("n_shingles")).join(found, "doc_id", "left")
    out = stash(out.withColumn("component_id", F.coalesce("component_id", "doc_id")), "classes")
    for used in (sets, members, parts):
        drop_stash(used)
    return out


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(table(spark, sf_dir, "documents"), words=4, num=85, den=100)


QUERIES = {"op2_jaccard_join": op2_jaccard_join}
SQL: dict[str, str] = {}
