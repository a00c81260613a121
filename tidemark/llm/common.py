"""Small helpers that the operators of this package share."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word and line rules, as a set of characters and as a pattern.
BLANKS = " \t\n\x0b\x0c\r"
#: Settings of a ``stash`` write: its shuffle files go when it is done, and texts reach Python in batches of bounded bytes.
_WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxBytesPerBatch": "2m"}
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see.

    Read from ``spark.checkpoint.dir`` or the context's checkpoint folder; only where neither is set
    (local tests) a temporary folder is made and set.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="shared-"))
        named = spark.sparkContext.getCheckpointDir()
    return named.rstrip("/")


def stash(df: DataFrame, tag: str, codec: str = "snappy") -> DataFrame:
    """Write a table into the shared folder and read it back: cuts lineage, survives lost executors.

    The write's own shuffle files go when it is done, since nothing reads them again.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    before = {k: spark.conf.get(k) for k in _WRITING if k in spark.conf.getAll}
    for k, v in _WRITING.items():
        spark.conf.set(k, v)
    try:
        df.write.option("compression", codec).parquet(path)
    finally:
        for k in _WRITING:
            spark.conf.set(k, before[k]) if k in before else spark.conf.unset(k)
    return spark.read.schema(df.schema).parquet(path)


def drop_stash(df: DataFrame) -> None:
    """Delete the files behind a table that ``stash`` made, once nothing reads it any more."""
    spark = df.sparkSession
    for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def trimmed(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function for mapInArrow that returns what it freed to the system when its input ends.

    Spark keeps as many Python workers as ever ran at once in an executor and uses them in turn; each would go on
    holding the most that any of its tasks took.
    """

    def out(batches: Iterator) -> Iterator:
        import pyarrow as pa

        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
        if trim is not None:
            trim(0)

    return out


def join_hot(rows: DataFrame, side: DataFrame, on, hot: DataFrame, weight: str | None = None, how: str = "inner", most: int = 32 << 20) -> DataFrame:
    """``rows`` joined with ``side`` on key columns of which ``hot`` lists those with very many rows.

    Rows of hot keys take a broadcast of their part of ``side``, all others the shuffle, so no key gathers its rows in one
    task. The part is broadcast only if it holds at most ``most`` bytes: the column ``weight`` and 64 for the rest of a row.
    """
    mine = side.join(hot, on, "left_semi")
    size = F.lit(64) + (F.octet_length(weight) if weight else F.lit(0))
    held = mine.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    if not 0 < held <= most:
        return rows.join(side, on, how)
    few = F.broadcast(mine)
    keys = F.broadcast(mine.select(*([on] if isinstance(on, str) else on)).distinct())
    return rows.join(few, on).unionByName(rows.join(keys, on, "left_anti").join(side, on, how))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: str | None) -> list[bytes]:
    """Words of a text with A-Z lower-cased. Bytes split at exactly the six blanks of the word rule."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def lower_ascii(col):
    """A-Z to lower case and nothing else (``lower`` would also fold other alphabets)."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def let(value, then):
    """``then(value)`` with the value computed once for a row, also where lambdas use it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def prefix_sums(numbers, block: int = 128):
    """The sum of all numbers before each one. Sums over blocks keep the work small for long arrays."""
    total = lambda a: F.aggregate(a, F.lit(0), lambda x, y: x + y)
    block_of = lambda i: F.floor(i / F.lit(block)).cast("int")

    def run(ls):
        blocks = F.sequence(F.lit(0), block_of(F.size(ls) - 1))
        sums = F.transform(blocks, lambda b: total(F.slice(ls, b * block + 1, F.lit(block))))
        before = let(sums, lambda s: F.transform(F.sequence(F.lit(0), F.size(s) - 1), lambda b: total(F.slice(s, F.lit(1), b))))
        at = lambda i, b: F.get(b, block_of(i)) + total(F.slice(ls, block_of(i) * block + 1, i % block))
        return let(before, lambda b: F.transform(F.sequence(F.lit(0), F.size(ls) - 1), lambda i: at(i, b)))

    return F.when(F.size(numbers) > 0, let(numbers, run)).otherwise(F.array().cast("array<int>"))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an edge table, as rows (id, component) for every id that has an edge.

    ``component`` is the smallest id that can be reached. Large-star and small-star steps alternate until
    the edges stay as they are; each step is two aggregations with partial sums and a join, so a hub with
    very many edges is never gathered in one task. Edges with a null end and loops count for nothing.
    """
    star = edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).where("u <> v")
    star = stash(star.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    while True:
        # Large star: every larger neighbour of u is tied to the least of u's neighbours and u.
        both = star.unionByName(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        # Small star: u and its smaller neighbours are tied to the least of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        tied = large.join(least, "u")
        small = tied.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
        nxt = stash(small.where("u <> v").distinct(), "edges")
        mark = nxt.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        drop_stash(star)
        star = nxt
        if mark == before:
            break
        before = mark
    return star.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("component")).unionByName(
        star.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )


#: Bytes of Latin-1 text that both tokenizer libraries are known to cut alike.
_PLAIN = bytes(range(0x20, 0x7F)) + b"\n" + bytes(range(0xC0, 0x100))


class Subwords:
    """Ids of the byte-level BPE vocabulary, equal to those of the ``tokenizers`` library.

    ``json_path`` and ``rank_path`` name the same vocabulary. Plain Latin text takes the faster library;
    text with other characters or with a special token's string goes through ``tokenizers`` itself.
    """

    def __init__(self, json_path: str, rank_path: str, pattern: str):
        import base64

        import tiktoken
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(json_path)
        with open(rank_path, "rb") as f:
            ranks = {base64.b64decode(k): int(v) for k, v in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        (self.blank_line,) = self.fast.encode_ordinary("\n\n")

    def encode(self, text: str) -> list[int]:
        try:
            plain = not text.encode("latin-1").translate(None, _PLAIN) and "<|" not in text
        except UnicodeEncodeError:
            plain = False
        return self.fast.encode_ordinary(text) if plain else self.slow.encode(text, add_special_tokens=False).ids

    def encode_words(self, words):
        """Ids of words without blanks (a list or an Arrow array), each as it stands after a space: all ids, and where each word's end."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        if not len(words):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        arrow = isinstance(words, pa.Array)
        text = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), "\n\n ")[0].as_py() if arrow else "\n\n ".join(words)
        ids = np.array(self.fast.encode_ordinary(" " + text), dtype=np.int64)
        gap = ids == self.blank_line
        if int(gap.sum()) != len(words) - 1:  # blanks of other alphabets: one word at a time
            each = [self.fast.encode_ordinary(" " + w) for w in (words.to_pylist() if arrow else words)]
            return np.array([i for e in each for i in e], dtype=np.int64), np.cumsum([len(e) for e in each])
        ends = np.append(np.flatnonzero(gap), len(ids)) - np.arange(len(words))
        return ids[~gap], ends


_SUBWORDS: dict[tuple, Subwords] = {}


def subwords(json_path: str, rank_path: str, pattern: str) -> Subwords:
    """One encoder for each Python worker."""
    key = (json_path, rank_path)
    if key not in _SUBWORDS:
        _SUBWORDS[key] = Subwords(json_path, rank_path, pattern)
    return _SUBWORDS[key]
