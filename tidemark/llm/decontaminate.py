"""Benchmark decontamination by size-partitioned MinHash containment search, in DataFrame functions only.

The queries are short test items, the other side long documents, so the sketches are taken of the items. Items
are partitioned by the power of two of their shingle count, and each keeps its k least MinHash values, k from the
largest size of its partition: at containment t an item of n shingles may miss floor((1 - t) n) of them, so one of
any floor((1 - t) n) + 1 of its values lies in every document that contains it. A document's shingle hashes meet the
sketch values by an equality join, and each candidate pair is then verified on the shingles themselves.

Defined results: shingles are of ``words`` words (A-Z lower-cased); an item with fewer is one shingle of all its
words. Items without words or with a null item_id match nothing, as do null or empty texts and rows with a null
doc_id. Repeated rows count once: a pair is returned once. Empty tables give an empty table. Only doc_id, text
and item_id are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import lower_ascii, stash, table

#: Sketch or shingle tables of up to so many rows (some 100 bytes each) may be broadcast; larger ones are shuffled.
BROADCAST_ROWS = 500_000


def words_column(text: Column) -> Column:
    return F.filter(F.split(lower_ascii(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def _grams(words: Column, size: int, make) -> Column:
    """``make`` of the columns of each run of ``size`` words; an empty array if there are fewer."""
    runs = F.transform(F.sequence(F.lit(1), F.size(words) - (size - 1)), lambda i: make([F.get(words, i + (j - 1)) for j in range(size)]))
    return F.when(F.size(words) >= size, runs).otherwise(F.array().cast(f"array<{'bigint' if make is _hash else 'string'}>"))


def _hash(run: list[Column]) -> Column:
    return F.xxhash64(F.lit(len(run)), *run)


def _text(run: list[Column]) -> Column:
    return F.concat_ws(" ", *run)


def _small(df: DataFrame) -> DataFrame:
    """Broadcast a table read back from storage if its counted rows are few."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def item_grams(items: DataFrame, words: int) -> DataFrame:
    """(item_id, size, g, h, n): the distinct shingles of each item with their hash and number."""
    w = items.select(F.col("item_id").cast("long").alias("item_id"), words_column(F.col("text")).alias("w"))
    w = w.where("item_id is not null and size(w) > 0").withColumn("size", F.least(F.lit(words), F.size("w")))
    whole = F.array(F.concat_ws(" ", "w"))
    g = w.select("item_id", "size", F.explode(F.when(F.size("w") < words, whole).otherwise(_grams(F.col("w"), words, _text))).alias("g"))
    g = g.distinct().withColumn("h", F.xxhash64(F.col("size"), F.split("g", " ")))
    return g.join(g.groupBy("item_id").agg(F.count("*").alias("n")), "item_id")


def sketches(grams: DataFrame, num: int, den: int) -> DataFrame:
    """(size, h, item_id): the least MinHash values of each item, as many as its size partition needs."""
    by_hash = F.row_number().over(W.partitionBy("item_id").orderBy(F.xxhash64(F.lit(9176), "h"), "g"))
    largest = F.pow(F.lit(2), F.length(F.bin("n"))).cast("long") - 1  # of the item's partition: all sizes of as many bits
    k = F.floor(largest * (den - num) / F.lit(den)) + 1
    return grams.withColumn("rank", by_hash).where(F.col("rank") <= k).select("size", "h", "item_id")


def find_leaks(docs: DataFrame, items: DataFrame, words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """(doc_id, item_id, n_found, n_item): the pairs in which a document has at least num/den of an item's shingles."""
    grams = stash(item_grams(items, words), "grams")
    sketch = _small(stash(sketches(grams, num, den), "sketches"))
    sizes = [r["size"] for r in grams.select("size").distinct().orderBy("size").collect()] or [words]  # at most ``words``
    w = docs.select(F.col("doc_id").cast("long").alias("doc_id"), words_column(F.col("text")).alias("w"))
    w = w.where("doc_id is not null")

    def exploded(make, name: str) -> DataFrame:
        parts = [
            w.select("doc_id", F.lit(s).alias("size"), F.explode(F.array_distinct(_grams(F.col("w"), s, make))).alias(name))
            for s in sizes
        ]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    pairs = stash(exploded(_hash, "h").join(sketch, ["size", "h"]).select("doc_id", "item_id").distinct(), "candidates")
    w = w.join(pairs.select("doc_id").distinct(), "doc_id", "left_semi")
    found = exploded(_text, "g").distinct().join(_small(grams), ["size", "g"])
    found = found.groupBy("doc_id", "item_id").agg(F.count("*").alias("n_found"), F.first("n").alias("n_item"))
    found = found.where(F.col("n_found") * den >= F.col("n_item") * num)
    return found.join(pairs, ["doc_id", "item_id"], "left_semi").select("doc_id", "item_id", "n_found", "n_item")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_W = r"list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '')"
SQL = {
    "op4_decontaminate": f"""
WITH item AS (SELECT item_id, {_W} AS w FROM benchmark WHERE item_id IS NOT NULL),
doc AS (SELECT doc_id, {_W} AS w FROM documents WHERE doc_id IS NOT NULL),
ig AS (SELECT DISTINCT item_id, array_to_string(list_slice(w, i, i + least(5, len(w)) - 1), ' ') AS g
       FROM (SELECT item_id, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i FROM item WHERE len(w) > 0)),
dg AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + k - 1), ' ') AS g
       FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
             FROM doc, (SELECT DISTINCT least(5, len(w)) AS k FROM item WHERE len(w) > 0) WHERE len(w) >= k)),
n AS (SELECT item_id, count(*) AS n_item FROM ig GROUP BY item_id)
SELECT doc_id, ig.item_id, count(*) AS n_found, any_value(n_item) AS n_item
FROM dg JOIN ig ON dg.g = ig.g JOIN n ON n.item_id = ig.item_id
GROUP BY doc_id, ig.item_id HAVING count(*) * 100 >= any_value(n_item) * 80
"""
}
QUERIES = {"op4_decontaminate": op4_decontaminate}
