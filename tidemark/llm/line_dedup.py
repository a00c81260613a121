"""Line de-duplication over a range-partitioned table of line hashes.

Every line that is long enough becomes one row (128-bit hash of its key, document, position). The rows are
range-partitioned by hash and document and sorted inside each partition, the largest document first, so that
one pass meets the keeper of a line before its other holders and needs to remember only the few rows that
wait for the document count to reach its minimum. A very frequent line covers several partitions; what a
partition can't know about the lines at its two ends is settled by summaries, of which each partition has
at most two. The result is a compressed bitmap of kept lines for each document that loses any: no text moves.

Defined results: a null or empty text is one empty line. Rows with a null doc_id take no part and keep all
lines. Rows that repeat a doc_id are one document where documents are counted. An empty table gives an
empty table. Other columns are carried through ``apply_keep_bitmaps`` unchanged, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BLANKS, stash, table, trimmed

_LINES = "h1 long, h2 long, doc long, th long, pos int"
_FOUND = "kind int, h1 long, h2 long, doc long, th long, pos long"
DROP, OPEN, SUMMARY = 0, 1, 2


def _hash_lines(min_chars: int):
    schema = pa.schema([(n, pa.int64()) for n in ("h1", "h2", "doc", "th")] + [("pos", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, doc, th, pos = [], [], [], []
            for d, h, text in zip(b["doc"].to_pylist(), b["th"].to_pylist(), b["text"].to_pylist(), strict=True):
                if text is None or len(text) < min_chars:
                    continue
                for i, line in enumerate(text.split("\n")):
                    if len(line) >= min_chars and len(key := line.strip(BLANKS)) >= min_chars:
                        raw.append(xxhash.xxh3_128_digest(key.encode("utf-8", "surrogatepass").lower()))
                        doc.append(d)
                        th.append(h)
                        pos.append(i)
            h = np.frombuffer(b"".join(raw), dtype="<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ascontiguousarray(h[:, 0])), pa.array(np.ascontiguousarray(h[:, 1])),
                 pa.array(doc, pa.int64()), pa.array(th, pa.int64()), pa.array(pos, pa.int32())],
                schema=schema,
            )

    return run


def _stream(min_docs: int):
    """Over one sorted partition: certain drops, rows of the lines at its ends, and summaries of those."""
    schema = pa.schema([("kind", pa.int32())] + [(n, pa.int64()) for n in ("h1", "h2", "doc", "th", "pos")])

    def batch(kind, h1, h2, doc, th, pos):
        n = len(doc)
        fill = lambda x: pa.array(np.broadcast_to(np.asarray(x, dtype=np.int64), n))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, kind, np.int32)), *map(fill, (h1, h2, doc, th, pos))], schema=schema
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = top = last_doc = None  # the run that goes on: its key, its largest and its latest document
        seen, first = 0, True  # documents in it so far; whether it is the partition's first
        wait: list[tuple] = []  # its rows that are dropped only if enough documents follow
        for b in batches:
            if not b.num_rows:
                continue
            h1, h2, doc, th, pos = (b[n].to_numpy(zero_copy_only=False) for n in ("h1", "h2", "doc", "th", "pos"))
            edge = np.empty(len(doc), bool)
            edge[0] = key != (h1[0], h2[0])
            edge[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
            starts = np.flatnonzero(edge)
            if edge[0] is np.False_ or not edge[0]:
                starts = np.insert(starts, 0, 0)
            stops = np.append(starts[1:], len(doc))
            fresh = np.empty(len(doc), bool)
            fresh[0] = edge[0] or doc[0] != last_doc
            fresh[1:] = edge[1:] | (doc[1:] != doc[:-1])
            count = np.cumsum(fresh)
            order = count - np.repeat(count[starts] - fresh[starts], stops - starts)  # the document's rank in its run
            if not edge[0]:
                order[: stops[0]] += seen
            totals = order[stops - 1]
            if edge[0] and key is not None:  # the run before ended with the batch before
                if first:
                    yield batch(SUMMARY, key[0], key[1], [top], 0, seen)
                first, wait = False, []
            head = 0
            if first or not edge[0]:
                if edge[0]:
                    top = doc[0]
                key, seen, last_doc = (h1[0], h2[0]), int(totals[0]), doc[stops[0] - 1]
                s = slice(0, stops[0])
                if first:
                    yield batch(OPEN, key[0], key[1], doc[s], th[s], pos[s])
                else:
                    late = order[s] >= min_docs
                    wait.append((doc[s][~late & (order[s] > 1)], th[s][~late & (order[s] > 1)], pos[s][~late & (order[s] > 1)]))
                    if seen >= min_docs:
                        for d, t, p in wait:
                            yield batch(DROP, 0, 0, d, t, p)
                        wait = []
                        yield batch(DROP, 0, 0, doc[s][late], th[s][late], pos[s][late])
                head = 1
                if len(starts) > 1:
                    if first:
                        yield batch(SUMMARY, key[0], key[1], [top], 0, seen)
                    first, wait = False, []
            if len(starts) > head:
                full = slice(starts[head], stops[-2] if len(starts) > head + 1 else starts[head])
                run_total = np.repeat(totals[head:], (stops - starts)[head:])[: full.stop - full.start]
                gone = (order[full] > 1) & (run_total >= min_docs)
                if gone.any():
                    yield batch(DROP, 0, 0, doc[full][gone], th[full][gone], pos[full][gone])
                s = slice(starts[-1], len(doc))
                key, top, seen, last_doc = (h1[-1], h2[-1]), doc[s.start], int(totals[-1]), doc[-1]
                rest = order[s] > 1
                wait = [(doc[s][rest], th[s][rest], pos[s][rest])]
                if seen >= min_docs:
                    yield batch(DROP, 0, 0, *wait[0])
                    wait = []
        if key is not None:
            yield batch(SUMMARY, key[0], key[1], [top], 0, seen)
            for d, t, p in wait:
                yield batch(OPEN, key[0], key[1], d, t, p)

    return run


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        maps = []
        for gone in b["gone"].to_pylist():
            bits = np.ones((max(gone) // 8 + 1) * 8, bool)  # whole bytes, so that padding keeps lines
            bits[gone] = False
            maps.append(zlib.compress(np.packbits(bits).tobytes()))
        yield pa.RecordBatch.from_arrays([b["doc"], b["th"], pa.array(maps, pa.binary())], names=["doc", "th", "bitmap"])


def keep_bitmaps(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """Bitmaps (doc, th, bitmap) of the lines that stay, for each document that loses lines.

    ``th`` is ``xxhash64(text)``: with doc it names the text that the bitmap belongs to. The bitmap is
    zlib-compressed, eight lines to a byte; lines beyond its end stay.
    """
    lines = docs.select(F.col("doc_id").cast("long").alias("doc"), F.xxhash64("text").alias("th"), "text")
    lines = lines.where("doc is not null").mapInArrow(trimmed(_hash_lines(min_chars)), _LINES)
    order = ["h1", "h2", F.col("doc").desc()]
    ranged = lines.repartitionByRange(*order).sortWithinPartitions(*order, "th", "pos")
    found = stash(ranged.mapInArrow(trimmed(_stream(min_docs)), _FOUND), "lines")
    # At most two summaries for each partition, and one row for each key of these.
    edges = found.where(f"kind = {SUMMARY}").groupBy("h1", "h2").agg(F.sum("pos").alias("n"), F.max("doc").alias("top"))
    late = (
        found.where(f"kind = {OPEN}")
        .join(F.broadcast(edges.where(f"n >= {min_docs}")), ["h1", "h2"])
        .where("doc <> top")
    )
    gone = found.where(f"kind = {DROP}").select("doc", "th", "pos").unionByName(late.select("doc", "th", "pos"))
    gone = gone.groupBy("doc", "th").agg(F.collect_set(F.col("pos").cast("int")).alias("gone"))
    return gone.mapInArrow(trimmed(_bitmaps), "doc long, th long, bitmap binary")


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts, n_lines, n_dropped = [], [], []
        for text, packed in zip(b["text"].to_pylist(), b["bitmap"].to_pylist(), strict=True):
            if packed is None:
                texts.append(text)
                n_lines.append(1 + (text or "").count("\n"))
                n_dropped.append(0)
                continue
            lines = text.split("\n")
            bits = np.unpackbits(np.frombuffer(zlib.decompress(packed), np.uint8))
            keep = np.ones(len(lines), bool)
            n = min(len(bits), len(lines))
            keep[:n] = bits[:n]
            texts.append("\n".join([x for x, k in zip(lines, keep.tolist(), strict=True) if k]))
            n_lines.append(len(lines))
            n_dropped.append(int((~keep).sum()))
        yield pa.RecordBatch.from_arrays(
            [b["row"], pa.array(texts, pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
            names=["row", "kept_text", "n_lines", "n_dropped"],
        )


def apply_keep_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """The rows of ``docs`` as a struct ``row`` (without the text), with kept_text, n_lines and n_dropped."""
    rest = [c for c in docs.columns if c != "text"]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"),
        F.col("doc_id").cast("long").alias("doc"), F.xxhash64("text").alias("th"), "text",
    )
    schema = T.StructType([
        rows.schema["row"], T.StructField("kept_text", T.StringType()),
        T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()),
    ])
    rows = rows.join(bitmaps, ["doc", "th"], "left").select("row", "text", "bitmap")
    return rows.mapInArrow(trimmed(_apply), schema)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = apply_keep_bitmaps(docs, keep_bitmaps(docs, min_chars=40, min_docs=5))
    text = F.coalesce("kept_text", F.lit(""))
    return out.select("row.doc_id", "n_lines", "n_dropped", F.sha2(text.cast("binary"), 256).alias("kept_sha256"))


_KEY = r"translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SQL = {
    "op7_line_dedup": rf"""
WITH lines AS (
  SELECT doc_id, pos, line, {_KEY} AS k
  FROM (SELECT doc_id, unnest(s) AS line, unnest(range(len(s))) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents))
), bad AS (
  SELECT k, max(doc_id) AS top FROM lines WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT l.doc_id, l.pos, l.line, bad.k IS NOT NULL AND l.doc_id <> bad.top AS gone FROM lines l LEFT JOIN bad ON l.k = bad.k
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""",
}
QUERIES = {"op7_line_dedup": op7_line_dedup}
