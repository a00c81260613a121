"""Packing of tokenised documents into windows by Karmarkar-Karp multiway differencing.

A document's ids are cut into full windows and a tail; the tail is cut into near-equal pieces of at most
``max_piece`` ids. Full windows need no packing. All other pieces are dealt into batches of bounded size, evenly
and whatever their document, and each batch is one group: its pieces start as partial partitions with one
used window each, and the two partitions of largest spread are merged again and again, the fullest window of one
on the emptiest of the other, until one partition is left. Its windows are near equal. If one exceeds the
capacity, the number of windows rises and the batch is done again.

Defined results: a null text is empty, and an empty document is the end id alone. Null doc_ids and repeated
rows are packed like any others; an empty table gives an empty table. Other columns play no part.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stash, subwords, table, trimmed

WINDOW, END = 2048, 1


def vocabulary() -> dict[str, str]:
    """Where the public byte-level BPE vocabulary lies; a caller may name other files of the same vocabulary."""
    import public_tokenizers as public

    return {
        "json_path": public.path("byte_bpe_50k.json"),
        "rank_path": public.path("byte_bpe_50k.tiktoken"),
        "pattern": public.PATTERN,
    }


def cuts(n: int, window: int, max_piece: int) -> list[int]:
    """Where the pieces of a document of ``n`` ids start, and its end."""
    full = n // window * window
    at = list(range(0, full + 1, window))
    if n > full:
        at += [*range(full + max_piece, n, max_piece), n]
    return at


def token_pieces(
    docs: DataFrame, vocab: dict[str, str], window: int = WINDOW, max_piece: int = 512, keep_ids: bool = False
) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens) of all documents, with their ids if asked for."""
    schema = pa.schema(
        [(c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
        + [("ids", pa.list_(pa.int32()))] * keep_ids
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = subwords(**vocab)
        for b in batches:
            rows: list[tuple] = []
            ids_of: list[np.ndarray] = []
            for doc, text in zip(b["doc_id"].to_pylist(), (t.as_py() for t in b["text"]), strict=True):
                ids = np.array([*(encoder.encode(text) if text else ()), END], dtype="<u4")
                at = cuts(len(ids), window, max_piece)
                for lo, hi in zip(at, at[1:], strict=False):
                    part = ids[lo:hi]
                    rows.append((doc, lo, hi - lo, zlib.crc32(part.tobytes()), len(ids)))
                    if keep_ids:
                        ids_of.append(part.astype(np.int32))
            columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] if rows else [pa.array([], pa.int64())] * 5
            if keep_ids:
                columns.append(pa.array(ids_of, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    ddl = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * keep_ids
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(trimmed(run), ddl)


def differencing(sizes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Deal sizes into k windows of near-equal sums: the window of each, and the windows' sums."""
    n = len(sizes)
    left, right = [], []  # the two parts of each joined window, counted from n
    heap = [(-int(s), i, np.array([s], np.int64), np.array([i], np.int64)) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    ticket = n
    while len(heap) > 1:
        _, _, a, a_at = heapq.heappop(heap)
        _, _, b, b_at = heapq.heappop(heap)
        over = len(a) + len(b) - k  # windows in use in both: the emptiest of one join the fullest of the other
        if over > 0:
            i, j = len(a) - over, len(b) - over
            joined = np.arange(over) + n + len(left)
            left.extend(a_at[i:].tolist())
            right.extend(b_at[j:][::-1].tolist())
            total = np.concatenate((a[:i], a[i:] + b[j:][::-1], b[:j]))
            where = np.concatenate((a_at[:i], joined, b_at[:j]))
        else:
            total, where = np.concatenate((a, b)), np.concatenate((a_at, b_at))
        order = np.argsort(-total, kind="stable")
        total, where = total[order], where[order]
        spread = int(total[0]) - (int(total[-1]) if len(total) == k else 0)
        heapq.heappush(heap, (-spread, ticket, total, where))
        ticket += 1
    _, _, sums, roots = heap[0]
    of = np.empty(n, np.int64)
    stack = [(int(r), w) for w, r in enumerate(roots)]
    while stack:
        node, w = stack.pop()
        if node < n:
            of[node] = w
        else:
            stack += [(left[node - n], w), (right[node - n], w)]
    return of, sums


def windows_of(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The window of each size, with as few windows as differencing fits into the capacity."""
    k = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        of, sums = differencing(sizes, k)
        if sums[0] <= capacity:
            return of
        k = max(k + 1, k * 1003 // 1000)


def pack(pieces: DataFrame, window: int = WINDOW, batch: int = 4096) -> DataFrame:
    """Pieces of at most ``window`` ids with their sequence_id and offset added.

    Batches hold ``batch`` pieces on average. A sequence's number is its batch times 2**32 and a count.
    """
    pieces = stash(pieces, "pieces")
    n_batches = max(1, -(-pieces.count() // batch))
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(group: pa.Table) -> pa.Table:
        size = group["length"].to_numpy()
        of = np.empty(len(size), np.int64)
        full = size == window
        of[full] = np.arange(full.sum())
        if not full.all():
            of[~full] = windows_of(size[~full], window) + full.sum()
        order = np.lexsort((group["start"].to_numpy(), np.asarray(group["doc_id"].fill_null(-(2**63))), of))
        group, of, size = group.take(pa.array(order)), of[order], size[order]
        before = np.cumsum(size) - size
        first = np.searchsorted(of, of)
        out = group.drop_columns(["batch_of"])
        number = group["batch_of"].to_numpy() * 2**32 + of
        return out.append_column("sequence_id", pa.array(number)).append_column("offset", pa.array(before - before[first]))

    # Numbers of rows as they lie in the written table: the same whenever a task runs again.
    dealt = pieces.withColumn("batch_of", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n_batches)))
    return dealt.groupBy("batch_of").applyInArrow(run, schema)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(token_pieces(table(spark, sf_dir, "documents"), vocabulary()))


QUERIES = {"op6_packing": op6_packing}
SQL: dict[str, str] = {}
