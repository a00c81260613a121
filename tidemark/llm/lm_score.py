"""Language-model scores: word unigrams as the base, and a causal self-attention model trained in numpy on subword ids.

A text is its words (A-Z lower-cased) and one end, each of them a token. The events are those of the base: the words that
training texts hold, the end, and one event for any other word. A token's probability is

    unseen word:  u
    other token:  (1 - u) * P(class of its opening id | tokens before) * product of P(class of the next id, or none | tokens
                  before, ids so far) * (c + 1) / (sum of c + 1 over the words of the same classes)

``u`` is the Good-Turing estimate from the words seen once. A single-head causal attention layer reads the tokens before, each
as the sum of the vectors of all its subword ids. Two heads stand on its output: one gives the class of the opening id
(frequent ids alone, the others binned by count), the other, for each later id and for the word's end, weighs the shares
that training words have after the same opening class and preceding class. Classes that no training word has after the ids
so far are left out; the table of these has ``SLOTS`` hashed rows at any size, and where two beginnings share a row some
probability goes to spellings that no word has. Beyond that the probabilities of all events sum to one. Windows of
``WINDOW`` tokens overlap, each token is scored once, with at least WINDOW - STRIDE tokens of context where the text has
them; batches are masked causally.

Documents are read in blocks of bounded bytes. A block is written down as one row, the tokens of its texts as numbers of its
distinct words and the ids of these, beside a row for each word with its training count. Spark adds the counts over all blocks
and hands every block the totals of just its own words, so no table of all words is ever in one place; words that very many
blocks list take a broadcast of checked size instead of the shuffle.

Training averages parameters: in each round every task trains on its share of a fresh 1/``share`` of the training
documents, and Spark averages the results by tokens seen. There are as many rounds as parts at least, so every training
document is learned from. Tasks see the documents in the parts in which the table is read, so parameters depend on that.

Defined results: a null or empty text is one end. Rows with a null doc_id are scored, never learned from, and not
held out. Repeated rows are documents of their own. Without training texts every count is 0 and the classes are uniform.
An empty table gives an empty table. Only doc_id and text are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_stash, join_hot, stash, subwords, table, words_of
from .packing import vocabulary

CLASSES, SINGLE, DIM, WINDOW, STRIDE = 128, 112, 16, 48, 36
PARTS, COMMON = 32, 24  # classes of later ids, number 0 being the word's end; ids that have a class of their own
SLOTS = 1 << 20
END_ID = 50256  # free in the vocabulary
_SEEN = np.tril(np.ones((WINDOW, WINDOW), np.float32))  # the causal mask


def learns(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 7 != 2, F.lit(False))


# --- spellings -------------------------------------------------------------------------------------------------------


class Chain(NamedTuple):
    """How training words go on: shares of the next part by (opening class, preceding part), the parts that have any as
    bits, and the bits of the parts that follow each beginning of a word, by its hash."""

    share: np.ndarray
    some: np.ndarray
    bits: np.ndarray


def chain_of(counts: np.ndarray, bits: np.ndarray) -> Chain:
    share = (counts / np.maximum(1, counts.sum(1, keepdims=True))).astype(np.float32)
    return Chain(share, ((counts > 0) << np.arange(PARTS, dtype=np.int64)).sum(1).astype(np.uint32), bits)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def runs(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers first, first + 1, ... of every run, end to end."""
    return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())


def steps(kinds: np.ndarray) -> tuple[np.ndarray, ...]:
    """Words laid end to end as kinds of their ids. Where each begins and its number of ids; for each id the state after it, the part
    that follows (0: none) and the slot of the ids so far; and a hash of each word's kinds."""
    at = np.flatnonzero(kinds < CLASSES)
    size = np.diff(at, append=len(kinds))
    place = np.arange(len(kinds)) - np.repeat(at, size)
    state = np.repeat(kinds[at], size) * PARTS + np.where(place > 0, kinds - CLASSES - 1, 0)
    part = np.append(np.maximum(kinds[1:] - CLASSES - 1, 0), 0)[: len(kinds)]
    each = _mixed((place * (CLASSES + 1 + PARTS) + kinds + 1).astype(np.uint64))
    total = np.cumsum(each)  # wraps
    so_far = _mixed(total - np.repeat((total - each)[at], size))
    return at, size, state, part, (so_far >> np.uint64(44)).astype(np.int64), so_far[at + size - 1].view(np.int64)


def spellings(ids: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A hash of the ids of each word; words stand end to end, each from ``at`` on."""
    place = np.arange(len(ids)) - np.repeat(at, size)
    return _mixed(np.add.reduceat(_mixed((place * (END_ID + 1) + ids + 1).astype(np.uint64)), at))


def numbered(ids: np.ndarray, kind: np.ndarray, most: int = 1 << 16) -> tuple[np.ndarray, np.ndarray]:
    """The words of texts laid end to end, by rank of their hash: each token's number, and the ids of all words end to end."""
    at = np.flatnonzero(kind[ids] < CLASSES)
    size = np.diff(at, append=len(ids))
    cuts = np.unique(np.append(np.searchsorted(at, np.arange(0, len(ids), most)), len(at)))
    hashes = [spellings(ids[at[lo] : at[hi - 1] + size[hi - 1]], at[lo:hi] - at[lo], size[lo:hi]) for lo, hi in zip(cuts[:-1], cuts[1:], strict=True)]
    _, first, tokens = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
    return tokens, ids[runs(at[first], size[first])]


def layers(first: np.ndarray, size: np.ndarray, few: int = 16) -> Iterator[tuple]:
    """Runs of numbers from ``first`` on, by falling ``size``, across: for j = 0, 1, ... how many runs have a j-th number, the rows of
    these and the numbers. Once no more than ``few`` runs go on, all their rest comes at once, with where each run's begins."""
    left = len(size) - np.cumsum(np.bincount(size, minlength=1))
    for j, n in enumerate(left.tolist()):
        if n <= few:
            if n:
                rest = size[:n].astype(np.int64) - j
                yield n, np.repeat(np.arange(n), rest), runs(first[:n] + j, rest), np.cumsum(rest) - rest
            return
        yield n, slice(n), first[:n] + j, None


def _add(sums: np.ndarray, n: int, values: np.ndarray, begins: np.ndarray | None) -> None:
    sums[:n] += values if begins is None else np.add.reduceat(values, begins)


def _small(x: np.ndarray) -> np.ndarray:
    """As 16 bits where they fit: these are sorted by radix."""
    return x.astype(np.int16 if len(x) and x.max() < 1 << 15 else np.int64)


class Words:
    """Words as the model reads them: their ids' kinds, and those steps of their spelling at which more than one part may follow.

    One more word, the last, stands before a text's first token.
    """

    def __init__(self, kinds: np.ndarray, chain: Chain, scored: np.ndarray | None = None):
        at, size, state, part, slot, _ = steps(kinds)
        self.kinds, self.at, self.size = np.append(kinds, CLASSES), np.append(at, len(kinds)), _small(np.append(size, 1))
        self.head, self.root = kinds[at], (self.size.astype(np.float64) ** -0.5).astype(np.float32)
        may = chain.some[state] & chain.bits[slot]
        free = (may & (may - np.uint32(1))) != 0
        if scored is not None:
            free &= np.repeat(scored, size)
        # The shares at each kind of open step, and of each step the row there, the part that follows and the log of its share.
        each, self.row = np.unique(state[free] << 32 | may[free].astype(np.int64), return_inverse=True)
        bits = np.unpackbits((each & 0xFFFFFFFF).astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
        self.share, self.part = chain.share[each >> 32] * bits, part[free]
        with np.errstate(divide="ignore"):
            self.log_share = np.log(self.share[self.row, self.part])
        self.steps = np.add.reduceat(free.astype(np.int32), at)
        self.first = np.cumsum(self.steps) - self.steps
        self.steps = _small(self.steps)

    def layers(self, words: np.ndarray) -> tuple[np.ndarray, list[tuple]]:
        """The words' order by falling number of ids, and in it their ids' kinds, in layers."""
        size = self.size[words]
        order = np.argsort(-size, kind="stable")
        return order, [(n, rows, self.kinds[at], begins) for n, rows, at, begins in layers(self.at[words[order]], size[order])]

    def read(self, words: np.ndarray, embed: np.ndarray, laid: tuple | None = None) -> np.ndarray:
        """The sum of the vectors of all ids of each word, over the root of their number."""
        order, each = laid or self.layers(words)
        sums, out = np.zeros((len(words), DIM), embed.dtype), np.empty((len(words), DIM), embed.dtype)
        for n, _, kinds, begins in each:
            _add(sums, n, np.take(embed, kinds, axis=0), begins)
        sums *= self.root[words[order]][:, None]
        out[order] = sums
        return out

    def read_back(self, words: np.ndarray, d: np.ndarray, laid: tuple) -> np.ndarray:
        """The gradient of the vectors of ids, from that of what is read."""
        order, each = laid
        out, d = np.zeros((CLASSES + 1 + PARTS, DIM), d.dtype), np.take(d * self.root[words][:, None], order, axis=0)
        kinds = np.concatenate([k for _, _, k, _ in each]).astype(np.uint8)
        rows = np.concatenate([np.arange(n) if begins is None else rows for n, rows, _, begins in each])
        by = np.argsort(kinds, kind="stable")
        kinds = kinds[by]
        begins = np.flatnonzero(np.append(True, kinds[1:] != kinds[:-1]))
        out[kinds[begins]] = np.add.reduceat(np.take(d, rows[by], axis=0), begins)
        return out

    def vectors(self, p: dict, most: int = 4096) -> np.ndarray:
        """What the model reads for each word."""
        return np.concatenate([self.read(np.arange(lo, min(lo + most, len(self.at))), p["embed"]) for lo in range(0, len(self.at), most)])


# --- the model -------------------------------------------------------------------------------------------------------


def first_parameters(share: np.ndarray, seed: int = 5) -> dict[str, np.ndarray]:
    """Parameters that predict the shares of the classes."""
    rng = np.random.default_rng(seed)
    draw = lambda *n: (rng.normal(size=n) * 0.3 / math.sqrt(n[0])).astype(np.float32)
    return {
        "embed": draw(CLASSES + 1 + PARTS, DIM) * 4, "place": draw(WINDOW, DIM), "q": draw(DIM, DIM), "k": draw(DIM, DIM), "v": draw(DIM, DIM) * 2,
        "o": draw(DIM, DIM) * 2, "out": draw(DIM, CLASSES) * 0.1, "bias": np.log(share + 1e-6).astype(np.float32), "next": draw(DIM, PARTS) * 0.1,
    }


def forward(p: dict, h: np.ndarray, skip: int = 0) -> tuple:
    """The layer's input, scaled queries, keys, values, attention before its division, the divisors' inverses, mixed values and output,
    for the tokens' vectors of equal windows. The first ``skip`` tokens of a window are context alone."""
    n, width = h.shape[:2]
    h = h + p["place"][:width]
    all_three = (h.reshape(-1, DIM) @ _three(p)).reshape(n, width, 3 * DIM)
    q, k, v = all_three[:, skip:, :DIM], all_three[..., DIM : 2 * DIM], all_three[..., 2 * DIM :]
    a = q @ k.transpose(0, 2, 1)
    np.clip(a, -60, 60, out=a)
    np.exp(a, out=a)
    a *= _SEEN[skip:width, :width]
    over = 1 / (a @ np.ones((width, 1), a.dtype))
    m = a @ v
    m *= over
    return h, q, k, v, a, over, m, h[:, skip:] + (m.reshape(-1, DIM) @ p["o"]).reshape(m.shape)


def _three(p: dict) -> np.ndarray:
    return np.concatenate((p["q"] * p["q"].dtype.type(DIM**-0.5), p["k"], p["v"]), 1)


def _exp_scores(p: dict, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exponentials of the classes' scores, and their sums; scores beyond what a float holds are cut."""
    z = _and_one(h) @ np.append(p["out"], p["bias"][None], 0)
    if not _reach(h, p["out"]) + np.abs(p["bias"]).max() < 80:
        np.clip(z, -80, 80, out=z)
    np.exp(z, out=z)
    return z, z @ np.ones(z.shape[1], z.dtype)


def _reach(h: np.ndarray, w: np.ndarray) -> float:
    """No number of ``h @ w`` is farther from 0."""
    return math.sqrt(np.einsum("ij,ij->i", h, h).max(initial=0) * (w * w).sum(0).max())


def _and_one(h: np.ndarray) -> np.ndarray:
    out = np.empty((len(h), DIM + 1), h.dtype)
    out[:, :DIM], out[:, DIM] = h, 1
    return out


def _next_scores(p: dict, h: np.ndarray) -> np.ndarray:
    z = h @ p["next"]
    return np.clip(z, -40, 40, out=z)


def _by_steps(words: Words, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple]]:
    """The order of the target words by falling number of open steps, in it the words, and the steps in layers."""
    size = words.steps[y]
    order = np.argsort(-size, kind="stable")
    y = y[order]
    return order, y, list(layers(words.first[y], size[order]))


def log_shares(p: dict, h: np.ndarray, words: Words, y: np.ndarray) -> np.ndarray:
    """Natural log-probability of the classes of the target words' ids; ``h`` and ``y`` hold a row and a word for each token."""
    order, y, each = _by_steps(words, y)
    h = np.take(h, order, axis=0)
    z, total = _exp_scores(p, h)
    logs, out = np.log(np.take(z.ravel(), np.arange(0, z.size, CLASSES) + words.head[y]) / total).astype(np.float64), np.empty(len(y))
    if each:
        x = _next_scores(p, h[: each[0][0]])
        z = np.exp(x)
        for n, rows, at, begins in each:
            all_parts = np.einsum("ij,ij->i", z[rows], np.take(words.share, words.row[at], axis=0))
            chosen = np.take(x.ravel(), (np.arange(n) if begins is None else rows) * PARTS + words.part[at])
            _add(logs, n, chosen - np.log(all_parts) + words.log_share[at], begins)
    out[order] = logs
    return out


def gradients(p: dict, words: Words, x: np.ndarray, y: np.ndarray, live: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean loss over the live tokens ``y``, each after the word ``x``."""
    shape, x = x.shape, x.ravel()
    laid = words.layers(x)
    h, q, k, v, a, over, m, r = forward(p, words.read(x, p["embed"], laid).reshape(*shape, DIM))
    flat = lambda t: t.reshape(-1, t.shape[-1])
    order, y, each = _by_steps(words, y.ravel())
    r, weight = np.take(flat(r), order, axis=0), (live / live.sum()).ravel()[order]
    z, total = _exp_scores(p, r)
    z.ravel()[np.arange(0, z.size, CLASSES) + words.head[y]] -= total
    part_of = (weight / total)[:, None]
    g_out = z.T @ (_and_one(r) * part_of)
    g = {"out": g_out[:, :DIM].T, "bias": g_out[:, DIM]}
    d = (z @ p["out"].T) * part_of
    g["next"] = np.zeros_like(p["next"])
    if each:
        some = each[0][0]
        z = np.exp(_next_scores(p, r[:some]))
        sums, chosen = np.zeros_like(z), np.zeros_like(z)
        for n, rows, at, begins in each:
            shares = np.take(words.share, words.row[at], axis=0)
            _add(sums, n, shares * (1 / np.einsum("ij,ij->i", z[rows], shares))[:, None], begins)
            if begins is None:
                chosen.ravel()[np.arange(0, n * PARTS, PARTS) + words.part[at]] += 1
            else:
                np.add.at(chosen.ravel(), rows * PARTS + words.part[at], 1)
        z *= sums
        z -= chosen
        z *= weight[:some, None]
        g["next"] += r[:some].T @ z
        d[:some] += z @ p["next"].T
    dr = np.empty_like(d)
    dr[order] = d
    g["o"] = flat(m).T @ dr
    dm = (dr @ p["o"].T).reshape(m.shape)
    dm *= over
    ds = dm @ v.transpose(0, 2, 1)
    ds -= np.einsum("nij,nij->ni", dm, m)[..., None]  # the mean of ds under the attention
    ds *= a
    d = flat(np.concatenate((ds @ k, ds.transpose(0, 2, 1) @ q, a.transpose(0, 2, 1) @ dm), -1))
    dh = dr + d @ _three(p).T
    g_three = (d.T @ flat(h)).T
    g["q"], g["k"], g["v"] = g_three[:, :DIM] * DIM**-0.5, g_three[:, DIM : 2 * DIM], g_three[:, 2 * DIM :]
    g["place"] = np.zeros_like(p["place"])
    g["place"][: shape[1]] = dh.reshape(*shape, DIM).sum(0)
    g["embed"] = words.read_back(x, dh, laid)
    return g


def windows(lengths: np.ndarray, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts laid end to end: each window's first token, its number of tokens, and whether it opens its text."""
    n = 1 + np.maximum(0, -(-(lengths - WINDOW) // stride))
    text = np.repeat(np.arange(len(lengths)), n)
    rank = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    start = (np.cumsum(lengths) - lengths)[text] + rank * stride
    return start, np.minimum(WINDOW, np.cumsum(lengths)[text] - start), rank == 0


def _batch(before: np.ndarray, tokens: np.ndarray, start: np.ndarray, size: np.ndarray):
    width = int(size.max())
    at = np.minimum(start[:, None] + np.arange(width), len(tokens) - 1)
    return before[at], tokens[at], np.arange(width) < size[:, None], at


def _before(words: Words, tokens: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The word before each token; a text opens after the last of ``words``."""
    out = np.roll(tokens, 1)
    out[np.cumsum(lengths) - lengths] = len(words.at) - 1
    return out


def score_tokens(p: dict, words: Words, tokens: np.ndarray, lengths: np.ndarray, batch: int = 96, vectors: np.ndarray | None = None) -> np.ndarray:
    """Natural log-probability of the classes of each token's ids, texts laid end to end; ``tokens`` number the words."""
    out, before = np.zeros(len(tokens)), _before(words, tokens, lengths)
    vectors = words.vectors(p) if vectors is None else vectors
    start, size, opens = windows(lengths)
    for some, skip in ((opens, 0), (~opens, WINDOW - STRIDE)):
        order = np.flatnonzero(some)
        order = order[np.argsort(size[order], kind="stable")]  # windows of like size share a batch
        for lo in range(0, len(order), batch):
            w = order[lo : lo + batch]
            x, y, live, at = _batch(before, tokens, start[w], size[w])
            live = live[:, skip:]
            out[at[:, skip:][live]] = log_shares(p, forward(p, np.take(vectors, x, axis=0), skip)[-1][live], words, y[:, skip:][live])
    return out


def train(p: dict, words: Words, tokens: np.ndarray, lengths: np.ndarray, seed: int, rate: float = 4e-3, batch: int = 64) -> dict:
    """One pass of Adam over some texts, each token in one window. Windows of like size share a batch; batches come in random order."""
    names, cuts = list(p), np.cumsum([v.size for v in p.values()])[:-1]
    whole = np.concatenate([v.ravel() for v in p.values()])
    p = {n: v.reshape(p[n].shape) for n, v in zip(names, np.split(whole, cuts), strict=True)}  # views of the whole
    one, two = np.zeros_like(whole), np.zeros_like(whole)
    before, (start, size, _) = _before(words, tokens, lengths), windows(lengths, WINDOW)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(start))
    order = order[np.argsort(size[order], kind="stable")]
    for t, lo in enumerate(rng.permutation(np.arange(0, len(order), batch)).tolist(), 1):
        w = order[lo : lo + batch]
        x, y, live, _ = _batch(before, tokens, start[w], size[w])
        step = rate * math.sqrt(1 - 0.99**t) / (1 - 0.9**t) / (1 + t * batch / len(order))
        g = gradients(p, words, x, y, live.astype(np.float32))
        g = np.concatenate([g[n].ravel() for n in names])
        one += 0.1 * (g - one)
        two += 0.01 * (g * g - two)
        whole -= (step * one / (np.sqrt(two) + 1e-6)).astype(np.float32)
    return p


# --- corpus counts, classes and training -----------------------------------------------------------------------------


def planes(x: np.ndarray) -> bytes:
    """Numbers as bytes, all first bytes before all second ones; the higher bytes are mostly zero and compress well."""
    return x.view(np.uint8).reshape(len(x), -1).T.tobytes()


def from_planes(x: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(x, np.uint8).reshape(np.dtype(kind).itemsize, -1).T.copy().view(kind).ravel()


def tokens_of(texts: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The tokens of texts laid end to end, as numbers of distinct words; each text's number of tokens; and the words. The empty
    word is the end."""
    texts = pc.ascii_lower(pc.ascii_trim_whitespace(pc.fill_null(texts, "")))
    lists = pc.ascii_split_whitespace(pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise(texts, "", " ")))  # a blank behind the last word splits off the end
    words = pc.list_flatten(lists).combine_chunks().dictionary_encode()
    words = words.combine_chunks() if isinstance(words, pa.ChunkedArray) else words
    return words.indices.to_numpy(), pc.list_value_length(lists).to_numpy().astype(np.int64), words.dictionary


_LISTED = (
    ("block", pa.int64(), "long"), ("doc_id", pa.list_(pa.int64()), "array<long>"), ("learn", pa.list_(pa.bool_()), "array<boolean>"),
    ("part", pa.list_(pa.int64()), "array<long>"), ("length", pa.list_(pa.int64()), "array<long>"), ("tokens", pa.binary(), "binary"), ("spelled", pa.binary(), "binary"),
    ("number", pa.int32(), "int"), ("ids", pa.binary(), "binary"), ("c", pa.int64(), "long"),
)


def _listed(block_docs: int, block_bytes: int, vocab: dict[str, str]):
    """mapInArrow over (doc_id, learn, part, text): for each block a row of its documents (their tokens as numbers of words, and the ids of
    the words end to end) and a row per distinct word."""
    kinds = {name: kind for name, kind, _ in _LISTED}
    schema = pa.schema(kinds)

    def rows(n: int, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns[k] if k in columns else pa.nulls(n, t) for k, t in kinds.items()], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, block = subwords(**vocab), TaskContext.get().partitionId() << 32
        held, docs, size = [], 0, 0

        def done() -> Iterator[pa.RecordBatch]:
            nonlocal held, docs, size, block
            texts = pa.Table.from_batches(held).combine_chunks()
            tokens, lengths, words = tokens_of(texts["text"])
            learned = np.repeat(texts["learn"].to_numpy(), lengths)
            c = np.bincount(tokens[learned], minlength=len(words)).astype(np.int64)
            ids, bounds = _ids(words, encoder)
            ids = ids.astype(np.uint16).tobytes()
            one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
            yield rows(1, block=pa.array([block]), **{k: one(texts[k].combine_chunks().cast(kinds[k].value_type)) for k in ("doc_id", "learn", "part")}, length=one(pa.array(lengths)),
                       tokens=pa.array([planes(tokens.astype(np.int32))], pa.binary()), spelled=pa.array([ids], pa.binary()))
            each = pa.Array.from_buffers(pa.binary(), len(words), [None, pa.py_buffer((2 * bounds).astype(np.int32).tobytes()), pa.py_buffer(ids)])
            for lo in range(0, len(words), 50_000):
                some = slice(lo, lo + 50_000)
                n = len(words[some])
                yield rows(n, block=pa.array(np.full(n, block)), number=pa.array(np.arange(lo, lo + n, dtype=np.int32)), ids=each[some], c=pa.array(c[some]))
            held, docs, size, block = [], 0, 0, block + 1

        for b in batches:
            lo = 0
            for hi, n in enumerate(pc.fill_null(pc.binary_length(b["text"]), 0).to_pylist(), 1):
                docs, size = docs + 1, size + n
                if docs >= block_docs or size >= block_bytes:
                    held.append(b.slice(lo, hi - lo))
                    yield from done()
                    lo = hi
            if lo < b.num_rows:
                held.append(b.slice(lo))
        if held:
            yield from done()

    return run, ", ".join(f"{name} {kind}" for name, _, kind in _LISTED)


def with_totals(words: DataFrame, totals: DataFrame, blocks: int, most: int = 200_000) -> DataFrame:
    """(block, number, total, mass) for the words of every block that ``totals`` (ids, c, mass, spread) has. Words that many blocks list
    would be hot keys of the shuffle; they are broadcast if no more than ``most`` of them are found."""
    hot = totals.where(F.col("spread") >= max(256, blocks // 16)).select("ids", F.col("c").alias("total"), "mass")
    some = hot.limit(most + 1).count()
    columns = ["block", "number", "total", "mass"]
    rest = totals.select("ids", F.col("c").alias("total"), "mass").hint("shuffle_hash")
    if not 0 < some <= most:
        return words.join(rest, "ids").select(*columns)
    few = F.broadcast(hot)
    return words.join(few, "ids").select(*columns).unionByName(words.join(few, "ids", "left_anti").join(rest, "ids").select(*columns))


_PACKED = "block long, number binary, total binary, mass binary"


def _packed(most: int = 1 << 19):
    """mapInArrow over (block, number, total, mass): of every ``most`` rows one row for each block, with its words by rising number
    as planes of the numbers' steps, the totals and the masses."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def done() -> pa.RecordBatch:
            block, number, total, mass = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.lexsort((number, block))
            block, number, total, mass = block[order], number[order].astype(np.int32), total[order], mass[order]
            at = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
            step = np.diff(number, prepend=np.int32(0))
            step[at] = number[at]
            cut = list(zip(at.tolist(), np.append(at[1:], len(block)).tolist(), strict=True))
            return pa.RecordBatch.from_arrays([pa.array(block[at]), *(pa.array([planes(x[lo:hi]) for lo, hi in cut], pa.binary()) for x in (step, total, mass))],
                                              names=["block", "number", "total", "mass"])

        for b in batches:
            if b.num_rows:
                held.append(tuple(b[k].to_numpy() for k in ("block", "number", "total", "mass")))
                size += b.num_rows
            if size >= most:
                yield done()
                held, size = [], 0
        if held:
            yield done()

    return run


def _unpacked(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers, totals and masses of the words in packed rows."""
    numbers = [np.cumsum(from_planes(x, np.int32)) for x in rows["number"].to_pylist()]
    each = [numbers, *([from_planes(x, np.int64) for x in rows[k].to_pylist()] for k in ("total", "mass"))]
    return tuple(np.concatenate([np.zeros(0, np.int64), *x]) for x in each)


def classes_of(counts: np.ndarray, opens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The class of each id, the natural log of each id's share of its class, and the classes' shares of all."""
    out = np.empty(len(counts), np.int64)
    order = np.argsort(-counts, kind="stable")
    order = order[order != END_ID]
    out[END_ID] = 0
    out[order[: SINGLE - 1]] = np.arange(1, SINGLE)
    rest, bins = order[SINGLE - 1 :], CLASSES - SINGLE
    sides = [rest[opens[rest] == side] for side in (False, True)]
    total = sum((counts[some] + 1e-9).sum() for some in sides)
    first = min(bins - 1, max(1, round(bins * (counts[sides[0]] + 1e-9).sum() / total))) if len(sides[0]) else 0
    for some, lo, n in ((sides[0], SINGLE, first), (sides[1], SINGLE + first, bins - first)):
        mass = np.cumsum(counts[some] + 1e-9)
        out[some] = lo + np.minimum(n - 1, (mass / mass[-1] * n).astype(np.int64) if len(some) else 0)
    weight = counts + 0.5
    mass = np.bincount(out, weight, minlength=CLASSES)
    return out, np.log(weight) - np.log(mass[out]), np.bincount(out, counts, minlength=CLASSES) / max(1, counts.sum())


def kinds_of(counts: np.ndarray, spaced: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The kind of each id, and the shares of the opening classes. Ids that open a word (``spaced``, and the end) have a class as
    kind, later ones CLASSES + 1 + their part."""
    opens = spaced | (np.arange(len(counts)) == END_ID)
    classes, _, shares = classes_of(counts * opens, spaced)
    later = np.where(opens, 0, counts)
    order = np.argsort(-later, kind="stable")
    part = np.empty(len(counts), np.int64)
    part[order[:COMMON]] = np.arange(1, COMMON + 1)
    bins, mass = PARTS - 1 - COMMON, np.cumsum(later[order[COMMON:]] + 1e-9)
    part[order[COMMON:]] = COMMON + 1 + np.minimum(bins - 1, (mass / mass[-1] * bins).astype(np.int64))
    return np.where(opens, classes, CLASSES + 1 + part), shares


def _laid_ids(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(b["ids"].to_pylist()), np.uint16), pc.binary_length(b["ids"]).to_numpy().astype(np.int64) // 2


def _count_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n = np.zeros(END_ID + 1, np.int64)
    for b in batches:
        ids, size = _laid_ids(b)
        np.add.at(n, ids, np.repeat(b["c"].to_numpy(), size))
    at = np.flatnonzero(n)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], names=["id", "n"])


def chain_rows(kinds: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of words with counts: how often each part follows each state, and the bits of the parts that follow each beginning."""
    at, size, state, part, slot, _ = steps(kinds)
    counts, bits = np.zeros(CLASSES * PARTS * PARTS, np.int64), np.zeros(SLOTS, np.uint32)
    np.add.at(counts, state * PARTS + part, np.repeat(c, size))
    np.bitwise_or.at(bits, slot, np.uint32(1) << part.astype(np.uint32))
    return counts, bits


def _count_steps(kind: np.ndarray):
    """mapInArrow over (c, ids): partial counts of parts by state, at their own numbers, and bits by slot, at -1 - slot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, bits = chain_rows(np.zeros(0, np.int64), np.zeros(0, np.int64))
        for b in batches:
            ids, _ = _laid_ids(b)
            more, others = chain_rows(kind[ids], b["c"].to_numpy())
            counts += more
            bits |= others
        for at, values, sign in ((np.flatnonzero(counts), counts, 0), (np.flatnonzero(bits), bits.astype(np.int64), 1)):
            yield pa.RecordBatch.from_arrays([pa.array(-1 - at if sign else at), pa.array(values[at])], names=["at", "n"])

    return run


def _paths(kind: np.ndarray):
    """mapInArrow over (ids, c, spread): a hash of the kinds of each word's ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, _ = _laid_ids(b)
            yield pa.RecordBatch.from_arrays([*(b[k] for k in ("ids", "c", "spread")), pa.array(steps(kind[ids])[-1])], names=["ids", "c", "spread", "path"])

    return run


def learned_chain(known: DataFrame, kind: np.ndarray) -> Chain:
    """The chain of the words (c, ids). What comes to the driver is bounded by the numbers of states and slots."""
    rows = known.select("c", "ids").mapInArrow(_count_steps(kind), "at long, n long")
    got = rows.groupBy("at").agg(F.when(F.col("at") < 0, F.bit_or("n")).otherwise(F.sum("n")).alias("n")).toArrow()
    at, n = got["at"].to_numpy(), got["n"].to_numpy()
    counts, bits = np.zeros(CLASSES * PARTS * PARTS, np.int64), np.zeros(SLOTS, np.uint32)
    counts[at[at >= 0]] = n[at >= 0]
    bits[-1 - at[at < 0]] = n[at < 0]
    return chain_of(counts.reshape(-1, PARTS), bits)


def _ids(words: list[str] | pa.Array, encoder) -> tuple[np.ndarray, np.ndarray]:
    """Ids of distinct words: all of them, and the bounds of each word's; the empty word is the end."""
    words = words if isinstance(words, pa.Array) else pa.array(words, pa.string())
    real = pc.not_equal(words, "")
    ids, ends = encoder.encode_words(words.filter(real))
    real = real.to_numpy(zero_copy_only=False)
    each = np.ones(len(words), np.int64)
    each[real] = np.diff(ends, prepend=0)
    out = np.full(each.sum(), END_ID, np.int64)
    out[np.repeat(real, each)] = ids
    return out, np.append(0, np.cumsum(each))


class Taught(NamedTuple):
    """Texts to train on: the kinds of their words end to end, their tokens as numbers of words, their lengths, the ids of all tokens."""

    kinds: np.ndarray
    tokens: np.ndarray
    lengths: np.ndarray
    size: int


def _of_texts(batches: Iterator[pa.RecordBatch], kind: np.ndarray, vocab: dict[str, str], most: int) -> Iterator[Taught]:
    """Documents laid end to end, some ``most`` ids at a time; words of equal kinds are one to the model."""
    held, size = [], 0

    def done() -> Taught:
        ids = np.concatenate(held)
        kinds = kind[ids]
        ends = np.flatnonzero(ids[kinds < CLASSES] == END_ID)
        tokens, spelled = numbered(kinds, np.arange(CLASSES + 1 + PARTS))
        return Taught(spelled, tokens, np.diff(ends, prepend=-1), len(ids))

    for b in batches:
        for x in b["text"].to_pylist():
            held.append(_ids([w.decode("utf-8", "surrogatepass") for w in [*words_of(x), b""]], subwords(**vocab))[0])
            size += len(held[-1])
            if size >= most:
                yield done()
                held, size = [], 0
    if held:
        yield done()


def _of_blocks(batches: Iterator[pa.RecordBatch], kind: np.ndarray, turn: int, most: int) -> Iterator[Taught]:
    """The same from blocks that hold the words' ids: their training documents of part ``turn``."""
    held: list[Taught] = []

    def done() -> Taught:
        before = np.cumsum([0] + [np.count_nonzero(x.kinds < CLASSES) for x in held])
        tokens = [x.tokens + n for x, n in zip(held, before.tolist(), strict=False)]
        return Taught(np.concatenate([x.kinds for x in held]), np.concatenate(tokens), np.concatenate([x.lengths for x in held]), sum(x.size for x in held))

    for b in batches:
        for row in range(b.num_rows):
            block = Block.read(b, row, kind)
            keep = block.learn & (block.part == turn)
            lengths = block.lengths[keep]
            if not len(lengths):
                continue
            tokens = block.tokens[runs((np.cumsum(block.lengths) - block.lengths)[keep], lengths)]
            cut = np.append(0, np.cumsum(lengths))
            size = np.append(0, np.cumsum(np.add.reduceat(block.size[tokens], cut[:-1])))
            lo = 0
            while lo < len(lengths):
                hi = min(len(lengths), int(np.searchsorted(size, size[lo] + most - sum(x.size for x in held))))
                some = tokens[cut[lo] : cut[hi]]
                used = np.zeros(len(block.at), bool)
                used[some] = True
                words = np.flatnonzero(used)
                kinds = block.kinds[runs(block.at[words], block.size[words])]
                held.append(Taught(kinds, (np.cumsum(used) - 1)[some], lengths[lo:hi], int(size[hi] - size[lo])))
                if sum(x.size for x in held) >= most:
                    yield done()
                    held.clear()
                lo = hi
    if held:
        yield done()


class Block(NamedTuple):
    """A block's documents as ``_listed`` writes them: the kinds of its words end to end, where each word begins and its number of ids."""

    doc_id: pa.Array
    learn: np.ndarray
    part: np.ndarray
    lengths: np.ndarray
    tokens: np.ndarray
    kinds: np.ndarray
    at: np.ndarray
    size: np.ndarray

    @staticmethod
    def read(b: pa.RecordBatch, row: int, kind: np.ndarray) -> Block:
        of = lambda k: b[k][row].values
        kinds = kind[np.frombuffer(b["spelled"][row].as_py(), np.uint16)]
        at = np.flatnonzero(kinds < CLASSES)
        return Block(of("doc_id"), of("learn").to_numpy(zero_copy_only=False), of("part").to_numpy(), of("length").to_numpy(), from_planes(b["tokens"][row].as_py(), np.int32), kinds, at,
                     np.diff(at, append=len(kinds)))


def parted(part: int):
    return F.pmod(F.xxhash64("doc_id"), F.lit(part))


def fit(docs: DataFrame, kind: np.ndarray, chain: Chain, share: np.ndarray, vocab: dict[str, str], rounds: int, part: int, most: int = 1_000_000) -> tuple[dict[str, np.ndarray], int]:
    """Parameters after ``rounds`` rounds, each over one of ``part`` disjoint parts of the training documents, and the ids seen.

    The documents come as rows (doc_id, learn, text), or in blocks of ``_listed`` that hold the same parts.
    Fewer rounds than parts would leave documents out, so there are ``part`` at least.
    """
    spark, p, seen, blocks = docs.sparkSession, first_parameters(share), 0, "spelled" in docs.columns
    names = list(p)
    for turn in range(max(rounds, part)):
        sent = spark.sparkContext.broadcast((p, kind, chain))  # some 10,000 parameters, a kind for each id, and the chain's fixed tables

        def run(batches: Iterator[pa.RecordBatch], turn=turn, sent=sent) -> Iterator[pa.RecordBatch]:
            params, kind, chain = sent.value
            total = 0
            for some in _of_blocks(batches, kind, turn % part, most) if blocks else _of_texts(batches, kind, vocab, most):
                params = train(params, Words(some.kinds, chain), some.tokens, some.lengths, turn)
                total += some.size
            flat = np.append(np.concatenate([params[n].ravel() for n in names]).astype(np.float64) * total, total) if total else np.zeros(0)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], names=["at", "v"])

        some = docs if blocks else docs.where(F.col("learn") & (parted(part) == turn % part)).select("text")
        rows = some.mapInArrow(run, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()  # one row for each parameter
        sent.unpersist()
        if rows:
            flat = np.zeros(len(rows))
            for r in rows:
                flat[r["at"]] = r["v"]
            seen += int(flat[-1])
            flat, at = flat[:-1] / flat[-1], 0
            for n in names:
                p[n] = flat[at : at + p[n].size].reshape(p[n].shape).astype(np.float32)
                at += p[n].size
    return p, seen


def log_inside(unseen: float, c: np.ndarray, mass: np.ndarray) -> np.ndarray:
    """Of each word, the natural log of its share of its path's mass and of being seen; that of being unseen where it is."""
    return np.where(c > 0, math.log1p(-unseen) + np.log(c + 1.0) - np.log(np.maximum(1, mass)), math.log(unseen))


def token_logs(p: dict, words: Words, unseen: float, c: np.ndarray, mass: np.ndarray, tokens: np.ndarray, lengths: np.ndarray, vectors: np.ndarray | None = None, inside: np.ndarray | None = None) -> np.ndarray:
    """Natural log-probability of each token, texts laid end to end; ``tokens`` number the words, ``mass`` is that of a word's path."""
    inside = log_inside(unseen, c, mass) if inside is None else inside
    out = score_tokens(p, words, tokens, lengths, vectors=vectors)
    return np.where(c[tokens] > 0, out, 0.0) + inside[tokens]


def score_texts(docs: DataFrame, vocab: dict[str, str], rounds: int = 3, share: int = 3, block_docs: int = 20_000, block_bytes: int = 12 << 20) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row of a documents table."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("learn", learns()).withColumn("part", parted(share))
    run, schema = _listed(block_docs, block_bytes, vocab)
    listed = stash(rows.select("doc_id", "learn", "part", "text").mapInArrow(run, schema), "blocks", "zstd")
    words = listed.where("number is not null").select("block", "number", "ids", "c")  # a word's ids stand for it: they spell its bytes
    texts = listed.where("number is null").select("block", "doc_id", "learn", "part", "length", "tokens", "spelled")
    totals = stash(words.groupBy("ids").agg(F.sum("c").alias("c"), F.count("*").alias("spread")), "totals", "zstd")
    ends = F.when(F.col("ids") == F.lit(np.uint16(END_ID).tobytes()), F.col("spread"))
    n, v, once, blocks = totals.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0), F.count_if(F.col("c") == 1), F.coalesce(F.max(ends), F.lit(0))).first()
    known, counts = totals.where("c > 0"), np.zeros(END_ID + 1, np.int64)
    for r in known.select("c", "ids").mapInArrow(_count_ids, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():  # one row for each id of the vocabulary at most
        counts[r.id] = r.n
    encoder = subwords(**vocab)
    kind, shares = kinds_of(counts, np.array([i < END_ID and encoder.fast.decode_single_token_bytes(i)[:1] == b" " for i in range(END_ID + 1)]))
    chain = learned_chain(known, kind)
    paths = known.mapInArrow(_paths(kind), "ids binary, c long, spread long, path long")
    masses = stash(paths.groupBy("path").agg(F.sum(F.col("c") + 1).alias("mass"), F.count("*").alias("words")), "masses")
    known = stash(join_hot(paths, masses.select("path", "mass"), "path", masses.where("words >= 20000").select("path")), "known", "zstd")
    unseen = (once + 1) / (n + once + 2)
    params, _ = fit(texts, kind, chain, shares, vocab, rounds, share)
    sent = spark.sparkContext.broadcast((params, kind, chain))  # bounded by the vocabulary and the chain's fixed tables
    rest = math.log10(n + v + 1)

    def score(group: pa.Table, known: pa.Table) -> pa.Table:
        p, kind, chain = sent.value
        block = Block.read(group.combine_chunks().to_batches()[0], 0, kind)  # a block is one row
        lengths, tokens = block.lengths, block.tokens
        c, mass = np.zeros((2, len(block.at)), np.int64)
        number, *found = _unpacked(known)
        c[number], mass[number] = found
        listed = Words(block.kinds, chain, c > 0)
        vectors, inside = listed.vectors(p), log_inside(unseen, c, mass)
        rate = np.log10(c + 1.0) - rest
        out: dict[str, list] = {k: [] for k in ("n_tokens", "n_known", "base_score", "score")}
        held = ~block.learn & pc.is_valid(block.doc_id).to_numpy(zero_copy_only=False)
        for lo in range(0, len(held), 500):
            sizes = lengths[lo : lo + 500]
            flat, tokens = np.split(tokens, [sizes.sum()])
            cut = np.cumsum(sizes) - sizes
            logs = token_logs(p, listed, unseen, c, mass, flat, sizes, vectors, inside)
            out["score"] += (np.add.reduceat(logs, cut) / math.log(10)).tolist()
            out["base_score"] += np.add.reduceat(rate[flat], cut).tolist()
            out["n_tokens"] += sizes.tolist()
            out["n_known"] += np.add.reduceat((c[flat] > 0).astype(np.int64), cut).tolist()
        real = lambda k: pa.array(out[k], pa.float64())
        whole = lambda k: pa.array(out[k], pa.int64())
        return pa.table({
            "doc_id": block.doc_id, "held_out": pa.array(held, pa.bool_()), "n_tokens": whole("n_tokens"), "n_known": whole("n_known"),
            "train_tokens": pa.array([n] * len(held), pa.int64()), "base_score": real("base_score"), "score": real("score"),
        })

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    # Written down before the texts move, so that the words' shuffle is gone by then.
    packed = stash(with_totals(words, known, blocks).mapInArrow(_packed(), _PACKED), "packed", "zstd").withColumnRenamed("block", "of")
    for used in (totals, masses, known):
        drop_stash(used)
    return texts.groupBy("block").cogroup(packed.groupBy("of")).applyInArrow(score, schema)


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"), vocabulary())


QUERIES = {"op8_lm_score": op8_lm_score}
SQL: dict[str, str] = {}
