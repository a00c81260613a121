"""Exact near-duplicate vectors by cover-tree dual traversal.

Unit vectors at cosine c are sqrt(2 - 2 c) apart, so a cosine threshold is a radius. Equal vectors become one class
first. The upper levels of a cover tree, over a bounded sample, cut space into cells; a cell is dealt into blocks of
bounded size, and each block builds its own tree of nested levels with halving radii, whose nodes keep their real
covering radius. Cell pairs, then node pairs, are pruned when the centers are farther apart than the threshold and both
covering radii; they are linked as a whole, without going through their vectors, when even the farthest vectors are near
enough; otherwise their children are compared, and at the leaves the cosines themselves, in double precision.

Each block pair is a task of its own with two blocks as input. It returns counts of links, and edges that connect what the
links connect: leaves are so small that all their vectors are linked, so an edge between two leaves stands for all.

Defined results: vectors that are null, empty, zero or hold null or non-finite components link with nothing, and so do
vectors of different lengths. Each row is a vector of its own, also if its vec_id repeats; rows with a null vec_id are
compared like others and have no kept mark. An empty table gives an empty table. Only vec_id and embedding are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, stash, table

LEVELS = (1.0, 0.5, 0.25, 0.125)
EPS = 1e-9
MARGIN = 1e-4  # far above the error of a product of unit vectors in single precision


def _unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for v in b["embedding"].to_pylist():
            x = None
            if v and None not in v:
                x = np.array(v, dtype=np.float64)
                top = np.abs(x).max()
                if np.isfinite(top) and top > 0:
                    x = x / top  # so that squares neither overflow nor vanish
                    x = x / math.sqrt(float(x @ x))
                else:
                    x = None
            out.append(None if x is None else (x + 0.0).tobytes())
        yield pa.RecordBatch.from_arrays([b["vec_id"], pa.array(out, pa.binary())], names=["vec_id", "x"])


def net(x: np.ndarray, at: np.ndarray, radius: float, batch: int = 256) -> list[np.ndarray]:
    """Greedy net: groups of the points ``at``, each with the first center within ``radius`` of it; the first group starts with at[0]."""
    least = 1 - radius * radius / 2
    centers, owner = np.zeros(0, np.int64), np.empty(len(at), np.int64)
    for lo in range(0, len(at), batch):
        new = at[lo : lo + batch]
        own = np.full(len(new), -1)
        if len(centers):
            near = x[new] @ x[centers].T >= least
            own = np.where(near.any(1), near.argmax(1), -1)
        near = x[new] @ x[new].T >= least
        for i in range(len(new)):
            if own[i] < 0:
                own[(own < 0) & near[i]] = len(centers)
                own[i] = len(centers)
                centers = np.append(centers, new[i])
        owner[lo : lo + batch] = own
    order = np.argsort(owner, kind="stable")
    return np.split(at[order], np.searchsorted(owner[order], np.arange(1, len(centers))))


def build(x: np.ndarray) -> dict:
    """The tree over the rows of ``x``: for each node its center, covering radius, and children or (at leaves) none."""
    center, radius, members, children, depth = [], [], [], [], []

    def add(group: np.ndarray, level: int) -> int:
        far = 1 - (x[group] @ x[group[0]]).min() if len(group) > 1 else 0.0
        center.append(int(group[0]))
        radius.append(math.sqrt(max(0.0, 2 * far)) + (EPS if len(group) > 1 else 0.0))
        members.append(group)
        children.append([])
        depth.append(level)
        return len(center) - 1

    top = [add(g, 0) for g in net(x, np.arange(len(x)), LEVELS[0])]
    todo = list(top)
    while todo:
        node = todo.pop()
        if len(members[node]) > 1 and depth[node] + 1 < len(LEVELS):
            kids = [add(g, depth[node] + 1) for g in net(x, members[node], LEVELS[depth[node] + 1])]
            children[node] = kids
            todo += kids
    return {"top": top, "center": center, "radius": radius, "members": members, "children": children}


class Traversal:
    """The dual traversal of two trees (or of one with itself).

    Node pairs are met in bulk: the centers of one node's children against those of all nodes that it still meets, as one
    product of matrices. These products are in single precision and prune with a margin above its error; whatever
    links, links by a product in double precision.
    """

    def __init__(self, a: dict, b: dict, same: bool, cosine: float):
        self.a, self.b, self.same, self.cosine = a, b, same, cosine
        self.reach = math.sqrt(2 - 2 * cosine)
        self.links = (np.zeros(len(a["x"]), np.int64), np.zeros(len(b["x"]), np.int64))
        self.edges: list[tuple[np.ndarray, np.ndarray]] = []  # positions in a and b
        for t in (a, b):
            t["kids"] = [np.array(c or [n]) for n, c in enumerate(t["children"])]
            t["leaf"] = np.array([not c for c in t["children"]], bool)
            t["single"] = np.array([len(m) == 1 for m in t["members"]], bool)
            t["at"] = np.array(t["center"])
            t["reach"] = np.array(t["radius"])
            t["short"] = t["x"][t["at"]].astype(np.float32)  # by node

    def run(self) -> None:
        top = [np.array(t["top"]) for t in (self.a, self.b)]
        # Nodes of one vector have no radius: one threshold for all of their pairs, and no descent.
        one, many = zip(*[(n[t["single"][n]], n[~t["single"][n]]) for t, n in zip((self.a, self.b), top, strict=True)], strict=True)
        todo = []
        for lo in range(0, len(one[0]), 512):
            p = one[0][lo : lo + 512]
            q = one[1][lo:] if self.same else one[1]
            i, j = np.divmod(np.flatnonzero(self.a["short"][p] @ self.b["short"][q].T >= np.float32(self.cosine - MARGIN)), max(1, len(q)))
            p, q = p[i], q[j]
            self.singles(p[p < q], q[p < q]) if self.same else self.singles(p, q)
        for p in many[0]:
            todo.append((np.array([p]), top[1][top[1] >= p] if self.same else top[1]))
        if not self.same:
            todo += [(one[0], np.array([q])) for q in many[1]]
        else:  # pairs (single, node of many) with the single first
            todo += [(one[0][one[0] < q], np.array([q])) for q in many[1]]
        while todo:
            todo += self.meet(*todo.pop())

    def singles(self, p: np.ndarray, q: np.ndarray) -> None:
        """Links of pairs of nodes of one vector each."""
        i, j = self.a["at"][p], self.b["at"][q]
        near = np.einsum("ij,ij->i", self.a["x"][i], self.b["x"][j]) >= self.cosine
        i, j = i[near], j[near]
        np.add.at(self.links[0], i, self.b["copies"][j])
        np.add.at(self.links[1], j, self.a["copies"][i])
        self.edges.append((i, j))

    def meet(self, p: np.ndarray, q: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Pairs of the nodes ``p`` and ``q`` that neither the covering radii part nor their leaves settle, as pairs of children.

        One of the two holds one node, unless they are children of two nodes.
        """
        a, b = self.a, self.b
        if not len(p) or not len(q):
            return []
        far = self.reach + MARGIN + a["reach"][p][:, None] + b["reach"][q][None, :]
        i, j = np.nonzero(a["short"][p] @ b["short"][q].T >= 1 - far * far / 2 - MARGIN)
        p, q = p[i], q[j]
        own = (p == q) if self.same else np.zeros(len(p), bool)
        keep = ~(own & a["single"][p])
        p, q, own = p[keep], q[keep], own[keep]
        whole = np.zeros(len(p), bool)
        r = a["reach"][p] + b["reach"][q]
        maybe = np.flatnonzero((r > 0) & (r <= self.reach))
        if len(maybe):
            dots = np.einsum("ij,ij->i", a["x"][a["at"][p[maybe]]], b["x"][b["at"][q[maybe]]])
            d = np.where(own[maybe], 0.0, np.sqrt(np.maximum(0.0, 2 - 2 * dots)))
            whole[maybe] = d + r[maybe] <= self.reach - EPS
        for n in np.flatnonzero(whole):
            self.link(int(p[n]), int(q[n]), bool(own[n]))
        done = a["leaf"][p] & b["leaf"][q] & ~whole
        alone = done & a["single"][p] & b["single"][q]
        self.singles(p[alone], q[alone])
        for n in np.flatnonzero(done & ~alone):
            self.compare(int(p[n]), int(q[n]), bool(own[n]))
        out = []
        for n in np.flatnonzero(own & ~done & ~whole):
            kids = a["kids"][p[n]]
            out += [(kids[k : k + 1], kids[k:]) for k in range(len(kids))]
        rest = ~(own | done | whole)
        p, q = p[rest], q[rest]
        # The side with fewer nodes leads, so that its partners' children fill one matrix.
        lead, other, swap = (p, q, False) if len(np.unique(p)) <= len(np.unique(q)) else (q, p, True)
        order = np.argsort(lead, kind="stable")
        names, starts = np.unique(lead[order], return_index=True)
        for node, those in zip(names, np.split(other[order], starts[1:]), strict=True) if len(names) else ():
            mine = (b if swap else a)["kids"][node]
            theirs = np.concatenate([(a if swap else b)["kids"][t] for t in those])
            out.append((theirs, mine) if swap else (mine, theirs))
        return out

    def link(self, p: int, q: int, own: bool) -> None:
        """All vectors of two nodes link."""
        a, b = self.a, self.b
        mp, mq = a["members"][p], b["members"][q]
        wp, wq = a["copies"][mp], b["copies"][mq]
        if own:
            self.links[0][mp] += wp.sum() - wp
            self.edges.append((np.full(len(mp) - 1, mp[0]), mp[1:]))
        else:
            self.links[0][mp] += wq.sum()
            self.links[1][mq] += wp.sum()
            self.edges.append((a["at"][p : p + 1], b["at"][q : q + 1]))

    def compare(self, p: int, q: int, own: bool) -> None:
        """Links of the vectors of two leaves."""
        a, b = self.a, self.b
        mp, mq = a["members"][p], b["members"][q]
        near = a["x"][mp] @ b["x"][mq].T >= self.cosine
        if own:
            np.fill_diagonal(near, False)
            self.links[0][mp] += near @ a["copies"][mp]
        else:
            self.links[0][mp] += near @ b["copies"][mq]
            self.links[1][mq] += near.T @ a["copies"][mp]
        i, j = np.nonzero(near)
        # The vectors of a leaf are all linked if the threshold allows its diameter; then one edge is enough.
        keep = 1 if not own and 2 * LEVELS[-1] + 2 * EPS < self.reach else len(i)
        self.edges.append((mp[i[:keep]], mq[j[:keep]]))


def _pack(group: pa.Table) -> pa.Table:
    """One row for a block: class numbers, numbers of copies, vectors, and the tree as node arrays."""
    order = np.argsort(group["cid"].to_numpy())
    x = np.stack([np.frombuffer(group["x"][int(i)].as_py(), np.float64) for i in order])
    t = build(x)
    flat = lambda ls: (np.concatenate([np.zeros(0, np.int64), *map(np.asarray, ls)]).astype(np.int64).tolist(), np.cumsum([0, *map(len, ls)]).tolist())
    members, m_at = flat(t["members"])
    children, c_at = flat(t["children"])
    numbers, floats = pa.list_(pa.int64()), pa.list_(pa.float64())
    kinds = [pa.int64(), numbers, numbers, pa.binary(), numbers, numbers, floats, numbers, numbers, numbers, numbers]
    columns = {
        "block": [group["block"][0].as_py()], "cid": [group["cid"].to_numpy()[order].tolist()], "copies": [group["copies"].to_numpy()[order].tolist()], "x": [x.tobytes()],
        "top": [t["top"]], "center": [t["center"]], "radius": [t["radius"]], "members": [members], "m_at": [m_at], "children": [children], "c_at": [c_at],
    }
    return pa.table([pa.array(v, k) for v, k in zip(columns.values(), kinds, strict=True)], names=list(columns))


_TREE = (
    "block long, cid array<long>, copies array<long>, x binary, top array<long>, center array<long>, radius array<double>, "
    "members array<long>, m_at array<long>, children array<long>, c_at array<long>"
)


def _unpack(r: dict) -> dict:
    cut = lambda ls, at: [ls[lo:hi] for lo, hi in zip(at, at[1:], strict=False)]
    return {
        "cid": np.array(r["cid"]), "copies": np.array(r["copies"]), "x": np.frombuffer(r["x"], np.float64).reshape(len(r["cid"]), -1),
        "top": r["top"], "center": r["center"], "radius": r["radius"],
        "members": cut(np.array(r["members"]), r["m_at"]), "children": cut(r["children"], r["c_at"]),
    }


def _compare(cosine: float):
    def run(group: pa.Table) -> pa.Table:
        i, j = group["i"][0].as_py(), group["j"][0].as_py()
        trees = {r["block"]: _unpack(r) for r in group.drop_columns(["i", "j"]).to_pylist()}
        a, b = trees[i], trees[j]
        t = Traversal(a, b, i == j, cosine)
        if a["x"].shape[1] == b["x"].shape[1]:
            t.run()
        cid, links = [], []
        for tree, n in zip((a, b), t.links, strict=True):
            cid.append(tree["cid"][n > 0])
            links.append(n[n > 0])
        none = np.zeros(0, np.int64)
        u = a["cid"][np.concatenate([none, *[x for x, _ in t.edges]])]
        v = b["cid"][np.concatenate([none, *[y for _, y in t.edges]])]
        n = sum(map(len, links))
        other = pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(v, pa.int64())])
        return pa.table({"cid": pa.array(np.concatenate([*cid, u]), pa.int64()), "links": pa.array(np.concatenate([*links, np.zeros_like(u)]), pa.int64()), "other": other})

    return run


def upper_levels(sample: np.ndarray, most: int = 256) -> np.ndarray:
    """Centers of the lowest cover-tree level that has at most ``most`` nodes over a sample."""
    best = sample[:1]
    for radius in (2.0, *LEVELS):
        groups = net(sample, np.arange(len(sample)), radius)
        if len(groups) > most:
            break
        best = sample[[g[0] for g in groups]]
    return best


def near_vectors(vectors: DataFrame, cosine: float = 0.9, block: int = 8192, sample: int = 4096) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row. ``sample`` bounds the vectors that shape the upper levels."""
    spark = vectors.sparkSession
    raw = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = stash(raw.mapInArrow(_unit, "vec_id long, x binary").withColumn("k", F.md5("x")), "vectors")
    real = rows.where("x is not null")
    classes = real.groupBy("k").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("x").alias("x"))
    classes = stash(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")

    cells = {}  # centers by vector length
    for r in classes.orderBy(F.xxhash64("k")).select("x").limit(sample).collect():
        cells.setdefault(len(r.x), []).append(np.frombuffer(r.x, np.float64))
    tops = {n: upper_levels(np.stack(v)) for n, v in cells.items()}
    first = {n: sum(len(t) for m, t in tops.items() if m < n) for n in tops}
    spare = sum(map(len, tops.values()))  # vectors of a length that the sample lacks share one cell for each length

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cell, away = [], []
            for raw_x in b["x"].to_pylist():
                top = tops.get(len(raw_x))
                if top is None:
                    cell.append(spare + len(raw_x))
                    away.append(2.0)
                    continue
                dots = top @ np.frombuffer(raw_x, np.float64)
                cell.append(first[len(raw_x)] + int(dots.argmax()))
                away.append(math.sqrt(max(0.0, 2 - 2 * float(dots.max()))))
            yield pa.RecordBatch.from_arrays([b["cid"], b["copies"], b["x"], pa.array(cell, pa.int64()), pa.array(away, pa.float64())],
                                             names=["cid", "copies", "x", "cell", "away"])

    placed = stash(classes.select("cid", "copies", "x").mapInArrow(place, "cid long, copies long, x binary, cell long, away double"), "placed")
    sizes = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("away").alias("r")).collect()  # at most 256 for each vector length
    centers = {first[n] + i: c for n, t in tops.items() for i, c in enumerate(t)}
    parts = {s.cell: max(1, -(-s.n // block)) for s in sizes}
    reach = math.sqrt(2 - 2 * cosine)
    pairs = []
    for s in sizes:
        for t in sizes:
            if s.cell > t.cell or (s.cell != t.cell and (s.cell not in centers or t.cell not in centers or len(centers[s.cell]) != len(centers[t.cell]))):
                continue
            d = 0.0 if s.cell == t.cell else math.sqrt(max(0.0, 2 - 2 * float(centers[s.cell] @ centers[t.cell])))
            if d <= reach + s.r + t.r + EPS:
                pairs.append((s.cell, t.cell, parts[s.cell], parts[t.cell]))
    sides = spark.createDataFrame(pairs, "c1 long, c2 long, n1 int, n2 int")
    sides = sides.withColumn("p1", F.explode(F.sequence(F.lit(0), F.col("n1") - 1))).withColumn("p2", F.explode(F.sequence(F.lit(0), F.col("n2") - 1)))
    number = lambda c, p: F.col(c) * (1 << 32) + F.col(p)
    sides = sides.select(number("c1", "p1").alias("i"), number("c2", "p2").alias("j")).where("i <= j")

    part_of = F.pmod(F.xxhash64("cid"), F.element_at(F.create_map(*[F.lit(v).cast("long") for kv in parts.items() for v in kv]), F.col("cell"))) if parts else F.lit(0)
    blocks = placed.withColumn("block", F.col("cell") * (1 << 32) + part_of).select("block", "cid", "copies", "x")
    trees = stash(blocks.groupBy("block").applyInArrow(_pack, _TREE), "trees")
    sent = sides.withColumn("block", F.explode(F.array_distinct(F.array("i", "j")))).join(trees, "block")
    out = stash(sent.groupBy("i", "j").applyInArrow(_compare(cosine), "cid long, links long, other long"), "links")

    links = out.where("other is null").groupBy("cid").agg(F.sum("links").alias("links"))
    parts_of = components(out.where("other is not null").select(F.col("cid").alias("a"), F.col("other").alias("b")))
    named = classes.select("cid", "k", "rep", "copies").join(parts_of.withColumnRenamed("id", "cid"), "cid", "left")
    named = named.withColumn("component", F.coalesce("component", "cid")).join(links, "cid", "left")
    named = stash(named.select("k", "component", "rep", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "named")
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = named.join(least, "component").select("k", "n_links", "component_id")
    out = rows.select("vec_id", "k").join(named, "k", "left")
    comp = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), comp.alias("component_id"), (F.col("vec_id") == comp).alias("kept"))


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), cosine=0.9)


QUERIES = {"op1_embedding_dedup": op1_embedding_dedup}
SQL: dict[str, str] = {}
