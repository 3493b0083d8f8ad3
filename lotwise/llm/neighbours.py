"""Approximate nearest neighbours by cosine: a neighbour graph from NN-descent, searched greedily."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Staged
from .textkit import mix

#: The first blocks come from random hyperplanes whose thresholds are medians of at most SAMPLE vectors.
SAMPLE = 20_000
TREES = 2
LEAF = 512
#: NN-descent stops when less than this share of all edges is new, or after ROUNDS.
STILL = 0.02
ROUNDS = 10
#: Nodes whose neighbours are joined in one task.
NODES = 8_192


def _ints(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int64)


def _parts(ids: np.ndarray, n_parts: int) -> np.ndarray:
    return (mix(ids.astype(np.uint64)) % np.uint64(n_parts)).astype(np.int64)


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector) of rows that take part: an id, and a vector of the commonest length without null or non-finite
    components that is not zero. Vectors are scaled by a power of two, which is exact and changes no cosine, so that their
    largest component is near 1: squares of very small and very large doubles neither vanish nor overflow."""
    v = F.col(vector_col)
    good = rows.filter(F.col(id_col).isNotNull() & v.isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.transform(v, lambda x: x.cast("double")).alias("vector"))
    good = good.filter(F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0))
    length = good.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), "length").limit(1).collect()
    good = good.filter(F.size("vector") == (length[0].length if length else 0))
    power = F.greatest(F.lit(-1022), F.least(F.lit(1022), -F.floor(F.log2(F.array_max(F.transform("vector", lambda x: F.abs(x)))))))
    return good.withColumn("_scale", F.pow(F.lit(2.0), power.cast("double"))).select("id", F.transform("vector", lambda x: x * F.col("_scale")).alias("vector"))


@dataclass
class Tree:
    """Hyperplanes of one random tree; a leaf that is still too large is dealt into blocks by the hash of the id."""

    planes: np.ndarray
    cuts: np.ndarray
    children: np.ndarray  # (node, side) -> next node, or -1 - leaf
    blocks: np.ndarray  # of each leaf

    @classmethod
    def of(cls, sample: np.ndarray, n_rows: int, rng: np.random.Generator) -> Tree:
        planes, cuts, children, blocks = [], [], [], []
        share = n_rows / max(1, len(sample))

        def grow(rows: np.ndarray) -> int:
            if len(rows) * share > LEAF and len(rows) >= 16:
                a, b = sample[rng.choice(rows, 2, replace=False)]
                along = sample[rows] @ (a - b)
                cut = float(np.median(along))
                left, right = rows[along <= cut], rows[along > cut]
                if len(left) and len(right):
                    node = len(planes)
                    planes.append(a - b)
                    cuts.append(cut)
                    children.append([0, 0])
                    children[node] = [grow(left), grow(right)]
                    return node
            blocks.append(max(1, int(np.ceil(len(rows) * share / LEAF))))
            return -len(blocks)

        grow(np.arange(len(sample)))
        d = sample.shape[1]
        return cls(np.array(planes).reshape(-1, d), np.array(cuts), np.array(children, np.int64).reshape(-1, 2), np.array(blocks))

    def block(self, vectors: np.ndarray, ids: np.ndarray) -> np.ndarray:
        node = np.full(len(vectors), 0 if len(self.cuts) else -1)
        while len(inner := np.flatnonzero(node >= 0)):
            at = node[inner]
            side = np.einsum("ij,ij->i", vectors[inner], self.planes[at]) > self.cuts[at]
            node[inner] = self.children[at, side.astype(int)]
        leaf = -1 - node
        first = np.concatenate([[0], np.cumsum(self.blocks)])
        return first[leaf] + _parts(ids + 7, 1 << 62) % self.blocks[leaf]


def _best(owner: np.ndarray, other: np.ndarray, near: np.ndarray, fresh: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The k nearest of each owner, each other once (not fresh where one of its rows isn't), sorted by owner and nearness."""
    order = np.lexsort((fresh, other, owner))
    owner, other, near, fresh = owner[order], other[order], near[order], fresh[order]
    once = np.ones(len(owner), bool)
    once[1:] = (owner[1:] != owner[:-1]) | (other[1:] != other[:-1])
    owner, other, near, fresh = owner[once], other[once], near[once], fresh[once]
    order = np.lexsort((other, -near, owner))
    owner, other, near, fresh = owner[order], other[order], near[order], fresh[order]
    start = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else np.zeros(0, np.int64)
    rank = np.arange(len(owner)) - np.repeat(start, np.diff(np.append(start, len(owner))))
    keep = rank < k
    return owner[keep], other[keep], near[keep], fresh[keep]


def _packed(owner: np.ndarray, other: np.ndarray, near: np.ndarray, n_parts: int) -> pa.Table:
    """Candidate edges as one row for each part of their owners."""
    part = _parts(owner, n_parts)
    order = np.argsort(part, kind="stable")
    part, owner, other, near = part[order], owner[order], other[order], near[order].astype(np.float32)
    names, at = np.unique(part, return_index=True)
    ends = [*at[1:].tolist(), len(part)]
    cut = lambda x: pa.array([x[a:b].tobytes() for a, b in zip(at.tolist(), ends)], pa.binary())
    return pa.table({"part": pa.array(names, pa.int64()), "owner": cut(owner), "other": cut(other), "near": cut(near)})


CANDIDATES = "part long, owner binary, other binary, near binary"
GRAPH = "part long, id long, vec binary, nbrs binary, near binary, fresh binary, n_fresh long, kth float"


def _first_blocks(nodes: DataFrame, trees: list[Tree], k: int, n_parts: int) -> DataFrame:
    """Candidates from exact search inside each tree's blocks."""

    def place(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            if batch.num_rows:
                ids = batch.column("id").to_numpy()
                v = np.frombuffer(b"".join(batch.column("vec").to_pylist()), np.float16).reshape(len(ids), -1).astype(np.float32)
                for t, tree in enumerate(trees):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), t)), pa.array(tree.block(v, ids)), batch.column("id"), batch.column("vec")], ["tree", "block", "id", "vec"])

    def search(group: pa.Table) -> pa.Table:
        ids = group.column("id").to_numpy()
        v = np.frombuffer(b"".join(group.column("vec").to_pylist()), np.float16).reshape(len(ids), -1).astype(np.float32)
        n = min(k, len(ids) - 1)
        if not n:
            return _packed(ids[:0], ids[:0], np.zeros(0), n_parts)
        owners, others, near = [], [], []
        for lo in range(0, len(ids), 1024):
            s = v[lo : lo + 1024] @ v.T
            s[np.arange(len(s)), np.arange(lo, lo + len(s))] = -9
            best = np.argpartition(-s, n - 1, axis=1)[:, :n]
            owners.append(np.repeat(ids[lo : lo + 1024], n))
            others.append(ids[best].ravel())
            near.append(np.take_along_axis(s, best, 1).ravel())
        return _packed(*map(np.concatenate, (owners, others, near)), n_parts)

    placed = nodes.select("id", "vec").mapInArrow(place, "tree long, block long, id long, vec binary")
    return placed.groupBy("tree", "block").applyInArrow(search, CANDIDATES)


def _updated(graph: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """The graph with each node's best k of its neighbours and candidates."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        ids = left.column("id").to_numpy()
        order = np.argsort(ids)
        ids = ids[order]
        counts = np.array([len(x) // 8 for x in left.column("nbrs").to_pylist()], np.int64)
        owner = np.concatenate([np.repeat(left.column("id").to_numpy(), counts), _ints(right.column("owner"))])
        other = np.concatenate([_ints(left.column("nbrs")), _ints(right.column("other"))])
        near = np.concatenate([np.frombuffer(b"".join(t.column("near").to_pylist()), np.float32) for t in (left, right)])
        fresh = np.ones(len(owner), bool)
        fresh[: counts.sum()] = False
        owner, other, near, fresh = _best(owner, other, near, fresh, k)
        known = np.isin(owner, ids)  # always so, but for candidates of rows that a caller has taken out
        owner, other, near, fresh = owner[known], other[known], near[known], fresh[known]
        at = np.searchsorted(owner, np.append(ids, np.iinfo(np.int64).max)).tolist()
        cut = lambda x: pa.array([x[a:b].tobytes() for a, b in zip(at, at[1:])], pa.binary())
        n_fresh = [int(fresh[a:b].sum()) for a, b in zip(at, at[1:])]
        kth = [float(near[b - 1]) if b - a >= k else -9.0 for a, b in zip(at, at[1:])]  # what a candidate must beat
        vec = left.column("vec").take(pa.array(order))
        part = left.column("part").take(pa.array(order))
        return pa.table({"part": part, "id": pa.array(ids), "vec": vec, "nbrs": cut(other), "near": cut(near), "fresh": cut(fresh.view(np.uint8)), "n_fresh": pa.array(n_fresh, pa.int64()), "kth": pa.array(kth, pa.float32())})

    return graph.groupBy("part").cogroup(candidates.groupBy("part")).applyInArrow(run, GRAPH)


def _joined(graph: DataFrame, k: int, n_parts: int) -> DataFrame:
    """Candidates from joining each node's neighbours, and nodes that it is a neighbour of, with each other; pairs of
    which neither edge is new have met before. Of a node's reverse edges at most k from each batch are sent and k are used."""

    def messages(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            counts = np.array([len(x) // 8 for x in batch.column("nbrs").to_pylist()], np.int64)
            node = np.repeat(batch.column("id").to_numpy(), counts)
            nbr = _ints(batch.column("nbrs"))
            fresh = np.frombuffer(b"".join(batch.column("fresh").to_pylist()), np.uint8)
            reverse = _best(nbr, node, (mix((nbr * 31 + node).astype(np.uint64)) >> np.uint64(40)).astype(float) + fresh * 2.0**30, fresh > 0, k)
            mid = np.concatenate([node, reverse[0]])
            member = np.concatenate([nbr, reverse[1]])
            is_new = np.concatenate([fresh, reverse[3].astype(np.uint8)])
            part = _parts(mid, n_parts)
            order = np.argsort(part, kind="stable")
            part, mid, member, is_new = part[order], mid[order], member[order], is_new[order]
            names, at = np.unique(part, return_index=True)
            ends = [*at[1:].tolist(), len(part)]
            cut = lambda x: pa.array([x[a:b].tobytes() for a, b in zip(at.tolist(), ends)], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), cut(mid), cut(member), cut(is_new)], ["part", "mid", "member", "fresh"])

    def needs(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for part, raw in zip(batch.column("part").to_pylist(), batch.column("member").to_pylist()):
                ids = np.unique(np.frombuffer(raw, np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), part)), pa.array(ids)], ["part", "id"])

    def join(left: pa.Table, right: pa.Table) -> pa.Table:
        mid, member = _ints(left.column("mid")), _ints(left.column("member"))
        fresh = np.frombuffer(b"".join(left.column("fresh").to_pylist()), np.uint8) > 0
        order = np.argsort(right.column("id").to_numpy())
        ids = right.column("id").to_numpy()[order]
        v = np.frombuffer(b"".join(right.column("vec").to_pylist()), np.float16).reshape(len(ids), -1)[order]
        kth = right.column("kth").to_numpy()[order]
        order = np.lexsort((member, mid))
        mid, member, fresh = mid[order], np.searchsorted(ids, member[order]), fresh[order]
        start = np.append(np.flatnonzero(np.concatenate([[True], mid[1:] != mid[:-1]])), len(mid))
        owners, others, near = [], [], []
        for a, b in zip(start.tolist(), start[1:].tolist()):
            m, at = np.unique(member[a:b], return_index=True)
            new = fresh[a:b][at]
            if len(m) > 2 * k:
                keep = np.sort(np.argsort(mix(m.astype(np.uint64) + np.uint64(a)), kind="stable")[: 2 * k])
                m, new = m[keep], new[keep]
            if len(m) < 2 or not new.any():
                continue
            x = v[m].astype(np.float32)
            s = x @ x.T
            ok = s > kth[m][:, None]
            ok &= new[:, None] | new[None, :]
            np.fill_diagonal(ok, False)
            i, j = np.nonzero(ok)
            owners.append(m[i])
            others.append(m[j])
            near.append(s[i, j])
        if not owners:
            return _packed(ids[:0], ids[:0], np.zeros(0), n_parts)
        o, c, s, _ = _best(np.concatenate(owners), np.concatenate(others), np.concatenate(near), np.zeros(sum(map(len, near)), bool), k)
        return _packed(ids[o], ids[c], s, n_parts)

    sent = graph.select("id", "nbrs", "fresh").mapInArrow(messages, "part long, mid binary, member binary, fresh binary")
    wanted = sent.select("part", "member").mapInArrow(needs, "part long, id long").distinct()
    vectors = wanted.join(graph.select("id", "vec", "kth"), "id").select("part", "id", "vec", "kth")
    return sent.groupBy("part").cogroup(vectors.groupBy("part")).applyInArrow(join, CANDIDATES)


def neighbour_graph(nodes: DataFrame, staged: Staged, k: int = 48) -> DataFrame:
    """The k nearest neighbours that NN-descent finds for every node (id, vector), as rows of GRAPH.

    Vectors are unit vectors of 16-bit floats here. Nodes are dealt to parts by the hash of their id; a part gets each
    vector that its nodes' joins need once, however many of them need it."""

    def unit(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            if batch.num_rows:
                ids = batch.column("id").to_numpy()
                v = _unit(batch.column("vector").flatten().to_numpy().reshape(len(ids), -1)).astype(np.float16)
                empty = pa.array([b""] * len(ids), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(_parts(ids, n_parts)), batch.column("id"), pa.array([x.tobytes() for x in v], pa.binary()), empty, empty, empty, pa.array(np.zeros(len(ids), np.int64)), pa.array(np.full(len(ids), -9, np.float32))], ["part", "id", "vec", "nbrs", "near", "fresh", "n_fresh", "kth"])

    n = nodes.count()
    n_parts = max(int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // NODES))
    graph = staged.write("graph", nodes.mapInArrow(unit, GRAPH))
    picked = graph.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("vec").collect()
    sample = np.array([np.frombuffer(r.vec, np.float16) for r in picked]).astype(np.float32)
    rng = np.random.default_rng(11)
    trees = [Tree.of(sample, n, rng) for _ in range(TREES)] if n else []
    candidates = _first_blocks(graph, trees, k, n_parts)
    for round_ in range(ROUNDS):
        old = staged.paths.pop("graph", [])
        graph = staged.write("graph", _updated(graph, candidates, k))
        staged.paths["old graph"] = old
        staged.drop("old graph")
        if not graph.filter("n_fresh > 0").limit(1).count() or round_ and graph.agg(F.sum("n_fresh")).first()[0] < STILL * k * n:
            break
        candidates = _joined(graph, k, n_parts)
    return graph


def greedy_search(graph: DataFrame, queries: DataFrame, staged: Staged, *, beam: int = 64, open_at_once: int = 16) -> DataFrame:
    """(query_id, id) of the `beam` nearest nodes that each query (query_id, vec, entry: a node, start: more ids as binary)
    reaches.

    Each round opens the nearest nodes of a query's beam that are not open yet, by a join with the graph, and measures their
    neighbours by a join with the vectors. The search ends when every node of every beam is open; queries that are done take
    no part in later rounds."""
    vectors = graph.select("id", "vec")
    state = "query_id long, vec binary, ids binary, near binary, opened binary, seen binary"
    names = ["query_id", "vec", "ids", "near", "opened", "seen"]
    beams = queries.select("query_id", "vec", *[F.lit(b"").alias(c) for c in ("ids", "near", "opened", "seen")])
    wanted = queries.select("query_id", F.col("start").alias("nbrs"))

    def fresh(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            lists = [np.frombuffer(x, np.int64) for x in batch.column("nbrs").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column("query_id").to_numpy(), [len(x) for x in lists])), pa.array(np.concatenate([*lists, np.zeros(0, np.int64)]))], ["query_id", "id"])

    def step(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return left
        row = left.slice(0, 1).to_pylist()[0]
        q = np.frombuffer(row["vec"], np.float16).astype(np.float32)
        ids, near, opened, seen = (np.frombuffer(row[c], t) for c, t in (("ids", np.int64), ("near", np.float32), ("opened", np.int64), ("seen", np.int64)))
        if right.num_rows:
            new = right.column("id").to_numpy()
            take = ~np.isin(new, seen)
            new = new[take]
            v = np.frombuffer(b"".join(right.column("other").to_pylist()), np.float16).reshape(right.num_rows, -1)[take].astype(np.float32)
            ids, near, seen = np.concatenate([ids, new]), np.concatenate([near, v @ q if len(new) else near[:0]]), np.concatenate([seen, new])
        keep = np.lexsort((ids, -near))[:beam]
        ids, near = ids[keep], near[keep]
        return pa.table({"query_id": pa.array([row["query_id"]], pa.int64()), "vec": pa.array([row["vec"]], pa.binary()), "ids": pa.array([ids.tobytes()], pa.binary()), "near": pa.array([near.tobytes()], pa.binary()), "opened": pa.array([opened.tobytes()], pa.binary()), "seen": pa.array([seen.tobytes()], pa.binary())})

    def choose(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            out = []
            for ids, opened in zip(batch.column("ids").to_pylist(), batch.column("opened").to_pylist()):
                ids, opened = np.frombuffer(ids, np.int64), np.frombuffer(opened, np.int64)
                out.append(np.concatenate([opened, ids[~np.isin(ids, opened)][:open_at_once]]).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()) if c == "opened" else batch.column(c) for c in names], names)

    def last_opened(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            ids = [np.frombuffer(x, np.int64) for x in batch.column("ids").to_pylist()]
            before = [np.frombuffer(x, np.int64) for x in batch.column("opened").to_pylist()]
            new = [i[~np.isin(i, o)][:open_at_once] for i, o in zip(ids, before)]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column("query_id").to_numpy(), [len(x) for x in new])), pa.array(np.concatenate([*new, np.zeros(0, np.int64)]))], ["query_id", "id"])

    pairs = wanted.mapInArrow(fresh, "query_id long, id long").unionByName(queries.select("query_id", F.col("entry").alias("id")))
    done = None
    while True:
        measured = pairs.distinct().join(vectors, "id").select("query_id", "id", F.col("vec").alias("other"))
        beams = staged.write("beams", beams.groupBy("query_id").cogroup(measured.groupBy("query_id")).applyInArrow(step, state))
        frontier = staged.write("frontier", beams.select("query_id", "ids", "opened").mapInArrow(last_opened, "query_id long, id long"))
        busy = frontier.select("query_id").distinct()
        ended = beams.join(busy, "query_id", "left_anti").select("query_id", "ids")
        done = ended if done is None else done.unionByName(ended)
        if frontier.isEmpty():
            return done.withColumnRenamed("ids", "nbrs").mapInArrow(fresh, "query_id long, id long")
        beams = beams.join(busy, "query_id", "left_semi").mapInArrow(choose, state)
        pairs = frontier.join(graph.select("id", "nbrs"), "id").select("query_id", "nbrs").mapInArrow(fresh, "query_id long, id long")


def nearest(rows: DataFrame, is_query, *, top: int = 5, k: int = 48, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the `top` nearest other rows found for each row for which `is_query` holds.

    Rows with equal vectors are one node of the graph and only the `top` + 1 smallest ids of a node are ever needed, so a
    vector that many rows share costs no more than another. A query starts at its own node's neighbours. Nodes found are
    measured again by the cosine of the original vectors in double precision; ties go to the smaller id. Vectors that are the
    same but for a power of two have the same cosines with all others and count as equal.

    Ids are integers; rows that share an id and differ in their vector are taken as they come. Null, zero, ragged and non-finite vectors and null ids take no part; with fewer candidates than `top` all are given."""
    staged = Staged(rows.sparkSession, "neighbours")
    table = staged.write("rows", usable(rows, id_col, vector_col).withColumn("key", F.md5(F.concat_ws(",", F.transform("vector", lambda x: (x + 0.0).cast("string"))).cast("binary"))))
    nodes = staged.write("nodes", table.groupBy("key").agg(F.min("id").alias("id"), F.count("*").alias("copies")))
    vectors = staged.write("vectors", table.join(nodes.select("key", "id"), ["key", "id"], "left_semi").dropDuplicates(["id"]).select("id", "vector"))
    graph = neighbour_graph(vectors, staged, k)
    first = Window.partitionBy("key").orderBy("vec_id")
    members = table.select("key", F.col("id").alias("vec_id")).distinct().withColumn("n", F.row_number().over(first)).filter(F.col("n") <= top + 1)
    members = staged.write("members", members.join(nodes.select("key", F.col("id").alias("node")), "key").select("node", "vec_id"))
    asked = table.withColumnRenamed("id", id_col).filter(is_query).select(F.col(id_col).alias("query_id"), "key")
    asked = staged.write("asked", asked.join(nodes.select("key", F.col("id").alias("node")), "key").select("query_id", "node"))
    starts = asked.select("node").distinct().join(graph, F.col("node") == F.col("id")).select(F.col("node").alias("query_id"), "vec", F.col("id").alias("entry"), F.col("nbrs").alias("start"))
    found = staged.write("found", greedy_search(graph, staged.write("starts", starts), staged))
    a, b = vectors.select(F.col("id").alias("query_id"), F.col("vector").alias("a")), vectors.select("id", F.col("vector").alias("b"))
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)
    scored = found.join(a, "query_id").join(b, "id").select(F.col("query_id").alias("node"), "id", (dot("a", "b") / (F.sqrt(dot("a", "a")) * F.sqrt(dot("b", "b")))).alias("score"))
    by_node = Window.partitionBy("node").orderBy(F.desc("score"), "id")
    scored = staged.write("scored", scored.withColumn("n", F.row_number().over(by_node)).filter(F.col("n") <= top + 1).select("node", "id", "score"))
    pairs = asked.join(scored, "node").join(members.withColumnRenamed("node", "id"), "id").filter("vec_id <> query_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    out = pairs.dropDuplicates(["query_id", "vec_id"]).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return out.select("query_id", "rank", "vec_id", "score")

