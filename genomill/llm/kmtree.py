"""Nearest neighbours by a hierarchical k-means tree (operator 7).

The tree is fitted on the driver on a bounded sample (``SAMPLE`` vectors at most); every
vector is then indexed: it goes to the leaf that it reaches by the nearest centre at each
level.  A query visits leaves best bin first, through a priority queue of tree nodes keyed
by the inner product that their vectors can have.  The number of visits is widened on
calibration queries against brute force over the sample until ``RECALL`` of their ``k``
nearest are found, and a query goes on until the leaves that it has visited hold enough
vectors.

Leaves are split into blocks of ``BLOCK`` vectors, so a very common vector is searched in
many places.  A place keeps the best k of each query; the best k of all places are the
result, in double precision on the original vectors, ties to the smaller vec_id.

Vectors that are null, empty, zero or hold null or non-finite components take no part, and
vectors of different lengths do not meet.  Rows of one vec_id are one item: equal ones count
once, and if its vectors differ, the nearest of them counts, of a query's as of a candidate's.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import save, table
from .vectors import classes, sample, stack

K = 20
SAMPLE, BRANCH, LEAF, MOST_LEAVES = 16_384, 12, 192, 4096
RECALL, CALIBRATION = 0.97, 128
BLOCK, SLOT_ROWS = 2048, 16_384


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    centres = np.unique(x[rng.permutation(len(x))[:k]], axis=0)
    for _ in range(rounds):
        to = nearest(x, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, to, x)
        n = np.bincount(to, minlength=len(centres))
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres, nearest(x, centres)


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres**2).sum(axis=1)[None, :] - 2 * (x @ centres.T), axis=1)


@dataclass
class Node:
    centre: np.ndarray
    radius: float
    leaf: int = -1
    children: list[Node] = field(default_factory=list)
    centres: np.ndarray | None = None


class Tree:
    """Hierarchical k-means over a sample; leaves are numbered from 0."""

    def __init__(self, x: np.ndarray, leaf: int = LEAF, branch: int = BRANCH, seed: int = 7) -> None:
        self.n_leaves = 0
        self.rng = np.random.default_rng(seed)
        self.leaf, self.branch = max(leaf, 1), branch
        self.root = self._grow(x)

    def _grow(self, x: np.ndarray) -> Node:
        centre = x.mean(axis=0)
        node = Node(centre, float(np.linalg.norm(x - centre, axis=1).max()))
        if len(x) > self.leaf:
            centres, to = _kmeans(x, min(self.branch, -(-len(x) // self.leaf) + 1), self.rng)
            used = np.unique(to)
            if len(used) > 1:
                node.children = [self._grow(x[to == c]) for c in used]
                node.centres = centres[used]
                return node
        node.leaf = self.n_leaves
        self.n_leaves += 1
        return node

    def assign(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), np.int32)

        def go(node: Node, rows: np.ndarray) -> None:
            if not node.children:
                out[rows] = node.leaf
                return
            to = nearest(x[rows], node.centres)
            for c, child in enumerate(node.children):
                go(child, rows[to == c])

        go(self.root, np.arange(len(x)))
        return out

    def visits(self, q: np.ndarray, sizes: np.ndarray, visits: int, least: int) -> list[int]:
        """Leaves by best-bin-first traversal: ``visits`` of them that hold vectors, and more
        until they hold ``least`` vectors."""
        norm = float(np.linalg.norm(q))
        heap, tie, out, held = [(0.0, 0, self.root)], 0, [], 0
        while heap and (len(out) < visits or held < least):
            _, _, node = heapq.heappop(heap)
            if node.leaf >= 0:
                if sizes[node.leaf]:
                    out.append(node.leaf)
                    held += int(sizes[node.leaf])
                continue
            for child in node.children:
                tie += 1
                heapq.heappush(heap, (-(float(q @ child.centre) + 0.5 * norm * child.radius), tie, child))
        return out


def top(q: np.ndarray, own: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query number, ids, scores) of each query's best k of a block, best first."""
    rough = q @ x.T
    slack = 1e-9 * (np.abs(rough).max() + 1e-300)
    for i in range(len(q)):
        row = rough[i]
        cut = np.partition(row, len(row) - k - 1)[len(row) - k - 1] - slack if len(row) > k + 1 else -np.inf
        at = np.flatnonzero((row >= cut) & (ids != own[i]))
        exact = (x[at] * q[i]).sum(axis=1)  # the same for equal vectors, wherever they stand
        best = np.lexsort((ids[at], -exact))[:k]
        yield i, ids[at][best], exact[best]


def calibrate(tree: Tree, x: np.ndarray, k: int = K, recall: float = RECALL, queries: int = CALIBRATION) -> int:
    """The fewest leaf visits that find ``recall`` of the k nearest of sample vectors."""
    leaf = tree.assign(x)
    sizes = np.bincount(leaf, minlength=tree.n_leaves)
    q = np.arange(0, len(x), max(1, len(x) // queries))[:queries]
    scores = x[q] @ x.T
    scores[np.arange(len(q)), q] = -np.inf
    k = min(k, len(x) - 1)
    if k < 1 or tree.n_leaves == 1:
        return 1
    true = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    # The place, in each query's traversal, of the leaf of each of its nearest.
    place = np.empty(true.shape, np.int64)
    for i, row in enumerate(q):
        order = np.empty(tree.n_leaves, np.int64)
        seen = tree.visits(x[row], np.maximum(sizes, 1), tree.n_leaves, 0)
        order[seen] = np.arange(len(seen))
        place[i] = order[leaf[true[i]]]
    for v in range(1, tree.n_leaves + 1):
        if (place < v).mean() >= recall:
            return v
    return tree.n_leaves


def search(rows: DataFrame, dim: int, n: int, k: int = K, every: int = 20) -> DataFrame:
    """query_id, vec_id, score: candidates for the best k of each query from each place.
    ``rows(id, dim, x)``; queries are the rows whose id is divisible by ``every``."""
    spark = rows.sparkSession
    fitted = sample(rows, dim, SAMPLE)
    # Leaves of the whole table hold about LEAF vectors each, up to MOST_LEAVES leaves.
    per = max(LEAF * len(fitted) / max(n, 1), len(fitted) / MOST_LEAVES, 8)
    tree = Tree(fitted, int(per))
    visits = calibrate(tree, fitted, k)
    sent = spark.sparkContext.broadcast(tree)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                leaf = sent.value.assign(stack(b.column("x"), dim))
                yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(leaf), b.column("x")], names=["id", "leaf", "x"])

    own = rows.filter(F.col("dim") == dim).select("id", "x")
    indexed = save(own.mapInArrow(index, "id bigint, leaf int, x binary"), "leaves")
    sizes = np.zeros(tree.n_leaves, np.int64)
    for r in indexed.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).collect():  # at most MOST_LEAVES rows or so
        sizes[r["leaf"]] = r["n"]
    blocks = -(-sizes // BLOCK)
    slots = max(1, -(-n // SLOT_ROWS))
    plan = spark.sparkContext.broadcast((sizes, blocks))

    def place(leaf: np.ndarray, block: np.ndarray) -> np.ndarray:
        return (leaf.astype(np.int64) * 1_000_003 + block * 7919) % slots

    def targets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes, blocks = plan.value
        for b in batches:
            if not b.num_rows:
                continue
            leaves = [sent.value.visits(q, sizes, visits, k + 1) for q in stack(b.column("x"), dim)]
            row = np.repeat(np.arange(len(leaves)), [len(x) for x in leaves])
            leaf = np.array([y for x in leaves for y in x], np.int64)
            nb = blocks[leaf]
            block = np.concatenate([np.arange(m) for m in nb]) if len(nb) else np.empty(0, np.int64)
            row, leaf = np.repeat(row, nb), np.repeat(leaf, nb)
            slot = place(leaf, block)
            # One row for a query and a slot, with the places to look at there.
            order = np.lexsort((slot, row))
            row, leaf, block, slot = row[order], leaf[order], block[order], slot[order]
            new = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (slot[1:] != slot[:-1])])) if len(row) else row
            to = pa.array(np.append(new, len(row)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(slot[new]), b.column("id").take(pa.array(row[new])), b.column("x").take(pa.array(row[new])), pa.ListArray.from_arrays(to, pa.array(leaf * (1 << 32) + block))],
                names=["slot", "id", "x", "places"],
            )

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, blocks = plan.value
        for b in batches:
            if b.num_rows:
                leaf = b.column("leaf").to_numpy().astype(np.int64)
                block = ((b.column("id").to_numpy() * 0x9E3779B1) >> 7) % blocks[leaf]
                yield pa.RecordBatch.from_arrays([pa.array(place(leaf, block)), pa.array(leaf * (1 << 32) + block), b.column("id"), b.column("x")], names=["slot", "place", "id", "x"])

    def meet(queries: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"query_id": np.empty(0, np.int64), "vec_id": np.empty(0, np.int64), "score": np.empty(0)})
        if not len(queries) or not len(vectors):
            return none
        vectors = vectors.sort_values(["place", "id"], kind="stable")
        at, ids, x = vectors["place"].to_numpy(), vectors["id"].to_numpy(), stack(vectors["x"].tolist(), dim)
        qid, q = queries["id"].to_numpy(), stack(queries["x"].tolist(), dim)
        n_places = queries["places"].map(len).to_numpy()
        who, where = np.repeat(np.arange(len(q)), n_places), np.concatenate(queries["places"].tolist())
        order = np.argsort(where, kind="stable")
        who, where = who[order], where[order]
        best: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in qid]
        heads = np.flatnonzero(np.concatenate([[True], where[1:] != where[:-1]]))
        for s, e in zip(heads, [*heads[1:], len(where)], strict=True):
            lo, hi = np.searchsorted(at, [where[s], where[s] + 1])
            for c in range(s, e, 512):
                mine = who[c : min(c + 512, e)]
                if hi > lo:
                    for i, found, score in top(q[mine], qid[mine], x[lo:hi], ids[lo:hi], k):
                        best[mine[i]].append((found, score))
        out = []
        for i, parts in enumerate(best):
            if parts:
                found, score = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
                keep = np.lexsort((found, -score))[:k]
                out.append(pd.DataFrame({"query_id": qid[i], "vec_id": found[keep], "score": score[keep]}))
        return pd.concat(out, ignore_index=True) if out else none

    asked = indexed.filter(F.pmod("id", F.lit(every)) == 0).select("id", "x").mapInArrow(targets, "slot bigint, id bigint, x binary, places array<bigint>")
    held = indexed.mapInArrow(spread, "slot bigint, place bigint, id bigint, x binary")
    return asked.groupBy("slot").cogroup(held.groupBy("slot")).applyInPandas(meet, "query_id bigint, vec_id bigint, score double")


def neighbours(embeddings: DataFrame, k: int = K, every: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest that each query found, nearest first."""
    rows = save(classes(embeddings).filter("key is not null and vec_id is not null").dropDuplicates(["vec_id", "key"]).select(F.col("vec_id").alias("id"), "dim", "x"), "vectors")
    forms = rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n")).first()["n"] or 1
    found = rows.sparkSession.createDataFrame([], "query_id bigint, vec_id bigint, score double")
    for r in rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).orderBy("dim").collect():
        found = found.union(search(rows, r["dim"], r["n"], k * forms, every))
    if forms > 1:
        found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def recall(embeddings: DataFrame, found: DataFrame, queries: int = 64, k: int = K, every: int = 20) -> float:
    """The share of the k nearest of about ``queries`` queries, picked by hash, that ``found``
    has, against brute force over all rows: a stated, bounded set of queries is sent to the rows,
    each task keeps its best k of each, and those meet by query."""
    rows = classes(embeddings).filter("key is not null and vec_id is not null").select(F.col("vec_id").alias("id"), "dim", "x")
    asked = rows.filter(F.pmod("id", F.lit(every)) == 0).orderBy(F.xxhash64("id"), "id").limit(queries).collect()
    sent = embeddings.sparkSession.sparkContext.broadcast([(r["id"], r["dim"], np.frombuffer(bytes(r["x"]))) for r in asked])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims, ids, blobs = b.column("dim").to_numpy(), b.column("id").to_numpy(), b.column("x").to_pylist()
            for q, dim, x in sent.value:
                at = np.flatnonzero((dims == dim) & (ids != q))
                if len(at):
                    score = (stack([blobs[i] for i in at], dim) * x).sum(axis=1)
                    best = np.lexsort((ids[at], -score))[:k]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(best), q)), pa.array(ids[at][best]), pa.array(score[best])], names=["query_id", "vec_id", "score"])

    near = rows.mapInArrow(run, "query_id bigint, vec_id bigint, score double").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    true = near.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= k).select("query_id", "vec_id")
    hits = true.join(found.select("query_id", "vec_id", F.lit(1).alias("hit")), ["query_id", "vec_id"], "left").agg(F.count(F.lit(1)).alias("n"), F.count("hit").alias("hits")).first()
    return hits["hits"] / hits["n"] if hits["n"] else 1.0


def op7_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours(table(spark, sf_dir, "embeddings"))
