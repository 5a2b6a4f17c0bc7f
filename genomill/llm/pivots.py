"""Near-duplicate vectors by a pivot-permutation index (operator 1).

Pivots are a bounded sample of the vectors, less those within a cosine ``cover`` of another
pivot, so that a dense group has few.  A vector within ``cover`` of its nearest pivot is
owned by it, and is compared with every vector that can be within reach of one so owned: by
the triangle inequality of angles those are within arccos(cover) + arccos(cosine) of the
pivot, its visitors.  So no pair with an owned member is missed; it is counted at the
smaller of its owners.  ``cover`` is the first of ``COVERS`` under which a vector visits
``VISITS`` pivots or fewer on average.

The other vectors lie in no dense group.  Each is described by its ``NEAREST`` nearest
pivots in order.  Inverted lists, one a pivot, retrieve candidates: two
vectors are compared only if they share at least ``SHARED`` of those pivots, and then by
the exact cosine in double precision.  Sharing ``SHARED`` of ``NEAREST`` implies sharing one
of the ``NEAREST - SHARED + 1`` that stand in the shortest lists, so only those lists are
kept, and a pair is counted in the first list that it shares alone.

Exact copies are one class from the start.  Lists (of pivots and of visitors) longer than
``BLOCK`` are split into blocks (of more than ``BLOCK`` vectors if there would be over
``BLOCKS``, up to ``MOST_BLOCK``), and pairs of blocks are compared in separate places; pairs are counted there and
never emitted: a block pair returns a count and a local component for each vector.

The number of pivots follows the number of vectors (one for ``PER_PIVOT``), up to
``MOST_PIVOTS``, which bounds what is broadcast; lists of a larger table are longer and
split into more blocks.

Vectors that are null, empty, zero or hold null or non-finite components link with nothing;
vectors of different lengths do not link.  A row's result is that of its vector: equal rows are
one vector, and a vector's links count the other vec_ids that hold it or a vector linked with
it, once for each of their vectors.  Classes are known by 64 bits of a digest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop, save, spread_join, table
from .components import connected_components
from .vectors import classes, sample, stack

COSINE = 0.95
NEAREST, SHARED = 10, 4
PER_PIVOT, LEAST_PIVOTS, MOST_PIVOTS = 50, 16, 8192
BLOCK, BLOCKS, MOST_BLOCK, SLOT_ROWS = 512, 16, 4096, 8192
COVERS, VISITS = (0.7, 0.8, 0.9, 0.95), 7


def apart(x: np.ndarray, cover: float) -> np.ndarray:
    """The unit vectors that are not within ``cover`` of an earlier one that is kept."""
    kept = x[:0]
    for i in range(0, len(x), 512):
        new = x[i : i + 512]
        new = new[(new @ kept.T).max(axis=1, initial=-1) < cover]
        near, ok = new @ new.T >= cover, np.ones(len(new), bool)
        for j in range(len(new)):
            ok[j] = not (near[j, :j] & ok[:j]).any()
        kept = np.concatenate([kept, new[ok]])
    return kept


def reach(cover: float, cosine: float) -> float:
    """The least cosine with a pivot of a vector that is within ``cosine`` of one it owns
    (a little less, for rounding)."""
    return float(np.cos(min(np.pi, np.arccos(cover) + np.arccos(np.clip(cosine, -1, 1))))) - 1e-9


def chosen_pivots(x: np.ndarray, cosine: float) -> tuple[np.ndarray, float]:
    """Pivots out of sampled unit vectors, and the cover they are apart by."""
    for cover in COVERS:
        pivots = apart(x, cover)
        visits = sum(int((x[i : i + 512] @ pivots.T >= reach(cover, cosine)).sum()) for i in range(0, len(x), 512))
        if visits <= VISITS * len(x):
            break
    return pivots, cover


def describe(x: np.ndarray, pivots: np.ndarray, k: int, cover: float, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of the k pivots with the largest cosine, nearest first; the owner (or -1); the
    pivots that are visited, and how many of them."""
    near, owner = np.empty((len(x), k), np.int32), np.empty(len(x), np.int32)
    visits, many = [np.empty(0, np.int32)], np.empty(len(x), np.int64)
    for i in range(0, len(x), 1024):
        c = (x[i : i + 1024] / np.linalg.norm(x[i : i + 1024], axis=1, keepdims=True)) @ pivots.T
        top = np.argpartition(-c, k - 1, axis=1)[:, :k]
        order = np.argsort(-np.take_along_axis(c, top, 1), axis=1, kind="stable")
        near[i : i + 1024] = top = np.take_along_axis(top, order, 1)
        owner[i : i + 1024] = np.where(np.take_along_axis(c, top[:, :1], 1)[:, 0] >= cover, top[:, 0], -1)
        row, pivot = np.nonzero(c >= reach(cover, cosine))
        visits.append(pivot.astype(np.int32))
        many[i : i + 1024] = np.bincount(row, minlength=len(c))
    return near, owner, np.concatenate(visits), many


def _one_hot(rows: np.ndarray, known: np.ndarray) -> np.ndarray:
    """0/1 matrix over the pivots in ``known`` (sorted); other entries are left out."""
    at = np.searchsorted(known, rows)
    at[at == len(known)] = 0
    hit = known[at] == rows
    out = np.zeros((len(rows), len(known)), np.float32)
    out[np.repeat(np.arange(len(rows)), rows.shape[1])[hit.ravel()], at[hit]] = 1
    return out


def _sharing(near: np.ndarray, kept: np.ndarray, left: np.ndarray, right: np.ndarray, rank: int, shared: int) -> np.ndarray:
    """The pairs of two blocks of a pivot's list (row numbers) that share enough pivots, and
    no earlier list."""
    counts = _one_hot(near[left], k := np.unique(near[left])) @ _one_hot(near[right], k).T
    pair = counts >= shared
    earlier = np.unique(kept[left])
    earlier = earlier[earlier < rank]
    if len(earlier):
        pair &= (_one_hot(kept[left], earlier) @ _one_hot(kept[right], earlier).T) == 0
    return pair


def _block_pair(ids: np.ndarray, mult: np.ndarray, x: np.ndarray, left: np.ndarray, right: np.ndarray, pair: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For two blocks (row numbers) and their pairs: (row, links, smallest id reached)."""
    if left is right:
        pair &= np.triu(np.ones(pair.shape, bool), 1)
    a, b = x[left], x[right]
    link = pair & ((a @ b.T) >= cosine * np.linalg.norm(a, axis=1)[:, None] * np.linalg.norm(b, axis=1)[None, :])
    if not link.any():
        none = np.empty(0, np.int64)
        return none, none, none
    deg_l, deg_r = link @ mult[right], mult[left] @ link
    low_l, low_r = ids[left].copy(), ids[right].copy()
    big = np.iinfo(np.int64).max
    while True:
        if left is right:
            both = link | link.T
            new = np.minimum(low_l, np.where(both, low_l[None, :], big).min(axis=1))
            if (new == low_l).all():
                break
            low_l = low_r = new
        else:
            new_l = np.minimum(low_l, np.where(link, low_r[None, :], big).min(axis=1))
            new_r = np.minimum(low_r, np.where(link, new_l[:, None], big).min(axis=0))
            if (new_l == low_l).all() and (new_r == low_r).all():
                break
            low_l, low_r = new_l, new_r
    if left is right:
        deg, low, rows = deg_l + deg_r, low_l, left
    else:
        deg, low, rows = np.concatenate([deg_l, deg_r]), np.concatenate([low_l, low_r]), np.concatenate([left, right])
    some = deg > 0
    return rows[some], deg[some], low[some]


def linked(vectors: DataFrame, dim: int, n: int, cosine: float = COSINE, nearest: int = NEAREST, shared: int = SHARED) -> DataFrame:
    """(id, links, low): for classes ``vectors(id, mult, dim, x)`` of one dimension, counts of
    links with vectors of other classes and the smallest id reached, from each place where
    the class was compared."""
    spark = vectors.sparkSession
    pivots = sample(vectors, dim, min(MOST_PIVOTS, max(LEAST_PIVOTS, n // PER_PIVOT)))
    pivots, cover = chosen_pivots(pivots / np.linalg.norm(pivots, axis=1, keepdims=True), cosine)
    sent = spark.sparkContext.broadcast(pivots)
    k = min(nearest, len(pivots))
    need = min(shared, k)
    first = len(pivots)  # visitors' lists come after those of pivots

    def located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                near, owner, visits, many = describe(stack(b.column("x"), dim), sent.value, k, cover, cosine)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(near) + 1) * k, pa.int32()), pa.array(near.ravel()))
                visited = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(many)]), pa.int32()), pa.array(visits))
                yield pa.RecordBatch.from_arrays([b.column("id"), b.column("mult"), b.column("x"), lists, pa.array(owner), visited], names=["id", "mult", "x", "near", "owner", "visits"])

    own = vectors.filter(F.col("dim") == dim).select("id", "mult", "x")
    described = save(own.mapInArrow(located, "id bigint, mult bigint, x binary, near array<int>, owner int, visits array<int>"), "described")
    # Lists 0 ... P - 1 are those of pivots, lists P ... 2 P - 1 of visitors: at most
    # 2 * MOST_PIVOTS rows.
    own_lists = F.when(F.col("owner") < 0, F.col("near")).otherwise(F.array().cast("array<int>"))
    lists = F.concat(own_lists, F.transform("visits", lambda v: v + F.lit(first)))
    length = np.zeros(2 * first, np.int64)
    for r in described.select(F.explode(lists).alias("p")).groupBy("p").agg(F.count(F.lit(1)).alias("n")).collect():
        length[r["p"]] = r["n"]
    # A list's number is its rank by length, visitors' lists after those of pivots.
    rank = np.empty(len(length), np.int32)
    for part in (slice(0, first), slice(first, None)):
        rank[part][np.argsort(length[part], kind="stable")] = np.arange(first) + part.start
    blocks = np.empty(len(length), np.int64)
    blocks[rank] = np.maximum(np.minimum(-(-length // BLOCK), BLOCKS), -(-length // MOST_BLOCK))
    order = spark.sparkContext.broadcast((rank, blocks))
    slots = max(1, int(-(-(length * blocks[rank]).sum() // SLOT_ROWS)))

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, blocks = order.value
        for b in batches:
            if not b.num_rows:
                continue
            near = np.sort(rank[b.column("near").flatten().to_numpy().reshape(-1, k)], axis=1)
            owner = b.column("owner").to_numpy()
            owner = np.where(owner < 0, np.int32(2 * first), rank[first + owner])
            free = np.flatnonzero(owner == 2 * first)
            lists = near[free, : k - need + 1]
            many = pc.list_value_length(b.column("visits")).to_numpy(zero_copy_only=False)
            row = np.concatenate([np.repeat(free, lists.shape[1]), np.repeat(np.arange(len(near)), many)])
            pivot = np.concatenate([lists.ravel(), rank[first + b.column("visits").flatten().to_numpy()]]).astype(np.int64)
            if not len(row):
                continue
            nb = blocks[pivot]
            ids = b.column("id").to_numpy()[row]
            mine = ((ids * 0x9E3779B1) >> 7) % nb
            other = np.concatenate([np.arange(m) for m in nb])
            row, pivot, mine = np.repeat(row, nb), np.repeat(pivot, nb), np.repeat(mine, nb)
            i, j = np.minimum(mine, other), np.maximum(mine, other)
            slot = (pivot * 1_000_003 + i * 7919 + j) % slots
            at = pa.array(row)
            full = pa.ListArray.from_arrays(pa.array(np.arange(len(near) + 1) * k, pa.int32()), pa.array(near.ravel()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(slot), pa.array(pivot), pa.array(i), pa.array(j), pa.array(mine), b.column("id").take(at), b.column("mult").take(at), b.column("x").take(at), full.take(at), pa.array(owner[row])],
                names=["slot", "pivot", "i", "j", "block", "id", "mult", "x", "near", "owner"],
            )

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["pivot", "i", "j", "id"], kind="stable")
        key = rows[["pivot", "i", "j"]].to_numpy()
        cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist(), len(rows)]
        ids, mult, block, owner = (rows[c].to_numpy() for c in ("id", "mult", "block", "owner"))
        x, near = stack(rows["x"].tolist(), dim), np.array(rows["near"].tolist(), np.int32)
        found = []
        for s, e in zip(cuts, cuts[1:], strict=False):
            pivot, i, j = key[s].tolist()
            left = s + np.flatnonzero(block[s:e] == i)
            right = left if i == j else s + np.flatnonzero(block[s:e] == j)
            # Parts of BLOCK, so that memory does not follow the size of a block.
            lefts = [left[a : a + BLOCK] for a in range(0, len(left), BLOCK)]
            rights = lefts if i == j else [right[a : a + BLOCK] for a in range(0, len(right), BLOCK)]
            for a, b in ((a, b) for p, a in enumerate(lefts) for b in rights[p if i == j else 0 :]):
                if pivot < first:
                    pair = _sharing(near, near[:, : k - need + 1], a, b, pivot, need)
                else:
                    pair = np.minimum(owner[a][:, None], owner[b][None, :]) == pivot
                found.append(_block_pair(ids, mult, x, a, b, pair, cosine))
        at, deg, low = (np.concatenate(v) for v in zip(*found, strict=True)) if found else (np.empty(0, np.int64),) * 3
        return pd.DataFrame({"id": ids[at.astype(np.int64)], "links": deg.astype(np.int64), "low": low}).groupby(["id", "low"], as_index=False)["links"].sum()[["id", "links", "low"]]

    posted = described.mapInArrow(post, "slot bigint, pivot bigint, i bigint, j bigint, block bigint, id bigint, mult bigint, x binary, near array<int>, owner int")
    return posted.groupBy("slot").applyInPandas(compare, "id bigint, links bigint, low bigint")


def near_duplicates(embeddings: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept of each row."""
    rows = save(classes(embeddings), "vectors")
    held = rows.filter("key is not null").groupBy("key", "dim").agg(F.min("vec_id").alias("rep"), F.count_distinct("vec_id").alias("mult"), F.first("x").alias("x"))
    vectors = save(held.withColumn("id", F.xxhash64("key")), "classes")
    parts = [linked(vectors, r["dim"], r["n"], cosine) for r in vectors.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).orderBy("dim").collect()]
    found = rows.sparkSession.createDataFrame([], "id bigint, links bigint, low bigint")
    for part in parts:
        found = found.union(part)
    found = save(found, "links")
    joined = connected_components(found.select(F.col("id").alias("a"), F.col("low").alias("b")))
    # A component's smallest vec_id; a component of many classes is joined where they are.
    least = joined.join(vectors.select("id", "rep"), "id").groupBy("component").agg(F.min("rep").alias("component_id"))
    joined = spread_join(joined, least, "component", joined.count()).select("id", "component_id")
    known = vectors.join(found.groupBy("id").agg(F.sum("links").alias("links")), "id", "left").join(joined, "id", "left")
    known = save(known.select("key", (F.col("mult") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component_id", "rep").alias("component_id")), "known")
    drop(vectors, found)
    out = rows.select("vec_id", "key").join(known, "key", "left")
    out = out.select("vec_id", F.greatest(F.coalesce("n_links", F.lit(0)), F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op1_pivot_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
