"""Near-duplicate documents by circulant MinHash (operator 8).

Every document is its set of distinct five-word shingles (64-bit identities).  One
permutation sends a shingle to a place on a circle of ``CIRCLE`` places; signature
coordinate k is the smallest value, over the document's places, of a second permutation
shifted circularly by k.  A shingle's values for all k are thus one contiguous slice of the
second permutation, and a signature is the column-wise minimum of such slices.

1.  *Sets.*  Documents with the same set form one class, whatever their number; the class
    is known by a hash of its digests and represented by a text of its smallest doc_id.
2.  *Bands.*  Coordinates are grouped in bands; classes that agree on a band share a bucket.
    For a similarity of 0.85 there are 21 bands of 6: a pair just that similar shares a
    bucket with probability 1 - 5e-5.
3.  *Stars.*  In each bucket every class is compared with the bucket's smallest; all
    comparisons are exact, on the full sets.  Links found join classes into components.
4.  *Crossings.*  Only classes of one bucket that stars left in different components are
    compared further, in blocks, and only if their signatures agree well enough that a
    link is possible (a true link fails this with probability below 1e-8).  So a group of
    copies costs a star, not its square, and no link between different texts is given up.

Sets are never gathered by key: comparisons are dealt into slots of bounded size, to which
the texts concerned are sent.  Null, empty and wordless texts have no shingle and link with
nothing; a text of fewer than five words is one shingle.  Rows of one doc_id are documents of
their own with the same id: each has the component of its own text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textkernel as tk
from .common import bounded_batches, drop, hot_keys, maybe_in, save, spread_join, steps, table, trim
from .components import connected_components

SHINGLE = 5
CIRCLE = 1 << 20
COORDINATES = 126
#: Links have 100 * intersection >= PERCENT * union.
PERCENT = 85


def banding(percent: int) -> tuple[int, int]:
    """(coordinates of a band, bands): a pair just at the threshold shares no bucket with
    a probability of 1e-4 at most, from 75 percent on."""
    for rows in (8, 7, 6, 5, 4):
        bands = COORDINATES // rows
        if (1 - (percent / 100) ** rows) ** bands <= 1e-4:
            return rows, bands
    return 3, COORDINATES // 3


def least_equal(percent: int) -> int:
    """Equal coordinates of a pair that may link: 5.8 deviations below the expectation."""
    p = percent / 100
    return math.floor(COORDINATES * p - 5.8 * math.sqrt(COORDINATES * p * (1 - p)))


#: Classes in a block of a crossing, blocks of a bucket before they grow, and classes in a
#: block then; shingles in a part of a neighbourhood, and in a slot.
BLOCK, BLOCKS, MOST_BLOCK, PART, SLOT = 256, 64, 16_384, 60_000, 3_000_000

_RNG = np.random.Generator(np.random.PCG64(8))
_PERM = _RNG.permutation(CIRCLE).astype(np.uint32)
_VALUES = np.lib.stride_tricks.sliding_window_view(np.concatenate([_PERM, _PERM[:COORDINATES]]), COORDINATES)


def document_sets(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, ascending, and text offsets."""
    ids, at = tk.words(col)
    return tk.distinct(*tk.shingles(ids, at, SHINGLE))


def digest(sets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """64 bits of each text's set, whatever its order."""
    with np.errstate(over="ignore"):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(tk.mix(sets))])
        return (sums[at[1:]] - sums[at[:-1]]).view(np.int64)


def signatures(sets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One row of COORDINATES values a text; zeros for texts without a shingle."""
    out = np.zeros((len(at) - 1, COORDINATES), np.uint32)
    places = (sets >> np.uint64(44)).astype(np.int64)
    for a, b in tk.text_blocks(at, 1 << 13):
        some = a + np.flatnonzero(at[a:b] < at[a + 1 : b + 1])
        for lo in range(int(at[a]), int(at[b]), 1 << 16):  # a long text, in parts
            hi = min(lo + (1 << 16), int(at[b]))
            if b - a > 1:
                out[some] = np.minimum.reduceat(_VALUES[places[lo:hi]], at[some] - lo, axis=0)
            else:
                part = _VALUES[places[lo:hi]].min(axis=0)
                out[a] = part if lo == at[a] else np.minimum(out[a], part)
    return out


def band_keys(sigs: np.ndarray, rows: int, bands: int) -> np.ndarray:
    """A 64-bit key for each band of each signature; bands never share keys by design."""
    keys = np.empty((len(sigs), bands), np.uint64)
    for b in range(bands):
        x = np.full(len(sigs), b + 1, np.uint64)
        for k in range(b * rows, (b + 1) * rows):
            x = tk.mix(x * np.uint64(0x9E3779B97F4A7C15) + sigs[:, k])
        keys[:, b] = x
    return keys


def describe(docs: DataFrame, rows: int, bands: int) -> DataFrame:
    """doc_id, n_shingles, two 64-bit digests of the set, band keys and signature bytes."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches, "text", 2 << 20):
            sets, at = document_sets(step.column("text"))
            n = np.diff(at)
            sigs = signatures(sets, at)
            keys = band_keys(sigs, rows, bands)
            m = len(n)
            d1, d2 = digest(sets, at), digest(sets ^ np.uint64(0xD6E8FEB86659FD93), at)
            low = np.ascontiguousarray(sigs.astype(np.uint8))
            yield pa.RecordBatch.from_arrays(
                [
                    step.column("doc_id"),
                    pa.array(n, pa.int64()),
                    pa.array(d1),
                    pa.array(d2),
                    pa.ListArray.from_arrays(pa.array(np.arange(m + 1) * bands, pa.int32()), pa.array(keys.view(np.int64).ravel())),
                    pa.array([r.tobytes() for r in low], pa.binary()),
                ],
                names=["doc_id", "n_shingles", "d1", "d2", "bands", "sig"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, n_shingles bigint, d1 bigint, d2 bigint, bands array<bigint>, sig binary")


def _compare(texts: pd.DataFrame, pairs: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links among the pairs of one slot, less those that other links of it imply."""
    empty = pd.DataFrame({"a": np.empty(0, np.int64), "b": np.empty(0, np.int64)})
    if not len(texts) or not len(pairs):
        return empty
    ids = texts["id"].to_numpy()
    sets, at = document_sets(pa.array(texts["text"].tolist(), pa.large_string()))
    # Rows of a doc_id may have other texts; one row with its set stands for a class.
    own = np.flatnonzero(digest(sets, at) == texts["d1"].to_numpy())
    own = own[np.unique(ids[own], return_index=True)[1]]
    a, b = (np.concatenate(pairs[c].tolist()) for c in ("a", "b"))
    a, b = (own[np.searchsorted(ids[own], x)] for x in (a, b))
    size = np.diff(at)
    # The smaller is at least that part of the larger, or they cannot link.
    can = 100 * np.minimum(size[a], size[b]) >= percent * np.maximum(size[a], size[b])
    a, b = a[can], b[can]
    if not len(a):
        return empty
    root = np.arange(len(ids))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    by = np.argsort(a, kind="stable")
    a, b = a[by], b[by]
    heads = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
    for i, j in zip(heads, [*heads[1:], len(a)], strict=True):
        own = sets[at[a[i]] : at[a[i] + 1]]
        for k in range(i, j, 512):
            others = b[k : min(k + 512, j)]
            n = size[others]
            to = np.cumsum(n) - n
            flat = sets[np.repeat(at[others] - to, n) + np.arange(int(n.sum()))]
            where = np.searchsorted(own, flat)
            where[where == len(own)] = 0
            both = np.add.reduceat((own[where] == flat).astype(np.int64), to)
            for other in others[100 * both >= percent * (len(own) + n - both)].tolist():
                x, y = find(int(a[i])), find(int(other))
                if x != y:
                    root[max(x, y)] = min(x, y)
    for x in range(len(ids)):
        root[x] = find(x)
    joined = np.flatnonzero(root != np.arange(len(ids)))
    trim()
    return pd.DataFrame({"a": ids[root[joined]], "b": ids[joined]})


def verify(docs: DataFrame, classes: DataFrame, pairs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Edges (a, b) that span the links among ``pairs(slot, a, b, ids)``: a slot's arrays of
    left and right classes, and the distinct ones among them.  ``classes(id, rep, d1)``."""
    sent = pairs.select(F.explode("ids").alias("id"), F.col("slot").alias("to")).distinct()
    wanted = sent.join(classes.select("id", "rep", "d1"), "id")
    rows = docs.select(F.col("doc_id").alias("rep"), "text")
    texts = maybe_in(rows, "rep", wanted.select(F.col("rep").alias("id"))).join(wanted, "rep").select("to", "id", "d1", "text")
    return texts.groupBy("to").cogroup(pairs.select("slot", "a", "b").groupBy("slot")).applyInPandas(lambda t, p: _compare(t, p, percent), "a bigint, b bigint")


def _parts(near: DataFrame) -> DataFrame:
    """id, n_shingles, part: classes of one neighbourhood are of one part, those of a large
    one of several, of about ``PART`` shingles each."""
    size = near.groupBy("hub").agg(F.sum("n_shingles").alias("size"))
    part = F.xxhash64("hub", F.pmod(F.xxhash64("id"), F.ceil(F.col("size") / F.lit(PART))))
    return near.join(size, "hub").select("id", "n_shingles", part.alias("part"))


def _slots(parts: DataFrame) -> int:
    return max(1, -(-int(parts.agg(F.sum("n_shingles")).first()[0] or 0) * 2 // SLOT))


def _dealt(stars: DataFrame, parts: DataFrame) -> DataFrame:
    """Stars as comparisons of slots; a pair's slot is that of its parts."""
    left = parts.select(F.col("id").alias("a"), F.col("part").alias("x"))
    right = parts.select(F.col("id").alias("b"), F.col("part").alias("y"))
    slot = F.pmod(F.xxhash64(F.least("x", "y"), F.greatest("x", "y")), F.lit(_slots(parts)))
    return stars.join(left, "a").join(right, "b").select(slot.alias("slot"), F.array("a").alias("a"), F.array("b").alias("b"), F.array("a", "b").alias("ids"))


def _crossing_pairs(rows: pd.DataFrame, slots: int, percent: int) -> pd.DataFrame:
    """Pairs of two blocks of one bucket that lie in different components, may link by
    their signatures, and share no earlier band, as arrays for each slot.  One call has
    many buckets."""
    rows = rows.sort_values(["band", "key", "i", "j"], kind="stable")
    key = rows[["band", "key", "i", "j"]].to_numpy()
    cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist(), len(rows)]
    ids, comp, size = rows["id"].to_numpy(), rows["component"].to_numpy(), rows["n_shingles"].to_numpy()
    part, least = rows["part"].to_numpy(), least_equal(percent)
    block, lead = rows["block"].to_numpy(), (rows["id"] == rows["lead"]).to_numpy()
    sig = np.frombuffer(b"".join(rows["sig"]), np.uint8).reshape(len(rows), COORDINATES)
    keys = np.array(rows["bands"].tolist(), dtype=np.int64)
    out_a, out_b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for s, e in zip(cuts, cuts[1:], strict=False):
        band, _, i, j = key[s].tolist() if e > s else (0, 0, 0, 0)
        left, right = s + np.flatnonzero(block[s:e] == i), s + np.flatnonzero(block[s:e] == j)
        for x in left[~lead[left]].tolist():
            y = right[(comp[right] != comp[x]) & ~lead[right]]  # the lead has been compared
            if i == j:
                y = y[y > x]
            y = y[percent * np.maximum(size[y], size[x]) <= 100 * np.minimum(size[y], size[x])]
            y = y[(sig[y] == sig[x]).sum(axis=1) >= least]
            y = y[~(keys[y, :band] == keys[x, :band]).any(axis=1)] if band else y
            out_a.append(np.full(len(y), x))
            out_b.append(y)
    a, b = np.concatenate(out_a), np.concatenate(out_b)
    x, y = np.minimum(part[a], part[b]), np.maximum(part[a], part[b])
    slot = (tk.mix(x.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + y.view(np.uint64)) % np.uint64(slots)).astype(np.int64)
    order = np.argsort(slot, kind="stable")
    a, b, slot = ids[a[order]], ids[b[order]], slot[order]
    ends = np.flatnonzero(np.concatenate([slot[1:] != slot[:-1], [True]])) + 1 if len(slot) else slot
    heads = np.concatenate([[0], ends[:-1]]) if len(slot) else slot
    cuts = list(zip(heads, ends, strict=True))
    lists = {"a": [a[s:e] for s, e in cuts], "b": [b[s:e] for s, e in cuts], "ids": [np.unique(np.concatenate([a[s:e], b[s:e]])) for s, e in cuts]}
    return pd.DataFrame({"slot": slot[heads]} | {k: pd.Series(v, dtype=object) for k, v in lists.items()})


def components(docs: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(described, classes): one row per document with its set's digests, and for each class
    ``d1, d2, component_id`` where the component holds more than one document."""
    described = save(describe(docs, *banding(percent)), "sets")
    reps = described.filter("n_shingles > 0 and doc_id is not null").groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"))
    # n_shingles, bands and signature are functions of the set.
    full = described.filter("n_shingles > 0").select(F.col("doc_id").alias("rep"), "d1", "d2", "n_shingles", "bands", "sig")
    whole = full.join(reps, ["d1", "d2", "rep"], "left_semi").withColumn("id", F.xxhash64("d1", "d2"))
    whole = save(whole.dropDuplicates(["id"]), "classes")
    rows = whole.select("id", F.posexplode("bands").alias("band", "key"))
    buckets = save(rows.groupBy("band", "key").agg(F.min("id").alias("lead"), F.count(F.lit(1)).alias("n")).filter("n > 1"), "buckets")
    # Hot buckets, of which a band has HOT_PART at most, go to their rows; the others meet theirs.
    total = whole.count()
    hot = F.broadcast(hot_keys(buckets, total))
    cold = rows.join(hot.select("band", "key"), ["band", "key"], "left_anti").join(buckets, ["band", "key"])
    members = save(rows.join(hot, ["band", "key"]).unionByName(cold).select("band", "key", "lead", "n", "id"), "members")

    stars = members.filter("id != lead").select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct()
    near = save(members.groupBy("id").agg(F.min("lead").alias("hub")).join(whole.select("id", "n_shingles"), "id"), "near")
    parts = save(_parts(near), "parts")
    first = save(verify(docs, whole, save(_dealt(stars, parts), "stars"), percent), "links")
    found = connected_components(first)

    placed = members.filter("n > 2").join(found, "id", "left").select("band", "key", "lead", "n", "id", F.coalesce("component", "id").alias("component"))
    mixed = placed.groupBy("band", "key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.max("n").alias("n")).filter("lo < hi").select("band", "key", "n")
    mixed = save(mixed, "mixed")
    crowded = F.broadcast(hot_keys(mixed, total).select("band", "key"))
    rest = placed.join(crowded, ["band", "key"], "left_anti").join(mixed.select("band", "key"), ["band", "key"])
    placed = placed.join(crowded, ["band", "key"]).unionByName(rest)
    blocks = F.greatest(F.least(F.ceil(F.col("n") / F.lit(BLOCK)), F.lit(BLOCKS)), F.ceil(F.col("n") / F.lit(MOST_BLOCK)))
    open_ = placed.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
    meets = open_.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    meets = meets.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")}).drop("other", "blocks", "n")
    meets = save(meets, "meets")
    groups = max(1, -(-meets.count() // 8192))
    meets = meets.join(whole.select("id", "n_shingles", "bands", "sig"), "id").join(parts.select("id", "part"), "id").withColumn("group", F.pmod(F.xxhash64("band", "key", "i", "j"), F.lit(groups)))
    slots = _slots(parts)
    crossing = meets.groupBy("group").applyInPandas(lambda rows: _crossing_pairs(rows, slots, percent), "slot bigint, a array<bigint>, b array<bigint>, ids array<bigint>")
    second = verify(docs, whole, save(crossing, "crossings"), percent)
    links = save(first.union(second), "links")
    found = connected_components(links)
    # A component's smallest doc_id.
    least = found.join(whole.select("id", "rep"), "id").groupBy("component").agg(F.min("rep").alias("component_id"))
    joined = spread_join(found, least, "component", found.count()).join(whole.select("id", "d1", "d2"), "id")
    known = save(joined.select("d1", "d2", "component_id"), "known")
    drop(members, buckets, near, parts, first, mixed, meets, links, whole, clean=True)
    return described, known


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of each row."""
    described, classes = components(docs, percent)
    rows = described.select("doc_id", "n_shingles", "d1", "d2")
    some, key = rows.filter("n_shingles > 0"), ["d1", "d2"]
    reps = some.groupBy(*key).agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n"))
    known = save(reps.join(classes, key, "left").select(*key, "n", F.coalesce("component_id", "rep").alias("component_id")), "known")
    # Sets that many documents share go to them; the others meet theirs.
    shared = F.broadcast(hot_keys(known, rows.count()).drop("n"))
    cold = some.join(shared.select(*key), key, "left_anti").join(known.drop("n"), key)
    alone = rows.filter("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    out = some.join(shared, key).unionByName(cold).unionByName(alone).select("doc_id", "n_shingles", "component_id")
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
