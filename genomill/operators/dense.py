"""Sites as vectors over samples.

A site's calls are folded into one array; batches of sites then become small dense matrices
(sites x samples) in Arrow workers, where sums over sites for all pairs of samples are matrix
products.  So a site is one row, never one for each pair of its samples.  What the workers
emit is of samples x samples numbers a task and key; it is added up in chunks, in parallel.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model import SITE
from ..shipping import ship

#: Sites of a matrix at a time, and numbers of a chunk of sums.
SITES, CHUNK = 4096, 1 << 17


def sample_ids(called: DataFrame) -> list:
    return sorted(r["sample_id"] for r in called.select("sample_id").distinct().collect())


def vectors(called: DataFrame, sites: DataFrame | None = None) -> DataFrame:
    """chrom, pos, s (sample ids), g (ALT counts, -1 where missing) of each site."""
    own = called if sites is None else called.join(sites.select(*SITE), SITE, "left_semi")
    call = F.struct("sample_id", F.coalesce("n_alt", F.lit(-1)).cast("int").alias("n"))
    return own.groupBy(*SITE).agg(F.collect_list(call).alias("c")).select(*SITE, F.col("c.sample_id").alias("s"), F.col("c.n").alias("g"))


def matrix_of(batch: pa.RecordBatch, ids: list) -> np.ndarray:
    """Sites x samples, -1 where a call is missing."""
    s = batch.column("s")
    out = np.full((batch.num_rows, len(ids)), -1, np.int8)
    row = np.repeat(np.arange(batch.num_rows), pc.list_value_length(s).to_numpy(zero_copy_only=False))
    at = pc.index_in(s.flatten(), value_set=pa.array(ids, s.type.value_type)).to_numpy(zero_copy_only=False)
    out[row, at.astype(np.int64)] = batch.column("g").flatten().to_numpy()
    return out


def pair_sums(called: DataFrame, sites: DataFrame | None, ids: list, kernel: Callable[[np.ndarray, pa.RecordBatch], np.ndarray], by: str | None = None) -> dict[str, np.ndarray]:
    """The sums of ``kernel(matrix, sites)``, an array of fixed shape, over all sites; for each
    value of the column ``by`` (as text) if it is given."""
    ship(called.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for a in range(0, batch.num_rows, SITES):
                part = batch.slice(a, SITES)
                keys = part.column(by).cast(pa.string()).to_numpy(zero_copy_only=False) if by else np.full(part.num_rows, "", object)
                for k in np.unique(keys):
                    own = part.take(pa.array(np.flatnonzero(keys == k)))
                    got = kernel(matrix_of(own, ids), own)
                    sums[k] = sums[k] + got if k in sums else got
        for k, x in sums.items():
            flat = np.ascontiguousarray(x, np.float64).ravel()
            for c in range(0, len(flat), CHUNK):
                yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([c // CHUNK], pa.int32()), pa.array(["x".join(map(str, x.shape))]), pa.array([flat[c : c + CHUNK].tobytes()], pa.binary())], names=["k", "c", "shape", "x"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, np.ndarray] = {}
        for batch in batches:
            for k, c, shape, x in zip(*(batch.column(n).to_pylist() for n in ("k", "c", "shape", "x")), strict=True):
                x = np.frombuffer(x)
                sums[k, c, shape] = sums[k, c, shape] + x if (k, c, shape) in sums else x
        for (k, c, shape), x in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([c], pa.int32()), pa.array([shape]), pa.array([x.tobytes()], pa.binary())], names=["k", "c", "shape", "x"])

    schema = "k string, c int, shape string, x binary"
    parts: dict[str, list] = {}
    for r in vectors(called, sites).mapInArrow(run, schema).repartition("k", "c").mapInArrow(add, schema).collect():
        parts.setdefault(r["k"], []).append((r["c"], r["shape"], bytes(r["x"])))
    return {k: np.frombuffer(b"".join(x for _, _, x in sorted(v))).reshape([int(n) for n in v[0][1].split("x")]) for k, v in parts.items()}


def differences(g: np.ndarray, _: pa.RecordBatch) -> np.ndarray:
    """Allele differences of all pairs, missing calls as homozygous reference: for counts up to
    2, ``|a - b| = a + b - 2 ([a, b >= 1] + [a, b >= 2])``; and, at [1, 0, 0], the sites."""
    one, two, total = (g >= 1).astype(np.float32), (g >= 2).astype(np.float32), np.maximum(g, 0).sum(axis=0, dtype=np.float64)
    shared = (one.T @ one + two.T @ two).astype(np.float64)
    n = np.zeros_like(shared)
    n[0, 0] = len(g)
    return np.stack([total[:, None] + total[None, :] - 2 * shared, n])


def agreements(g: np.ndarray, _: pa.RecordBatch) -> np.ndarray:
    """Sites that both samples have called, and those where they agree."""
    known = (g >= 0).astype(np.float32)
    same = sum(x.T @ x for x in ((g == v).astype(np.float32) for v in range(3)))
    return np.stack([known.T @ known, same]).astype(np.float64)


def scaled_products(scaler: str, impute: bool) -> Callable[[np.ndarray, pa.RecordBatch], np.ndarray]:
    """Products of centred and scaled dosages; missing calls are homozygous reference, or the
    site's mean if ``impute``.  Sites without variance are left out; [1, 0, 0] counts the rest."""

    def kernel(g: np.ndarray, _: pa.RecordBatch) -> np.ndarray:
        x = np.maximum(g, 0).astype(np.float64)
        known = g >= 0 if impute else np.ones(g.shape, bool)
        n = np.maximum(known.sum(axis=1, keepdims=True), 1)
        mean = x.sum(axis=1, keepdims=True) / n
        p = mean / 2
        v = {"patterson": p * (1 - p), "standard": (x * x).sum(axis=1, keepdims=True) / n - mean**2, "none": np.ones_like(p)}[scaler]
        ok = v[:, 0] > 1e-12
        z = (np.where(known, x - mean, 0.0) / np.sqrt(np.where(v > 1e-12, v, 1.0)))[ok]
        count = np.zeros((g.shape[1], g.shape[1]))
        count[0, 0] = ok.sum()
        return np.stack([z.T @ z, count])

    return kernel


def resampled_differences(replicates: int, seed: int) -> Callable[[np.ndarray, pa.RecordBatch], np.ndarray]:
    """``differences`` of all sites, then of each replicate, in which a site counts Poisson(1)
    times; the weights come from a hash of seed, site and replicate, whatever the partitions."""
    from hashlib import blake2b

    cuts = np.cumsum([0.36787944117144233 / f for f in (1, 1, 2, 6, 24, 120, 720, 5040)])

    def kernel(g: np.ndarray, sites: pa.RecordBatch) -> np.ndarray:
        names = [f"{seed}:{c}:{p}".encode() for c, p in zip(sites.column("chrom").to_pylist(), sites.column("pos").to_pylist(), strict=True)]
        h = np.array([int.from_bytes(blake2b(x, digest_size=8).digest(), "little") for x in names], np.uint64)
        out = np.empty((replicates + 1, 2, g.shape[1], g.shape[1]))
        out[0] = differences(g, sites)
        one, two, x = (g >= 1).astype(np.float32), (g >= 2).astype(np.float32), np.maximum(g, 0).astype(np.float64)
        for r in range(replicates):
            u = h ^ (np.uint64(r + 1) * np.uint64(0x9E3779B97F4A7C15))
            for shift, times in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                u = (u ^ (u >> np.uint64(shift))) * np.uint64(times)
            w = np.searchsorted(cuts, (u >> np.uint64(11)) / float(1 << 53), side="right").astype(np.float32)
            total = w.astype(np.float64) @ x
            out[r + 1, 0] = total[:, None] + total[None, :] - 2 * ((one * w[:, None]).T @ one + (two * w[:, None]).T @ two)
            out[r + 1, 1] = 0
            out[r + 1, 1, 0, 0] = w.sum()
        return out

    return kernel
