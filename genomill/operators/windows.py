"""Windowed scans: runs of homozygosity, selection, local ancestry, linkage."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..model import SITE, wide
from ..shipping import ship
from . import dense
from .population import hudson_terms, tajima_d, with_differences

#: Source frequencies stay this far from 0 and 1.
EDGE = 1e-6


def runs_of_homozygosity(called: DataFrame, sites: DataFrame, window_bp: int = 100_000, most_het: float = 0.02, min_bp: int = 200_000) -> DataFrame:
    """Runs per sample: windows from each contig's first position; a window without a call is
    not homozygous; a run ends at the next window's start, the last one at the contig's last
    position.  Gaps and islands over the grid of windows."""
    span = sites.groupBy("chrom").agg(F.min("pos").alias("first"), F.max("pos").alias("last"))
    own = called.filter("n_alt is not null").join(F.broadcast(span), "chrom").withColumn("w", F.floor((F.col("pos") - F.col("first")) / window_bp))
    seen = own.groupBy("sample_id", "chrom", "w").agg(F.avg((F.col("n_alt") == 1).cast("double")).alias("het")).filter(F.col("het") <= most_het)
    # Only homozygous windows are needed: a run is a stretch of them without a gap.
    w = Window.partitionBy("sample_id", "chrom").orderBy("w")
    island = seen.withColumn("g", F.col("w") - F.row_number().over(w))
    runs = island.groupBy("sample_id", "chrom", "g").agg(F.min("w").alias("a"), F.max("w").alias("b")).join(F.broadcast(span), "chrom")
    last = F.floor((F.col("last") - F.col("first")) / window_bp)
    start = F.col("first") + F.col("a") * window_bp
    stop = F.when(F.col("b") >= last, F.col("last")).otherwise(F.col("first") + (F.col("b") + 1) * window_bp)
    return runs.select("sample_id", "chrom", start.alias("start"), stop.alias("end")).filter(F.col("end") - F.col("start") >= min_bp)


def roh_summary(called: DataFrame, sites: DataFrame, **how) -> DataFrame:
    """Total length, number and share of the covered genome of each sample's runs."""
    runs = runs_of_homozygosity(called, sites, **how).groupBy("sample_id").agg(F.sum(F.col("end") - F.col("start")).alias("roh_bp"), F.count(F.lit(1)).alias("segments"))
    genome = sites.groupBy("chrom").agg((F.max("pos") - F.min("pos")).alias("bp")).agg(F.sum("bp").alias("genome"))
    out = called.select("sample_id").distinct().join(runs, "sample_id", "left").fillna(0, ["roh_bp", "segments"]).join(F.broadcast(genome))
    return out.select("sample_id", "roh_bp", "segments", F.when(F.col("genome") > 0, F.col("roh_bp") / F.col("genome")).otherwise(0.0).alias("f_roh"))


def pbs_windows(count: DataFrame, populations: list, window_bp: int = 100_000) -> DataFrame:
    """Population branch statistic and Tajima's D of the first of three populations, in windows
    from each contig's first position.  A pair's F_ST sums the sites that both have; it is
    held to [0, 0.9999]; D needs three segregating sites and takes the contig's largest n."""
    first = count.groupBy("chrom").agg(F.min("pos").alias("first"))
    placed = lambda f: f.join(F.broadcast(first), "chrom").withColumn("w", F.floor((F.col("pos") - F.col("first")) / window_bp))
    own = count.filter(F.col("population").isin(populations))
    a, b, c = populations
    pair = lambda p, q: (F.col("pop1") == min(p, q)) & (F.col("pop2") == max(p, q))
    aggs = [F.sum(F.when(pair(p, q), F.col(v))).alias(f"{v}{i}") for i, (p, q) in enumerate(((a, b), (a, c), (b, c))) for v in ("num", "den")]
    fst = placed(hudson_terms(own)).groupBy("chrom", "w", "first").agg(*aggs)
    t = [-F.log(1 - F.least(F.greatest(F.when(F.col(f"den{i}") > 0, F.col(f"num{i}") / F.col(f"den{i}")), F.lit(0.0)), F.lit(0.9999))) for i in range(3)]
    # greatest and least skip nulls: a pair without a denominator makes the whole null.
    known = F.col("den0").isNotNull() & (F.col("den0") > 0) & F.col("den1").isNotNull() & (F.col("den1") > 0) & F.col("den2").isNotNull() & (F.col("den2") > 0)
    focal = with_differences(own.filter(F.col("population") == a))
    n = focal.groupBy("chrom").agg(F.max(F.col("ref_n") + F.col("alt_n")).alias("n"))
    seg = ((F.col("ref_n") > 0) & (F.col("alt_n") > 0)).cast("bigint")
    d = placed(focal).groupBy("chrom", "w").agg(F.count(F.lit(1)).alias("n_sites"), F.sum(seg).alias("s"), F.sum("within").alias("diff")).join(F.broadcast(n), "chrom")
    out = fst.join(d.select("chrom", "w", "n_sites", tajima_d(F.col("n"), F.col("s"), F.col("diff")).alias("tajima_d")), ["chrom", "w"], "left")
    start = F.col("first") + F.col("w") * window_bp
    return out.select("chrom", start.alias("start"), "n_sites", F.when(known, (t[0] + t[1] - t[2]) / 2).alias("pbs"), "tajima_d")


def difference_windows(count: DataFrame, a, b, window_bp: int = 100_000) -> DataFrame:  # noqa: ANN001
    """Mean absolute frequency difference of two populations in windows."""
    rows = wide(count, [a, b])
    first = rows.groupBy("chrom").agg(F.min("pos").alias("first"))
    start = F.col("first") + F.floor((F.col("pos") - F.col("first")) / window_bp) * window_bp
    each = rows.join(F.broadcast(first), "chrom").withColumn("start", start)
    return each.groupBy("chrom", "start").agg(F.count(F.lit(1)).alias("n_sites"), F.avg(F.abs(F.col("p0") - F.col("p1"))).alias("difference"))


def emissions(called: DataFrame, freqs: DataFrame, sources: list, targets: list, window_bp: int = 200_000, min_sites: int = 5) -> DataFrame:
    """Log-likelihood of each target's calls under each source, per window of at least
    ``min_sites`` sites; a source without a frequency counts as 0.5."""
    span = called.groupBy("chrom").agg(F.min("pos").alias("first"))
    src = freqs.filter(F.col("population").isin(sources)).groupBy(*SITE).pivot("population", sources).agg(F.first("p"))
    own = called.filter(F.col("population").isin(targets) & F.col("n_alt").isNotNull()).join(src, SITE, "left").join(F.broadcast(span), "chrom")
    aggs = []
    for i, s in enumerate(sources):
        p = F.least(F.greatest(F.coalesce(F.col(str(s)), F.lit(0.5)), F.lit(EDGE)), F.lit(1 - EDGE))
        ll = F.when(F.col("n_alt") == 0, 2 * F.log(1 - p)).when(F.col("n_alt") == 2, 2 * F.log(p)).otherwise(F.log(2 * p * (1 - p)))
        aggs.append(F.sum(ll).alias(f"l{i}"))
    out = own.withColumn("w", F.floor((F.col("pos") - F.col("first")) / window_bp)).groupBy("sample_id", "chrom", "w").agg(F.first("first").alias("first"), F.count(F.lit(1)).alias("n_sites"), *aggs)
    return out.filter(F.col("n_sites") >= min_sites).withColumn("start", F.col("first") + F.col("w") * window_bp)


def viterbi(logs: np.ndarray, switch: float = 0.02) -> np.ndarray:
    """The most likely path of sources through windows; ties go to the first source."""
    n, k = logs.shape
    if k == 1 or n == 0:
        return np.zeros(n, int)
    stay, move = math.log(1 - switch), math.log(switch / (k - 1))
    step = np.full((k, k), move)
    np.fill_diagonal(step, stay)
    score, back = logs[0] - math.log(k), np.zeros((n, k), int)
    for i in range(1, n):
        both = score[:, None] + step
        back[i] = both.argmax(axis=0)
        score = both.max(axis=0) + logs[i]
    path = np.empty(n, int)
    path[-1] = score.argmax()
    for i in range(n - 1, 0, -1):
        path[i - 1] = back[i, path[i]]
    return path


def local_ancestry(windows: DataFrame, sources: list, switch: float = 0.02, types: dict[str, str] | None = None) -> DataFrame:
    """The source of each window, by a path through each sample's contigs on their own.  A
    group is one sample's windows on one contig."""
    names = [str(s) for s in sources]

    def path(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("w")
        logs = rows[[f"l{i}" for i in range(len(names))]].to_numpy()
        return rows[["sample_id", "chrom", "start"]].assign(ancestry=[names[i] for i in viterbi(logs, switch)])

    t = types or {f.name: f.dataType.simpleString() for f in windows.schema}
    return windows.groupBy("sample_id", "chrom").applyInPandas(path, f"sample_id {t['sample_id']}, chrom {t['chrom']}, start bigint, ancestry string")


def ancestry_fractions(paths: DataFrame, sources: list) -> DataFrame:
    cols = [F.bround(F.avg((F.col("ancestry") == str(s)).cast("double")), 4).alias(f"frac_{s}") for s in sources]
    return paths.groupBy("sample_id").agg(F.count(F.lit(1)).alias("n_windows"), *cols)


def ld_pairs(called: DataFrame, window_bp: int = 500_000, min_samples: int = 4) -> DataFrame:
    """r2 of site pairs of a contig within ``window_bp``, over samples called at both.  A band
    join: sites meet in their own bin and the next."""
    own = called.filter("n_alt is not null").select("chrom", "pos", "sample_id", F.col("n_alt").cast("double").alias("g")).withColumn("bin", F.floor(F.col("pos") / window_bp))
    left = own.withColumn("bin", F.explode(F.array(F.col("bin"), F.col("bin") + 1))).select("chrom", "sample_id", "bin", F.col("pos").alias("pos1"), F.col("g").alias("x"))
    right = own.select("chrom", "sample_id", "bin", F.col("pos").alias("pos2"), F.col("g").alias("y"))
    pairs = left.join(right, ["chrom", "sample_id", "bin"]).filter((F.col("pos1") < F.col("pos2")) & (F.col("pos2") - F.col("pos1") <= window_bp))
    out = pairs.groupBy("chrom", "pos1", "pos2").agg(F.count(F.lit(1)).alias("n"), F.sum("x").alias("sx"), F.sum("y").alias("sy"), F.sum(F.col("x") * F.col("x")).alias("sxx"), F.sum(F.col("y") * F.col("y")).alias("syy"), F.sum(F.col("x") * F.col("y")).alias("sxy"))
    n = F.col("n")
    vx, vy, cov = n * F.col("sxx") - F.col("sx") ** 2, n * F.col("syy") - F.col("sy") ** 2, n * F.col("sxy") - F.col("sx") * F.col("sy")
    return out.filter(n >= min_samples).select("chrom", "pos1", "pos2", "n", F.when((vx > 0) & (vy > 0), cov * cov / (vx * vy)).alias("r2"))


def greedy_prune(pos: np.ndarray, calls: np.ndarray, window_bp: int, r2: float) -> np.ndarray:
    """Kept variants of one contig: each in order, unless its r2 with a kept one within the
    window is ``r2`` or more.  Missing calls take the variant's mean; one without variance
    is kept."""
    x = np.where(calls >= 0, calls, np.nan)
    with np.errstate(all="ignore"):
        mean = np.nanmean(np.where(np.isnan(x).all(axis=1, keepdims=True), 0, x), axis=1, keepdims=True)
    x = np.where(np.isnan(x), mean, x) - mean
    norm = np.sqrt((x * x).sum(axis=1))
    z = np.divide(x, norm[:, None], out=np.zeros_like(x), where=norm[:, None] > 0)
    kept: list[int] = []
    first = 0
    for i in range(len(pos)):
        while first < len(kept) and pos[i] - pos[kept[first]] > window_bp:
            first += 1
        near = kept[first:]
        if norm[i] == 0 or not near or ((z[near] @ z[i]) ** 2).max() < r2:
            kept.append(i)
    return np.array(kept, int)


def ld_prune(called: DataFrame, n_samples: int, window_bp: int = 500_000, r2: float = 0.8, ids: list | None = None) -> DataFrame:
    """Sites that greedy pruning keeps, contig by contig: what is kept depends on what was
    kept before, so a contig is one task; its sites are arrays of bytes, one row each.
    ``ids``: all sample ids, if they are known already."""
    if n_samples < 4:
        return called.select(*SITE).distinct()
    ids, kind = dense.sample_ids(called) if ids is None else ids, dict(called.dtypes)
    ship(called.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            g = dense.matrix_of(batch, ids)
            yield pa.RecordBatch.from_arrays([batch.column("chrom"), batch.column("pos"), pa.array([r.tobytes() for r in g], pa.binary())], names=["chrom", "pos", "g"])

    def prune(sites: pa.Table) -> pa.Table:
        sites = sites.sort_by("pos")
        calls = np.frombuffer(b"".join(sites.column("g").to_pylist()), np.int8).reshape(sites.num_rows, len(ids))
        return sites.select(SITE).take(pa.array(greedy_prune(sites.column("pos").to_numpy(), calls, window_bp, r2)))

    schema = f"chrom {kind['chrom']}, pos {kind['pos']}"
    return dense.vectors(called).mapInArrow(rows, f"{schema}, g binary").groupBy("chrom").applyInArrow(prune, schema)


def scatter(contigs: DataFrame, window: int = 10_000_000) -> DataFrame:
    """Half-open intervals that tile ``contigs(chrom, length)``."""
    starts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(window).cast("bigint")))
    return contigs.filter("length > 0").select("chrom", "length", starts.alias("start")).select("chrom", "start", F.least(F.col("start") + window, F.col("length")).alias("end"))
