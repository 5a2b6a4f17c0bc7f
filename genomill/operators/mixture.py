"""Mixtures of reference panels: dosage fits, likelihood grids, panel ranking."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..model import SITE, wide
from ..shipping import ship

FLOOR = 1e-4
#: Loci whose likelihoods are held for a whole grid at a time.
PART = 500


def clipped(p: Column, floor: float = FLOOR) -> Column:
    return F.least(F.greatest(p, F.lit(floor)), F.lit(1 - floor))


def log_pmf(n_alt: Column, p: Column) -> Column:
    """Log-likelihood of a diploid call under a frequency, binomial constant included."""
    q = clipped(p)
    return F.when(n_alt == 0, 2 * F.log(1 - q)).when(n_alt == 2, 2 * F.log(q)).otherwise(F.log(2 * q * (1 - q)))


def source_fraction(calls: DataFrame, freqs: DataFrame, source, base, least_gap: float = 0.4, least_loci: int = 20) -> DataFrame:  # noqa: ANN001
    """Least-squares share of ``source`` against ``base`` in each sample's dosages, held to
    [0, 1]; null below ``least_loci`` loci.  Loci are those where the panels differ enough."""
    at = lambda pop, name: freqs.filter((F.col("population") == pop) & F.col("p").isNotNull()).select(*SITE, F.col("p").alias(name))
    loci = at(source, "s").join(at(base, "b"), SITE).filter(F.abs(F.col("s") - F.col("b")) >= least_gap)
    d, g = F.col("s") - F.col("b"), F.col("n_alt") / 2 - F.col("b")
    sums = calls.filter("n_alt is not null").join(loci, SITE).groupBy("sample_id").agg(F.count(F.lit(1)).alias("n_loci"), F.sum(g * d).alias("gd"), F.sum(d * d).alias("dd"), F.sum(g * g).alias("gg"))
    f = F.least(F.greatest(F.col("gd") / F.col("dd"), F.lit(0.0)), F.lit(1.0))
    ok = (F.col("n_loci") >= least_loci) & (F.col("dd") > 0)
    out = sums.withColumn("fraction", F.when(ok, f))
    # The residual sum is a quadratic of the fraction: no second pass.
    rss = F.greatest(F.col("gg") - 2 * F.col("fraction") * F.col("gd") + F.col("fraction") ** 2 * F.col("dd"), F.lit(0.0))
    return out.select("sample_id", "n_loci", "fraction", F.sqrt(rss / F.col("n_loci")).alias("rmse"))


def informative(freqs: DataFrame, panels: list, base, least_gap: float = 0.15) -> DataFrame:  # noqa: ANN001
    """Sites known in all panels where one differs enough from the base."""
    rows = wide(freqs, [*panels, base])
    gap = F.greatest(*[F.abs(F.col(f"p{i}") - F.col(f"p{len(panels)}")) for i in range(len(panels))], F.lit(0.0))
    return rows.filter(gap >= least_gap).select(*SITE)


def panel_likelihoods(calls: DataFrame, freqs: DataFrame) -> DataFrame:
    """Log-likelihood of each sample under each panel, and the number of loci used."""
    both = calls.filter("n_alt is not null").select(*SITE, "sample_id", "n_alt").join(freqs.filter("p is not null").select(*SITE, F.col("population").alias("panel"), "p"), SITE)
    return both.groupBy("sample_id", "panel").agg(F.count(F.lit(1)).alias("n_loci"), F.sum(log_pmf(F.col("n_alt"), F.col("p"))).alias("loglik"))


def blended(freqs: DataFrame, parts: dict, shares: DataFrame) -> DataFrame:  # noqa: ANN001
    """sample_id, chrom, pos, panel, p: each panel's frequencies, blended with those of other
    populations.  ``parts`` maps a population to the column of ``shares(sample_id, ...)`` that
    is its share; the panel has the rest.  Sites known in all of them."""
    out = freqs.filter("p is not null").select(*SITE, F.col("population").alias("panel"), F.col("p").alias("own"))
    total, left = F.lit(0.0), F.lit(1.0)
    for i, (pop, share) in enumerate(parts.items()):
        out = out.join(freqs.filter((F.col("population") == pop) & F.col("p").isNotNull()).select(*SITE, F.col("p").alias(f"q{i}")), SITE)
        total, left = total + F.col(share) * F.col(f"q{i}"), left - F.col(share)
    # The samples asked about are few: they are named by the caller.
    return out.join(F.broadcast(shares)).select("sample_id", *SITE, "panel", (total + left * F.col("own")).alias("p"))


def blended_likelihoods(calls: DataFrame, mixed: DataFrame) -> DataFrame:
    """Log-likelihood of each sample under each of its blends, and the number of loci used."""
    both = calls.filter("n_alt is not null").select(*SITE, "sample_id", "n_alt").join(mixed, ["sample_id", *SITE])
    return both.groupBy("sample_id", "panel").agg(F.count(F.lit(1)).alias("n_loci"), F.sum(log_pmf(F.col("n_alt"), F.col("p"))).alias("loglik"))


def ranked(scores: DataFrame, top: int = 5, value: str = "loglik") -> DataFrame:
    """The best panels of each sample with their lead on the next; of equal ones the larger
    name comes first."""
    w = Window.partitionBy("sample_id").orderBy(F.desc(value), F.desc("panel"))
    out = scores.withColumns({"rank": F.row_number().over(w), "gap_to_next": F.col(value) - F.lead(value).over(w)})
    return out.filter(F.col("rank") <= top)


def candidate_scores(calls: DataFrame, freqs: DataFrame, pooled: DataFrame, n_loci: int, top: int = 5, gap: float = 5.0, least_share: float = 0.9) -> DataFrame:
    """The best panels of each sample beside the pooled panel (``pooled``: chrom, pos, p).
    Panels known at too few loci do not compete.  ``single``: the best panel explains the
    sample better than the pool by more than ``gap``."""
    own = panel_likelihoods(calls, freqs).filter(F.col("n_loci") >= least_share * n_loci)
    return beside_pool(own, panel_likelihoods(calls, pooled.withColumn("population", F.lit("any"))), top, gap)


def beside_pool(own: DataFrame, pool: DataFrame, top: int = 5, gap: float = 5.0) -> DataFrame:
    """The best of the likelihoods ``own`` of each sample, beside that of its pool."""
    pool = pool.select("sample_id", F.col("loglik").alias("any_loglik"))
    best = own.groupBy("sample_id").agg(F.max("loglik").alias("best"))
    out = ranked(own, top).join(best, "sample_id").join(pool, "sample_id", "left").withColumn("gap", F.col("best") - F.col("any_loglik"))
    return out.withColumn("single", F.col("gap") > gap).drop("best")


def leave_one_out(calls: DataFrame, n_loci: int, least_share: float = 0.9, min_group: int = 3) -> DataFrame:
    """Each sample against each panel of Laplace frequencies, its own panel less itself; panels
    of fewer than ``min_group`` samples, and panels that share too few loci with the sample,
    do not compete.  The panels' counts are corrected by the sample's own, so there is no
    scan per sample."""
    each = calls.groupBy("population", "sample_id").agg(F.lit(1).alias("x")).groupBy("population").agg(F.count(F.lit(1)).alias("m"))
    own = calls.filter("n_alt is not null").join(F.broadcast(each.filter(F.col("m") >= min_group).select("population")), "population", "left_semi").select(*SITE, "sample_id", "population", "n_alt")
    panel = own.groupBy(*SITE, "population").agg(F.count(F.lit(1)).alias("n"), F.sum("n_alt").alias("alt")).withColumnRenamed("population", "panel")
    both = own.join(panel, SITE)
    mine = (F.col("population") == F.col("panel")).cast("int")
    n, alt = F.col("n") - mine, F.col("alt") - mine * F.col("n_alt")
    scored = both.filter(n > 0).withColumn("ll", log_pmf(F.col("n_alt"), (alt + 1) / (2 * n + 2)))
    sums = scored.groupBy("sample_id", "population", "panel").agg(F.count(F.lit(1)).alias("n_loci"), F.sum("ll").alias("loglik")).filter(F.col("n_loci") >= least_share * n_loci)
    best = ranked(sums, 1).select("sample_id", "population", F.col("panel").alias("assigned"), F.col("gap_to_next").alias("gap"))
    return best.withColumn("correct", F.col("population") == F.col("assigned"))


def grid(step: float, three: bool) -> np.ndarray:
    """The shares (first, second) of a grid, in order."""
    k = round(1 / step)
    return np.array([(i, j) for i in range(k + 1) for j in (range(k + 1 - i) if three else [0])]) / k


def _logs(alt: np.ndarray, ref: np.ndarray, const: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Log-likelihoods (rows x points) of alleles under blends of three frequencies."""
    p = np.clip(b[:, None] + (x - b)[:, None] * points[:, 0] + (y - b)[:, None] * points[:, 1], FLOOR, 1 - FLOOR)
    return alt[:, None] * np.log(p) + ref[:, None] * np.log1p(-p) + const[:, None]


def mixture_grid(calls: DataFrame, freqs: DataFrame, base, one, two=None, step: float = 0.01, least_gap: float = 0.15) -> DataFrame:  # noqa: ANN001
    """Maximum-likelihood shares of ``one`` (and ``two``) against ``base`` on a grid; the first
    maximum in order of the first share, then the second.  Each task adds up the grid's sums for
    each sample, ``PART`` loci at a time; sites x grid rows are never made, and a sample's loci
    never meet in one task."""
    at = lambda pop, name: freqs.filter((F.col("population") == pop) & F.col("p").isNotNull()).select(*SITE, F.col("p").alias(name))
    loci, gap = at(base, "b").join(at(one, "x"), SITE), F.abs(F.col("x") - F.col("b")) >= least_gap
    if two is not None:
        loci, gap = loci.join(at(two, "y"), SITE), gap | (F.abs(F.col("y") - F.col("b")) >= least_gap)
    else:
        loci = loci.withColumn("y", F.lit(0.0))
    points, three, kind = grid(step, two is not None), two is not None, dict(calls.dtypes)["sample_id"]
    own = calls.filter("n_alt is not null").join(loci.filter(gap), SITE).select("sample_id", F.col("n_alt").cast("double").alias("g"), "b", "x", "y")
    ship(calls.sparkSession)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in batches:
            for s in range(0, batch.num_rows, PART):
                part = batch.slice(s, PART)
                g, b, x, y = (part.column(c).to_numpy() for c in ("g", "b", "x", "y"))
                ll = _logs(g, 2 - g, np.where(g == 1, math.log(2.0), 0.0), b, x, y, points)
                ids = part.column("sample_id").dictionary_encode()
                code = ids.indices.to_numpy()
                order = np.argsort(code, kind="stable")
                head = np.flatnonzero(np.concatenate([[True], np.diff(code[order]) > 0]))
                for c, n, row in zip(code[order][head], np.diff(np.append(head, len(code))), np.add.reduceat(ll[order], head), strict=True):
                    key = ids.dictionary[c].as_py()
                    was = held.get(key, (0, 0.0))
                    held[key] = was[0] + int(n), was[1] + row
        yield made(held)

    def made(held: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), types["sample_id"]), pa.array([n for n, _ in held.values()], pa.int64()), pa.array([r.tobytes() for _, r in held.values()], pa.binary())], names=["sample_id", "n_loci", "ll"])

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in batches:
            for key, n, ll in zip(*(batch.column(c).to_pylist() for c in ("sample_id", "n_loci", "ll")), strict=True):
                was = held.get(key, (0, 0.0))
                held[key] = was[0] + n, was[1] + np.frombuffer(ll)
        # Rounded, so that equal likelihoods tie whatever their rounding errors.
        top = {k: int(np.argmax(np.round(ll, 9))) for k, (_, ll) in held.items()}
        cols = {"sample_id": pa.array(list(held), types["sample_id"]), "n_loci": pa.array([n for n, _ in held.values()], pa.int64()), "share_one": pa.array([points[i, 0] for i in top.values()], pa.float64())}
        if three:
            cols["share_two"] = pa.array([points[i, 1] for i in top.values()], pa.float64())
        cols["loglik"] = pa.array([float(ll[top[k]]) for k, (_, ll) in held.items()], pa.float64())
        yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    types = {"sample_id": to_arrow_type(own.schema["sample_id"].dataType)}
    per = own.mapInArrow(sums, f"sample_id {kind}, n_loci bigint, ll binary").repartition("sample_id")
    return per.mapInArrow(best, f"sample_id {kind}, n_loci bigint, share_one double, " + "share_two double, " * three + "loglik double")


def alleles(calls: DataFrame) -> DataFrame:
    """sample_id, chrom, pos, alt, ref (alleles) and const (the binomial constants) of calls;
    samples that share an id are a cohort, taken as one."""
    g = F.col("n_alt")
    return calls.filter("n_alt is not null").groupBy("sample_id", *SITE).agg(F.sum(g).alias("alt"), F.sum(2 - g).alias("ref"), F.sum(F.when(g == 1, math.log(2.0)).otherwise(0.0)).alias("const"))


def blend_grid(counted: DataFrame, freqs: DataFrame, base, one, two=None, step: float = 0.01, reps: int = 0, seed: int = 0) -> DataFrame:  # noqa: ANN001
    """Maximum-likelihood shares of ``one`` (and ``two``) against ``base`` for each id of
    ``alleles``, the first maximum in order of the first share, then the second; with ``reps``
    also 2.5 and 97.5 percentiles over resampled loci.  A locus counts Poisson(1) times in a
    replicate, by a hash.  The grid stays in the workers: loci x grid numbers of ``PART`` loci
    at a time, and replicates x grid sums of each id."""
    at = lambda pop, name: freqs.filter((F.col("population") == pop) & F.col("p").isNotNull()).select(*SITE, F.col("p").alias(name))
    loci = at(base, "b").join(at(one, "x"), SITE)
    loci = loci.join(at(two, "y"), SITE) if two is not None else loci.withColumn("y", F.lit(0.0))
    points = grid(step, two is not None)
    cuts = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(8)])

    def fit(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("chrom", "ascending"), ("pos", "ascending")])
        sums = np.zeros((reps + 1, len(points)))
        alt, ref, const, b, x, y, h = (rows.column(c).to_numpy().astype(np.uint64 if c == "h" else float) for c in ("alt", "ref", "const", "b", "x", "y", "h"))
        for s in range(0, len(alt), PART):
            o = slice(s, s + PART)
            ll = _logs(alt[o], ref[o], const[o], b[o], x[o], y[o], points)
            u = h[o, None] ^ (np.arange(1, reps + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[None, :]
            for shift, times in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                u = (u ^ (u >> np.uint64(shift))) * np.uint64(times)
            w = np.searchsorted(cuts, (u >> np.uint64(11)) / float(1 << 53), side="right")
            sums += np.concatenate([np.ones((1, len(ll))), w.T]) @ ll
        # Rounded, so that equal likelihoods tie whatever their rounding errors.
        best = np.argmax(np.round(sums, 9), axis=1)
        low, high = (np.percentile(points[best[1:]], q, axis=0) if reps else (None, None) for q in (2.5, 97.5))
        out = {"sample_id": rows.column("sample_id")[:1], "n_loci": [len(alt)], "share_one": [points[best[0], 0]]}
        if two is not None:
            out["share_two"] = [points[best[0], 1]]
        out["loglik"] = [sums[0, best[0]]]
        if reps:
            for i, name in enumerate(("one", "two")[: 1 + (two is not None)]):
                out |= {f"{name}_low": [low[i]], f"{name}_high": [high[i]]}
        return pa.table(out)

    names = ["one", "two"][: 1 + (two is not None)]
    schema = "sample_id string, n_loci bigint, " + "".join(f"share_{n} double, " for n in names) + "loglik double" + "".join(f", {n}_low double, {n}_high double" for n in names if reps)
    own = counted.withColumn("sample_id", F.col("sample_id").cast("string")).join(loci, SITE).withColumn("h", F.xxhash64(F.lit(seed), *SITE))
    ship(counted.sparkSession)
    return own.groupBy("sample_id").applyInArrow(fit, schema)


def bootstrap_interval(calls: DataFrame, freqs: DataFrame, source, base, reps: int = 100, seed: int = 0, least_gap: float = 0.4) -> DataFrame:  # noqa: ANN001
    """2.5 and 97.5 percentiles of the source fraction over resampled loci.  A locus' weight in
    a replicate is Poisson(1), drawn from a hash, so replicates are sums of one pass."""
    at = lambda pop, name: freqs.filter((F.col("population") == pop) & F.col("p").isNotNull()).select(*SITE, F.col("p").alias(name))
    loci = at(source, "s").join(at(base, "b"), SITE).filter(F.abs(F.col("s") - F.col("b")) >= least_gap)
    d, g = F.col("s") - F.col("b"), F.col("n_alt") / 2 - F.col("b")
    own = calls.filter("n_alt is not null").join(loci, SITE).select(*SITE, "sample_id", (g * d).alias("gd"), (d * d).alias("dd"))
    cuts, total, term = [], 0.0, 0.36787944117144233
    for n in range(8):
        total += term
        cuts.append(total)
        term /= n + 1
    aggs = []
    for r in range(reps):
        u = F.pmod(F.xxhash64(F.lit(seed), F.lit(r), *SITE), F.lit(1 << 30)) / float(1 << 30)
        w = sum((F.when(u >= c, 1).otherwise(0) for c in cuts), F.lit(0))
        aggs += [F.sum(w * F.col("gd")).alias(f"n{r}"), F.sum(w * F.col("dd")).alias(f"d{r}")]
    got = own.groupBy("sample_id").agg(*aggs)
    f = F.array(*[F.when(F.col(f"d{r}") > 0, F.least(F.greatest(F.col(f"n{r}") / F.col(f"d{r}"), F.lit(0.0)), F.lit(1.0))) for r in range(reps)])
    each = got.select("sample_id", F.explode(f).alias("f"))
    return each.groupBy("sample_id").agg(*[F.bround(F.percentile("f", F.lit(q)), 3).alias(n) for q, n in ((0.025, "low"), (0.975, "high"))])


def pedigree_verdict(fractions: DataFrame, f1, parent, offspring: list, target: float = 0.46, tolerance: float = 0.2, parent_max: float = 0.2, low: float = 0.08, high: float = 0.45) -> DataFrame:  # noqa: ANN001
    """Whether a first cross, its other parent and its offspring have the expected shares."""
    of = lambda s: F.max(F.when(F.col("sample_id") == s, F.col("fraction")))
    f1_ok, parent_ok = F.abs(of(f1) - target) <= tolerance, of(parent) <= parent_max
    kids = [of(s).between(low, high) for s in offspring]
    yes = lambda c: F.coalesce(c, F.lit(False))
    every = F.lit(True)
    for c in kids:
        every = every & yes(c)
    return fractions.agg(yes(f1_ok).alias("f1"), yes(parent_ok).alias("parent"), every.alias("offspring"), (yes(f1_ok) & yes(parent_ok) & every).alias("supported"))
