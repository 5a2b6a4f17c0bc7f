"""f-statistics with block jackknives.

A statistic is a ratio of sums of two expressions over sites (the denominator may be 1).
Sites are summed per block first, in one aggregate with map-side combining; all jackknife
arithmetic runs on those block sums, of which there are few however many sites there are.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.special import significant, two_sided_p
from ..model import SITE, ranked, wide


def block_of(sites: DataFrame, mode: str = "chromosome", size_bp: int = 1_000_000, n_blocks: int = 20) -> DataFrame:
    """Adds ``block``: the contig, a run of ``size_bp`` bases, or one of ``n_blocks`` runs of
    sites of equal number (as NTILE)."""
    if mode == "chromosome":
        return sites.withColumn("block", F.col("chrom").cast("string"))
    if mode == "bp":
        return sites.withColumn("block", F.concat_ws(":", F.col("chrom"), F.floor((F.col("pos") - 1) / size_bp)))
    i, n = F.col("_rank"), F.least(F.col("_total"), F.lit(n_blocks))
    size, extra = F.floor(F.col("_total") / n), F.col("_total") % n
    tile = F.when(i < extra * (size + 1), F.floor(i / (size + 1))).otherwise(extra + F.floor((i - extra * (size + 1)) / size))
    return ranked(sites).withColumn("block", tile.cast("string")).drop("_rank", "_total")


def block_sums(terms: DataFrame, by: list[str]) -> DataFrame:
    """num, den and the number of sites of each block, for ``terms(*by, block, num, den)``."""
    return terms.filter("num is not null and den is not null").groupBy(*by, "block").agg(F.sum("num").alias("num"), F.sum("den").alias("den"), F.count(F.lit(1)).alias("n"))


def jackknife(sums: DataFrame, by: list[str]) -> DataFrame:
    """Unweighted delete-one jackknife: estimate, se, z, blocks, sites.  A block whose removal
    leaves no denominator is dropped; with fewer than two left there is no error."""
    w = Window.partitionBy(*by)
    left = sums.withColumns({"all_num": F.sum("num").over(w), "all_den": F.sum("den").over(w)})
    rest = F.col("all_den") - F.col("den")
    left = left.withColumn("theta", F.when(rest != 0, (F.col("all_num") - F.col("num")) / rest))
    out = left.groupBy(*by).agg(
        F.when(F.sum("den") != 0, F.sum("num") / F.sum("den")).alias("estimate"), F.count("theta").alias("n_blocks"), F.sum("n").alias("n_sites"), F.var_pop("theta").alias("v")
    )
    g = F.col("n_blocks")
    se = F.when(g >= 2, F.sqrt((g - 1) * F.col("v")))
    return out.withColumn("se", se).withColumn("z", F.when(F.col("se") > 0, F.col("estimate") / F.col("se"))).drop("v")


def quotient(num: Column, den: Column) -> Column:
    """Null where the denominator is zero but for rounding."""
    return F.when(F.abs(den) > 1e-12, num / den)


def weighted_jackknife(sums: DataFrame, by: list[str]) -> DataFrame:
    """Delete-one jackknife for blocks of unequal size: pseudovalues weighted by block size."""
    w = Window.partitionBy(*by)
    left = sums.withColumns({"all_num": F.sum("num").over(w), "all_den": F.sum("den").over(w), "all_n": F.sum("n").over(w), "g": F.count(F.lit(1)).over(w)})
    h, theta = F.col("all_n") / F.col("n"), quotient(F.col("all_num"), F.col("all_den"))
    minus = quotient(F.col("all_num") - F.col("num"), F.col("all_den") - F.col("den"))
    left = left.withColumns({"h": h, "theta": theta, "minus": minus})
    left = left.withColumn("ps", F.col("h") * F.col("theta") - (F.col("h") - 1) * F.col("minus"))
    centre = F.col("g") * F.col("theta") - F.sum((1 - 1 / F.col("h")) * F.col("minus")).over(w)
    left = left.withColumn("centre", centre)
    part = F.when(F.col("h") > 1, F.pow(F.col("ps") - F.col("centre"), 2) / (F.col("h") - 1)).otherwise(0.0)
    out = left.groupBy(*by).agg(F.first("theta").alias("estimate"), F.first("g").alias("n_blocks"), F.first("all_n").alias("n_sites"), F.sqrt(F.avg(part)).alias("se"))
    return out.withColumn("z", F.when(F.col("se") > 0, F.col("estimate") / F.col("se")))


def d_terms(p1: Column, p2: Column, p3: Column, po: Column) -> tuple[Column, Column]:
    """ABBA - BABA and ABBA + BABA."""
    abba = (1 - p1) * p2 * p3 * (1 - po) + p1 * (1 - p2) * (1 - p3) * po
    baba = p1 * (1 - p2) * p3 * (1 - po) + (1 - p1) * p2 * (1 - p3) * po
    return abba - baba, abba + baba


def panel_d_terms(w: Column, x: Column, y: Column, z: Column) -> tuple[Column, Column]:
    """The other sign convention: (w - x)(y - z) over its normaliser."""
    return (w - x) * (y - z), (w + x - 2 * w * x) * (y + z - 2 * y * z)


def trios(populations: list, outgroup) -> list[tuple]:  # noqa: ANN001
    """Every third population with every unordered pair of the others, without the outgroup."""
    own = [p for p in sorted(populations) if p != outgroup]
    return [(a, b, c) for c in own for a, b in combinations([p for p in own if p != c], 2)]


def d_statistics(freqs: DataFrame, populations: list, outgroup, mode: str = "chromosome", **block) -> DataFrame:  # noqa: ANN001
    """D of every trio, in one pass over the sites: a site's frequencies become one row, its
    terms for all trios one array."""
    pops = sorted(populations)
    at = {p: F.col(f"p{i}") for i, p in enumerate(pops)}
    rows = block_of(wide(freqs, pops), mode, **block)
    each = F.array(*[F.struct(F.lit(a).alias("p1"), F.lit(b).alias("p2"), F.lit(c).alias("p3"), t[0].alias("num"), t[1].alias("den")) for a, b, c in trios(pops, outgroup) for t in [d_terms(at[a], at[b], at[c], at[outgroup])]])
    terms = rows.select("block", F.inline(each))
    return jackknife(block_sums(terms, ["p1", "p2", "p3"]), ["p1", "p2", "p3"])


def with_p(frame: DataFrame) -> DataFrame:
    """Two-sided p of z, to three significant digits."""
    return frame.withColumn("p", F.when(F.col("z").isNotNull(), significant(two_sided_p(F.col("z")))))


def statistic(freqs: DataFrame, populations: list, terms, weighted: bool = False, mode: str = "chromosome", **block) -> DataFrame:  # noqa: ANN001
    """One statistic: ``terms`` makes (num, den) from the populations' frequencies."""
    rows = block_of(wide(freqs, populations), mode, **block)
    num, den = terms(*[F.col(f"p{i}") for i in range(len(populations))])
    sums = block_sums(rows.select(F.lit(0).alias("one"), "block", num.alias("num"), (den if isinstance(den, Column) else F.lit(float(den))).alias("den")), ["one"])
    return (weighted_jackknife if weighted else jackknife)(sums, ["one"]).drop("one")


def f4(freqs: DataFrame, a, b, c, d, **how) -> DataFrame:  # noqa: ANN001
    return statistic(freqs, [a, b, c, d], lambda a, b, c, d: ((a - b) * (c - d), 1), **how)


def f4_ratio(freqs: DataFrame, a, o, x, b, c, **how) -> DataFrame:  # noqa: ANN001
    """f4(a, o; x, c) / f4(a, o; b, c)."""
    return statistic(freqs, [a, o, x, b, c], lambda a, o, x, b, c: ((a - o) * (x - c), (a - o) * (b - c)), **how)


def paired_difference(freqs: DataFrame, a, o, x, y, b, c, **how) -> DataFrame:  # noqa: ANN001
    """The difference of two f4-ratios with one denominator."""
    return statistic(freqs, [a, o, x, y, b, c], lambda a, o, x, y, b, c: ((a - o) * (x - y), (a - o) * (b - c)), **how)


def rotations(freqs: DataFrame, outgroup) -> DataFrame:  # noqa: ANN001
    """f4(x, y; t, outgroup) for every pair of references and every other target.  Differences
    from the outgroup are made per site first; a site's populations meet through its key."""
    o = freqs.filter((F.col("population") == outgroup) & F.col("p").isNotNull()).select(*SITE, F.col("p").alias("o"))
    own = freqs.filter((F.col("population") != outgroup) & F.col("p").isNotNull()).join(o, SITE)
    side = lambda n: own.select(*SITE, F.col("population").alias(n), F.col("p").alias(f"p_{n}"), *([F.col("o")] if n == "t" else []))
    each = side("x").join(side("y"), SITE).filter("x < y").join(side("t"), SITE).filter("t != x and t != y")
    return each.groupBy("x", "y", "t").agg(F.count(F.lit(1)).alias("n_sites"), F.avg((F.col("p_x") - F.col("p_y")) * (F.col("p_t") - F.col("o"))).alias("f4"))


def f3_matrix(freqs: DataFrame, outgroup, n_blocks: int | None = None) -> DataFrame:  # noqa: ANN001
    """Mean (o - a)(o - b) of all pairs, a = b included; with ``n_blocks`` also its delete-one
    error over so many runs of sites of equal number."""
    o = freqs.filter((F.col("population") == outgroup) & F.col("p").isNotNull()).select(*SITE, F.col("p").alias("o"))
    if n_blocks:
        o = block_of(o, "sites", n_blocks=n_blocks)
    extra = ["block"] if n_blocks else []
    own = freqs.filter((F.col("population") != outgroup) & F.col("p").isNotNull()).join(o, SITE).select(*SITE, *extra, F.col("population").alias("i"), (F.col("o") - F.col("p")).alias("x"))
    pairs = own.join(own.select(*SITE, F.col("i").alias("j"), F.col("x").alias("y")), SITE).filter("i <= j")
    if not n_blocks:
        return pairs.groupBy("i", "j").agg(F.count(F.lit(1)).alias("n_sites"), F.avg(F.col("x") * F.col("y")).alias("f3"))
    sums = block_sums(pairs.select("i", "j", "block", (F.col("x") * F.col("y")).alias("num"), F.lit(1.0).alias("den")), ["i", "j"])
    return jackknife(sums, ["i", "j"]).select("i", "j", "n_sites", F.col("estimate").alias("f3"), "se", "z")


def auto_outgroup(freqs: DataFrame) -> DataFrame:
    """The population with the largest mean absolute difference from the others."""
    own = freqs.filter("p is not null").select(*SITE, "population", "p")
    pairs = own.join(own.select(*SITE, F.col("population").alias("other"), F.col("p").alias("q")), SITE).filter("population != other")
    return pairs.groupBy("population").agg(F.avg(F.abs(F.col("p") - F.col("q"))).alias("difference"))


def fd_windows(freqs: DataFrame, quartet: list, window_bp: int = 100_000, min_sites: int = 10) -> DataFrame:
    """f_d in windows from each contig's first position; the donor frequency is the larger of
    the second and the third population's."""
    rows = wide(freqs, quartet)
    first = rows.groupBy("chrom").agg(F.min("pos").alias("first"))
    p1, p2, p3, po = (F.col(f"p{i}") for i in range(4))
    donor = F.greatest(p2, p3)
    each = rows.join(F.broadcast(first), "chrom").withColumn("w", F.floor((F.col("pos") - F.col("first")) / window_bp))
    num, den = d_terms(p1, p2, p3, po)[0], d_terms(p1, donor, donor, po)[0]
    out = each.groupBy("chrom", "w").agg(F.first("first").alias("first"), F.count(F.lit(1)).alias("n_sites"), F.sum(num).alias("num"), F.sum(den).alias("den")).filter(F.col("n_sites") >= min_sites)
    start = F.col("first") + F.col("w") * window_bp
    return out.select("chrom", start.alias("start"), (start + window_bp).alias("end"), "n_sites", F.when(F.abs(F.col("den")) > 1e-12, F.col("num") / F.col("den")).alias("f_d"))


def qpadm(freqs: DataFrame, target, sources: list, rights: list, **block) -> dict:  # noqa: ANN001
    """Weights of the sources in the target by least squares on f4(target, S0; R0, Ri) against
    f4(Ss, S0; R0, Ri), S0 taking the rest.  Errors, and the covariance of what the fit leaves,
    are those of a weighted block jackknife that refits without each block; the chi-squared
    test looks at the ``len(rights) - len(sources)`` directions in which they vary most.

    Spark sums each block's terms in one pass; the rest works on (blocks x sources x rights)
    numbers on the driver.  At least two sources, as many rights, two blocks and sources that
    the rights tell apart are needed."""
    import numpy as np

    from ..functions.special import chi2_sf

    if len(sources) < 2 or len(rights) < len(sources):
        raise ValueError("at least two sources, and no fewer rights than sources, are needed")
    pops = [target, *sources, *rights]
    rows = block_of(wide(freqs, pops), **block)
    p = {x: F.col(f"p{i}") for i, x in enumerate(pops)}
    left = [p[x] - p[sources[0]] for x in (target, *sources[1:])]
    right = [p[rights[0]] - p[r] for r in rights[1:]]
    sums = [F.sum(a * b).alias(f"t{i}_{j}") for i, a in enumerate(left) for j, b in enumerate(right)]
    got = rows.groupBy("block").agg(F.count(F.lit(1)).alias("n"), *sums).orderBy("block").collect()
    if len(got) < 2:
        raise ValueError("at least two blocks are needed")
    size = np.array([r["n"] for r in got], float)
    terms = np.array([[[r[f"t{i}_{j}"] for j in range(len(right))] for i in range(len(left))] for r in got])
    total, n = terms.sum(axis=0), size.sum()

    def fit(mean: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(weights of all sources, what the fit leaves of the target's f4)."""
        own, of = mean[0], mean[1:].T
        w = np.linalg.lstsq(of, own, rcond=None)[0]
        return np.array([1 - w.sum(), *w]), own - of @ w

    if np.linalg.matrix_rank(total[1:] / n) < len(sources) - 1:
        raise ValueError("the rights do not tell the sources apart")
    weights, rest = fit(total / n)
    without = [fit((total - t) / (n - m)) for t, m in zip(terms, size, strict=True)]
    h = (n / size)[:, None]

    def deviations(whole: np.ndarray, minus: np.ndarray) -> np.ndarray:
        """Pseudovalues less their centre, a row for each block, of unit weight."""
        centre = len(size) * whole - ((1 - 1 / h) * minus).sum(axis=0)
        return (h * whole - (h - 1) * minus - centre) / np.sqrt(h - 1)

    se = np.sqrt((deviations(weights, np.array([w for w, _ in without])) ** 2).mean(axis=0))
    dof, chi = len(rights) - len(sources), 0.0
    if dof:
        dev = deviations(rest, np.array([r for _, r in without]))
        values, axes = np.linalg.eigh(dev.T @ dev / len(size))
        chi = float(((axes[:, -dof:].T @ rest) ** 2 / values[-dof:]).sum())
    return {
        "weights": dict(zip(sources, weights.tolist(), strict=True)),
        "se": dict(zip(sources, se.tolist(), strict=True)),
        "chisq": chi,
        "dof": dof,
        "p": chi2_sf(chi, dof) if dof else None,
        "n_sites": int(n),
        "n_blocks": len(size),
    }
