"""Population statistics from site and population counts (``model.counts``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..model import SITE
from . import dense

EARTH_KM = 6371.0088


def laplace(called: DataFrame, by: str = "population") -> DataFrame:
    """(ALT + 1) / (2 n + 2) per site and group; null without a call."""
    out = called.groupBy(*SITE, by).agg(F.count("n_alt").alias("n_called"), F.sum("n_alt").alias("alt"))
    return out.select(*SITE, by, "n_called", F.when(F.col("n_called") > 0, (F.col("alt") + 1) / (2 * F.col("n_called") + 2)).alias("p"))


def shrunk(count: DataFrame, weight: float = 6.0) -> DataFrame:
    """Frequencies drawn towards the mean of the populations' own: (ALT + w m) / (2 n + w)."""
    prior = count.groupBy(*SITE).agg(F.avg("p").alias("prior"))
    return count.join(prior, SITE).select(*SITE, "population", "prior", ((F.col("alt_n") + weight * F.col("prior")) / (2 * F.col("n_called") + weight)).alias("p"))


def with_differences(count: DataFrame) -> DataFrame:
    """Mean difference within each population at each site; 0 below two alleles."""
    n = F.col("ref_n") + F.col("alt_n")
    return count.withColumn("within", F.when(n > 1, 2 * F.col("ref_n") * F.col("alt_n") / (n * (n - 1))).otherwise(0.0))


def diversity(count: DataFrame, called: DataFrame, callable_sites: int = 0) -> DataFrame:
    """Sites, segregating sites, pi and mean heterozygosity of each population."""
    per = callable_sites or None
    pi = F.sum("within") / per if per else F.avg("within")
    stats = with_differences(count).groupBy("population").agg(
        F.count(F.lit(1)).alias("n_sites"), F.sum(((F.col("ref_n") > 0) & (F.col("alt_n") > 0)).cast("bigint")).alias("segregating"), pi.alias("pi")
    )
    het = called.groupBy("sample_id", "population").agg(F.avg((F.col("n_alt") == 1).cast("double")).alias("h"))
    return stats.join(het.groupBy("population").agg(F.count(F.lit(1)).alias("n_samples"), F.avg("h").alias("het")), "population")


def hudson_terms(count: DataFrame) -> DataFrame:
    """num and den of Hudson's F_ST at each site and unordered pair of populations.  One
    shuffle: a site's populations meet through the site key."""
    own = with_differences(count).filter("ref_n + alt_n > 1").select(*SITE, "population", "ref_n", "alt_n", "within")
    other = own.select(*SITE, *[F.col(c).alias(f"{c}_2") for c in ("population", "ref_n", "alt_n", "within")])
    pairs = own.join(other, SITE).filter("population < population_2")
    n1, n2 = F.col("ref_n") + F.col("alt_n"), F.col("ref_n_2") + F.col("alt_n_2")
    between = 1 - (F.col("ref_n") * F.col("ref_n_2") + F.col("alt_n") * F.col("alt_n_2")) / (n1 * n2)
    return pairs.select(*SITE, F.col("population").alias("pop1"), F.col("population_2").alias("pop2"), (between - (F.col("within") + F.col("within_2")) / 2).alias("num"), between.alias("den"))


def ratio(num: str = "num", den: str = "den") -> Column:
    return F.when(F.sum(den) > 0, F.sum(num) / F.sum(den))


def fst(count: DataFrame) -> DataFrame:
    """Ratio of sums over sites; null where the denominator is not positive."""
    return hudson_terms(count).groupBy("pop1", "pop2").agg(F.count(F.lit(1)).alias("n_sites"), ratio().alias("fst"))


def distance(called: DataFrame, sites: DataFrame, samples: DataFrame) -> DataFrame:
    """Mean allele difference of pairs of samples over the given sites; a missing call counts
    as homozygous reference.  Sites are vectors over samples; the result has samples**2 rows."""
    called = called.persist()
    kind = dict(samples.dtypes)["sample_id"]
    try:
        ids = dense.sample_ids(samples)
        every = sorted({*ids, *dense.sample_ids(called)})
        got = dense.pair_sums(called, sites, every, dense.differences).get("")
    finally:
        called.unpersist()
    n = int(got[1, 0, 0]) if got is not None else 0
    at = {x: i for i, x in enumerate(every)}
    rows = [(a, b, float(got[0, at[a], at[b]]) / (2 * n) if n else None) for i, a in enumerate(ids) for b in ids[i + 1 :]]
    return called.sparkSession.createDataFrame(rows, f"s1 {kind}, s2 {kind}, distance double")


def folded_spectrum(count: DataFrame) -> DataFrame:
    """Number of sites by minor allele count of each population."""
    return count.groupBy("population", F.least("ref_n", "alt_n").alias("minor_count")).agg(F.count(F.lit(1)).alias("n_sites"))


def tajima_d(n: Column, s: Column, diff: Column) -> Column:
    """Tajima's D of s segregating sites and a summed mean difference among n alleles; null
    below three sites."""
    upto = F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1)).cast("int"))
    add = lambda f: F.aggregate(upto, F.lit(0.0), lambda acc, i: acc + f(i))
    a1, a2 = add(lambda i: 1 / i), add(lambda i: 1 / (i * i))
    b1, b2 = (n + 1) / (3 * (n - 1)), 2 * (n * n + n + 3) / (9 * n * (n - 1))
    c1, c2 = b1 - 1 / a1, b2 - (n + 2) / (a1 * n) + a2 / (a1 * a1)
    spread = F.sqrt(c1 / a1 * s + c2 / (a1 * a1 + a2) * s * (s - 1))
    return F.when((s >= 3) & (n > 2), (diff - s / a1) / spread)


def demography(count: DataFrame, called: DataFrame, callable_sites: int = 0, mutation_rate: float = 0.0) -> DataFrame:
    """Chromosomes, segregating sites and mean difference of each population; Watterson's theta
    and pi per callable site, Tajima's D and the effective size are given only if the number of
    callable sites is known, because a panel of chosen sites says nothing per base."""
    seg = (F.col("ref_n") > 0) & (F.col("alt_n") > 0)
    size = called.groupBy("population", "sample_id").agg(F.lit(1).alias("x")).groupBy("population").agg((2 * F.count(F.lit(1))).alias("n_chromosomes"))
    base = with_differences(count).groupBy("population").agg(
        F.max(F.col("ref_n") + F.col("alt_n")).alias("n"), F.sum(seg.cast("bigint")).alias("n_segregating"), F.sum("within").alias("diff"), F.avg("within").alias("mean_difference")
    )
    out = base.join(F.broadcast(size), "population")
    if not callable_sites:
        none = F.lit(None).cast("double")
        return out.select("population", "n_chromosomes", "n_segregating", "mean_difference", none.alias("theta_w"), none.alias("pi"), none.alias("tajima_d"), F.lit(None).cast("bigint").alias("ne"))
    a = F.aggregate(F.sequence(F.lit(1), F.greatest(F.col("n_chromosomes") - 1, F.lit(1)).cast("int")), F.lit(0.0), lambda acc, i: acc + 1 / i)
    pi = F.col("diff") / callable_sites
    ne = (pi / (4 * mutation_rate)).cast("bigint") if mutation_rate > 0 else F.lit(None).cast("bigint")
    d = tajima_d(F.col("n"), F.col("n_segregating"), F.col("diff"))
    return out.select("population", "n_chromosomes", "n_segregating", "mean_difference", (F.col("n_segregating") / a / callable_sites).alias("theta_w"), pi.alias("pi"), d.alias("tajima_d"), ne.alias("ne"))


def haversine(places: DataFrame) -> DataFrame:
    """km between unordered pairs of ``places(sample_id, lat, lon)`` (a few, by nature)."""
    a, b = (places.select(F.col("sample_id").alias(f"s{i}"), F.radians("lat").alias(f"lat{i}"), F.radians("lon").alias(f"lon{i}")) for i in (1, 2))
    pairs = a.join(b, F.col("s1") < F.col("s2"))
    h = F.pow(F.sin((F.col("lat2") - F.col("lat1")) / 2), 2) + F.cos("lat1") * F.cos("lat2") * F.pow(F.sin((F.col("lon2") - F.col("lon1")) / 2), 2)
    return pairs.select("s1", "s2", (2 * EARTH_KM * F.asin(F.sqrt(F.least(h, F.lit(1.0))))).alias("km"))


def mantel_r(d1: DataFrame, d2: DataFrame, x: str, y: str) -> DataFrame:
    return d1.join(d2, ["s1", "s2"]).agg(F.corr(x, y).alias("r"), F.regr_slope(F.col(x), F.col(y)).alias("slope"), F.regr_intercept(F.col(x), F.col(y)).alias("intercept"))


def adjusted_rand(labels: DataFrame, a: str, b: str) -> DataFrame:
    """Agreement of two groupings of the same rows."""
    two = lambda c: F.col(c) * (F.col(c) - 1) / 2
    cells = labels.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    both = cells.agg(F.sum(two("n")).alias("ij"), F.sum("n").alias("total"))
    rows = cells.groupBy(a).agg(F.sum("n").alias("n")).agg(F.sum(two("n")).alias("i"))
    cols = cells.groupBy(b).agg(F.sum("n").alias("n")).agg(F.sum(two("n")).alias("j"))
    expected = F.col("i") * F.col("j") / two("total")
    most = (F.col("i") + F.col("j")) / 2
    return both.join(rows).join(cols).select(F.when(most == expected, 1.0).otherwise((F.col("ij") - expected) / (most - expected)).alias("ari"))


def gl_em(likelihoods: DataFrame, rounds: int = 60, tol: float = 1e-7) -> DataFrame:
    """ALT frequency of each site and population by EM over phred likelihoods (``pl``, three
    numbers), under Hardy-Weinberg from 0.5; all-zero likelihoods are missing.  A site's
    likelihoods are folded into one array, and the rounds are an expression over it; a site
    and population whose frequency moves by less than ``tol`` is done."""
    weight = F.transform("pl", lambda x: F.pow(F.lit(10.0), -x / 10))
    good = likelihoods.filter("pl[0] + pl[1] + pl[2] > 0").withColumn("w", weight)
    sites = good.groupBy(*SITE, "population").agg(F.collect_list("w").alias("ws"))

    def step(state: Column, _: Column) -> Column:
        p = state["p"]

        def expected(w: Column) -> Column:
            a, b, c = w[0] * (1 - p) * (1 - p), w[1] * 2 * p * (1 - p), w[2] * p * p
            return (b + 2 * c) / (a + b + c)

        new = F.aggregate(F.col("ws"), F.lit(0.0), lambda acc, w: acc + expected(w)) / (2 * F.size("ws"))
        return F.when(state["moves"], F.struct(new.alias("p"), (F.abs(new - p) >= tol).alias("moves"))).otherwise(state)

    start = F.struct(F.lit(0.5).alias("p"), F.lit(True).alias("moves"))
    return sites.select(*SITE, "population", F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, step, lambda state: state["p"]).alias("p"))


def median_top(frame: DataFrame, key: str, value: str) -> DataFrame:
    """The key of the largest value (ties to the smaller key), and the median."""
    return frame.agg(F.max_by(key, F.struct(F.col(value), -F.col(key))).alias("top"), F.max(value).alias("top_value"), F.median(value).alias("median"))


def running_q(frame: DataFrame, p: str = "p") -> DataFrame:
    """Benjamini-Hochberg q-values; null p stay null.  The tests of one study are few."""
    known = frame.filter(F.col(p).isNotNull())
    up, n = Window.orderBy(F.col(p)), known.agg(F.count(F.lit(1)).alias("_m"))
    ranked = known.withColumn("_k", F.row_number().over(up)).join(F.broadcast(n))
    down = Window.orderBy(F.desc("_k")).rowsBetween(Window.unboundedPreceding, 0)
    out = ranked.withColumn("q", F.least(F.min(F.col(p) * F.col("_m") / F.col("_k")).over(down), F.lit(1.0))).drop("_k", "_m")
    return out.unionByName(frame.filter(F.col(p).isNull()).withColumn("q", F.lit(None).cast("double")))
