"""Study compositions: ancestry clines, rotations of references, groups against references,
held-out mixed samples.  Groups are named by their samples, which are few; sites are read once
for all of them."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..model import SITE
from ..operators import fstats, mixture, population

#: Roles of a unit: two that set the axis (A, O), the unit (X), its two references (B, C).
ROLES = ("A", "O", "X", "B", "C")
HIGH_COVERAGE = 10.0


def unit(name: str, members: list[str], roles: dict[str, list[str]], kind: str = "group", group: str = "") -> dict:
    """A unit to be scored; its members are left out of its references B and C."""
    out = {r: [s for s in samples if r in ("A", "O") or s not in members] for r, samples in roles.items()}
    return {"unit": name, "kind": kind, "group": group or name, "roles": out | {"X": list(members)}}


def cline_units(groups: dict[str, list[str]], roles: dict[str, str], targets: list[str], singly: list[str]) -> list[dict]:
    """The target groups, and each sample of the groups ``singly``; ``roles`` names the groups of
    A, O, B and C."""
    of = {r: groups[g] for r, g in roles.items()}
    out = [unit(g, groups[g], of) for g in targets]
    return out + [unit(s, [s], of, "individual", g) for g in singly for s in groups[g]]


def membership(calls: DataFrame, units: list[dict]) -> DataFrame:
    """The calls with the unit and role of each of their samples' memberships."""
    rows = [(u["unit"], r, s) for u in units for r, samples in u["roles"].items() for s in samples]
    named = calls.sparkSession.createDataFrame(rows, "unit string, role string, sample_id string")
    return calls.withColumn("sample_id", F.col("sample_id").cast("string")).join(F.broadcast(named), "sample_id")


def unit_frequencies(calls: DataFrame, units: list[dict], likelihoods: bool = False) -> DataFrame:
    """chrom, pos, unit, role, p from ``n_alt``, or by EM from ``pl``."""
    own = membership(calls, units)
    if likelihoods:
        got = population.gl_em(own.withColumn("population", F.struct("unit", "role")).select(*SITE, "population", "pl"))
        return got.select(*SITE, "population.unit", "population.role", "p")
    return own.filter("n_alt is not null").groupBy(*SITE, "unit", "role").agg((F.sum("n_alt") / (2 * F.count("n_alt"))).alias("p"))


def unit_statistics(freqs: DataFrame) -> DataFrame:
    """unit, and estimate, se, z, n_sites of its f4-ratio f4(A, O; X, C) / f4(A, O; B, C) and of
    its D(X, B; C, O), with contigs as blocks."""
    rows = freqs.groupBy(*SITE, "unit").pivot("role", list(ROLES)).agg(F.first("p")).withColumn("block", F.col("chrom").cast("string"))
    a, o, x, b, c = (F.col(r) for r in ROLES)

    def estimate(num: Column, den: Column, name: str) -> DataFrame:
        sums = fstats.block_sums(rows.select("unit", "block", num.alias("num"), den.alias("den")), ["unit"])
        return fstats.weighted_jackknife(sums, ["unit"]).select("unit", *[F.col(k).alias(f"{name}_{k}") for k in ("estimate", "se", "z", "n_sites")])

    num, den = fstats.panel_d_terms(x, b, c, o)
    return estimate((a - o) * (x - c), (a - o) * (b - c), "ratio").join(estimate(num, den, "d"), "unit", "outer")


def ancestry_cline(callsets: dict[str, DataFrame], units: list[dict]) -> DataFrame:
    """unit, kind, group and the statistics of each set of calls; a set called ``gl`` is read by
    its likelihoods."""
    spark = next(iter(callsets.values())).sparkSession
    out = spark.createDataFrame([(u["unit"], u["kind"], u["group"]) for u in units], "unit string, kind string, group string")
    for name, calls in callsets.items():
        got = unit_statistics(unit_frequencies(calls, units, name == "gl"))
        out = out.join(got.select("unit", *[F.col(c).alias(f"{c}_{name}") for c in got.columns if c != "unit"]), "unit", "left")
    return out


def local_contrasts(calls: DataFrame, targets: dict[str, list[str]], roles: dict[str, list[str]], unsampled: list[str] = (), likelihoods: bool = True) -> DataFrame:
    """A row for each group against references without its members; groups without samples are
    there with null statistics."""
    units = [unit(g, members, roles) for g, members in targets.items()]
    rows = [(u["unit"], "computed", len(u["roles"]["X"]), ";".join(u["roles"]["X"]), ";".join(u["roles"]["B"])) for u in units]
    rows += [(g, "no genotypes", 0, "", "") for g in unsampled]
    top = calls.sparkSession.createDataFrame(rows, "unit string, status string, n_genomes bigint, genomes string, reference string")
    return top.join(unit_statistics(unit_frequencies(calls, units, likelihoods)), "unit", "left")


def reference_rotation(freqs: DataFrame, targets: list, a: list, b: list, c: list, o: list, baseline: tuple = ()) -> DataFrame:
    """f4-ratio of every target under every choice of the references A, B, C and O, in one pass
    over the sites: a site is one row of frequencies, its terms one array.  Each estimate uses
    the sites that its five populations have."""
    pops = list(dict.fromkeys([*targets, *a, *b, *c, *o]))
    # Unlike ``wide``, a site stays that some populations lack.
    rows = freqs.filter(F.col("population").isin(pops)).groupBy(*SITE).pivot("population", pops).agg(F.first("p"))
    p = {x: F.col(f"`{x}`") for x in pops}
    each = [(t, *q) for t in targets for q in product(a, b, c, o) if len({t, *q}) == 5]
    terms = F.array(*[F.struct(F.lit(i).alias("i"), ((p[a_] - p[o_]) * (p[t] - p[c_])).alias("num"), ((p[a_] - p[o_]) * (p[b_] - p[c_])).alias("den")) for i, (t, a_, b_, c_, o_) in enumerate(each)])
    sums = fstats.block_sums(rows.select(F.col("chrom").cast("string").alias("block"), F.inline(terms)), ["i"])
    names = freqs.sparkSession.createDataFrame([(i, *map(str, q), q[1:] == tuple(baseline)) for i, q in enumerate(each)], "i int, target string, a string, b string, c string, o string, baseline boolean")
    return names.join(fstats.weighted_jackknife(sums, ["i"]), "i", "left").drop("i")


def paired_contrasts(freqs: DataFrame, pairs: list[tuple], a, o, b, c) -> list[dict]:  # noqa: ANN001
    """Differences of the f4-ratios of pairs of targets, each pair on its common sites."""
    out = []
    for x, y in pairs:
        r = fstats.paired_difference(freqs, a, o, x, y, b, c, weighted=True).first()
        out.append({"x": x, "y": y} | r.asDict())
    return out


def heterozygosity(calls: DataFrame, spans: DataFrame, filtered: DataFrame | None = None) -> DataFrame:
    """sample_id, shares of missing calls, and heterozygous sites per kb of the spans
    (``first``, ``last``) that the panel was read from."""
    sites = calls.select(*SITE).distinct().agg(F.count(F.lit(1)).alias("sites"))
    width = spans.agg(F.sum(F.greatest(F.col("last") - F.col("first"), F.lit(0))).alias("bp"))
    known = calls.groupBy("sample_id").agg(F.count("n_alt").alias("n"), F.sum((F.col("n_alt") == 1).cast("bigint")).alias("het"))
    out = known.join(F.broadcast(sites)).join(F.broadcast(width))
    kb = F.when((F.col("n") > 0) & (F.col("bp") > 0), F.col("het") / F.col("n") * F.col("sites") / F.col("bp") * 1000)
    cols = ["sample_id", (1 - F.col("n") / F.col("sites")).alias("missing"), kb.alias("het_per_kb")]
    if filtered is not None:
        out = out.join(filtered.groupBy("sample_id").agg(F.count("n_alt").alias("m")), "sample_id", "left")
        cols.append((1 - F.coalesce("m", F.lit(0)) / F.col("sites")).alias("missing_filtered"))
    return out.select(*cols)


def mix_sensitivity(rows: DataFrame, panels: DataFrame, top: int = 5, gap: float = 5.0, least_share: float = 0.9) -> DataFrame:
    """Samples known to be mixed against each dog panel, beside all dogs but themselves: one that
    a single breed explains tells that names or threshold are at fault.  ``rows`` has the kind
    of each sample's group, ``panels`` the populations."""
    n = rows.select(*SITE).distinct().count()
    mixed = rows.filter("kind = 'mixed' and n_alt is not null").select(*SITE, "sample_id", "n_alt")
    own = mixture.panel_likelihoods(mixed, population.laplace(panels)).filter(F.col("n_loci") >= least_share * n)
    pool = rows.filter("kind != 'wild'").groupBy(*SITE).agg(F.count("n_alt").alias("m"), F.sum("n_alt").alias("alt"))
    without = mixed.join(pool, SITE).filter("m > 1").withColumn("p", (F.col("alt") - F.col("n_alt") + 1) / (2 * (F.col("m") - 1) + 2))
    any_ = without.groupBy("sample_id").agg(F.count(F.lit(1)).alias("n_loci"), F.sum(mixture.log_pmf(F.col("n_alt"), F.col("p"))).alias("loglik"))
    return mixture.beside_pool(own, any_, top, gap)


