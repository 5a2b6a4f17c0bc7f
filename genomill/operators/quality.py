"""Quality gates, filters and thinning."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.strings import is_autosome
from ..model import SITE, ranked
from . import dense


def sample_metrics(calls: DataFrame, samples: DataFrame, n_sites: int | F.Column, least: float = 0.5) -> DataFrame:
    """Call rate, heterozygosity and reasons of failure of each sample of the sheet or the
    calls; a sample that stands only in one of them is reported too."""
    got = calls.groupBy("sample_id").agg(F.count("n_alt").alias("n_called"), F.sum((F.col("n_alt") == 1).cast("int")).cast("bigint").alias("n_het"))
    both = samples.select("sample_id", F.lit(True).alias("known")).join(got, "sample_id", "full_outer")
    n = n_sites if not isinstance(n_sites, int) else F.lit(n_sites)
    rate = F.coalesce("n_called", F.lit(0)) / n
    reasons = F.concat_ws(";", F.when(F.col("known").isNull(), "missing metadata"), F.when(rate < least, "call rate"))
    het = F.when(F.col("n_called") > 0, F.col("n_het") / F.col("n_called")).otherwise(0.0)
    return both.select("sample_id", F.coalesce("n_called", F.lit(0)).alias("n_called"), rate.alias("call_rate"), het.alias("het"), reasons.alias("reasons"))


def site_metrics(calls: DataFrame, n_samples: int | F.Column, least_rate: float = 0.8, least_maf: float = 0.0) -> DataFrame:
    """Call rate and minor allele frequency over full calls of each site, and why it fails."""
    n = n_samples if not isinstance(n_samples, int) else F.lit(n_samples)
    each = calls.groupBy(*SITE).agg(F.count("n_alt").alias("n_called"), F.coalesce(F.sum("n_alt"), F.lit(0)).alias("alt"))
    p = F.when(F.col("n_called") > 0, F.col("alt") / (2 * F.col("n_called"))).otherwise(0.0)
    out = each.withColumns({"call_rate": F.col("n_called") / n, "maf": F.least(p, 1 - p)})
    reasons = F.concat_ws(";", F.when(F.col("call_rate") < least_rate, "call rate"), F.when(F.col("maf") < least_maf, "maf"))
    return out.select(*SITE, "n_called", "call_rate", "maf", reasons.alias("reasons"))


def exclusions(samples: DataFrame, sites: DataFrame) -> DataFrame:
    """The ledger of what failed: kind, id, reasons."""
    one = samples.filter("reasons != ''").select(F.lit("sample").alias("kind"), F.col("sample_id").cast("string").alias("id"), "reasons")
    two = sites.filter("reasons != ''").select(F.lit("site").alias("kind"), F.concat_ws(":", "chrom", "pos").alias("id"), "reasons")
    return one.unionByName(two)


def gate(calls: DataFrame, samples: DataFrame, sites_of) -> DataFrame:  # noqa: ANN001
    """Calls of the samples that pass, then of the sites that pass among them."""
    kept = calls.join(samples.filter("reasons = ''").select("sample_id"), "sample_id", "left_semi")
    return kept.join(sites_of(kept).filter("reasons = ''").select(*SITE), SITE, "left_semi")


def segregating(calls: DataFrame) -> DataFrame:
    """Sites where both alleles are seen."""
    seen = calls.groupBy(*SITE).agg(F.sum(F.col("n_alt")).alias("alt"), F.sum(2 - F.col("n_alt")).alias("ref"))
    return seen.filter("alt > 0 and ref > 0").select(*SITE)


def site_filter(calls: DataFrame, n_samples: int, min_maf: float = 0.0, max_missing: float = 1.0) -> DataFrame:
    """Calls of the sites within the limits of missingness (if below 1) and MAF."""
    kept = site_metrics(calls, n_samples, 1 - max_missing if max_missing < 1 else 0.0, min_maf).filter("reasons = ''")
    return calls.join(kept.select(*SITE), SITE, "left_semi")


def autosomal(frame: DataFrame) -> DataFrame:
    return frame.filter(is_autosome(F.col("chrom").cast("string")))


def thin(sites: DataFrame, bin_bp: int = 2000) -> DataFrame:
    """The first site of each bin of positions."""
    w = Window.partitionBy("chrom", F.floor(F.col("pos") / bin_bp)).orderBy("pos")
    return sites.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def panel_sites(calls: DataFrame, n_samples: int, call_rate: float = 0.9, min_maf: float = 0.05, bin_bp: int = 2000) -> DataFrame:
    """Sites that enough samples have called and that are not rare, one of each bin."""
    n, alt = F.count("n_alt"), F.coalesce(F.sum("n_alt"), F.lit(0))
    share = alt / F.greatest(2 * n, F.lit(1))
    kept = calls.groupBy(*SITE).agg((n / n_samples).alias("rate"), F.least(share, 1 - share).alias("maf"))
    return thin(kept.filter((F.col("rate") >= call_rate) & (F.col("maf") >= min_maf)).select(*SITE), bin_bp)


def cohort_table(calls: DataFrame) -> DataFrame:
    """Samples and calls of each population.  Counted per sample first: one group of samples may
    hold most calls."""
    per = calls.groupBy("population", "sample_id").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("population").agg(F.count(F.lit(1)).alias("n_samples"), F.sum("n").alias("n_calls"))


def heterozygosity_per_kb(calls: DataFrame) -> DataFrame:
    """Heterozygous calls of each sample per kb of the contigs' covered spans."""
    genome = calls.groupBy("chrom").agg((F.max("pos") - F.min("pos")).alias("b")).agg(F.sum("b").alias("genome"))
    per = calls.groupBy("sample_id").agg(F.count("n_alt").alias("n_called"), F.sum((F.col("n_alt") == 1).cast("int")).alias("h")).join(F.broadcast(genome))
    return per.select("sample_id", "n_called", (F.col("h") / F.col("genome") * 1000).alias("het_per_kb"))


def marker_panel(sites: DataFrame, target: int) -> DataFrame:
    """Every ceil(n / target)-th autosomal site in order."""
    stride = F.ceil(F.col("_total") / F.lit(target))
    return ranked(autosomal(sites)).filter(F.col("_rank") % stride == 0).select(*sites.columns)


def concordance(calls: DataFrame, least_sites: int = 100, threshold: float = 0.98) -> DataFrame:
    """Pairs of samples whose calls agree at ``threshold`` of the sites both have called.
    Sites are vectors over samples; the result has at most samples**2 rows."""
    calls = calls.persist()
    kind = dict(calls.dtypes)["sample_id"]
    try:
        ids = dense.sample_ids(calls)
        got = dense.pair_sums(calls, None, ids, dense.agreements).get("")
    finally:
        calls.unpersist()
    rows = [(a, b, int(got[0, i, j]), float(got[1, i, j] / got[0, i, j])) for i, a in enumerate(ids) for j, b in enumerate(ids) if i < j and got[0, i, j] >= max(1, least_sites) and got[1, i, j] / got[0, i, j] >= threshold]
    return calls.sparkSession.createDataFrame(rows, f"s1 {kind}, s2 {kind}, n_sites bigint, concordance double")


def pseudohaploid(calls: DataFrame, seed: int = 0) -> DataFrame:
    """One allele of each call, drawn by a hash of the seed, site and sample, twice."""
    pick = F.pmod(F.xxhash64(F.lit(seed), *SITE, "sample_id"), F.lit(2)) == 0
    drawn = F.when(F.col("n_alt").isNotNull(), F.when(pick, F.col("a0")).otherwise(F.col("a1")))
    return calls.withColumn("_d", drawn).withColumns({"a0": F.col("_d"), "a1": F.col("_d"), "n_alt": 2 * F.col("_d")}).drop("_d")


def site_subsample(sites: DataFrame, n: int, seed: int = 0) -> DataFrame:
    return sites.orderBy(F.xxhash64(F.lit(seed), *SITE), *SITE).limit(n)
