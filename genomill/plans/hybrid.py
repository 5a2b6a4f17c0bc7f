"""Mixture stages of named query samples on a bridge panel, read from files.

A bridge VCF has the loci (and genotypes) of the queries; JSON panels have the genotypes of the
reference samples; calls tables have allele counts of each query.  Panels are groups of
reference samples, told by their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.strings import VILLAGE_CODES, canonical_contig, group_kind, group_name
from ..model import SITE
from ..operators import mixture, population
from ..sources import panels, vcf
from .executor import Context

#: Loci below which a panel is refused (fixed values).
LEAST_SHARED, LEAST_INFORMATIVE = 20, 10
#: Names of panels (fixed values): regions of village codes, groups of gray and eastern wolves.
VILLAGE_REGIONS = {"PER": "Peru", "BAN": "Bangladesh"}
GRAY, EASTERN = ("Wolf", "AlaskanWolf"), ("AlgonquinWolf", "QuebecWolf")
ANY_DOG, COYOTE, GRAY_WOLF, EASTERN_WOLF = "(any dog)", "(coyote)", "(gray wolf)", "(eastern wolf)"
#: Columns of the published bridge that repeat reference samples (fixed values).
BRIDGE_REFERENCES = ("AlaskanWolf", "AlgonquinWolf13467", "AlgonquinWolf13470", "Coyote01", "Coyote02", "GoldenJackal01")
#: Weight of the pooled prior in shrunk frequencies (fixed value).
SHRINK = 6.0


def _enough(rows: DataFrame, least: int, what: str) -> int:
    n = rows.count()
    if n < least:
        raise ValueError(f"{n} loci {what}; {least} are needed")
    return n


def queried(ctx: Context, cfg: dict, loci: DataFrame) -> DataFrame:
    """Calls of the query samples at ``loci``, made anew from depths; each sample's table has to
    cover them all."""
    n, frames = loci.count(), []
    for s in cfg["query_samples"]:
        own = panels.allele_counts(ctx.spark, ctx.path(f"{cfg['calls_dir'].rstrip('/')}/{s}_calls.csv"), None, cfg["min_depth"]).join(loci, SITE, "left_semi")
        if (have := own.select(*SITE).distinct().count()) != n:
            raise ValueError(f"{s}: {have} of {n} loci in its calls")
        frames.append(own.withColumn("sample_id", F.lit(s)))
    if not frames:
        raise ValueError("no query samples")
    return reduce(DataFrame.unionByName, frames)


def two_source(ctx: Context, cfg: dict) -> tuple[DataFrame, DataFrame]:
    """(calls, mean frequencies of the populations coyote and dog) at the loci that bridge and
    reference share."""
    wgs = list(cfg["wgs_samples"])
    coyote = list(cfg["coyote_samples"]) or [s for s in wgs if "coyote" in s.lower()]
    if not wgs or not coyote:
        raise ValueError("wgs_samples, with coyotes among them, have to be named")
    panel = panels.json_panel(ctx.spark, ctx.path(cfg["reference_genotypes"]), wgs)
    _enough(panel.select(*SITE).distinct(), LEAST_SHARED, "in the reference")
    loci = vcf.bridge_sites(ctx.spark, ctx.path(cfg["bridge_vcf"])).select(*SITE).join(panel.select(*SITE).distinct(), SITE, "left_semi")
    _enough(loci, LEAST_SHARED, "shared by bridge and reference")
    label = F.when(F.col("sample_id").isin(coyote), "coyote").otherwise("dog")
    freqs = panel.join(loci, SITE, "left_semi").groupBy(*SITE, label.alias("population")).agg((F.avg("n_alt") / 2).alias("p"))
    return queried(ctx, cfg, loci), freqs


def grouped(ctx: Context, path: str) -> DataFrame:
    """Reference calls with the group of each sample and its kind."""
    rows = panels.json_panel(ctx.spark, ctx.path(path)).withColumn("group", group_name(F.col("sample_id")))
    return rows.withColumn("kind", group_kind(F.col("group")))


def dog_panels(rows: DataFrame, least: int) -> DataFrame:
    """chrom, pos, sample_id, n_alt, population of the dog panels with ``least`` samples or more:
    breeds, all village dogs, and village dogs of a region known by a code."""
    region = F.create_map(*[F.lit(x) for c in VILLAGE_CODES for x in (c, f"VillageDog({VILLAGE_REGIONS[c]}, inferred)")])
    labels = F.array(F.when(F.col("kind") == "breed", F.col("group")), F.when(F.col("kind") == "village", F.lit("VillageDog(all regions)")), region[F.col("group")])
    each = rows.select(*SITE, "sample_id", "n_alt", F.explode(labels).alias("population")).filter("population is not null")
    big = each.groupBy("population").agg(F.count_distinct("sample_id").alias("n")).filter(F.col("n") >= least)
    return each.join(F.broadcast(big.select("population")), "population", "left_semi")


def named(rows: DataFrame, name: str, condition) -> DataFrame:  # noqa: ANN001
    return rows.filter(condition).select(*SITE, "sample_id", "n_alt", F.lit(name).alias("population"))


def _is_coyote():  # noqa: ANN202
    return (F.col("kind") == "wild") & F.lower("group").contains("coyote")


def breed_scores(ctx: Context, cfg: dict) -> tuple[DataFrame, DataFrame]:
    """(best panels of each query, leave-one-out of the panels' own samples)."""
    rows = grouped(ctx, cfg["wgs_genotypes"])
    if cfg["locus_filter_json"]:
        keep = panels.json_loci(ctx.spark, ctx.path(cfg["locus_filter_json"]))
        rows = rows.join(keep, SITE, "left_semi")
    rows = rows.persist()
    n = _enough(rows.select(*SITE).distinct(), LEAST_SHARED, "for breed assignment")
    if named(rows, COYOTE, _is_coyote()).isEmpty():
        raise ValueError("no coyote group for the mixture")
    dogs = dog_panels(rows, cfg["min_group"])
    loci = vcf.bridge_sites(ctx.spark, ctx.path(cfg["bridge_vcf"])).select(*SITE).join(rows.select(*SITE).distinct(), SITE, "left_semi")
    fractions = panels.source_fractions(ctx.spark, ctx.path(cfg["dog_fractions"])).filter("fraction is not null")
    known = sorted(r["sample_id"] for r in fractions.select("sample_id").distinct().collect())
    asked = [s for s in (cfg["query_samples"] or known) if s in known]
    calls = queried(ctx, cfg | {"query_samples": asked}, loci)
    freqs = population.laplace(dogs.unionByName(named(rows, ANY_DOG, F.col("kind") != "wild")).unionByName(named(rows, COYOTE, _is_coyote())))
    shares = fractions.select("sample_id", (1 - F.col("fraction")).alias("wild"))
    scores = mixture.blended_likelihoods(calls, mixture.blended(freqs, {COYOTE: "wild"}, shares)).filter(F.col("panel") != COYOTE)
    out = mixture.beside_pool(scores.filter(F.col("panel") != ANY_DOG), scores.filter(F.col("panel") == ANY_DOG), cfg["top_k"], cfg["single_breed_gap"])
    return out, mixture.leave_one_out(dogs, n, min_group=cfg["min_group"])


def western(cfg: dict) -> set[str]:
    ids = set(cfg["western_ids"])
    if cfg["western_id_prefix"] and len(cfg["western_id_range"]) == 2:
        first, last = cfg["western_id_range"]
        ids |= {f"{cfg['western_id_prefix']}{i:0{max(3, len(str(last)))}d}" for i in range(first, last + 1)}
    return ids


def three_way(ctx: Context, cfg: dict) -> dict[str, DataFrame]:
    """Shares of wolf and dog against coyote for each sample of the bridge and for each region's
    cohort, with bootstrap intervals, and dog panels for samples with enough dog."""
    rows = grouped(ctx, cfg["wgs_genotypes"]).persist()
    groups = {COYOTE: _is_coyote(), GRAY_WOLF: F.col("group").isin(*GRAY), EASTERN_WOLF: F.col("group").isin(*EASTERN), ANY_DOG: F.col("kind") != "wild"}
    pooled = reduce(DataFrame.unionByName, [named(rows, name, c) for name, c in groups.items()])
    there = {r["population"] for r in pooled.select("population").distinct().collect()}
    if missing := {COYOTE, GRAY_WOLF, ANY_DOG} - there:
        raise ValueError(f"no reference samples of {', '.join(sorted(missing))}")
    raw = population.laplace(pooled).filter("p is not null")
    prior = raw.groupBy(*SITE).agg(F.avg("p").alias("prior"))
    wide = raw.groupBy(*SITE).pivot("population", list(groups)).agg(F.first("p"))
    gap = [F.abs(F.col(f"`{x}`") - F.col(f"`{COYOTE}`")) >= cfg["min_panel_separation"] for x in (GRAY_WOLF, ANY_DOG, EASTERN_WOLF)]
    wanted = F.lit(False)
    for g in gap:
        wanted = wanted | F.coalesce(g, F.lit(False))
    loci = wide.filter(wanted & F.col(f"`{COYOTE}`").isNotNull() & F.col(f"`{GRAY_WOLF}`").isNotNull() & F.col(f"`{ANY_DOG}`").isNotNull()).select(*SITE)
    _enough(loci, LEAST_INFORMATIVE, "are informative")
    panel = pooled.unionByName(dog_panels(rows, cfg["min_group"])).join(loci, SITE, "left_semi")
    counted = panel.groupBy(*SITE, "population").agg(F.count("n_alt").alias("n"), F.sum("n_alt").alias("alt")).filter("n > 0").join(prior, SITE)
    freqs = counted.select(*SITE, "population", ((F.col("alt") + SHRINK * F.col("prior")) / (2 * F.col("n") + SHRINK)).alias("p")).persist()

    wgs = [r["sample_id"] for r in rows.select("sample_id").distinct().collect()]
    bridge = vcf.calls(ctx.spark, ctx.path(cfg["bridge_vcf"]), only_snps=False).withColumn("chrom", F.concat(F.lit("chr"), canonical_contig(F.col("chrom"))))
    drop = wgs + list(cfg["exclude_samples"]) + list(BRIDGE_REFERENCES if cfg["exclude_bridge_wgs_bug_ids"] else ())
    calls = bridge.filter(~F.col("sample_id").isin(*drop)).select(*SITE, "sample_id", "n_alt").join(loci, SITE, "left_semi").persist()
    if calls.isEmpty():
        raise ValueError("no query samples are left")
    region = F.when(F.col("sample_id").isin(*western(cfg)) if western(cfg) else F.lit(False), "western").otherwise("eastern")
    grid = lambda alleles, two: mixture.blend_grid(alleles, freqs, COYOTE, GRAY_WOLF if two else ANY_DOG, ANY_DOG if two else None, reps=cfg["bootstrap_n"], seed=cfg["seed"])
    shares = grid(mixture.alleles(calls), True).withColumn("region", region).persist()
    cohort = mixture.alleles(calls.withColumn("sample_id", region))
    # What the eastern cohort's dog share would be without wolves, and its wolf share without dogs.
    east = cohort.filter("sample_id = 'eastern'")
    ways = [mixture.blend_grid(east, freqs, COYOTE, x, reps=0).select(F.lit(x).alias("source"), "share_one", "loglik") for x in (ANY_DOG, GRAY_WOLF)]
    with_dog = shares.filter(F.col("share_two") >= cfg["min_dog_fraction_for_breed"]).select("sample_id", (1 - F.col("share_one") - F.col("share_two")).alias("coyote"), F.col("share_one").alias("wolf"))
    dogs = freqs.filter(~F.col("population").isin(EASTERN_WOLF))
    scores = mixture.blended_likelihoods(calls, mixture.blended(dogs, {COYOTE: "coyote", GRAY_WOLF: "wolf"}, with_dog)).filter(~F.col("panel").isin(COYOTE, GRAY_WOLF))
    breeds = mixture.beside_pool(scores.filter(F.col("panel") != ANY_DOG), scores.filter(F.col("panel") == ANY_DOG), cfg["top_k"], 5.0)
    summary = shares.groupBy("region").agg(F.count(F.lit(1)).alias("n"), *[f(c).alias(f"{n}_{m}") for c, n in (("share_one", "wolf"), ("share_two", "dog")) for f, m in ((F.avg, "mean"), (F.min, "min"), (F.max, "max"))])
    return {"mixture": shares, "cohorts": grid(cohort, True).withColumnRenamed("sample_id", "region"), "two_way": ways[0].unionByName(ways[1]), "mixture_breeds": breeds, "region_summary": summary}
