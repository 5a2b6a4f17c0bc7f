"""Harmonising the sites of several studies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.strings import canonical_contig, complement


def normalized(sites: DataFrame) -> DataFrame:
    return sites.withColumns({"chrom": canonical_contig(F.col("chrom").cast("string")), "ref": F.upper("ref"), "alt": F.upper("alt")})


def orientation(ref0: Column, alt0: Column, ref: Column, alt: Column, allow_complement: bool = True) -> Column:
    """same, swap, complement, complement_swap or null; a site whose alleles are each other's
    complement is never complemented."""
    out = F.when((ref == ref0) & (alt == alt0), "same").when((ref == alt0) & (alt == ref0), "swap")
    if allow_complement:
        plain = complement(ref) != alt
        out = out.when(plain & (complement(ref) == ref0) & (complement(alt) == alt0), "complement")
        out = out.when(plain & (complement(ref) == alt0) & (complement(alt) == ref0), "complement_swap")
    return out


def shared_sites(studies: list[DataFrame], allow_complement: bool = True) -> DataFrame:
    """Sites of the first study that every study has in an orientable form: chrom, pos, ref,
    alt and ``o1, o2, ...``.  A chain of joins on the site."""
    first = studies[0].select("chrom", "pos", "ref", "alt")
    for i, other in enumerate(studies[1:], 1):
        own = other.select("chrom", "pos", F.col("ref").alias("_r"), F.col("alt").alias("_a"))
        both = first.join(own, ["chrom", "pos"]).withColumn(f"o{i}", orientation(F.col("ref"), F.col("alt"), F.col("_r"), F.col("_a"), allow_complement))
        first = both.filter(F.col(f"o{i}").isNotNull()).drop("_r", "_a")
    return first


def orientation_report(first: DataFrame, other: DataFrame, allow_complement: bool = True) -> DataFrame:
    """Number of shared coordinates by orientation; incompatible ones are counted too."""
    own = other.select("chrom", "pos", F.col("ref").alias("_r"), F.col("alt").alias("_a"))
    both = first.join(own, ["chrom", "pos"])
    o = F.coalesce(orientation(F.col("ref"), F.col("alt"), F.col("_r"), F.col("_a"), allow_complement), F.lit("incompatible"))
    return both.groupBy(o.alias("orientation")).agg(F.count(F.lit(1)).alias("n"))


def flipped(calls: DataFrame, orientation_column: str = "orientation") -> DataFrame:
    """Alleles of swapped sites exchanged; missing ones stay missing."""
    swap = F.col(orientation_column).endswith("swap")
    flip = lambda c: F.when(swap & F.col(c).isNotNull(), 1 - F.col(c)).otherwise(F.col(c))
    return calls.withColumns({"a0": flip("a0"), "a1": flip("a1")}).withColumn("n_alt", F.col("a0") + F.col("a1"))


def repeated_sites(sites: DataFrame) -> DataFrame:
    return sites.groupBy("chrom", "pos").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def sample_concordance(calls_samples: DataFrame, sheet: DataFrame) -> DataFrame:
    """Samples that stand only in the calls, or only in the sheet."""
    one = calls_samples.select("sample_id").distinct().join(sheet, "sample_id", "left_anti").select("sample_id", F.lit("calls only").alias("where"))
    return one.unionByName(sheet.select("sample_id").distinct().join(calls_samples, "sample_id", "left_anti").select("sample_id", F.lit("sheet only").alias("where")))


def shared_samples(studies: list[DataFrame]) -> DataFrame:
    """Samples of more than one study."""
    each = None
    for i, s in enumerate(studies):
        own = s.select("sample_id").distinct().withColumn("study", F.lit(i))
        each = own if each is None else each.unionByName(own)
    return each.groupBy("sample_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def batch_diagnostics(calls: DataFrame, batch: str, n_sites: int | Column) -> DataFrame:
    """Mean and least sample call rate and mean site call rate of each batch."""
    n = n_sites if not isinstance(n_sites, int) else F.lit(n_sites)
    per = calls.groupBy(batch, "sample_id").agg((F.count("n_alt") / n).alias("rate"))
    return per.groupBy(batch).agg(F.count(F.lit(1)).alias("n_samples"), F.avg("rate").alias("mean_rate"), F.min("rate").alias("min_rate"))
