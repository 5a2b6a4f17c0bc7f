"""VCF text as DataFrames.  Lines are split by Spark; a compressed file is one partition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.strings import AUTOSOMES, canonical_contig, contig_number, genotype, genotype_where, likelihoods

FIXED = ("CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT")
#: A panel of fewer loci is refused (fixed value).
LEAST_LOCI = 100


def header(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """(meta lines, sample names)."""
    lines = [r["value"] for r in spark.read.text(path).filter(F.col("value").startswith("#")).collect()]
    names = next((x for x in lines if x.startswith("#CHROM")), None)
    if names is None:
        raise ValueError(f"{path}: no #CHROM line")
    return [x for x in lines if x.startswith("##")], names.split("\t")[len(FIXED) :]


def reference_build(meta: list[str]) -> str:
    """What ##reference or ##assembly says, or an empty string."""
    for line in meta:
        for key in ("##reference=", "##assembly="):
            if line.lower().startswith(key):
                return line[len(key) :].strip()
    return ""


def records(spark: SparkSession, path: str) -> DataFrame:
    """chrom, pos, ref, alt, format and the sample fields as an array."""
    parts = F.split("value", "\t")
    rows = spark.read.text(path).filter(~F.col("value").startswith("#") & (F.length("value") > 0)).select(parts.alias("f"))
    return rows.select(
        F.col("f")[0].alias("chrom"), F.col("f")[1].cast("bigint").alias("pos"), F.upper(F.col("f")[3]).alias("ref"), F.upper(F.col("f")[4]).alias("alt"),
        F.col("f")[6].alias("filter"), F.col("f")[8].alias("format"), F.slice("f", len(FIXED) + 1, F.greatest(F.size("f") - len(FIXED), F.lit(0))).alias("fields"),
    )


def biallelic(rows: DataFrame) -> DataFrame:
    """Single-nucleotide sites with one alternative."""
    return rows.filter((F.length("ref") == 1) & (F.length("alt") == 1) & ~F.col("alt").contains(","))


def calls(spark: SparkSession, path: str, only_snps: bool = True, min_gq: float = 0, min_dp: float = 0) -> DataFrame:
    """Long calls: chrom, pos, site_ord, ref, alt, sample_id, sample_ord, a0, a1, n_alt, pl."""
    _, samples = header(spark, path)
    rows = records(spark, path)
    rows = biallelic(rows) if only_snps else rows
    each = rows.withColumn("site_ord", F.monotonically_increasing_id()).select("chrom", "pos", "site_ord", "ref", "alt", "format", F.posexplode("fields").alias("sample_ord", "field"))
    names = F.array(*[F.lit(s) for s in samples])
    gt = F.split("field", ":")[0]
    allele = lambda i: F.when(gt.rlike("^[01.][/|][01.]$") & (F.substring(gt, 2 * i + 1, 1) != "."), F.substring(gt, 2 * i + 1, 1).cast("int"))
    ok: Column = genotype_where(F.col("field"), F.col("format"), min_gq, min_dp) if min_gq or min_dp else genotype(F.col("field"))
    at = F.array_position(F.split("format", ":"), "PL").cast("int")
    pl = F.when(at > 0, likelihoods(F.try_element_at(F.split("field", ":"), at)))
    return each.select("chrom", "pos", "site_ord", "ref", "alt", F.element_at(names, F.col("sample_ord") + 1).alias("sample_id"), "sample_ord", allele(0).alias("a0"), allele(1).alias("a1"), ok.alias("n_alt"), pl.alias("pl"))


def bridge_sites(spark: SparkSession, path: str, least: int = LEAST_LOCI) -> DataFrame:
    """chrom (with the chr prefix), pos, ref, alt; an error if there are few."""
    rows = records(spark, path).select(F.concat(F.lit("chr"), canonical_contig(F.col("chrom"))).alias("chrom"), "pos", "ref", "alt")
    n = rows.count()
    if n < least:
        raise ValueError(f"{path}: {n} loci; {least} are needed")
    return rows


def window_panel(spark: SparkSession, path: str, samples: list[str], windows: int, window_bytes: int = 3_500_000, max_bytes: int = 2_500_000_000, index: str = "") -> tuple[DataFrame, DataFrame]:
    """(calls, spans) of evenly spaced windows of an indexed file: single-nucleotide sites that
    passed and vary among the samples, with genotype quality and likelihoods, and each window's
    first and last record.  One task a window."""
    from .tabix import IndexedVcf, contig_lengths, fetch, inflate

    spark.dataSource.register(IndexedVcf)
    top = [x for x in inflate(fetch(path, 0, 8 << 20)).decode("utf-8", "replace").split("\n") if x.startswith("#")]
    names = next((x for x in top if x.startswith("#CHROM")), "").split("\t")[len(FIXED) :]
    if missing := [s for s in samples if s not in names]:
        raise ValueError(f"{path}: no samples {', '.join(missing)}")
    lengths = {c: n for c, n in contig_lengths(top).items() if canonical_contig_number(c) is not None}
    options = {"path": path, "windows": str(windows), "window_bytes": str(window_bytes), "max_bytes": str(max_bytes), "lengths": ",".join(f"{c}:{n}" for c, n in lengths.items())}
    rows = spark.read.format("indexed_vcf").options(**options, **({"index": index} if index else {})).load()
    f = F.split("value", "\t")
    passed = (f[6] == "PASS") & (F.length(f[3]) == 1) & (F.length(f[4]) == 1)
    columns = F.array(*[F.struct(F.lit(i).alias("sample_ord"), F.lit(s).alias("sample_id"), f[len(FIXED) + names.index(s)].alias("field")) for i, s in enumerate(samples)])
    each = rows.filter(passed).select("window", "chrom", "pos", f[3].alias("ref"), f[4].alias("alt"), f[8].alias("format"), F.inline(columns))
    value = lambda key: F.try_element_at(F.split("field", ":"), F.array_position(F.split("format", ":"), key).cast("int"))
    gq = F.coalesce(F.least(value("GQ").try_cast("int"), F.lit(99)), F.lit(0))
    n = genotype_where(F.col("field"), F.col("format"))
    calls_ = each.select("window", "chrom", "pos", "ref", "alt", "sample_ord", "sample_id", n.alias("n_alt"), gq.alias("gq"), likelihoods(F.coalesce(value("PL"), F.lit(""))).alias("pl"))
    varying = calls_.groupBy("chrom", "pos").agg(F.max("n_alt").alias("top")).filter("top > 0").select("chrom", "pos")
    spans = rows.groupBy("window", "chrom").agg(F.min("pos").alias("first"), F.max("pos").alias("last"))
    return calls_.join(varying, ["chrom", "pos"], "left_semi"), spans


def canonical_contig_number(name: str, most: int = AUTOSOMES) -> int | None:
    """The number of an autosome by its name."""
    bare = name.lower().removeprefix("chr")
    return int(bare) if bare.isdigit() and 1 <= int(bare) <= most else None


def lines(frame: DataFrame) -> DataFrame:
    """VCF records of long calls, as (contig number, contig, pos, value), ordered fields."""
    allele = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("."))
    gt = F.concat(allele("a0"), F.lit("/"), allele("a1"))
    sites = frame.groupBy("chrom", "pos", "ref", "alt").agg(F.sort_array(F.collect_list(F.struct("sample_ord", gt.alias("gt")))).alias("g"))
    value = F.concat_ws("\t", "chrom", F.col("pos").cast("string"), F.lit("."), "ref", "alt", F.lit("."), F.lit("PASS"), F.lit("."), F.lit("GT"), F.array_join(F.transform("g", lambda x: x["gt"]), "\t"))
    return sites.select(contig_number(F.col("chrom").cast("string")).alias("number"), "chrom", "pos", value.alias("value"))


def write(frame: DataFrame, path: str, samples: list[str], compression: str = "none") -> None:
    """Minimal VCF 4.2 in a folder of parts that are in order: the first has the header."""
    spark = frame.sparkSession
    top = ["##fileformat=VCFv4.2", '##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">', "#" + "\t".join([*FIXED, *samples])]
    head = spark.createDataFrame([(-1, "", i, x) for i, x in enumerate(top)], "number int, chrom string, pos bigint, value string")
    rows = lines(frame).withColumn("number", F.coalesce("number", F.lit(1 << 30)))
    head.unionByName(rows).sort("number", "chrom", "pos").select("value").write.mode("overwrite").option("compression", compression).text(path)
