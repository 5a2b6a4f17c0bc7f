"""The stages.  Each is a thin call of operators over the artifacts that it needs; external
programs (alignment, variant calling, maximum-likelihood trees) are given as commands."""

from __future__ import annotations

import shlex

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.strings import canonical_contig
from ..model import SITE, calls, counts
from ..operators import fstats, harmonize, matrix, mixture, population, quality, trees, windows
from ..sources import exports, panels, vcf
from . import hybrid
from .config import Param
from .executor import STAGES, Context

GENOTYPES = ("analysis_genotypes", "genotypes")


def genotypes(ctx: Context) -> DataFrame:
    """Calls with the population of each sample; those made ready for analysis if there are."""
    g = ctx.get(*GENOTYPES)
    if "sample_sheet" in ctx.artifacts and "population" not in g.columns:
        return g.join(F.broadcast(ctx.get("sample_sheet").select("sample_id", "population")), "sample_id")
    return g


def pops(g: DataFrame, least: int = 1) -> list:
    rows = g.groupBy("population").agg(F.count_distinct("sample_id").alias("n")).filter(F.col("n") >= least).collect()
    return sorted(r["population"] for r in rows)


def samples_of(g: DataFrame) -> DataFrame:
    return g.select("sample_id").distinct()


@STAGES.register("ingest", makes=("sample_sheet", "callset"), params={"sample_sheet": Param(required=True), "callset": Param(required=True), "reference_build": Param("unknown"), "callable_sites": Param(0, least=0)})
def ingest(ctx, cfg):
    return {"sample_sheet": panels.sample_sheet(ctx.spark, ctx.path(cfg["sample_sheet"])), "callset": vcf.calls(ctx.spark, ctx.path(cfg["callset"]))}


@STAGES.register("sample_sheet", makes=("sample_sheet",), params={"path": Param(required=True)})
def sample_sheet(ctx, cfg):
    return {"sample_sheet": panels.sample_sheet(ctx.spark, ctx.path(cfg["path"]))}


@STAGES.register("reduced_panel", makes=("callset",), params={"path": Param(required=True), "positions": Param(required=True), "samples": Param(required=True), "max_bytes": Param(9_000_000_000, least=1, most=9_999_999_999), "min_genotype_quality": Param(0.0, least=0), "min_genotype_depth": Param(0, least=0)})
def reduced_panel(ctx, cfg):
    from ..functions.strings import genotype_where
    from ..sources.tabix import IndexedVcf

    ctx.spark.dataSource.register(IndexedVcf)
    rows = ctx.spark.read.format("indexed_vcf").options(path=cfg["path"], positions=",".join(cfg["positions"]), max_bytes=str(cfg["max_bytes"])).load()
    f = F.split("value", "\t")
    names = F.array(*[F.lit(s) for s in cfg["samples"]])
    each = rows.select("chrom", "pos", f[3].alias("ref"), f[4].alias("alt"), f[8].alias("format"), F.posexplode(F.slice(f, 10, len(cfg["samples"]))).alias("sample_ord", "field"))
    g = genotype_where(F.col("field"), F.col("format"), cfg["min_genotype_quality"], cfg["min_genotype_depth"])
    return {"callset": each.select("chrom", "pos", "ref", "alt", "sample_ord", F.element_at(names, F.col("sample_ord") + 1).alias("sample_id"), g.alias("n_alt"), (g > 1).cast("int").alias("a0"), (g > 0).cast("int").alias("a1"))}


def _command(*parts: object) -> str:
    return " ".join(shlex.quote(str(p)) for p in parts)


@STAGES.register("acquire_reads", takes=("sample_sheet",), makes=("raw_reads",), params={"archives": Param((), required=True), "output_dir": Param("reads"), "max_download_bytes": Param(9_000_000_000, least=1, most=9_999_999_999), "confirm_large_transfer": Param(False), "timeout_seconds": Param(120, least=1)})
def acquire_reads(ctx, cfg):
    from ..sources.reads import acquire

    archives = [a | {"fraction": a.get("downsample_fraction", a.get("fraction", 1.0))} for a in cfg["archives"]]
    if "sample_sheet" in ctx.artifacts:
        known = {r["sample_id"] for r in ctx.get("sample_sheet").select("sample_id").collect()}
        if strange := sorted({a["sample_id"] for a in archives} - known):
            raise ValueError(f"not in the sample sheet: {', '.join(strange)}")
    return {"raw_reads": acquire(ctx.spark, archives, ctx.path(cfg["output_dir"]), cfg["max_download_bytes"], cfg["confirm_large_transfer"], ctx.seed, cfg["timeout_seconds"])}


@STAGES.register("align", makes=("alignments",), params={"fastq_manifest": Param("fastq_manifest.csv"), "reference": Param("reference.fasta"), "threads": Param(4, least=1)})
def align(ctx, cfg):
    rows = panels.fastq_manifest(ctx.spark, ctx.path(cfg["fastq_manifest"])).collect()
    return {"alignments": [{"sample_id": r["sample_id"], "command": _command("bwa", "mem", "-t", cfg["threads"], *(["-p"] if r["layout"] == "interleaved" else []), cfg["reference"], r["fastq1"], *([r["fastq2"]] if r["layout"] == "paired" else []))} for r in rows]}


@STAGES.register("call_variants", needs=("alignments",), makes=("gvcfs",), params={"reference": Param("reference.fasta"), "backend": Param("gatk", choices=("gatk", "deepvariant")), "threads": Param(4, least=1)})
def call_variants(ctx, cfg):
    def command(sample: str) -> str:
        bam, vcf_, gvcf = f"{sample}.cram", f"{sample}.vcf.gz", f"{sample}.g.vcf.gz"
        if cfg["backend"] == "deepvariant":
            return _command("run_deepvariant", "--model_type=WGS", f"--ref={cfg['reference']}", f"--reads={bam}", f"--output_vcf={vcf_}", f"--output_gvcf={gvcf}", f"--num_shards={cfg['threads']}")
        return _command("gatk", "HaplotypeCaller", "-R", cfg["reference"], "-I", bam, "-O", gvcf, "-ERC", "GVCF", "--native-pair-hmm-threads", cfg["threads"])

    return {"gvcfs": [{"sample_id": a["sample_id"], "backend": cfg["backend"], "command": command(a["sample_id"])} for a in ctx.get("alignments")]}


@STAGES.register("joint_genotype", needs=("gvcfs",), makes=("joint_callset",), params={"reference": Param("reference.fasta"), "backend": Param("glnexus", choices=("glnexus", "gatk")), "threads": Param(4, least=1)})
def joint_genotype(ctx, cfg):
    files = [f"{g['sample_id']}.g.vcf.gz" for g in ctx.get("gvcfs")]
    if cfg["backend"] == "gatk":
        combine = _command("gatk", "CombineGVCFs", "-R", cfg["reference"], *[x for f in files for x in ("-V", f)], "-O", "cohort.g.vcf.gz")
        return {"joint_callset": [{"command": combine}, {"command": _command("gatk", "GenotypeGVCFs", "-R", cfg["reference"], "-V", "cohort.g.vcf.gz", "-O", "cohort.vcf.gz")}]}
    model = "DeepVariantWGS" if any(g.get("backend") == "deepvariant" for g in ctx.get("gvcfs")) else "gatk"
    return {"joint_callset": [{"command": _command("glnexus_cli", "--config", model, "--threads", cfg["threads"], *files) + " | bcftools view -Oz -o cohort.vcf.gz -"}]}


@STAGES.register("bcftools_call", needs=("alignments",), makes=("joint_calls",), params={"reference": Param("reference.fasta"), "threads": Param(4, least=1)})
def bcftools_call(ctx, cfg):
    pile = _command("bcftools", "mpileup", "--threads", cfg["threads"], "-a", "FORMAT/AD,FORMAT/DP", "-Ou", "-f", cfg["reference"], *[f"{a['sample_id']}.cram" for a in ctx.get("alignments")])
    return {"joint_calls": [{"command": f"{pile} | {_command('bcftools', 'call', '--threads', cfg['threads'], '-mv', '-Oz', '-o', 'joint.vcf.gz')}"}]}


@STAGES.register("harmonize", makes=("callset", "orientation_report"), params={"datasets": Param(required=True), "allow_strand_complement": Param(True)})
def harmonize_stage(ctx, cfg):
    frames = [vcf.calls(ctx.spark, ctx.path(p)) for p in cfg["datasets"]]
    shared = harmonize.shared_samples(frames)
    if shared.limit(1).count():
        raise ValueError("a sample stands in two datasets")
    sites = [harmonize.normalized(f.select("chrom", "pos", "ref", "alt").distinct()) for f in frames]
    for s in sites:
        if harmonize.repeated_sites(s).limit(1).count():
            raise ValueError("a coordinate stands twice in a dataset")
    first = harmonize.shared_sites(sites, cfg["allow_strand_complement"])
    out = None
    for i, f in enumerate(frames):
        own = f.withColumn("chrom", canonical_contig(F.col("chrom"))).drop("ref", "alt", "site_ord").join(first, SITE)
        own = harmonize.flipped(own.withColumn("orientation", F.col(f"o{i}") if i else F.lit("same"))).withColumn("dataset", F.lit(i)).select("chrom", "pos", "ref", "alt", "sample_id", "sample_ord", "a0", "a1", "n_alt", "dataset")
        out = own if out is None else out.unionByName(own)
    report = harmonize.orientation_report(sites[0], sites[1], cfg["allow_strand_complement"]) if len(sites) > 1 else ctx.spark.createDataFrame([], "orientation string, n bigint")
    return {"callset": out, "orientation_report": report}


@STAGES.register("qc", needs=("callset", "sample_sheet"), makes=("sample_qc", "site_qc", "exclusions", "qc_callset"), params={"min_call_rate": Param(0.5, 0, 1), "min_sample_call_rate": Param(None, 0, 1), "min_site_call_rate": Param(0.8, 0, 1), "min_site_maf": Param(0.0, 0, 0.5)})
def qc(ctx, cfg):
    c, sheet = ctx.get("callset"), ctx.get("sample_sheet")
    n = c.select(*SITE).distinct().count()
    samples = quality.sample_metrics(c, sheet, n, cfg["min_call_rate"] if cfg["min_sample_call_rate"] is None else cfg["min_sample_call_rate"])
    own = c.join(samples.filter("reasons = ''").select("sample_id"), "sample_id", "left_semi")
    sites = quality.site_metrics(own, max(1, own.select("sample_id").distinct().count()), cfg["min_site_call_rate"], cfg["min_site_maf"])
    kept = own.join(sites.filter("reasons = ''").select(*SITE), SITE, "left_semi")
    return {"sample_qc": samples, "site_qc": sites, "exclusions": quality.exclusions(samples, sites), "qc_callset": kept}


@STAGES.register("load_genotypes", takes=("qc_callset", "callset", "depths"), makes=("genotypes",), params={"min_maf": Param(0.0, 0, 0.5), "max_missing": Param(1.0, 0, 1), "biallelic_snps_only": Param(True)})
def load_genotypes(ctx, cfg):
    c = calls(ctx.get("depths")) if "depths" in ctx.artifacts else ctx.get("qc_callset", "callset")
    n = max(1, c.select("sample_id").distinct().count())
    return {"genotypes": quality.site_filter(c, n, cfg["min_maf"], cfg["max_missing"])}


@STAGES.register("analysis_readiness", needs=("genotypes",), takes=("sample_sheet",), makes=("analysis_genotypes", "readiness"), params={"strict": Param(False), "autosomes_only": Param(True), "min_samples_per_population": Param(2, 1), "ld_prune": Param(True), "ld_window_bp": Param(500_000, 1), "ld_r2_threshold": Param(0.8, 0, 1), "duplicate_concordance": Param(0.98, 0.5, 1)})
def analysis_readiness(ctx, cfg):
    g = genotypes(ctx)
    before = g.select(*SITE).distinct().count()
    g = quality.autosomal(g) if cfg["autosomes_only"] else g
    n = g.select("sample_id").distinct().count()
    if cfg["ld_prune"]:
        g = g.join(windows.ld_prune(g, n, cfg["ld_window_bp"], cfg["ld_r2_threshold"]), SITE, "left_semi")
    small = sorted(str(r["population"]) for r in g.groupBy("population").agg(F.count_distinct("sample_id").alias("n")).filter(F.col("n") < cfg["min_samples_per_population"]).collect())
    pairs = [[str(r["s1"]), str(r["s2"]), r["concordance"]] for r in quality.concordance(g, 100, cfg["duplicate_concordance"]).collect()]
    warnings = [f"few samples: {p}" for p in small] + [f"near duplicates: {a}, {b}" for a, b, _ in pairs]
    if cfg["strict"] and warnings:
        raise ValueError("; ".join(warnings))
    return {"analysis_genotypes": g, "readiness": {"sites_before": before, "duplicates": pairs, "warnings": warnings}}


@STAGES.register("distance", takes=GENOTYPES, makes=("distance",), params={"metric": Param("allele_difference", choices=("allele_difference",))})
def distance(ctx, cfg):
    g = ctx.get(*GENOTYPES)
    return {"distance": population.distance(g, quality.segregating(g), samples_of(g))}


@STAGES.register("pca", takes=(*GENOTYPES, "sample_sheet"), makes=("pca", "pca_variance"), params={"n_components": Param(6, 2), "scaler": Param("patterson", choices=("patterson", "standard", "none")), "impute_mean": Param(False)})
def pca(ctx, cfg):
    g = ctx.get(*GENOTYPES)
    ids, x, share = matrix.pca(g, quality.segregating(g), cfg["n_components"], cfg["scaler"], cfg["impute_mean"])
    cols = ", ".join(f"PC{i + 1} double" for i in range(x.shape[1]))
    return {"pca": ctx.spark.createDataFrame([(str(s), *map(float, r)) for s, r in zip(ids, x, strict=True)], f"sample_id string, {cols}"), "pca_variance": [float(v) for v in share]}


@STAGES.register("fst", takes=(*GENOTYPES, "sample_sheet"), makes=("fst",), params={"method": Param("hudson", choices=("hudson",)), "min_samples_per_population": Param(2, 1)})
def fst(ctx, cfg):
    g = genotypes(ctx)
    return {"fst": population.fst(counts(g.filter(F.col("population").isin(pops(g, cfg["min_samples_per_population"])))))}


@STAGES.register("diversity", takes=(*GENOTYPES, "sample_sheet"), makes=("diversity",), params={"min_samples_per_population": Param(2, 1), "callable_sites": Param(0, 0)})
def diversity(ctx, cfg):
    g = genotypes(ctx)
    g = g.filter(F.col("population").isin(pops(g, cfg["min_samples_per_population"])))
    return {"diversity": population.diversity(counts(g), g, cfg["callable_sites"])}


@STAGES.register("admixture", takes=(*GENOTYPES, "sample_sheet"), makes=("admixture", "admixture_cv"), params={"k_min": Param(2, 1), "k_max": Param(6, 1), "max_sites": Param(20_000, 1), "cv_holdout": Param(0.1, 0, 1), "n_iter": Param(250, 1), "n_replicates": Param(3, 1)})
def admixture(ctx, cfg):
    g = ctx.get(*GENOTYPES)
    ids, x = matrix.dosages(g, quality.site_subsample(quality.segregating(g), cfg["max_sites"], ctx.seed))
    errors = matrix.choose_k(x, list(range(cfg["k_min"], cfg["k_max"] + 1)), cfg["cv_holdout"], cfg["n_iter"], cfg["n_replicates"], ctx.seed)
    k = min(errors, key=errors.get)
    q = matrix.admixture(x, k, cfg["n_iter"], ctx.seed)
    cols = ", ".join(f"Q{i + 1} double" for i in range(k))
    return {"admixture": ctx.spark.createDataFrame([(str(s), *map(float, r)) for s, r in zip(ids, q, strict=True)], f"sample_id string, {cols}"), "admixture_cv": {str(a): b for a, b in errors.items()}}


@STAGES.register("cluster", needs=("distance",), takes=("sample_sheet",), makes=("clusters",), params={"k_min": Param(2, 2), "k_max": Param(8, 2), "linkage": Param("average", choices=("average",))})
def cluster(ctx, cfg):
    ids, d = matrix.square(ctx.get("distance"), "s1", "s2", "distance")
    k, s, labels = matrix.best_clusters(d, cfg["k_min"], cfg["k_max"])
    return {"clusters": ctx.spark.createDataFrame([(str(i), int(x), k, float(s)) for i, x in zip(ids, labels, strict=True)], "sample_id string, cluster int, k int, silhouette double")}


@STAGES.register("roh", takes=GENOTYPES, makes=("roh",), params={"window_bp": Param(100_000, 1), "max_window_heterozygosity": Param(0.02, 0, 1), "min_segment_bp": Param(200_000, 1)})
def roh(ctx, cfg):
    g = ctx.get(*GENOTYPES)
    return {"roh": windows.roh_summary(g, g.select(*SITE).distinct(), window_bp=cfg["window_bp"], most_het=cfg["max_window_heterozygosity"], min_bp=cfg["min_segment_bp"])}


def _outgroup(cfg: dict, freqs: DataFrame, known: list):  # noqa: ANN202
    if cfg["outgroup"] not in ("", None):
        if cfg["outgroup"] not in known:
            raise ValueError(f"no population {cfg['outgroup']}")
        return cfg["outgroup"]
    if not cfg["allow_auto_outgroup"]:
        raise ValueError("an outgroup has to be named")
    return fstats.auto_outgroup(freqs).orderBy(F.desc("difference"), "population").first()["population"]


_OUTGROUP = {"outgroup": Param(""), "allow_auto_outgroup": Param(False)}


@STAGES.register("dstats", takes=(*GENOTYPES, "sample_sheet"), makes=("dstats", "fd_windows"), params=_OUTGROUP | {"block_mode": Param("chromosome", choices=("chromosome", "bp", "sites")), "block_size_mb": Param(5.0, 0), "n_blocks": Param(20, 1), "min_effective_blocks": Param(2, 2), "window_bp": Param(100_000, 1), "min_window_sites": Param(10, 1)})
def dstats(ctx, cfg):
    g = genotypes(ctx)
    c, known = counts(g), pops(g)
    out = _outgroup(cfg, c, known)
    d = fstats.d_statistics(c, known, out, cfg["block_mode"], size_bp=int(cfg["block_size_mb"] * 1e6), n_blocks=cfg["n_blocks"])
    d = d.withColumn("z", F.when(F.col("n_blocks") >= cfg["min_effective_blocks"], F.col("z")))
    d = population.running_q(fstats.with_p(d))
    rows = [r for r in d.collect() if r["z"] is not None]
    if not rows:
        return {"dstats": d, "fd_windows": ctx.spark.createDataFrame([], "chrom string, start bigint, end bigint, n_sites bigint, f_d double")}
    top = max(rows, key=lambda r: abs(r["z"]))
    return {"dstats": d, "fd_windows": fstats.fd_windows(c, [top["p1"], top["p2"], top["p3"], out], cfg["window_bp"], cfg["min_window_sites"])}


@STAGES.register("f3", takes=(*GENOTYPES, "sample_sheet"), makes=("f3",), params=_OUTGROUP | {"n_blocks": Param(20, 1)})
def f3(ctx, cfg):
    g = genotypes(ctx)
    c = counts(g)
    return {"f3": fstats.f3_matrix(c, _outgroup(cfg, c, pops(g)), cfg["n_blocks"])}


@STAGES.register("local_ancestry", takes=(*GENOTYPES, "sample_sheet"), makes=("ancestry_windows", "ancestry_fractions"), params={"sources": Param(required=True), "targets": Param(required=True), "window_bp": Param(200_000, 1), "switch_prob": Param(0.02, 0, 1), "min_sites": Param(5, 1)})
def local_ancestry(ctx, cfg):
    g = genotypes(ctx)
    w = windows.emissions(g, counts(g), cfg["sources"], cfg["targets"], cfg["window_bp"], cfg["min_sites"])
    paths = windows.local_ancestry(w, cfg["sources"], cfg["switch_prob"], {f.name: f.dataType.simpleString() for f in g.schema})
    return {"ancestry_windows": paths, "ancestry_fractions": windows.ancestry_fractions(paths, cfg["sources"])}


@STAGES.register("selection", takes=(*GENOTYPES, "sample_sheet"), makes=("selection",), params={"focal_population": Param(required=True), "reference_populations": Param(required=True), "window_bp": Param(100_000, 1)})
def selection(ctx, cfg):
    return {"selection": windows.pbs_windows(counts(genotypes(ctx)), [cfg["focal_population"], *cfg["reference_populations"]], cfg["window_bp"])}


@STAGES.register("demography", takes=(*GENOTYPES, "sample_sheet"), makes=("demography", "sfs"), params={"mutation_rate": Param(0.0, 0), "callable_sites": Param(0, 0)})
def demography(ctx, cfg):
    g = genotypes(ctx)
    c = counts(g)
    return {"demography": population.demography(c, g, cfg["callable_sites"], cfg["mutation_rate"]), "sfs": population.folded_spectrum(c)}


@STAGES.register("pseudohaploid", needs=("genotypes",), makes=("pseudohaploid",), params={})
def pseudohaploid(ctx, cfg):
    return {"pseudohaploid": quality.pseudohaploid(ctx.get("genotypes"), ctx.seed)}


@STAGES.register("geography", needs=("distance", "sample_sheet"), takes=("admixture",), makes=("places_km", "mantel", "regional_ancestry"), params={"permutations": Param(999, 1)})
def geography(ctx, cfg):
    sheet = ctx.get("sample_sheet")
    km = population.haversine(sheet.filter("latitude is not null and longitude is not null").select("sample_id", F.col("latitude").alias("lat"), F.col("longitude").alias("lon")))
    d = ctx.get("distance").join(km, ["s1", "s2"])
    _, a = matrix.square(d, "s1", "s2", "distance")
    _, b = matrix.square(d, "s1", "s2", "km")
    r, p = matrix.mantel(a, b, cfg["permutations"], ctx.seed)
    out = {"places_km": km, "mantel": {"r": r, "p": p}}
    if "admixture" in ctx.artifacts:
        q = ctx.get("admixture")
        both = q.join(F.broadcast(sheet.select("sample_id", "region")), "sample_id", "left").fillna("unknown", ["region"])
        out["regional_ancestry"] = both.groupBy("region").agg(*[F.bround(F.avg(x), 4).alias(x) for x in q.columns if x != "sample_id"])
    return out


@STAGES.register("nj_tree", takes=GENOTYPES, makes=("nj",), params={"n_bootstrap": Param(100, 0), "bootstrap_mode": Param("chromosome", choices=("chromosome", "site"))})
def nj_tree(ctx, cfg):
    g = ctx.get(*GENOTYPES)
    sites = quality.segregating(g)
    if cfg["bootstrap_mode"] == "site":
        tree, support = trees.site_bootstrap_tree(g, sites, cfg["n_bootstrap"], ctx.seed)
    else:
        tree, support = trees.bootstrap_tree(trees.block_distances(g, sites), cfg["n_bootstrap"], ctx.seed)
    return {"nj": {"newick": trees.newick(tree, support)}}


@STAGES.register("ml_tree", takes=GENOTYPES, makes=("ml", "alignment"), params={"model": Param("MFP"), "ufboot": Param(1000, 0)})
def ml_tree(ctx, cfg):
    g = ctx.get(*GENOTYPES)
    names = [str(r["sample_id"]) for r in samples_of(g).orderBy("sample_id").collect()]
    order = ctx.spark.createDataFrame(list(enumerate(names)), "sample_ord int, sample_id string")
    rows = exports.phylip_rows(g.drop("sample_ord").withColumn("sample_id", F.col("sample_id").cast("string")).join(F.broadcast(order), "sample_id"), names)
    return {"alignment": rows, "ml": {"command": _command("iqtree2", "-s", "alignment.phy", "-m", cfg["model"], "-B", cfg["ufboot"])}}


@STAGES.register("treemix", takes=(*GENOTYPES, "sample_sheet"), makes=("treemix_input", "treemix"), params={"n_migrations": Param(2, 0), "block_size": Param(500, 1), "root": Param(""), "input_path": Param("")})
def treemix(ctx, cfg):
    g = genotypes(ctx)
    if cfg["input_path"]:
        exports.write_treemix(counts(g), pops(g), ctx.path(cfg["input_path"]))
    return {"treemix_input": exports.treemix(counts(g), pops(g)), "treemix": {"command": _command("treemix", "-i", cfg["input_path"] or "counts.gz", "-m", cfg["n_migrations"], "-k", cfg["block_size"], *(["-root", cfg["root"]] if cfg["root"] else []))}}


_FILES = {"bridge_vcf": Param(""), "calls_dir": Param(""), "query_samples": Param(()), "min_depth": Param(8, 4)}


def _either(ctx: Context, cfg: dict, *roles: str) -> bool:
    """Whether the stage reads files; else the roles have to be there."""
    if cfg["bridge_vcf"]:
        return True
    if missing := [r for r in roles if r not in ctx.artifacts]:
        raise KeyError(f"needs bridge_vcf, or {', '.join(missing)}")
    return False


@STAGES.register("reference_mixture", takes=("calls", "panel_freqs"), makes=("fractions", "verdict"), params=_FILES | {"reference_genotypes": Param(""), "wgs_samples": Param(()), "coyote_samples": Param(()), "source": Param("dog"), "base": Param("coyote"), "min_difference": Param(0.4, 0), "min_called": Param(20, 1), "expected_f1": Param(""), "expected_parent": Param(""), "expected_offspring": Param(()), "f1_target": Param(0.46), "f1_tolerance": Param(0.2), "parent_max": Param(0.2), "offspring_min": Param(0.08), "offspring_max": Param(0.45)})
def reference_mixture(ctx, cfg):
    calls_, freqs = hybrid.two_source(ctx, cfg) if _either(ctx, cfg, "calls", "panel_freqs") else (ctx.get("calls"), ctx.get("panel_freqs"))
    out = mixture.source_fraction(calls_, freqs, cfg["source"], cfg["base"], cfg["min_difference"], cfg["min_called"])
    if "depth" in calls_.columns:
        out = out.join(calls_.groupBy("sample_id").agg(F.bround(F.avg("depth"), 2).alias("mean_depth")), "sample_id")
    verdict = mixture.pedigree_verdict(out, cfg["expected_f1"], cfg["expected_parent"], list(cfg["expected_offspring"]), cfg["f1_target"], cfg["f1_tolerance"], cfg["parent_max"], cfg["offspring_min"], cfg["offspring_max"])
    return {"fractions": out, "verdict": verdict}


@STAGES.register("breed_assign", takes=("calls", "panel", "fractions"), makes=("breed_scores", "breed_loo"), params=_FILES | {"wgs_genotypes": Param(""), "dog_fractions": Param(""), "locus_filter_json": Param(""), "top_k": Param(5, 1), "single_breed_gap": Param(5.0, 0), "min_group": Param(3, 2)})
def breed_assign(ctx, cfg):
    if _either(ctx, cfg, "calls", "panel"):
        scores, loo = hybrid.breed_scores(ctx, cfg)
        return {"breed_scores": scores, "breed_loo": loo}
    panel = ctx.get("panel")
    big = panel.groupBy("population").agg(F.count_distinct("sample_id").alias("n")).filter(F.col("n") >= cfg["min_group"]).select("population")
    panel = panel.join(F.broadcast(big), "population", "left_semi")
    n = panel.select(*SITE).distinct().count()
    pooled = population.laplace(panel.withColumn("any", F.lit(0)), "any").select(*SITE, "p")
    scores = mixture.candidate_scores(ctx.get("calls"), population.laplace(panel), pooled, n, cfg["top_k"], cfg["single_breed_gap"])
    return {"breed_scores": scores, "breed_loo": mixture.leave_one_out(panel, n, min_group=cfg["min_group"])}


@STAGES.register("multiway_admixture", takes=("calls", "panel_freqs"), makes=("mixture", "cohorts", "two_way", "mixture_breeds", "region_summary"), params={"bridge_vcf": Param(""), "wgs_genotypes": Param(""), "western_ids": Param(()), "western_id_prefix": Param(""), "western_id_range": Param(()), "exclude_samples": Param(()), "exclude_bridge_wgs_bug_ids": Param(True), "bootstrap_n": Param(200, 0), "seed": Param(0), "min_group": Param(3, 2), "top_k": Param(5, 1), "min_dog_fraction_for_breed": Param(0.05, 0), "base": Param("coyote"), "one": Param("wolf"), "two": Param(None), "step": Param(0.01, 0.005, 0.5), "min_panel_separation": Param(0.15, 0)})
def multiway_admixture(ctx, cfg):
    if _either(ctx, cfg, "calls", "panel_freqs"):
        return hybrid.three_way(ctx, cfg)
    return {"mixture": mixture.mixture_grid(ctx.get("calls"), ctx.get("panel_freqs"), cfg["base"], cfg["one"], cfg["two"], cfg["step"], cfg["min_panel_separation"])}


@STAGES.register("sv", needs=("alignments",), makes=("sv",), params={"reference": Param("reference.fasta"), "sv_types": Param(("DEL", "DUP", "INV")), "threads": Param(4, 1)})
def sv(ctx, cfg):
    return {"sv": [{"command": _command("delly", "call", "-g", cfg["reference"], *[f"{a['sample_id']}.cram" for a in ctx.get("alignments")])}]}


@STAGES.register("report", takes=("sample_sheet", "fst", "pca", "pca_variance", "diversity", "admixture", "admixture_cv", "clusters", "roh", "dstats", "f3", "fd_windows", "selection", "demography", "distance", "places_km", "mantel", "regional_ancestry", "nj", "sample_qc", "exclusions", "readiness", "orientation_report", "ancestry_windows", "ancestry_fractions", "fractions", "verdict", "breed_scores", "breed_loo", "mixture", "cohorts", "two_way", "mixture_breeds", "region_summary"), makes=("report", "citations"), params={"title": Param("Population-genomics report"), "exploratory": Param(True), "citations": Param(())})
def report(ctx, cfg):
    from . import citations
    from .report import html

    cited = citations.rows(citations.load(list(cfg["citations"]), ctx.root)) if cfg["citations"] else []
    return {"report": {"html": html(ctx.artifacts, cfg["title"], cfg["exploratory"], cited)}, "citations": cited}
