"""Allele-count calls, JSON panels, sample sheets and manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.strings import contig_number, genotype
from ..model import recall

CALLS = "chrom string, position bigint, ref string, alt string, gt string, depth int, ref_count int, alt_count int"
SHEET = ("sample_id", "taxon", "population", "subspecies", "scientific_name", "region", "country", "latitude", "longitude", "source_study", "accession")
REQUIRED = SHEET[:3]
LAYOUTS = ("paired", "interleaved", "single")


def allele_counts(spark: SparkSession, path: str, sites: DataFrame | None = None, min_depth: int = 8) -> DataFrame:
    """Calls made anew from depths.  With ``sites``, the coordinates have to be the same."""
    rows = spark.read.csv(path, header=True, schema=CALLS).withColumnRenamed("position", "pos")
    if sites is not None:
        odd = rows.select("chrom", "pos", F.lit(1).alias("x")).join(sites.select("chrom", "pos", F.lit(1).alias("y")), ["chrom", "pos"], "full_outer").filter("x is null or y is null")
        if (n := odd.count()):
            raise ValueError(f"{path}: {n} coordinates differ from the requested sites")
    return rows.withColumn("n_alt", recall(F.col("depth"), F.col("alt_count"), min_depth))


def json_panel(spark: SparkSession, path: str, samples: list[str] | None = None) -> DataFrame:
    """Long calls of ``{"samples": [...], "loci": {"chr:pos": [gt, ...]}}``, or of a plain map
    of loci with the sample order given."""
    text = spark.read.text(path, wholetext=True)
    loci = "map<string, array<string>>"
    if samples is None:
        whole = text.select(F.from_json("value", f"samples array<string>, loci {loci}").alias("j")).select(F.col("j.samples").alias("samples"), F.explode("j.loci").alias("key", "gts"))
    else:
        whole = text.select(F.array(*[F.lit(s) for s in samples]).alias("samples"), F.explode(F.from_json("value", loci)).alias("key", "gts"))
    each = whole.select("key", "samples", F.posexplode("gts").alias("sample_ord", "gt"))
    chrom, pos = F.split("key", ":")[0], F.split("key", ":")[1].cast("bigint")
    return each.select(chrom.alias("chrom"), pos.alias("pos"), contig_number(chrom).alias("number"), F.element_at("samples", F.col("sample_ord") + 1).alias("sample_id"), "sample_ord", genotype(F.col("gt")).alias("n_alt"))


def json_loci(spark: SparkSession, path: str) -> DataFrame:
    """The distinct coordinates of a JSON map of loci, whatever its values are."""
    keys = spark.read.text(path, wholetext=True).select(F.explode(F.map_keys(F.from_json("value", "map<string, string>"))).alias("key"))
    return keys.select(F.split("key", ":")[0].alias("chrom"), F.split("key", ":")[1].cast("bigint").alias("pos")).distinct()


def sample_sheet(spark: SparkSession, path: str, taxa: set[str] | None = None) -> DataFrame:
    """The sheet in column order, checked: required columns, ids that are there and unique,
    known taxa, populations, coordinates in range."""
    raw = spark.read.csv(path, header=True)
    if missing := [c for c in REQUIRED if c not in raw.columns]:
        raise ValueError(f"{path}: missing columns {', '.join(missing)}")
    text = lambda c: F.trim(F.coalesce(F.col(c), F.lit("")))
    rows = raw.select(*[(text(c) if c in raw.columns else F.lit("")).alias(c) for c in SHEET]).withColumn("taxon", F.lower("taxon"))
    number = lambda c: F.col(c).try_cast("double")
    bad = lambda c, top: (F.col(c) != "") & (number(c).isNull() | (F.abs(number(c)) > top))
    faults = {"empty sample_id": F.col("sample_id") == "", "empty population": F.col("population") == "", "latitude": bad("latitude", 90), "longitude": bad("longitude", 180)}
    if taxa is not None:
        faults["unknown taxon"] = ~F.col("taxon").isin(*taxa)
    found = rows.agg(*[F.sum(c.cast("int")).alias(k) for k, c in faults.items()], F.count(F.lit(1)).alias("n"), F.count_distinct("sample_id").alias("ids")).first()
    wrong = [k for k in faults if found[k]] + ["duplicate sample_id"] * (found["n"] != found["ids"])
    if wrong:
        raise ValueError(f"{path}: {'; '.join(wrong)}")
    return rows.withColumns({"latitude": number("latitude"), "longitude": number("longitude")})


def aligned(samples: DataFrame, sheet: DataFrame) -> DataFrame:
    """Samples with their labels; one that the sheet lacks is ``unknown``."""
    out = samples.join(F.broadcast(sheet.select("sample_id", "population", "region")), "sample_id", "left")
    return out.fillna("unknown", ["population", "region"])


def choose_samples(sheet: DataFrame, wanted: list[str]) -> DataFrame:
    """The wanted rows in the wanted order; an error on repeats and unknown ids."""
    if len(set(wanted)) < len(wanted):
        raise ValueError("a sample is named twice")
    order = sheet.sparkSession.createDataFrame(list(enumerate(wanted)), "ord int, sample_id string")
    out = order.join(sheet, "sample_id")
    if out.count() < len(wanted):
        raise ValueError("a sample is not in the sheet")
    return out.orderBy("ord").drop("ord")


def fastq_manifest(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.csv(path, header=True)
    if missing := [c for c in ("sample_id", "fastq1") if c not in rows.columns]:
        raise ValueError(f"{path}: missing columns {', '.join(missing)}")
    second = F.col("fastq2") if "fastq2" in rows.columns else F.lit(None).cast("string")
    layout = F.lower("layout") if "layout" in rows.columns else F.when(second.isNotNull(), "paired").otherwise("single")
    out = rows.select("sample_id", "fastq1", second.alias("fastq2"), layout.alias("layout"))
    if out.filter(~F.col("layout").isin(*LAYOUTS)).limit(1).count():
        raise ValueError(f"{path}: unknown layout")
    return out


def source_fractions(spark: SparkSession, path: str) -> DataFrame:
    """sample_id, fraction: from CSV, from JSON ``results`` or from a JSON map."""
    if path.endswith(".csv"):
        return spark.read.csv(path, header=True).select("sample_id", F.col("dog_fraction").cast("double").alias("fraction"))
    text = spark.read.text(path, wholetext=True)
    rows = text.select(F.explode(F.from_json("value", "results array<struct<sample_id:string,dog_fraction:double>>")["results"]).alias("r")).select("r.sample_id", F.col("r.dog_fraction").alias("fraction"))
    if rows.limit(1).count():
        return rows
    return text.select(F.explode(F.from_json("value", "map<string, double>")).alias("sample_id", "fraction"))


def pileup(spark: SparkSession, path: str, sites: DataFrame, min_mapq: int = 30, min_base: int = 20) -> DataFrame:
    """Bases that SAM reads show at sites: chrom, pos, base, n.  Unmapped, secondary,
    duplicate and supplementary reads are left out.  The CIGAR is walked with columns."""
    f = F.split("value", "\t")
    reads = spark.read.text(path).filter(~F.col("value").startswith("@")).select(f[1].cast("int").alias("flag"), f[2].alias("chrom"), f[3].cast("bigint").alias("start"), f[4].cast("int").alias("mapq"), f[5].alias("cigar"), f[9].alias("seq"), f[10].alias("qual"))
    good = reads.filter((F.col("flag").bitwiseAND(0xD04) == 0) & (F.col("mapq") >= min_mapq) & F.col("cigar").rlike("^([0-9]+[MIDNSHP=X])+$"))
    ops = F.transform(F.regexp_extract_all("cigar", F.lit("([0-9]+)([MIDNSHP=X])"), F.lit(0)), lambda x: F.struct(F.regexp_extract(x, "^[0-9]+", 0).cast("int").alias("n"), F.substring(x, -1, 1).alias("op")))
    zero = F.struct(F.col("start").alias("at"), F.lit(1).alias("read"), F.array().cast("array<struct<at:bigint,read:int,n:int>>").alias("out"))

    def step(acc, x):  # noqa: ANN001, ANN202
        ref, own, both = x["op"].isin("M", "D", "N", "=", "X"), x["op"].isin("M", "I", "S", "=", "X"), x["op"].isin("M", "=", "X")
        out = F.when(both, F.concat(acc["out"], F.array(F.struct(acc["at"].alias("at"), acc["read"].alias("read"), x["n"].alias("n"))))).otherwise(acc["out"])
        return F.struct((acc["at"] + F.when(ref, x["n"]).otherwise(0)).alias("at"), (acc["read"] + F.when(own, x["n"]).otherwise(0)).alias("read"), out.alias("out"))

    runs = good.select("chrom", "seq", "qual", F.explode(F.aggregate(ops, zero, step, lambda acc: acc["out"])).alias("r"))
    bins = runs.withColumn("bin", F.explode(F.sequence(F.floor(F.col("r.at") / 1000), F.floor((F.col("r.at") + F.col("r.n") - 1) / 1000))))
    own = sites.select("chrom", "pos", F.floor(F.col("pos") / 1000).alias("bin"))
    hits = bins.join(own, ["chrom", "bin"]).filter((F.col("pos") >= F.col("r.at")) & (F.col("pos") < F.col("r.at") + F.col("r.n")))
    i = (F.col("r.read") + F.col("pos") - F.col("r.at")).cast("int")
    seen = hits.select("chrom", "pos", F.upper(F.substring("seq", i, F.lit(1))).alias("base"), (F.ascii(F.substring("qual", i, F.lit(1))) - 33).alias("q"))
    return seen.filter(F.col("q") >= min_base).groupBy("chrom", "pos", "base").agg(F.count(F.lit(1)).alias("n"))
