"""The relational genotype model.

``calls`` is the canonical long table: one row per site and sample with a call,
``chrom, pos, site_ord, sample_id, population, a0, a1, n_alt``.  A missing call is a missing
row (or a null ``n_alt``); a half call keeps its known allele and has a null ``n_alt``.
``counts`` is the central aggregate, per site and population; nearly every statistic starts
from it, so it is computed once, with map-side combining, and reused.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shipping import ship

#: Allele balance of a homozygous call (fixed values).
HOM_REF, HOM_ALT = 0.15, 0.85
SITE = ["chrom", "pos"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def recall(depth: Column, alt: Column, min_depth: int = 1) -> Column:
    """Genotype from allele depths; null below the minimum depth."""
    share = alt / depth
    return F.when(depth < min_depth, None).when(share <= HOM_REF, 0).when(share >= HOM_ALT, 2).otherwise(1).cast("int")


def read_depths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads of the star schema as allele depths: a lineitem is a read of its part's site,
    from the sample that its customer's nation stands for.  The joins up to the nation are
    on keys; the nation side is of fixed size."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_partkey").alias("site"), F.col("l_returnflag").alias("flag"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    reads = lines.join(orders, lines.l_orderkey == orders.o_orderkey).join(customers, F.col("o_custkey") == F.col("c_custkey"))
    depth = reads.groupBy("site", "c_nationkey").agg(F.count(F.lit(1)).alias("depth"), F.sum((F.col("flag") == "R").cast("int")).alias("alt_count"))
    named = depth.join(F.broadcast(nations), F.col("c_nationkey") == F.col("n_nationkey"))
    site = F.col("site")
    return named.select(
        (site % 38 + 1).cast("bigint").alias("chrom"),
        (F.expr("(site - site % 38) div 38 + 1") * 10000).cast("bigint").alias("pos"),
        site.cast("bigint").alias("site_ord"),
        F.col("c_nationkey").cast("bigint").alias("sample_id"),
        F.col("n_regionkey").cast("bigint").alias("population"),
        "depth",
        "alt_count",
    )


def calls(depths: DataFrame, min_depth: int = 1) -> DataFrame:
    """Genotype calls of allele depths, with alleles."""
    called = depths.withColumn("n_alt", recall(F.col("depth"), F.col("alt_count"), min_depth))
    return called.withColumns({"a0": (F.col("n_alt") > 1).cast("int"), "a1": (F.col("n_alt") > 0).cast("int")})


def counts(called: DataFrame) -> DataFrame:
    """chrom, pos, population, n_called, ref_n, alt_n, p (null where nothing is called).
    Known alleles of half calls are counted."""
    known = lambda allele: sum((F.coalesce((F.col(c) == allele).cast("int"), F.lit(0)) for c in ("a0", "a1")), F.lit(0))
    both = called.groupBy(*SITE, "population").agg(
        F.sum(F.col("n_alt").isNotNull().cast("int")).cast("bigint").alias("n_called"),
        F.sum(known(0)).cast("bigint").alias("ref_n"),
        F.sum(known(1)).cast("bigint").alias("alt_n"),
    )
    total = F.col("ref_n") + F.col("alt_n")
    return both.withColumn("p", F.when(total > 0, F.col("alt_n") / total))


def wide(count: DataFrame, populations: list, value: str = "p") -> DataFrame:
    """One column ``p0, p1, ...`` per given population; sites where all are known."""
    out = count.filter(F.col("population").isin(populations)).groupBy(*SITE).pivot("population", populations).agg(F.first(value))
    for i, p in enumerate(populations):
        out = out.withColumnRenamed(str(p), f"p{i}")
    return out.dropna(subset=[f"p{i}" for i in range(len(populations))])


#: Bases of a bin within which sites are ranked.
RANK_BP = 1 << 20


def ranked(sites: DataFrame) -> DataFrame:
    """Adds ``_rank``, the number of sites before in order of (chrom, pos), and ``_total``.  Ranks
    are made within bins of RANK_BP bases and offset by the bins before, of which there are as
    many as a genome has megabases, so that no task orders a contig."""
    own = sites.withColumn("_bin", F.floor(F.col("pos") / RANK_BP))
    per = own.groupBy("chrom", "_bin").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("chrom", "_bin").rowsBetween(Window.unboundedPreceding, -1)
    before = per.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    total = per.agg(F.sum("_n").alias("_total"))
    within = F.row_number().over(Window.partitionBy("chrom", "_bin").orderBy("pos")) - 1
    placed = own.withColumn("_k", within).join(F.broadcast(before), ["chrom", "_bin"]).join(F.broadcast(total))
    return placed.withColumn("_rank", F.col("_before") + F.col("_k")).select(*sites.columns, "_rank", "_total")
