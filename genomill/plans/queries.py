"""One query per operator over the driver's tables, and SQL that states the same result.

Numbers are rounded alike on both sides; keys are BIGINT.  Population 4 is the outgroup,
0 to 3 the others; sample ids are nations, which number 25 at any scale.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import strings
from ..model import SITE, calls, counts, read_depths, recall, table
from ..operators import fstats, harmonize, matrix, mixture, population, quality, trees, windows
from . import studies

OUT = 4
_Q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}

#: The genotype view as SQL: g depths, c calls, s samples, f counts and frequencies.
VIEW = """WITH RECURSIVE g AS (SELECT CAST(l_partkey % 38 + 1 AS BIGINT) AS chrom,
 CAST(((l_partkey - l_partkey % 38) / 38 + 1) * 10000 AS BIGINT) AS pos, CAST(l_partkey AS BIGINT) AS site_ord,
 CAST(c_nationkey AS BIGINT) AS sample_id, CAST(n_regionkey AS BIGINT) AS population, count(*) AS depth,
 CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS alt_count
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
 GROUP BY l_partkey, c_nationkey, n_regionkey),
c AS (SELECT *, CASE WHEN alt_count * 1.0 / depth <= 0.15 THEN 0 WHEN alt_count * 1.0 / depth >= 0.85 THEN 2 ELSE 1 END AS n_alt FROM g),
f0 AS (SELECT chrom, pos, population, count(*) AS n_called, CAST(sum(2 - n_alt) AS BIGINT) AS ref_n, CAST(sum(n_alt) AS BIGINT) AS alt_n FROM c GROUP BY ALL),
f AS (SELECT *, alt_n * 1.0::DOUBLE / (ref_n + alt_n) AS p, CASE WHEN ref_n + alt_n > 1 THEN 2.0::DOUBLE * ref_n * alt_n / ((ref_n + alt_n) * (ref_n + alt_n - 1)) ELSE 0 END AS within FROM f0),
sites AS (SELECT DISTINCT chrom, pos FROM c),
seg AS (SELECT chrom, pos FROM f GROUP BY ALL HAVING sum(alt_n) > 0 AND sum(ref_n) > 0)"""


def query(name: str, sql: str | None = None) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        _Q[name] = f
        if sql is not None:
            _SQL[name] = f"{VIEW}\n{sql}" if "FROM" in sql and not sql.startswith("--raw") else sql.removeprefix("--raw")
        return f

    return add


def called(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calls(read_depths(spark, sf_dir))


def freqs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts(called(spark, sf_dir))


def rounded(frame: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return frame.withColumns({c: F.round(F.col(c), digits) for c in columns})


def longs(frame: DataFrame, *columns: str) -> DataFrame:
    return frame.withColumns({c: F.col(c).cast("bigint") for c in columns})


def n_sites(c: DataFrame) -> int:
    return c.select(*SITE).distinct().count()


# -- calls, quality -----------------------------------------------------------------------


@query("genotype_calls", "SELECT chrom, pos, sample_id, population, depth, alt_count, CAST(n_alt AS BIGINT) AS n_alt FROM c")
def genotype_calls(spark, d):
    return longs(called(spark, d).select("chrom", "pos", "sample_id", "population", "depth", "alt_count", "n_alt"), "n_alt")


@query("depth_recall", "SELECT chrom, pos, sample_id, CAST(CASE WHEN depth >= 3 THEN n_alt END AS BIGINT) AS n_alt FROM c")
def depth_recall(spark, d):
    g = read_depths(spark, d)
    return g.select("chrom", "pos", "sample_id", recall(F.col("depth"), F.col("alt_count"), 3).cast("bigint").alias("n_alt"))


@query("sample_qc", """SELECT sample_id, CAST(count(*) AS BIGINT) AS n_called, round(count(*) * 1.0::DOUBLE / (SELECT count(*) FROM sites), 6) AS call_rate,
 round(avg(CASE WHEN n_alt = 1 THEN 1.0::DOUBLE ELSE 0 END), 6) AS het, CASE WHEN count(*) * 1.0::DOUBLE / (SELECT count(*) FROM sites) < 0.5 THEN 'call rate' ELSE '' END AS reasons FROM c GROUP BY sample_id""")
def sample_qc(spark, d):
    c = called(spark, d)
    return rounded(quality.sample_metrics(c, c.select("sample_id").distinct(), n_sites(c)), "call_rate", "het")


_SITE_QC = """sq AS (SELECT chrom, pos, count(*) AS n_called, count(*) / 25.0::DOUBLE AS call_rate, least(sum(n_alt) / (2.0::DOUBLE * count(*)), 1 - sum(n_alt) / (2.0::DOUBLE * count(*))) AS maf FROM c GROUP BY ALL),
 sr AS (SELECT *, concat_ws(';', CASE WHEN call_rate < 0.3 THEN 'call rate' END, CASE WHEN maf < 0.05 THEN 'maf' END) AS reasons FROM sq)"""


@query("site_qc", f", {_SITE_QC} SELECT chrom, pos, CAST(n_called AS BIGINT) AS n_called, round(call_rate, 6) AS call_rate, round(maf, 6) AS maf, reasons FROM sr")
def site_qc(spark, d):
    return rounded(quality.site_metrics(called(spark, d), 25, 0.3, 0.05), "call_rate", "maf")


@query("qc_exclusions", f""", {_SITE_QC} SELECT 'site' AS kind, chrom || ':' || pos AS id, reasons FROM sr WHERE reasons <> ''
 UNION ALL SELECT 'sample', CAST(sample_id AS VARCHAR), 'call rate' FROM c GROUP BY sample_id HAVING count(*) * 1.0::DOUBLE / (SELECT count(*) FROM sites) < 0.5""")
def qc_exclusions(spark, d):
    c = called(spark, d)
    samples = quality.sample_metrics(c, c.select("sample_id").distinct(), n_sites(c))
    return quality.exclusions(samples, quality.site_metrics(c, 25, 0.3, 0.05))


@query("qc_gate", """, sk AS (SELECT sample_id FROM c GROUP BY 1 HAVING count(*) * 1.0::DOUBLE / (SELECT count(*) FROM sites) >= 0.3), k AS (SELECT * FROM c SEMI JOIN sk USING (sample_id)),
 kk AS (SELECT chrom, pos FROM k GROUP BY ALL HAVING count(*) >= 5) SELECT k.sample_id, CAST(count(*) AS BIGINT) AS n FROM k SEMI JOIN kk USING (chrom, pos) GROUP BY 1""")
def qc_gate(spark, d):
    c = called(spark, d)
    samples = quality.sample_metrics(c, c.select("sample_id").distinct(), n_sites(c), 0.3)
    kept = quality.gate(c, samples, lambda k: quality.site_metrics(k, 25, 0.2))
    return kept.groupBy("sample_id").agg(F.count(F.lit(1)).alias("n"))


@query("segregating_sites", "SELECT chrom, pos FROM seg")
def segregating_sites(spark, d):
    return quality.segregating(called(spark, d))


@query("site_filters", """, k AS (SELECT chrom, pos FROM c GROUP BY ALL HAVING count(*) / 25.0::DOUBLE >= 1 - 0.6 AND least(sum(n_alt) / (2.0::DOUBLE * count(*)), 1 - sum(n_alt) / (2.0::DOUBLE * count(*))) >= 0.1)
 SELECT chrom, pos, sample_id, CAST(n_alt AS BIGINT) AS n_alt FROM c SEMI JOIN k USING (chrom, pos)""")
def site_filters(spark, d):
    return longs(quality.site_filter(called(spark, d), 25, 0.1, 0.6).select(*SITE, "sample_id", "n_alt"), "n_alt")


@query("autosomes", "SELECT CAST(chrom AS BIGINT) AS chrom, CAST(count(*) AS BIGINT) AS n FROM sites WHERE chrom <= 20 GROUP BY 1")
def autosomes(spark, d):
    s = called(spark, d).select(*SITE).distinct().withColumn("chrom", F.when(F.col("chrom") <= 20, F.concat(F.lit("chr"), "chrom")).otherwise(F.concat(F.lit("chrUn"), "chrom")))
    return quality.autosomal(s).groupBy(strings.contig_number(F.col("chrom")).cast("bigint").alias("chrom")).agg(F.count(F.lit(1)).alias("n"))


@query("thin_sites", "SELECT chrom, min(pos) AS pos FROM sites GROUP BY chrom, pos // 50000")
def thin_sites(spark, d):
    return quality.thin(called(spark, d).select(*SITE).distinct(), 50_000)


@query("panel_sites", ", k AS (SELECT chrom, pos, count(*) / 25.0::DOUBLE AS rate, sum(n_alt) / (2.0::DOUBLE * count(*)) AS q FROM c GROUP BY ALL) SELECT chrom, min(pos) AS pos FROM k WHERE rate >= 0.6 AND least(q, 1 - q) >= 0.2 GROUP BY chrom, pos // 50000")
def panel_sites(spark, d):
    return quality.panel_sites(called(spark, d), 25, 0.6, 0.2, 50_000)


@query("marker_panel", ", r AS (SELECT chrom, pos, row_number() OVER (ORDER BY chrom, pos) - 1 AS k, count(*) OVER () AS n FROM sites) SELECT chrom, pos FROM r WHERE k % CAST(ceil(n / 100.0) AS BIGINT) = 0")
def marker_panel(spark, d):
    return quality.marker_panel(called(spark, d).select(*SITE).distinct(), 100)


_PAIRS = "pr AS (SELECT a.sample_id AS s1, b.sample_id AS s2, count(*) AS n_sites, avg(CASE WHEN a.n_alt = b.n_alt THEN 1.0::DOUBLE ELSE 0 END) AS concordance FROM c a JOIN c b USING (chrom, pos) WHERE a.sample_id < b.sample_id GROUP BY ALL)"


@query("near_duplicates", f", {_PAIRS} SELECT s1, s2, CAST(n_sites AS BIGINT) AS n_sites, round(concordance, 6) AS concordance FROM pr WHERE n_sites >= 50 AND concordance >= 0.42")
def near_duplicates(spark, d):
    return rounded(quality.concordance(called(spark, d), 50, 0.42), "concordance")


@query("pseudohaploid")
def pseudohaploid(spark, d):
    return quality.pseudohaploid(called(spark, d), 7).select(*SITE, "sample_id", "a0", "a1", "n_alt")


@query("site_subsample")
def site_subsample(spark, d):
    return quality.site_subsample(called(spark, d).select(*SITE).distinct(), 500, 7)


# -- frequencies, diversity ---------------------------------------------------------------


@query("allele_freq", "SELECT chrom, pos, population, CAST(n_called AS BIGINT) AS n_called, ref_n, alt_n, round(p, 6) AS p FROM f")
def allele_freq(spark, d):
    return rounded(freqs(spark, d), "p")


@query("laplace_freq", "SELECT chrom, pos, population, CAST(n_called AS BIGINT) AS n_called, round((alt_n + 1) / (2.0::DOUBLE * n_called + 2), 6) AS p FROM f")
def laplace_freq(spark, d):
    return rounded(population.laplace(called(spark, d)), "p")


@query("shrunk_freq", ", m AS (SELECT chrom, pos, avg(p) AS prior FROM f GROUP BY ALL) SELECT chrom, pos, population, round(prior + 1e-10, 6) AS prior, round((alt_n + 6 * prior) / (2 * n_called + 6) + 1e-10, 6) AS p FROM f JOIN m USING (chrom, pos)")
def shrunk_freq(spark, d):
    # Means of few frequencies often end in an exact half; both sides round it up.
    out = population.shrunk(freqs(spark, d)).withColumns({"prior": F.col("prior") + 1e-10, "p": F.col("p") + 1e-10})
    return rounded(out, "prior", "p")


@query("diversity", """, h AS (SELECT sample_id, population, avg(CASE WHEN n_alt = 1 THEN 1.0::DOUBLE ELSE 0 END) AS h FROM c GROUP BY ALL), hp AS (SELECT population, count(*) AS n_samples, avg(h) AS het FROM h GROUP BY 1)
 SELECT population, CAST(count(*) AS BIGINT) AS n_sites, CAST(sum(CASE WHEN ref_n > 0 AND alt_n > 0 THEN 1 ELSE 0 END) AS BIGINT) AS segregating, round(avg(within), 6) AS pi, CAST(any_value(n_samples) AS BIGINT) AS n_samples, round(any_value(het), 6) AS het FROM f JOIN hp USING (population) GROUP BY population""")
def diversity(spark, d):
    c = called(spark, d)
    return rounded(population.diversity(counts(c), c), "pi", "het")


@query("heterozygosity", "SELECT sample_id, CAST(count(*) AS BIGINT) AS n_called, round(avg(CASE WHEN n_alt = 1 THEN 1.0::DOUBLE ELSE 0 END) * count(*) / (SELECT sum(b) FROM (SELECT max(pos) - min(pos) AS b FROM sites GROUP BY chrom)) * 1000, 6) AS het_per_kb FROM c GROUP BY 1")
def heterozygosity(spark, d):
    return rounded(quality.heterozygosity_per_kb(called(spark, d)), "het_per_kb")


_HUD = """hu AS (SELECT a.chrom, a.pos, a.population AS pop1, b.population AS pop2, 1 - (a.ref_n * b.ref_n + a.alt_n * b.alt_n) * 1.0::DOUBLE / ((a.ref_n + a.alt_n) * (b.ref_n + b.alt_n)) AS den, (a.within + b.within) / 2 AS w
 FROM f a JOIN f b USING (chrom, pos) WHERE a.population < b.population)"""


@query("fst", f", {_HUD} SELECT pop1, pop2, CAST(count(*) AS BIGINT) AS n_sites, round(sum(den - w) / sum(den), 6) AS fst FROM hu GROUP BY ALL")
def fst(spark, d):
    return rounded(population.fst(freqs(spark, d)), "fst")


_DIST = """ids AS (SELECT DISTINCT sample_id FROM c), di AS (SELECT a.sample_id AS s1, b.sample_id AS s2, sum(abs(coalesce(x.n_alt, 0) - coalesce(y.n_alt, 0))) / (2.0::DOUBLE * count(*)) AS distance FROM ids a JOIN ids b ON a.sample_id < b.sample_id CROSS JOIN seg
 LEFT JOIN c x ON x.chrom = seg.chrom AND x.pos = seg.pos AND x.sample_id = a.sample_id LEFT JOIN c y ON y.chrom = seg.chrom AND y.pos = seg.pos AND y.sample_id = b.sample_id GROUP BY ALL)"""


def _distance(spark, d):
    c = called(spark, d)
    return population.distance(c, quality.segregating(c), c.select("sample_id").distinct())


@query("distance", f", {_DIST} SELECT s1, s2, round(distance, 6) AS distance FROM di")
def distance(spark, d):
    return rounded(_distance(spark, d), "distance")


@query("sfs_folded", "SELECT population, least(ref_n, alt_n) AS minor_count, CAST(count(*) AS BIGINT) AS n_sites FROM f GROUP BY ALL")
def sfs_folded(spark, d):
    return population.folded_spectrum(freqs(spark, d))


_TAJIMA = "CASE WHEN s >= 3 AND n > 2 THEN (diff - s / a1) / sqrt(((n + 1) / (3.0::DOUBLE * (n - 1)) - 1 / a1) / a1 * s + (2.0::DOUBLE * (n * n + n + 3) / (9 * n * (n - 1)) - (n + 2) / (a1 * n) + a2 / (a1 * a1)) / (a1 * a1 + a2) * s * (s - 1)) END"


@query("demography", f""", b AS (SELECT population, max(ref_n + alt_n) AS n, CAST(sum(CASE WHEN ref_n > 0 AND alt_n > 0 THEN 1 ELSE 0 END) AS BIGINT) AS s, sum(within) AS diff, avg(within) AS mean FROM f GROUP BY 1), m AS (SELECT population, 2 * count(DISTINCT sample_id) AS m FROM c GROUP BY 1),
 a AS (SELECT *, list_sum([1.0::DOUBLE / i FOR i IN range(1, n)]) AS a1, list_sum([1.0::DOUBLE / (i * i) FOR i IN range(1, n)]) AS a2, list_sum([1.0::DOUBLE / i FOR i IN range(1, m)]) AS am FROM b JOIN m USING (population))
 SELECT population, CAST(m AS BIGINT) AS n_chromosomes, s AS n_segregating, round(mean, 6) AS mean_difference, round(s / am / 100000, 8) AS theta_w, round(diff / 100000, 8) AS pi, round({_TAJIMA}, 5) AS tajima_d, CAST(floor(diff / 100000 / 4e-8) AS BIGINT) AS ne FROM a""")
def demography(spark, d):
    c = called(spark, d)
    out = rounded(rounded(population.demography(counts(c), c, 100_000, 1e-8), "mean_difference"), "theta_w", "pi", digits=8)
    return longs(rounded(out, "tajima_d", digits=5), "n_chromosomes")


# -- f-statistics -------------------------------------------------------------------------


def _wide_sql(*pops: int) -> str:
    joins = " ".join(f"JOIN f f{i} ON f{i}.chrom = f0.chrom AND f{i}.pos = f0.pos AND f{i}.population = {p}" for i, p in enumerate(pops) if i)
    cols = ", ".join(f"f{i}.p AS p{i}" for i in range(len(pops)))
    return f"w AS (SELECT f0.chrom, f0.pos, {cols} FROM f f0 {joins} WHERE f0.population = {pops[0]})"


_JACK = """j AS (SELECT *, sum(num) OVER w2 AS nn, sum(den) OVER w2 AS dd FROM bs WINDOW w2 AS (PARTITION BY k)), t AS (SELECT *, CASE WHEN dd - den <> 0 THEN (nn - num) / (dd - den) END AS theta FROM j),
 e AS (SELECT k, sum(num) / sum(den) AS estimate, count(theta) AS g, sum(n) AS n_sites, var_pop(theta) AS v FROM t GROUP BY k), r AS (SELECT *, sqrt((g - 1.0::DOUBLE) * v) AS se FROM e)"""
_JOUT = "round(estimate, 6) AS estimate, round(se, 6) AS se, round(estimate / nullif(se, 0), 4) AS z, CAST(g AS BIGINT) AS n_blocks, CAST(n_sites AS BIGINT) AS n_sites"


def _jack_cols(frame: DataFrame, *keys: str) -> DataFrame:
    return frame.select(*keys, F.round("estimate", 6).alias("estimate"), F.round("se", 6).alias("se"), F.round("z", 4).alias("z"), F.col("n_blocks").cast("bigint").alias("n_blocks"), F.col("n_sites").cast("bigint").alias("n_sites"))


_TRIOS = """tr AS (SELECT a.population AS q1, b.population AS q2, c3.population AS q3 FROM (SELECT DISTINCT population FROM f) a, (SELECT DISTINCT population FROM f) b, (SELECT DISTINCT population FROM f) c3
 WHERE a.population < b.population AND c3.population NOT IN (a.population, b.population) AND 4 NOT IN (a.population, b.population, c3.population)),
 ok AS (SELECT chrom, pos FROM f GROUP BY ALL HAVING count(*) = 5), k5 AS (SELECT * FROM f SEMI JOIN ok USING (chrom, pos)),
 x AS (SELECT q1, q2, q3, a.chrom, (1 - a.p) * b.p * c3.p * (1 - o.p) + a.p * (1 - b.p) * (1 - c3.p) * o.p AS abba, a.p * (1 - b.p) * c3.p * (1 - o.p) + (1 - a.p) * b.p * (1 - c3.p) * o.p AS baba
 FROM tr JOIN k5 a ON a.population = q1 JOIN k5 b ON b.population = q2 AND b.chrom = a.chrom AND b.pos = a.pos JOIN k5 c3 ON c3.population = q3 AND c3.chrom = a.chrom AND c3.pos = a.pos JOIN k5 o ON o.population = 4 AND o.chrom = a.chrom AND o.pos = a.pos),
 bs AS (SELECT q1 * 100 + q2 * 10 + q3 AS k, chrom AS block, sum(abba - baba) AS num, sum(abba + baba) AS den, count(*) AS n FROM x GROUP BY ALL)"""


@query("dstats", f", {_TRIOS}, {_JACK} SELECT CAST(k // 100 AS BIGINT) AS p1, CAST(k // 10 % 10 AS BIGINT) AS p2, CAST(k % 10 AS BIGINT) AS p3, {_JOUT} FROM r")
def dstats(spark, d):
    out = fstats.d_statistics(freqs(spark, d), [0, 1, 2, 3, OUT], OUT)
    return longs(_jack_cols(out, "p1", "p2", "p3"), "p1", "p2", "p3")


_ERFC = "u * exp(-y * y - 1.26551223 + u * (1.00002368 + u * (0.37409196 + u * (0.09678418 + u * (-0.18628806 + u * (0.27886807 + u * (-1.13520398 + u * (1.48851587 + u * (-0.82215223 + u * 0.17087277)))))))))"


@query("dstats_bh", f""", {_TRIOS}, {_JACK}, z AS (SELECT k, abs(estimate / se) / sqrt(2.0::DOUBLE) AS y FROM r), zz AS (SELECT *, 1 / (1 + 0.5 * y) AS u FROM z), pp AS (SELECT k, {_ERFC} AS raw FROM zz),
 ps AS (SELECT k, round(raw / pow(10.0, floor(log10(raw)) - 2)) * pow(10.0, floor(log10(raw)) - 2) AS p FROM pp), rk AS (SELECT *, row_number() OVER (ORDER BY p) AS i, count(*) OVER () AS m FROM ps)
 SELECT CAST(k // 100 AS BIGINT) AS p1, CAST(k // 10 % 10 AS BIGINT) AS p2, CAST(k % 10 AS BIGINT) AS p3, round(p, 6) AS p, round(least(1.0, min(p * m / i) OVER (ORDER BY i DESC ROWS UNBOUNDED PRECEDING)), 6) AS q FROM rk""")
def dstats_bh(spark, d):
    out = fstats.with_p(fstats.d_statistics(freqs(spark, d), [0, 1, 2, 3, OUT], OUT))
    return longs(rounded(population.running_q(out).select("p1", "p2", "p3", "p", "q"), "p", "q"), "p1", "p2", "p3")


@query("f4", f", {_wide_sql(0, 1, 2, 4)}, bs AS (SELECT 0 AS k, chrom AS block, sum((p0 - p1) * (p2 - p3)) AS num, count(*) * 1.0::DOUBLE AS den, count(*) AS n FROM w GROUP BY ALL), {_JACK} SELECT {_JOUT} FROM r")
def f4(spark, d):
    return _jack_cols(fstats.f4(freqs(spark, d), 0, 1, 2, OUT))


@query("f4_tiles", f", {_wide_sql(0, 1, 2, 4)}, nt AS (SELECT *, ntile(20) OVER (ORDER BY chrom, pos) AS block FROM w), bs AS (SELECT 0 AS k, block, sum((p0 - p1) * (p2 - p3)) AS num, count(*) * 1.0::DOUBLE AS den, count(*) AS n FROM nt GROUP BY ALL), {_JACK} SELECT {_JOUT} FROM r")
def f4_tiles(spark, d):
    return _jack_cols(fstats.f4(freqs(spark, d), 0, 1, 2, OUT, mode="sites", n_blocks=20))


@query("f4_fixed_blocks", f", {_wide_sql(0, 1, 2, 4)}, bs AS (SELECT 0 AS k, chrom * 100000 + (pos - 1) // 200000 AS block, sum((p0 - p1) * (p2 - p3)) AS num, count(*) * 1.0::DOUBLE AS den, count(*) AS n FROM w GROUP BY ALL), {_JACK} SELECT {_JOUT} FROM r")
def f4_fixed_blocks(spark, d):
    return _jack_cols(fstats.f4(freqs(spark, d), 0, 1, 2, OUT, mode="bp", size_bp=200_000))


@query("f3_matrix", ", x AS (SELECT a.chrom, a.pos, a.population AS i, o.p - a.p AS x FROM f a JOIN f o ON o.chrom = a.chrom AND o.pos = a.pos AND o.population = 4 WHERE a.population <> 4) SELECT a.i, b.i AS j, CAST(count(*) AS BIGINT) AS n_sites, round(avg(a.x * b.x), 6) AS f3 FROM x a JOIN x b USING (chrom, pos) WHERE a.i <= b.i GROUP BY ALL")
def f3_matrix(spark, d):
    return rounded(fstats.f3_matrix(freqs(spark, d), OUT), "f3")


_WJACK = """j AS (SELECT *, sum(num) OVER () AS nn, sum(den) OVER () AS dd, sum(n) OVER () AS ss, count(*) OVER () AS g FROM bs), t AS (SELECT *, ss * 1.0::DOUBLE / n AS h, nn / dd AS theta, (nn - num) / (dd - den) AS minus FROM j),
 u AS (SELECT *, h * theta - (h - 1) * minus AS ps, g * theta - sum((1 - 1 / h) * minus) OVER () AS centre FROM t),
 r AS (SELECT any_value(theta) AS estimate, any_value(g) AS g, any_value(ss) AS n_sites, sqrt(avg(CASE WHEN h > 1 THEN (ps - centre) * (ps - centre) / (h - 1) ELSE 0 END)) AS se FROM u)"""


@query("d_panel", f", {_wide_sql(0, 1, 2, 4)}, bs AS (SELECT chrom AS block, sum((p0 - p1) * (p2 - p3)) AS num, sum((p0 + p1 - 2 * p0 * p1) * (p2 + p3 - 2 * p2 * p3)) AS den, count(*) AS n FROM w GROUP BY ALL), {_WJACK} SELECT {_JOUT} FROM r")
def d_panel(spark, d):
    return _jack_cols(fstats.statistic(freqs(spark, d), [0, 1, 2, OUT], fstats.panel_d_terms, weighted=True))


@query("f4_ratio", f", {_wide_sql(0, 4, 1, 2, 3)}, bs AS (SELECT chrom AS block, sum((p0 - p1) * (p2 - p4)) AS num, sum((p0 - p1) * (p3 - p4)) AS den, count(*) AS n FROM w GROUP BY ALL), {_WJACK} SELECT {_JOUT} FROM r")
def f4_ratio(spark, d):
    out = fstats.f4_ratio(freqs(spark, d), 0, OUT, 1, 2, 3, weighted=True)
    return _jack_cols(out)


@query("paired_f4_diff", f", {_wide_sql(0, 4, 1, 2, 3)}, bs AS (SELECT chrom AS block, sum((p0 - p1) * (p2 - p3)) AS num, sum((p0 - p1) * (p3 - p4)) AS den, count(*) AS n FROM w GROUP BY ALL), {_WJACK} SELECT {_JOUT} FROM r")
def paired_f4_diff(spark, d):
    out = fstats.statistic(freqs(spark, d), [0, OUT, 1, 2, 3], lambda a, o, x, y, c: ((a - o) * (x - y), (a - o) * (y - c)), weighted=True)
    return _jack_cols(out)


def _partitioned_jack(keys: str) -> str:
    """The weighted jackknife of bs(keys, block, num, den, n) for each key."""
    return f"""j AS (SELECT *, sum(num) OVER p AS nn, sum(den) OVER p AS dd, sum(n) OVER p AS ss, count(*) OVER p AS g FROM bs WINDOW p AS (PARTITION BY {keys})), t AS (SELECT *, ss * 1.0::DOUBLE / n AS hh, CASE WHEN abs(dd) > 1e-12 THEN nn / dd END AS theta, CASE WHEN abs(dd - den) > 1e-12 THEN (nn - num) / (dd - den) END AS minus FROM j),
 u AS (SELECT *, hh * theta - (hh - 1) * minus AS ps, g * theta - sum((1 - 1 / hh) * minus) OVER (PARTITION BY {keys}) AS centre FROM t),
 r AS (SELECT {keys}, any_value(theta) AS estimate, any_value(g) AS g, any_value(ss) AS n_sites, sqrt(avg(CASE WHEN hh > 1 THEN (ps - centre) * (ps - centre) / (hh - 1) ELSE 0 END)) AS se FROM u GROUP BY {keys})"""


@query("reference_sets", f""", h AS (SELECT chrom, pos, population * 2 + sample_id % 2 AS k, sum(n_alt) / (2.0::DOUBLE * count(*)) AS p FROM c GROUP BY ALL),
 v AS (SELECT t.k AS target, a.k AS a, b.k AS b, e.k AS c, o.k AS o, chrom, (a.p - o.p) * (t.p - e.p) AS x, (a.p - o.p) * (b.p - e.p) AS y FROM h t JOIN h a USING (chrom, pos) JOIN h b USING (chrom, pos) JOIN h e USING (chrom, pos) JOIN h o USING (chrom, pos) WHERE t.k IN (0, 1) AND a.k IN (2, 3) AND b.k IN (4, 5) AND e.k IN (6, 7) AND o.k IN (8, 9)),
 bs AS (SELECT target, a, b, c, o, chrom AS block, sum(x) AS num, sum(y) AS den, count(*) AS n FROM v GROUP BY target, a, b, c, o, chrom), {_partitioned_jack("target, a, b, c, o")}
 SELECT CAST(target AS VARCHAR) AS target, CAST(a AS VARCHAR) AS a, CAST(b AS VARCHAR) AS b, CAST(c AS VARCHAR) AS c, CAST(o AS VARCHAR) AS o, target IN (0, 1) AND a = 2 AND b = 4 AND c = 6 AND o = 8 AS baseline, round(estimate, 4) AS estimate, round(se, 4) AS se, CAST(g AS BIGINT) AS n_blocks, CAST(n_sites AS BIGINT) AS n_sites FROM r""")
def reference_sets(spark, d):
    halves = called(spark, d).withColumn("population", F.col("population") * 2 + F.col("sample_id") % 2)
    out = studies.reference_rotation(counts(halves), [0, 1], [2, 3], [4, 5], [6, 7], [8, 9], (2, 4, 6, 8))
    return longs(rounded(out.drop("z"), "estimate", "se", digits=4), "n_blocks", "n_sites")


def _cline(name: str) -> str:
    num, den, known = {"ratio": ("(a - o) * (x - c)", "(a - o) * (b - c)", "a + o + x + b + c"), "d": ("(x - b) * (c - o)", "(x + b - 2 * x * b) * (c + o - 2 * c * o)", "x + b + c + o")}[name]
    return f"bs AS (SELECT s, chrom AS block, sum({num}) AS num, sum({den}) AS den, count(*) AS n FROM w WHERE {known} IS NOT NULL GROUP BY ALL), {_partitioned_jack('s')}"


#: Samples of populations 0 and 1 one by one; a sample is left out of population 1, its reference.
@query("ancestry_cline", f""", un AS (SELECT DISTINCT sample_id AS s, population AS g FROM c WHERE population IN (0, 1)),
 m AS (SELECT s, chrom, pos, sum(n_alt) FILTER (population = 3) / (2.0::DOUBLE * count(*) FILTER (population = 3)) AS a, sum(n_alt) FILTER (population = 4) / (2.0::DOUBLE * count(*) FILTER (population = 4)) AS o, sum(n_alt) FILTER (population = 2) / (2.0::DOUBLE * count(*) FILTER (population = 2)) AS c,
 sum(n_alt) FILTER (population = 1 AND sample_id <> s) / (2.0::DOUBLE * count(*) FILTER (population = 1 AND sample_id <> s)) AS b, sum(n_alt) FILTER (sample_id = s) / (2.0::DOUBLE * count(*) FILTER (sample_id = s)) AS x FROM c, un GROUP BY s, chrom, pos),
 w AS (SELECT s, chrom, CASE WHEN isnan(a) THEN NULL ELSE a END AS a, CASE WHEN isnan(o) THEN NULL ELSE o END AS o, CASE WHEN isnan(c) THEN NULL ELSE c END AS c, CASE WHEN isnan(b) THEN NULL ELSE b END AS b, CASE WHEN isnan(x) THEN NULL ELSE x END AS x FROM m),
 r1 AS (WITH {_cline("ratio")} SELECT * FROM r), r2 AS (WITH {_cline("d")} SELECT * FROM r)
 SELECT CAST(un.s AS VARCHAR) AS unit, CAST(un.g AS BIGINT) AS grp, round(r1.estimate, 4) AS ratio, round(r1.se, 4) AS ratio_se, CAST(r1.n_sites AS BIGINT) AS ratio_sites, round(r2.estimate, 4) AS d, round(r2.se, 4) AS d_se, CAST(r2.n_sites AS BIGINT) AS d_sites FROM (SELECT s, g FROM un) un LEFT JOIN r1 USING (s) LEFT JOIN r2 USING (s)""")
def ancestry_cline(spark, d):
    c = called(spark, d)
    groups: dict[str, list[str]] = {}
    for r in c.select("population", "sample_id").distinct().collect():
        groups.setdefault(str(r["population"]), []).append(str(r["sample_id"]))
    units = studies.cline_units(groups, {"A": "3", "O": "4", "B": "1", "C": "2"}, [], ["0", "1"])
    out = studies.ancestry_cline({"all": c}, units)
    cols = {"ratio": "ratio_estimate_all", "ratio_se": "ratio_se_all", "d": "d_estimate_all", "d_se": "d_se_all"}
    return out.select("unit", F.col("group").cast("bigint").alias("grp"), *[F.round(v, 4).alias(k) for k, v in cols.items()], F.col("ratio_n_sites_all").cast("bigint").alias("ratio_sites"), F.col("d_n_sites_all").cast("bigint").alias("d_sites"))


@query("auto_outgroup", "SELECT a.population, round(avg(abs(a.p - b.p)), 6) AS difference FROM f a JOIN f b USING (chrom, pos) WHERE a.population <> b.population GROUP BY 1")
def auto_outgroup(spark, d):
    return rounded(fstats.auto_outgroup(freqs(spark, d)), "difference")


@query("fd_windows", f""", {_wide_sql(0, 1, 2, 4)}, fi AS (SELECT chrom, min(pos) AS first FROM w GROUP BY 1), x AS (SELECT w.*, first, (pos - first) // 100000 AS k, greatest(p1, p2) AS dn FROM w JOIN fi USING (chrom)),
 y AS (SELECT chrom, first + k * 100000 AS start, count(*) AS n_sites, sum((1 - p0) * p1 * p2 * (1 - p3) + p0 * (1 - p1) * (1 - p2) * p3 - p0 * (1 - p1) * p2 * (1 - p3) - (1 - p0) * p1 * (1 - p2) * p3) AS num,
 sum((1 - p0) * dn * dn * (1 - p3) + p0 * (1 - dn) * (1 - dn) * p3 - p0 * (1 - dn) * dn * (1 - p3) - (1 - p0) * dn * (1 - dn) * p3) AS den FROM x GROUP BY ALL HAVING count(*) >= 3)
 SELECT chrom, CAST(start AS BIGINT) AS start, CAST(start + 100000 AS BIGINT) AS "end", CAST(n_sites AS BIGINT) AS n_sites, round(num / den, 4) AS f_d FROM y WHERE abs(den) > 1e-12""")
def fd_windows(spark, d):
    out = fstats.fd_windows(freqs(spark, d), [0, 1, 2, OUT], 100_000, 3)
    return longs(rounded(out.filter("f_d is not null"), "f_d", digits=4), "start", "end", "n_sites")


# -- windows ------------------------------------------------------------------------------


@query("roh", """, sp AS (SELECT chrom, min(pos) AS first, max(pos) AS last FROM sites GROUP BY 1), o AS (SELECT sample_id, c.chrom, (pos - first) // 50000 AS w, avg(CASE WHEN n_alt = 1 THEN 1.0::DOUBLE ELSE 0 END) AS het FROM c JOIN sp USING (chrom) GROUP BY ALL HAVING avg(CASE WHEN n_alt = 1 THEN 1.0::DOUBLE ELSE 0 END) <= 0.02),
 i AS (SELECT *, w - row_number() OVER (PARTITION BY sample_id, chrom ORDER BY w) AS k FROM o), ru AS (SELECT sample_id, i.chrom, min(w) AS a, max(w) AS b FROM i GROUP BY sample_id, i.chrom, k),
 e AS (SELECT sample_id, first + a * 50000 AS s, CASE WHEN b >= (last - first) // 50000 THEN last ELSE first + (b + 1) * 50000 END AS t FROM ru JOIN sp USING (chrom)), k AS (SELECT sample_id, sum(t - s) AS bp, count(*) AS n FROM e WHERE t - s >= 100000 GROUP BY 1)
 SELECT ids.sample_id, CAST(coalesce(bp, 0) AS BIGINT) AS roh_bp, CAST(coalesce(n, 0) AS BIGINT) AS segments, round(coalesce(bp, 0) * 1.0::DOUBLE / (SELECT sum(last - first) FROM sp), 6) AS f_roh FROM (SELECT DISTINCT sample_id FROM c) ids LEFT JOIN k USING (sample_id)""")
def roh(spark, d):
    c = called(spark, d)
    out = windows.roh_summary(c, c.select(*SITE).distinct(), window_bp=50_000, min_bp=100_000)
    return longs(rounded(out, "f_roh"), "roh_bp", "segments")


def _pbs_t(i: int) -> str:
    return f"-ln(1 - least(greatest(n{i} / d{i}, 0), 0.9999))"


@query("pbs_windows", f""", {_HUD}, fi AS (SELECT chrom, min(pos) AS first FROM f GROUP BY 1), x AS (SELECT hu.chrom, (pos - first) // 100000 AS w, any_value(first) AS first, """ + ", ".join(f"sum(CASE WHEN pop1 = {p} AND pop2 = {q} THEN den - w END) AS n{i}, sum(CASE WHEN pop1 = {p} AND pop2 = {q} THEN den END) AS d{i}" for i, (p, q) in enumerate(((0, 1), (0, 2), (1, 2)))) + """ FROM hu JOIN fi USING (chrom) GROUP BY ALL),
 mx AS (SELECT chrom, max(ref_n + alt_n) AS n FROM f WHERE population = 0 GROUP BY 1), td AS (SELECT f.chrom, (pos - first) // 100000 AS w, any_value(mx.n) AS n, count(*) AS n_sites, sum(CASE WHEN ref_n > 0 AND alt_n > 0 THEN 1 ELSE 0 END) AS s, sum(within) AS diff FROM f JOIN fi USING (chrom) JOIN mx ON mx.chrom = f.chrom WHERE population = 0 GROUP BY ALL),
 ta AS (SELECT *, list_sum([1.0::DOUBLE / i FOR i IN range(1, n)]) AS a1, list_sum([1.0::DOUBLE / (i * i) FOR i IN range(1, n)]) AS a2 FROM td)
 """ + f"SELECT x.chrom, CAST(first + x.w * 100000 AS BIGINT) AS start, CAST(n_sites AS BIGINT) AS n_sites, round(({_pbs_t(0)} + {_pbs_t(1)} - ({_pbs_t(2)})) / 2, 5) AS pbs, round({_TAJIMA}, 5) AS tajima_d FROM x JOIN ta USING (chrom, w) WHERE d0 > 1e-9 AND d1 > 1e-9 AND d2 > 1e-9")
def pbs_windows(spark, d):
    out = windows.pbs_windows(freqs(spark, d), [0, 1, 2], 100_000).filter("pbs is not null")
    return longs(rounded(out, "pbs", "tajima_d", digits=5), "start", "n_sites")


@query("window_emissions", """, sp AS (SELECT chrom, min(pos) AS first FROM sites GROUP BY 1), o AS (SELECT c.sample_id, c.chrom, first + (c.pos - first) // 200000 * 200000 AS start, n_alt, least(greatest(coalesce(a.p, 0.5), 1e-6), 1 - 1e-6) AS q0, least(greatest(coalesce(b.p, 0.5), 1e-6), 1 - 1e-6) AS q1 FROM c JOIN sp USING (chrom)
 LEFT JOIN f a ON a.chrom = c.chrom AND a.pos = c.pos AND a.population = 0 LEFT JOIN f b ON b.chrom = c.chrom AND b.pos = c.pos AND b.population = 1 WHERE c.population = 2)
 SELECT sample_id, chrom, CAST(start AS BIGINT) AS start, CAST(count(*) AS BIGINT) AS n_sites, round(sum(CASE n_alt WHEN 0 THEN 2 * ln(1 - q0) WHEN 2 THEN 2 * ln(q0) ELSE ln(2 * q0 * (1 - q0)) END), 6) AS l0, round(sum(CASE n_alt WHEN 0 THEN 2 * ln(1 - q1) WHEN 2 THEN 2 * ln(q1) ELSE ln(2 * q1 * (1 - q1)) END), 6) AS l1 FROM o GROUP BY ALL HAVING count(*) >= 3""")
def window_emissions(spark, d):
    c = called(spark, d)
    out = windows.emissions(c, counts(c), [0, 1], [2], 200_000, 3)
    return longs(rounded(out.select("sample_id", "chrom", "start", "n_sites", "l0", "l1"), "l0", "l1"), "start", "n_sites")


#: The path of most likely sources as a recursion that carries the best path to each source.
_STAY, _MOVE = "ln(1 - 0.02::DOUBLE)", "ln(0.02::DOUBLE)"
_PATHS = f""", sp AS (SELECT chrom, min(pos) AS first FROM sites GROUP BY 1), o AS (SELECT c.sample_id, c.chrom, (c.pos - first) // 200000 AS w, n_alt, least(greatest(coalesce(a.p, 0.5), 1e-6), 1 - 1e-6) AS q0, least(greatest(coalesce(b.p, 0.5), 1e-6), 1 - 1e-6) AS q1 FROM c JOIN sp USING (chrom)
 LEFT JOIN f a ON a.chrom = c.chrom AND a.pos = c.pos AND a.population = 0 LEFT JOIN f b ON b.chrom = c.chrom AND b.pos = c.pos AND b.population = 1 WHERE c.population = 2),
 em AS (SELECT sample_id, chrom, w, sum(CASE n_alt WHEN 0 THEN 2 * ln(1 - q0) WHEN 2 THEN 2 * ln(q0) ELSE ln(2 * q0 * (1 - q0)) END) AS l0, sum(CASE n_alt WHEN 0 THEN 2 * ln(1 - q1) WHEN 2 THEN 2 * ln(q1) ELSE ln(2 * q1 * (1 - q1)) END) AS l1 FROM o GROUP BY ALL HAVING count(*) >= 3),
 nu AS (SELECT *, row_number() OVER (PARTITION BY sample_id, chrom ORDER BY w) AS i FROM em),
 vi AS (SELECT sample_id, chrom, i, l0 AS s0, l1 AS s1, [0] AS p0, [1] AS p1 FROM nu WHERE i = 1 UNION ALL
 SELECT vi.sample_id, vi.chrom, nu.i, greatest(s0 + {_STAY}, s1 + {_MOVE}) + l0, greatest(s0 + {_MOVE}, s1 + {_STAY}) + l1, list_append(CASE WHEN s0 + {_STAY} >= s1 + {_MOVE} THEN p0 ELSE p1 END, 0), list_append(CASE WHEN s0 + {_MOVE} >= s1 + {_STAY} THEN p0 ELSE p1 END, 1) FROM vi JOIN nu ON nu.sample_id = vi.sample_id AND nu.chrom = vi.chrom AND nu.i = vi.i + 1),
 en AS (SELECT sample_id, chrom, arg_max(CASE WHEN s0 >= s1 THEN p0 ELSE p1 END, i) AS p FROM vi GROUP BY ALL), wi AS (SELECT sample_id, unnest(p) AS a FROM en)
 SELECT sample_id, CAST(count(*) AS BIGINT) AS n_windows, round_even(avg(CASE WHEN a = 0 THEN 1.0::DOUBLE ELSE 0 END), 4) AS frac_0, round_even(avg(CASE WHEN a = 1 THEN 1.0::DOUBLE ELSE 0 END), 4) AS frac_1 FROM wi GROUP BY 1"""


@query("local_ancestry", _PATHS)
def local_ancestry(spark, d):
    c = called(spark, d)
    paths = windows.local_ancestry(windows.emissions(c, counts(c), [0, 1], [2], 200_000, 3), [0, 1])
    return windows.ancestry_fractions(paths, [0, 1])


@query("ld_pairs", """SELECT * FROM (SELECT a.chrom, a.pos AS pos1, b.pos AS pos2, CAST(count(*) AS BIGINT) AS n, round(CASE WHEN count(*) * sum(a.n_alt * a.n_alt) > sum(a.n_alt) * sum(a.n_alt) AND count(*) * sum(b.n_alt * b.n_alt) > sum(b.n_alt) * sum(b.n_alt) THEN
 pow(count(*) * sum(a.n_alt * b.n_alt) - sum(a.n_alt) * sum(b.n_alt), 2) * 1.0::DOUBLE / ((count(*) * sum(a.n_alt * a.n_alt) - sum(a.n_alt) * sum(a.n_alt)) * (count(*) * sum(b.n_alt * b.n_alt) - sum(b.n_alt) * sum(b.n_alt))) END, 6) AS r2
 FROM c a JOIN c b ON a.chrom = b.chrom AND a.sample_id = b.sample_id AND b.pos > a.pos AND b.pos - a.pos <= 50000 GROUP BY ALL HAVING count(*) >= 4)""")
def ld_pairs(spark, d):
    return longs(rounded(windows.ld_pairs(called(spark, d), 50_000), "r2"), "n")


#: Greedy choice as a recursion over each contig's sites, by the list of those kept so far.
_PRUNE = """, d AS (SELECT chrom, pos, sample_id, n_alt - avg(n_alt) OVER (PARTITION BY chrom, pos) AS x FROM c), v AS (SELECT chrom, pos, sum(x * x) AS ss, row_number() OVER (PARTITION BY chrom ORDER BY pos) AS i FROM d GROUP BY chrom, pos),
 pr AS (SELECT b.chrom, b.pos, a.pos AS before, sum(a.x * b.x) AS s FROM d a JOIN d b ON a.chrom = b.chrom AND a.sample_id = b.sample_id AND a.pos < b.pos AND b.pos - a.pos <= 100000 GROUP BY ALL),
 bad AS (SELECT v.chrom, v.i, list(w.i) AS js FROM pr JOIN v ON v.chrom = pr.chrom AND v.pos = pr.pos JOIN v w ON w.chrom = pr.chrom AND w.pos = pr.before WHERE v.ss > 1e-12 AND w.ss > 1e-12 AND pr.s * pr.s / (v.ss * w.ss) >= 0.2 GROUP BY ALL),
 steps AS (SELECT v.chrom, v.i, coalesce(js, []::BIGINT[]) AS js FROM v LEFT JOIN bad USING (chrom, i)),
 go AS (SELECT chrom, 0::BIGINT AS i, []::BIGINT[] AS kept FROM v GROUP BY chrom UNION ALL SELECT go.chrom, steps.i, CASE WHEN list_has_any(kept, js) THEN kept ELSE list_append(kept, steps.i) END FROM go JOIN steps ON steps.chrom = go.chrom AND steps.i = go.i + 1),
 ends AS (SELECT chrom, arg_max(kept, i) AS kept FROM go GROUP BY chrom)
 SELECT v.chrom, v.pos FROM v JOIN ends USING (chrom) WHERE list_contains(kept, v.i)"""


@query("ld_prune", _PRUNE)
def ld_prune(spark, d):
    return windows.ld_prune(called(spark, d), 25, 100_000, 0.2, list(range(25)))


@query("scatter_intervals", "--rawSELECT CAST(p_size AS BIGINT) AS chrom, CAST(s AS BIGINT) AS start, CAST(least(s + 1000, n) AS BIGINT) AS \"end\" FROM (SELECT p_size, count(*) * 37 AS n FROM part GROUP BY 1), unnest(range(0, n, 1000)) AS t(s)")
def scatter_intervals(spark, d):
    contigs = table(spark, d, "part").groupBy(F.col("p_size").cast("bigint").alias("chrom")).agg((F.count(F.lit(1)) * 37).alias("length"))
    return windows.scatter(contigs, 1000)


# -- mixture, assignment ------------------------------------------------------------------


@query("dog_fraction", """, lo AS (SELECT a.chrom, a.pos, a.p AS s, b.p AS b FROM f a JOIN f b USING (chrom, pos) WHERE a.population = 0 AND b.population = 1 AND abs(a.p - b.p) >= 0.4),
 x AS (SELECT sample_id, count(*) AS n, sum((n_alt / 2.0::DOUBLE - b) * (s - b)) AS gd, sum((s - b) * (s - b)) AS dd, sum((n_alt / 2.0::DOUBLE - b) * (n_alt / 2.0::DOUBLE - b)) AS gg FROM c JOIN lo USING (chrom, pos) GROUP BY 1), y AS (SELECT *, CASE WHEN n >= 20 THEN least(greatest(gd / dd, 0), 1) END AS fr FROM x)
 SELECT sample_id, CAST(n AS BIGINT) AS n_loci, round(fr, 6) AS fraction, round(sqrt(greatest(gg - 2 * fr * gd + fr * fr * dd, 0) / n), 6) AS rmse FROM y""")
def dog_fraction(spark, d):
    c = called(spark, d)
    return rounded(mixture.source_fraction(c, counts(c), 0, 1), "fraction", "rmse")


_LL = "CASE n_alt WHEN 0 THEN 2 * ln(1 - q) WHEN 2 THEN 2 * ln(q) ELSE ln(2 * q * (1 - q)) END"


@query("breed_loglik", f""", nl AS (SELECT count(*) AS n FROM sites), po AS (SELECT chrom, pos, sum(alt_n) * 1.0::DOUBLE / sum(ref_n + alt_n) AS p FROM f GROUP BY ALL), x AS (SELECT sample_id, f.population AS panel, n_alt, least(greatest(p, 1e-4), 1 - 1e-4) AS q FROM c JOIN f USING (chrom, pos)),
 y AS (SELECT sample_id, panel, count(*) AS n_loci, sum({_LL}) AS loglik FROM x GROUP BY ALL HAVING count(*) >= 0.2 * (SELECT n FROM nl)), px AS (SELECT sample_id, n_alt, least(greatest(p, 1e-4), 1 - 1e-4) AS q FROM c JOIN po USING (chrom, pos)), py AS (SELECT sample_id, sum({_LL}) AS any_ll FROM px GROUP BY 1),
 z AS (SELECT *, row_number() OVER w AS rank, loglik - lead(loglik) OVER w AS gap_to_next, max(loglik) OVER (PARTITION BY sample_id) AS best FROM y WINDOW w AS (PARTITION BY sample_id ORDER BY loglik DESC, panel DESC))
 SELECT sample_id, panel, CAST(n_loci AS BIGINT) AS n_loci, CAST(rank AS BIGINT) AS rank, round(loglik, 4) AS loglik, round(gap_to_next, 4) AS gap_to_next, round(any_ll, 4) AS any_loglik, round(best - any_ll, 4) AS gap, best - any_ll > 5 AS single FROM z JOIN py USING (sample_id) WHERE rank <= 3""")
def breed_loglik(spark, d):
    c = called(spark, d)
    f = counts(c)
    pooled = f.groupBy(*SITE).agg((F.sum("alt_n") / F.sum(F.col("ref_n") + F.col("alt_n"))).alias("p"))
    out = mixture.candidate_scores(c, f, pooled, n_sites(c), 3, least_share=0.2)
    return longs(rounded(out, "loglik", "gap_to_next", "any_loglik", "gap", digits=4), "rank")


@query("loo_assign", """, x AS (SELECT c.sample_id, c.population, f.population AS panel, n_alt, n_called - CAST(c.population = f.population AS INT) AS n, alt_n - CAST(c.population = f.population AS INT) * n_alt AS alt FROM c JOIN f USING (chrom, pos)),
 y AS (SELECT *, least(greatest((alt + 1) / (2.0::DOUBLE * n + 2), 1e-4), 1 - 1e-4) AS q FROM x WHERE n > 0), """ + f"z AS (SELECT sample_id, population, panel, count(*) AS n_loci, sum({_LL}) AS ll FROM y GROUP BY ALL HAVING count(*) >= 0.2 * (SELECT count(*) FROM sites)), " + """k AS (SELECT *, row_number() OVER w AS rk, ll - lead(ll) OVER w AS gap FROM z WINDOW w AS (PARTITION BY sample_id ORDER BY ll DESC, panel DESC))
 SELECT sample_id, population, panel AS assigned, round(gap, 4) AS gap, population = panel AS correct FROM k WHERE rk = 1""")
def loo_assign(spark, d):
    c = called(spark, d)
    return rounded(mixture.leave_one_out(c, n_sites(c), 0.2), "gap", digits=4)


_GRID_LL = "CASE n_alt WHEN 0 THEN 2 * ln(1 - q) WHEN 2 THEN 2 * ln(q) ELSE ln(2 * q * (1 - q)) END"


@query("mixture_grid", """, lo AS (SELECT a.chrom, a.pos, a.p AS b, x.p AS x FROM f a JOIN f x USING (chrom, pos) WHERE a.population = 1 AND x.population = 0 AND abs(a.p - x.p) >= 0.15), o AS (SELECT sample_id, n_alt, i, least(greatest(b * ((100 - i) / 100.0::DOUBLE) + x * (i / 100.0::DOUBLE), 1e-4), 1 - 1e-4) AS q FROM c JOIN lo USING (chrom, pos), range(0, 101) r(i)),
 """ + f"y AS (SELECT sample_id, i, count(*) AS n_loci, sum({_GRID_LL}) AS ll FROM o GROUP BY ALL), z AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY ll DESC, i) AS rk FROM y) SELECT sample_id, CAST(n_loci AS BIGINT) AS n_loci, round(i / 100.0::DOUBLE, 4) AS share_one, round(ll, 4) AS loglik FROM z WHERE rk = 1")
def mixture_grid(spark, d):
    c = called(spark, d)
    return rounded(mixture.mixture_grid(c, counts(c), 1, 0, step=0.01), "share_one", "loglik", digits=4)


@query("mixture_grid_3way", """, lo AS (SELECT a.chrom, a.pos, a.p AS b, x.p AS x, y.p AS y FROM f a JOIN f x USING (chrom, pos) JOIN f y USING (chrom, pos) WHERE a.population = 2 AND x.population = 0 AND y.population = 1 AND (abs(a.p - x.p) >= 0.15 OR abs(a.p - y.p) >= 0.15)),
 gr AS (SELECT i, j FROM range(0, 101) r(i), range(0, 101) s(j) WHERE i + j <= 100), o AS (SELECT sample_id, n_alt, i, j, least(greatest(b * ((100 - i - j) / 100.0::DOUBLE) + x * (i / 100.0::DOUBLE) + y * (j / 100.0::DOUBLE), 1e-4), 1 - 1e-4) AS q FROM c JOIN lo USING (chrom, pos), gr),
 """ + f"t AS (SELECT sample_id, i, j, count(*) AS n_loci, sum({_GRID_LL}) AS ll FROM o GROUP BY ALL), z AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY ll DESC, i, j) AS rk FROM t) SELECT sample_id, CAST(n_loci AS BIGINT) AS n_loci, round(i / 100.0::DOUBLE, 4) AS share_one, round(j / 100.0::DOUBLE, 4) AS share_two, round(ll, 4) AS loglik FROM z WHERE rk = 1")
def mixture_grid_3way(spark, d):
    c = called(spark, d)
    return rounded(mixture.mixture_grid(c, counts(c), 2, 0, 1, step=0.01), "share_one", "share_two", "loglik", digits=4)


@query("bootstrap_ci")
def bootstrap_ci(spark, d):
    c = called(spark, d)
    return mixture.bootstrap_interval(c, counts(c), 0, 1, reps=50, seed=7)


@query("pedigree_verdict", """, lo AS (SELECT a.chrom, a.pos, a.p AS s, b.p AS b FROM f a JOIN f b USING (chrom, pos) WHERE a.population = 0 AND b.population = 1 AND abs(a.p - b.p) >= 0.4),
 x AS (SELECT sample_id, CASE WHEN count(*) >= 20 THEN least(greatest(sum((n_alt / 2.0::DOUBLE - b) * (s - b)) / sum((s - b) * (s - b)), 0), 1) END AS fr FROM c JOIN lo USING (chrom, pos) GROUP BY 1),
 v AS (SELECT coalesce(abs(max(CASE WHEN sample_id = 3 THEN fr END) - 0.46) <= 0.2, false) AS f1, coalesce(max(CASE WHEN sample_id = 1 THEN fr END) <= 0.2, false) AS parent, coalesce(max(CASE WHEN sample_id = 2 THEN fr END) BETWEEN 0.08 AND 0.45, false) AS offspring FROM x) SELECT *, f1 AND parent AND offspring AS supported FROM v""")
def pedigree_verdict(spark, d):
    c = called(spark, d)
    return mixture.pedigree_verdict(mixture.source_fraction(c, counts(c), 0, 1), 3, 1, [2])


# -- harmonising, names, geography --------------------------------------------------------

_BASES = "['A','C','G','T']"


def _study(spark, d, shift: int) -> DataFrame:
    bases = F.array(*[F.lit(x) for x in "ACGT"])
    key = F.col("p_partkey")
    ref = F.element_at(bases, (key % 4 + 1).cast("int"))
    alt = F.element_at(bases, ((key % 4 + 1 + key % 3) % 4 + 1).cast("int"))
    swap, flip = (key % 5 == shift), (key % 7 == shift)
    r, a = F.when(swap, alt).otherwise(ref), F.when(swap, ref).otherwise(alt)
    r, a = F.when(flip, strings.complement(r)).otherwise(r), F.when(flip, strings.complement(a)).otherwise(a)
    chrom = F.concat(F.lit("chr") if shift else F.lit(""), (key % 38 + 1).cast("string"))
    rows = table(spark, d, "part").filter(key % 11 != shift).select(chrom.alias("chrom"), key.cast("bigint").alias("pos"), F.lower(r).alias("ref") if shift else r.alias("ref"), a.alias("alt"))
    return harmonize.normalized(rows)


def _study_sql(shift: int) -> str:
    ref, alt = f"{_BASES}[p_partkey % 4 + 1]", f"{_BASES}[(p_partkey % 4 + 1 + p_partkey % 3) % 4 + 1]"
    r = f"CASE WHEN p_partkey % 5 = {shift} THEN {alt} ELSE {ref} END"
    a = f"CASE WHEN p_partkey % 5 = {shift} THEN {ref} ELSE {alt} END"
    comp = lambda x: f"CASE WHEN p_partkey % 7 = {shift} THEN translate({x}, 'ACGT', 'TGCA') ELSE {x} END"
    return f"(SELECT CAST(p_partkey % 38 + 1 AS VARCHAR) AS chrom, CAST(p_partkey AS BIGINT) AS pos, {comp(r)} AS ref, {comp(a)} AS alt FROM part WHERE p_partkey % 11 <> {shift})"


def _orient_sql(r0: str, a0: str, r: str, a: str) -> str:
    c = lambda x: f"translate({x}, 'ACGT', 'TGCA')"
    return f"CASE WHEN {r} = {r0} AND {a} = {a0} THEN 'same' WHEN {r} = {a0} AND {a} = {r0} THEN 'swap' WHEN {c(r)} <> {a} AND {c(r)} = {r0} AND {c(a)} = {a0} THEN 'complement' WHEN {c(r)} <> {a} AND {c(r)} = {a0} AND {c(a)} = {r0} THEN 'complement_swap' END"


@query("harmonize", f"--rawSELECT a.chrom, a.pos, a.ref, a.alt, {_orient_sql('a.ref', 'a.alt', 'b.ref', 'b.alt')} AS o1, {_orient_sql('a.ref', 'a.alt', 'e.ref', 'e.alt')} AS o2 FROM {_study_sql(0)} a JOIN {_study_sql(1)} b USING (chrom, pos) JOIN {_study_sql(2)} e USING (chrom, pos) WHERE o1 IS NOT NULL AND o2 IS NOT NULL")
def harmonized(spark, d):
    return harmonize.shared_sites([_study(spark, d, i) for i in range(3)])


@query("orientation", f"--rawSELECT orientation, CAST(count(*) AS BIGINT) AS n FROM (SELECT coalesce({_orient_sql('a.ref', 'a.alt', 'b.ref', 'b.alt')}, 'incompatible') AS orientation FROM {_study_sql(0)} a JOIN {_study_sql(1)} b USING (chrom, pos)) GROUP BY 1")
def orientation(spark, d):
    return harmonize.orientation_report(_study(spark, d, 0), _study(spark, d, 1))


@query("batch_diagnostics", "SELECT batch, CAST(count(*) AS BIGINT) AS n_samples, round(avg(rate), 6) AS mean_rate, round(min(rate), 6) AS min_rate FROM (SELECT site_ord % 3 AS batch, sample_id, count(*) * 1.0::DOUBLE / (SELECT count(*) FROM sites) AS rate FROM c GROUP BY ALL) GROUP BY 1")
def batch_diagnostics(spark, d):
    c = called(spark, d).withColumn("batch", F.col("site_ord") % 3)
    return rounded(harmonize.batch_diagnostics(c, "batch", n_sites(c)), "mean_rate", "min_rate")


@query("name_groups", """--rawSELECT kind, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT grp) AS BIGINT) AS n_groups FROM (SELECT grp, CASE WHEN grp = 'IrishWolfhound' THEN 'breed' WHEN regexp_matches(lower(grp), 'coyote|wolf|jackal|fox|dhole|lycaon|wilddog|dingo|ngsd|newguineasinging') THEN 'wild'
 WHEN starts_with(grp, 'VillDog_') OR contains(lower(grp), 'indigenousdog') OR grp IN ('PER', 'BAN') THEN 'village' WHEN grp = 'CFA.' THEN 'ambiguous' WHEN regexp_matches(lower(grp), 'mix|unknown') THEN 'mixed' WHEN regexp_matches(grp, '[0-9]') OR length(grp) <= 3 OR grp = 'Helsinki_BC' THEN 'ambiguous' ELSE 'breed' END AS kind
 FROM (SELECT regexp_replace(['GrayWolf', 'VillDog_A', 'PoodleMix', 'Boxer', 'PER', 'BC', 'IrishWolfhound', 'CFA.', 'B2x', 'Helsinki_BC'][p_partkey % 10 + 1] || p_partkey, '[0-9]+$', '') AS grp FROM part)) GROUP BY 1""")
def name_groups(spark, d):
    names = F.array(*[F.lit(x) for x in ("GrayWolf", "VillDog_A", "PoodleMix", "Boxer", "PER", "BC", "IrishWolfhound", "CFA.", "B2x", "Helsinki_BC")])
    grp = strings.group_name(F.concat(F.element_at(names, (F.col("p_partkey") % 10 + 1).cast("int")), F.col("p_partkey").cast("string")))
    each = table(spark, d, "part").select(grp.alias("grp")).withColumn("kind", strings.group_kind(F.col("grp")))
    return each.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("grp").alias("n_groups"))


@query("gt_parse", "--rawSELECT CAST(l_orderkey AS BIGINT) AS k, CAST(l_linenumber AS BIGINT) AS j, CAST(CASE WHEN regexp_matches(gt, '^[01][/|][01]$') THEN CAST(gt[1] AS INT) + CAST(gt[3] AS INT) END AS BIGINT) AS n_alt, CAST(CASE WHEN regexp_matches(gt, '^[01][/|][01]$') AND l_quantity >= 20 THEN CAST(gt[1] AS INT) + CAST(gt[3] AS INT) END AS BIGINT) AS n_alt_gq FROM (SELECT *, ['0/0', '0/1', '1|1', './.', '1', '0/2'][l_linenumber % 6 + 1] AS gt FROM lineitem)")
def gt_parse(spark, d):
    gts = F.array(*[F.lit(x) for x in ("0/0", "0/1", "1|1", "./.", "1", "0/2")])
    field = F.concat_ws(":", F.element_at(gts, (F.col("l_linenumber") % 6 + 1).cast("int")), F.col("l_quantity").cast("string"))
    rows = table(spark, d, "lineitem").select(F.col("l_orderkey").cast("bigint").alias("k"), F.col("l_linenumber").cast("bigint").alias("j"), field.alias("field"))
    return rows.select("k", "j", strings.genotype(F.col("field")).cast("bigint").alias("n_alt"), strings.genotype_where(F.col("field"), F.lit("GT:GQ"), 20).cast("bigint").alias("n_alt_gq"))


def _places(spark, d) -> DataFrame:
    key = F.col("n_nationkey").cast("bigint")
    return table(spark, d, "nation").select(key.alias("sample_id"), (key * 7 % 120 - 60).cast("double").alias("lat"), (key * 31 % 340 - 170).cast("double").alias("lon"), F.col("n_regionkey").cast("bigint").alias("region"))


_PLACES = "pl AS (SELECT CAST(n_nationkey AS BIGINT) AS sample_id, radians(CAST(n_nationkey * 7 % 120 - 60 AS DOUBLE)) AS la, radians(CAST(n_nationkey * 31 % 340 - 170 AS DOUBLE)) AS lo FROM nation), km AS (SELECT a.sample_id AS s1, b.sample_id AS s2, 2 * 6371.0088 * asin(sqrt(least(1.0, pow(sin((b.la - a.la) / 2), 2) + cos(a.la) * cos(b.la) * pow(sin((b.lo - a.lo) / 2), 2)))) AS km FROM pl a JOIN pl b ON a.sample_id < b.sample_id)"


@query("haversine_pairs", f"--rawWITH {_PLACES} SELECT s1, s2, round(km, 4) AS km FROM km")
def haversine_pairs(spark, d):
    return rounded(population.haversine(_places(spark, d)), "km", digits=4)


@query("mantel_r", f", {_PLACES}, {_DIST} SELECT round(corr(distance, km), 6) AS r, round(regr_slope(distance, km) * 1e6, 4) AS slope_1e6, round(regr_intercept(distance, km), 6) AS intercept FROM di JOIN km USING (s1, s2)")
def mantel_r(spark, d):
    out = population.mantel_r(_distance(spark, d), population.haversine(_places(spark, d)), "distance", "km")
    return out.select(F.round("r", 6).alias("r"), F.round(F.col("slope") * 1e6, 4).alias("slope_1e6"), F.round("intercept", 6).alias("intercept"))


@query("mantel_p")
def mantel_p(spark, d):
    _, a = matrix.square(_distance(spark, d), "s1", "s2", "distance")
    _, b = matrix.square(population.haversine(_places(spark, d)), "s1", "s2", "km")
    r, p = matrix.mantel(a, b[: len(a), : len(a)], 199)
    return spark.createDataFrame([(float(r), float(p))], "r double, p double")


@query("regional_mean", "SELECT population AS region, round(avg(fr), 4) AS mean_het, CAST(count(*) AS BIGINT) AS n FROM (SELECT population, sample_id, avg(CASE WHEN n_alt = 1 THEN 1.0::DOUBLE ELSE 0 END) AS fr FROM c GROUP BY ALL) GROUP BY 1")
def regional_mean(spark, d):
    per = called(spark, d).groupBy("sample_id").agg(F.avg((F.col("n_alt") == 1).cast("double")).alias("fr"))
    own = per.join(F.broadcast(_places(spark, d).select("sample_id", "region")), "sample_id", "left")
    return own.groupBy("region").agg(F.round(F.avg("fr"), 4).alias("mean_het"), F.count(F.lit(1)).alias("n"))


@query("cluster_ari", ", l AS (SELECT sample_id, any_value(population) AS a, sample_id % 4 AS b FROM c GROUP BY 1), ce AS (SELECT a, b, count(*) AS n FROM l GROUP BY ALL), t AS (SELECT (SELECT sum(n * (n - 1) / 2.0::DOUBLE) FROM ce) AS ij, (SELECT sum(m * (m - 1) / 2.0::DOUBLE) FROM (SELECT sum(n) AS m FROM ce GROUP BY a)) AS i, (SELECT sum(m * (m - 1) / 2.0::DOUBLE) FROM (SELECT sum(n) AS m FROM ce GROUP BY b)) AS j, (SELECT sum(n) FROM ce) AS n) SELECT round((ij - i * j / (n * (n - 1) / 2.0::DOUBLE)) / ((i + j) / 2 - i * j / (n * (n - 1) / 2.0::DOUBLE)), 6) AS ari FROM t")
def cluster_ari(spark, d):
    labels = called(spark, d).groupBy("sample_id").agg(F.min("population").alias("a")).withColumn("b", F.col("sample_id") % 4)
    return rounded(population.adjusted_rand(labels, "a", "b"), "ari")


@query("cohort_table", "SELECT population, CAST(count(DISTINCT sample_id) AS BIGINT) AS n_samples, CAST(count(*) AS BIGINT) AS n_calls FROM c GROUP BY 1")
def cohort_table(spark, d):
    return quality.cohort_table(called(spark, d))


@query("covered_genome", "SELECT chrom, CAST(max(pos) - min(pos) AS BIGINT) AS bp, CAST(count(*) AS BIGINT) AS n_sites FROM sites GROUP BY 1")
def covered_genome(spark, d):
    return called(spark, d).select(*SITE).distinct().groupBy("chrom").agg((F.max("pos") - F.min("pos")).alias("bp"), F.count(F.lit(1)).alias("n_sites"))


_EM = "list_sum([(w[2] * 2 * {p} * (1 - {p}) + 2 * w[3] * {p} * {p}) / (w[1] * (1 - {p}) * (1 - {p}) + w[2] * 2 * {p} * (1 - {p}) + w[3] * {p} * {p}) FOR w IN ws]) / (2 * len(ws))"


_EM_SQL = f""", e0 AS (SELECT chrom, pos, population, list([pow(10.0::DOUBLE, -pl[1] / 10.0::DOUBLE), pow(10.0::DOUBLE, -pl[2] / 10.0::DOUBLE), pow(10.0::DOUBLE, -pl[3] / 10.0::DOUBLE)] ORDER BY sample_id) AS ws FROM (SELECT chrom, pos, population, sample_id, [least(255, 30 * alt_count), least(255, 10 * abs(depth - 2 * alt_count)), least(255, 30 * (depth - alt_count))] AS pl FROM g) WHERE pl[1] + pl[2] + pl[3] > 0 GROUP BY ALL),
 em AS (SELECT 0 AS i, *, 0.5::DOUBLE AS p, true AS moves FROM e0 UNION ALL SELECT i + 1, chrom, pos, population, ws, q AS p, abs(q - p) >= 1e-7 AS moves FROM (SELECT *, {_EM.format(p="em.p")} AS q FROM em WHERE moves AND i < 60)),
 last AS (SELECT chrom, pos, population, arg_max(p, i) AS p FROM em GROUP BY ALL)
 SELECT chrom, pos, population, round(p, 5) AS p FROM last"""


@query("gl_em_freq", _EM_SQL)
def gl_em_freq(spark, d):
    depth, alt = F.col("depth"), F.col("alt_count")
    cap = lambda x: F.least(F.lit(255), x).cast("int")
    rows = read_depths(spark, d).select(*SITE, "population", F.array(cap(30 * alt), cap(10 * F.abs(depth - 2 * alt)), cap(30 * (depth - alt))).alias("pl"))
    return rounded(population.gl_em(rows), "p", digits=5)


# -- reports, joins, parsing --------------------------------------------------------------


@query("sample_concordance", "--rawWITH a AS (SELECT DISTINCT c_nationkey AS k FROM customer), b AS (SELECT DISTINCT s_nationkey AS k FROM supplier WHERE s_nationkey % 2 = 0) SELECT CAST(k AS BIGINT) AS sample_id, 'calls only' AS \"where\" FROM a ANTI JOIN b USING (k) UNION ALL SELECT CAST(k AS BIGINT), 'sheet only' FROM b ANTI JOIN a USING (k)")
def sample_concordance(spark, d):
    a = table(spark, d, "customer").select(F.col("c_nationkey").cast("bigint").alias("sample_id")).distinct()
    b = table(spark, d, "supplier").filter("s_nationkey % 2 = 0").select(F.col("s_nationkey").cast("bigint").alias("sample_id")).distinct()
    return harmonize.sample_concordance(a, b)


@query("shared_samples", "--rawSELECT CAST(k AS BIGINT) AS sample_id, CAST(count(*) AS BIGINT) AS n FROM (SELECT DISTINCT c_nationkey AS k, 0 AS s FROM customer UNION ALL SELECT DISTINCT s_nationkey, 1 FROM supplier) GROUP BY 1 HAVING count(*) > 1")
def shared_samples(spark, d):
    return harmonize.shared_samples([table(spark, d, t).select(F.col(c).cast("bigint").alias("sample_id")) for t, c in (("customer", "c_nationkey"), ("supplier", "s_nationkey"))])


@query("aligned_labels", "--rawSELECT CAST(n_nationkey AS BIGINT) AS sample_id, coalesce(CASE WHEN n_nationkey % 4 <> 0 THEN r_name END, 'unknown') AS region FROM nation LEFT JOIN region ON n_regionkey = r_regionkey")
def aligned_labels(spark, d):
    from ..sources.panels import aligned

    samples = table(spark, d, "nation").select(F.col("n_nationkey").cast("bigint").alias("sample_id"))
    sheet = table(spark, d, "nation").filter("n_nationkey % 4 != 0").join(F.broadcast(table(spark, d, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    return aligned(samples, sheet.select(F.col("n_nationkey").cast("bigint").alias("sample_id"), F.col("r_name").alias("population"), F.col("r_name").alias("region"))).select("sample_id", "region")


@query("pl_parse", "--rawSELECT CAST(p_partkey AS BIGINT) AS k, CAST(CASE WHEN p_partkey % 5 = 0 THEN 0 ELSE least(255, p_size * 7) END AS BIGINT) AS pl0, CAST(CASE WHEN p_partkey % 5 = 0 THEN 0 ELSE least(255, p_partkey % 300) END AS BIGINT) AS pl1 FROM part")
def pl_parse(spark, d):
    text = F.when(F.col("p_partkey") % 5 == 0, F.lit("3,x")).otherwise(F.concat_ws(",", (F.col("p_size") * 7).cast("string"), (F.col("p_partkey") % 300).cast("string"), F.lit("9")))
    rows = table(spark, d, "part").select(F.col("p_partkey").cast("bigint").alias("k"), strings.likelihoods(text).alias("pl"))
    return rows.select("k", F.col("pl")[0].cast("bigint").alias("pl0"), F.col("pl")[1].cast("bigint").alias("pl1"))


@query("flipped_calls", "SELECT sample_id, CAST(sum(CASE WHEN site_ord % 3 = 0 THEN 2 - n_alt ELSE n_alt END) AS BIGINT) AS alt FROM c GROUP BY 1")
def flipped_calls(spark, d):
    c = called(spark, d).withColumn("orientation", F.when(F.col("site_ord") % 3 == 0, "complement_swap").otherwise("same"))
    return harmonize.flipped(c).groupBy("sample_id").agg(F.sum("n_alt").cast("bigint").alias("alt"))


@query("reference_rotation", """, rt AS (SELECT a.population AS x, b.population AS y, o.population AS t FROM (SELECT DISTINCT population FROM f) a, (SELECT DISTINCT population FROM f) b, (SELECT DISTINCT population FROM f) o WHERE a.population < b.population AND o.population NOT IN (a.population, b.population, 4) AND 4 NOT IN (a.population, b.population)),
 v AS (SELECT x, y, t, (a.p - b.p) AS d, (tt.p - o.p) AS e FROM rt JOIN f a ON a.population = x JOIN f b ON b.population = y AND b.chrom = a.chrom AND b.pos = a.pos JOIN f tt ON tt.population = t AND tt.chrom = a.chrom AND tt.pos = a.pos JOIN f o ON o.population = 4 AND o.chrom = a.chrom AND o.pos = a.pos)
 SELECT x, y, t, CAST(count(*) AS BIGINT) AS n_sites, round(avg(d * e), 6) AS f4 FROM v GROUP BY ALL""")
def reference_rotation(spark, d):
    return rounded(fstats.rotations(freqs(spark, d), OUT), "f4")


@query("top_windows", """, q AS (SELECT a.chrom, a.pos, abs(a.p - b.p) AS x FROM f a JOIN f b USING (chrom, pos) WHERE a.population = 0 AND b.population = 1), fi AS (SELECT chrom, min(pos) AS first FROM q GROUP BY 1),
 w AS (SELECT q.chrom, first + (pos - first) // 100000 * 100000 AS start, count(*) AS n, round(avg(x), 6) AS difference FROM q JOIN fi USING (chrom) GROUP BY ALL) SELECT chrom, CAST(start AS BIGINT) AS start, CAST(n AS BIGINT) AS n_sites, difference FROM w ORDER BY difference DESC, chrom, start LIMIT 10""")
def top_windows(spark, d):
    out = rounded(windows.difference_windows(freqs(spark, d), 0, 1, 100_000), "difference")
    return longs(out.orderBy(F.desc("difference"), "chrom", "start").limit(10), "start", "n_sites")


@query("d_summary", f", {_TRIOS}, {_JACK} SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(CASE WHEN abs(estimate / se) > 1 THEN 1 ELSE 0 END) AS BIGINT) AS strong, round(max(abs(estimate / se)), 4) AS top_z FROM r")
def d_summary(spark, d):
    z = fstats.d_statistics(freqs(spark, d), [0, 1, 2, 3, OUT], OUT)
    return z.agg(F.count(F.lit(1)).alias("n"), F.sum((F.abs("z") > 1).cast("bigint")).alias("strong"), F.round(F.max(F.abs("z")), 4).alias("top_z"))


@query("het_median", "SELECT round(median(h), 6) AS median, round(max(h), 6) AS top_value, max_by(sample_id, h) AS top FROM (SELECT sample_id, avg(CASE WHEN n_alt = 1 THEN 1.0::DOUBLE ELSE 0 END) AS h FROM c GROUP BY 1)")
def het_median(spark, d):
    per = called(spark, d).groupBy("sample_id").agg(F.avg((F.col("n_alt") == 1).cast("double")).alias("h"))
    return rounded(population.median_top(per, "sample_id", "h"), "median", "top_value")


@query("informative_loci", ", k AS (SELECT chrom, pos, max(CASE WHEN population = 0 THEN p END) AS a, max(CASE WHEN population = 1 THEN p END) AS b, max(CASE WHEN population = 2 THEN p END) AS e FROM f GROUP BY ALL) SELECT chrom, pos FROM k WHERE a IS NOT NULL AND b IS NOT NULL AND e IS NOT NULL AND (abs(a - e) >= 0.15 OR abs(b - e) >= 0.15)")
def informative_loci(spark, d):
    return mixture.informative(freqs(spark, d), [0, 1], 2)


@query("event_windows", "--rawSELECT strftime(ts, '%Y-%m-%d') AS start, event_type, CAST(count(*) AS BIGINT) AS n, round(sum(value), 4) AS value FROM events GROUP BY ALL")
def event_windows(spark, d):
    from ..streaming.counts import windowed_events

    out = windowed_events(table(spark, d, "events"), "1 day")
    return out.withColumns({"start": F.date_format("start", "yyyy-MM-dd"), "value": F.round("value", 4)})


# -- matrix and trees ---------------------------------------------------------------------


@query("pca")
def pca(spark, d):
    c = called(spark, d)
    ids, coords, _ = matrix.pca(c, quality.segregating(c), 4)
    return spark.createDataFrame([(int(s), *map(float, x)) for s, x in zip(ids, coords, strict=True)], "sample_id bigint, pc1 double, pc2 double, pc3 double, pc4 double")


@query("admixture_nmf")
def admixture_nmf(spark, d):
    c = called(spark, d)
    ids, x = matrix.dosages(c, quality.site_subsample(quality.segregating(c), 20_000, 7))
    q = matrix.admixture(x, 3)
    return spark.createDataFrame([(int(s), *map(float, r)) for s, r in zip(ids, q, strict=True)], "sample_id bigint, q1 double, q2 double, q3 double")


@query("admixture_k")
def admixture_k(spark, d):
    c = called(spark, d)
    _, x = matrix.dosages(c, quality.site_subsample(quality.segregating(c), 20_000, 7))
    errors = matrix.choose_k(x, [2, 3, 4, 5, 6], rounds=250, replicates=3)
    best = min(errors, key=errors.get)
    return spark.createDataFrame([(k, float(e), k == best) for k, e in errors.items()], "k bigint, error double, best boolean")


@query("clusters")
def clusters(spark, d):
    ids, m = matrix.square(_distance(spark, d), "s1", "s2", "distance")
    k, s, labels = matrix.best_clusters(m)
    return spark.createDataFrame([(int(i), int(x), k, float(s)) for i, x in zip(ids, labels, strict=True)], "sample_id bigint, cluster bigint, k bigint, silhouette double")


@query("nj_tree")
def nj_tree(spark, d):
    c = called(spark, d)
    tree, support = trees.bootstrap_tree(trees.block_distances(c, quality.segregating(c)), 20)
    return spark.createDataFrame([(trees.newick(tree, support), len(support))], "newick string, n_splits bigint")


#: Regions and halves of nations: ten groups.  Two sources and three rights leave one direction
#: to test, so that least squares and the larger axis of a 2 x 2 covariance are formulas.
_QPADM = """, h AS (SELECT chrom, pos, population * 2 + sample_id % 2 AS k, sum(n_alt) / (2.0::DOUBLE * count(*)) AS p FROM c GROUP BY ALL),
 w AS (SELECT chrom, pos, any_value(p) FILTER (k = 0) AS t, any_value(p) FILTER (k = 2) AS s0, any_value(p) FILTER (k = 4) AS s1, any_value(p) FILTER (k = 8) AS r0, any_value(p) FILTER (k = 6) AS r1, any_value(p) FILTER (k = 1) AS r2 FROM h GROUP BY ALL),
 b AS (SELECT chrom, count(*) AS n, sum((t - s0) * (r0 - r1)) AS y1, sum((t - s0) * (r0 - r2)) AS y2, sum((s1 - s0) * (r0 - r1)) AS m1, sum((s1 - s0) * (r0 - r2)) AS m2 FROM w WHERE t + s0 + s1 + r0 + r1 + r2 IS NOT NULL GROUP BY chrom),
 a AS (SELECT *, sum(n) OVER () AS nn, count(*) OVER () AS g, sum(y1) OVER () AS ty1, sum(y2) OVER () AS ty2, sum(m1) OVER () AS tm1, sum(m2) OVER () AS tm2 FROM b),
 f1 AS (SELECT *, nn * 1.0::DOUBLE / n AS hh, (ty1 * tm1 + ty2 * tm2) / (tm1 * tm1 + tm2 * tm2) AS x, ((ty1 - y1) * (tm1 - m1) + (ty2 - y2) * (tm2 - m2)) / ((tm1 - m1) * (tm1 - m1) + (tm2 - m2) * (tm2 - m2)) AS xb FROM a),
 f2 AS (SELECT *, (ty1 - x * tm1) / nn AS e1, (ty2 - x * tm2) / nn AS e2, (ty1 - y1 - xb * (tm1 - m1)) / (nn - n) AS e1b, (ty2 - y2 - xb * (tm2 - m2)) / (nn - n) AS e2b FROM f1),
 f3 AS (SELECT *, (hh * x - (hh - 1) * xb - g * x + sum((1 - 1 / hh) * xb) OVER ()) / sqrt(hh - 1) AS dx, (hh * e1 - (hh - 1) * e1b - g * e1 + sum((1 - 1 / hh) * e1b) OVER ()) / sqrt(hh - 1) AS d1, (hh * e2 - (hh - 1) * e2b - g * e2 + sum((1 - 1 / hh) * e2b) OVER ()) / sqrt(hh - 1) AS d2 FROM f2),
 f4 AS (SELECT any_value(x) AS x, any_value(e1) AS e1, any_value(e2) AS e2, any_value(nn) AS nn, any_value(g) AS g, sqrt(avg(dx * dx)) AS se, avg(d1 * d1) AS ca, avg(d1 * d2) AS cb, avg(d2 * d2) AS cc FROM f3),
 f5 AS (SELECT *, (ca + cc) / 2 + sqrt((ca - cc) * (ca - cc) / 4 + cb * cb) AS top FROM f4)
 SELECT CAST(source AS BIGINT) AS source, round(CASE WHEN source = 4 THEN x ELSE 1 - x END, 4) AS weight, round(se, 4) AS se, round((cb * e1 + (top - ca) * e2) * (cb * e1 + (top - ca) * e2) / (cb * cb + (top - ca) * (top - ca)) / top, 3) AS chisq, CAST(1 AS BIGINT) AS dof, CAST(nn AS BIGINT) AS n_sites, CAST(g AS BIGINT) AS n_blocks FROM f5, (VALUES (2), (4)) v(source)"""


@query("qpadm", _QPADM)
def qpadm(spark, d):
    halves = called(spark, d).withColumn("population", F.col("population") * 2 + F.col("sample_id") % 2)
    out = fstats.qpadm(counts(halves), 0, [2, 4], [8, 6, 1])
    rows = [(s, w, out["se"][s], out["chisq"], out["dof"], out["n_sites"], out["n_blocks"]) for s, w in out["weights"].items()]
    got = spark.createDataFrame(rows, "source bigint, weight double, se double, chisq double, dof bigint, n_sites bigint, n_blocks bigint")
    return rounded(rounded(got, "weight", "se", digits=4), "chisq", digits=3)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_Q)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
