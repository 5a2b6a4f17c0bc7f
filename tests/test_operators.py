import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from genomill import model
from genomill.operators import dense, fstats, harmonize, matrix, mixture, population, quality, trees, windows
from genomill.sources import exports

COUNTS = "chrom bigint, pos bigint, population bigint, n_called bigint, ref_n bigint, alt_n bigint, p double"


def calls_of(spark, rows):
    """rows: (chrom, pos, sample, population, n_alt)."""
    df = spark.createDataFrame(rows, "chrom bigint, pos bigint, sample_id bigint, population bigint, n_alt int")
    return df.withColumns({"a0": (F.col("n_alt") > 1).cast("int"), "a1": (F.col("n_alt") > 0).cast("int")})


def test_hudson_fst(spark):
    rows = [(1, i, p, (r + a) // 2, r, a, a / (r + a)) for p, ac in ((0, [(2, 0), (1, 1)]), (1, [(0, 2), (1, 1)])) for i, (r, a) in enumerate(ac)]
    got = population.fst(spark.createDataFrame(rows, COUNTS)).first()
    assert got["fst"] == pytest.approx(1 / 3)


def test_half_calls_count_their_allele(spark):
    df = spark.createDataFrame([(1, 10, 1, 0, 0, None, None), (1, 10, 2, 0, 1, 1, 2)], "chrom bigint, pos bigint, sample_id bigint, population bigint, a0 int, a1 int, n_alt int")
    r = model.counts(df).first()
    assert (r["n_called"], r["ref_n"], r["alt_n"]) == (1, 1, 2)


def test_roh(spark):
    rows = [(1, p, 1, 0, 1 if p == 300 else 0) for p in range(0, 501, 100)]
    c = calls_of(spark, rows)
    got = windows.roh_summary(c, c.select("chrom", "pos").distinct(), window_bp=100, min_bp=200).first()
    assert (got["roh_bp"], got["segments"]) == (300, 1)


@pytest.mark.parametrize(("bp", "kept"), [(1000, [0, 2, 3]), (10, [0, 1, 2, 3])])
def test_ld_prune(bp, kept):
    calls = np.array([[0, 1, 2, 1, 0, 2], [0, 1, 2, 1, 0, 2], [2, 0, 1, 0, 1, 0], [0, 0, 0, 0, 0, 0]])
    assert windows.greedy_prune(np.array([100, 200, 300, 400]), calls, bp, 0.8).tolist() == kept


def test_jackknives(spark):
    rng = np.random.default_rng(1)
    num, n = rng.normal(1, 0.3, 8), rng.integers(5, 20, 8)
    df = spark.createDataFrame([(0, str(i), float(x), float(k), int(k)) for i, (x, k) in enumerate(zip(num, n, strict=True))], "one int, block string, num double, den double, n bigint")
    plain = fstats.jackknife(df, ["one"]).first()
    theta = np.array([(num.sum() - x) / (n.sum() - k) for x, k in zip(num, n, strict=True)])
    assert plain["estimate"] == pytest.approx(num.sum() / n.sum())
    assert plain["se"] == pytest.approx(np.sqrt(7 / 8 * ((theta - theta.mean()) ** 2).sum()))
    assert plain["n_sites"] == n.sum()
    h = n.sum() / n
    centre = 8 * num.sum() / n.sum() - ((1 - 1 / h) * theta).sum()
    ps = h * num.sum() / n.sum() - (h - 1) * theta
    heavy = fstats.weighted_jackknife(df, ["one"]).first()
    assert heavy["se"] == pytest.approx(np.sqrt((((ps - centre) ** 2) / (h - 1)).mean()))


def test_d_signs(spark):
    f = lambda *p: spark.createDataFrame([(c, 10 * c, i, 2, 0, 0, x) for c in (1, 2, 3) for i, x in enumerate(p)], COUNTS)
    d = fstats.d_statistics(f(0.1, 0.9, 0.9, 0.0), [0, 1, 2, 3], 3).filter("p1 = 0 and p2 = 1 and p3 = 2").first()
    assert d["estimate"] > 0
    panel = fstats.statistic(f(0.1, 0.9, 0.9, 0.0), [0, 1, 2, 3], fstats.panel_d_terms).first()
    assert panel["estimate"] < 0


def test_qpadm_finds_mixture(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(900):
        anc = rng.uniform(0.1, 0.9)
        drift = lambda x, s: float(np.clip(x + rng.normal(0, s), 0.01, 0.99))
        a0, b0 = drift(anc, 0.15), drift(anc, 0.15)
        a, b = drift(a0, 0.03), drift(b0, 0.03)
        for pop, x in enumerate((0.3 * a + 0.7 * b, a, b, drift(anc, 0.05), drift(a0, 0.05), drift(b0, 0.05), drift(anc, 0.1))):
            rows.append((i % 15 + 1, i, pop, 2, 0, 0, float(x)))
    got = fstats.qpadm(spark.createDataFrame(rows, COUNTS), 0, [1, 2], [3, 4, 5, 6])
    assert got["weights"][1] == pytest.approx(0.3, abs=0.1)
    assert got["dof"] == 2
    assert 0 <= got["p"] <= 1


def test_gl_em(spark):
    rows = [(1, 1, 0, [0, 60, 255]), (1, 1, 0, [60, 0, 60]), (1, 1, 0, [255, 60, 0]), (1, 1, 0, [0, 0, 0])]
    got = population.gl_em(spark.createDataFrame(rows, "chrom bigint, pos bigint, population bigint, pl array<int>")).first()
    assert got["p"] == pytest.approx(0.5, abs=1e-6)


def test_orientation(spark):
    rows = [("A", "G", "A", "G"), ("A", "G", "G", "A"), ("A", "G", "T", "C"), ("A", "G", "C", "T"), ("A", "T", "T", "A"), ("C", "G", "A", "T"), ("A", "G", "A", "C")]
    o = harmonize.orientation(*[F.col(c) for c in "rsxy"])
    got = [r["o"] for r in spark.createDataFrame(rows, "r string, s string, x string, y string").select(o.alias("o")).collect()]
    assert got == ["same", "swap", "complement", "complement_swap", "swap", None, None]


def test_q_values(spark):
    got = {r["i"]: r["q"] for r in population.running_q(spark.createDataFrame([(0, 0.01), (1, 0.04), (2, 0.03), (3, None)], "i int, p double")).collect()}
    assert got[0] == pytest.approx(0.03)
    assert got[1] == got[2] == pytest.approx(0.04)
    assert got[3] is None


def test_marker_panel_and_blocks(spark):
    sites = spark.createDataFrame([(c, p) for c in (1, 2, 3) for p in range(1, 18)], "chrom bigint, pos bigint")
    got = sorted((r["chrom"], r["pos"]) for r in quality.marker_panel(sites, 10).collect())
    every = sorted((r["chrom"], r["pos"]) for r in sites.collect())
    assert got == every[:: -(-len(every) // 10)]
    sizes = sorted(r["count"] for r in fstats.block_of(sites, "sites", n_blocks=20).groupBy("block").count().collect())
    assert sizes == sorted(len(x) for x in np.array_split(np.arange(51), 20))


def test_viterbi_smooths_and_prefers():
    logs = np.log(np.array([[0.9, 0.1], [0.9, 0.1], [0.45, 0.55], [0.9, 0.1], [0.1, 0.9], [0.01, 0.99], [0.01, 0.99]]))
    assert windows.viterbi(logs, 0.02).tolist() == [0, 0, 0, 0, 1, 1, 1]
    assert windows.viterbi(np.zeros((3, 2)), 0.02).tolist() == [0, 0, 0]


def test_neighbour_joining():
    d = np.array([[0, 5, 9, 9, 8], [5, 0, 10, 10, 9], [9, 10, 0, 8, 7], [9, 10, 8, 0, 3], [8, 9, 7, 3, 0]], float)
    tree = trees.neighbour_joining(d, list("abcde"))
    assert trees.splits(tree) == {frozenset("de"), frozenset("cde")}
    assert trees.newick(tree).endswith(";")


def test_clusters_and_mantel():
    x = np.array([0, 0.1, 0.2, 5, 5.1, 5.3])
    d = np.abs(x[:, None] - x[None, :])
    k, s, labels = matrix.best_clusters(d)
    assert k == 2 and s > 0.9 and labels.tolist() == [0, 0, 0, 1, 1, 1]
    r, p = matrix.mantel(d, 2 * d, 99)
    assert r == pytest.approx(1) and p < 0.1


def test_gram_is_that_of_scaled_dosages(spark):
    rng = np.random.default_rng(2)
    g = rng.integers(0, 3, (12, 6))
    c = calls_of(spark, [(1, i, s, 0, int(g[i, s])) for i in range(12) for s in range(6)])
    sites = quality.segregating(c)
    ids, got, n = matrix.gram(c, sites)
    seg = g[(g.sum(axis=1) > 0) & (g.sum(axis=1) < 12)]
    p = seg.mean(axis=1) / 2
    z = (seg - 2 * p[:, None]) / np.sqrt(p * (1 - p))[:, None]
    assert n == len(seg) and np.allclose(got, z.T @ z)


def test_pca_with_means_for_missing_calls(spark):
    rng = np.random.default_rng(6)
    g = rng.integers(0, 3, (60, 7))
    g[rng.random(g.shape) < 0.2] = -1
    c = calls_of(spark, [(1, i, s, 0, None if g[i, s] < 0 else int(g[i, s])) for i in range(60) for s in range(7)])
    x = np.where(g < 0, np.nan, g)
    mean = np.nanmean(x, axis=1, keepdims=True)
    keep = (mean[:, 0] > 0) & (mean[:, 0] < 2)
    z = np.nan_to_num((x - mean) / np.sqrt(mean / 2 * (1 - mean / 2)))[keep].T
    _, s, _ = np.linalg.svd(z, full_matrices=False)
    _, coords, share = matrix.pca(c, quality.segregating(c), 3, impute=True)
    assert np.allclose(share, (s**2 / (s**2).sum())[:3]) and np.allclose((coords**2).sum(axis=0), s[:3] ** 2)


def test_pair_statistics_are_those_of_dense_matrices(spark, monkeypatch):
    rng = np.random.default_rng(7)
    g = rng.integers(-1, 3, (50, 6))
    c = calls_of(spark, [(1 + i % 3, i, s, 0, None if g[i, s] < 0 else int(g[i, s])) for i in range(50) for s in range(6)])
    sites = c.select("chrom", "pos").distinct()
    zero = np.maximum(g, 0)
    d = {(r["s1"], r["s2"]): r["distance"] for r in population.distance(c, sites, c.select("sample_id").distinct()).collect()}
    same = {(r["s1"], r["s2"]): (r["n_sites"], r["concordance"]) for r in quality.concordance(c, 1, 0.0).collect()}
    monkeypatch.setattr(dense, "CHUNK", 7)
    ids, blocks, n = trees.block_distances(c, sites)
    assert ids == list(range(6)) and n.tolist() == [17, 17, 16]
    for a in range(6):
        for b in range(a + 1, 6):
            diff = np.abs(zero[:, a] - zero[:, b])
            assert d[a, b] == pytest.approx(diff.mean() / 2)
            assert np.allclose(blocks[:, a, b], [diff[k::3].sum() / 2 for k in range(3)])
            both = (g[:, a] >= 0) & (g[:, b] >= 0)
            assert same[a, b] == (both.sum(), pytest.approx((g[both, a] == g[both, b]).mean()))
    twice = lambda m, rows: dense.differences(m, rows) * np.array([2.0, 1.0])[:, None, None]
    assert np.allclose(trees.block_distances(c, sites, kernel=twice)[1], 2 * blocks)
    ids, x = matrix.dosages(c, sites)
    assert x.shape == (6, 50) and sorted(map(tuple, x.T.tolist())) == sorted(map(tuple, (zero / 2).tolist()))


def test_site_bootstrap(spark):
    rng = np.random.default_rng(8)
    base = rng.integers(0, 3, (400, 2))
    g = np.stack([base[:, s // 3] for s in range(6)], axis=1)
    flip = rng.random(g.shape) < 0.1
    g[flip] = rng.integers(0, 3, flip.sum())
    c = calls_of(spark, [(1, i, s, 0, int(g[i, s])) for i in range(400) for s in range(6)])
    tree, support = trees.site_bootstrap_tree(c, quality.segregating(c), 20, 3)
    again, other = trees.site_bootstrap_tree(c.repartition(5), quality.segregating(c), 20, 3)
    assert support[frozenset({"3", "4", "5"})] == 100 and other == support and trees.newick(again) == trees.newick(tree)
    by_chrom = trees.bootstrap_tree(trees.block_distances(c, quality.segregating(c)), 5)
    assert trees.splits(by_chrom[0]) == trees.splits(tree)


def plain_qpadm(f, blocks, target, sources, rights):
    """Weights, errors and chi-squared, a statistic and a block at a time."""
    def system(keep):
        y = np.array([((f[target] - f[sources[0]]) * (f[rights[0]] - f[r]))[keep].mean() for r in rights[1:]])
        m = np.array([[((f[s] - f[sources[0]]) * (f[rights[0]] - f[r]))[keep].mean() for s in sources[1:]] for r in rights[1:]])
        w = np.linalg.solve(m.T @ m, m.T @ y)
        return np.concatenate([[1 - w.sum()], w]), y - m @ w

    names, n = np.unique(blocks), len(blocks)
    whole = system(np.ones(n, bool))
    out = []
    for k in (0, 1):
        theta, ps, centre = whole[k], [], len(names) * whole[k]
        for b in names:
            h = n / (blocks == b).sum()
            minus = system(blocks != b)[k]
            centre = centre - (1 - 1 / h) * minus
            ps.append((h, h * theta - (h - 1) * minus))
        out.append(np.array([(x - centre) / np.sqrt(h - 1) for h, x in ps]))
    se = np.sqrt((out[0] ** 2).mean(axis=0))
    cov = sum(np.outer(x, x) for x in out[1]) / len(names)
    dof = len(rights) - len(sources)
    u, s, _ = np.linalg.svd(cov)
    return whole[0], se, sum((u[:, i] @ whole[1]) ** 2 / s[i] for i in range(dof)), dof


@pytest.mark.parametrize(("sources", "rights"), [([1, 2], [3, 4, 5]), ([1, 2, 6], [3, 4, 5, 7, 8]), ([1, 2], [3, 4])])
def test_qpadm(spark, sources, rights):
    rng = np.random.default_rng(9)
    n = 900
    f = {3: rng.uniform(0.1, 0.9, n)}
    for p in (4, 5, 7, 8):
        f[p] = np.clip(f[3] + rng.normal(0, 0.15, n), 0, 1)
    for p, q in ((1, 4), (2, 5), (6, 7)):
        f[p] = np.clip(f[q] + rng.normal(0, 0.1, n), 0, 1)
    f[0] = np.clip(0.3 * f[2] + 0.7 * f[1] + rng.normal(0, 0.05, n), 0, 1)
    blocks = np.sort(rng.integers(0, 9, n))
    rows = [(int(blocks[i]), i, p, 2, 0, 0, float(f[p][i])) for p in f for i in range(n)]
    freqs = spark.createDataFrame(rows, COUNTS)
    got = fstats.qpadm(freqs, 0, sources, rights)
    w, se, chi, dof = plain_qpadm(f, blocks, 0, sources, rights)
    assert list(got["weights"].values()) == pytest.approx(list(w)) and list(got["se"].values()) == pytest.approx(list(se))
    assert got["dof"] == dof and got["n_blocks"] == 9 and got["n_sites"] == n
    assert got["chisq"] == pytest.approx(chi, rel=1e-6) if dof else (got["chisq"] == 0 and got["p"] is None)
    assert got["weights"][2] == pytest.approx(0.3, abs=0.15)


def test_qpadm_refuses(spark):
    freqs = spark.createDataFrame([(c, i, p, 2, 0, 0, 0.1 * ((i * p + c) % 9)) for c in (1, 2) for i in range(20) for p in range(5)] + [(c, i, 9, 2, 0, 0, 0.1 * ((i + c) % 9)) for c in (1, 2) for i in range(20)], COUNTS)
    for sources, rights in (([1], [2, 3, 4]), ([1, 2], [3])):
        with pytest.raises(ValueError, match="at least two sources"):
            fstats.qpadm(freqs, 0, sources, rights)
    with pytest.raises(ValueError, match="blocks"):
        fstats.qpadm(freqs.filter("chrom = 1"), 0, [1, 2], [3, 4, 9])
    with pytest.raises(ValueError, match="apart"):
        fstats.qpadm(freqs, 0, [1, 9], [2, 3, 4])


def test_em_stops_at_its_tolerance(spark):
    rows = [(1, 5, 0, [0, 60, 255]), (1, 5, 0, [60, 0, 60]), (1, 5, 0, [255, 60, 0]), (1, 5, 0, [0, 0, 0]), (1, 6, 0, [0, 3, 30]), (1, 6, 0, [10, 0, 10])]
    pl = spark.createDataFrame(rows, "chrom bigint, pos bigint, population bigint, pl array<int>")
    got = {r["pos"]: r["p"] for r in population.gl_em(pl).collect()}
    assert got[5] == pytest.approx(0.5)

    def em(rounds, tol):
        p, w = 0.5, [np.power(10.0, -np.array(x) / 10) for x in ([0, 3, 30], [10, 0, 10])]
        for _ in range(rounds):
            new = sum((a[1] * 2 * p * (1 - p) + 2 * a[2] * p * p) / (a[0] * (1 - p) ** 2 + a[1] * 2 * p * (1 - p) + a[2] * p * p) for a in w) / 4
            moved, p = abs(new - p), new
            if moved < tol:
                break
        return p

    assert got[6] == pytest.approx(em(60, 1e-7), abs=1e-12)
    assert population.gl_em(pl, tol=0.02).filter("pos = 6").first()["p"] == pytest.approx(em(60, 0.02), abs=1e-12) != em(60, 1e-7)


def test_f3_errors(spark):
    rng = np.random.default_rng(10)
    p = rng.random((60, 3))
    freqs = spark.createDataFrame([(1 + i // 30, i, k, 2, 0, 0, float(p[i, k])) for i in range(60) for k in range(3)], COUNTS)
    got = {(r["i"], r["j"]): r for r in fstats.f3_matrix(freqs, 2, 6).collect()}
    x = (p[:, 2] - p[:, 0]) * (p[:, 2] - p[:, 1])
    minus = np.array([np.delete(x, np.arange(b * 10, b * 10 + 10)).mean() for b in range(6)])
    assert got[0, 1]["f3"] == pytest.approx(x.mean()) and got[0, 1]["se"] == pytest.approx(np.sqrt(5 / 6 * ((minus - minus.mean()) ** 2).sum()))


def test_pruning_of_named_contigs(spark):
    rng = np.random.default_rng(11)
    g = rng.integers(0, 3, (40, 8))
    g[1::4] = g[::4]
    c = calls_of(spark, [(1, 10 * i, s, 0, int(g[i, s])) for i in range(40) for s in range(8)])
    want = [10 * i for i in windows.greedy_prune(np.arange(40) * 10, g, 1000, 0.8)]
    assert [r["pos"] for r in windows.ld_prune(c, 8, 1000, 0.8).orderBy("pos").collect()] == want and 10 not in want
    named = c.withColumn("chrom", F.lit("chr1"))
    got = windows.ld_prune(named, 8, 1000, 0.8)
    assert dict(got.dtypes)["chrom"] == "string" and got.count() == len(want)


def test_cohort_grid_is_that_of_summed_alleles(spark):
    rng = np.random.default_rng(12)
    freqs, rows, f = [], [], rng.uniform(0.05, 0.95, (80, 3))
    for i in range(80):
        freqs += [(1, i, k, 2, 0, 0, float(f[i, k])) for k in range(3)]
        rows += [(1, i, s, 0, int(rng.binomial(2, 0.5 * f[i, 0] + 0.3 * f[i, 1] + 0.2 * f[i, 2]))) for s in range(4)]
    c, q = calls_of(spark, rows), spark.createDataFrame(freqs, COUNTS)
    best = []
    for i in range(21):
        for j in range(21 - i):
            p = np.clip(f[:, 0] * (20 - i - j) / 20 + f[:, 1] * i / 20 + f[:, 2] * j / 20, 1e-4, 1 - 1e-4)
            alt = np.zeros(80)
            for _, k, _, _, n in rows:
                alt[k] += n
            best.append((alt @ np.log(p) + (8 - alt) @ np.log(1 - p), i, j))
    _, i, j = max(best)
    whole = mixture.alleles(c.withColumn("sample_id", F.lit("all")))
    got = mixture.blend_grid(whole, q, 0, 1, 2, step=0.05, reps=30, seed=1).first()
    assert (got["share_one"], got["share_two"], got["n_loci"]) == (pytest.approx(i / 20), pytest.approx(j / 20), 80)
    assert got["one_low"] <= got["share_one"] <= got["one_high"]
    each = {r["sample_id"]: r for r in mixture.blend_grid(mixture.alleles(c), q, 0, 1, 2, step=0.1).collect()}
    for r in mixture.mixture_grid(c, q, 0, 1, 2, step=0.1, least_gap=0.0).collect():
        o = each[str(r["sample_id"])]
        assert (r["share_one"], r["share_two"], r["loglik"]) == (pytest.approx(o["share_one"]), pytest.approx(o["share_two"]), pytest.approx(o["loglik"]))


def test_source_fraction(spark):
    rng = np.random.default_rng(3)
    rows, freqs = [], []
    for i in range(300):
        s, b = (0.95, 0.05) if i % 2 else (0.05, 0.95)
        freqs += [(1, i, 0, 2, 0, 0, s), (1, i, 1, 2, 0, 0, b)]
        rows.append((1, i, 7, 9, int(rng.binomial(2, 0.3 * s + 0.7 * b))))
    got = mixture.source_fraction(calls_of(spark, rows), spark.createDataFrame(freqs, COUNTS), 0, 1).first()
    assert got["fraction"] == pytest.approx(0.3, abs=0.06)
    grid = mixture.mixture_grid(calls_of(spark, rows), spark.createDataFrame(freqs, COUNTS), 1, 0, step=0.1).first()
    assert grid["share_one"] == pytest.approx(0.3, abs=0.11)


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 9).flatmap(lambda n: st.lists(st.lists(st.integers(-1, 2), min_size=n, max_size=n), min_size=1, max_size=6)))
def test_bed_round_trip(rows):
    g = np.array(rows)
    assert (exports.unpack(exports.BED_MAGIC + exports.pack(g), g.shape[1]) == g).all()


def test_empty_tables(spark):
    c = calls_of(spark, [])
    assert population.fst(model.counts(c)).count() == 0
    assert population.distance(c, quality.segregating(c), c.select("sample_id").distinct()).count() == 0
    assert windows.roh_summary(c, c.select("chrom", "pos")).count() == 0
