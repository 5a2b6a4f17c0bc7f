import numpy as np
import pytest
from pyspark.sql import functions as F

from genomill.plans import studies

CALLS = "chrom bigint, pos bigint, sample_id string, n_alt int"


@pytest.fixture(scope="module")
def cohort(spark):
    """Samples of five groups on six contigs; X is a 3 : 7 mixture of B and C."""
    rng = np.random.default_rng(3)
    rows, n = [], 900
    o = rng.uniform(0.05, 0.95, n)
    drift = lambda p, s: np.clip(p + rng.normal(0, s, n), 0.02, 0.98)
    west = drift(o, 0.2)
    f = {"O": o, "A": drift(west, 0.05), "B": drift(west, 0.05), "C": drift(o, 0.2)}
    f["X"] = 0.3 * f["B"] + 0.7 * f["C"]
    groups = {g: [f"{g}{k}" for k in range(8)] for g in f}
    for g, names in groups.items():
        for s in names:
            rows += [(i % 6 + 1, i, s, int(rng.binomial(2, f[g][i]))) for i in range(n) if rng.random() > 0.05]
    calls = spark.createDataFrame(rows, CALLS)
    pl = F.when(F.col("n_alt") == 0, F.array(*map(F.lit, (0, 90, 255)))).when(F.col("n_alt") == 1, F.array(*map(F.lit, (90, 0, 90)))).otherwise(F.array(*map(F.lit, (255, 90, 0))))
    return calls.withColumn("pl", pl), groups


def test_cline(cohort):
    calls, groups = cohort
    units = studies.cline_units(groups, {r: r for r in "AOBC"}, ["X"], ["B", "X"])
    assert len(units) == 17 and "B3" not in next(u for u in units if u["unit"] == "B3")["roles"]["B"]
    got = {r["unit"]: r for r in studies.ancestry_cline({"all": calls, "gl": calls}, units).collect()}
    assert got["X"]["ratio_estimate_all"] == pytest.approx(0.3, abs=0.1)
    assert got["X"]["ratio_estimate_gl"] == pytest.approx(got["X"]["ratio_estimate_all"], abs=0.02)
    assert got["X"]["d_estimate_all"] > 0 and got["X"]["kind"] == "group" and got["B3"]["kind"] == "individual"
    assert np.mean([got[s]["ratio_estimate_all"] for s in groups["B"]]) == pytest.approx(1, abs=0.15)


def test_groups_without_samples(cohort):
    calls, groups = cohort
    roles = {"A": groups["A"], "O": groups["O"], "B": groups["B"], "C": groups["C"]}
    got = {r["unit"]: r for r in studies.local_contrasts(calls, {"X": groups["X"], "some B": groups["B"][:3]}, roles, ["nobody"]).collect()}
    assert got["nobody"]["status"] == "no genotypes" and got["nobody"]["ratio_estimate"] is None and got["nobody"]["d_z"] is None
    assert got["some B"]["reference"] == ";".join(groups["B"][3:]) and got["X"]["n_genomes"] == 8
    assert got["X"]["ratio_estimate"] == pytest.approx(0.3, abs=0.1)


def test_rotation_of_references(spark):
    rng = np.random.default_rng(5)
    p = rng.random((120, 7))
    rows = [(1 + i % 4, i, k, float(p[i, k])) for i in range(120) for k in range(7) if not (k == 6 and i % 3 == 0)]
    freqs = spark.createDataFrame(rows, "chrom bigint, pos bigint, population bigint, p double")
    got = studies.reference_rotation(freqs, [0], [1], [2, 6], [3, 0], [4, 5], (1, 2, 3, 4)).collect()
    assert len(got) == 4 and sum(r["baseline"] for r in got) == 1
    for r in got:
        t, a, b, c, o = (int(r[k]) for k in ("target", "a", "b", "c", "o"))
        keep = np.arange(120) % 3 > 0 if b == 6 else np.ones(120, bool)
        x = ((p[:, a] - p[:, o]) * (p[:, t] - p[:, c]))[keep].sum() / ((p[:, a] - p[:, o]) * (p[:, b] - p[:, c]))[keep].sum()
        assert r["estimate"] == pytest.approx(x) and r["n_sites"] == keep.sum()
    pairs = studies.paired_contrasts(freqs, [(0, 6)], 1, 5, 2, 3)
    assert pairs[0]["n_sites"] == 80 and pairs[0]["se"] > 0


def test_mixed_samples_and_heterozygosity(spark):
    rng = np.random.default_rng(6)
    f = {"Beagle": np.where(np.arange(200) % 2, 0.9, 0.1), "Boxer": np.where(np.arange(200) % 2, 0.1, 0.9)}
    rows = []
    for g in f:
        for k in range(6):
            rows += [(1, i, f"{g}{k}", int(rng.binomial(2, f[g][i])), "breed", g) for i in range(200)]
    rows += [(1, i, "Mix1", int(rng.binomial(2, 0.5)), "mixed", "Mix") for i in range(200)]
    rows += [(1, i, "Unknown1", int(rng.binomial(2, f["Boxer"][i])), "mixed", "Unknown") for i in range(200)]
    calls = spark.createDataFrame(rows, "chrom bigint, pos bigint, sample_id string, n_alt int, kind string, population string")
    got = {r["sample_id"]: r for r in studies.mix_sensitivity(calls, calls.filter("kind = 'breed'")).filter("rank = 1").collect()}
    assert got["Unknown1"]["panel"] == "Boxer" and got["Unknown1"]["single"] and not got["Mix1"]["single"]
    spans = spark.createDataFrame([(0, 100, 1100), (1, 50, 40)], "window int, first bigint, last bigint")
    one = spark.createDataFrame([(1, 1, "a", 1), (1, 2, "a", 0), (1, 3, "a", None), (1, 4, "b", 1)], CALLS)
    het = {r["sample_id"]: r for r in studies.heterozygosity(one, spans, one.filter("n_alt = 1")).collect()}
    assert het["a"]["missing"] == 0.5 and het["a"]["het_per_kb"] == pytest.approx(0.5 * 4) and het["a"]["missing_filtered"] == 0.75
