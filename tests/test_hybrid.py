"""The two mixture recipes, from files, on a made-up bridge panel with known shares."""

import gzip
import json

import numpy as np
import pytest

from genomill.plans import config, stages  # noqa: F401
from genomill.plans.executor import Executor

N = 400
GROUPS = {"Coyote": 6, "Wolf": 5, "Beagle": 5, "Boxer": 5, "Poodle": 5, "VillDog_X": 4}


def frequencies(rng):
    dog = lambda v, rest=0.05: {g: v if g not in ("Coyote", "Wolf") else rest for g in GROUPS}
    out = []
    for i in range(N):
        if i < 120:
            out.append(dog(0.95))
        elif i < 180:
            out.append({g: 0.95 if g == "Wolf" else 0.05 for g in GROUPS})
        elif i < 300:
            own = list(GROUPS)[2 + i % 3]
            out.append({g: 0.9 if g == own else 0.1 for g in GROUPS})
        else:
            p = rng.uniform(0.2, 0.8)
            out.append(dict.fromkeys(GROUPS, p))
    return out


@pytest.fixture(scope="module")
def panel(tmp_path_factory):
    home, rng = tmp_path_factory.mktemp("panel"), np.random.default_rng(4)
    f = frequencies(rng)
    draw = lambda p: int(rng.binomial(2, p))
    text = ("0/0", "0/1", "1/1")
    samples = [f"{g}{k:02d}" for g, n in GROUPS.items() for k in range(1, n + 1)]
    loci = {f"chr1:{(i + 1) * 1000}": [text[draw(f[i][s[:-2]])] if rng.random() > 0.02 else None for s in samples] for i in range(N)}
    (home / "wgs.json").write_text(json.dumps({"samples": samples, "loci": loci}))
    two = [s for s in samples if s.startswith(("Coyote", "Beagle", "Boxer"))]
    few = list(loci)[:300]
    (home / "reference.json").write_text(json.dumps({k: [loci[k][samples.index(s)] or "0/0" for s in two] for k in few}))

    def query(dog, wolf, breed):
        return [draw(dog * f[i][breed] + wolf * f[i]["Wolf"] + (1 - dog - wolf) * f[i]["Coyote"]) for i in range(N)]

    queries = {"F1": query(0.5, 0, "Boxer"), "PARENT": query(0.05, 0, "Beagle"), "KID": query(0.27, 0, "Boxer")}
    (home / "calls").mkdir()
    for s, g in queries.items():
        rows = ["chrom,position,ref,alt,gt,depth,ref_count,alt_count"]
        for i in range(N):
            depth = 4 if i % 20 == 19 else 20
            rows.append(f"chr1,{(i + 1) * 1000},A,G,{text[g[i]]},{depth},{depth - depth * g[i] // 2},{depth * g[i] // 2}")
        (home / "calls" / f"{s}_calls.csv").write_text("\n".join(rows) + "\n")
    (home / "fractions.json").write_text(json.dumps({"F1": 0.5, "PARENT": 0.05, "KID": 0.27}))
    bridge = queries | {f"EAST{k}": query(0.1, 0.25, "Boxer") for k in range(4)} | {f"West{k:03d}": query(0, 0, "Boxer") for k in (1, 2, 3)} | {"GoldenJackal01": query(0.9, 0, "Boxer"), "Coyote01": query(0, 0.9, "Boxer")}
    lines = ["##fileformat=VCFv4.2", "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", *bridge])]
    lines += ["\t".join(["1", str((i + 1) * 1000), ".", "A", "G", ".", "PASS", ".", "GT", *[text[g[i]] for g in bridge.values()]]) for i in range(N)]
    with gzip.open(home / "bridge.vcf.gz", "wt") as file:
        file.write("\n".join(lines) + "\n")
    return home, two


def run(spark, home, out, pipeline, settings):
    raw = {"project_name": "hybrid", "seed": 7, "paths": {"root": str(home)}, "pipeline": pipeline, "stages": settings, "run_dir": str(out)}
    got = Executor(spark, config.Config.of(raw)).run()
    assert {k: v.get("error") for k, v in got["stages"].items() if v["status"] != "done"} == {}
    return got["artifacts"]


def test_pedigree_recipe(spark, panel, tmp_path):
    home, two = panel
    common = {"bridge_vcf": "bridge.vcf.gz", "calls_dir": "calls", "query_samples": ["F1", "PARENT", "KID"], "min_depth": 8}
    got = run(spark, home, tmp_path, ["reference_mixture", "breed_assign", "report"], {
        "reference_mixture": common | {"reference_genotypes": "reference.json", "wgs_samples": two, "expected_f1": "F1", "expected_parent": "PARENT", "expected_offspring": ["KID"]},
        "breed_assign": common | {"wgs_genotypes": "wgs.json", "dog_fractions": "fractions.json", "locus_filter_json": "reference.json"},
    })
    shares = {r["sample_id"]: r for r in got["fractions"].collect()}
    for s, f in (("F1", 0.5), ("PARENT", 0.05), ("KID", 0.27)):
        assert shares[s]["fraction"] == pytest.approx(f, abs=0.1)
        assert shares[s]["mean_depth"] == pytest.approx(19.2, abs=0.1)
    assert got["verdict"].first()["supported"]
    best = {r["sample_id"]: r["panel"] for r in got["breed_scores"].filter("rank = 1").collect()}
    assert best["F1"] == "Boxer"
    loo = got["breed_loo"].collect()
    assert len(loo) == 19 and sum(r["correct"] for r in loo) >= 17
    assert "<table" in got["report"]["html"].lower()


def test_three_way_recipe(spark, panel, tmp_path):
    home, _ = panel
    got = run(spark, home, tmp_path, ["multiway_admixture", "report"], {"multiway_admixture": {"bridge_vcf": "bridge.vcf.gz", "wgs_genotypes": "wgs.json", "western_id_prefix": "West", "western_id_range": [1, 12], "bootstrap_n": 40, "seed": 5}})
    rows = {r["sample_id"]: r for r in got["mixture"].collect()}
    assert set(rows) == {"F1", "PARENT", "KID", *(f"EAST{k}" for k in range(4)), *(f"West{k:03d}" for k in (1, 2, 3))}
    for s, r in rows.items():
        assert r["region"] == ("western" if s.startswith("West") else "eastern")
        assert r["one_low"] <= r["share_one"] <= r["one_high"] and r["two_low"] <= r["share_two"] <= r["two_high"]
    east = {r["region"]: r for r in got["region_summary"].collect()}
    assert np.mean([rows[f"EAST{k}"]["share_one"] for k in range(4)]) == pytest.approx(0.25, abs=0.08)
    assert east["western"]["wolf_mean"] < 0.08 and east["western"]["dog_mean"] < 0.08
    cohorts = {r["region"]: r for r in got["cohorts"].collect()}
    assert cohorts["western"]["share_one"] < 0.06 and set(cohorts) == {"eastern", "western"}
    assert {r["source"] for r in got["two_way"].collect()} == {"(any dog)", "(gray wolf)"}
    assert got["mixture_breeds"].filter("sample_id = 'F1' and rank = 1").first()["panel"] == "Boxer"


def test_missing_files_and_roles(spark, panel, tmp_path):
    home, two = panel
    raw = {"pipeline": ["reference_mixture"], "run_dir": str(tmp_path)}
    got = Executor(spark, config.Config.of(raw)).run()
    assert got["status"] == "failed" and "bridge_vcf" in got["stages"]["reference_mixture"]["error"]
    few = {"bridge_vcf": "bridge.vcf.gz", "calls_dir": "calls", "query_samples": ["NOBODY"], "reference_genotypes": "reference.json", "wgs_samples": two}
    got = Executor(spark, config.Config.of(raw | {"paths": {"root": str(home)}, "stages": {"reference_mixture": few}})).run()
    assert got["stages"]["reference_mixture"]["status"] == "failed"
