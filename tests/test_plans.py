import json

import pytest
from pyspark.sql import functions as F

from genomill import cli
from genomill.model import read_depths, calls
from genomill.plans import config, queries, stages  # noqa: F401
from genomill.plans.executor import STAGES, Context, Executor, Names, Registry, Stage, levels, map_parallel


def test_config():
    assert config.merge({"a": {"b": 1, "c": 2}}, {"a": {"b": 3}}) == {"a": {"b": 3, "c": 2}}
    assert config.assign({}, "a.b=true") == {"a": {"b": True}}
    assert config.scalar("1.5") == 1.5 and config.scalar("x") == "x" and config.scalar("[1]") == [1]
    with pytest.raises(ValueError, match="out of range"):
        config.checked("s", {"x": config.Param(1, least=0, most=2)}, {"x": 3})
    with pytest.raises(ValueError, match="required"):
        config.checked("s", {"x": config.Param(required=True)}, {})
    with pytest.raises(ValueError, match="unknown settings"):
        config.Config.of({"pipelines": []})


def test_levels():
    s = lambda n, needs=(), makes=(): Stage(n, None, needs, (), makes)
    got = levels([s("c", ("y",)), s("b", ("x",), ("y",)), s("a", (), ("x",)), s("d")])
    assert [[x.name for x in level] for level in got] == [["a", "d"], ["b"], ["c"]]
    with pytest.raises(ValueError, match="cycle"):
        levels([s("a", ("y",), ("x",)), s("b", ("x",), ("y",))])
    with pytest.raises(ValueError, match="made by"):
        levels([s("a", (), ("x",)), s("b", (), ("x",))])


def test_registry():
    r = Registry()
    r.register("a")(lambda ctx, cfg: {})
    with pytest.raises(ValueError, match="twice"):
        r.register("a")(lambda ctx, cfg: {})
    assert len(STAGES.names()) == 34


def test_named_objects_and_parallel_calls(spark):
    n = Names("dataset")
    n.register("a")([1])
    assert n["a"] == [1] and n.names() == ["a"]
    with pytest.raises(ValueError, match="twice"):
        n.register("a")([2])
    with pytest.raises(KeyError, match="unknown dataset b"):
        n["b"]
    assert map_parallel(spark, lambda x: (x["v"] ** 2, "y"), [{"v": v} for v in range(5)]) == [(v * v, "y") for v in range(5)]
    assert map_parallel(spark, len, []) == []


def test_run_and_cache(spark, data, tmp_path):
    depths = read_depths(spark, data)
    raw = {
        "pipeline": ["load_genotypes", "analysis_readiness", "distance", "fst", "diversity", "roh", "f3", "dstats", "demography", "cluster", "nj_tree", "pca", "report"],
        "stages": {"f3": {"outgroup": 4}, "dstats": {"outgroup": 4, "min_window_sites": 2}, "nj_tree": {"n_bootstrap": 5}, "analysis_readiness": {"ld_r2_threshold": 0.95}},
        "run_dir": str(tmp_path),
    }
    ex = Executor(spark, config.Config.of(raw))
    assert [s for level in ex.run(dry_run=True, artifacts={"depths": depths})["plan"] for s in level][0] == "load_genotypes"
    got = ex.run(artifacts={"depths": depths})
    assert {k: v.get("error") for k, v in got["stages"].items() if v["status"] != "done"} == {}
    assert got["artifacts"]["fst"].count() == 10
    assert "<svg" in got["artifacts"]["report"]["html"]
    again = ex.run(artifacts={"depths": depths})
    assert {v["status"] for v in again["stages"].values()} == {"cached"}
    assert json.loads((tmp_path / "run" / "provenance.json").read_text())["run_id"] == "run"


def test_changed_inputs_and_markers(spark, tmp_path):
    sheet = tmp_path / "s.csv"
    sheet.write_text("sample_id,taxon,population\nA,dog,p\n")
    ex = Executor(spark, config.Config.of({"pipeline": ["sample_sheet"], "stages": {"sample_sheet": {"path": "s.csv"}}, "paths": {"root": str(tmp_path)}, "run_dir": str(tmp_path / "runs")}))
    assert [ex.run()["stages"]["sample_sheet"]["status"] for _ in range(2)] == ["done", "cached"]
    sheet.write_text("sample_id,taxon,population\nA,dog,p\nB,dog,q\n")
    got = ex.run()
    assert got["stages"]["sample_sheet"]["status"] == "done" and got["artifacts"]["sample_sheet"].count() == 2
    (tmp_path / "runs" / "run" / "pause").write_text("")
    stopped = ex.run()
    assert stopped["status"] == "interrupted" and stopped["left"] == ["sample_sheet"] and stopped["stages"] == {}
    (tmp_path / "runs" / "run" / "pause").unlink()
    assert ex.run()["stages"]["sample_sheet"]["status"] == "cached"
    assert "| sample_sheet | cached |" in (tmp_path / "runs" / "run" / "provenance.md").read_text()


def test_commands_follow_their_backends(spark):
    ctx = Context(spark, 0, "x", {"alignments": [{"sample_id": "a"}, {"sample_id": "b"}]})
    run = lambda name, **cfg: STAGES[name].run(ctx, config.checked(name, STAGES[name].params, cfg))
    assert "HaplotypeCaller" in run("call_variants")["gvcfs"][0]["command"]
    ctx.artifacts |= run("call_variants", backend="deepvariant")
    assert "run_deepvariant" in ctx.get("gvcfs")[1]["command"]
    assert "DeepVariantWGS" in run("joint_genotype")["joint_callset"][0]["command"]
    assert [x["command"].split()[1] for x in run("joint_genotype", backend="gatk")["joint_callset"]] == ["CombineGVCFs", "GenotypeGVCFs"]
    assert "bcftools call" in run("bcftools_call")["joint_calls"][0]["command"]


def test_readiness_of_named_contigs(spark, data, tmp_path):
    depths = read_depths(spark, data)
    named = calls(depths).withColumn("chrom", F.concat(F.lit("chr"), "chrom"))
    ex = Executor(spark, config.Config.of({"pipeline": ["analysis_readiness"], "run_dir": str(tmp_path)}))
    got = ex.run(artifacts={"genotypes": named})
    assert got["stages"]["analysis_readiness"].get("error") is None
    assert got["artifacts"]["analysis_genotypes"].filter("chrom like 'chr%'").count() > 0


def test_failure_leaves_nothing(spark, tmp_path):
    ex = Executor(spark, config.Config.of({"pipeline": ["sample_sheet"], "stages": {"sample_sheet": {"path": str(tmp_path / "none.csv")}}, "run_dir": str(tmp_path)}))
    got = ex.run()
    assert got["stages"]["sample_sheet"]["status"] == "failed"
    assert not (tmp_path / "run" / "sample_sheet").exists()


def test_cli(capsys):
    assert cli.main(["version"]) == 0
    assert cli.main(["stages"]) == 0
    assert "dstats" in capsys.readouterr().out


@pytest.mark.parametrize("name", ["fst", "dstats", "roh", "mixture_grid", "qpadm", "gl_em_freq", "near_duplicates", "distance"])
def test_queries_match_sql(spark, data, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "part", "orders", "lineitem"):
        con.sql(f"create view {t} as select * from read_parquet('{data}/{t}.parquet')")
    want = con.sql(queries.oracle_sql()[name])
    cols = sorted(want.columns)
    at = [want.columns.index(c) for c in cols]
    got = queries.queries()[name](spark, data)
    assert sorted(got.columns) == cols
    rows = lambda it: sorted((tuple(it_) for it_ in it), key=str)
    assert rows([r[c] for c in cols] for r in got.collect()) == rows([r[i] for i in at] for r in want.fetchall())


def test_calls_are_unique(spark, data):
    c = calls(read_depths(spark, data))
    assert c.count() == c.select("chrom", "pos", "sample_id").distinct().count()
