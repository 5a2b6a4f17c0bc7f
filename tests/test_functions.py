import math

import pytest
from pyspark.sql import functions as F

from genomill.functions import special, strings


def test_erfc(spark):
    xs = [0.0, 0.1, 1.0, 2.5, 5.0]
    got = [r["y"] for r in spark.createDataFrame([(x,) for x in xs], "x double").select(special.erfc(F.col("x")).alias("y")).collect()]
    for x, y in zip(xs, got, strict=True):
        assert y == pytest.approx(math.erfc(x), rel=2e-7)


@pytest.mark.parametrize(("x", "dof", "p"), [(3.841458820694124, 1, 0.05), (5.991464547107979, 2, 0.05), (0.0, 3, 1.0), (18.307038053275146, 10, 0.05)])
def test_chi2(x, dof, p):
    assert special.chi2_sf(x, dof) == pytest.approx(p, abs=1e-9)


def test_genotype_fields(spark):
    rows = [("0/1:25:9",), ("1|1:5:9",), ("./.:40:9",), ("0/2:40:9",), ("1:40:9",), ("0/0",)]
    got = spark.createDataFrame(rows, "f string").select(strings.genotype(F.col("f")).alias("a"), strings.genotype_where(F.col("f"), F.lit("GT:GQ:DP"), 20, 5).alias("b")).collect()
    assert [r["a"] for r in got] == [1, 2, None, None, None, 0]
    assert [r["b"] for r in got] == [1, None, None, None, None, None]


def test_likelihoods_and_names(spark):
    got = spark.createDataFrame([("0,60,400",), ("x",), ("1,2",)], "f string").select(strings.likelihoods(F.col("f")).alias("p")).collect()
    assert [r["p"] for r in got] == [[0, 60, 255], [0, 0, 0], [0, 0, 0]]
    kinds = spark.createDataFrame([("GrayWolf12",), ("VillDog_Peru3",), ("BoxerMix1",), ("Boxer7",), ("",), ("IrishWolfhound2",), ("PER4",), ("CFA.",), ("B4x1",)], "s string").select(strings.group_kind(strings.group_name(F.col("s"))).alias("k")).collect()
    assert [r["k"] for r in kinds] == ["wild", "village", "mixed", "breed", "ambiguous", "breed", "village", "ambiguous", "ambiguous"]
    autos = spark.createDataFrame([("chr1",), ("38",), ("X",), ("39",), ("CHR2",)], "c string").select(strings.is_autosome(F.col("c")).alias("a")).collect()
    assert [r["a"] for r in autos] == [True, True, False, False, True]
