import gzip
import hashlib

import numpy as np
import pytest

from genomill.operators import matrix
from genomill.plans import citations, figures, report
from genomill.sources import exports, reads, tabix


def test_citation_bundles(tmp_path):
    folder = tmp_path / citations.FOLDER
    folder.mkdir(parents=True)
    (folder / "one.yaml").write_text("id: one\nlabel: One\nsources:\n- {key: a, label: A, doi: 'https://doi.org/10.1/x', year: 2019}\n- {key: b, label: B, accession: PRJ1, accession_kind: bioproject}\n- {key: c, label: C, url: 'http://x'}\n- {key: d, label: D}\n")
    got = citations.rows(citations.load(["one", str(folder / "one.yaml")], str(tmp_path)))
    assert [r["link"] for r in got] == ["https://doi.org/10.1/x", "https://www.ncbi.nlm.nih.gov/bioproject/PRJ1", "http://x", ""]
    assert got[0]["doi"] == "10.1/x" and got[0]["dataset"] == "One" and got[0]["year"] == 2019
    with pytest.raises(ValueError, match="no citation bundle"):
        citations.load(["two"], str(tmp_path))
    (folder / "bad.yaml").write_text("label: x\n")
    with pytest.raises(ValueError, match="id and label"):
        citations.load(["bad"], str(tmp_path))


def test_figures(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(7, 2))
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    merges = figures.merges_of(d)
    for k in (2, 3, 4):  # cutting the merges gives the clusters
        at = {i: {i} for i in range(7)}
        for n, (a, b, _) in enumerate(merges[: 7 - k]):
            at[7 + n] = at.pop(a) | at.pop(b)
        labels = matrix.average_linkage(d, k)
        assert {frozenset(v) for v in at.values()} == {frozenset(np.flatnonzero(labels == c).tolist()) for c in range(k)}
    assert figures.dendrogram([f"s{i}" for i in range(7)], merges).count("<text") == 7
    drawn = figures.tree("((a:1,b:2)90:0.5,c:3,d:0.1);")
    assert drawn.count("<text") >= 5 and ">90<" in drawn and ">a<" in drawn
    frames = {
        "pca": spark.createDataFrame([("a", 0.1, 0.2), ("b", 0.3, -1.0)], "sample_id string, PC1 double, PC2 double"),
        "sample_sheet": spark.createDataFrame([("a", "p", 1.0, 2.0), ("b", "q", None, None)], "sample_id string, population string, latitude double, longitude double"),
        "admixture": spark.createDataFrame([("a", 0.25, 0.75)], "sample_id string, Q1 double, Q2 double"),
        "distance": spark.createDataFrame([("a", "b", 0.4)], "s1 string, s2 string, distance double"),
        "places_km": spark.createDataFrame([("a", "b", 40.0)], "s1 string, s2 string, km double"),
        "roh": spark.createDataFrame([("a", 0.2), ("b", 0.1)], "sample_id string, f_roh double"),
        "fd_windows": spark.createDataFrame([("1", 0, 0.2), ("2", 0, -0.1), ("2", 5, None)], "chrom string, start bigint, f_d double"),
        "ancestry_windows": spark.createDataFrame([("a", "1", 0, "p"), ("a", "1", 10, "q")], "sample_id string, chrom string, start bigint, ancestry string"),
        "diversity": spark.createDataFrame([("p", 0.1)], "population string, pi double"),
        "fractions": spark.createDataFrame([("a", 0.1), ("b", None)], "sample_id string, fraction double"),
        "breed_scores": spark.createDataFrame([("a", "x", 1, -3.0, 6.0), ("a", "y", 2, -4.0, 6.0)], "sample_id string, panel string, rank int, loglik double, gap double"),
        "mixture": spark.createDataFrame([("a", 0.1, 0.2)], "sample_id string, share_one double, share_two double"),
        "fst": spark.createDataFrame([("p", "q", 0.1)], "pop1 string, pop2 string, fst double"),
        "exclusions": spark.createDataFrame([], "id string"),
    }
    artifacts = frames | {"nj": {"newick": "(a:1,b:2);"}, "readiness": {"warnings": ["x"]}}
    assert len(report.drawings(artifacts)) == 15
    labels = [b[1] for b in report.badges(artifacts, True)]
    assert labels[0] == "Exploratory" and "Quality gate passed" in labels and "Readiness: 1 warnings" in labels and "Bridge-locus diagnostic" in labels
    page = report.html(artifacts, "<T>", True, [citations.source({"key": "a", "label": "A&B", "url": "http://x"}) | {"dataset": "D"}])
    assert "&lt;T&gt;" in page and "A&amp;B" in page and page.count("<svg") == 14
    assert "No quality gate" in report.html({}, "t")


def fastq(names, mate=""):
    return "".join(f"@{n}{mate} x\nACGT\n+\nIIII\n" for n in names).encode()


def test_read_archives(spark, tmp_path):
    names = [f"r{i}" for i in range(400)]
    for f, data in (("a1", fastq(names, "/1")), ("a2", fastq(names, "/2")), ("b", b"".join(fastq([n]) * 2 for n in names)), ("c", fastq(names)), ("odd", fastq(names[1:], "/2")), ("cut", fastq(names)[:-9])):
        (tmp_path / f"{f}.gz").write_bytes(gzip.compress(data))
    url = lambda f: f"file://{tmp_path}/{f}.gz"
    digest = hashlib.sha256((tmp_path / "c.gz").read_bytes()).hexdigest()
    archives = [{"sample_id": "A", "layout": "paired", "urls": [url("a1"), url("a2")], "fraction": 0.3}, {"sample_id": "B", "layout": "interleaved", "urls": [url("b")], "fraction": 0.5}, {"sample_id": "C", "layout": "single", "urls": [url("c")], "checksums": [digest]}]
    got = {r["sample_id"]: r for r in reads.acquire(spark, archives, str(tmp_path / "out"), seed=4).collect()}
    lines = {s: [gzip.open(p, "rt").read().split("\n")[:-1] for p in (r["fastq1"], r["fastq2"]) if p] for s, r in got.items()}
    assert got["A"]["fragments"] == 400 and 80 < got["A"]["kept"] < 160
    one, two = ([x[1:].split("/")[0] for x in f[::4]] for f in lines["A"])
    assert one == two and len(one) == got["A"]["kept"]
    pairs = lines["B"][0][::4]
    assert pairs[::2] == pairs[1::2] and len(pairs) == 2 * got["B"]["kept"]
    assert len(lines["C"][0]) == 1600 and got["C"]["sha256"] == [digest]
    for bad, what in (({"layout": "paired", "urls": [url("a1"), url("odd")]}, "match|argument"), ({"layout": "single", "urls": [url("cut")]}, "cut off"), ({"layout": "single", "urls": [url("c")], "checksums": ["0" * 64]}, "checksum")):
        with pytest.raises(ValueError, match=what):
            reads.fetch_one("X", bad["layout"], bad["urls"], bad.get("checksums", []), 1.0, str(tmp_path / "bad"), 0, 5)
    assert list((tmp_path / "bad").iterdir()) == []
    with pytest.raises(ValueError, match="ceiling"):
        reads.acquire(spark, archives, str(tmp_path / "out"), max_bytes=10)


def test_anchors_are_even():
    got = tabix.anchors({"1": 1000, "2": 500, "3": 10}, 10)
    flat = [{"1": 0, "2": 1000, "3": 1500}[c] + p - 1 for c, p in got]
    assert len(got) == 10 and flat == [int(151 / 2 + k * 151) for k in range(10)]
    assert tabix.contig_lengths(["##contig=<ID=1,length=5>", "##contig=<ID=x>", "#CHROM"]) == {"1": 5}


def test_files_of_other_programs(spark, tmp_path):
    c = spark.createDataFrame([("1", 5, "A", "G", 0, 0), ("1", 5, "A", "G", 1, 2), ("1", 9, "C", "T", 0, 1), ("10", 2, "C", "T", 1, None), ("2", 7, "G", "A", 1, 1)], "chrom string, pos bigint, ref string, alt string, sample_ord int, n_alt int")
    assert exports.write_plink(c, str(tmp_path / "x"), ["a", "b"]) == (4, 2)
    got = exports.unpack((tmp_path / "x.bed").read_bytes(), 2)
    assert got.tolist() == [[0, 2], [1, -1], [-1, 1], [-1, -1]]
    assert [x.split("\t")[1] for x in (tmp_path / "x.bim").read_text().splitlines()] == ["1:5", "1:9", "2:7", "10:2"]
    assert (tmp_path / "x.fam").read_text().splitlines()[1].split("\t")[:2] == ["b", "b"]
    counts = spark.createDataFrame([(1, 5, 0, 3, 1), (1, 5, 1, 0, 2), (1, 9, 0, 4, 0)], "chrom bigint, pos bigint, population bigint, ref_n bigint, alt_n bigint")
    assert exports.write_treemix(counts, [0, 1], str(tmp_path / "t.gz")) == 2
    assert gzip.open(tmp_path / "t.gz", "rt").read().splitlines() == ["0 1", "3,1 0,2", "4,0 0,0"]
