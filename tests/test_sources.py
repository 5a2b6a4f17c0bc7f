import gzip
import json
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from genomill.sources import exports, panels, tabix, vcf
from genomill.streaming import counts as streaming

VCF = """##fileformat=VCFv4.2
##reference=build7
#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS1\tS2
chr2\t20\t.\tA\tG\t.\tPASS\t.\tGT:GQ\t0/1:30\t1|1:10
chr1\t10\t.\tc\tt\t.\tPASS\t.\tGT:GQ\t./.:0\t0/0:40
chr1\t11\t.\tAT\tG\t.\tPASS\t.\tGT\t0/1\t0/0
chr1\t12\t.\tA\tG,T\t.\tPASS\t.\tGT\t0/1\t0/2
chr10\t5\t.\tA\tG\t.\tPASS\t.\tGT:GQ\t0/.:30\t0/1:30
"""


def test_vcf_round_trip(spark, tmp_path):
    (tmp_path / "x.vcf").write_text(VCF)
    meta, samples = vcf.header(spark, str(tmp_path / "x.vcf"))
    assert samples == ["S1", "S2"] and vcf.reference_build(meta) == "build7"
    c = vcf.calls(spark, str(tmp_path / "x.vcf"))
    got = {(r["chrom"], r["pos"], r["sample_id"]): (r["a0"], r["a1"], r["n_alt"]) for r in c.collect()}
    assert len(got) == 6
    assert got[("chr1", 10, "S1")] == (None, None, None)
    assert got[("chr10", 5, "S1")] == (0, None, None)
    assert got[("chr2", 20, "S2")] == (1, 1, 2)
    assert vcf.calls(spark, str(tmp_path / "x.vcf"), min_gq=20).filter("n_alt is not null").count() == 3
    vcf.write(c, str(tmp_path / "out"), samples)
    again = vcf.calls(spark, str(tmp_path / "out"))
    assert {(r["chrom"], r["pos"], r["sample_id"]): (r["a0"], r["a1"], r["n_alt"]) for r in again.collect()} == got
    order = [(r["chrom"], r["pos"]) for r in vcf.records(spark, str(tmp_path / "out")).collect()]
    assert order == [("chr1", 10), ("chr2", 20), ("chr10", 5)]
    with pytest.raises(ValueError, match="loci"):
        vcf.bridge_sites(spark, str(tmp_path / "x.vcf"))


def test_sample_sheet(spark, tmp_path):
    p = tmp_path / "s.csv"
    p.write_text("sample_id,taxon,population,latitude\nA, Gray_Wolf ,p,10\nB,dog,q,\n")
    rows = {r["sample_id"]: r for r in panels.sample_sheet(spark, str(p), {"gray_wolf", "dog"}).collect()}
    assert rows["A"]["taxon"] == "gray_wolf" and rows["A"]["latitude"] == 10 and rows["B"]["latitude"] is None
    for text, what in (("sample_id,taxon\nA,x\n", "missing"), ("sample_id,taxon,population\nA,x,p\nA,x,p\n", "duplicate"), ("sample_id,taxon,population\nA,x,\n", "population"), ("sample_id,taxon,population,latitude\nA,x,p,95\n", "latitude")):
        p.write_text(text)
        with pytest.raises(ValueError, match=what):
            panels.sample_sheet(spark, str(p))


def test_panels(spark, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps({"samples": ["a", "b"], "loci": {"chr1:5": ["0/1", None], "chr2:7": ["1/1", "0/0"]}}))
    got = {(r["chrom"], r["pos"], r["sample_id"]): r["n_alt"] for r in panels.json_panel(spark, str(tmp_path / "p.json")).collect()}
    assert got == {("chr1", 5, "a"): 1, ("chr1", 5, "b"): None, ("chr2", 7, "a"): 2, ("chr2", 7, "b"): 0}
    (tmp_path / "c.csv").write_text("chrom,position,ref,alt,gt,depth,ref_count,alt_count\nchr1,5,A,G,0/1,20,10,10\nchr1,6,A,G,0/1,4,0,4\nchr1,7,A,G,0/1,20,19,1\n")
    c = panels.allele_counts(spark, str(tmp_path / "c.csv"))
    assert [r["n_alt"] for r in c.orderBy("pos").collect()] == [1, None, 0]
    with pytest.raises(ValueError, match="coordinates"):
        panels.allele_counts(spark, str(tmp_path / "c.csv"), c.filter("pos < 7").select("chrom", "pos"))


def test_pileup(spark, tmp_path):
    sam = "@HD\nr1\t0\tchr1\t100\t60\t2S3M1D3M\t*\t0\t0\tTTACGTAC\tIIIIIIII\nr2\t1024\tchr1\t100\t60\t5M\t*\t0\t0\tAAAAA\tIIIII\nr3\t0\tchr1\t103\t10\t5M\t*\t0\t0\tAAAAA\tIIIII\nr4\t512\tchr1\t104\t60\t1M\t*\t0\t0\tT\tI\nr5\t2048\tchr1\t104\t60\t1M\t*\t0\t0\tT\tI\n"
    (tmp_path / "x.sam").write_text(sam)
    sites = spark.createDataFrame([("chr1", 100), ("chr1", 103), ("chr1", 104)], "chrom string, pos bigint")
    got = {r["pos"]: (r["base"], r["n"]) for r in panels.pileup(spark, str(tmp_path / "x.sam"), sites).collect()}
    assert got == {100: ("A", 1), 104: ("T", 2)}


def block(data: bytes) -> bytes:
    c = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = c.compress(data) + c.flush()
    return struct.pack("<4BI2BH2B2H", 31, 139, 8, 4, 0, 0, 255, 6, 66, 67, 2, len(body) + 25) + body + struct.pack("<2I", zlib.crc32(data), len(data))


def test_indexed_vcf(spark, tmp_path):
    one, two = b"#h\n1\t100\tx\n1\t200\ty\n", b"1\t20000\tz\n2\t5\tw\n"
    a, b = block(one), block(two)
    (tmp_path / "x.vcf.gz").write_bytes(a + b + block(b""))
    mid, end = len(a) << 16, (len(a) + len(b)) << 16
    ref = lambda bins, linear: struct.pack("<i", len(bins)) + b"".join(struct.pack("<Ii", n, len(c)) + b"".join(struct.pack("<QQ", *x) for x in c) for n, c in bins.items()) + struct.pack("<i", len(linear)) + b"".join(struct.pack("<Q", x) for x in linear)
    raw = b"TBI\x01" + struct.pack("<8i", 2, 2, 1, 2, 0, 35, 0, 4) + b"1\x002\x00" + ref({4681: [(0, mid)], 4682: [(mid, end)]}, [0, mid]) + ref({4681: [(mid + 10, end)]}, [mid + 10])
    (tmp_path / "x.vcf.gz.tbi").write_bytes(gzip.compress(raw))
    spark.dataSource.register(tabix.IndexedVcf)
    rows = spark.read.format("indexed_vcf").options(path=str(tmp_path / "x.vcf.gz"), positions="1:200,1:20000,2:5,2:6").load()
    assert sorted((r["chrom"], r["pos"]) for r in rows.collect()) == [("1", 200), ("1", 20000), ("2", 5)]
    assert tabix.bins_of(0, 1) == [0, 1, 9, 73, 585, 4681]
    with pytest.raises(ValueError, match="ceiling"):
        tabix.enforce(10, 5)
    with pytest.raises(ValueError, match="confirmed"):
        tabix.enforce(2_000_000_000)


def test_window_panel(spark, tmp_path):
    top = "##contig=<ID=chr1,length=40000>\n##contig=<ID=chrX,length=900>\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tA\tB\n"
    row = lambda pos, a, b, keep="PASS", alt="G": f"chr1\t{pos}\t.\tA\t{alt}\t.\t{keep}\t.\tGT:GQ:PL\t{a}\t{b}\n"
    one = row(100, "0/0:9:0,1,300", "0/1:120:9,0,9") + row(200, "0/0:9:.", "0/0:9:0,1,2") + row(300, "1/1:9:1,1,1", "0/1:9:1,1,1", "LOW")
    two = row(21000, "1|1:3:7,7,0", "./.:.:.") + row(21001, "0/1:3:7,0,7", "0/0:1:0,7,7", alt="GT") + "chr1\t21002\tcut"
    head, a, b = block(top.encode()), block(one.encode()), block(two.encode())
    (tmp_path / "x.vcf.gz").write_bytes(head + a + b + block(b""))
    u, v, w = len(head) << 16, (len(head) + len(a)) << 16, (len(head) + len(a) + len(b)) << 16
    bins = {4681: [(u, v)], 4682: [(v, w)]}
    raw = b"TBI\x01" + struct.pack("<8i", 1, 2, 1, 2, 0, 35, 0, 5) + b"chr1\x00" + struct.pack("<i", len(bins)) + b"".join(struct.pack("<Ii", n, len(c)) + b"".join(struct.pack("<QQ", *x) for x in c) for n, c in bins.items()) + struct.pack("<i3Q", 3, u, v, v)
    (tmp_path / "x.vcf.gz.tbi").write_bytes(gzip.compress(raw))
    calls, spans = vcf.window_panel(spark, str(tmp_path / "x.vcf.gz"), ["B", "A"], 2, window_bytes=len(a), max_bytes=10_000)
    got = {(r["window"], r["pos"], r["sample_id"]): (r["n_alt"], r["gq"], r["pl"]) for r in calls.collect()}
    assert got[0, 100, "B"] == (1, 99, [9, 0, 9]) and got[0, 100, "A"] == (0, 9, [0, 1, 255])
    assert {k[1] for k in got if k[0] == 0} == {100}
    assert {(r["window"], r["first"], r["last"]) for r in spans.collect()} >= {(0, 100, 300)}
    with pytest.raises(ValueError, match="no samples"):
        vcf.window_panel(spark, str(tmp_path / "x.vcf.gz"), ["C"], 2)


def test_exports(spark):
    c = spark.createDataFrame([("1", 5, "a", 0, 0), ("1", 5, "b", 1, 2), ("1", 9, "a", 0, 1)], "chrom string, pos bigint, sample_id string, sample_ord int, n_alt int")
    assert exports.phylip(c, ["a", "b"]) == ["2 2", "a  AW", "b  T"]
    rows = exports.plink(c, ["a", "b"]).collect()
    assert exports.unpack(exports.BED_MAGIC + b"".join(bytes(r["bed"]) for r in rows), 2).tolist() == [[0, 2], [1, -1]]


def test_streaming_counts(spark, tmp_path):
    rows = spark.createDataFrame([(1, 5, 0, 1), (1, 5, 0, 2), (1, 5, 1, None), (1, 6, 0, 0)], "chrom bigint, pos bigint, population bigint, n_alt int")
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    q = streaming.running_counts(stream).writeStream.outputMode("complete").format("memory").queryName("counts").trigger(availableNow=True).start()
    q.awaitTermination(60)
    got = {(r["pos"], r["population"]): (r["n_called"], r["alt_n"]) for r in spark.table("counts").collect()}
    assert got == {(5, 0): (2, 3), (6, 0): (1, 0)}


def test_events(spark, data):
    events = spark.read.parquet(f"{data}/events.parquet")
    out = streaming.windowed_events(events)
    assert out.agg(F.sum("n")).first()[0] == events.count()
