"""PLINK, PHYLIP, TreeMix, CSV and genotype stores."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.strings import contig_number
from ..model import SITE

#: PLINK .bed: magic bytes, and the two-bit code of 0, 1, 2 ALT and of missing (fixed values).
BED_MAGIC = b"\x6c\x1b\x01"
BED_CODES = (0b00, 0b10, 0b11, 0b01)


def _sites(calls: DataFrame, n: int) -> DataFrame:
    """A site's calls as one array in sample order; -1 is missing."""
    g = F.map_from_entries(F.collect_list(F.struct("sample_ord", F.coalesce("n_alt", F.lit(-1)))))
    return calls.groupBy(*SITE).agg(g.alias("m")).select(*SITE, contig_number(F.col("chrom").cast("string")).alias("number"), F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.coalesce(F.col("m")[i], F.lit(-1))).alias("g"))


def pack(calls: np.ndarray) -> bytes:
    """Two-bit codes of (sites x samples) calls, SNP-major, first sample in the low bits."""
    codes = np.array(BED_CODES, np.uint8)[np.where(calls < 0, 3, calls)]
    pad = -codes.shape[1] % 4
    codes = np.pad(codes, ((0, 0), (0, pad))).reshape(len(codes), -1, 4)
    return (codes << np.array([0, 2, 4, 6], np.uint8)).sum(axis=2).astype(np.uint8).tobytes()


def unpack(data: bytes, n_samples: int) -> np.ndarray:
    if data[:3] != BED_MAGIC:
        raise ValueError("not a SNP-major .bed")
    rows = np.frombuffer(data[3:], np.uint8).reshape(-1, -(-n_samples // 4))
    codes = ((rows[:, :, None] >> np.array([0, 2, 4, 6], np.uint8)) & 3).reshape(len(rows), -1)[:, :n_samples]
    back = np.zeros(4, np.int8)
    back[list(BED_CODES)] = (0, 1, 2, -1)
    return back[codes]


def plink(calls: DataFrame, samples: list[str]) -> DataFrame:
    """chrom, pos, bed bytes of each site's row, in order: what a .bed and .bim file hold."""
    n = len(samples)

    def rows(frames):  # noqa: ANN001, ANN202
        for frame in frames:
            if len(frame):
                data, width = pack(np.array(frame["g"].tolist())), -(-n // 4)
                yield pd.DataFrame({"number": frame["number"], "chrom": frame["chrom"].astype(str), "pos": frame["pos"], "bed": [data[i * width : (i + 1) * width] for i in range(len(frame))]})

    return _sites(calls, n).mapInPandas(rows, "number int, chrom string, pos bigint, bed binary").sort("number", "chrom", "pos")


def write_plink(calls: DataFrame, prefix: str, samples: list[str]) -> tuple[int, int]:
    """The .bed, .bim and .fam files of a prefix on the driver's file system; rows come one
    partition at a time.  Returns (sites, samples)."""
    n = 0
    alleles = calls.select(*SITE, *(c for c in ("ref", "alt") if c in calls.columns)).distinct()
    rows = plink(calls, samples).join(alleles.withColumn("chrom", F.col("chrom").cast("string")), SITE).sort("number", "chrom", "pos")
    with open(f"{prefix}.bed", "wb") as bed, open(f"{prefix}.bim", "w") as bim:
        bed.write(BED_MAGIC)
        for r in rows.toLocalIterator():
            ref, alt = (r["ref"], r["alt"]) if "alt" in rows.columns else ("1", "2")
            bed.write(bytes(r["bed"]))
            # ALT is the first allele, which the codes count.
            bim.write(f"{r['chrom']}\t{r['chrom']}:{r['pos']}\t0\t{r['pos']}\t{alt}\t{ref}\n")
            n += 1
    with open(f"{prefix}.fam", "w") as fam:
        fam.writelines(f"{s}\t{s}\t0\t0\t0\t-9\n" for s in samples)
    return n, len(samples)


def phylip_rows(calls: DataFrame, samples: list[str]) -> DataFrame:
    """ord, value: the lines of an alignment, the first (-1) with its size; A, W, T stand for 0,
    1, 2 ALT and N for missing.  A sequence is made on the executor that has its sample."""
    letter = F.when(F.col("n_alt") == 0, "A").when(F.col("n_alt") == 1, "W").when(F.col("n_alt") == 2, "T").otherwise("N")
    seqs = calls.groupBy("sample_ord").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(*SITE, letter.alias("x")))), lambda s: s["x"]), "").alias("s"))
    names = calls.sparkSession.createDataFrame(list(enumerate(samples)), "ord int, name string")
    lines = names.join(seqs, F.col("ord") == F.col("sample_ord"), "left").select("ord", F.concat_ws("  ", "name", F.coalesce("s", F.lit(""))).alias("value"))
    top = seqs.agg(F.coalesce(F.max(F.length("s")), F.lit(0)).alias("n")).select(F.lit(-1).alias("ord"), F.concat_ws(" ", F.lit(str(len(samples))), F.col("n").cast("string")).alias("value"))
    return top.unionByName(lines)


def phylip(calls: DataFrame, samples: list[str]) -> list[str]:
    """The alignment's lines on the driver, for small ones."""
    return [r["value"] for r in phylip_rows(calls, samples).orderBy("ord").collect()]


def treemix(count: DataFrame, populations: list) -> DataFrame:
    """One line a site, ``ref,alt`` of each population, under a header line."""
    pair = F.concat_ws(",", F.col("ref_n").cast("string"), F.col("alt_n").cast("string"))
    wide = count.groupBy(*SITE).pivot("population", populations).agg(F.first(pair))
    return wide.select(*SITE, F.concat_ws(" ", *[F.coalesce(F.col(str(p)), F.lit("0,0")) for p in populations]).alias("value"))


def write_treemix(count: DataFrame, populations: list, path: str) -> int:
    """The gzip file that the program reads: a line of names, then a line a site, in order; rows
    come one partition at a time.  Returns the number of sites."""
    import gzip

    rows, n = treemix(count, populations).sort(*SITE), 0
    with gzip.open(path, "wt") as out:
        out.write(" ".join(map(str, populations)) + "\n")
        for r in rows.select("value").toLocalIterator():
            out.write(r["value"] + "\n")
            n += 1
    return n


def save_store(calls: DataFrame, path: str) -> None:
    """The genotype store: Parquet by contig, sorted by position within a file."""
    calls.repartition("chrom").sortWithinPartitions("chrom", "pos").write.mode("overwrite").partitionBy("chrom").parquet(path)


def load_store(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def save_csv(frame: DataFrame, path: str) -> None:
    frame.write.mode("overwrite").option("header", True).csv(path)
