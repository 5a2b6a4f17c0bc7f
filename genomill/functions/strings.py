"""Contigs, loci and names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Autosomes of the study species (fixed value).
AUTOSOMES = 38
#: Name rules of the reference panel's groups (fixed values, in order of precedence).
BREEDS_ALL_THE_SAME = ("IrishWolfhound",)
WILD = ("coyote", "wolf", "jackal", "fox", "dhole", "lycaon", "wilddog", "dingo", "ngsd", "newguineasinging")
VILLAGE_PREFIX, VILLAGE = "VillDog_", "indigenousdog"
VILLAGE_CODES, UNRESOLVED = ("PER", "BAN"), ("CFA.", "Helsinki_BC")
MIXED = ("mix", "unknown")


def canonical_contig(c: Column) -> Column:
    return F.regexp_replace(F.trim(c), "(?i)^chr", "")


def contig_number(c: Column) -> Column:
    """The contig's number, null if it has none; sort by it first, then by name."""
    bare = canonical_contig(c)
    return F.when(bare.rlike("^[0-9]+$"), bare.cast("int"))


def is_autosome(c: Column, most: int = AUTOSOMES) -> Column:
    return F.coalesce(contig_number(c).between(1, most), F.lit(False))


def complement(base: Column) -> Column:
    return F.translate(F.upper(base), "ACGT", "TGCA")


def group_name(sample: Column) -> Column:
    """A sample's name less its running number."""
    return F.regexp_replace(sample, "[0-9]+$", "")


def group_kind(group: Column) -> Column:
    """wild, village, mixed, ambiguous or breed; names that are short or hold digits tell nothing."""
    low = F.lower(group)
    has = lambda words: low.rlike("|".join(words))
    village = group.startswith(VILLAGE_PREFIX) | low.contains(VILLAGE) | group.isin(*VILLAGE_CODES)
    unclear = group.isNull() | group.isin(*UNRESOLVED) | group.rlike("[0-9]") | (F.length(group) <= 3)
    out = F.when(group.isin(*BREEDS_ALL_THE_SAME), "breed").when(has(WILD), "wild").when(village, "village")
    return out.when(group.isin(UNRESOLVED[0]), "ambiguous").when(has(MIXED), "mixed").when(unclear, "ambiguous").otherwise("breed")


def genotype(field: Column, index: int = 0) -> Column:
    """ALT count of a VCF sample field: diploid and biallelic, phased or not; else null."""
    gt = F.split(field, ":")[index]
    return F.when(gt.rlike("^[01][/|][01]$"), F.substring(gt, 1, 1).cast("int") + F.substring(gt, 3, 1).cast("int"))


def genotype_where(field: Column, fmt: Column, min_gq: float = 0, min_dp: float = 0) -> Column:
    """``genotype``, null where GQ or DP is below its minimum or absent."""
    parts, names = F.split(field, ":"), F.split(fmt, ":")
    value = lambda name: F.try_element_at(parts, F.array_position(names, name).cast("int"))
    gt = value("GT")
    ok = F.lit(True)
    for name, least in (("GQ", min_gq), ("DP", min_dp)):
        if least > 0:
            ok = ok & F.coalesce(value(name).try_cast("double") >= least, F.lit(False))
    return F.when(ok, genotype(gt))


def likelihoods(field: Column) -> Column:
    """Phred likelihoods of three genotypes, 255 at most; (0, 0, 0) if malformed."""
    good = field.rlike("^[0-9]+,[0-9]+,[0-9]+$")
    return F.when(good, F.transform(F.split(field, ","), lambda x: F.least(x.cast("int"), F.lit(255)))).otherwise(F.array(F.lit(0), F.lit(0), F.lit(0)))


def locus_key(chrom: Column, pos: Column) -> Column:
    return F.concat_ws(":", chrom.cast("string"), pos.cast("string"))
