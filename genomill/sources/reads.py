"""Read archives: size checks, checked downloads, and downsampling of whole fragments.

An archive is a gzip stream, which only one task can read; archives are tasks of their own.
A fragment (the records of one read pair, or a single read) is kept by a hash of its name, so
that mates stay together and a task that runs again keeps the same reads.
"""

from __future__ import annotations

import gzip
import hashlib
import os
import uuid
from collections.abc import Iterator
from contextlib import ExitStack
from typing import Any, BinaryIO
from urllib.request import Request, urlopen

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from ..shipping import ship
from .panels import LAYOUTS
from .tabix import enforce

ARCHIVES = "sample_id string, layout string, urls array<string>, checksums array<string>, fraction double"
FETCHED = "sample_id string, layout string, fastq1 string, fastq2 string, fragments bigint, kept bigint, md5 array<string>, sha256 array<string>"


def _open(url: str, timeout: int, method: str = "GET") -> Any:
    if url.startswith(("http://", "https://")):
        return urlopen(Request(url, method=method), timeout=timeout)  # noqa: S310
    return open(url.removeprefix("file://"), "rb")


def size_of(url: str, timeout: int = 60) -> int:
    """What a HEAD request, or the file system, says."""
    if not url.startswith(("http://", "https://")):
        return os.path.getsize(url.removeprefix("file://"))
    with _open(url, timeout, "HEAD") as r:
        if r.headers.get("Content-Length") is None:
            raise OSError(f"{url}: no size is told")
        return int(r.headers["Content-Length"])


class Hashed:
    """A stream that hashes what is read from it."""

    def __init__(self, stream: BinaryIO) -> None:
        self.stream, self.md5, self.sha256 = stream, hashlib.md5(usedforsecurity=False), hashlib.sha256()

    def read(self, n: int = -1) -> bytes:
        data = self.stream.read(n)
        self.md5.update(data)
        self.sha256.update(data)
        return data

    def rest(self) -> None:
        while self.read(1 << 20):
            pass

    def check(self, expected: str, url: str) -> None:
        """``expected``: hexadecimal, MD5 or SHA-256 by its length; empty checks nothing."""
        own = {0: "", 32: self.md5.hexdigest(), 64: self.sha256.hexdigest()}.get(len(expected))
        if own is None or own != expected.lower():
            raise ValueError(f"{url}: its checksum is not {expected}")


def records(stream: Any, url: str) -> Iterator[tuple[bytes, list[bytes]]]:
    """(fragment name, the four lines) of FASTQ records; an incomplete one is an error."""
    while first := stream.readline():
        lines = [first, *(stream.readline() for _ in range(3))]
        if not lines[3] or not first.startswith(b"@") or not lines[2].startswith(b"+"):
            raise ValueError(f"{url}: not FASTQ, or cut off")
        yield first[1:].split()[0].removesuffix(b"/1").removesuffix(b"/2"), lines


def kept(name: bytes, fraction: float, seed: int) -> bool:
    h = int.from_bytes(hashlib.blake2b(name, digest_size=8, salt=str(seed).encode()[:16]).digest(), "little")
    return h < fraction * 2.0**64


def fetch_one(sample: str, layout: str, urls: list[str], checksums: list[str], fraction: float, folder: str, seed: int, timeout: int) -> dict:
    """Streams one archive set into ``folder``; files appear whole or not at all."""
    if layout not in LAYOUTS or len(urls) != (2 if layout == "paired" else 1) or not 0 < fraction <= 1:
        raise ValueError(f"{sample}: layout, number of files or fraction is wrong")
    names = [f"{sample}_{x}.fastq.gz" for x in (("R1", "R2") if layout == "paired" else (layout,))]
    parts = [os.path.join(folder, f".{n}.{uuid.uuid4().hex}") for n in names]
    os.makedirs(folder, exist_ok=True)
    total = passed = 0
    try:
        with ExitStack() as stack:
            raw = [Hashed(stack.enter_context(_open(u, timeout))) for u in urls]
            files = [records(gzip.GzipFile(fileobj=r), u) for r, u in zip(raw, urls, strict=True)]
            outs = [stack.enter_context(gzip.open(p, "wb", compresslevel=6)) for p in parts]
            units = zip(*files, strict=True) if layout == "paired" else ((a, b) for a, b in _twos(files[0], urls[0])) if layout == "interleaved" else ((a,) for a in files[0])
            for unit in units:
                if any(n != unit[0][0] for n, _ in unit):
                    raise ValueError(f"{sample}: mates do not match at {unit[0][0].decode()}")
                total += 1
                if kept(unit[0][0], fraction, seed):
                    passed += 1
                    for i, (_, lines) in enumerate(unit):
                        outs[i % len(outs)].writelines(lines)
            for r, u, c in zip(raw, urls, checksums or [""] * len(urls), strict=True):
                r.rest()
                r.check(c, u)
        for part, name in zip(parts, names, strict=True):
            os.replace(part, os.path.join(folder, name))
    finally:
        for part in parts:
            if os.path.exists(part):
                os.remove(part)
    paths = [os.path.join(folder, n) for n in names]
    return {"sample_id": sample, "layout": layout, "fastq1": paths[0], "fastq2": paths[1] if layout == "paired" else None, "fragments": total, "kept": passed, "md5": [r.md5.hexdigest() for r in raw], "sha256": [r.sha256.hexdigest() for r in raw]}


def _twos(rows: Iterator, url: str) -> Iterator[tuple]:
    for a in rows:
        b = next(rows, None)
        if b is None:
            raise ValueError(f"{url}: a mate is missing at the end")
        yield a, b


def acquire(spark: SparkSession, archives: list[dict], folder: str, max_bytes: int = 9_000_000_000, confirmed: bool = False, seed: int = 0, timeout: int = 120) -> DataFrame:
    """FETCHED rows of archives (``sample_id, layout, urls[, checksums, fraction]``), one task
    each.  Sizes are asked first and held against the ceiling.  ``folder`` has to be a path
    that all executors share."""
    rows = [(a["sample_id"], a.get("layout", "paired"), list(a["urls"]), list(a.get("checksums") or []), float(a.get("fraction", 1.0))) for a in archives]
    if len({r[0] for r in rows}) < len(rows):
        raise ValueError("a sample is named twice")
    enforce(sum(size_of(u) for r in rows for u in r[2]), max_bytes, confirmed=confirmed)
    ship(spark)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for r in f.itertuples(index=False):
                yield pd.DataFrame([fetch_one(r.sample_id, r.layout, list(r.urls), list(r.checksums), r.fraction, folder, seed, timeout)])

    each = spark.createDataFrame(rows, ARCHIVES)
    return each.repartition(max(1, len(rows)), "sample_id").mapInPandas(run, FETCHED)
