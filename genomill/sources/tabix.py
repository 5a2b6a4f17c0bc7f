"""Ranged reads of block-compressed, tabix-indexed files (formats of the public
specification), as a Spark data source with one partition per merged range."""

from __future__ import annotations

import gzip
import math
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path
from urllib.request import Request, urlopen

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Blocks hold 64 KB at most; a range is read past its end by this much.
BLOCK = 1 << 16


def fetch(url: str, start: int = 0, end: int | None = None, timeout: int = 120) -> bytes:
    """Bytes [start, end) of a file or of an http(s) address that grants ranges."""
    if url.startswith(("http://", "https://")):
        headers = {"Range": f"bytes={start}-{'' if end is None else end - 1}"} if start or end is not None else {}
        with urlopen(Request(url, headers=headers), timeout=timeout) as r:  # noqa: S310
            if headers and r.status != 206:
                raise OSError(f"{url}: no ranges")
            return r.read()
    with open(url.removeprefix("file://"), "rb") as f:
        f.seek(start)
        return f.read() if end is None else f.read(end - start)


def inflate(data: bytes, skip: int = 0) -> bytes:
    """The content of whole gzip members in ``data``, less the first ``skip`` bytes; a cut
    member at the end is left out."""
    out = []
    while data:
        d = zlib.decompressobj(31)
        try:
            part = d.decompress(data)
        except zlib.error:
            break
        if not d.eof:
            break
        out.append(part)
        data = d.unused_data
    return b"".join(out)[skip:]


@dataclass
class Index:
    """Of one contig: {bin: [(begin, end) virtual offsets]} and the linear index."""

    bins: dict[int, list[tuple[int, int]]]
    linear: list[int]


def parse_index(data: bytes) -> dict[str, Index]:
    raw = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
    if raw[:4] != b"TBI\x01":
        raise ValueError("not a tabix index")
    n_ref, *_, l_nm = struct.unpack_from("<8i", raw, 4)
    names = raw[36 : 36 + l_nm].rstrip(b"\0").split(b"\0")
    at, out = 36 + l_nm, {}

    def take(fmt: str) -> tuple:
        nonlocal at
        got = struct.unpack_from(fmt, raw, at)
        at += struct.calcsize(fmt)
        return got

    for i in range(n_ref):
        bins = {}
        for _ in range(take("<i")[0]):
            number, n = take("<Ii")
            bins[number] = [take("<QQ") for _ in range(n)]
        linear = list(take(f"<{take('<i')[0]}Q"))
        out[names[i].decode()] = Index(bins, linear)
    return out


def bins_of(begin: int, end: int) -> list[int]:
    """Bins that may hold records of the half-open, 0-based interval."""
    last = end - 1
    return [0] + [b for first, shift in ((1, 26), (9, 23), (73, 20), (585, 17), (4681, 14)) for b in range(first + (begin >> shift), first + (last >> shift) + 1)]


def chunks_for(index: Index, pos: int) -> list[tuple[int, int]]:
    """Virtual ranges to read for a 1-based position."""
    window = (pos - 1) >> 14
    floor = index.linear[window] if window < len(index.linear) else 0
    return sorted(c for b in bins_of(pos - 1, pos) for c in index.bins.get(b, []) if c[1] > floor)


def merged(chunks: set[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges that touch or overlap, on file offsets, as one."""
    out: list[list[int]] = []
    for a, b in sorted(chunks):
        if out and a >> 16 <= (out[-1][1] >> 16) + BLOCK:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def plan(index: dict[str, Index], positions: list[tuple[str, int]]) -> list[tuple[int, int]]:
    return merged({c for chrom, pos in positions if chrom in index for c in chunks_for(index[chrom], pos)})


def transfer_bytes(ranges: list[tuple[int, int]]) -> int:
    return sum((b >> 16) + BLOCK - (a >> 16) for a, b in ranges)


def enforce(total: int, ceiling: int = 9_000_000_000, confirm_above: int = 1_000_000_000, confirmed: bool = False) -> None:
    """Refuses a transfer above the ceiling, or a large one that is not confirmed."""
    if total > ceiling:
        raise ValueError(f"{total} bytes are above the ceiling of {ceiling}")
    if total > confirm_above and not confirmed:
        raise ValueError(f"{total} bytes have to be confirmed")


def contig_lengths(meta: list[str]) -> dict[str, int]:
    """Lengths that the ##contig lines of a header state."""
    out = {}
    for line in meta:
        if line.startswith("##contig=<"):
            fields = dict(x.split("=", 1) for x in line[len("##contig=<") :].rstrip(">").split(",") if "=" in x)
            if "ID" in fields and fields.get("length", "").isdigit():
                out[fields["ID"]] = int(fields["length"])
    return out


def anchors(lengths: dict[str, int], n: int) -> list[tuple[str, int]]:
    """``n`` evenly spaced positions (1-based) along the contigs laid end to end; the first is
    half a step from the beginning."""
    step, out, before = sum(lengths.values()) / n, [], 0
    for contig, length in lengths.items():
        k = max(0, math.ceil((before - step / 2) / step))
        while (at := step / 2 + k * step - before) < length:
            out.append((contig, int(at) + 1))
            k += 1
        before += length
    return out


def window_plan(index: dict[str, Index], where: list[tuple[str, int]], size: int) -> list[tuple[int, str, int, int]]:
    """(window, contig, virtual offset, file end) for the anchors that the index knows."""
    out = []
    for i, (contig, pos) in enumerate(where):
        if contig in index and (chunks := chunks_for(index[contig], pos)):
            begin = chunks[0][0]
            out.append((i, contig, begin, (begin >> 16) + size))
    return out


@dataclass
class Range(InputPartition):
    begin: int
    end: int
    window: int = -1
    contig: str = ""


class IndexedVcf(DataSource):
    """``spark.read.format("indexed_vcf")`` with options ``path``, ``index`` (path.tbi if not
    given), ``max_bytes``, and ``positions`` (``chrom:pos`` joined by commas) or ``windows``: then
    so many runs of ``window_bytes`` are read at even distances along the contigs of ``lengths``
    (``contig:length`` joined by commas), each as far as its last whole line."""

    @classmethod
    def name(cls) -> str:
        return "indexed_vcf"

    def schema(self) -> str:
        return "chrom string, pos bigint, value string, window int"

    def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
        return _Reader(dict(self.options))


class _Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path = options["path"]
        self.index = options.get("index", f"{self.path}.tbi")
        pairs = lambda text: [(c, int(p)) for c, p in (x.rsplit(":", 1) for x in text.split(",") if x)]
        self.positions = pairs(options.get("positions", ""))
        self.windows, self.size = int(options.get("windows", 0)), int(options.get("window_bytes", options.get("windowbytes", 3_500_000)))
        self.lengths = dict(pairs(options.get("lengths", "")))
        self.most = int(options.get("max_bytes", 9_000_000_000))

    def partitions(self) -> list[Range]:
        if self.windows:
            runs = window_plan(parse_index(fetch(self.index)), anchors(self.lengths, self.windows), self.size)
            enforce(len(runs) * self.size, self.most, self.most)
            return [Range(a, b, w, c) for w, c, a, b in runs] or [Range(0, 0)]
        ranges = plan(parse_index(fetch(self.index)), self.positions)
        enforce(transfer_bytes(ranges), self.most, self.most)
        return [Range(a, b) for a, b in ranges] or [Range(0, 0)]

    def read(self, partition: Range) -> Iterator[tuple]:
        if not partition.end:
            return
        if partition.window >= 0:
            text = inflate(fetch(self.path, partition.begin >> 16, partition.end), partition.begin & 0xFFFF)
            for line in text.decode("utf-8", "replace").split("\n")[:-1]:
                parts = line.split("\t", 2)
                if len(parts) == 3 and parts[0] == partition.contig and parts[1].isdigit():
                    yield parts[0], int(parts[1]), line, partition.window
            return
        wanted = set(self.positions)
        text = inflate(fetch(self.path, partition.begin >> 16, (partition.end >> 16) + BLOCK + 1024), partition.begin & 0xFFFF)
        seen = set()
        for line in text.decode("utf-8", "replace").split("\n"):
            parts = line.split("\t", 2)
            if len(parts) == 3 and parts[1].isdigit() and (key := (parts[0], int(parts[1]))) in wanted and line not in seen:
                seen.add(line)
                yield (*key, line, None)


def cached(folder: Path, url: str, start: int, end: int) -> bytes:
    """``fetch`` through a folder of ranges, each checked against its own digest."""
    import hashlib

    key = hashlib.sha256(f"{url}:{start}:{end}".encode()).hexdigest()
    data, digest = folder / key, folder / f"{key}.sha256"
    if data.exists() and digest.exists() and hashlib.sha256(data.read_bytes()).hexdigest() == digest.read_text():
        return data.read_bytes()
    got = fetch(url, start, end)
    folder.mkdir(parents=True, exist_ok=True)
    data.write_bytes(got)
    digest.write_text(hashlib.sha256(got).hexdigest())
    return got
