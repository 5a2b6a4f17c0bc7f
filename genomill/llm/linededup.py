"""Line deduplication by an exact set-similarity join (operator 6).

A line is the set of its distinct words.  A line is removed if an earlier line, in order of
(doc_id, line number), has a Jaccard similarity of ``0.8`` or more with it, whether or not
that line is itself removed.  Lines without a word stay and match nothing.

1.  *Equal sets.*  Lines with the same set (128-bit digest) keep their first occurrence;
    only first occurrences take part in what follows.
2.  *Rarity.*  A hashed table of exact counts over all lines, sent as one byte a bucket (the
    logarithm), orders each line's words from rare to common (ties by hash).
3.  *Prefix.*  Two lines of sizes m and n that match share one of the first
    ``m - ceil(0.8 m) + 1`` words of each.  Only these words are posted, with the word's
    position, the line's size and a 128-bit parity map of its set; postings travel as packed
    columns, one row for many.
4.  *Filters.*  Within a word's list, ordered by size, only lines of similar sizes meet; the
    positions bound the overlap, and so does the distance of the parity maps.  None of
    these ever drops a match.  Lists of more than ``BLOCK`` postings, counted exactly, are
    split into blocks, compared pair by pair.
5.  *Verification.*  For each later line the earliest candidate is verified first, on the
    words themselves; what that leaves goes to its other candidates.  What then remains and
    had more candidates than were carried (``CARRIED``) is compared with all of them: the
    lists of its prefix words, and only those, are posted again, in smaller blocks.

So a group of near copies costs a comparison for each line, not one for each pair.  Sets of
up to three words match only equal sets, which step 1 settles.

A line's words are told apart by 48 bits of their hashes.

Null and empty texts have no lines; documents without an id are left as they are.  Rows of
one doc_id are one document: line k of any of them stands at the same place, is counted
once, and is removed from all of them if in any of them it matches an earlier line.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textkernel as tk
from .common import bounded_batches, drop, hot_keys, maybe_in, ragged, save, steps, table, trim

#: Matches have 9 * intersection >= 4 * (sum of sizes), that is, Jaccard >= 0.8.
IN, OF = 9, 4
BUCKETS_LOG2 = 22
CHUNK = 1 << 16
#: Steps of a doubling in the table of rarity; a count of one has this value.
SCALE = 8
#: Postings of a slot (about), lines of a block of a long list, pairs expanded at a time.
SLOT_ROWS, BLOCK, PAIRS = 150_000, 8192, 1 << 19
#: Candidates that are carried for a line besides the earliest; lines, and candidates in all,
#: that are verified in one place (about).
CARRIED, VERIFIED, COMPARED = 64, 20_000, 500_000
#: Buckets (a power of 2) in which the prefix words of frequent words are counted.
LISTS_LOG2 = 18
#: Candidates that a slot holds before they are thinned out or sent on.
HELD = 1 << 20
#: Postings that a task packs at a time.
PACKED = 100_000

#: 64-bit words of a parity map; a posting in a line's row (its place is at least ``pos``), and
#: the columns of packed postings.
MAP_WORDS = 2
_POST = np.dtype([("token", "<u8"), ("pos", "<u2")])
_COLUMNS = (("token", "<u8"), ("doc", "<i8"), ("line", "<u4"), ("size", "<u4"), ("pos", "<u2"), *((f"b{k}", "<u8") for k in range(MAP_WORDS)), ("i", "<u2"), ("j", "<u2"), ("block", "<u2"), ("open", "u1"))
_WORD = re.compile(r"[^\x20\x09-\x0D]")
#: A task's excess counts of one chunk.
_MORE = np.dtype([("at", "<u4"), ("more", "<i8")])


def line_sets(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct words, offsets, text number, line number) of the lines that have words."""
    raw, at = tk.buffers(col)
    breaks = np.flatnonzero(raw == 10) + 1
    lines = np.unique(np.concatenate([at, breaks]))
    starts, ends = tk.spans(raw, at)
    words, to = tk.distinct_upper(tk.span_hashes(raw, starts, ends), np.searchsorted(starts, lines))
    text = np.searchsorted(at, lines[:-1], side="right") - 1
    first = np.searchsorted(lines, at[:-1])
    number = np.arange(len(lines) - 1) - first[text] if len(lines) > 1 else np.empty(0, np.int64)
    some = np.diff(to) > 0
    return words, np.concatenate([to[:-1][some], to[-1:]]), text[some], number[some]


def _digests(words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        one = np.add.reduceat(tk.mix(words), at[:-1]) if len(at) > 1 else words[:0]
        two = np.add.reduceat(tk.mix(words ^ np.uint64(0xD6E8FEB86659FD93)), at[:-1]) if len(at) > 1 else words[:0]
    return one.view(np.int64), two.view(np.int64)


def _survey(docs: DataFrame) -> DataFrame:
    """A row for each line that has words; and, with a null doc, the task's word counts."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << BUCKETS_LOG2, np.int32)
        names = ["doc", "line", "d1", "d2", "counts"]
        for step in steps(batches, "text", 2 << 20):
            words, at, text, number = line_sets(step.column("text"))
            if not len(text):
                continue
            d1, d2 = _digests(words, at)
            bucket, n = np.unique((words >> np.uint64(64 - BUCKETS_LOG2)).astype(np.int32), return_counts=True)
            counts[bucket] += n.astype(np.int32)
            yield pa.RecordBatch.from_arrays([step.column("id").take(pa.array(text)), pa.array(number, pa.int32()), pa.array(d1), pa.array(d2), pa.nulls(len(text), pa.binary())], names=names)
        some = [c for c in range(len(counts) // CHUNK) if counts[c * CHUNK : (c + 1) * CHUNK].any()]
        if some:
            data = [_packed_counts(counts[c * CHUNK : (c + 1) * CHUNK]) for c in some]
            none = pa.nulls(len(some), pa.int64())
            yield pa.RecordBatch.from_arrays([none, pa.array(some, pa.int32()), none, none, pa.array(data, pa.binary())], names=names)

    return docs.mapInArrow(run, "doc bigint, line int, d1 bigint, d2 bigint, counts binary")


def _packed_counts(counts: np.ndarray) -> bytes:
    """One byte a count, 255 at most, then what the larger ones have beyond that."""
    at = np.flatnonzero(counts > 255)
    more = np.empty(len(at), _MORE)
    more["at"], more["more"] = at, counts[at] - 255
    return np.minimum(counts, 255).astype(np.uint8).tobytes() + more.tobytes()


def _add_counts(sums: np.ndarray, data: bytes) -> None:
    sums += np.frombuffer(data, np.uint8, CHUNK)
    more = np.frombuffer(data, _MORE, offset=CHUNK)
    sums[more["at"]] += more["more"]


def rarity_of(counts: np.ndarray) -> np.ndarray:
    """SCALE * log2(1 + count), 255 at most (four thousand million)."""
    return np.minimum(255, np.rint(SCALE * np.log2(1.0 + counts))).astype(np.uint8)


def most_of(q: np.ndarray) -> np.ndarray:
    """An upper bound of the counts that have these rarities."""
    return 2.0 ** ((q + 0.5) / SCALE)


def _rarity(survey: DataFrame) -> np.ndarray:
    """One byte a bucket.  The counts are summed per chunk on the executors; 4 MB come to the
    driver."""

    def total(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for frame in frames:
            for c, data in zip(frame["line"], frame["counts"], strict=True):
                _add_counts(sums.setdefault(c, np.zeros(CHUNK, np.int64)), data)
        for c, n in sums.items():
            yield pd.DataFrame({"c": [c], "q": [rarity_of(n).tobytes()]})

    out = np.zeros(1 << BUCKETS_LOG2, np.uint8)
    chunks = survey.filter("doc is null and counts is not null").select("line", "counts").repartition(16, "line")
    for r in chunks.mapInPandas(total, "c int, q binary").collect():
        out[r["c"] * CHUNK : (r["c"] + 1) * CHUNK] = np.frombuffer(r["q"], np.uint8)
    return out


def _prefixes(docs: DataFrame, sent: Broadcast) -> DataFrame:
    """doc, line, size, maps (the parity map), posts (of each prefix word, rare first: the word
    and its position; words of one line alone are left out)."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches, "text", 2 << 20):
            words, at, text, number = line_sets(step.column("text"))
            if not len(text):
                continue
            size = np.diff(at)
            owner = np.repeat(np.arange(len(size)), size)
            q = sent.value[(words >> np.uint64(64 - BUCKETS_LOG2)).astype(np.int64)]
            order = tk.grouped_order(owner, q)
            ranked, q = words[order], q[order]
            pos = np.arange(len(words)) - np.repeat(at[:-1], size)
            prefix = size - -(-4 * size // 5) + 1
            post = (pos < prefix[owner]) & (size[owner] > 3) & (q > SCALE)
            spot = (words >> np.uint64(20)) % np.uint64(64 * MAP_WORDS)
            mask = np.uint64(1) << (spot & np.uint64(63))
            maps = np.stack([np.bitwise_xor.reduceat(np.where(spot >> np.uint64(6) == k, mask, np.uint64(0)), at[:-1]) for k in range(MAP_WORDS)], axis=1)
            n = np.bincount(owner[post], minlength=len(size))
            some = np.flatnonzero(n)
            posts = np.empty(int(n.sum()), _POST)
            posts["token"], posts["pos"] = ranked[post], np.minimum(pos[post], 65_535)
            to = np.concatenate([[0], np.cumsum(n[some])]) * _POST.itemsize
            packed = pa.Array.from_buffers(pa.binary(), len(some), [None, pa.py_buffer(to.astype(np.int32)), pa.py_buffer(posts)])
            maps_ = pa.Array.from_buffers(pa.binary(), len(some), [None, pa.py_buffer((np.arange(len(some) + 1) * 8 * MAP_WORDS).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(maps[some]))])
            yield pa.RecordBatch.from_arrays([step.column("id").take(pa.array(text[some])), pa.array(number[some], pa.int32()), pa.array(size[some], pa.int32()), maps_, packed], names=["doc", "line", "size", "maps", "posts"])

    return docs.mapInArrow(run, "doc bigint, line int, size int, maps binary, posts binary")


def _posts(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """All postings of a batch of lines, and the line (row) of each."""
    raw, at = tk.buffers(batch.column("posts"))
    return np.frombuffer(raw.tobytes(), _POST), np.repeat(np.arange(batch.num_rows), np.diff(at) // _POST.itemsize)


def _list_sizes(prefixes: DataFrame, rarity: Broadcast, block: int) -> np.ndarray:
    """Upper bounds of the lengths of the lists that may be longer than ``block``, by bucket of
    their words; 0 elsewhere.  At most ``2**LISTS_LOG2`` sums come to the driver."""
    often = most_of(np.arange(256)) > block

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(1 << LISTS_LOG2, np.int64)
        for batch in batches:
            token = _posts(batch)[0]["token"]
            token = token[often[rarity.value[(token >> np.uint64(64 - BUCKETS_LOG2)).astype(np.int64)]]]
            sums += np.bincount((token >> np.uint64(64 - LISTS_LOG2)).astype(np.int64), minlength=len(sums))
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(sums[some])], names=["b", "n"])

    out = np.zeros(1 << LISTS_LOG2, np.int64)
    for r in prefixes.select("posts").mapInArrow(run, "b bigint, n bigint").groupBy("b").agg(F.sum("n").alias("n")).filter(F.col("n") > block).collect():
        out[r["b"]] = r["n"]
    return out


def _planes(values: np.ndarray, kind: str) -> np.ndarray:
    """The values' bytes as one row for each place in them, which compress well."""
    return np.ascontiguousarray(values.astype(kind)).view(np.uint8).reshape(len(values), -1).T


def _postings(lines: DataFrame, slots: int, rarity: Broadcast, lists: np.ndarray, block: int) -> DataFrame:
    """slot, n, data: packed columns of a task's postings for each slot.  A posting goes to
    every pair of blocks of its list that has its own block."""
    often = most_of(np.arange(256)) > block
    sent = lines.sparkSession.sparkContext.broadcast(np.clip(-(-lists // block), 1, 65_535).astype(np.uint16))

    def pack(parts: list[dict[str, np.ndarray]]) -> pa.RecordBatch:
        blocks = sent.value
        col = {c: np.concatenate([p[c] for p in parts]) for c in parts[0]}
        nb = np.where(often[rarity.value[(col["token"] >> np.uint64(64 - BUCKETS_LOG2)).astype(np.int64)]], blocks[(col["token"] >> np.uint64(64 - LISTS_LOG2)).astype(np.int64)], 1).astype(np.int64)
        mine = (tk.mix(col["doc"].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + col["line"].astype(np.uint64)) % nb.astype(np.uint64)).astype(np.int64)
        again = np.repeat(np.arange(len(nb)), nb)
        other = np.arange(len(again)) - np.repeat(np.cumsum(nb) - nb, nb)
        mine = mine[again]
        col = {c: v[again] for c, v in col.items()} | {"i": np.minimum(mine, other), "j": np.maximum(mine, other), "block": mine}
        slot = (tk.mix(col["token"] + (col["i"] * 65_536 + col["j"]).astype(np.uint64)) % np.uint64(slots)).astype(np.int64)
        order = np.argsort(slot, kind="stable")
        cuts = np.searchsorted(slot[order], np.arange(slots + 1))
        some = np.flatnonzero(np.diff(cuts))
        planes = [_planes(col[c][order], t) for c, t in _COLUMNS]
        data = [b"".join(v[:, cuts[s] : cuts[s + 1]].tobytes() for v in planes) for s in some]
        return pa.RecordBatch.from_arrays([pa.array(some), pa.array(np.diff(cuts)[some]), pa.array(data, pa.binary())], names=["slot", "n", "data"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[dict[str, np.ndarray]] = []
        n = 0
        for batch in batches:
            posts, row = _posts(batch)
            if not len(posts):
                continue
            maps = np.frombuffer(tk.buffers(batch.column("maps"))[0].tobytes(), np.uint64).reshape(-1, MAP_WORDS)[row]
            part = {c: batch.column(c).to_numpy(zero_copy_only=False)[row] for c in ("doc", "line", "size", "open")}
            parts.append(part | {"token": posts["token"], "pos": posts["pos"]} | {f"b{k}": maps[:, k] for k in range(MAP_WORDS)})
            n += len(posts)
            if n >= PACKED:
                yield pack(parts)
                parts, n = [], 0
        if parts:
            yield pack(parts)
        trim()

    own = lines.select("doc", "line", "size", "maps", "posts", F.col("open") if "open" in lines.columns else F.lit(True).alias("open"))
    return own.mapInArrow(run, "slot bigint, n bigint, data binary")


def unpacked(rows: pa.Table) -> dict[str, np.ndarray]:
    """The columns of a slot's packed postings."""
    parts: dict[str, list[np.ndarray]] = {c: [] for c, _ in _COLUMNS}
    for n, data in zip(rows.column("n").to_pylist(), rows.column("data").to_pylist(), strict=True):
        at = 0
        for c, t in _COLUMNS:
            size = np.dtype(t).itemsize
            parts[c].append(np.ascontiguousarray(np.frombuffer(data, np.uint8, n * size, at).reshape(size, n).T).view(t).ravel())
            at += n * size
    wide = {"line": np.int64, "size": np.int64, "pos": np.int64, "i": np.int64, "j": np.int64, "open": bool}
    return {c: np.concatenate(v).astype(wide.get(c, v[0].dtype)) if v else np.empty(0, wide.get(c, t)) for (c, t), v in zip(_COLUMNS, parts.values(), strict=True)}


def _open_lists(prefixes: DataFrame, rest: DataFrame) -> DataFrame:
    """The lines that post a prefix word of a line of ``rest(doc, line)``, with those posts
    alone; ``open`` says which lines are of ``rest``.  A bitmap of fixed size tells the words."""

    def spots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = np.unique(_posts(batch)[0]["token"] >> np.uint64(41)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(h)], names=["h"])

    own = maybe_in(prefixes, "doc", rest.select(F.col("doc").alias("id"))).join(rest, ["doc", "line"], "left_semi")
    bits = own.select("posts").mapInArrow(spots, "h bigint").groupBy(F.shiftright("h", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(h & 63 as int))")).alias("m"))
    marks = np.zeros(1 << 17, np.int64)
    for r in bits.collect():  # at most 2**17 rows
        marks[r["w"]] = r["m"]
    sent = prefixes.sparkSession.sparkContext.broadcast(marks.view(np.uint64))

    def only_open(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            posts, row = _posts(batch)
            h = posts["token"] >> np.uint64(41)
            hit = (sent.value[(h >> np.uint64(6)).astype(np.int64)] >> (h & np.uint64(63))) & np.uint64(1) == 1
            n = np.bincount(row[hit], minlength=batch.num_rows)
            some = np.flatnonzero(n)
            to = np.concatenate([[0], np.cumsum(n[some])]) * _POST.itemsize
            kept = pa.Array.from_buffers(pa.binary(), len(some), [None, pa.py_buffer(to.astype(np.int32)), pa.py_buffer(posts[hit].tobytes())])
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(pa.array(some)) for c in ("doc", "line", "size", "maps")), kept], names=["doc", "line", "size", "maps", "posts"])

    lines = prefixes.select("doc", "line", "size", "maps", "posts").mapInArrow(only_open, "doc bigint, line int, size int, maps binary, posts binary")
    return lines.join(rest.withColumn("open", F.lit(True)), ["doc", "line"], "left").fillna(False, ["open"])


def candidates(col: dict[str, np.ndarray], carried: int | None = CARRIED) -> Iterator[pa.RecordBatch]:
    """For each later line of a slot that is ``open``: its earliest candidate, then up to
    ``carried`` others, nearest by parity first, and whether there are more.  If ``carried`` is
    None all candidates, a line's in one row or several."""
    order = np.lexsort((col["size"], col["j"], col["i"], col["token"]))
    col = {c: v[order] for c, v in col.items()}
    wanted = col["open"]
    maps = [col[f"b{k}"] for k in range(MAP_WORDS)]
    n = len(order)
    # The place of each line in the order of lines.
    by = np.lexsort((col["line"], col["doc"]))
    new = np.ones(n, bool)
    new[1:] = (col["doc"][by][1:] != col["doc"][by][:-1]) | (col["line"][by][1:] != col["line"][by][:-1])
    place = np.empty(n, np.int64)
    place[by] = np.cumsum(new) - 1
    lines = by[new]
    cut = np.ones(n + 1, bool)
    cut[1:n] = (col["token"][1:] != col["token"][:-1]) | (col["i"][1:] != col["i"][:-1]) | (col["j"][1:] != col["j"][:-1])
    group = np.cumsum(cut[:-1])
    size = col["size"].astype(np.int64)
    # Partners of a row follow it in its list, up to 5/4 of its size.
    span = int(size.max()) + 2 if n else 1
    until = np.searchsorted(group * span + size, group * span + np.minimum(5 * size // 4, span - 1), side="right")
    partners = until - np.arange(n) - 1
    kept: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    seen, held, most = np.zeros(len(lines), np.int64), 0, HELD

    def made() -> pa.RecordBatch:
        late, early, _ = _best(*(np.concatenate(v) for v in zip(*kept, strict=True)), carried, seen) if kept else (np.empty(0, np.int64),) * 3
        heads = np.flatnonzero(np.concatenate([[True], late[1:] != late[:-1]])) if len(late) else late
        to = pa.array(np.append(heads, len(late)), pa.int32())
        y, x = lines[late[heads]], lines[early]
        names = {
            "doc": pa.array(col["doc"][y]),
            "line": pa.array(col["line"][y].astype(np.int32)),
            "xdoc": pa.ListArray.from_arrays(to, pa.array(col["doc"][x])),
            "xline": pa.ListArray.from_arrays(to, pa.array(col["line"][x], pa.int32())),
            "more": pa.array(seen[late[heads]] > 0),
        }
        return pa.RecordBatch.from_arrays(list(names.values()), names=list(names))

    for s, e in tk.text_blocks(np.concatenate([[0], np.cumsum(partners)]), PAIRS):
        many = partners[s:e]
        x = np.repeat(np.arange(s, e), many)
        y = x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(many) - many, many)
        total = size[x] + size[y]
        ok = IN * (1 + np.minimum(size[x] - col["pos"][x], size[y] - col["pos"][y]) - 1) >= OF * total
        x, y, total = x[ok], y[ok], total[ok]
        apart = sum(np.bitwise_count(b[x] ^ b[y]).astype(np.int64) for b in maps)
        ok = IN * ((total - apart) // 2) >= OF * total
        ok &= (col["i"][x] == col["j"][x]) | (col["block"][x] != col["block"][y])
        x, y, apart = x[ok], y[ok], apart[ok]
        early, late = np.minimum(place[x], place[y]), np.maximum(place[x], place[y])
        ok = (early != late) & np.where(place[x] > place[y], wanted[x], wanted[y])
        early, late, apart = early[ok], late[ok], apart[ok]
        if len(late):
            pair, one = np.unique(late * len(lines) + early, return_index=True)
            kept.append(_best(pair // len(lines), pair % len(lines), apart[one], carried, seen))
            held += len(kept[-1][0])
            if held > most and carried is None:
                yield made()
                kept, held = [], 0
            elif held > most:
                kept = [_best(*(np.concatenate(v) for v in zip(*kept, strict=True)), carried, seen)]
                held = len(kept[0][0])
                most = max(HELD, 2 * held)
    yield made()
    trim()


def _of_slot(carried: int | None) -> Callable:
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from candidates(unpacked(pa.Table.from_batches(list(rows))), carried)

    return run


def _best(late: np.ndarray, early: np.ndarray, apart: np.ndarray, carried: int | None, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each late line's earliest candidate and its ``carried`` nearest others, in that order;
    ``seen`` counts the candidates that are let go."""
    pair, one = np.unique(late * (int(early.max()) + 1 if len(early) else 1) + early, return_index=True)
    late, early, apart = late[one], early[one], apart[one]  # by late, then early
    head = np.ones(len(late), bool)
    head[1:] = late[1:] != late[:-1]
    rank = np.where(head, -1, apart)
    order = np.lexsort((early, rank, late))
    late, early, apart = late[order], early[order], apart[order]
    if carried is not None:
        start = np.flatnonzero(np.concatenate([[True], late[1:] != late[:-1]])) if len(late) else late
        nth = np.arange(len(late)) - np.repeat(start, np.diff(np.append(start, len(late))))
        keep = nth <= carried
        np.add.at(seen, late[~keep], 1)
        late, early, apart = late[keep], early[keep], apart[keep]
    return late, early, apart


def _fetch(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """slot, doc, line, text of ``wanted(slot, doc, line)``."""
    bounded_batches(docs.sparkSession)
    asked = wanted.distinct().groupBy(F.col("doc").alias("id")).agg(F.collect_list(F.struct("line", "slot")).alias("asked"))
    texts = maybe_in(docs, "id", wanted.select(F.col("doc").alias("id"))).join(asked, "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches, "text"):
            rows = [(a["slot"], d, a["line"], lines[a["line"]]) for d, t, asked in zip(step.column("id").to_pylist(), step.column("text").to_pylist(), step.column("asked").to_pylist(), strict=True) for lines in [t.split("\n")] for a in asked if a["line"] < len(lines)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int32(), pa.large_string()), strict=True)], names=["slot", "doc", "line", "text"])

    return texts.select("id", "text", "asked").mapInArrow(run, "slot bigint, doc bigint, line int, text string")


def _confirm(lines: pd.DataFrame, pairs: pd.DataFrame) -> pd.DataFrame:
    """Later lines that match one of their candidates on their words.  Candidates are tried in
    growing portions, and a line that has matched is done."""
    none = pd.DataFrame({"doc": np.empty(0, np.int64), "line": np.empty(0, np.int32)})
    if not len(lines) or not len(pairs):
        return none
    lines = lines.drop_duplicates()
    words, at, text, _ = line_sets(pa.array(lines["text"].tolist(), pa.large_string()))
    where, others = {}, {}
    for i, k in enumerate(zip(lines["doc"].to_numpy()[text].tolist(), lines["line"].to_numpy()[text].tolist(), strict=True)):
        if where.setdefault(k, i) != i:  # a place of which rows of one doc_id have several texts
            others.setdefault(where[k], []).append(i)
    size = np.diff(at)
    many = pairs["xdoc"].map(len).to_numpy()
    x = np.array([where.get(k, -1) for k in zip(np.concatenate(pairs["xdoc"].tolist()).tolist(), np.concatenate(pairs["xline"].tolist()).tolist(), strict=True)], np.int64)
    own = np.array([where.get(k, -1) for k in zip(pairs["doc"].tolist(), pairs["line"].tolist(), strict=True)], np.int64)
    y, nth = np.repeat(own, many), np.arange(len(x)) - np.repeat(np.cumsum(many) - many, many)
    place = np.arange(len(size) + 1)
    if others:
        for i, more in others.items():
            place[more] = i
        again = [(a, b, n) for p, q, n in zip(x.tolist(), y.tolist(), nth.tolist(), strict=True) if p in others or q in others for a in [p, *others.get(p, [])] for b in [q, *others.get(q, [])]]
        x, y, nth = np.concatenate([np.stack([x, y, nth]), np.array(again, np.int64).reshape(-1, 3).T], axis=1)
    done = np.zeros(len(size) + 1, bool)
    low, high = 0, 1
    while low < int(many.max()):
        now = np.flatnonzero((nth >= low) & (nth < high) & (x >= 0) & (y >= 0) & ~done[place[y]])
        for s in range(0, len(now), 8192):
            a, b = x[now[s : s + 8192]], y[now[s : s + 8192]]
            pair = np.concatenate([np.repeat(np.arange(len(a)), size[a]), np.repeat(np.arange(len(b)), size[b])])
            keys = tk.packed(pair, np.concatenate([ragged(words, size[a], at[a]), ragged(words, size[b], at[b])]))
            same = np.bincount((keys[1:][keys[1:] == keys[:-1]] >> np.uint64(48)).astype(np.int64), minlength=len(a))
            done[place[b[IN * same >= OF * (size[a] + size[b])]]] = True
        low, high = high, high * 4
    trim()
    return pairs.loc[done[own] & (own >= 0), ["doc", "line"]].drop_duplicates()


def _matched(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """(doc, line) of ``pairs(doc, line, xdoc, xline)`` whose line matches one of its candidates
    (arrays).  Lines with the same first candidate meet in one slot, a large group in several,
    and each slot gets each text once."""
    pairs = save(pairs.withColumns({"hdoc": F.col("xdoc")[0], "hline": F.col("xline")[0]}), "pairs")
    sums = pairs.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.size("xdoc")), F.lit(0)).alias("x")).first()
    slots = max(1, -(-sums["n"] // VERIFIED), -(-sums["x"] // COMPARED))
    hubs = pairs.groupBy("hdoc", "hline").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("xdoc")).alias("x"))
    part = F.pmod(F.xxhash64("doc", "line"), F.greatest(F.ceil(F.col("n") / F.lit(VERIFIED // 2)), F.ceil(F.col("x") / F.lit(COMPARED // 2))))
    # A hub that many lines share meets them where they are.
    key = ["hdoc", "hline"]
    hot = F.broadcast(hot_keys(hubs, sums["n"]))
    sized = pairs.join(hot, key).unionByName(pairs.join(hot.select(*key), key, "left_anti").join(hubs, key))
    dealt = save(sized.select(F.pmod(F.xxhash64("hdoc", "hline", part), F.lit(slots)).alias("slot"), "doc", "line", "xdoc", "xline"), "pairs")

    def want(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f):
                n = f["xdoc"].map(len).to_numpy()
                mine = f[["slot", "doc", "line"]]
                theirs = pd.DataFrame({"slot": np.repeat(f["slot"].to_numpy(), n), "doc": np.concatenate(f["xdoc"].tolist()), "line": np.concatenate(f["xline"].tolist())})
                yield pd.concat([mine, theirs]).drop_duplicates()

    wanted = save(dealt.mapInPandas(want, "slot bigint, doc bigint, line int").distinct(), "wanted")
    lines = _fetch(docs, wanted).withColumnRenamed("slot", "to")
    out = save(lines.groupBy("to").cogroup(dealt.groupBy("slot")).applyInPandas(_confirm, "doc bigint, line int").distinct(), "matched")
    drop(pairs, dealt, wanted)
    return out


_CANDIDATES = "doc bigint, line int, xdoc array<bigint>, xline array<int>, more boolean"


def removed_lines(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines (that have words), removed (numbers of the removed lines, sorted) of
    each document that has lines."""
    texts = docs.filter("doc_id is not null and text is not null").select(F.col("doc_id").cast("bigint").alias("id"), "text")
    survey = save(_survey(texts), "survey")
    lines = survey.filter("doc is not null").select("doc", "line", "d1", "d2")
    firsts = save(lines.groupBy("d1", "d2").agg(F.min(F.struct("doc", "line")).alias("f")).select("f.doc", "f.line", "d1", "d2"), "firsts")
    repeats = lines.join(firsts, ["doc", "line", "d1", "d2"], "left_anti").select("doc", "line")

    rarity = texts.sparkSession.sparkContext.broadcast(_rarity(survey))
    prefixes = save(_prefixes(texts, rarity).join(firsts.select("doc", "line"), ["doc", "line"], "left_semi"), "prefixes")
    n_posts = int(prefixes.agg(F.sum(F.length("posts"))).first()[0] or 0) // _POST.itemsize
    slots = max(1, -(-n_posts // SLOT_ROWS))
    posted = _postings(prefixes, slots, rarity, _list_sizes(prefixes, rarity, BLOCK), BLOCK)
    carried = CARRIED
    found = save(posted.groupBy("slot").applyInArrow(_of_slot(carried), _CANDIDATES), "candidates")

    first = F.struct(F.col("xdoc")[0].alias("xdoc"), F.col("xline")[0].alias("xline"))
    earliest = found.groupBy("doc", "line").agg(F.min(first).alias("x")).select("doc", "line", F.array("x.xdoc").alias("xdoc"), F.array("x.xline").alias("xline"))
    one = _matched(texts, earliest)
    two = _matched(texts, found.join(one, ["doc", "line"], "left_anti").select("doc", "line", "xdoc", "xline"))
    parts = [one, two]
    rest = save(found.filter("more").select("doc", "line").distinct().join(one.union(two), ["doc", "line"], "left_anti"), "rest")
    drop(found, clean=True)
    if not rest.isEmpty():
        again = save(_open_lists(prefixes, rest), "again")
        n_again = int(again.agg(F.sum(F.length("posts"))).first()[0] or 0) // _POST.itemsize
        block = max(1, BLOCK // 8)
        posted = _postings(again, max(1, -(-8 * n_again // SLOT_ROWS)), rarity, _list_sizes(again, rarity, block), block)
        every = save(posted.groupBy("slot").applyInArrow(_of_slot(None), _CANDIDATES), "candidates")
        parts.append(_matched(texts, every.select("doc", "line", "xdoc", "xline")))
        drop(again, every)
    drop(prefixes)

    matched = repeats
    for part in parts:
        matched = matched.union(part)
    gone = matched.distinct().groupBy("doc").agg(F.sort_array(F.collect_list("line")).alias("removed"))
    n = lines.groupBy("doc").agg(F.count_distinct("line").alias("n_lines"))
    out = n.join(gone, "doc", "left").select(F.col("doc").alias("doc_id"), "n_lines", F.coalesce("removed", F.array().cast("array<int>")).alias("removed"))
    out = save(out, "removed")
    drop(survey, firsts, rest, *parts, clean=True)
    return out


def without_lines(docs: DataFrame, removed: DataFrame) -> DataFrame:
    """The rows less their document's removed lines; a row none of whose lines that have
    words is left goes.  Other columns stay as they are."""
    gone = removed.filter("size(removed) > 0").select(F.col("doc_id").alias("id"), "removed")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("bigint").alias("id")).join(gone, "id", "left")
    at, schema = docs.columns.index("text"), docs.schema
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols, removed = batch.column("row").flatten(), batch.column("removed")
            some = np.flatnonzero(removed.is_valid().to_numpy(zero_copy_only=False))
            keep, texts = np.ones(batch.num_rows, bool), []
            for i, text, gone in zip(some.tolist(), cols[at].take(pa.array(some)).to_pylist(), removed.take(pa.array(some)).to_pylist(), strict=True):
                if text is None:
                    texts.append(None)
                    continue
                gone = set(gone)
                left = "\n".join([x for k, x in enumerate(text.split("\n")) if k not in gone])
                texts.append(left)
                keep[i] = bool(_WORD.search(left)) or not _WORD.search(text)
            if len(some):
                mask = np.zeros(batch.num_rows, bool)
                mask[some] = True
                cols[at] = pc.replace_with_mask(cols[at], pa.array(mask), pa.array(texts, cols[at].type))
            yield pa.RecordBatch.from_arrays(cols, names=schema.names).filter(pa.array(keep))

    return rows.select("row", "removed").mapInArrow(run, schema)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_removed, removed_lines (numbers, comma-joined) of every document."""
    docs = table(spark, sf_dir, "documents")
    found = removed_lines(docs)
    out = docs.select("doc_id").join(found, "doc_id", "left")
    return out.select("doc_id", F.coalesce("n_lines", F.lit(0)).alias("n_lines"), F.coalesce(F.size("removed"), F.lit(0)).cast("bigint").alias("n_removed"), F.coalesce(F.array_join("removed", ","), F.lit("")).alias("removed_lines"))
