"""Language-model scoring (operator 2).

*Base.*  Words and one end for each text, with add-one counts over all training documents.
Counts are summed per task, then by hash range.  Words that make up ``1 / 2**16`` of the
training tokens or more (at most 2**16 words) are broadcast; the other words of each step
are sent, once a step, to the range that counts them, which returns each document's part of
the sum.  So no text is shuffled, and no word is a hot key.

*Model.*  A causal self-attention model over the ids of a public subword tokenizer, trained
here in numpy.  The chances of an id after the last id are counts over all training
documents (the ``ACTIVE`` most frequent ids have rows and columns of their own, the others
share one); attention over the window shifts them between classes of ids:
``p(id | before) = P(id | last) exp(u[class(id)]) / sum_c P(class c | last) exp(u[c])`` with
``u`` from one causal head with a bias for distance.  Classes (ids that stand between the
same neighbours) come from the same counts.  Weights are learned from every id of every
training document: in rounds over shares of the corpus that quadruple, tasks of about
``LOCAL_DOCS`` documents start from the last round's weights and take their own steps, and
the mean of what they change, by the ids they saw, makes the next round's (what an id's own
row changes counts by how often the task saw that id, so that rare ones are not thinned by
tasks without them).  Each document is learned ``EPOCHS`` times, at a lower rate each time,
however large the corpus; a hash deals them, so the weights do not depend on how the table is
stored.

*Memory.*  Texts fall into spans that end where a hash of the last ids says so (one id in
``SPAN``), the same wherever a passage stands.  All spans of the training documents are counted
after the span before them, in hash ranges that grow with the corpus.  With c, t and n the
number of spans that followed, of different ones, and of this one,
``p(span | before) = (n - 1) / c + t / c * p_attention(span)``: absolute discounting by one, so
that what was seen once is scored by attention alone, and what the corpus repeats is known.  A
text's first span is scored by attention.  Spans are sent to their ranges, packed; a step's
records of one range travel in one row.

*Scoring.*  A text's ids are covered by windows of ``WINDOW`` ids that overlap by
``OVERLAP``; windows of many texts are scored in one batch under a causal mask, and each id
counts once, in the window where it stands after the overlap.

Null and empty texts are scored as one end.  Without training documents c is 0 everywhere.
Rows with the same text get equal scores, whatever their ids; repeated rows stay.  A document without an id is held out of nothing: its
crc32 is null, so it neither trains nor is held out.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textkernel as tk
from .bpe import STEP, encoder, vocabulary
from .common import bounded_batches, drop, fold, keep_freed, only, save, steps, sweep, table

VOCAB = 49_408
START, END = 49_406, 49_407
WINDOW, OVERLAP, WIDTH = 32, 8, 16
CLASSES, NEIGHBOURS = 30, 128
ACTIVE = 2048
EPOCHS, BATCH, RATE = 2, 64, 0.1
#: Words of at least this share of the training tokens are broadcast.
COMMON = 1 / (1 << 16)
#: Training documents that one task learns from (about); where rounds end, in shares of the last;
#: ids whose windows are put in random order together.
LOCAL_DOCS, ROUNDS, MIXED = 2_000, (1, 4, 16, 64), 1 << 18
#: Documents whose words one hash range counts (about).
RANGE_DOCS = 8_000
FLUSH = 2_000_000
#: Ids of a span (about; a power of 2); ids that tell its end; texts whose spans travel together.
SPAN, TELLING, STEP_DOCS = 64, 4, 1_024
_SPANS = np.dtype([("before", "<u8"), ("span", "<u8"), ("text", "<u4"), ("logp", "<f4")])


# -- survey: ids of each text, counts of words and of ids ---------------------------------


def _survey(docs: DataFrame, ranges: int, vocab_path: str | None) -> DataFrame:
    vocab = docs.sparkSession.sparkContext.broadcast(vocabulary(vocab_path))
    bounded_batches(docs.sparkSession)
    names = ["doc_id", "h", "held_out", "trains", "slot", "x", "y"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        keep_freed()
        # Handing short lists of chunks to other threads costs CPU time, and the cores are busy.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        enc, pack = encoder(vocab.value), zstandard.ZstdCompressor(level=1)
        id_counts, ends = np.zeros(VOCAB, np.int64), 0
        keys, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
        waiting: list[np.ndarray] = []

        def merge() -> None:
            nonlocal keys, counts
            new, n = np.unique(np.concatenate(waiting), return_counts=True)
            waiting.clear()
            if not len(new) + len(keys):
                return
            both = np.concatenate([keys, new])
            order = np.argsort(both, kind="stable")
            both, n = both[order], np.concatenate([counts, n])[order]
            head = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]]))
            keys, counts = both[head], np.add.reduceat(n, head)

        def emit() -> pa.RecordBatch:
            cuts = np.searchsorted(_range_of(keys, ranges), np.arange(ranges + 1))
            some = np.flatnonzero(np.diff(cuts))
            x = [keys[cuts[s] : cuts[s + 1]].tobytes() for s in some]
            y = [counts[cuts[s] : cuts[s + 1]].tobytes() for s in some]
            return pa.RecordBatch.from_arrays([pa.nulls(len(some), pa.int64()), pa.nulls(len(some), pa.int64()), pa.nulls(len(some), pa.bool_()), pa.nulls(len(some), pa.bool_()), pa.array(some, pa.int64()), pa.array(x, pa.binary()), pa.array(y, pa.binary())], names=names)

        for step in steps(batches, "text", STEP, owner="bpe"):
            ids, at = enc.encode(step.column("text"))
            small = ids.astype(np.uint16)
            blobs = [pack.compress(small[a:b].tobytes()) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            n = step.num_rows
            yield pa.RecordBatch.from_arrays([step.column("doc_id"), step.column("h"), step.column("held_out"), step.column("train"), pa.nulls(n, pa.int64()), pa.array(blobs, pa.binary()), pa.nulls(n, pa.binary())], names=names)
            train = step.column("train").to_numpy(zero_copy_only=False).astype(bool)
            words, to = tk.words(step.column("text"))
            waiting.append(words[np.repeat(train, np.diff(to))])
            id_counts += np.bincount(ids[np.repeat(train, np.diff(at))], minlength=VOCAB)
            ends += int(train.sum())
            if sum(map(len, waiting)) > FLUSH:
                merge()
                if len(keys) > FLUSH:
                    yield emit()
                    keys, counts = keys[:0], counts[:0]
        if waiting:
            merge()
        yield emit()
        if ends:
            id_counts[END] += ends
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.bool_()), pa.nulls(1, pa.bool_()), pa.array([-1], pa.int64()), pa.array([id_counts.tobytes()], pa.binary()), pa.array([str(ends).encode()], pa.binary())], names=names)

    rows = docs.select("doc_id", "h", F.coalesce(F.col("held_out"), F.lit(False)).alias("held_out"), F.coalesce(~F.col("held_out"), F.lit(False)).alias("train"), "text")
    return rows.mapInArrow(run, "doc_id bigint, h bigint, held_out boolean, trains boolean, slot bigint, x binary, y binary")


def _range_of(keys: np.ndarray, ranges: int) -> np.ndarray:
    """The hash range of each key; ascending with the keys."""
    return ((keys >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def _sum_ids(survey: DataFrame) -> tuple[np.ndarray, int]:
    """Counts of all ids in training documents (VOCAB numbers, summed on the executors), and
    the number of these documents; a text may hold the end's id too."""

    def total(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums, ends = np.zeros(VOCAB, np.int64), 0
        for frame in frames:
            for x, y in zip(frame["x"], frame["y"], strict=True):
                sums += np.frombuffer(x, np.int64)
                ends += int(y)
        yield pd.DataFrame({"x": [sums.tobytes()], "ends": [ends]})

    out, ends = np.zeros(VOCAB, np.int64), 0
    for r in survey.filter("slot = -1").select("x", "y").repartition(8).mapInPandas(total, "x binary, ends bigint").collect():
        out += np.frombuffer(r["x"], np.int64)
        ends += r["ends"]
    return out, ends


def _word_counts(survey: DataFrame) -> DataFrame:
    """slot, keys, counts (ascending keys), n (distinct words), total of each hash range."""

    def merge(rows: pa.Table) -> pa.Table:
        keys = np.concatenate([np.frombuffer(x, np.uint64) for x in rows.column("x").to_pylist()])
        n = np.concatenate([np.frombuffer(y, np.int64) for y in rows.column("y").to_pylist()])
        order = np.argsort(keys, kind="stable")
        keys, n = keys[order], n[order]
        head = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        keys, n = keys[head], np.add.reduceat(n, head)
        return pa.table({"slot": rows.column("slot")[:1], "keys": pa.array([keys.tobytes()], pa.binary()), "counts": pa.array([n.tobytes()], pa.binary()), "n": [len(keys)], "total": [int(n.sum())]})

    return survey.filter("slot >= 0").select("slot", "x", "y").groupBy("slot").applyInArrow(merge, "slot bigint, keys binary, counts binary, n bigint, total bigint")


# -- base score ---------------------------------------------------------------------------


def _base(docs: DataFrame, counts: DataFrame, ranges: int, tokens: int, ends: int) -> DataFrame:
    """doc_id, h, held_out, n_tokens, n_known, logs (the sum of log10(c + 1)) of each row, saved."""
    floor = max(1.0, tokens * COMMON)

    def common(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for keys, n in zip(frame["keys"], frame["counts"], strict=True):
                n = np.frombuffer(n, np.int64)
                big = np.flatnonzero(n >= floor)
                yield pd.DataFrame({"k": np.frombuffer(keys, np.int64)[big], "n": n[big]})

    rows = counts.select("keys", "counts").mapInPandas(common, "k bigint, n bigint").toPandas()  # at most 1 / COMMON rows
    known = rows["k"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(known)
    sent = docs.sparkSession.sparkContext.broadcast((known[order], np.log10(rows["n"].to_numpy(np.float64)[order] + 1)))
    end_log, end_known = float(np.log10(ends + 1)), int(ends > 0)
    bounded_batches(docs.sparkSession)
    names = ["step", "doc_id", "h", "held_out", "n_tokens", "n_known", "logs", "slot", "x", "y"]

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        keep_freed()
        number = TaskContext.get().partitionId() << 32
        known, logs = sent.value
        for step in steps(batches, "text"):
            words, at = tk.words(step.column("text"))
            n = len(at) - 1
            keys, which = np.unique(words, return_inverse=True)
            to = np.searchsorted(known, keys)
            to[to == len(known)] = 0
            hit = known[to] == keys if len(known) else np.zeros(len(keys), bool)
            value = np.where(hit, logs[to], 0.0) if len(known) else np.zeros(len(keys))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, number)),
                    step.column("doc_id"),
                    step.column("h"),
                    step.column("held_out"),
                    pa.array(np.diff(at) + 1, pa.int64()),
                    pa.array(tk.segment_sums(hit[which].astype(np.int64), at) + end_known),
                    pa.array(tk.segment_sums(value[which], at) + end_log),
                    pa.nulls(n, pa.int64()),
                    pa.nulls(n, pa.binary()),
                    pa.nulls(n, pa.binary()),
                ],
                names=names,
            )
            # The other words, by range: the distinct ones, how often each occurs, and the texts.
            rare = np.flatnonzero(~hit)
            place = np.cumsum(~hit) - 1
            mine = np.flatnonzero(~hit[which])
            word = place[which[mine]]
            text = np.repeat(np.arange(n), np.diff(at))[mine]
            order = np.argsort(word, kind="stable")
            word, text = word[order], text[order]
            cuts = np.searchsorted(_range_of(keys[rare], ranges), np.arange(ranges + 1))
            ends_at = np.searchsorted(word, cuts)
            some = np.flatnonzero(np.diff(cuts))
            m = len(some)
            head = np.array([n], np.uint32).tobytes()
            x = [keys[rare[cuts[s] : cuts[s + 1]]].tobytes() for s in some]
            times = np.bincount(word, minlength=len(rare)).astype(np.uint32)
            text = text.astype(np.uint16)  # a step has STEP_ROWS rows at most
            y = [head + times[cuts[s] : cuts[s + 1]].tobytes() + text[ends_at[s] : ends_at[s + 1]].tobytes() for s in some]
            none = pa.nulls(m, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(np.full(m, number)), none, none, pa.nulls(m, pa.bool_()), none, none, pa.nulls(m, pa.float64()), pa.array(some, pa.int64()), pa.array(x, pa.binary()), pa.array(y, pa.binary())], names=names)
            number += 1

    def count(asked: pa.Table, held: pa.Table) -> pa.Table:
        steps_, known_, logs_ = [], [], []
        keys = np.frombuffer(held.column("keys")[0].as_py(), np.uint64) if held.num_rows else np.empty(0, np.uint64)
        n = np.frombuffer(held.column("counts")[0].as_py(), np.int64) if held.num_rows else np.empty(0, np.int64)
        for number, x, y in zip(asked.column("step").to_pylist(), asked.column("x").to_pylist(), asked.column("y").to_pylist(), strict=True):
            words, head = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint32, 1 + len(x) // 8)
            docs_in, word, text = int(head[0]), np.repeat(np.arange(len(words)), head[1:]), np.frombuffer(y, np.uint16, offset=head.nbytes)
            c = np.zeros(len(words), np.int64)
            if len(keys):
                to = np.searchsorted(keys, words)
                to[to == len(keys)] = 0
                c = np.where(keys[to] == words, n[to], 0)
            steps_.append(number)
            known_.append(np.bincount(text, weights=(c > 0)[word], minlength=docs_in).tobytes())
            logs_.append(np.bincount(text, weights=np.log10(c + 1.0)[word], minlength=docs_in).tobytes())
        return pa.table({"step": pa.array(steps_, pa.int64()), "known": pa.array(known_, pa.binary()), "logs": pa.array(logs_, pa.binary())})

    def add(rows: pa.Table, parts: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return rows.slice(0, 0)
        known, logs = rows.column("n_known").to_numpy().astype(np.float64), rows.column("logs").to_numpy().copy()
        for k, x in zip(parts.column("known").to_pylist(), parts.column("logs").to_pylist(), strict=True):
            known += np.frombuffer(k)
            logs += np.frombuffer(x)
        return pa.table({"doc_id": rows.column("doc_id"), "h": rows.column("h"), "held_out": rows.column("held_out"), "n_tokens": rows.column("n_tokens"), "n_known": pa.array(np.rint(known).astype(np.int64)), "logs": pa.array(logs)})

    rows = docs.select("doc_id", "h", F.coalesce("held_out", F.lit(False)).alias("held_out"), "text")
    sent_out = save(rows.mapInArrow(split, "step bigint, doc_id bigint, h bigint, held_out boolean, n_tokens bigint, n_known bigint, logs double, slot bigint, x binary, y binary"), "base")
    asked = sent_out.filter("slot is not null").select("slot", "step", "x", "y")
    parts = asked.groupBy("slot").cogroup(counts.select(F.col("slot").alias("of"), "keys", "counts").groupBy("of")).applyInArrow(count, "step bigint, known binary, logs binary")
    own = sent_out.filter("slot is null").select("step", "doc_id", "h", "held_out", "n_tokens", "n_known", "logs", F.monotonically_increasing_id().alias("nth"))
    both = own.groupBy("step").cogroup(parts.groupBy("step"))
    out = save(both.applyInArrow(lambda a, b: add(a.sort_by("nth"), b), "doc_id bigint, h bigint, held_out boolean, n_tokens bigint, n_known bigint, logs double"), "base")
    drop(sent_out)
    return out


# -- model --------------------------------------------------------------------------------


def classes_of(active: np.ndarray, counts: np.ndarray, word_end: np.ndarray, n: int = CLASSES, seed: int = 7) -> np.ndarray:
    """A class for every id.  Active ids seen often enough are grouped by their neighbours in all
    training documents (k-means over Hellinger-scaled counts of pairs); others by whether they
    end a word."""
    out = np.where(word_end, n, n + 1).astype(np.int64)
    counts = counts.reshape(ACTIVE + 1, ACTIVE + 1)
    freq = np.maximum(counts.sum(axis=0), counts.sum(axis=1))[:ACTIVE]
    used = np.flatnonzero(freq >= 5)
    if len(used) < 2 * n:
        return out
    # Active ids are numbered by how often they occur: the first ones are columns of their own.
    beside = lambda c: np.column_stack([c[:, :NEIGHBOURS], c[:, NEIGHBOURS:].sum(axis=1)])
    x = np.column_stack([beside(counts[used]), beside(counts.T[used]), np.zeros(len(used))]).astype(np.float64)
    x = np.sqrt(x / np.maximum(x.sum(axis=1, keepdims=True), 1))
    x[:, -1] = 0.12 * np.log(freq[used])
    rng = np.random.default_rng(seed)
    weight = np.log1p(freq[used])
    centres = x[rng.choice(len(used), n, replace=False, p=weight / weight.sum())]
    for _ in range(12):
        to = np.argmin((centres**2).sum(axis=1) - 2 * x @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, to, x * weight[:, None])
        size = np.bincount(to, weights=weight, minlength=n)
        centres = np.where(size[:, None] > 0, sums / np.maximum(size, 1e-9)[:, None], centres)
    number = np.full(ACTIVE + 1, -1)
    number[used] = to
    return np.where(number[active] >= 0, number[active], out)


class Pairs:
    """Chances of an id after the last id, from counts of pairs of active ids."""

    def __init__(self, id_counts: np.ndarray, active: np.ndarray, counts: np.ndarray, class_of: np.ndarray, n_classes: int) -> None:
        """``active``: the number of each id, ACTIVE for those that share one."""
        size = ACTIVE + 1
        uni = id_counts + 0.05
        uni = uni / uni.sum()
        share = np.bincount(active, weights=uni, minlength=size)
        counts = counts.reshape(size, size)
        p = np.empty((size, size), np.float32)
        for a in range(0, size, 256):  # a part at a time, for memory
            c = counts[a : a + 256].astype(np.float64)
            total, kinds = c.sum(axis=1, keepdims=True), (c > 0).sum(axis=1, keepdims=True)
            back = np.where(total > 0, (0.5 * kinds + 0.5) / (total + 0.5), 1.0)
            c = np.where(total > 0, np.maximum(c - 0.5, 0) / (total + 0.5), 0.0) + back * share[None, :]
            p[a : a + 256] = c / c.sum(axis=1, keepdims=True)
        self.logs = np.log(p).ravel()
        # An id that shares a column has its part of it.
        self.part = np.log(uni / share[active]).astype(np.float32)
        self.active = active.astype(np.int64)
        # Ids of one column may be of several classes: a column's class is its first id's.
        column = np.zeros(size, np.int64)
        column[active[::-1]] = class_of[::-1]
        self.column_class = column
        self.by_class = np.zeros((size, n_classes), np.float32)
        for k in range(n_classes):
            self.by_class[:, k] = p[:, column == k].sum(axis=1)
        self.by_class = np.maximum(self.by_class, 1e-12)


class Attention:
    """One causal head over WINDOW ids, whose output shifts the classes of the next id.  The
    first OVERLAP places of a window are context only."""

    def __init__(self, n_classes: int, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        f = np.float32
        self.p = {
            "e": rng.normal(0, 0.3, (ACTIVE + 1, WIDTH)).astype(f),
            "q": rng.normal(0, 0.25, (WIDTH, WIDTH)).astype(f),
            "k": rng.normal(0, 0.25, (WIDTH, WIDTH)).astype(f),
            "v": rng.normal(0, 0.25, (WIDTH, WIDTH)).astype(f),
            "o": rng.normal(0, 0.1, (WIDTH, n_classes)).astype(f),
            "b": np.zeros(n_classes, f),
            "d": np.zeros(WINDOW, f),
        }
        self.sq = {k: np.full_like(v, 1e-3) for k, v in self.p.items()}
        gap = np.arange(OVERLAP, WINDOW)[:, None] - np.arange(WINDOW)[None, :]
        self.mask, self.gap = np.where(gap >= 0, 0, -1e9).astype(f), np.maximum(gap, 0)
        self.tables: tuple | None = None

    def learn(self, x: np.ndarray, y: np.ndarray, ok: np.ndarray, by_class: np.ndarray, rate: float, tell: bool = True) -> float:
        """One step on windows of active ids ``x`` whose places after the overlap are followed
        by classes ``y`` where ``ok``; the mean loss, if it is to ``tell``."""
        p, f, n = self.p, np.float32, len(x)
        # q stands only beside k, v beside o: with their products a place is its own key and value.
        # A column of ones adds up weights.
        qk, vob = p["q"] @ p["k"].T * f(WIDTH**-0.5), np.concatenate([p["v"] @ p["o"], p["b"][None]])
        ids, last = x.ravel(), x[:, OVERLAP:].ravel()
        e = np.concatenate([p["e"], np.ones((len(p["e"]), 1), f)], axis=1).take(ids, axis=0).reshape(n, WINDOW, -1)
        key, own = e[..., :-1], p["e"].take(last, axis=0)
        q = (own @ qk).reshape(n, STRIDE, -1)
        a = q @ key.transpose(0, 2, 1)
        np.minimum(a, f(60), out=a)
        np.maximum(a, f(-60), out=a)
        a += p["d"][self.gap] + self.mask
        np.exp(a, out=a)
        h = (a @ e).reshape(-1, WIDTH + 1)
        part = 1 / h[:, -1:]
        h *= part  # its last column is one from here on, and carries the bias
        g = h @ vob
        np.minimum(g, f(30), out=g)
        np.maximum(g, f(-30), out=g)
        np.exp(g, out=g)
        g *= by_class.take(last, axis=0)
        right, real = np.arange(0, g.size, g.shape[1]) + y.ravel(), ok.ravel()
        total, n_real = g @ np.ones(g.shape[1], f), int(np.count_nonzero(real))
        chance = (g.ravel().take(right) / total)[real] if tell else np.ones(1, f)
        weight = real * f(1 / max(1, n_real))
        g *= (weight / total)[:, None]
        g.ravel()[right] -= weight
        # With h the weighted mean of places, the gradient of a score is a (do . place - do . h).
        do = g @ vob.T
        do[:, -1] = 0
        do[:, -1] = (do * h) @ np.full(WIDTH + 1, -1, f)
        do *= part
        do = do.reshape(n, STRIDE, -1)
        ds = do @ e.transpose(0, 2, 1)
        ds *= a
        dq = (ds @ key).reshape(-1, WIDTH)
        de = a.transpose(0, 2, 1) @ do[..., :-1]
        de += ds.transpose(0, 2, 1) @ q
        de[:, OVERLAP:] += (dq @ qk.T).reshape(n, STRIDE, -1)
        dqk, dvob = own.T @ dq, (g.T @ h).T
        self._step(
            {
                "q": dqk @ p["k"] * f(WIDTH**-0.5),
                "k": dqk.T @ p["q"] * f(WIDTH**-0.5),
                "v": dvob[:-1] @ p["o"].T,
                "o": p["v"].T @ dvob[:-1],
                "b": dvob[-1],
                "d": np.bincount(self.gap.ravel(), weights=ds.sum(axis=0).ravel(), minlength=WINDOW).astype(f),
            },
            rate,
        )
        ids = ids.astype(np.uint16)
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        heads = np.concatenate([[0], np.flatnonzero(ids[1:] != ids[:-1]) + 1])
        rows = ids[heads].astype(np.int64)
        # Rows are added up two numbers at a time, as complex ones.
        sums = np.add.reduceat(de.reshape(-1, WIDTH).take(order, axis=0).view(np.complex64), heads).view(f)
        sq, change = self._change(self.sq["e"].take(rows, axis=0), sums, rate)
        self.sq["e"][rows] = sq
        p["e"][rows] = p["e"].take(rows, axis=0) - change
        return float(-np.log(np.maximum(chance, 1e-9)).sum()) / max(1, n_real)

    @staticmethod
    def _change(sq: np.ndarray, grad: np.ndarray, rate: float) -> tuple[np.ndarray, np.ndarray]:
        """Adagrad's new sums of squares, in place, and what is taken from the weights."""
        change = grad * np.float32(100)  # losses are means; Adagrad does not mind the scale
        sq += change * change
        change *= np.float32(rate)
        change /= np.sqrt(sq)
        return sq, change

    def _step(self, grads: dict[str, np.ndarray], rate: float) -> None:
        """One step of the small weights."""
        for k, d in grads.items():
            self.p[k] -= self._change(self.sq[k], d, rate)[1]

    def ready(self) -> None:
        """Tables over active ids of what a window needs, so that scoring only looks them up.  If
        no score can be so large that its exponential overflows, no maximum is subtracted."""
        p, f = self.p, np.float32
        q, vo = p["e"] @ (p["q"] @ p["k"].T * f(WIDTH**-0.5)), p["v"] @ p["o"]
        # The largest score of any two ids, a part at a time, for memory.
        largest = max(float(np.abs(q[i : i + 256] @ p["e"].T).max()) for i in range(0, len(q), 256))
        small = largest + np.abs(p["d"]).max() < 60 and np.abs(p["e"] @ vo).max() + np.abs(p["b"]).max() < 60
        # As in learning, ids are their own keys and values; a column of ones adds up the weights
        # and then carries the bias.
        self.tables = (q, np.concatenate([p["e"], np.ones((len(q), 1), f)], axis=1), p["d"][self.gap] + self.mask, np.concatenate([vo, p["b"][None]]), bool(small))

    def shifts(self, x: np.ndarray, y: np.ndarray, by_class: np.ndarray) -> np.ndarray:
        """log of exp(u[y]) / sum_c P(c | last) exp(u[c]) after each scored place."""
        q, e, near, vob, small = self.tables
        n, last = len(x), x[:, OVERLAP:].ravel()
        e = e.take(x.ravel(), axis=0).reshape(n, WINDOW, -1)
        s = q.take(last, axis=0).reshape(n, STRIDE, -1) @ e[..., :-1].transpose(0, 2, 1)
        s += near
        if not small:
            s -= s.max(axis=-1, keepdims=True)
        np.exp(s, out=s)
        h = (s @ e).reshape(len(last), -1)
        h /= h[:, -1:]
        u = h @ vob
        if not small:
            u -= u.max(axis=-1, keepdims=True)
        own = u.ravel().take(np.arange(len(u)) * u.shape[1] + y.ravel())
        np.exp(u, out=u)
        u *= by_class.take(last, axis=0)
        return (own - np.log(u @ np.ones(u.shape[1], np.float32))).reshape(n, STRIDE)


STRIDE = WINDOW - OVERLAP


def windows(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first place, end) of the windows' scored places, for sequences [at[i], at[i + 1])."""
    n = -(-np.diff(at) // STRIDE)
    of = np.repeat(np.arange(len(n)), n)
    first = at[:-1][of] + (np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)) * STRIDE
    return first, np.minimum(first + STRIDE, at[1:][of])


def sequences(ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids each after a start, ids each before an end, offsets) of texts."""
    to = np.concatenate([[0], np.cumsum(np.diff(at) + 1)])
    x = np.empty(int(to[-1]), np.int64)
    y = np.empty_like(x)
    x[to[:-1]], y[to[1:] - 1] = START, END
    inner = np.ones(len(x), bool)
    inner[to[:-1]] = False
    x[inner] = ids
    inner[:] = True
    inner[to[1:] - 1] = False
    y[inner] = ids
    return x, y, to


def _batches(a: np.ndarray, to: np.ndarray, start: int, size: int, order: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(window inputs, scored places, which of them are real); before a text stands ``start``."""
    first, end = windows(to)
    begin = np.repeat(to[:-1], -(-np.diff(to) // STRIDE))
    if order is not None:
        first, end, begin = first[order], end[order], begin[order]
    back, ahead = np.arange(-OVERLAP, STRIDE), np.arange(STRIDE)
    many = 16 * size  # places of so many windows are found together
    for s in range(0, len(first), many):
        f, e = first[s : s + many, None], end[s : s + many, None]
        at = np.minimum(f + back, e - 1)
        x, real = a.take(at, mode="clip"), f + ahead < e
        x[:, :OVERLAP][at[:, :OVERLAP] < begin[s : s + many, None]] = start
        for t in range(0, len(x), size):
            yield x[t : t + size], at[t : t + size, OVERLAP:], real[t : t + size]


def place_logs(model: Attention, pairs: Pairs, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(log10 probability of each id and end, these ids, offsets) of texts, by attention."""
    x, y, to = sequences(ids, at)
    a, b = pairs.active[x], pairs.active[y]
    out = pairs.logs[a * (ACTIVE + 1) + b].astype(np.float64) + pairs.part[y]
    cls = pairs.column_class[b]
    # Windows stand in the order of their places, each of which is real in one of them.
    got = [model.shifts(win, cls.take(place), pairs.by_class)[real] for win, place, real in _batches(a, to, int(pairs.active[START]), BATCH)]
    out += np.concatenate([np.empty(0, np.float32), *got])
    return out / np.log(10.0), y, to


def score_ids(model: Attention, pairs: Pairs, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """log10 probability of each text's ids and its end, by attention alone."""
    logs, _, to = place_logs(model, pairs, ids, at)
    return tk.segment_sums(logs, to)


# -- memory ---------------------------------------------------------------------------------

_IDS = np.random.Generator(np.random.PCG64(20260817)).integers(1, 2**63, VOCAB, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def spans_of(y: np.ndarray, to: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first places, hashes, texts) of the spans of sequences that end with END."""
    value, tell = _IDS[y], np.zeros(len(y), np.uint64)
    for k in range(TELLING):
        tell[k:] = (tell[k:] + value[: len(y) - k]) * np.uint64(0x9E3779B97F4A7C15)
    ends = tk.mix(tell) & np.uint64(SPAN - 1) == 0
    place = np.arange(len(y)) - np.repeat(to[:-1], np.diff(to))
    ends &= place >= TELLING - 1
    ends[to[1:] - 1] = True
    start = np.concatenate([[0], np.flatnonzero(ends)[:-1] + 1]) if len(y) else np.empty(0, np.int64)
    up, down = tk.powers(len(y))
    total = np.concatenate([[np.uint64(0)], np.cumsum(value * up)])
    end = np.append(start[1:], len(y))
    return start, tk.mix((total[end] - total[start]) * down[start]), np.searchsorted(to, start, side="right") - 1


def followers(start: np.ndarray, span: np.ndarray, text: np.ndarray, logs: np.ndarray | None = None) -> np.ndarray:
    """Records of the spans that have one before them in their text."""
    later = np.flatnonzero(text[1:] == text[:-1]) + 1
    out = np.zeros(len(later), _SPANS)
    out["before"], out["span"], out["text"] = span[later - 1], span[later], text[later]
    if logs is not None and len(start):
        out["logp"] = np.add.reduceat(logs, start)[later]
    return out


def _merged(before: np.ndarray, span: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums of equal (before, span), in their order."""
    order = np.lexsort((span, before))
    before, span, n = before[order], span[order], n[order]
    head = np.flatnonzero(np.concatenate([[True], (before[1:] != before[:-1]) | (span[1:] != span[:-1])])) if len(order) else order
    return before[head], span[head], np.add.reduceat(n, head) if len(head) else n


def _memory(survey: DataFrame, ranges: int) -> DataFrame:
    """slot, befores (ascending), c, t, and (pair_before, pair_span, n) of the pairs that occur
    more than once, for each hash range of the span before, of all training documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor()
        held = (np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.int64))
        waiting: list[np.ndarray] = []

        def emit() -> pa.RecordBatch:
            got = np.concatenate([np.empty(0, _SPANS), *waiting])
            before, span, n = _merged(*(np.concatenate(v) for v in zip(held, (got["before"], got["span"], np.ones(len(got), np.int64)), strict=True)))
            cuts = np.searchsorted(_range_of(before, ranges), np.arange(ranges + 1))
            some = np.flatnonzero(np.diff(cuts))
            cols = [[v[cuts[s] : cuts[s + 1]].tobytes() for s in some] for v in (before, span, n.astype(np.uint32))]
            waiting.clear()
            return pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), *(pa.array(c, pa.binary()) for c in cols)], names=["slot", "before", "span", "n"])

        for batch in batches:
            for s in range(0, batch.num_rows, 256):
                texts = [np.frombuffer(unpack.decompress(x), np.uint16) for x in batch.column("x").slice(s, 256).to_pylist()]
                _, y, to = sequences(np.concatenate(texts), np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64))
                waiting.append(followers(*spans_of(y, to)))
                if sum(map(len, waiting)) > FLUSH // 4:
                    yield emit()
        yield emit()

    def merge(rows: pa.Table) -> pa.Table:
        col = [np.concatenate([np.frombuffer(x, t) for x in rows.column(c).to_pylist()]) for c, t in (("before", "<u8"), ("span", "<u8"), ("n", "<u4"))]
        before, span, n = _merged(col[0], col[1], col[2].astype(np.int64))
        head = np.flatnonzero(np.concatenate([[True], before[1:] != before[:-1]])) if len(before) else np.empty(0, np.int64)
        c, t = (np.add.reduceat(n, head), np.diff(np.append(head, len(before)))) if len(head) else (n, n)
        keep = c > t
        pair = (n > 1)
        cols = {"befores": before[head][keep], "c": c[keep], "t": t[keep].astype(np.int64), "pair_before": before[pair], "pair_span": span[pair], "pair_n": n[pair]}
        return pa.table({"slot": rows.column("slot")[:1]} | {k: pa.array([v.tobytes()], pa.binary()) for k, v in cols.items()})

    own = survey.filter("slot is null and trains").select("x").mapInArrow(count, "slot bigint, before binary, span binary, n binary")
    return own.groupBy("slot").applyInArrow(merge, "slot bigint, befores binary, c binary, t binary, pair_before binary, pair_span binary, pair_n binary")


def remembered(records: np.ndarray, befores: np.ndarray, c: np.ndarray, t: np.ndarray, pair_before: np.ndarray, pair_span: np.ndarray, pair_n: np.ndarray) -> np.ndarray:
    """What memory adds to the log10 probability of each record's span."""
    out = np.zeros(len(records))
    if not len(befores):
        return out
    at = np.searchsorted(befores, records["before"])
    at[at == len(befores)] = 0
    hit = np.flatnonzero(befores[at] == records["before"])
    if not len(hit):
        return out
    r, c, t = records[hit], c[at[hit]].astype(float), t[at[hit]].astype(float)
    # Pairs are looked up by a mixed key of both hashes.
    key = lambda b, s: tk.mix(b * np.uint64(0x9E3779B97F4A7C15) + s)
    keys, asked = key(pair_before, pair_span), key(r["before"], r["span"])
    order = np.argsort(keys)
    to = np.searchsorted(keys[order], asked)
    to[to == len(keys)] = 0
    n = np.where(keys[order][to] == asked, pair_n[order][to], 1) if len(keys) else np.ones(len(r))
    # log10(a + b 10**logp), with a = (n - 1) / c and b = t / c, less logp; logp may be very small.
    logp = r["logp"].astype(float)
    with np.errstate(divide="ignore"):
        a, b = np.log10((n - 1) / c), np.log10(t / c) + logp
    top = np.maximum(a, b)
    out[hit] = top + np.log10(10.0 ** (a - top) + 10.0 ** (b - top)) - logp
    return out


def active_ids(id_counts: np.ndarray) -> np.ndarray:
    """A number for each id: its rank among the ACTIVE most frequent, or ACTIVE."""
    weight = id_counts.astype(np.float64)
    weight[START] = np.inf  # it stands before every text
    out = np.full(VOCAB, ACTIVE, np.int64)
    top = np.argsort(-weight, kind="stable")[:ACTIVE]
    out[top] = np.arange(len(top))
    return out


def learn_texts(model: Attention, active: np.ndarray, column_class: np.ndarray, by_class: np.ndarray, texts: list[np.ndarray], rate: float, rng: np.random.Generator) -> int:
    """Learns each id and end of the texts once, windows in random order; how many these are."""
    x, y, to = sequences(np.concatenate(texts), np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64))
    a, cls = active[x], column_class[active[y]]
    order, learned = rng.permutation(len(windows(to)[0])), 0
    for win, place, real in _batches(a, to, int(active[START]), BATCH, order):
        model.learn(win, cls.take(place), real, by_class, rate, tell=False)
        learned += int(real.sum())
    return learned


def fit(texts: list[np.ndarray], id_counts: np.ndarray, pair_counts: np.ndarray, word_end: np.ndarray, epochs: int = EPOCHS) -> tuple[Attention, Pairs]:
    """The model of texts that fit in memory, with the counts of their corpus."""
    active, rng = active_ids(id_counts), np.random.default_rng(11)
    pairs = Pairs(id_counts, active, pair_counts, classes_of(active, pair_counts, word_end), CLASSES + 2)
    model = Attention(CLASSES + 2)
    for epoch in range(epochs if texts else 0):
        learn_texts(model, active, pairs.column_class, pairs.by_class, texts, RATE / (1 + epoch), rng)
    model.ready()
    return model, pairs


def _count_pairs(survey: DataFrame, active: np.ndarray) -> np.ndarray:
    """Counts of (last, next) active ids over all training documents, (ACTIVE + 1)**2 numbers:
    summed per task, then by range of the last id on the executors."""
    sent = survey.sparkSession.sparkContext.broadcast(active)
    size, parts = ACTIVE + 1, 16

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        keep_freed()
        unpack, sums, any_ = zstandard.ZstdDecompressor(), np.zeros(size * size, np.int32), False
        for batch in batches:
            for s in range(0, batch.num_rows, 256):
                texts = [np.frombuffer(unpack.decompress(x), np.uint16) for x in batch.column("x").slice(s, 256).to_pylist()]
                x, y, _ = sequences(np.concatenate(texts), np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64))
                np.add.at(sums, sent.value[x] * size + sent.value[y], np.int32(1))
                any_ = True
        if any_:
            at = np.flatnonzero(sums)
            cuts = np.searchsorted(at, np.arange(parts + 1) * (size * size // parts + 1))
            x = [at[a:b].astype(np.int32).tobytes() for a, b in zip(cuts, cuts[1:], strict=False)]
            y = [sums[at[a:b]].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([pa.array(range(parts), pa.int64()), pa.array(x, pa.binary()), pa.array(y, pa.binary())], names=["part", "x", "y"])

    def total(rows: pd.DataFrame) -> pd.DataFrame:
        width = size * size // parts + 1
        first = int(rows["part"].iloc[0]) * width
        sums = np.zeros(width, np.int64)
        for x, y in zip(rows["x"], rows["y"], strict=True):
            sums[np.frombuffer(x, np.int32) - first] += np.frombuffer(y, np.int32)
        return pd.DataFrame({"part": [int(rows["part"].iloc[0])], "x": [sums.tobytes()]})

    own = survey.filter("slot is null and trains").select("x")
    out = np.zeros(size * size, np.int64)
    for r in own.mapInArrow(count, "part bigint, x binary, y binary").groupBy("part").applyInPandas(total, "part bigint, x binary").toLocalIterator():
        first = r["part"] * (size * size // parts + 1)
        got = np.frombuffer(r["x"], np.int64)[: len(out) - first]
        out[first : first + len(got)] = got
    return out


def _train(survey: DataFrame, pairs: Pairs, n: int, further: int = 0) -> tuple[Attention, int]:
    """The model, learned from all ``n`` training documents, and how many ids (with ends) that
    took, repeats included.  Tasks and the order in them follow from hashes of the rows.  A corpus
    of one task is learned EPOCHS times; a larger one in rounds, and ``further`` times as a whole."""
    spark, model, learned = survey.sparkSession, Attention(CLASSES + 2), 0
    own = survey.filter("slot is null and trains").select(F.xxhash64("doc_id", "h").alias("turn"), "doc_id", "h", "x")
    if n <= LOCAL_DOCS:
        rounds = [(0, ROUNDS[-1], RATE / (1 + epoch)) for epoch in range(EPOCHS if n else 0)]
    else:
        rounds = [(a, b, RATE) for a, b in zip((0, *ROUNDS), ROUNDS, strict=False)]
        rounds += [(0, ROUNDS[-1], RATE / (1 + epoch)) for epoch in range(1, 1 + further)]
    names = list(model.p)
    sizes = [model.p[k].size for k in names]
    slices = 16

    for first, end, rate in rounds:
        sent = spark.sparkContext.broadcast((model.p, model.sq, pairs.active, pairs.column_class, pairs.by_class))

        def learn(batches: Iterator[pa.RecordBatch], sent=sent, rate=rate) -> Iterator[pa.RecordBatch]:
            import zstandard

            only()
            keep_freed()
            p, sq, active, column_class, by_class = sent.value
            unpack, rng, mine = zstandard.ZstdDecompressor(), np.random.default_rng(11), Attention(CLASSES + 2)
            mine.p, mine.sq = ({k: v.copy() for k, v in x.items()} for x in (p, sq))
            waiting: list[np.ndarray] = []
            ids, size, seen = 0, 0, np.zeros(ACTIVE + 1, np.int64)

            def learn_waiting() -> None:
                nonlocal ids, size, seen
                ids += learn_texts(mine, active, column_class, by_class, waiting, rate, rng)
                seen += np.bincount(active[np.concatenate(waiting)], minlength=len(seen))
                seen[active[START]] += len(waiting)
                waiting.clear()
                size = 0

            for batch in batches:
                for x in batch.column("x"):
                    waiting.append(np.frombuffer(unpack.decompress(x.as_py()), np.uint16))
                    size += len(waiting[-1]) + 1
                    if size >= MIXED:
                        learn_waiting()
            if waiting:
                learn_waiting()
            if ids:
                part = {k: seen[:, None] if k == "e" else ids for k in names}
                change = [((new[k] - old[k]) * np.float32(part[k])).ravel() for new, old in ((mine.p, p), (mine.sq, sq)) for k in names]
                change = np.concatenate([*change, seen.astype(np.float32)])
                yield pa.RecordBatch.from_arrays([pa.array(range(slices), pa.int64()), pa.array([ids] * slices, pa.int64()), pa.array([c.tobytes() for c in np.array_split(change, slices)], pa.binary())], names=["slice", "ids", "x"])

        def total(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            sums: dict[int, tuple[int, np.ndarray | float]] = {}
            for frame in frames:
                for k, ids, x in zip(frame["slice"], frame["ids"], frame["x"], strict=True):
                    n, s = sums.get(k, (0, 0.0))
                    sums[k] = n + ids, s + np.frombuffer(x, np.float32).astype(np.float64)
            for k, (ids, s) in sums.items():
                yield pd.DataFrame({"slice": [k], "ids": [ids], "x": [s.tobytes()]})

        turn = F.pmod("turn", F.lit(ROUNDS[-1]))
        tasks = max(1, -(-n * (end - first) // (ROUNDS[-1] * LOCAL_DOCS)))
        dealt = own.filter((turn >= first) & (turn < end)).repartition(tasks, "turn").sortWithinPartitions("turn", "doc_id", "h").select("x")
        parts = dealt.mapInArrow(learn, "slice bigint, ids bigint, x binary").repartition(slices, "slice")
        rows = sorted(parts.mapInPandas(total, "slice bigint, ids bigint, x binary").collect())
        sent.unpersist()
        del dealt, parts
        sweep(spark)  # a round's shuffle goes before the next one's
        if not rows:
            continue
        learned += rows[0]["ids"]
        *sums, seen = np.split(np.concatenate([np.frombuffer(r["x"]) for r in rows]), np.cumsum(sizes * 2))
        for (x, k), d in zip([(x, k) for x in (model.p, model.sq) for k in names], sums, strict=True):
            part = np.maximum(seen, 1)[:, None] if k == "e" else rows[0]["ids"]
            x[k] = (x[k] + d.reshape(x[k].shape) / part).astype(np.float32)
    model.ready()
    return model, learned


def score(docs: DataFrame, test_mod: int = 7, test_fold: int = 2, vocab_path: str | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of each row."""
    spark = docs.sparkSession
    # A row is known by its id and a digest of its text, so that rows may repeat.
    rows = docs.select("doc_id", F.xxhash64("text").alias("h"), (fold("doc_id", test_mod) == test_fold).alias("held_out"), "text")
    ranges = max(4, -(-docs.count() // RANGE_DOCS))
    survey = save(_survey(rows, ranges, vocab_path), "survey")
    counts = save(_word_counts(survey), "counts")
    summed = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("total"), F.lit(0)).alias("total")).first()
    id_counts, ends = _sum_ids(survey)
    tokens, distinct = int(summed["total"]) + ends, int(summed["n"]) + int(ends > 0)
    base = _base(rows, counts, ranges, tokens, ends)
    drop(counts, clean=True)

    enc = encoder(vocabulary(vocab_path))
    word_end = np.array([(enc.tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(VOCAB)])
    active = active_ids(id_counts)
    pair_counts = _count_pairs(survey, active)
    pairs = Pairs(id_counts, active, pair_counts, classes_of(active, pair_counts, word_end), CLASSES + 2)
    model, _ = _train(survey, pairs, ends, further=EPOCHS - 1)
    sweep(spark)
    model.p = model.sq = {}  # only the tables are needed from here on
    sent = spark.sparkContext.broadcast((model, pairs))
    memory = save(_memory(survey, ranges), "memory")
    names = ["step", "id", "of", "score", "slot", "records"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark import TaskContext

        only()
        keep_freed()
        model, pairs = sent.value
        unpack, number = zstandard.ZstdDecompressor(), TaskContext.get().partitionId() << 32
        for batch in batches:
            for first in range(0, batch.num_rows, STEP_DOCS):
                whole, records = batch.slice(first, STEP_DOCS), [np.empty(0, _SPANS)]
                for s in range(0, whole.num_rows, 256):
                    part = whole.slice(s, 256)
                    texts = [np.frombuffer(unpack.decompress(x), np.uint16) for x in part.column("x").to_pylist()]
                    at = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
                    logs, y, to = place_logs(model, pairs, np.concatenate(texts).astype(np.int64), at)
                    own = followers(*spans_of(y, to), logs)
                    own["text"] += s
                    records.append(own)
                    n, none = part.num_rows, part.num_rows
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, number)), part.column("doc_id"), part.column("h"), pa.array(tk.segment_sums(logs, to)), pa.nulls(none, pa.int64()), pa.nulls(none, pa.binary())], names=names)
                both = np.concatenate(records)
                slot = _range_of(both["before"], ranges)
                order = np.argsort(slot, kind="stable")
                both, cuts = both[order], np.searchsorted(slot[order], np.arange(ranges + 1))
                some = np.flatnonzero(np.diff(cuts))
                m = len(some)
                head = np.array([whole.num_rows], np.uint32).tobytes()
                data = [head + both[cuts[r] : cuts[r + 1]].tobytes() for r in some]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(m, number)), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.float64()), pa.array(some, pa.int64()), pa.array(data, pa.binary())], names=names)
                number += 1

    def recall(asked: pa.Table, held: pa.Table) -> pa.Table:
        known = [np.frombuffer(held.column(c)[0].as_py(), t) if held.num_rows else np.empty(0, t) for c, t in (("befores", "<u8"), ("c", "<i8"), ("t", "<i8"), ("pair_before", "<u8"), ("pair_span", "<u8"), ("pair_n", "<i8"))]
        steps_, more = [], []
        for number, data in zip(asked.column("step").to_pylist(), asked.column("records").to_pylist(), strict=True):
            n, records = int(np.frombuffer(data, np.uint32, 1)[0]), np.frombuffer(data, _SPANS, offset=4)
            got = remembered(records, *known)
            if got.any():
                steps_.append(number)
                more.append(np.bincount(records["text"], weights=got, minlength=n).tobytes())
        return pa.table({"step": pa.array(steps_, pa.int64()), "more": pa.array(more, pa.binary())})

    def add(rows: pa.Table, parts: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return rows.select(["id", "of", "score"]).slice(0, 0)
        score = rows.column("score").to_numpy().copy()
        for x in parts.column("more").to_pylist():
            score += np.frombuffer(x)
        return pa.table({"id": rows.column("id"), "of": rows.column("of"), "score": pa.array(score)})

    texts = survey.filter("slot is null").select("doc_id", "h", "x")
    sent_out = save(texts.mapInArrow(run, "step bigint, id bigint, of bigint, score double, slot bigint, records binary"), "scored")
    asked = sent_out.filter("slot is not null").select("slot", "step", "records")
    more = asked.groupBy("slot").cogroup(memory.withColumnRenamed("slot", "at").groupBy("at")).applyInArrow(recall, "step bigint, more binary")
    own = sent_out.filter("slot is null").select("step", "id", "of", "score", F.monotonically_increasing_id().alias("nth"))
    scored = own.groupBy("step").cogroup(more.groupBy("step")).applyInArrow(lambda a, b: add(a.sort_by("nth"), b), "id bigint, of bigint, score double")
    scored = save(scored.dropDuplicates(["id", "of"]), "scores")
    drop(survey, memory, sent_out, clean=True)
    out = base.join(scored, (F.col("h") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("id")))
    per_token = float(np.log10(tokens + distinct + 1))
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("bigint").alias("train_tokens"), (F.col("logs") - F.col("n_tokens") * F.lit(per_token)).alias("base_score"), "score")


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
