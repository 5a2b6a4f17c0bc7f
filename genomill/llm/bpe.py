"""BPE encoding and decoding of whole texts (operator 3).

A text longer than ``LEAF`` bytes is encoded by *tree concatenation*: it is halved until its
parts are no longer than that, wherever the cuts fall; all leaves are encoded in parallel; then
neighbours are joined, re-encoding a window around each join that doubles until its ids agree
with both sides.  Windows of different joins do not touch, so the joins of all levels, of many
texts, go to the tokenizer library in one parallel batch; a text whose windows would meet is
joined level by level (``tree``).

Leaves are encoded by chunks: the tokenizer drops white space and never merges across it, so
a leaf's ids are those of its white-space-free chunks one after another.  Chunks are found and
hashed in blocks (``textkernel``); each distinct chunk is encoded once per worker by the
tokenizer library and then looked up (the seldom ones are forgotten when the table is full).
Most of what a new chunk costs is the call, not its merges, so ``JOINED`` of them go in one text
with spaces between.  Where one chunk's ids end follows from its words: just the last token of a
word ends with ``</w>``, and the words of chunks of ASCII and of letters from U+00C0 to U+00FF can
be counted by their bytes.  All other chunks, and all chunks of other kinds of tokenizers, are
encoded one by one.

Why agreement is enough: a sequence of tokens is the encoding of its text exactly if every
adjacent pair of tokens is.  Inside each side and inside the window all pairs are sound;
where window and side share a token at one place, the pair across the seam is one of those.
A side's token is trusted only away from its cut, where an end-of-word mark may be false.

Nulls and empty texts give no ids.  Repeated rows each have a result.  Chunks are told apart
by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import textkernel as tk
from .common import bounded_batches, hold, ragged, steps

#: Bytes of a leaf at most; chunks on either side of a join in its first window.
LEAF, WINDOW = 8192, 8
#: Characters of a leaf, and tokens on either side in the first window, level by level.
TREE_LEAF, TREE_WINDOW = 4096, 32
#: Bytes of the table of chunks that a worker remembers, at most (about).
REMEMBERED = 40 << 20
#: Chunks that are handed to the tokenizer at a time, those in one text, and bytes of text in a step.
PORTION, JOINED, STEP = 10_000, 100, 1 << 20
#: What a tokenizer's file says if words can be counted as ``plain_words`` does.
WORDS = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}
MODEL = {"type": "BPE", "dropout": None, "continuing_subword_prefix": None, "end_of_word_suffix": "</w>", "byte_fallback": False, "ignore_merges": False}
#: Tokens that have to agree in a row.
AGREE = 3


def vocabulary(path: str | None = None) -> bytes:
    """The tokenizer file's bytes (its size is fixed, 1.7 MB), to be sent to the workers."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, "rb") as file:
        return file.read()


def word_ends(vocab: bytes) -> np.ndarray | None:
    """Which ids end a word, if each word's last token does and no other can; None otherwise."""
    said = json.loads(vocab)
    model = said["model"]
    if any(said[k] != v for k, v in WORDS.items()) or any(model.get(k) != v for k, v in MODEL.items()):
        return None
    letters = [*range(33, 127), *range(161, 173), *range(174, 256), *range(256, 324)]  # one for each byte
    if any(chr(c) + end not in model["vocab"] for c in letters for end in ("", "</w>")):
        return None
    special = {t["id"] for t in said["added_tokens"]}
    out = np.zeros(max([*model["vocab"].values(), *special]) + 1, bool)
    out[[i for token, i in model["vocab"].items() if token.endswith("</w>") and i not in special]] = True
    return out


# Kinds of bytes: 0 letters, 1 digits, 2 other visible ones, 3 those that are not counted.
_KIND = np.full(256, 3, np.uint8)
_KIND[0x21:0x7F] = 2
_KIND[0x30:0x3A] = 1
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B), 0xC3]] = 0


def plain_words(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many words the tokenizer finds in each text [at[i], at[i + 1]), none of them empty; 0
    for those that it has to tell itself: with apostrophes, ``<|`` or other characters."""
    kind = _KIND[raw]
    second = np.zeros(len(raw), bool)  # of two bytes from U+00C0 to U+00FF, but for the signs of times and division
    second[1:] = (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] < 0xC0) & (raw[1:] != 0x97) & (raw[1:] != 0xB7)
    second[at[:-1]] = False
    kind[second] = 0
    first = kind == 1
    first[1:] |= kind[1:] != kind[:-1]
    first[at[:-1]] = True
    odd = (kind == 3) | (raw == 0x27)
    odd[:-1] |= (raw[:-1] == 0xC3) & ~second[1:] | (raw[:-1] == 0x3C) & (raw[1:] == 0x7C)
    odd[-1:] |= raw[-1:] == 0xC3
    return np.where(np.add.reduceat(odd, at[:-1], dtype=np.int64) > 0, 0, np.add.reduceat(first, at[:-1], dtype=np.int64))


class Encoder:
    """Encodes Arrow string columns; one per worker and vocabulary."""

    def __init__(self, vocab: bytes, leaf: int = LEAF, window: int = WINDOW, tree_leaf: int = TREE_LEAF, tree_window: int = TREE_WINDOW) -> None:
        os.environ.setdefault("RAYON_NUM_THREADS", "2")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocab.decode("utf-8"))
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.leaf, self.window, self.tree_leaf, self.tree_window = leaf, window, tree_leaf, tree_window
        self.special_ids = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.special = re.compile("(" + "|".join(map(re.escape, self.special_ids)) + ")") if self.special_ids else None
        self.word_ends = word_ends(vocab)
        self.joins = self.regrown = self.by_level = 0  # joins made, windows that grew, texts joined level by level
        self._forget()

    def _forget(self) -> None:
        self.keys, self.place = np.empty(0, np.uint64), np.empty(0, np.int32)
        self.first, self.size, self.n = np.empty(1024, np.int32), np.empty(1024, np.int32), 0
        self.asked = np.zeros(1024, np.int32)  # in how many steps
        self.pool, self.used = np.empty(4096, np.int32), 0

    def _thin(self) -> None:
        """Forgets the chunks that few steps asked for, half of what is remembered or more; how
        often the others were asked for is halved, so that they go in their turn."""
        asked = self.asked[self.place]
        keep = np.flatnonzero(asked > max(1, np.partition(asked, len(asked) // 2)[len(asked) // 2]))
        place = self.place[keep]
        sizes = self.size[place]
        pool = ragged(self.pool, sizes.astype(np.int64), self.first[place].astype(np.int64))
        self.keys, self.place, self.n = self.keys[keep], np.arange(len(keep), dtype=np.int32), len(keep)
        self.size, self.first = sizes, (np.cumsum(sizes) - sizes).astype(np.int32)
        self.asked, self.pool, self.used = asked[keep] // 2, pool, len(pool)

    # -- chunks ---------------------------------------------------------------------

    def _learn(self, keys: np.ndarray, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Encodes new chunks (by ascending key), a portion at a time."""
        if len(self.keys) and 24 * (len(self.keys) + len(keys)) + 4 * self.used > REMEMBERED:
            self._thin()  # what is needed now and is gone is learned again by the caller
        n = self.n + len(keys)
        if n > len(self.first):
            self.first, self.size, self.asked = (np.resize(x, n + n // 2) for x in (self.first, self.size, self.asked))
        self.asked[self.n : n] = 0
        for a in range(0, len(keys), PORTION):
            ids, sizes = self._encoded(raw, starts[a : a + PORTION], ends[a : a + PORTION])
            until = self.used + len(ids)
            if until > len(self.pool):
                self.pool = np.resize(self.pool, until + until // 2)
            self.pool[self.used : until] = ids
            at = self.n + a
            self.first[at : at + len(sizes)] = self.used + np.cumsum(sizes) - sizes
            self.size[at : at + len(sizes)] = sizes
            self.used = until
        to = np.searchsorted(self.keys, keys)
        self.keys, self.place = np.insert(self.keys, to, keys), np.insert(self.place, to, np.arange(self.n, n, dtype=np.int32))
        self.n = n

    def _encoded(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks one after another, and how many each has."""
        lens, n = ends - starts, len(starts)
        at = np.concatenate([[0], np.cumsum(lens)])
        own = ragged(raw, lens, starts)
        words = plain_words(own, at) if self.word_ends is not None else np.zeros(n, np.int64)
        plain, odd = np.flatnonzero(words), np.flatnonzero(words == 0)
        sizes = np.zeros(n, np.int64)
        # Each plain chunk with a space behind it.
        to = np.concatenate([[0], np.cumsum(lens[plain] + 1)])
        spaced = np.full(int(to[-1]), 0x20, np.uint8)
        inner = np.ones(len(spaced), bool)
        inner[to[1:] - 1] = False
        spaced[inner] = ragged(own, lens[plain], at[:-1][plain])
        data = spaced.tobytes()
        edges = to[np.append(np.arange(0, len(plain), JOINED), len(plain))].tolist()
        joined = self._ids([data[a:b].decode("utf-8") for a, b in zip(edges, edges[1:], strict=False)])[0]
        last = np.flatnonzero(self.word_ends[joined]) if len(plain) else joined
        if len(last) != words.sum():  # not the words that were counted
            joined, plain, odd = joined[:0], plain[:0], np.arange(n)
        if len(plain):
            sizes[plain] = np.diff(last[np.cumsum(words[plain]) - 1] + 1, prepend=0)
        data = own.tobytes()
        single, sizes[odd] = self._ids([data[a:b].decode("utf-8") for a, b in zip(at[odd].tolist(), at[odd + 1].tolist(), strict=True)])
        if not len(odd):
            return joined, sizes
        # The two kinds back in their order.
        from_ = np.empty(n, np.int64)
        from_[plain] = np.cumsum(sizes[plain]) - sizes[plain]
        from_[odd] = np.cumsum(sizes[odd]) - sizes[odd] + len(joined)
        return ragged(np.concatenate([joined, single]), sizes, from_), sizes

    def _ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts as the tokenizer library has them, and how many each has."""
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.int32, int(sizes.sum())), sizes

    def _chunks(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks, and the n + 1 offsets of the chunks in them."""
        keys, one, which = np.unique(tk.span_hashes(raw, starts, ends, fold=False), return_index=True, return_inverse=True)
        while True:
            to = np.searchsorted(self.keys, keys)
            known = np.zeros(len(keys), dtype=bool)
            inside = to < len(self.keys)
            known[inside] = self.keys[to[inside]] == keys[inside]
            if known.all():
                break
            new = np.flatnonzero(~known)
            self._learn(keys[new], raw, starts[one[new]], ends[one[new]])
        self.asked[self.place[to]] += 1
        place = self.place[to][which]
        sizes = self.size[place].astype(np.int64)
        return ragged(self.pool, sizes, self.first[place].astype(np.int64)), np.concatenate([[0], np.cumsum(sizes)])

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and the n + 1 offsets of the texts in them."""
        raw, at = tk.buffers(column)
        cuts = self._cuts(raw, at)
        edges = np.unique(np.concatenate([at, cuts])) if len(cuts) else at
        starts, ends = tk.spans(raw, edges)
        if not len(starts):
            return np.empty(0, np.int32), np.zeros(len(at), np.int64)
        ids, until = self._chunks(raw, starts, ends)
        to = until[np.searchsorted(starts, at)]
        if len(cuts):
            ids, to = self._joined(raw, at, edges, cuts, starts, ends, ids, until, to)
        return ids, to

    # -- joins of leaves --------------------------------------------------------------

    def _cuts(self, raw: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where longer texts are halved, and their halves again, at the starts of characters."""
        out = [np.empty(0, np.int64)]
        size = np.diff(at)
        for t in np.flatnonzero(size > self.leaf).tolist():
            parts = 1 << (-(-int(size[t]) // self.leaf) - 1).bit_length()
            out.append(at[t] + np.arange(1, parts) * size[t] // parts)
        cuts = np.concatenate(out)
        for _ in range(3):
            cuts = np.where((raw[cuts] & 0xC0) == 0x80, cuts - 1, cuts) if len(cuts) else cuts
        return cuts

    def _joined(self, raw: np.ndarray, at: np.ndarray, edges: np.ndarray, cuts: np.ndarray, starts: np.ndarray, ends: np.ndarray, ids: np.ndarray, until: np.ndarray, to: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids and offsets of whole texts, from those of their leaves."""
        text = np.searchsorted(at, cuts, side="right") - 1
        k = np.searchsorted(edges, cuts)
        lo, hi = edges[k - 1], edges[k + 1]
        first, here, last = (np.searchsorted(starts, x) for x in (lo, cuts, hi))
        opens, closes = lo == at[text], hi == at[text + 1]
        data = raw.tobytes()
        edits: dict[int, tuple[int, int, list[int]]] = {}
        failed: set[int] = set()
        todo, width = list(range(len(cuts))), self.window
        while todo:
            spans = []
            for c in todo:
                i, j = max(first[c], here[c] - width), min(last[c], here[c] + width)
                cut = int(cuts[c])
                left = data[starts[i] : cut].decode("utf-8") if i < here[c] else ""
                right = data[cut : ends[j - 1]].decode("utf-8") if j > here[c] else ""
                spans.append((c, int(i), int(j), left, right))
            got = self.tokenizer.encode_batch([x for _, _, _, a, b in spans for x in (a, b, a + b)], add_special_tokens=False)
            todo = []
            for n, (c, i, j, left, _) in enumerate(spans):
                a, b, mid = (list(zip(e.ids, *zip(*e.offsets, strict=True), strict=True)) if e.ids else [] for e in got[3 * n : 3 * n + 3])
                b = [(x, s + len(left), e + len(left)) for x, s, e in b]
                p, q = self._same_left(a, mid, len(left)), self._same_right(b, mid, len(left))
                if p is None and i == first[c] and (opens[c] or first[c] == here[c]):
                    p = 0, 0
                if q is None and j == last[c] and (closes[c] or last[c] == here[c]):
                    q = len(b), len(mid)
                r = int(here[c])
                if p is not None and q is not None and len(a) == until[r] - until[i] and len(b) == until[j] - until[r]:
                    edits[c] = int(until[i]) + p[0], int(until[r]) + q[0], [x for x, _, _ in mid[p[1] : q[1]]]
                elif i == first[c] and j == last[c]:
                    failed.add(int(text[c]))
                else:
                    todo.append(c)
            self.regrown += len(todo)
            width *= 2
        self.joins += len(cuts)
        order = sorted(edits)
        failed |= {int(text[y]) for x, y in zip(order, order[1:], strict=False) if edits[x][1] > edits[y][0]}
        self.by_level += len(failed)
        whole = [(int(to[t]), int(to[t + 1]), self.tree(data[at[t] : at[t + 1]].decode("utf-8"))) for t in sorted(failed)]
        places = sorted([(e, int(text[c])) for c, e in edits.items() if int(text[c]) not in failed] + list(zip(whole, sorted(failed), strict=True)))
        parts, done, grown = [], 0, np.zeros(len(at), np.int64)
        for (s, e, new), t in places:
            parts += [ids[done:s], np.array(new, np.int32)]
            done = e
            grown[t + 1] += len(new) - (e - s)
        return np.concatenate([*parts, ids[done:]]), to + np.cumsum(grown)

    @staticmethod
    def _same_left(side: list, mid: list, cut: int) -> tuple[int, int] | None:
        """Places in side and window, as near the cut as can be, from which AGREE tokens that
        end before it are the same."""
        at = {t: k for k, t in enumerate(mid)}
        for x in range(len(side) - AGREE, -1, -1):
            y = at.get(side[x])
            if y is not None and side[x + AGREE - 1][2] < cut and side[x : x + AGREE] == mid[y : y + AGREE] and (x == 0 or side[x - 1][2] <= side[x][1]):
                return x, y
        return None

    @staticmethod
    def _same_right(side: list, mid: list, cut: int) -> tuple[int, int] | None:
        """Places in side and window, as near the cut as can be, before which AGREE tokens that
        begin after it are the same, as are those at them."""
        at = {t: k for k, t in enumerate(mid[:-1])}
        for x in range(AGREE, len(side)):
            y = at.get(side[x])
            if y is not None and y >= AGREE and side[x - AGREE][1] > cut and side[x - AGREE : x + 1] == mid[y - AGREE : y + 1] and side[x - 1][2] <= side[x][1]:
                return x, y
        return None

    # -- level by level -----------------------------------------------------------------

    def _tokens(self, text: str, at: int) -> list[tuple[int, int, int]]:
        e = self.tokenizer.encode(text, add_special_tokens=False)
        return [(i, a + at, b + at) for i, (a, b) in zip(e.ids, e.offsets, strict=True)]

    def tree(self, text: str) -> list[int]:
        """Ids of one text.  Special tokens' strings are taken out first, as the tokenizer
        does; the parts between them are joined apart."""
        out: list[int] = []
        for part in self.special.split(text) if self.special else [text]:
            if part in self.special_ids:
                out.append(self.special_ids[part])
            elif part:
                out += self._tree(part)
        return out

    def _tree(self, text: str) -> list[int]:
        cuts = [*range(0, len(text), self.tree_leaf), len(text)]
        if len(cuts) > 2 and cuts[-1] - cuts[-2] < self.tree_leaf // 2:
            del cuts[-2]
        pieces = self.tokenizer.encode_batch([text[a:b] for a, b in zip(cuts, cuts[1:], strict=False)], add_special_tokens=False)
        nodes = [(a, b, [(i, s + a, t + a) for i, (s, t) in zip(e.ids, e.offsets, strict=True)]) for a, b, e in zip(cuts, cuts[1:], pieces, strict=False)]
        while len(nodes) > 1:
            joined = [self._join(text, x, y) for x, y in zip(nodes[::2], nodes[1::2], strict=False)]
            nodes = joined + nodes[len(joined) * 2 :]
        return [i for i, _, _ in nodes[0][2]]

    def _join(self, text: str, left: tuple, right: tuple) -> tuple:
        lo, cut, a = left
        _, hi, b = right
        width = self.tree_window
        while True:
            i = max(0, len(a) - width)
            while i > 0 and a[i][1] < a[i - 1][2]:  # within a character
                i -= 1
            j = min(len(b), width)
            while 0 < j < len(b) and b[j][1] < b[j - 1][2]:
                j += 1
            begin, end = (a[i][1] if i else lo), (b[j][1] if j < len(b) else hi)
            mid = self._tokens(text[begin:end], begin)
            if begin == lo and end == hi:
                return lo, hi, mid
            p = 0 if begin == lo else self._agree_left(a, i, mid, cut)
            q = len(mid) if end == hi else self._agree_right(b, j, mid, cut)
            if p is not None and q is not None:
                head = a[:i] if begin == lo else a[: p[0]]
                body = mid[(p if begin == lo else p[1]) : (q if end == hi else q[1])]
                return lo, hi, head + body + (b[j:] if end == hi else b[q[0] :])
            width *= 2

    @staticmethod
    def _agree_left(side: list, i: int, mid: list, cut: int) -> tuple[int, int] | None:
        """Places in side and window from which AGREE tokens are the same, well before the cut."""
        at = {t: k for k, t in enumerate(mid)}
        for x in range(i, len(side) - AGREE):
            y = at.get(side[x])
            if y is not None and side[x : x + AGREE] == mid[y : y + AGREE] and (x == 0 or side[x - 1][2] <= side[x][1]) and side[x + AGREE - 1][2] < cut:
                return x, y
        return None

    @staticmethod
    def _agree_right(side: list, j: int, mid: list, cut: int) -> tuple[int, int] | None:
        """Places in side and window before which AGREE tokens are the same; the window's own
        last tokens, next to its end, are not trusted."""
        at = {t: k for k, t in enumerate(mid[:-1])}
        for x in range(min(j, len(side)) - 1, AGREE, -1):
            y = at.get(side[x])
            if y is not None and y >= AGREE and side[x - AGREE : x + 1] == mid[y - AGREE : y + 1] and side[x - 1][2] <= side[x][1] and side[x - AGREE][1] > cut:
                return x, y
        return None


_ENCODERS: dict[int, Encoder] = {}


def encoder(vocab: bytes) -> Encoder:
    """The worker's encoder of this vocabulary; it stays for later tasks of the worker."""
    key = hash(vocab)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(vocab)
    hold("bpe", _ENCODERS.clear)
    return _ENCODERS[key]


class Decoder:
    """Turns ids into the bytes of ``decode(ids, skip_special_tokens=False)`` and of the
    decimal ids joined by spaces, by lookup in tables over the vocabulary."""

    def __init__(self, enc: Encoder) -> None:
        t = enc.tokenizer
        size = t.get_vocab_size(with_added_tokens=True)
        if t.decoder is not None:
            raise ValueError("only vocabularies without a decoder, whose tokens are joined by spaces, can be decoded")
        self.tokens = self._table([(t.id_to_token(i) or "") + " " for i in range(size)])
        self.numbers = self._table([f"{i} " for i in range(size)])

    @staticmethod
    def _table(items: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        data = [x.encode("utf-8") for x in items]
        lens = np.fromiter(map(len, data), np.int64, len(data))
        return np.frombuffer(b"".join(data), np.uint8), np.cumsum(lens) - lens, lens

    @staticmethod
    def _digests(which: tuple, ids: np.ndarray, at: np.ndarray) -> list[str]:
        pool, first, lens = which
        out: list[str] = []
        for a, b in tk.text_blocks(at, 1 << 18):
            part = ids[at[a] : at[b]]
            n = lens[part]
            data = ragged(pool, n, first[part])
            until = np.concatenate([[0], np.cumsum(n)])[at[a : b + 1] - at[a]]
            view = memoryview(data)
            out += [hashlib.sha256(view[s : max(s, e - 1)]).hexdigest() for s, e in zip(until[:-1].tolist(), until[1:].tolist(), strict=True)]
        return out

    def id_digests(self, ids: np.ndarray, at: np.ndarray) -> list[str]:
        return self._digests(self.numbers, ids, at)

    def text_digests(self, ids: np.ndarray, at: np.ndarray) -> list[str]:
        return self._digests(self.tokens, ids, at)

    def texts(self, ids: np.ndarray, at: np.ndarray) -> list[str]:
        pool, first, lens = self.tokens
        return [ragged(pool, lens[x], first[x]).tobytes()[:-1].decode("utf-8") for x in (ids[a:b] for a, b in zip(at, at[1:], strict=False))]


def encode(docs: DataFrame, vocab_path: str | None = None, *, decoded: bool = False) -> DataFrame:
    """doc_id, ids array<int> [, decoded string] of each row, in the rows' own partitions."""
    vocab = docs.sparkSession.sparkContext.broadcast(vocabulary(vocab_path))
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocab.value)
        dec = Decoder(enc) if decoded else None
        for step in steps(batches, "text", STEP, owner="bpe"):
            ids, at = enc.encode(step.column("text"))
            cols = [step.column("doc_id"), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32()))]
            if dec:
                cols.append(pa.array(dec.texts(ids, at), pa.string()))
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "ids", "decoded"][: len(cols)])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, ids array<int>" + ", decoded string" * decoded)


def round_trip_digests(docs: DataFrame, vocab_path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each row: the digests of ``encode``'s
    ids and of the text decoded from them.  No shuffle; one scan."""
    vocab = docs.sparkSession.sparkContext.broadcast(vocabulary(vocab_path))
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocab.value)
        dec = Decoder(enc)
        for step in steps(batches, "text", STEP, owner="bpe"):
            ids, at = enc.encode(step.column("text"))
            yield pa.RecordBatch.from_arrays(
                [step.column("doc_id"), pa.array(np.diff(at), pa.int64()), pa.array(dec.id_digests(ids, at)), pa.array(dec.text_digests(ids, at))],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .common import table

    return round_trip_digests(table(spark, sf_dir, "documents"))
