"""Operators against brute force, exact round trips and held-out accuracy, on small inputs
with nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import zstandard
from pyspark.sql import functions as F

from genomill.llm import bpe, common, kmtree, langid, linededup, lm, minhash, packing, pii, pivots, toxicity
from genomill.llm import textkernel as tk
from genomill.llm.components import connected_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
RNG = random.Random(5)
SYLLABLES = {"en": "the ing er on at ed".split(), "fr": "eau ou le tion é re".split()}


def words(text):
    return WORD.findall((text or "").translate(LOW))


def prose(lang, n, rng=RNG):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def odd_texts():
    base = prose("en", 40)
    near = base.split()
    near[3] = "changed"
    return [base, base, base.upper(), " ".join(near), "", None, "   \n ", "one", "one two three", "one two three", "\n".join([base, "", base, prose("fr", 12)]), prose("fr", 3000), "é" * 3000, "a b " * 5, "<|endoftext|> x", "O " * 50]


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(9)
    rows = [(i, t, "en", f"s{i % 2}") for i, t in enumerate(odd_texts())]
    for i in range(100, 160):
        lang = "en" if i % 2 else "fr"
        rows.append((i, "\n".join(prose(lang, rng.randint(4, 40), rng) for _ in range(rng.randint(1, 5))), lang, "s"))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    return df.withColumns({"id": F.lit(1), "_spans": F.lit(2), "removed": F.lit(3), "n_lines": F.lit(4), "row": F.lit(5), "slot": F.lit(6), "x": F.lit(7)}).repartition(3)


def texts_of(docs):
    return {r["doc_id"]: r["text"] for r in docs.collect()}


def empty(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, lang string, source string")


# -- words --------------------------------------------------------------------------------


def test_word_identities():
    texts = odd_texts()
    ids, at = tk.words(pa.array(texts))
    seen = {}
    for i, t in enumerate(texts):
        own = words(t)
        assert at[i + 1] - at[i] == len(own)
        for w, x in zip(own, ids[at[i] : at[i + 1]], strict=True):
            assert seen.setdefault(w, x) == x
    assert len(set(seen.values())) == len(seen)
    few = tk.BLOCK
    try:
        tk.BLOCK = 50
        assert (tk.words(pa.array(texts))[0] == ids).all()
    finally:
        tk.BLOCK = few


# -- 3, 5 ---------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_str(bpe.vocabulary().decode())


def test_encoding_is_the_librarys(docs, tokenizer, spark):
    got = {r["doc_id"]: r for r in bpe.round_trip_digests(docs).collect()}
    for i, t in texts_of(docs).items():
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.round_trip_digests(empty(spark)).count() == 0
    one = bpe.encode(docs.filter("doc_id = 0"), decoded=True).first()
    assert one["decoded"] == tokenizer.decode(list(one["ids"]), skip_special_tokens=False)


def test_tree_concatenation(tokenizer):
    enc = bpe.Encoder(bpe.vocabulary(), tree_leaf=16, tree_window=4)
    rng = random.Random(1)
    for alphabet in ("abcdefgh", "theringandof", "é日本語ßabc", "'st re1234'll", "!!!###abc", "aaaa", "éäb́"):
        for _ in range(150):
            s = "".join(rng.choice(alphabet) for _ in range(rng.randint(21, 300))).replace(" ", "")
            assert enc.tree(s) == tokenizer.encode(s, add_special_tokens=False).ids
    for s in ("<|endoftext|>" * 9, "ab<|endoftext|>" * 7 + "cd"):
        assert enc.tree(s) == tokenizer.encode(s, add_special_tokens=False).ids


def test_long_texts_are_joined(tokenizer, data):
    rng = random.Random(1)
    texts = [None, "", "x"]
    for alphabet in ("abcdefgh ", "theringandof    ", "é日本語ßabc ", "'st re1234'll \n\t", "!!!###abc  ", "aaaa", "éäb́ ", "ab<|endoftext|> ", "  ab c", "日本語日本"):
        texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 700))) for _ in range(40)]
    texts += ["<|endoftext|>" * 90, "ab<|endoftext|>" * 70 + "cd", "x " * 500 + "<|endoftext|>" * 40 + " yy" * 300, " " * 900]
    small = bpe.Encoder(bpe.vocabulary(), leaf=64, window=4, tree_leaf=16, tree_window=4)
    for column, enc in ((texts, small), (pq.read_table(f"{data}/documents.parquet")["text"].to_pylist(), bpe.Encoder(bpe.vocabulary()))):
        ids, at = enc.encode(pa.array(column))
        for k, t in enumerate(column):
            assert ids[at[k] : at[k + 1]].tolist() == tokenizer.encode(t or "", add_special_tokens=False).ids
        # A join for every cut of a text that is longer than a leaf.
        assert enc.joins == sum((1 << (-(-n // enc.leaf) - 1).bit_length()) - 1 for n in (len((t or "").encode()) for t in column) if n > enc.leaf) > 0
    assert small.regrown and small.by_level


def test_remembered_chunks_are_bounded(tokenizer, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 20_000)
    monkeypatch.setattr(bpe, "PORTION", 7)
    enc = bpe.Encoder(bpe.vocabulary())
    for i in range(20):
        texts = [" ".join(f"w{i}x{k}" for k in range(100)), "again and again"]
        ids, at = enc.encode(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:], strict=False)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert 24 * len(enc.keys) + 4 * enc.used <= 25_000
        assert {"again", "and"} <= {enc.tokenizer.decode(enc.pool[enc.first[p] : enc.first[p] + enc.size[p]].tolist()).replace("</w>", "") for p in enc.place}


def test_best_fit():
    rng = random.Random(2)
    bins, load, sizes = packing.BestFit(100, 8), Counter(), [rng.randint(1, 99) for _ in range(2000)]
    for n in sizes:
        b, at = bins.put(n)
        assert at == load[b]
        load[b] += n
        assert load[b] <= 100
        assert bins.n_open <= 8
    assert len(load) < 1.12 * sum(sizes) / 100


def test_packing(docs, tokenizer, spark):
    rows = packing.best_fit(docs).collect()
    texts = texts_of(docs)
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(texts)
    for i, parts in by_doc.items():
        ids = np.array(tokenizer.encode(texts[i] or "", add_special_tokens=False).ids + [0], "<u4")
        parts.sort(key=lambda r: r["piece"])
        assert [r["piece"] for r in parts] == list(range(len(parts))) == list(range(-(-len(ids) // 2048)))
        for r in parts:
            own = ids[r["start"] : r["start"] + r["length"]]
            assert len(own) == r["length"] and zlib.crc32(own.tobytes()) == r["ids_crc32"]
    for parts in by_seq.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
    assert packing.best_fit(empty(spark)).count() == 0


# -- 4, 10 --------------------------------------------------------------------------------


def test_language(spark):
    rng = random.Random(3)
    rows = [(i, prose("en" if i % 3 else "fr", rng.randint(3, 60), rng), "en" if i % 3 else "fr", "s") for i in range(400)]
    rows += [(1000, None, "en", "s"), (1001, "12 34 !!", "en", "s"), (1002, "", None, "s")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").withColumns({c: F.lit(1) for c in ("at", "run", "score", "held_out", "lang_pred", "other")})
    dictionaries = langid.train(docs)
    got = {r["doc_id"]: r for r in langid.identify(docs, dictionaries).collect()}
    assert len(got) == len(rows)
    # The classes' sizes, by compressors of their own and without a first look.
    for i, text, _, _ in rows[:400]:
        sizes = {}
        for lang in sorted(dictionaries):
            d = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=langid.CLOSE_LEVEL)
            c = zstandard.ZstdCompressor(dict_data=d, level=langid.CLOSE_LEVEL, write_checksum=False, write_content_size=False, write_dict_id=False)
            sizes[lang] = len(c.compress(langid.normal(text) + langid.ZEROS))
        best, second = sorted(sizes.values())
        assert got[i]["rejected"] == (got[i]["score"] < langid.MARGIN)
        if second - best > 0.02 * second:
            assert got[i]["lang_pred"] == min(sizes, key=sizes.get)
    assert set(dictionaries) == {"en", "fr"} and all(len(d) <= langid.DICTIONARY for d in dictionaries.values())
    held = [r for r in rows if r[0] < 1000 and zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert all(got[r[0]]["held_out"] for r in held)
    assert np.mean([got[r[0]]["lang_pred"] == r[2] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert {got[i]["lang_pred"] for i in (1000, 1001, 1002)} == {"und"}
    kept = langid.filter_language(docs, langid.train(docs))
    assert kept.columns == docs.columns and kept.filter("doc_id < 1000").count() > 390
    assert langid.identify(empty(spark), langid.train(empty(spark))).count() == 0


def test_toxicity(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(600):
        bad = i % 5 == 0
        w = prose("en", rng.randint(10, 60), rng).split()
        if bad:
            for _ in range(3):
                w[rng.randrange(len(w))] = rng.choice(["vile1", "vile2", "grossest"])
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(bad)))
    rows += [(900, None), (901, ""), (0, rows[0][1])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({c: F.lit(1) for c in ("y", "f", "toxic", "score", "held_out")})
    marks = spark.createDataFrame(labels + [(1, 1, None), (5, 0, 1)], "doc_id bigint, quality int, toxic int")
    got = toxicity.score(docs, toxicity.train(docs, marks)).collect()
    assert len(got) == len(rows)
    truth = {i: t for i, _, t in labels}
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    none = toxicity.train(docs, marks.limit(0))
    assert none[2] == 0 and toxicity.score(docs.limit(0), none).count() == 0


def test_ftrl_is_that_of_single_coordinates():
    rng = random.Random(3)
    rows = [(sorted(rng.sample(range(30), rng.randint(0, 9))), rng.randint(0, 1)) for _ in range(300)]
    model = toxicity.Ftrl(30)
    z, n, a, b, l1, l2 = [0.0] * 31, [0.0] * 31, toxicity.ALPHA, toxicity.BETA, toxicity.L1, toxicity.L2

    def weight(i):
        cut = l1 if i < 30 else 0.0  # the bias, number 30, has no L1
        return 0.0 if i < 30 and abs(z[i]) <= cut else -(z[i] - math.copysign(cut, z[i])) / ((b + math.sqrt(n[i])) / a + l2)

    for f, y in rows:
        model.learn(np.array(f, np.int64), y)
        w = {i: weight(i) for i in [*f, 30]}
        g = 1 / (1 + math.exp(-sum(w.values()))) - y
        for i, x in w.items():
            z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / a * x
            n[i] += g * g
    assert np.allclose(model.weights(slice(None)), [weight(i) for i in range(30)]) and model.bias == pytest.approx(weight(30))
    assert np.count_nonzero(model.weights(slice(None))) < 30


def test_features_of_a_text():
    f, at = toxicity.features(pa.array(["One two, one", None, "two"]))
    assert list(np.diff(at)) == [len({*"one two".split(), "one two", "two one", "one * one"}), 0, 1]
    assert set(f[at[2] : at[3]]) < set(f[at[0] : at[1]])


# -- 2 ------------------------------------------------------------------------------------


def test_language_model(docs):
    got = {r["doc_id"]: r for r in lm.score(docs).collect()}
    texts = texts_of(docs)
    counts, held = Counter(), {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    for i, t in texts.items():
        if not held[i]:
            counts.update([*words(t), None])
    total, distinct = sum(counts.values()), len(counts)
    for i, t in texts.items():
        own = [*words(t), None]
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held[i], len(own), total)
        assert r["n_known"] == sum(counts[w] > 0 for w in own)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in own), rel=1e-9)
        assert r["score"] < 0 and math.isfinite(r["score"])


def test_language_model_of_odd_tables(spark):
    assert lm.score(empty(spark)).count() == 0
    rows = [(1, "a b c"), (1, "c b a a"), (1, "a b c"), (None, "a b c"), (2, None), (7, "zz")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({c: F.lit(1) for c in ("h", "x", "of", "score", "slot")})
    got = lm.score(docs).collect()
    assert len(got) == len(rows)
    by = {(r["doc_id"], r["n_tokens"], round(r["score"], 9)) for r in got}
    assert len(by) == 5  # rows with the same text and id are alike, others of one id are not
    assert len({round(r["score"], 9) for r in got if r["n_tokens"] == 4}) == 1


def test_attention_helps_on_held_out_text(data, tokenizer):
    texts = [np.array(tokenizer.encode(t or "", add_special_tokens=False).ids, np.int64) for t in pq.read_table(f"{data}/documents.parquet")["text"].to_pylist()]
    train, held = texts[: len(texts) * 4 // 5], texts[len(texts) * 4 // 5 :]
    counts = np.bincount(np.concatenate(train), minlength=lm.VOCAB)
    counts[lm.END] += len(train)
    active = lm.active_ids(counts)
    pairs = np.zeros((lm.ACTIVE + 1) ** 2, np.int64)
    for t in train:
        x, y, _ = lm.sequences(t, np.array([0, len(t)]))
        np.add.at(pairs, active[x] * (lm.ACTIVE + 1) + active[y], 1)
    word_end = np.array([(tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(lm.VOCAB)])
    model, p = lm.fit(train, counts, pairs, word_end)
    at = np.concatenate([[0], np.cumsum([len(t) for t in held])])
    n = at[-1] + len(held)
    whole = lm.score_ids(model, p, np.concatenate(held), at).sum() / n
    x, y, _ = lm.sequences(np.concatenate(held), at)
    alone = (p.logs[p.active[x] * (lm.ACTIVE + 1) + p.active[y]].astype(float) + p.part[y]).sum() / n / np.log(10)
    assert whole > alone + 0.02


def test_memory_of_spans(spark, tokenizer):
    rng = random.Random(14)
    passages = [prose("en", 150, rng) for _ in range(6)]
    rows = [(i, " ".join([prose("en", 40, rng), *rng.sample(passages, rng.randint(0, 3)), prose("en", 30, rng)])) for i in range(60)] + [(100, None), (101, "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    train = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 7 != 2}
    pairs, every = Counter(), {}
    for i, t in rows:
        y = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, lm.END], np.int64)
        start, span, _ = lm.spans_of(y, np.array([0, len(y)]))
        every[i] = y, span.tolist()
        if i in train:
            pairs.update(zip(span[:-1].tolist(), span[1:].tolist(), strict=True))
    # Spans do not depend on what stands around a text, and a passage has the same ones anywhere.
    flat = np.concatenate([y for y, _ in every.values()])
    start, span, text = lm.spans_of(flat, np.concatenate([[0], np.cumsum([len(y) for y, _ in every.values()])]))
    assert span.tolist() == [h for _, own in every.values() for h in own] and max(pairs.values()) > 3
    followed = {}
    for (b, a), n in pairs.items():
        followed.setdefault(b, {})[a] = n
    held = docs.select("doc_id", F.xxhash64("text").alias("h"), (F.crc32(F.col("doc_id").cast("string")) % 7 == 2).alias("held_out"), "text")
    got = [lm.np.frombuffer(r[c], t).tolist() for r in lm._memory(lm.save(lm._survey(held, 3, None), "survey"), 3).collect() for c, t in (("befores", "<u8"), ("c", "<i8"), ("t", "<i8"), ("pair_before", "<u8"), ("pair_span", "<u8"), ("pair_n", "<i8"))]
    befores, c, t, pb, ps, pn = (np.array(sum(got[k::6], []), np.uint64 if k in (0, 3, 4) else np.int64) for k in range(6))
    assert {b: (x, y) for b, x, y in zip(befores.tolist(), c.tolist(), t.tolist(), strict=True)} == {b: (sum(f.values()), len(f)) for b, f in followed.items() if sum(f.values()) > len(f)}
    assert {(b, a): n for b, a, n in zip(pb.tolist(), ps.tolist(), pn.tolist(), strict=True)} == {k: n for k, n in pairs.items() if n > 1}
    order = np.argsort(befores)
    asked = np.zeros(4, lm._SPANS)
    (b, f) = max(((b, f) for b, f in followed.items() if len(f) > 1 and max(f.values()) > 1), key=lambda x: len(x[1]))
    seen = max(f, key=f.get)
    asked["before"], asked["span"] = [b, b, 5, b], [seen, 12345, seen, min(f, key=f.get)]
    asked["logp"] = [-90, -90, -90, -800]
    more = lm.remembered(asked, befores[order], c[order], t[order], pb, ps, pn)
    n, m = sum(f.values()), len(f)
    assert more[0] == pytest.approx(math.log10((f[seen] - 1) / n + m / n * 1e-90) + 90)
    assert more[1] == pytest.approx(math.log10(m / n)) and more[2] == 0 and np.isfinite(more).all()
    assert sum((x - 1) / n for x in f.values()) + m / n == pytest.approx(1)


def test_scores_tell_repeated_documents(spark):
    rng = random.Random(15)
    rows = [(i, prose("en", 300, rng)) for i in range(80)]
    rows += [(200 + i, rows[i][1]) for i in range(0, 40, 2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = {r["doc_id"]: r for r in lm.score(docs).collect()}
    held = lambda i: got[i]["held_out"]
    twice = [got[i]["score"] / got[i]["n_tokens"] for i in range(0, 40, 2) if not held(i) and not held(200 + i)]
    once = [got[i]["score"] / got[i]["n_tokens"] for i in range(41, 80)]
    assert len(twice) > 8 and min(twice) > max(once)


def test_attention_learns_from_every_training_document(spark, tokenizer, monkeypatch):
    rng = random.Random(16)
    rows = [(i, prose("en", rng.randint(0, 60), rng)) for i in range(90)] + [(None, "no id"), (100, None), (101, "x"), (101, "x")]
    held = spark.createDataFrame(rows, "doc_id bigint, text string").select("doc_id", F.xxhash64("text").alias("h"), (F.crc32(F.col("doc_id").cast("string")) % 7 == 2).alias("held_out"), "text")
    train = [np.array(tokenizer.encode(t or "", add_special_tokens=False).ids, np.int64) for i, t in rows if i is not None and zlib.crc32(str(i).encode()) % 7 != 2]
    x, y, to = lm.sequences(np.concatenate(train), np.concatenate([[0], np.cumsum([len(t) for t in train])]))
    counts = np.bincount(y, minlength=lm.VOCAB)
    active = lm.active_ids(counts)
    follow = np.bincount(active[x] * (lm.ACTIVE + 1) + active[y], minlength=(lm.ACTIVE + 1) ** 2)
    pairs = lm.Pairs(counts, active, follow, lm.classes_of(active, follow, np.zeros(lm.VOCAB, bool)), lm.CLASSES + 2)
    whole, ids = lm._train(lm.save(lm._survey(held.repartition(3), 3, None), "survey"), pairs, len(train))
    assert ids == lm.EPOCHS * len(y)
    # In rounds of several tasks each document is learned once, however the table is stored.
    monkeypatch.setattr(lm, "LOCAL_DOCS", 8)
    one, ids = lm._train(lm.save(lm._survey(held.repartition(3), 3, None), "survey"), pairs, len(train))
    other, again = lm._train(lm.save(lm._survey(held.repartition(5), 3, None), "survey"), pairs, len(train))
    assert ids == again == len(y)
    seen = np.unique(active[x])
    start = lm.Attention(lm.CLASSES + 2)
    for model in (whole, one):
        assert (model.p["e"][seen] != start.p["e"][seen]).any(axis=1).all()
    for k in one.p:
        assert np.allclose(one.p[k], other.p[k], atol=1e-5)


def test_a_corpus_of_many_tasks_is_learned_in_every_epoch(spark, tokenizer, monkeypatch):
    rng = random.Random(17)
    rows = [(i, prose("en", rng.randint(0, 30), rng)) for i in range(60)]
    size = sum(len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2)
    took, train = [], lm._train

    def noted(*args, **more):
        model, ids = train(*args, **more)
        took.append(ids)
        return model, ids

    monkeypatch.setattr(lm, "_train", noted)
    for most in (lm.LOCAL_DOCS, 8):
        monkeypatch.setattr(lm, "LOCAL_DOCS", most)
        assert lm.score(spark.createDataFrame(rows, "doc_id bigint, text string")).count() == len(rows)
    assert took == [lm.EPOCHS * size] * 2


def test_ids_of_one_task_are_not_thinned_by_the_others(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(lm, "LOCAL_DOCS", 1)
    monkeypatch.setattr(lm, "ROUNDS", (64,))
    rows = [(i, "the cat sat on the mat and the dog sat on the rug") for i in range(60)] + [(60, "a zebra jumps high over green hills " * 3)]
    assert zlib.crc32(b"60") % 7 != 2
    held = spark.createDataFrame(rows, "doc_id bigint, text string").select("doc_id", F.xxhash64("text").alias("h"), (F.crc32(F.col("doc_id").cast("string")) % 7 == 2).alias("held_out"), "text")
    train = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, np.int64) for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    x, y, to = lm.sequences(np.concatenate(train), np.concatenate([[0], np.cumsum([len(t) for t in train])]))
    counts = np.bincount(y, minlength=lm.VOCAB)
    active = lm.active_ids(counts)
    follow = np.bincount(active[x] * (lm.ACTIVE + 1) + active[y], minlength=(lm.ACTIVE + 1) ** 2)
    classes = np.arange(lm.VOCAB) % (lm.CLASSES + 2)
    pairs = lm.Pairs(counts, active, follow, classes, lm.CLASSES + 2)
    model, ids = lm._train(lm.save(lm._survey(held, 3, None), "survey"), pairs, len(train))
    assert ids == len(y)
    only = np.setdiff1d(active[train[-1]], active[np.concatenate(train[:-1])])
    change = np.abs(model.p["e"] - lm.Attention(lm.CLASSES + 2).p["e"])[only].max(axis=1)
    # A step of one task changes a weight by up to RATE; a mean over all tasks would leave 1 / 50 of it.
    assert len(only) > 3 and (change > lm.RATE / 5).all()


def test_large_attention_scores_stay_finite():
    model = lm.Attention(lm.CLASSES + 2)
    model.p = {k: v * np.float32(60) for k, v in model.p.items()}
    model.ready()
    x = np.random.default_rng(1).integers(0, lm.ACTIVE, (3, lm.WINDOW))
    assert np.isfinite(model.shifts(x, np.zeros((3, lm.STRIDE), np.int64), np.full((lm.ACTIVE + 1, lm.CLASSES + 2), 0.03, np.float32))).all()


def test_scores_that_cannot_overflow_need_no_maximum():
    model, rng = lm.Attention(lm.CLASSES + 2), np.random.default_rng(2)
    # Long rows that stand apart: no two ids have a score near the product of the greatest lengths.
    model.p["e"][:] = 0
    model.p["e"][:9, 0], model.p["e"][9:, 1:] = 20, rng.normal(0, 0.1, (lm.ACTIVE - 8, lm.WIDTH - 1))
    model.p["q"][:] = np.eye(lm.WIDTH)
    model.p["k"][:] = np.roll(np.eye(lm.WIDTH), 1, axis=0)
    model.p["v"] *= np.float32(0.1)
    model.ready()
    assert model.tables[-1]
    x, y = rng.integers(0, 30, (5, lm.WINDOW)), rng.integers(0, 32, (5, lm.STRIDE))
    by_class = rng.dirichlet(np.ones(32), lm.ACTIVE + 1).astype(np.float32)
    quick = model.shifts(x, y, by_class)
    model.tables = (*model.tables[:-1], False)
    assert np.allclose(quick, model.shifts(x, y, by_class), atol=1e-4)


def test_new_chunks_share_calls_and_keep_their_ids():
    import pyarrow as pa

    enc = bpe.Encoder(bpe.vocabulary())
    assert enc.word_ends is not None
    rng, handed = np.random.default_rng(3), []
    alphabet = [*"abzABZ09.,;'<|>/w-éßØ÷×ÿÀÃİıﬁ中²ª\u0301\x00\x1c\x7f\u0085ſ", "'s", "'LL", "</w>", "<|endoftext|>", "don't"]
    odd = ["".join(rng.choice(alphabet, rng.integers(1, 8))) for _ in range(3_000)]
    plain = ["".join(rng.choice([*"abcdeABZ09.,;-éßØÿÀ"], rng.integers(1, 9))) for _ in range(4_000)]
    chunks = sorted({*odd, *plain})
    rng.shuffle(chunks)
    whole = enc.tokenizer
    want = [e.ids for e in whole.encode_batch(chunks, add_special_tokens=False)]

    class Counted:
        def __getattr__(self, name):
            return getattr(whole, name)

        def encode_batch_fast(self, texts, **kw):
            handed.append(len(texts))
            return whole.encode_batch_fast(texts, **kw)

    enc.tokenizer = Counted()
    ids, at = enc.encode(pa.array(chunks))
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == want
    assert sum(handed) < len(chunks) * 0.6  # before: one text for each chunk
    # A tokenizer whose words aren't known is asked for each chunk.
    enc.word_ends = None
    enc._forget()
    again, _ = enc.encode(pa.array(chunks))
    assert again.tolist() == ids.tolist()


def test_a_step_follows_the_gradient_of_its_loss():
    rng = np.random.default_rng(5)
    n, c = 3, lm.CLASSES + 2
    x, y = rng.integers(0, 40, (n, lm.WINDOW)), rng.integers(0, c, (n, lm.STRIDE))
    ok = rng.random((n, lm.STRIDE)) < 0.8
    by_class = rng.dirichlet(np.ones(c), lm.ACTIVE + 1).astype(np.float32)
    model = lm.Attention(c)
    p = {k: v.astype(float) for k, v in model.p.items()}

    def loss(p):
        e = p["e"][x]
        q, k, v = e[:, lm.OVERLAP :] @ p["q"] / np.sqrt(lm.WIDTH), e @ p["k"], e @ p["v"]
        a = np.exp(q @ k.transpose(0, 2, 1) + p["d"][model.gap] + model.mask)
        u = (a / a.sum(axis=2, keepdims=True)) @ v @ p["o"] + p["b"]
        g = by_class[x[:, lm.OVERLAP :]] * np.exp(u)
        return -np.log(np.take_along_axis(g, y[..., None], 2)[..., 0] / g.sum(axis=2))[ok].mean()

    got = model.learn(x, y, ok, by_class, 0.1)
    assert got == pytest.approx(loss(p), rel=1e-4)
    for name, old in p.items():
        # Adagrad's first step tells the gradient, whose square it has added to what it began with.
        grad = np.sqrt(np.maximum(model.sq[name].astype(float) - 1e-3, 0)) * np.sign(old - model.p[name]) / 100
        places = [tuple(i) for i in np.argwhere(np.abs(grad) > 5e-4)]
        for at in [places[i] for i in rng.choice(len(places), min(8, len(places)), replace=False)]:
            up, down = ({k: v.copy() for k, v in p.items()} for _ in range(2))
            up[name][at] += 1e-5
            down[name][at] -= 1e-5
            assert grad[at] == pytest.approx((loss(up) - loss(down)) / 2e-5, rel=2e-2, abs=2e-5), (name, at)
    # What it learned is what it scores.
    model.ready()
    p = {k: v.astype(float) for k, v in model.p.items()}
    assert -(model.shifts(x, y, by_class) + np.log(by_class[x[:, lm.OVERLAP :], y]))[ok].mean() == pytest.approx(loss(p), rel=1e-4)


def test_windows_score_each_id_once():
    rng = np.random.default_rng(1)
    texts = [rng.integers(0, 50, n) for n in (0, 1, lm.STRIDE - 1, lm.STRIDE, 100)]
    counts = np.bincount(np.concatenate(texts), minlength=lm.VOCAB)
    counts[lm.END] = len(texts)
    active = lm.active_ids(counts)
    pairs = np.zeros((lm.ACTIVE + 1) ** 2)
    for t in texts:
        x, y, _ = lm.sequences(t, np.array([0, len(t)]))
        np.add.at(pairs, active[x] * (lm.ACTIVE + 1) + active[y], 1)
    model, p = lm.fit(texts, counts, pairs, np.zeros(lm.VOCAB, bool))
    at = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    together = lm.score_ids(model, p, np.concatenate(texts), at)
    alone = [lm.score_ids(model, p, t, np.array([0, len(t)]))[0] for t in texts]
    assert np.allclose(together, alone, rtol=1e-5)
    # One text's next-id chances sum to one: all ids that may follow a given beginning.
    ids = np.arange(lm.VOCAB)
    x = np.full((1, lm.WINDOW), p.active[lm.START])
    x[0, lm.OVERLAP + 1 :] = p.active[7]
    b = p.active[ids]
    shift = np.stack([model.shifts(x, np.full((1, lm.STRIDE), c), p.by_class)[0, 1] for c in range(lm.CLASSES + 2)])
    chance = np.exp(p.logs[p.active[7] * (lm.ACTIVE + 1) + b].astype(float) + p.part[ids] + shift[p.column_class[b]])
    assert chance.sum() == pytest.approx(1, abs=1e-3)


# -- 1, 7 ---------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(7)
    rows = []
    for i in range(700):
        rows.append((i, [float(x) for x in rng.normal(size=16)], "l"))
    for i in range(700, 760):  # a group of near copies, then exact ones
        rows.append((i, [float(np.float32(x + 0.02 * rng.normal())) for x in rows[5][1]], "l"))
    rows += [(760 + i, list(rows[6][1]), "m") for i in range(25)]
    rows += [(800, None, "l"), (801, [0.0] * 16, "l"), (802, [float("nan")] * 16, "l"), (803, [1.0] * 15 + [None], "l"), (804, [1.0, 2.0], "l"), (805, [2.0, 4.0], "l"), (806, [], "l")]
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label string").withColumns({"id": F.lit(1), "x": F.lit(2), "key": F.lit(3)}).repartition(3)


def usable(vectors):
    out = {}
    for r in vectors.collect():
        v = r["embedding"]
        if v and None not in v and np.isfinite(v).all() and np.any(v):
            out[r["vec_id"]] = np.array(v, float)
    return out


def test_near_vectors(vectors, spark):
    own = usable(vectors)
    links = {i: set() for i in own}
    for i, x in own.items():
        for j, y in own.items():
            if i != j and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.95:
                links[i].add(j)
    got = {r["vec_id"]: r for r in pivots.near_duplicates(vectors).collect()}
    assert len(got) == vectors.count()
    found = sum(r["n_links"] for r in got.values())
    assert all(got[i]["n_links"] <= len(links[i]) for i in own) and found >= 0.98 * sum(map(len, links.values()))
    assert got[700]["component_id"] == 5 and got[770]["component_id"] == 6 and not got[770]["kept"]
    assert all((got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True) for i in (800, 801, 802, 803, 806))
    assert got[805]["component_id"] == 804
    assert pivots.near_duplicates(vectors.limit(0)).count() == 0


def test_near_vectors_of_a_dense_group(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(6000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[:2000] = math.sqrt(0.97) * x[5999] + math.sqrt(0.03) * x[:2000]
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    links = (u @ u.T >= 0.95).sum(axis=1) - 1
    table = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id bigint, embedding array<double>").repartition(4)
    got = {r["vec_id"]: r for r in pivots.near_duplicates(table).collect()}
    assert [got[i]["n_links"] for i in range(6000)] == links.tolist()
    assert all(got[i]["component_id"] == 0 for i in np.flatnonzero(links) if i < 2000)


def test_near_vectors_through_a_pruning_index(spark):
    rng = np.random.default_rng(10)
    n = 20_000
    x = rng.normal(size=(n, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for i in range(0, 1200, 2):  # pairs, some of them in chains, of cosine 0.95 to 0.97
        c = rng.uniform(0.951, 0.97)
        other = rng.normal(size=64)
        other -= other @ x[i] * x[i]
        x[i + 1] = c * x[i] + math.sqrt(1 - c * c) * other / np.linalg.norm(other)
        if i % 10 == 0:
            x[i + 2] = x[i + 1]
    links = np.zeros(n, int)
    pairs = []
    for a in range(0, n, 2000):
        near = np.argwhere(x[a : a + 2000] @ x.T >= 0.95)
        pairs += [(a + p, q) for p, q in near.tolist() if a + p < q]
    for p, q in pairs:
        links[p] += 1
        links[q] += 1
    assert len(pairs) > 600
    # The index proposes a small part of all pairs.
    chosen, cover = pivots.chosen_pivots(x[:: n // (n // pivots.PER_PIVOT)], 0.95)
    near, owner, _, many = pivots.describe(x, chosen, pivots.NEAREST, cover, 0.95)
    lists = np.bincount(near[owner < 0].ravel(), minlength=len(chosen))
    kept = np.sort(lists[near[owner < 0]], axis=1)[:, : pivots.NEAREST - pivots.SHARED + 1]
    assert (kept.sum() + many.sum() * many.sum() / len(chosen)) / 2 < 0.2 * n * n / 2
    table = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id bigint, embedding array<double>").repartition(8)
    got = {r["vec_id"]: r for r in pivots.near_duplicates(table).collect()}
    found = sum(r["n_links"] for r in got.values())
    assert all(got[i]["n_links"] <= links[i] for i in range(n)) and found >= 0.99 * links.sum()


def test_repeated_vectors(spark):
    a, b, c = [1.0, 0.0, 0.0], [0.99, 0.01, 0.0], [0.0, 0.0, 1.0]
    rows = [(5, a), (5, a), (3, b), (9, a), (9, c), (2, c), (None, c), (4, [0.0, 1.0, 0.0])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in pivots.near_duplicates(table).collect()), key=str)
    assert got == sorted([(5, 2, 3, False), (5, 2, 3, False), (3, 2, 3, True), (9, 2, 3, False), (9, 1, 2, False), (2, 1, 2, True), (None, 1, 2, False), (4, 0, 4, True)], key=str)
    rows = [(20, a), (20, a), (20, c), (3, b), (3, [5.0, 0.0, 0.0]), (3, b), (7, c), (8, [0.0, 0.0, 0.5]), (None, a)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in kmtree.neighbours(table).orderBy("rank").collect()]
    assert got == [(20, 1, 3, 5.0), (20, 2, 7, 1.0), (20, 3, 8, 0.5)]


def test_neighbours(vectors):
    own = usable(vectors)
    got = {}
    for r in kmtree.neighbours(vectors).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    asked = [i for i in own if i % 20 == 0 and len(own[i]) == 16]
    assert set(got) == set(asked)
    hits = []
    for q in asked:
        best = sorted(((-(own[q] @ x), i) for i, x in own.items() if i != q and len(x) == 16))[:20]
        assert [r[0] for r in got[q]] == list(range(1, 21))
        assert all(s == pytest.approx(own[q] @ own[i]) for _, i, s in got[q])
        assert [(-s, i) for _, i, s in got[q]] == sorted((-s, i) for _, i, s in got[q])
        hits.append(len({i for _, i in best} & {i for _, i, _ in got[q]}) / 20)
    assert np.mean(hits) >= 0.9
    assert kmtree.recall(vectors, kmtree.neighbours(vectors), queries=1000) == pytest.approx(np.sum(np.array(hits)) / len(hits), abs=0.02)
    assert kmtree.neighbours(vectors.limit(0)).count() == 0


# -- 6, 8 ---------------------------------------------------------------------------------


def near_texts(rng, n=14):
    base = [prose("en", 12, rng) for _ in range(8)]
    out = []
    for _ in range(n):
        lines = []
        for b in rng.sample(base, 4):
            w = b.split()
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = prose("fr", 1, rng)
            lines.append(" ".join(w))
        out.append("\n".join(lines))
    return out


@pytest.mark.parametrize("tight", [False, True])
def test_line_dedup(docs, spark, tight, monkeypatch):
    opened = []
    if tight:  # few lines a block and one candidate carried, so that every way is taken
        monkeypatch.setattr(linededup, "BLOCK", 3)
        monkeypatch.setattr(linededup, "CARRIED", 0)
        ways = linededup._open_lists
        monkeypatch.setattr(linededup, "_open_lists", lambda p, rest: opened.append(rest.count()) or ways(p, rest))
    rng = random.Random(11)
    texts, base = near_texts(rng, 30), [f"base{k}" for k in range(300)]
    for i in range(30 * tight):  # long lines, not quite similar: their maps tell little
        w = list(base)
        for k in rng.sample(range(300), 43):
            w[k] = f"w{i}x{k}"
        texts.append(" ".join(w))
    texts += [t[: -len("rest of it")] + "changed" for t in texts[45:48]]
    more = spark.createDataFrame([(500 + i, t, "en", "s") for i, t in enumerate(texts)], "doc_id bigint, text string, lang string, source string")
    every = docs.select("doc_id", "text", "lang", "source").unionByName(more)
    lines = [(d, k, frozenset(words(x))) for d, t in sorted(texts_of(every).items()) for k, x in enumerate((t or "").split("\n"))]
    lines = [x for x in lines if x[2]]
    gone = {}
    for i, (d, k, s) in enumerate(lines):
        if any(9 * len(s & t) >= 4 * (len(s) + len(t)) for _, _, t in lines[:i]):
            gone.setdefault(d, []).append(k)
    got = {r["doc_id"]: r for r in linededup.removed_lines(every).collect()}
    assert {d: r["removed"] for d, r in got.items() if r["removed"]} == gone
    assert {d: r["n_lines"] for d, r in got.items()} == Counter(d for d, _, _ in lines)
    if tight:
        assert opened and opened[0] > 0
    else:
        kept = linededup.without_lines(docs, linededup.removed_lines(docs))
        assert kept.columns == docs.columns
        assert linededup.removed_lines(empty(spark)).count() == 0


def test_lines_of_repeated_rows(spark):
    a, b, c = "one two three four five", "six seven eight nine ten", "red green blue black white"
    rows = [(1, f"{a}\n{b}"), (2, a), (2, a), (3, c), (3, c), (4, f"{c}\n\nten nine eight seven six five"), (5, "zz yy xx"), (5, b), (6, None), (6, ""), (None, a), (7, "  ")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    removed = linededup.removed_lines(docs)
    got = {r["doc_id"]: (r["n_lines"], r["removed"]) for r in removed.collect()}
    assert got == {1: (2, []), 2: (1, [0]), 3: (1, []), 4: (2, [0, 2]), 5: (1, [0])}
    kept = sorted(((r["doc_id"], r["text"]) for r in linededup.without_lines(docs, removed).collect()), key=str)
    assert kept == sorted([(1, f"{a}\n{b}"), (3, c), (3, c), (6, None), (6, ""), (None, a), (7, "  ")], key=str)


def test_counts_of_words_are_exact():
    n = np.zeros(linededup.CHUNK, np.int64)
    n[[3, 9, 70]] = [1, 255, 3_000_000]
    sums = np.zeros(linededup.CHUNK, np.int64)
    for _ in range(40):
        linededup._add_counts(sums, linededup._packed_counts(n))
    assert (sums == 40 * n).all()
    assert (linededup.most_of(linededup.rarity_of(sums)) >= sums).all() and linededup.rarity_of(np.array([1]))[0] == linededup.SCALE


def test_line_candidates_beyond_those_carried():
    rng = np.random.default_rng(3)
    sets = [rng.choice(60, 20, replace=False) for _ in range(60)]
    rows = [(t, d, len(s)) for d, s in enumerate(sets) for t in s]
    n = len(rows)
    col = {"token": np.array([r[0] for r in rows], np.uint64), "doc": np.array([r[1] for r in rows]), "line": np.zeros(n, np.int64), "size": np.full(n, 20), "pos": np.zeros(n, np.int64), "open": np.ones(n, bool)}
    col |= {f"b{k}": np.zeros(n, np.uint64) for k in range(linededup.MAP_WORDS)} | {c: np.zeros(n, np.int64) for c in ("i", "j", "block")}
    few, every = (pa.Table.from_batches(list(linededup.candidates(dict(col), k))) for k in (2, None))
    assert all(len(x) <= 3 for x in few["xdoc"].to_pylist()) and any(few["more"].to_pylist())
    assert not any(every["more"].to_pylist())
    share = {d: sorted(e for e in range(d) if set(sets[d]) & set(sets[e])) for d in range(60)}
    assert {d: sorted(x) for d, x in zip(every["doc"].to_pylist(), every["xdoc"].to_pylist(), strict=True)} == {d: x for d, x in share.items() if x}
    assert all(x[0] == share[d][0] for d, x in zip(few["doc"].to_pylist(), few["xdoc"].to_pylist(), strict=True))


@pytest.mark.parametrize("pairs", [1, 40, 1 << 19])
def test_line_candidates_let_go_between_batches(pairs, monkeypatch):
    monkeypatch.setattr(linededup, "PAIRS", pairs)
    n = 100  # equal lines of one list: each is a candidate of all that follow
    col = {"token": np.zeros(n, np.uint64), "doc": np.arange(n), "line": np.zeros(n, np.int64), "size": np.full(n, 20), "pos": np.zeros(n, np.int64), "open": np.ones(n, bool)}
    col |= {f"b{k}": np.zeros(n, np.uint64) for k in range(linededup.MAP_WORDS)} | {c: np.zeros(n, np.int64) for c in ("i", "j", "block")}
    monkeypatch.setattr(linededup, "HELD", 30)
    every = pa.Table.from_batches(list(linededup.candidates(dict(col), None)))
    assert sum(map(len, every["xdoc"].to_pylist())) == n * (n - 1) // 2 and (every.num_rows > n - 1) == (pairs < 1 << 19)
    got = pa.Table.from_batches(list(linededup.candidates(col, 5)))
    assert got["doc"].to_pylist() == list(range(1, n))
    assert [len(x) for x in got["xdoc"].to_pylist()] == [min(d, 6) for d in range(1, n)]
    assert got["more"].to_pylist() == [d > 6 for d in range(1, n)]


@pytest.mark.parametrize("percent", [85, 80])
def test_near_documents(docs, spark, percent, monkeypatch):
    if percent == 80:  # every larger bucket and component counts as hot
        monkeypatch.setattr(common, "HOT_LEAST", 2)
        monkeypatch.setattr(common, "HOT_PART", 1000)
    rng = random.Random(12)
    rows, base = [], prose("en", 150, rng).split()
    for i in range(40):
        w = list(base)
        for _ in range(i % 5):
            w[rng.randrange(len(w))] = prose("fr", 1, rng)
        rows.append((700 + i, " ".join(w), "en", "s"))
    every = docs.select("doc_id", "text", "lang", "source").unionByName(spark.createDataFrame(rows, docs.select("doc_id", "text", "lang", "source").schema))
    sets = {}
    for i, t in texts_of(every).items():
        w = words(t)
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    got = {r["doc_id"]: r for r in minhash.near_duplicates(every, percent).collect()}
    assert {i: (r["n_shingles"], r["component_id"], r["kept"]) for i, r in got.items()} == {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}


def test_near_documents_of_repeated_ids(spark):
    rng = random.Random(16)
    a, b, c = (prose("en", 60, rng) for _ in range(3))
    rows = [(1, a), (1, b), (1, a), (2, a + " end"), (3, b + " end"), (4, c), (None, a), (None, None)]
    got = sorted(((r["doc_id"], r["component_id"], r["kept"], r["n_shingles"]) for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()), key=str)
    assert got == sorted([(1, 1, True, 56), (1, 1, True, 56), (1, 1, True, 56), (2, 1, False, 57), (3, 1, False, 57), (4, 4, True, 56), (None, 1, False, 56), (None, None, False, 0)], key=str)


def test_no_near_documents(spark):
    assert minhash.near_duplicates(empty(spark)).count() == 0


@pytest.mark.parametrize("least", [1000, 2])
def test_components(spark, least, monkeypatch):
    monkeypatch.setattr(common, "HOT_LEAST", least)
    rng = random.Random(6)
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 130)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)]
    root = {x: x for e in edges for x in e}
    for _ in range(len(root)):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = {r["id"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: c for x, c in root.items() if x in got} and all(root[x] == x for x in root if x not in got)


# -- 9 ------------------------------------------------------------------------------------

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base_spans(text):
    def luhn(d):
        return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0

    def good(kind, m):
        d = re.sub("[^0-9]", "", m)
        return {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.split(".")), "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]

    out = [(m.start(), n, m.end(), k) for n, (k, p) in enumerate(BASE.items()) for m in re.finditer(p, text) if good(k, m.group())]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


def test_personal_data(spark):
    rng = random.Random(8)
    bits = ["a", "@", "b.c", ".", "+1", "9", " ", "-", "12", "345", "4111 1111 1111 1111", "1.2.3.4", "256", "é", "😀", "_", "(555)", "x@y.z", "0", "\n", "+49 (0)30 123456", "4111111111111111", "me at foo dot com", "(415) 555-1234", "@@", ".."]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 25))), 1) for i in range(600)]
    rows += [(900, None, 1), (901, "", 1), (902, "a" * 50_000 + " " + "1" * 50_000, 1), (903, "x@y.com " * 500, 1), (904, "x a@b.co +1 (269) 555-3296 4524132264652876 and", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _spans int").unionAll(spark.createDataFrame([rows[0]], "doc_id bigint, text string, _spans int"))
    got = pii.detect(docs).collect()
    assert len(got) == len(rows) + 1
    texts = {r[0]: r[1] for r in rows}
    for r in got:
        text = texts[r["doc_id"]] or ""
        want = base_spans(text) if len(text) < 50_000 else ""
        assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest(), texts[r["doc_id"]]
        assert set(filter(None, want.split(","))) <= set(r["spans"].split(","))
        assert [r[f"n_{k}"] for k in BASE] == [sum(s.startswith(k) for s in want.split(",")) for k in BASE]
    usual = [(i, f"word x{i}@mail8.example.com ing +1 (45{i % 10}) 555-21{i % 90 + 10} thn 4111111111111111 a") for i in range(60)] + [(904, rows[-1][1])]
    more = {r["doc_id"]: r["spans"] for r in pii.detect(spark.createDataFrame(usual, "doc_id bigint, text string")).collect()}
    assert more[904] == "email:2:8,phone:9:26,card:27:43"
    red = {r["doc_id"]: r for r in pii.redact(docs).collect()}
    assert red[900]["text"] is None and red[903]["text"] == "[EMAIL] " * 500 and red[5]["_spans"] == 1
    assert pii.detect(docs.limit(0)).count() == 0


def test_added_spans_are_wider_candidates(spark, data):
    wide = {"email": [pii.SPELT_EMAIL], "phone": [pii.PLAIN_PHONE, pii.FULL_PHONE], "card": [pii.SOLID_CARD, r"[0-9](?:[\x20-]?[0-9])+"], "ip": []}
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()}
    texts |= {10_000 + i: f"mail to: joe{i} (at) host{i}.example (dot) com or call (41{i % 10}) 555-01{i % 90 + 10} now" for i in range(40)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    added = 0
    for r in pii.detect(docs).collect():
        text, every = texts[r["doc_id"]], [x.split(":") for x in r["spans"].split(",") if x]
        base = {tuple(x.split(":")) for x in base_spans(text).split(",") if x}
        order = [(int(a), int(b)) for _, a, b in every]
        assert base <= {tuple(x) for x in every} and order == sorted(order, key=lambda x: x[0])
        for kind, a, b in every:
            if (kind, a, b) not in base:
                added += 1
                assert any(m.span() == (int(a), int(b)) for p in wide[kind] for m in re.finditer(p, text)), (kind, text[int(a) : int(b)])
                assert not any(int(a) < int(y) and int(x) < int(b) for _, x, y in base)
    assert added > 20


def test_estimate_trusts_agreeing_labelers():
    post = pii.estimate([(0, 1, 1, 1, 1, 1, 0, 500), (0, -1, -1, -1, 0, -1, 0, 400), (0, -1, 1, 1, 1, 1, 0, 30)])
    assert post[(0, 1, 1, 1, 1, 1)] > 0.9 and post[(0, -1, -1, -1, 0, -1)] < 0.1 and post[(0, -1, 1, 1, 1, 1)] > 0.5
