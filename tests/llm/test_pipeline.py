import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline as cp
from genomill.llm import bpe, langid, pii
from genomill.llm.common import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_stages(spark, data):
    assert [n for n, _ in cp.STAGES] == ["language_id", "line_dedup", "near_dedup", "personal_data", "best_fit"]
    docs = table(spark, data, "documents")
    columns, before = docs.columns, docs.count()
    for name, stage in cp.STAGES[:-1]:
        docs = cp.save(stage(spark, docs, data), name)
        assert docs.columns == columns
        after = docs.count()
        assert 0 < after <= before
        before = after
    assert docs.filter(F.col("text").rlike(r"[a-z0-9]@mail[0-9]\.example")).count() == 0
    packed = cp.STAGES[-1][1](spark, docs, data)
    assert packed.select("doc_id").distinct().count() == before


def words(text):
    return WORD.findall(text.translate(str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})))


def without_repeats(rows):
    """Plain line removal: an earlier line, by (doc_id, number), that is similar enough."""
    seen, out = [], []
    for i, t in sorted(rows):
        kept, any_words = [], False
        for x in (t or "").split("\n"):
            s = set(words(x))
            any_words |= bool(s)
            if not s or not any(9 * len(s & e) >= 4 * (len(s) + len(e)) for e in seen):
                kept.append(x)
            if s:
                seen.append(s)
        left = "\n".join(kept)
        if not any_words or words(left):
            out.append((i, left if t is not None else None))
    return out


def without_copies(rows):
    """Plain near-duplicate removal: the smallest id of each component at 0.8."""
    sets = {}
    for i, t in rows:
        w = words(t or "")
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(i):
        return i if root[i] == i else find(root[i])

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return [(i, t) for i, t in rows if find(i) == i]


def test_run_is_that_of_plain_stages(spark, tmp_path):
    from tokenizers import Tokenizer

    rng = random.Random(21)
    syllables = {"en": "the ing er on at ed".split(), "fr": "eau ou le tion é re".split()}
    line = lambda lang, n: " ".join("".join(rng.choice(syllables[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))
    shared = [line("en", 12) for _ in range(3)]
    rows = []
    for i in range(90):
        lang = ("en", "fr")[i % 2]
        lines = [line(lang, rng.randint(8, 40)) for _ in range(rng.randint(1, 6))]
        if i % 4 == 0:
            lines.insert(rng.randint(0, len(lines)), rng.choice(shared))
        if i % 5 == 0:
            lines.append(f"write to me{i}@mail{i % 9}.example.com today")
        rows.append((i, "\n".join(lines), lang, "s", len(lines)))
    for i in (3, 8, 20):  # copies: whole, shuffled words of one line, one word changed
        w = rows[i][1].split(" ")
        w[-1] = "changed"
        rows += [(200 + i, rows[i][1], rows[i][2], "s", 1), (300 + i, " ".join(w).replace("\n", " "), rows[i][2], "s", 1)]
    rows += [(400, None, "en", "s", 0), (401, "", "en", "s", 0), (402, "1234 5678", None, "s", 0), (403, line("fr", 3000), "fr", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars int")
    docs.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))

    model = langid.Classifier(langid.train(docs))
    plain = [(i, t) for i, t, *_ in rows if not model.classify(t)[2]]
    assert len(plain) < len(rows)
    lines = without_repeats(plain)
    assert sum(len(t or "") for _, t in lines) < sum(len(t or "") for _, t in plain)
    kept = without_copies(lines)
    assert len(kept) < len(lines) < len(plain)
    clean = pii.redact(spark.createDataFrame(kept, "doc_id bigint, text string")).collect()
    assert any("[EMAIL]" in r["text"] for r in clean)
    tokenizer, want = Tokenizer.from_str(bpe.vocabulary().decode()), set()
    for r in clean:
        ids = np.array(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [0], "<u4")
        want |= {(r["doc_id"], k, s, len(ids[s : s + 2048]), zlib.crc32(ids[s : s + 2048].tobytes())) for k, s in enumerate(range(0, len(ids), 2048))}
    got = cp.run(spark, str(tmp_path)).collect()
    assert {(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got} == want and len(got) == len(want)
    load = {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == load.get(r["sequence_id"], 0)
        load[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(load.values()) <= 2048 and len(load) <= sum(r["length"] for r in got) / 2048 * 1.3 + 1


def test_run_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars int").write.parquet(str(tmp_path / "documents.parquet"))
    assert cp.run(spark, str(tmp_path)).count() == 0
