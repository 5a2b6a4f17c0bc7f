"""Language identification by compression (operator 4).

For each language a raw-content zstandard dictionary is made from a bounded sample of its
training documents: about ``SAMPLE_DOCS`` whole texts, whose distinct runs of words (a line, or
``RUN`` words of it) fill a dictionary of ``DICTIONARY`` bytes in the order of a hash, so that
all parts of all texts have the same chance; runs that two languages share are left out.  The
runs are sorted out on the executors.  A text is compressed with every dictionary; the language whose dictionary
leaves the fewest bytes is chosen.  ``score`` is the margin: the share of the second-best
size that the best saves (0 to 1).  A text is *rejected* when that margin is narrow, or when
there is nothing to go by.

Texts are folded first (lower case; ASCII characters other than letters become spaces; a
word repeated at once is taken once), and
compressed whole, in blocks of ``BLOCK`` bytes that each start from the dictionary, so
that a long text weighs all its parts alike.  Where the margin is below ``CLOSE`` a second
look decides: a higher level, and a run of zeros after each block, without which the
compressor would store short texts as they are.  A text is narrow if its second look is
within ``MARGIN``.

Null texts and texts without a letter: ``und``, score 0, rejected.  Without any training
language every text is ``und``.  Ties go to the language that sorts first.  Repeated rows
each have a result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, drop, fold, hold, save, steps, table

#: Training sample: documents of each language (about), all of them whole.
SAMPLE_DOCS = 600
#: Words of a run at most, and bytes of a language's dictionary.
RUN, DICTIONARY = 64, 224 << 10
LEVEL = 3
BLOCK = 64 << 10
#: Margins below this get a second look, with this level and so many zeros; second looks
#: below the other are narrow.  It stands where learned languages leave off: see the README.
CLOSE, CLOSE_LEVEL, ZEROS = 0.03, 9, bytes(4096)
MARGIN = 0.01

_LETTER = re.compile(r"[^\W\d_]")
_ASCII = bytes(c if c >= 128 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def normal(text: str) -> bytes:
    """The folded text; a word that is repeated at once counts once."""
    words = text.lower().encode("utf-8", "replace").translate(_ASCII).split()
    return b" ".join([w for w, _ in groupby(words)])


def runs(text: str) -> Iterator[bytes]:
    """The folded lines that have a letter, cut into runs of RUN words."""
    for line in text.split("\n"):
        if _LETTER.search(line):
            words = normal(line).split(b" ")
            for i in range(0, len(words), RUN):
                if run := b" ".join(words[i : i + RUN]):
                    yield run


def train(docs: DataFrame, test_mod: int = 5, sample_docs: int = SAMPLE_DOCS, size: int = DICTIONARY) -> dict[str, bytes]:
    """Dictionaries by language, of ``size`` bytes at most, from documents outside fold 0."""
    usable = docs.filter((fold("doc_id", test_mod) != 0) & F.col("lang").isNotNull())
    counts = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return {}
    # A document's place in its language's sample depends on its id alone.
    at = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 30))
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1 << 30, int((1 << 30) * sample_docs / n) + 1))])
    sample = usable.filter(F.col("text").isNotNull() & (at < share[F.col("lang")])).select("lang", "text")
    bounded_batches(docs.sparkSession)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches, "text"):
            rows = [(lang, r) for lang, t in zip(step.column("lang").to_pylist(), step.column("text").to_pylist(), strict=True) for r in set(runs(t))]
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in rows], pa.string()), pa.array([r for _, r in rows], pa.binary())], names=["lang", "run"])

    # A run that several languages have says nothing about any of them.
    own = save(sample.mapInArrow(split, "lang string, run binary").groupBy("run").agg(F.min("lang").alias("lang"), F.max("lang").alias("other")).filter("lang = other").select("lang", "run", F.pmod(F.xxhash64("run"), F.lit(1 << 30)).alias("at")), "runs")
    whole = {r["lang"]: r["n"] for r in own.groupBy("lang").agg(F.sum(F.length("run") + 1).alias("n")).collect()}
    out = {}
    for lang in sorted(whole):
        # Somewhat more than fills the dictionary.
        bound = min(1 << 30, int((1 << 30) * (1.1 * size + (64 << 10)) / whole[lang]) + 1)
        kept, total = [], 0
        for r in own.filter((F.col("lang") == lang) & (F.col("at") < bound)).select("run", "at").orderBy("at", "run").collect():
            if total + len(r["run"]) < size:
                kept.append(bytes(r["run"]))
                total += len(r["run"]) + 1
        if kept:
            out[lang] = b" ".join(kept)
    drop(own)
    return out


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes], level: int = LEVEL) -> None:
        self.langs = sorted(dictionaries)
        self.dictionaries = dictionaries
        self.compressors = self._compressors(level)
        self.close: list = []

    def _compressors(self, level: int) -> list:
        import zstandard as z

        out = []
        for lang in self.langs:
            d = z.ZstdCompressionDict(self.dictionaries[lang], dict_type=z.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            out.append(z.ZstdCompressor(dict_data=d, level=level, write_checksum=False, write_content_size=False, write_dict_id=False))
        return out

    def sizes(self, text: str, close: bool = False) -> list[int]:
        b = normal(text)
        blocks = [b[i : i + BLOCK] for i in range(0, len(b), BLOCK)]
        if close:
            self.close = self.close or self._compressors(CLOSE_LEVEL)
            return [sum(len(c.compress(x + ZEROS)) for x in blocks) for c in self.close]
        return [sum(len(c.compress(x)) for x in blocks) for c in self.compressors]

    def _best(self, sizes: list[int]) -> tuple[str, float]:
        best, second = sorted(sizes)[:2]
        return self.langs[sizes.index(best)], (second - best) / max(second, 1)

    def classify(self, text: str | None, margin: float = MARGIN) -> tuple[str, float, bool]:
        if not self.langs or text is None or not _LETTER.search(text):
            return "und", 0.0, True
        if len(self.langs) == 1:
            return self.langs[0], 1.0, False
        lang, score = self._best(self.sizes(text))
        if score < CLOSE:
            lang, score = self._best(self.sizes(text, close=True))
            return lang, score, score < margin
        return lang, score, False


_CLASSIFIERS: dict[int, Classifier] = {}


def _classifier(dictionaries: dict[str, bytes]) -> Classifier:
    key = hash(tuple(sorted(dictionaries.items())))
    if key not in _CLASSIFIERS:
        _CLASSIFIERS.clear()
        _CLASSIFIERS[key] = Classifier(dictionaries)
    hold("language", _CLASSIFIERS.clear)
    return _CLASSIFIERS[key]


def identify(docs: DataFrame, dictionaries: dict[str, bytes], margin: float = MARGIN, test_mod: int = 5) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected of each row.  One scan, no shuffle."""
    sent = docs.sparkSession.sparkContext.broadcast(dictionaries)
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _classifier(sent.value)
        for step in steps(batches, "text", owner="language"):
            rows = [model.classify(t, margin) for t in step.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [step.column("doc_id"), step.column("held_out"), pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.float64()), pa.array([r[2] for r in rows], pa.bool_())],
                names=["doc_id", "held_out", "lang_pred", "score", "rejected"],
            )

    rows = docs.select("doc_id", F.coalesce(fold("doc_id", test_mod) == 0, F.lit(False)).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double, rejected boolean")


def filter_language(docs: DataFrame, dictionaries: dict[str, bytes], margin: float = MARGIN) -> DataFrame:
    """The rows that are not rejected, with all their columns."""
    sent = docs.sparkSession.sparkContext.broadcast(dictionaries)
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _classifier(sent.value)
        for step in steps(batches, "text", owner="language"):
            yield step.filter(pa.array([not model.classify(t, margin)[2] for t in step.column("text").to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, train(docs))
