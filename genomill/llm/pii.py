"""Personal data by weak supervision (operator 9), in DataFrame functions only.

Base patterns (e-mail, IP, card, phone) give spans that always stay.  Wider patterns give
further candidates: written-out e-mail addresses, phone numbers without a plus, phone and
card numbers that other numbers follow at once, digit runs of card length that fail the
check digit.  Five labelers vote on every candidate:

* ``strict``   regex: it is a base span;
* ``valid``    form: check digit, octets, number of digits, letters in the name;
* ``gazette``  known top-level domain, card issuer, country or area code, public address;
* ``context``  words shortly before it that speak for its kind, or for a version or a title;
* ``alone``    it stands alone, not inside a longer token.

The vote patterns of all candidates are counted (at most 4 kinds x 3**5 rows come to the
driver).  Expectation-maximisation over these counts estimates each labeler's reliability
for each kind and every pattern's posterior; a logistic span classifier is then trained on
the posteriors, and is applied as an expression: it sees the votes and the candidate's
length.  Candidates it accepts, that overlap no base span, are added.

Offsets are code points, found from the lengths of the pieces between matches.  The
patterns are written so that their matches and their order are those of the plain ones, but
no long run of characters is tried from each of its places.  Null texts count as empty.
Repeated rows give repeated results.  With no candidates at all nothing is added.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import save, table

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("strict", "valid", "gazette", "context", "alone")
#: Base patterns.  A match starts where the last one ended or where a run begins.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Wider candidates.
SPELT_EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?(?:\(at\)|\[at\]|\x20at\x20)\x20?[A-Za-z0-9-]{1,63}+(?:\x20?(?:\(dot\)|\[dot\]|\x20dot\x20)\x20?[A-Za-z0-9-]{1,63}+)++"
PLAIN_PHONE = r"(?<![0-9+(.-])(?<![0-9+]\x20)(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[.\x20-][0-9]{4}(?![0-9.-])"
FULL_PHONE = r"(?<![0-9])\+[0-9]{1,3}[\x20.-]?\(?[0-9]{2,4}\)?[\x20.-]?[0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9])"
SOLID_CARD = r"(?<![0-9])[0-9]{13,19}(?![0-9])"
#: Gazetteers.
TLDS = "com org net edu gov mil int info biz io co ai app dev me tv us uk de fr es it nl be ch at pt pl se no dk fi ie eu ca au nz jp cn in br mx ru".split()
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|3[068]|6011|65|64[4-9]|35|62)"
COUNTRIES = r"^(?:1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|2[1-689][0-9]|3[578][0-9]|42[013]|5[09][0-9]|6[789][0-9]|8[058][0-9]|9[679][0-9])"
RESERVED = r"^(?:0|10|127|255|22[4-9]|23[0-9])\.|^192\.168\.|^169\.254\."
#: Words before a candidate, by kind; and words that speak against any.
BEFORE = {"email": r"(?i)mail|contact|write|kontakt|correo|courriel", "ip": r"(?i)\bip\b|host|server|address|adres", "card": r"(?i)card|visa|master|amex|credit|karte|tarjeta|carte", "phone": r"(?i)tel|phone|call|fax|mobil|cell|anruf|llam|appel"}
AGAINST = r"(?i)(?:version|release|chapter|section|isbn|issn|licen[cs]e|\bno\.|\bv)\W*$"
AROUND = 40
EM_ROUNDS, FIT_ROUNDS, ACCEPT = 50, 400, 0.9


def _found(text: Column, pattern: str, guard: Column) -> Column:
    """array<struct<a, b, m>> of the pattern's matches, leftmost first; none without guard."""
    pieces = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda s, m: F.struct(F.char_length(s).alias("s"), m.alias("m")))
    empty = F.array().cast("array<struct<a:int,b:int,m:string>>")

    def step(acc: Column, x: Column) -> Column:
        a = acc["at"] + x["s"]
        b = a + F.char_length(x["m"])
        more = F.struct(b.alias("at"), F.concat(acc["out"], F.array(F.struct(a.alias("a"), b.alias("b"), x["m"].alias("m")))).alias("out"))
        return F.when(x["m"].isNull(), acc).otherwise(more)

    return F.when(guard, F.aggregate(pieces, F.struct(F.lit(0).alias("at"), empty.alias("out")), step, lambda acc: acc["out"])).otherwise(empty)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(m: Column) -> Column:
    d = F.reverse(_digits(m))

    def digit(i: Column) -> Column:
        x = F.substring(d, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return F.when(x > 9, x - 9).otherwise(x)

    total = F.aggregate(F.sequence(F.lit(1), F.char_length(d)), F.lit(0), lambda acc, i: acc + digit(i))
    return (F.char_length(d) > 0) & (total % 10 == 0)


def _octets(m: Column) -> Column:
    def small(part: Column) -> Column:
        bare = F.regexp_replace(part, "^0+(?=[0-9])", "")
        return (F.char_length(bare) <= 3) & (bare.cast("int") <= 255)

    return F.forall(F.split(m, r"\."), small)


def _vote(yes: Column, no: Column | None = None) -> Column:
    """1, -1 or 0 (abstains); without ``no`` it is against where it is not for."""
    yes = F.coalesce(yes, F.lit(False))
    return F.when(yes, 1).when(F.coalesce(no, F.lit(False)) if no is not None else F.lit(True), -1).otherwise(0)


def _judged(text: Column, kind: str, spans: Column) -> Column:
    """Adds the kind's number and the labelers' votes to its spans."""

    def judge(x: Column) -> Column:
        m = x["m"]
        n = F.char_length(_digits(m))
        if kind == "email":
            valid, known = m.rlike("^[A-Za-z0-9]") & m.rlike("[A-Za-z]"), F.lower(F.regexp_extract(m, r"([A-Za-z]+)$", 1)).isin(TLDS)
        elif kind == "ip":
            valid, known = _octets(m), ~m.rlike(RESERVED)
        elif kind == "card":
            valid, known = _luhn(m), _digits(m).rlike(ISSUERS)
        else:
            valid, known = n.between(9, 15), F.when(m.startswith("+"), _digits(m).rlike(COUNTRIES)).otherwise(m.rlike(r"^\(?[2-9]"))
        before = F.substring(text, F.greatest(x["a"] - AROUND + 1, F.lit(1)), F.least(x["a"], F.lit(AROUND)))
        near = F.concat(F.substring(text, F.greatest(x["a"], F.lit(1)), F.when(x["a"] > 0, 1).otherwise(0)), F.lit(" "), F.substring(text, x["b"] + 1, F.lit(1)))
        votes = {
            "strict": _vote(base_of(x)),
            "valid": _vote(valid),
            "gazette": _vote(known),
            "context": _vote(before.rlike(BEFORE[kind]), before.rlike(AGAINST)),
            "alone": _vote(~near.rlike(r"[A-Za-z0-9@_]")),
        }
        return F.struct(F.lit(KINDS.index(kind)).alias("kind"), x["a"].alias("a"), x["b"].alias("b"), base_of(x).alias("base"), *[v.cast("tinyint").alias(k) for k, v in votes.items()])

    def base_of(x: Column) -> Column:
        return F.coalesce(x["base"], F.lit(False))

    return F.transform(spans, judge)


def _marked(spans: Column, base) -> Column:  # noqa: ANN001 - a function of a match
    return F.transform(spans, lambda x: F.struct(x["a"], x["b"], x["m"], base(x["m"]).alias("base")))


def candidates(docs: DataFrame) -> DataFrame:
    """The rows with ``_spans``: judged candidates of the text, base ones first of each kind."""
    rows = docs.withColumn("_t", F.coalesce(F.col("text"), F.lit("")))
    t = F.col("_t")
    digits = t.rlike("[0-9][^0-9]?[0-9]")
    rows = rows.withColumns(
        {
            "_email": _marked(_found(t, EMAIL, F.instr(t, "@") > 0), lambda m: F.lit(True)),
            "_ip": _marked(_found(t, IP, digits & t.rlike(r"[0-9]\.[0-9]")), _octets),
            "_card": _marked(_found(t, CARD, digits), _luhn),
            "_phone": _marked(_found(t, PHONE, F.instr(t, "+") > 0), lambda m: F.char_length(_digits(m)).between(9, 15)),
        }
    )
    base = F.concat(*[F.filter(F.col(f"_{k}"), lambda x: x["base"]) for k in KINDS])
    wider = {"_email2": ("email", SPELT_EMAIL, t.rlike(r"\(dot\)|\[dot\]|\x20dot\x20")), "_phone2": ("phone", PLAIN_PHONE, digits & t.rlike(r"[0-9]{3}[.\x20-][0-9]{4}")), "_phone3": ("phone", FULL_PHONE, F.instr(t, "+") > 0), "_card2": ("card", SOLID_CARD, digits & t.rlike("[0-9]{13}"))}
    rows = rows.withColumn("_base", base)
    for name, (_, pattern, guard) in wider.items():
        clear = F.filter(_found(t, pattern, guard), lambda x: ~F.exists(F.col("_base"), lambda o: (o["a"] < x["b"]) & (x["a"] < o["b"])))
        rows = rows.withColumn(name, _marked(clear, lambda m: F.lit(False)))
    # What failed a base pattern is judged too, but for digit runs that a wider one splits.
    judged = F.concat(*[_judged(t, k, F.col(f"_{k}")) for k in KINDS], *[_judged(t, kind, F.col(name)) for name, (kind, _, _) in wider.items()])
    return rows.withColumn("_spans", judged).drop("_t", "_base", *[f"_{k}" for k in KINDS], *wider)


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-max(-35.0, min(35.0, x))))


def estimate(patterns: list[tuple]) -> dict[tuple, float]:
    """EM over ``(kind, *votes, length, count)`` rows: {(kind, *votes): probability}.  Each
    kind has a share of true candidates and, for each labeler, chances of its three votes
    for true and for false candidates."""
    out = {}
    for kind in sorted({p[0] for p in patterns}):
        counts: dict[tuple, float] = {}
        for p in patterns:
            if p[0] == kind:
                v = tuple(p[1 : 1 + len(LABELERS)])
                counts[v] = counts.get(v, 0) + p[-1]
        chance = [[{1: 0.7, 0: 0.2, -1: 0.1} for _ in LABELERS], [{1: 0.1, 0: 0.3, -1: 0.6} for _ in LABELERS]]
        share, post = 0.5, dict.fromkeys(counts, 0.5)
        for _ in range(EM_ROUNDS):
            for v in counts:
                t, f = (math.log(s) + sum(math.log(c[x]) for c, x in zip(chance[i], v, strict=True)) for i, s in ((0, share), (1, 1 - share)))
                post[v] = _sigmoid(t - f)
            total, true = sum(counts.values()), sum(n * post[v] for v, n in counts.items())
            share = min(0.99, max(0.01, (true + 1) / (total + 2)))
            for i, weight in ((0, lambda v: post[v]), (1, lambda v: 1 - post[v])):
                whole = sum(n * weight(v) for v, n in counts.items())
                for k in range(len(LABELERS)):
                    prior = {1: 0.7, 0: 0.2, -1: 0.1} if i == 0 else {1: 0.1, 0: 0.3, -1: 0.6}
                    chance[i][k] = {x: (sum(n * weight(v) for v, n in counts.items() if v[k] == x) + 20 * prior[x]) / (whole + 20) for x in (1, 0, -1)}
        out |= {(kind, *v): p for v, p in post.items()}
    return out


def _features(kind: int, votes: tuple, length: int) -> dict[str, float]:
    return {f"kind{kind}": 1.0, "long": length / 4} | {f"{name}{'+' if v > 0 else '-'}": 1.0 for name, v in zip(LABELERS, votes, strict=True) if v}


def fit(patterns: list[tuple]) -> dict[str, float]:
    """Weights of the logistic span classifier, trained on the estimated probabilities."""
    post = estimate(patterns)
    rows = [(_features(p[0], p[1:-2], p[-2]), post[p[:-2]], math.log1p(p[-1])) for p in patterns]
    names = sorted({f for x, _, _ in rows for f in x})
    w = dict.fromkeys(names, 0.0)
    total = sum(n for _, _, n in rows) or 1.0
    for _ in range(FIT_ROUNDS):
        grad = {f: 0.01 * w[f] for f in names}
        for x, y, n in rows:
            g = n * (_sigmoid(sum(w[f] * v for f, v in x.items())) - y) / total
            for f, v in x.items():
                grad[f] += g * v
        w = {f: w[f] - 2.0 * grad[f] for f in names}
    return w


def _length(s: Column) -> Column:
    return F.least(F.floor((s["b"] - s["a"]) / 8), F.lit(4)).cast("int")


def _accepted(weights: dict[str, float]) -> Column:
    """All spans of a row that stay: base ones, and candidates the classifier accepts that
    overlap no base span; by start, then kind."""
    spans = F.col("_spans")
    base = F.filter(spans, lambda s: s["base"])

    def value(s: Column) -> Column:
        terms = [F.when(s["kind"] == k, weights.get(f"kind{k}", 0.0)).otherwise(0.0) for k in range(len(KINDS))]
        terms += [F.when(s[n] > 0, weights.get(f"{n}+", 0.0)).when(s[n] < 0, weights.get(f"{n}-", 0.0)).otherwise(0.0) for n in LABELERS]
        return reduce(lambda x, y: x + y, terms, _length(s) / 4 * weights.get("long", 0.0))

    added = F.filter(spans, lambda s: ~s["base"] & (s["valid"] > 0) & (value(s) > math.log(ACCEPT / (1 - ACCEPT))) & ~F.exists(base, lambda o: (o["a"] < s["b"]) & (s["a"] < o["b"])))
    plain = lambda x: F.transform(x, lambda s: F.struct(s["a"].alias("a"), s["kind"].alias("kind"), s["b"].alias("b")))
    return F.array_sort(F.concat(plain(base), plain(added)))


def _written(spans: Column) -> Column:
    name = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s), s["a"].cast("string"), s["b"].cast("string"))), ",")


def train(spans: DataFrame) -> dict[str, float]:
    """Weights from the vote patterns of a table that ``candidates`` made."""
    each = spans.select(F.explode("_spans").alias("s")).select("s.kind", *[f"s.{x}" for x in LABELERS], _length(F.col("s")).alias("length"))
    rows = each.groupBy("kind", *LABELERS, "length").agg(F.count(F.lit(1)).alias("n")).orderBy("kind", *LABELERS, "length").collect()
    return fit([tuple(r) for r in rows])


def detect(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans of each row."""
    found = save(candidates(docs.select("doc_id", "text")).select("doc_id", "_spans"), "spans")
    weights = train(found)
    base = F.array_sort(F.transform(F.filter("_spans", lambda s: s["base"]), lambda s: F.struct(s["a"].alias("a"), s["kind"].alias("kind"), s["b"].alias("b"))))
    of = lambda k: F.filter("_spans", lambda s: s["base"] & (s["kind"] == k))
    counts = [F.size(of(k)).cast("bigint").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(_written(base), 256).alias("base_sha256"), _written(_accepted(weights)).alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """The rows with each span of their text replaced by its kind in brackets; overlapping
    spans are replaced together, by the first one's kind."""
    weights = train(save(candidates(docs.select("text")).select("_spans"), "spans"))
    mark = lambda k: F.concat(F.lit("["), F.upper(F.element_at(F.array(*map(F.lit, KINDS)), k + 1)), F.lit("]"))

    def step(acc: Column, s: Column) -> Column:
        more = F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, s["a"] - acc["at"]), mark(s["kind"]))
        inside = F.struct(F.greatest(acc["at"], s["b"]).alias("at"), acc["out"].alias("out"))
        return F.when(s["a"] < acc["at"], inside).otherwise(F.struct(s["b"].alias("at"), more.alias("out")))

    rest = lambda acc: F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, F.lit(2**31 - 1)))
    text = F.aggregate(F.col("_keep"), F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, rest)
    rows = candidates(docs.select(F.struct(*docs.columns).alias("row"), "text")).withColumn("_keep", _accepted(weights))
    text = F.when(F.size("_keep") > 0, text).otherwise(F.col("text"))
    return rows.select(F.col("row").withField("text", text).alias("row")).select("row.*")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect(table(spark, sf_dir, "documents"))
