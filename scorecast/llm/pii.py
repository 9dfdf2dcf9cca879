"""Personal data by weak supervision, with DataFrame functions only.

Patterns propose spans.  For every span five labelers vote yes, no or nothing:
the strict form of its kind, a gazetteer, cue words before it, its characters,
and its borders.  Expectation-maximisation over the counted vote patterns
estimates how reliable each labeler is (Dawid and Skene's model with labelers
independent given the truth) and how likely each span is personal data.  These
soft labels train the final span classifier, a naive Bayes model over votes,
kind, length and neighbours.  Spans of the four base kinds stay in any case;
spans of the added kinds stay if the classifier says so.

Each text is read once and nothing but narrow rows moves: vote patterns and
feature counts are grouped (at most a few thousand rows, bounded by the number
of labelers and feature values) before they reach the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, text_or_empty

BASE = ("email", "ip", "card", "phone")
ADDED = ("secret", "account", "handle")

# Possessive quantifiers keep long runs linear; they and the look-behinds do
# not change what matches: where a run fails at its first character, it fails
# at the others.  \G lets a match begin where the last one ended.
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # whole runs of digits with single spaces or dashes; only those of 12 to 19 digits
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "secret": r"AKIA[0-9A-Z]{16}(?![0-9A-Za-z])"
              r"|(?<=(?:password|passwd|pwd|token|secret|api_key|apikey)\x20{0,2}[=:]\x20{0,2}[\x22\x27]?)[A-Za-z0-9+/_!$%&*-]{8,128}+",
    "account": r"(?<![0-9A-Za-z-])(?:[0-9]{3}-[0-9]{2}-[0-9]{4}|[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}+)(?![0-9A-Za-z-])",
    "handle": r"(?<![A-Za-z0-9._-])[A-Za-z0-9._-]{1,64}+\x20?[(\[]at[)\]]\x20?[A-Za-z0-9-]{1,64}+(?:\x20?(?:\.|[(\[]dot[)\]])\x20?[A-Za-z0-9-]{1,64}+){1,8}+",
}
# what a text must hold for a pattern to be worth running
_NEEDS = {
    "email": lambda t: t.contains("@"), "ip": lambda t: t.rlike(r"[0-9]\.[0-9]"), "card": lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){11}"),
    "phone": lambda t: t.contains("+"), "secret": lambda t: t.rlike("AKIA|password|passwd|pwd|token|secret|api_?key"),
    "account": lambda t: t.rlike(r"[0-9]{2}(?:-[0-9]{4}|\x20?[A-Z0-9]{4})"), "handle": lambda t: t.rlike(r"[(\[]at[)\]]"),
}
_CONTEXT = 32    # characters before a span that labelers see
_CHUNK, _MATCHES = 128, "array<struct<m:string,p:string,q:string>>"

# gazetteers, parameters of the labelers
_GAZETTEER = {
    "email": r"(?i)\.(?:com|net|org|edu|gov|info|biz|io|de|fr|es|it|uk|eu|us|ch|at|nl|be|pl|ca|au|jp|cn|in|br|mx)$",
    "ip": r"^(?!0\.|127\.|255\.|22[4-9]\.|2[3-5][0-9]\.)",
    "card": r"^(?:3[47]|4|5[1-5]|2[2-7]|6)",
    "phone": r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])",
    "secret": r"^AKIA|(?=.*[0-9])(?=.*[A-Za-z])",
    "account": r"^(?:[0-9]{3}-|AT|BE|BG|CH|CY|CZ|DE|DK|EE|ES|FI|FR|GB|GR|HR|HU|IE|IT|LT|LU|LV|MT|NL|NO|PL|PT|RO|SE|SI|SK)",
    "handle": r"(?i)(?:com|net|org|edu|gov|info|io|de|fr|es|it|uk|eu)$",
}
_CUES = {
    "email": "mail|contact|write|reach|address|kontakt|correo|courriel", "ip": r"\bip\b|host|server|address|login|client",
    "card": "card|visa|master|amex|credit|karte|carte|tarjeta", "phone": "tel|phone|call|mobile|fax|ruf|appel|llam",
    "secret": "key|password|passwd|pwd|token|secret|credential", "account": "iban|account|ssn|social|konto|compte|cuenta",
    "handle": "mail|contact|write|reach|kontakt|correo",
}
_STRICT = {
    "email": r"^[A-Za-z0-9][A-Za-z0-9._%+-]*@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,24}$",
    "ip": rf"^(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){{3}}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])$",
    "card": r"^(?:[0-9]{13,19}|[0-9]{4}(?:[\x20-][0-9]{4}){3}|[0-9]{4}[\x20-][0-9]{6}[\x20-][0-9]{5})$",
    "phone": r"^\+[0-9]{1,3}[\x20.-]?\(?[0-9]{1,4}\)?(?:[\x20.-]?[0-9]{2,5}){1,4}$",
    "secret": r"^AKIA[0-9A-Z]{16}$|^[0-9a-f]{16,128}$|^[A-Za-z0-9+/_-]{20,128}$",
    "account": r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$|^[A-Z]{2}[0-9]{2}[A-Z0-9\x20]{11,38}$",
    "handle": r"(?i)(?:\.|[(\[]dot[)\]])\x20?[a-z]{2,24}$",
}


def _proposed(text: Column, kind: str) -> Column:
    """array<struct<kind, start, stop, text, before, after>> of a pattern's
    matches; places in code points from the pieces between the matches.

    Arrays grow match by match only inside chunks of ``_CHUNK`` matches, so a
    text with very many costs a bounded amount for each."""
    pattern = PATTERNS[kind]
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    both = F.arrays_zip(found.alias("m"), F.slice(pieces, 1, F.size(found)).alias("p"), F.slice(pieces, 2, F.size(found)).alias("q"))
    none = F.array().cast("array<struct<kind:string,start:int,stop:int,text:string,before:string,after:string>>")

    def step(acc, x):
        m, p, q = x["m"], x["p"], x["q"]
        start = acc["at"] + F.length(p)
        span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), (start + F.length(m)).alias("stop"), m.alias("text"),
                        F.right(p, F.lit(_CONTEXT)).alias("before"), F.left(q, F.lit(1)).alias("after"))
        return F.struct((start + F.length(m)).alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    both = F.transform(both, lambda x: F.struct(x["m"].alias("m"), x["p"].alias("p"), x["q"].alias("q")))
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(both) - 1) / _CHUNK).cast("int")), lambda c: F.slice(both, c * _CHUNK + 1, _CHUNK))
    sizes = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0), lambda n, x: n + F.length(x["m"]) + F.length(x["p"])))
    starts = F.aggregate(sizes, F.array(F.lit(0)), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))
    placed = F.transform(F.arrays_zip(chunks.alias("c"), starts.alias("at")), lambda z: F.filter(
        F.aggregate(F.coalesce(z["c"], F.array().cast(_MATCHES)), F.struct(z["at"].alias("at"), none.alias("spans")), step)["spans"],
        lambda s: _valid(s["text"], kind)))
    return F.when(_NEEDS[kind](text) & (F.size(found) > 0), F.flatten(placed)).otherwise(none)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _valid(m: Column, kind: str) -> Column:
    if kind == "ip":
        return m.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "phone":
        return F.length(_digits(m)).between(9, 15)
    if kind == "card":
        d = F.reverse(_digits(m))

        def luhn(total, i):
            x = F.substring(d, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
            return total + F.when(x > 9, x - 9).otherwise(x)
        total = F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(d), F.lit(1))), F.lit(0), luhn)
        return F.when(F.length(d).between(12, 19), total % 10 == 0).otherwise(False)
    return F.lit(True)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _by_kind(kind: Column, table: dict, test) -> Column:
    out = F.lit(False)
    for k, pattern in table.items():
        out = F.when(kind == k, test(pattern)).otherwise(out)
    return out


def labelers(s: Column) -> list[Column]:
    """The votes on a span: 1 personal data, -1 not, 0 no opinion."""
    kind, text, before, after = s["kind"], s["text"], F.lower(s["before"]), s["after"]
    strict = _by_kind(kind, _STRICT, lambda p: text.rlike(p))
    known = _by_kind(kind, _GAZETTEER, lambda p: F.when(kind == "card", _digits(text)).otherwise(text).rlike(p))
    cue = _by_kind(kind, _CUES, lambda p: before.rlike(p))
    junk = text.rlike(r"(.)\1{6,}") | text.rlike(r"(?i)xxxx|0000000|1234567|changeme|example$")
    mixed = F.length(F.regexp_replace(text, r"(.)(?=.*\1)", "")) * 2 >= F.least(F.length(text), F.lit(20))
    torn = s["before"].rlike(r"[A-Za-z0-9]$") | after.rlike(r"^[A-Za-z0-9]")
    clean = (s["before"] == "") | s["before"].rlike(r"[\s\x22\x27(<\[:=,;]$")
    return [_vote(strict, ~strict), _vote(known, ~known), _vote(cue, before.rlike(r"version|chapter|figure|\brev\b|isbn|build")),
            _vote(mixed & ~junk, junk), _vote(clean & ~torn, torn)]


def _features(s: Column, votes: list[Column]) -> list[Column]:
    """Values of the classifier's features, each with a few possible values."""
    name = lambda k, v: F.concat(F.lit(f"{k}="), v.cast("string"))
    last = F.when(s["before"] == "", "start").when(s["before"].rlike(r"\s$"), "space").when(s["before"].rlike(r"\w$"), "word").otherwise("mark")
    nxt = F.when(s["after"] == "", "end").when(s["after"].rlike(r"^\s"), "space").when(s["after"].rlike(r"^\w"), "word").otherwise("mark")
    size = F.least(F.floor(F.length(s["text"]) / 6), F.lit(8))
    share = F.floor(F.length(_digits(s["text"])) * 4 / F.greatest(F.length(s["text"]), F.lit(1)))
    return [*(name(f"vote{i}", v) for i, v in enumerate(votes)), name("kind", s["kind"]), name("last", last), name("next", nxt),
            name("size", size), name("digits", share)]


def expectation_maximisation(patterns: list[tuple[tuple, int]], rounds: int = 50) -> dict[tuple, float]:
    """Probability that a span is personal data, by (kind, votes).

    ``patterns`` are ((kind, votes...), count).  Each labeler has one table
    P(vote | truth); each kind has its own prior.  It starts from labelers
    that are right more often than not, which fixes which class is which."""
    if not patterns:
        return {}
    n = len(patterns[0][0]) - 1
    like = [{y: {v: (0.7 if v == y else 0.1 if v else 0.2) for v in (-1, 0, 1)} for y in (-1, 1)} for _ in range(n)]
    prior = {p[0]: 0.5 for p, _ in patterns}
    post: dict[tuple, float] = {}
    for _ in range(rounds):
        for p, _c in patterns:
            yes, no = math.log(prior[p[0]]), math.log(1 - prior[p[0]])
            for i, v in enumerate(p[1:]):
                yes += math.log(like[i][1][v])
                no += math.log(like[i][-1][v])
            post[p] = 1 / (1 + math.exp(max(-500.0, min(500.0, no - yes))))
        for kind in prior:
            mass = sum(c for p, c in patterns if p[0] == kind)
            prior[kind] = (sum(c * post[p] for p, c in patterns if p[0] == kind) + 1) / (mass + 2)
        for i in range(n):
            for y in (-1, 1):
                w = {v: 1.0 for v in (-1, 0, 1)}
                w[y] += 1.0
                for p, c in patterns:
                    w[p[i + 1]] += c * (post[p] if y == 1 else 1 - post[p])
                total = sum(w.values())
                like[i][y] = {v: x / total for v, x in w.items()}
    return post


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, spans, base.

    Both are array<struct<kind, start, stop, text, score>> ordered by start,
    then kind; places are code points, ends exclusive.  ``base`` has the spans
    of the four base patterns that pass their checks; ``spans`` also those the
    classifier adds (never over a base span).  Null and empty texts have none.
    Repeated rows repeat, null ids stay null, other columns are ignored, an
    empty table gives no rows."""
    text = F.col("_text")
    kinds = (*BASE, *ADDED)
    proposed = F.concat(*(_proposed(text, k) for k in kinds))
    rows = cut(docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("_text")).select("id", proposed.alias("spans")))

    # votes of every span, counted by pattern
    each = rows.select(F.explode("spans").alias("s"))
    votes = [v.alias(f"v{i}") for i, v in enumerate(labelers(F.col("s")))]
    each = cut(each.select(F.col("s"), *votes))
    names = [f"v{i}" for i in range(len(votes))]
    patterns = each.groupBy(F.col("s.kind").alias("kind"), *names).count().collect()   # at most 7 * 3^5 rows
    post = expectation_maximisation(sorted((tuple(r)[:-1], r["count"]) for r in patterns))

    # the classifier: log odds of each feature value under the soft labels
    soft = F.lit(0.5)
    key = F.concat_ws("|", F.col("s.kind"), *names)
    if post:
        table = F.create_map(*[F.lit(x) for p, y in sorted(post.items()) for x in ("|".join(map(str, p)), float(y))])
        soft = F.coalesce(table[key], F.lit(0.5))
    values = (each.withColumn("soft", soft).select("soft", F.explode(F.array(*_features(F.col("s"), [F.col(c) for c in names]))).alias("value"))
              .groupBy("value").agg(F.sum("soft").alias("yes"), F.sum(1 - F.col("soft")).alias("no")).collect())   # below 100 rows
    groups: dict[str, list] = {}
    for r in values:
        groups.setdefault(r["value"].split("=")[0], []).append(r)
    weight = {}
    for rs in groups.values():
        yes, no = (sum(r[c] for r in rs) + len(rs) for c in ("yes", "no"))
        for r in rs:
            weight[r["value"]] = math.log((r["yes"] + 1) / yes) - math.log((r["no"] + 1) / no)
    total = [sum(r[c] for r in groups.get("kind", [])) + 1 for c in ("yes", "no")]
    bias = math.log(total[0] / total[1])
    table = F.create_map(*[F.lit(x) for v, w in sorted(weight.items()) for x in (v, float(w))]) if weight else None

    def score(s):
        if table is None:
            return F.lit(0.5)
        odds = sum((F.coalesce(table[f], F.lit(0.0)) for f in _features(s, labelers(s))), F.lit(bias))
        return 1 / (1 + F.exp(-odds))

    place = F.create_map(*[F.lit(x) for i, k in enumerate(kinds) for x in (k, i)])
    spans = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), place[s["kind"]].alias("place"), s["kind"].alias("kind"),
                                                    s["stop"].alias("stop"), s["text"].alias("text"), score(s).alias("score")))
    scored = rows.select("id", F.array_sort(spans).alias("spans"))
    base = F.filter("spans", lambda s: s["place"] < len(BASE))
    scored = scored.withColumn("base", base)
    kept = F.filter("spans", lambda s: (s["place"] < len(BASE)) | (
        (s["score"] >= 0.5) & ~F.exists("base", lambda b: (b["start"] < s["stop"]) & (b["stop"] > s["start"]))))
    plain = lambda a: F.transform(a, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"),
                                                        s["text"].alias("text"), s["score"].alias("score")))
    return scored.select(F.col("id").alias(id_col), plain(kept).alias("spans"), plain(F.col("base")).alias("base"))


def spans_text(spans: Column) -> Column:
    """kind:start:end of the spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")
