"""Personal data by weak supervision, natively.

Candidates: spans of the four base kinds (email, ip, card, phone), found left
to right without overlap within a kind and checked (octets, Luhn, digit
counts), and of one further kind, secret: a long run of letters and digits.
Labelers vote on each candidate from its form (regex), from words known to
announce its kind (gazetteer) and from the characters beside it (context).
Expectation maximisation over the counts of vote patterns estimates each
labeler's reliability by kind; a logistic classifier of votes and kind is
trained on the posterior and decides each span. Base spans always stay.

Vote patterns are at most kinds times 2 to the power of the labelers, so the
fit sees a bounded table; everything on rows is a DataFrame expression.

Defined cases: a null text is empty and has no spans; repeated rows get equal
results; an empty table fits nothing; extra columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import quoted, stored
from .line_frequency import bound

#: kind -> pattern. Possessive forms and the look-behind of a run's first
#: character match what the plain patterns match, in linear time.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "secret": r"(?:\G|(?<![A-Za-z0-9+/_-]))(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{20,}+",
}
BASE = ("email", "ip", "card", "phone")
#: cheap conditions without which a kind can't occur
NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+", "secret": ""}
BEFORE = 24
#: fixed values: words that announce a kind
ANNOUNCE = {
    "email": "mail|contact|write|kontakt|correo|courriel",
    "ip": "ip|addr|host|server|client|from",
    "card": "card|visa|master|amex|karte|carte|tarjeta|iban|payment",
    "phone": "phone|tel|call|fax|mobile|ruf|appel|llama",
    "secret": "token|key|secret|password|passwd|bearer|credential|auth",
}
LABELERS = ("form", "announced", "assigned", "quoted", "bounded")
ROUNDS = 60


def digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(d: Column) -> Column:
    def summed(r: Column) -> Column:
        each = F.transform(F.sequence(F.lit(1), F.length(r)), lambda i: bound(
            F.substr(r, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1), lambda v: F.when(v > 9, v - 9).otherwise(v)))
        return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0
    return F.when(F.length(d) > 0, bound(F.reverse(d), summed)).otherwise(False)


def valid(kind: str, s: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(s, r"\."), lambda p: p.cast("double") <= 255)
    if kind == "card":
        return bound(digits(s), lambda d: F.length(d).between(14, 19) & luhn(d))
    if kind == "phone":
        return F.length(digits(s)).between(10, 15)
    return F.lit(True)


def votes(kind: str, s: Column, before: Column, after: Column) -> Column:
    """The labelers' votes on a candidate, one character each."""
    lead = F.lower(before)
    form = {"email": F.rlike(s, F.lit(r"^[A-Za-z0-9._%+-]{1,64}@[^@]+\.[A-Za-z]{2,24}$")),
            "ip": ~F.rlike(s, F.lit(r"^0|\.0[0-9]")),
            "card": F.rlike(s, F.lit(r"^[2-6][0-9]{3}(?:[ -]?[0-9]{4}){2}[ -]?[0-9]{2,7}$")),
            "phone": F.rlike(s, F.lit(r"^\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?[0-9 .-]+$")),
            "secret": F.rlike(s, F.lit(r"^(?:[0-9a-f]{32,}|[0-9A-F]{32,}|(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9+/_-]{24,})$"))}[kind]
    said = (form,
            F.rlike(lead, F.lit(rf"(?<!\pL)(?:{ANNOUNCE[kind]})\S*[\s:=\"'(]*$")),
            F.rlike(before, F.lit(r"[:=]\s*[\"']?$")),
            F.rlike(before, F.lit(r"[\"'<(]$")) & F.rlike(after, F.lit(r"^[\"'>)]")),
            F.rlike(before, F.lit(r"(?:^|[\s\"'<(:=])$")) & F.rlike(after, F.lit(r"^(?:$|[\s\"'>),.;:!?])")))
    return F.concat(*[F.when(v, "1").otherwise("0") for v in said])


def running(sizes: Column) -> Column:
    """The sum of all earlier entries for every entry. Built in blocks of about
    sqrt(n) entries, since an array that grows by one entry is copied each time."""
    def grown(a: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(a, start, lambda s, x: F.struct((s["at"] + x).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")))["out"]

    def summed(a: Column) -> Column:
        n = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(a))).cast("int"))
        blocks = F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(a) - 1), n), lambda k: F.slice(a, k + 1, n))
        total = lambda b: F.aggregate(b, F.lit(0), lambda s, x: s + x)
        return bound(blocks, lambda bs: F.flatten(F.zip_with(
            bs, grown(F.transform(bs, total)), lambda b, before: F.transform(grown(b), lambda x: x + before))))
    return bound(sizes, summed)


def candidates(kind: str, order: int, text: Column) -> Column:
    """All checked candidates of a kind with their places and votes."""
    pattern = PATTERNS[kind]

    def placed(pieces: Column, found: Column) -> Column:
        steps = F.transform(found, lambda m, i: F.struct(
            m.alias("m"), F.length(F.get(pieces, i)).alias("lead"), F.right(F.get(pieces, i), F.lit(BEFORE)).alias("before"),
            F.left(F.get(pieces, i + 1), F.lit(4)).alias("after")))
        # the text before a match is all earlier pieces and matches
        return bound(steps, lambda s: F.zip_with(
            s, running(F.transform(s, lambda x: x["lead"] + F.length(x["m"]))), lambda x, at: F.struct(
                (at + x["lead"]).alias("start"), x["m"].alias("m"), x["before"].alias("before"), x["after"].alias("after"))))

    spans = bound(F.split(text, pattern, -1), lambda p: placed(p, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))))
    kept = F.filter(spans, lambda x: valid(kind, x["m"]))
    shaped = F.transform(kept, lambda x: F.struct(
        x["start"].alias("start"), F.lit(order).alias("order"), (x["start"] + F.length(x["m"])).alias("end"),
        F.lit(kind).alias("kind"), votes(kind, x["m"], x["before"], x["after"]).alias("votes")))
    empty = F.array().cast("array<struct<start:int,order:int,end:int,kind:string,votes:string>>")
    some = F.rlike(text, F.lit(pattern))
    if NEEDS[kind]:
        some = F.contains(text, F.lit(NEEDS[kind])) & some
    return F.when(some, shaped).otherwise(empty)


def estimate(patterns: list[tuple[str, str, int]]) -> dict[tuple[str, str], float]:
    """Posterior by (kind, votes) from the labelers' reliabilities, which
    expectation maximisation learns for each kind."""
    out = {}
    for kind in PATTERNS:
        rows = [([int(c) for c in v], n) for k, v, n in patterns if k == kind]
        # start: base candidates passed their checks, a secret needs two labelers
        post = [0.9 if kind in BASE else min(0.95, 0.1 + 0.3 * sum(v)) for v, _ in rows]
        total = sum(n for _, n in rows)
        for _ in range(ROUNDS if rows else 0):
            yes = sum(n * p for (_, n), p in zip(rows, post)) + 1
            no = total + 2 - yes
            rates = [(min(.98, (sum(n * p for (v, n), p in zip(rows, post) if v[j]) + .7) / (yes + 0.4)),
                      max(.02, (sum(n * (1 - p) for (v, n), p in zip(rows, post) if v[j]) + .1) / (no + 0.4)))
                     for j in range(len(LABELERS))]
            # a labeler that is no better than chance for its kind is left out
            rates = [r if r[0] > r[1] else (.5, .5) for r in rates]
            post = [1 / (1 + math.exp(-max(-30, min(30, math.log(yes / no) + sum(
                math.log(a / b) if x else math.log((1 - a) / (1 - b)) for x, (a, b) in zip(v, rates))))))
                    for v, _ in rows]
        out |= {(kind, "".join(map(str, v))): p for (v, _), p in zip(rows, post)}
    return out


def train(patterns: list[tuple[str, str, int]], posterior: dict[tuple[str, str], float],
          steps: int = 2000) -> dict[tuple[str, str], float]:
    """The span classifier: logistic regression of kind and votes by kind on
    the posterior; returns its probability for every pattern."""
    total = sum(n for _, _, n in patterns) or 1
    bias, weight = dict.fromkeys(PATTERNS, 0.0), {k: [0.0] * len(LABELERS) for k in PATTERNS}

    def chance(k: str, v: str) -> float:
        z = bias[k] + sum(w for w, c in zip(weight[k], v) if c == "1")
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))

    for kind in PATTERNS:
        own = [(v, n / total) for k, v, n in patterns if k == kind]
        scale = sum(n for _, n in own) or 1
        for _ in range(steps):
            errors = [(v, n / scale * (chance(kind, v) - posterior[kind, v])) for v, n in own]
            bias[kind] -= 0.6 * sum(e for _, e in errors)
            for j in range(len(LABELERS)):
                weight[kind][j] -= 0.6 * (sum(e for v, e in errors if v[j] == "1") + 1e-4 * weight[kind][j])
    return {(k, v): chance(k, v) for k, v, _ in patterns}


def find(docs: DataFrame, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and spans: array of (start, order, end, kind, score), sorted;
    base spans and the others the classifier accepts."""
    text = F.coalesce(F.col(quoted(text_col)), F.lit(""))
    cands = F.concat(*[candidates(k, i, F.col("text")) for i, k in enumerate(PATTERNS)])
    rows = stored(docs.select(F.col(quoted(id_col)).alias("doc_id"), text.alias("text"))
                  .select("doc_id", cands.alias("cands")), "candidates")
    counted = rows.select(F.explode("cands").alias("x")).groupBy("x.kind", "x.votes").agg(F.count(F.lit(1)).alias("n")).collect()
    patterns = sorted((r["kind"], r["votes"], r["n"]) for r in counted)  # at most 5 x 32
    score = train(patterns, estimate(patterns))
    if score:
        known = F.create_map(*[F.lit(x) for (k, v), p in score.items() for x in (f"{k} {v}", float(p))])
        lookup = lambda x: F.element_at(known, F.concat_ws(" ", x["kind"], x["votes"]))
    else:
        lookup = lambda x: F.lit(0.0)
    scored = F.transform("cands", lambda x: F.struct(x["start"], x["order"], x["end"], x["kind"], lookup(x).alias("score")))
    kept = F.filter(scored, lambda x: (x["order"] < len(BASE)) | (x["score"] >= threshold))
    return rows.select("doc_id", F.array_sort(kept).alias("spans"))


def of_kind(spans: Column, kind: str) -> Column:
    return F.filter(spans, lambda x: x["kind"] == kind)


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
