"""Operator 11 [native]: personal data by weak supervision.

Candidates are all matches of four patterns (emails, IPs, cards, phones), and looser
forms of them (written-out emails, IPv6, phones without a plus). Five labelers vote on
each, for, against or not at all: its format (pattern and check digits), a gazetteer
(top-level domains, issuer numbers, calling codes, address ranges), words before it that
name such data, words or signs that name something else, and the variety of its digits.
Expectation-maximisation over the counts of vote patterns (243 per kind) estimates how
often each labeler is right and how likely each pattern is personal data. With these as
soft labels a naive Bayes classifier over votes, shape, length and neighbouring words is
trained, and decides which candidates are spans besides those that the patterns and
their checks give, which always stay.

All work on texts is column functions within one row: no shuffle, no join. Places come
from the lengths of the pieces between matches, summed in a few steps, so a text with many
matches takes time in proportion. What is gathered is a count
per vote pattern and two sums per feature, both of fixed size.

Cases: a null text is empty and has no spans; null and repeated ids are rows like any
other; an empty table gives an empty result; a corpus without candidates has no spans to
add; other columns are ignored. Places count code points, the end is exclusive.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rootsweep.llm.common import own_columns, stored

KINDS = ("email", "ip", "card", "phone")
# The contract's patterns. Possessive repeats and the look-behinds change no
# match: a start within a run of the same characters fails or succeeds as the run's start.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without this has no match.
NEEDED = {"email": "@", "ip": r"[0-9]\.[0-9]++\.[0-9]", "card": r"[0-9](?:[\x20-]?+[0-9]){12}", "phone": r"\+[0-9]"}
#: Looser forms, searched between the matches above.
LOOSE = {
    "email": r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]++(?:\x20?[\(\[{]at[\)\]}]\x20?|\x20at\x20)[a-z0-9-]++"
             r"(?:(?:\x20?[\(\[{]dot[\)\]}]\x20?|\x20dot\x20)[a-z0-9-]++)++",
    "ip": r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])",
    "phone": r"(?<![A-Za-z0-9+])(?<![0-9][\x20().-])(?:\([0-9]{2,4}\)[\x20.-]?|[0-9]{2,4}[\x20.-])[0-9]{3,4}[\x20.-][0-9]{3,4}"
             r"(?![0-9A-Za-z])(?![\x20().-][0-9])",
}
LOOSE_NEEDED = {"email": r"(?i)[\(\[{\x20]dot[\)\]}\x20]", "ip": r"(?::[0-9A-Fa-f]{1,4}){5}", "phone": r"[0-9][\x20.-][0-9]{3,4}(?![0-9])"}
OCTETS = r"^0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2}+|)(?:\.0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2}+|)){3}$"

# Gazetteers.
DOMAINS = ("com|org|net|edu|gov|mil|int|info|biz|io|dev|app|me|tv|co|eu|us|uk|de|fr|es|it|nl|be|ch|at|pl|pt|se|no|dk|fi|ie|cz|gr|hu|ro|"
           "ru|ua|tr|il|in|cn|jp|kr|au|nz|ca|mx|br|ar|cl|za")
ISSUERS = r"^(?:4[0-9]{12}(?:[0-9]{3}){0,2}|5[1-5][0-9]{14}|2[2-7][0-9]{14}|3[47][0-9]{13}|3(?:0[0-5]|[68][0-9])[0-9]{11}|6(?:011|5[0-9]{2}|4[4-9][0-9])[0-9]{12}|35[0-9]{14})$"
CALLING = r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|2[1-69][0-9]|3[578][0-9]|42[0-9]|5[09][0-9]|6[7-9][0-9]|8[058][0-9]|9[679][0-9])"
PRIVATE = r"^0*+(?:0|127|22[4-9]|23[0-9]|24[0-9]|25[0-5])\.|\.0*+$"
NAMED = {
    "email": r"\b(e-?mail|mailto|mail|contact|contacto|kontakt|correo|courriel|write to|reply|reach)\b",
    "ip": r"\b(ip|ipv4|ipv6|host|server|addr|address|adresse|direcci[oó]n|client|peer|login|logged)\b",
    "card": r"\b(card|credit|debit|visa|mastercard|amex|cc|pan|karte|kreditkarte|tarjeta|carte)\b",
    "phone": r"\b(tel|telephone|telefon|tel[eé]fono|t[eé]l[eé]phone|phone|call|mobile|cell|fax|handy|m[oó]vil|dial|sms|whatsapp)\b",
}
OTHER = (r"\b(version|ver|release|build|section|chapter|kapitel|abschnitt|figure|table|page|order|invoice|rechnung|factura|isbn|issn|ean|doi|"
         r"serial|tracking|sum|total|id|ref|no|nr|art)\b[^a-z]{0,4}$|[/=#&?_\\]$")

LABELERS = ("format", "gazetteer", "context", "counter", "variety")
PER_KIND = 3 ** len(LABELERS)
#: Feature places of a kind: votes, shapes, words before, next characters, lengths.
SHAPES, WORDS, NEXT, LENGTHS = 512, 1024, 64, 32
FEATURES = 3 * len(LABELERS) + SHAPES + WORDS + NEXT + LENGTHS
#: How often a vote is expected (for, none, against) where the span is personal data, and
#: the weight of this expectation in candidates.
EXPECTED, WEIGHT = {"format": (0.85, 0.1, 0.05), None: (0.45, 0.45, 0.1)}, 8.0
#: Candidates from this probability on are added.
ADD = 0.9



# ---- places of matches --------------------------------------------------------------------
def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), lambda x: body(x)).getItem(0)


def running_sums(values: Column) -> Column:
    """Prefix sums of an array (of up to 2**28 elements): each step adds 16 partial sums."""
    def step(v: Column, width: int) -> Column:
        def total(x: Column, i: Column) -> Column:
            return F.aggregate(F.sequence(F.lit(1), F.lit(15)), x, lambda s, j: s + F.coalesce(F.get(v, i - j * width), F.lit(0)))

        return F.when(F.size(v) > width, F.transform(v, total)).otherwise(v)

    out = values
    for s in range(7):
        out = let(out, partial(step, width=16 ** s))
    return out


def pieces(text: Column, kind: str, loose: bool = False) -> Column:
    """Pieces between the matches of a kind's pattern (p) and the matches (m)."""
    pattern = LOOSE[kind] if loose else PATTERNS[kind]
    return F.struct(F.lit(KINDS.index(kind)).alias("kind"), F.lit(loose).alias("loose"), F.split(text, pattern, -1).alias("p"),
                    F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"))


def places(cut: Column) -> Column:
    """Matches with their places, and some text before and after each."""
    lengths = F.transform(cut["m"], lambda x, i: F.length(F.get(cut["p"], i)) + F.length(x))
    return let(running_sums(lengths), lambda e: F.transform(cut["m"], lambda x, i: F.struct(
        cut["kind"].alias("kind"), cut["loose"].alias("loose"), (F.get(e, i) - F.length(x)).alias("start"), F.get(e, i).alias("end"), x.alias("value"),
        F.substring(F.get(cut["p"], i), -40, 40).alias("before"), F.substring(F.get(cut["p"], i + F.lit(1)), 1, 20).alias("after"))))


def masked(text: Column, cut: Column) -> Column:
    """The text with as many marks in place of each match."""
    marked = F.concat_ws("", F.transform(cut["p"], lambda p, i: F.concat(p, F.repeat(F.lit("\x01"), F.coalesce(F.length(F.get(cut["m"], i)), F.lit(0))))))
    return F.when(cut.isNull(), text).otherwise(marked)


# ---- labelers -------------------------------------------------------------------------------
def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def passes(kind: str, value: Column) -> Column:
    """Whether a match of the kind's pattern is a span by itself."""
    if kind == "ip":
        return value.rlike(OCTETS)
    if kind == "card":
        return F.length(_digits(value)).between(13, 19) & F.call_function("luhn_check", _digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def by_kind(kind: Column, of: Callable[[str], Column]) -> Column:
    """The column of the span's own kind (only that one is computed)."""
    out = F.when(kind == 0, of(KINDS[0]))
    for k in range(1, len(KINDS)):
        out = out.when(kind == k, of(KINDS[k]))
    return out


def votes(span: Column) -> list[Column]:
    """Votes of the labelers: 1 for, -1 against, 0 none."""
    value, kind, loose, low = span["value"], span["kind"], span["loose"], F.lower(span["before"])
    digits = _digits(value)
    known = {
        "email": F.lower(value).rlike(rf"[^a-z0-9-](?:{DOMAINS})$"),
        "ip": F.when(loose, value.rlike("^[23]")).otherwise(~value.rlike(PRIVATE)),
        "card": digits.rlike(ISSUERS),
        "phone": F.when(loose, digits.rlike("^0?[2-9]")).otherwise(F.regexp_replace(value, "[^+0-9]", "").rlike(CALLING)),
    }
    poor = F.size(F.array_distinct(F.split(digits, ""))) <= 3
    variety = {
        "email": F.when(value.rlike(r"^[._%+-]|[._%+-]@|\.\."), -1),
        "ip": F.when(F.length(digits) >= 8, 1).when(F.length(digits) <= 4, -1),
        "card": F.when(poor, -1),
        "phone": F.when(poor, -1),
    }
    return [F.when(loose, 0).when(by_kind(kind, lambda k: passes(k, value)), 1).otherwise(-1),
            F.when(by_kind(kind, known.get), 1).otherwise(-1),
            F.when(by_kind(kind, lambda k: low.rlike(NAMED[k])), 1).otherwise(0),
            F.when(low.rlike(OTHER) | span["after"].rlike(r"^[/=&?_\\@]"), -1).otherwise(0),
            F.coalesce(by_kind(kind, variety.get), F.lit(0))]


def _bucket(x: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(x), F.lit(n)).cast("int")


def candidate(span: Column) -> Column:
    """A span with its vote pattern and its features."""
    value, kind = span["value"], span["kind"]

    def described(v: Column) -> Column:
        pattern = F.aggregate(v, kind, lambda s, x: s * 3 + x + 1)  # the kind, then a digit per labeler
        shape = F.regexp_replace(F.regexp_replace(value, "[0-9]+", "9"), "[A-Za-z]+", "a")
        at = 3 * len(LABELERS)
        more = F.array(_bucket(shape, SHAPES) + at, _bucket(F.regexp_extract(F.lower(span["before"]), r"(\p{L}+)\P{L}*$", 1), WORDS) + (at + SHAPES),
                       _bucket(F.substring(span["after"], 1, 1), NEXT) + (at + SHAPES + WORDS),
                       F.least(F.length(value), F.lit(LENGTHS - 1)) + (at + SHAPES + WORDS + NEXT))
        features = F.transform(F.concat(F.transform(v, lambda x, j: x + 1 + 3 * j), more), lambda f: f + kind * FEATURES)
        return F.struct(kind.alias("kind"), span["start"].alias("start"), span["end"].alias("end"), (F.get(v, F.lit(0)) == 1).alias("base"),
                        pattern.alias("pattern"), features.alias("features"))

    return let(F.array(*votes(span)), described)


def candidates(documents: DataFrame) -> DataFrame:
    """doc_id and its candidates, base spans among them."""
    docs = own_columns(documents, "doc_id", "text").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    text = F.col("text")
    has = {k: text.contains(n) if k == "email" else text.rlike(n) for k, n in NEEDED.items()}
    docs = docs.select("doc_id", "text", *[F.when(has[k], pieces(text, k)).alias(k) for k in KINDS])
    between = {k: F.when(text.rlike(LOOSE_NEEDED[k]), masked(text, F.col(k))) for k in LOOSE}
    docs = docs.select("doc_id", *KINDS, *[between[k].alias(f"between_{k}") for k in LOOSE])
    loose = [F.when(F.col(f"between_{k}").isNotNull(), pieces(F.col(f"between_{k}"), k, True)) for k in LOOSE]
    docs = docs.select("doc_id", F.filter(F.array(*KINDS, *loose), lambda c: F.size(c["m"]) > 0).alias("cuts"))
    docs = docs.select("doc_id", F.flatten(F.transform("cuts", places)).alias("spans"))
    # numbers of fewer digits are no cards in any form
    spans = F.filter("spans", lambda s: (s["kind"] != KINDS.index("card")) | (F.length(s["value"]) >= 13))
    return docs.select("doc_id", F.transform(spans, candidate).alias("found"))


# ---- reliabilities and classifier -----------------------------------------------------------
def reliabilities(counts: dict[int, int], rounds: int = 200) -> tuple[dict[int, float], list]:
    """EM over the counts of one kind's vote patterns: how likely each pattern is personal
    data, and per labeler how often it votes (for, none, against) if it is, and if not."""
    def digits(p: int) -> list[int]:
        return [2 - p // 3 ** j % 3 for j in reversed(range(len(LABELERS)))]  # 0 for, 1 none, 2 against

    prior_yes = [EXPECTED.get(name, EXPECTED[None]) for name in LABELERS]
    rates = [(list(t), list(t[::-1])) for t in prior_yes]
    share, post = 0.5, {}
    for _ in range(rounds):
        before = post
        post = {}
        for p in counts:
            odds = math.log(share / (1 - share)) + sum(math.log(rates[j][0][v] / rates[j][1][v]) for j, v in enumerate(digits(p)))
            post[p] = 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))
        total = sum(counts.values())
        yes = sum(n * post[p] for p, n in counts.items())
        share = (yes + 1) / (total + 2)
        for j in range(len(LABELERS)):
            sums = [[WEIGHT * w for w in prior_yes[j]], [WEIGHT * w for w in prior_yes[j][::-1]]]
            for p, n in counts.items():
                sums[0][digits(p)[j]] += n * post[p]
                sums[1][digits(p)[j]] += n * (1 - post[p])
            rates[j] = tuple([x / sum(s) for x in s] for s in sums)
        if before and max(abs(post[p] - before[p]) for p in post) < 1e-12:
            break
    return post, rates


def classifier(sums: dict[int, tuple[float, float]], kind: int, yes: float, no: float) -> tuple[float, dict[int, float]]:
    """Naive Bayes weights of one kind's features (log odds, smoothed) and its prior."""
    groups = [(3 * j, 3) for j in range(len(LABELERS))]
    at = 3 * len(LABELERS)
    for n in (SHAPES, WORDS, NEXT, LENGTHS):
        groups.append((at, n))
        at += n
    weights = {}
    for start, n in groups:
        for f in range(start, start + n):
            a, b = sums.get(kind * FEATURES + f, (0.0, 0.0))
            weights[kind * FEATURES + f] = math.log((a + 1) / (yes + n)) - math.log((b + 1) / (no + n))
    return math.log((yes + 1) / (no + 1)), weights


def numbers(values: list[float]) -> Column:
    """A constant array of doubles."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>")


def train(found: DataFrame) -> tuple[list[float], list[float]]:
    """(prior per kind, weight per feature) from all candidates of the corpus."""
    rows = stored(found.select(F.inline("found")).select("kind", "pattern", "features"), "pii-candidates")
    counts = {r["pattern"]: r["count"] for r in rows.groupBy("pattern").count().collect()}  # 243 a kind at most
    post = [0.0] * (len(KINDS) * PER_KIND)
    for k in range(len(KINDS)):
        mine = {p - k * PER_KIND: n for p, n in counts.items() if p // PER_KIND == k}
        for p, value in reliabilities(mine)[0].items():
            post[k * PER_KIND + p] = value
    soft = rows.select(F.explode("features").alias("f"), F.get(numbers(post), F.col("pattern")).alias("p"))
    sums = {r["f"]: (r["yes"], r["no"]) for r in soft.groupBy("f").agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no")).collect()}
    priors, weights = [], [0.0] * (len(KINDS) * FEATURES)
    for k in range(len(KINDS)):
        mine = {p: n for p, n in counts.items() if p // PER_KIND == k}
        yes = sum(n * post[p] for p, n in mine.items())
        prior, w = classifier(sums, k, yes, sum(mine.values()) - yes)
        priors.append(prior)
        for f, x in w.items():
            weights[f] = x
    return priors, weights


def personal_data(documents: DataFrame, add: float = ADD) -> DataFrame:
    """(doc_id, spans, base): all spans and those of the patterns alone, as arrays of
    struct(kind, start, end) by kind, then start."""
    found = candidates(documents)
    priors, weights = train(found)
    bar = math.log(add / (1 - add))
    prior, weight = numbers(priors), numbers(weights)

    def chosen(c: Column) -> Column:
        return F.aggregate(c["features"], F.get(prior, c["kind"]), lambda s, f: s + F.get(weight, f)) >= bar

    def triple(c: Column) -> Column:
        return F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"))

    kept = found.select("doc_id", F.filter("found", lambda c: c["base"] | chosen(c)).alias("found"))
    return kept.select("doc_id", F.sort_array(F.transform("found", triple)).alias("spans"),
                       F.sort_array(F.transform(F.filter("found", lambda c: c["base"]), triple)).alias("base"))


def digests(spans: DataFrame) -> DataFrame:
    """doc_id, base counts per kind, digest of the base spans, and all spans as text."""
    names = F.array(*[F.lit(k) for k in KINDS])

    def text(column: str) -> Column:
        return F.concat_ws(",", F.transform(column, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))))

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")

    return spans.select("doc_id", *[count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
                        F.sha2(text("base"), 256).alias("base_sha256"), text("spans").alias("spans"))
