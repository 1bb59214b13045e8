"""Personal data against a plain Python version: candidates, votes, EM, classifier."""

from __future__ import annotations

import hashlib
import math
from collections import Counter, defaultdict

import pytest
import regex as re
import xxhash
from llm_helpers import DOCS, extra

from rootsweep.llm import personal_data as pii
from rootsweep.llm.common import ship

CONTRACT = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    double = [2 * int(c) - 9 * (c > "4") if i % 2 else int(c) for i, c in enumerate(reversed(digits))]
    return sum(double) % 10 == 0


def passes(kind: str, value: str) -> bool:
    digits = re.sub("[^0-9]", "", value)
    return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in value.split(".")), "card": 13 <= len(digits) <= 19 and luhn(digits),
            "phone": 9 <= len(digits) <= 15}[kind]


def found(text: str) -> list[tuple]:
    """(kind, loose, start, end, value, before, after) of all candidates."""
    out = []
    for k, pattern in CONTRACT.items():
        spans = [m.span() for m in re.finditer(pattern, text)]
        hidden = text
        for s, e in spans:
            hidden = hidden[:s] + "\x01" * (e - s) + hidden[e:]
        for t, p, loose in ((text, pattern, False), (hidden, pii.LOOSE.get(k), True)):
            if p is None or loose and not re.search(pii.LOOSE_NEEDED[k], text):
                continue
            spans = [m.span() for m in re.finditer(p, t)]
            for i, (s, e) in enumerate(spans):
                last = spans[i - 1][1] if i else 0
                following = spans[i + 1][0] if i + 1 < len(spans) else len(t)
                if k != "card" or e - s >= 13:
                    out.append((k, loose, s, e, t[s:e], t[max(last, s - 40):s], t[e:min(following, e + 20)]))
    return out


def votes(c: tuple) -> tuple[int, ...]:
    k, loose, _, _, value, before, after = c
    digits, low = re.sub("[^0-9]", "", value), before.lower()
    known = {"email": lambda: re.search(rf"[^a-z0-9-](?:{pii.DOMAINS})$", value.lower()),
             "ip": lambda: value[0] in "23" if loose else not re.search(pii.PRIVATE, value),
             "card": lambda: re.search(pii.ISSUERS, digits),
             "phone": lambda: re.search("^0?[2-9]", digits) if loose else re.search(pii.CALLING, re.sub("[^+0-9]", "", value))}[k]()
    variety = {"email": -1 if re.search(r"^[._%+-]|[._%+-]@|\.\.", value) else 0, "ip": 1 if len(digits) >= 8 else -1 if len(digits) <= 4 else 0}
    return (0 if loose else 1 if passes(k, value) else -1, 1 if known else -1, 1 if re.search(pii.NAMED[k], low) else 0,
            -1 if re.search(pii.OTHER, low) or re.search(r"^[/=&?_\\@]", after) else 0, variety.get(k, -1 if len(set(digits)) <= 3 else 0))


def features(c: tuple, v: tuple) -> list[tuple]:
    def bucket(x, n):
        h = xxhash.xxh64_intdigest(x.encode(), 42)
        return (h - (1 << 64) if h >> 63 else h) % n

    word = re.search(r"(\p{L}+)\P{L}*$", c[5].lower())
    shape = re.sub("[A-Za-z]+", "a", re.sub("[0-9]+", "9", c[4]))
    return [*[(name, x) for name, x in zip(pii.LABELERS, v, strict=True)], ("shape", bucket(shape, pii.SHAPES)),
            ("word", bucket(word[1] if word else "", pii.WORDS)), ("next", bucket(c[6][:1], pii.NEXT)), ("length", min(len(c[4]), pii.LENGTHS - 1))]


def brute(texts: list[str]) -> list[tuple[list, list]]:
    """(base spans, all spans) of each text."""
    cands = [[(c, votes(c)) for c in found(t)] for t in texts]
    score = {}
    for k in pii.KINDS:
        counts = Counter(v for row in cands for c, v in row if c[0] == k)
        want = {j: dict(zip((1, 0, -1), pii.EXPECTED.get(name, pii.EXPECTED[None]), strict=True)) for j, name in enumerate(pii.LABELERS)}
        yes, no, share, post = want, {j: {v: w[-v] for v in w} for j, w in want.items()}, 0.5, {}
        for _ in range(200):
            post = {v: 1 / (1 + (1 - share) / share * math.prod(no[j][x] / yes[j][x] for j, x in enumerate(v))) for v in counts}
            total = sum(n * post[v] for v, n in counts.items())
            share = (total + 1) / (sum(counts.values()) + 2)
            new = []
            for sign, weight in ((1, lambda v: post[v]), (-1, lambda v: 1 - post[v])):
                rates = {}
                for j, w in want.items():
                    raw = {x: pii.WEIGHT * w[sign * x] + sum(n * weight(v) for v, n in counts.items() if v[j] == x) for x in w}
                    rates[j] = {x: y / sum(raw.values()) for x, y in raw.items()}
                new.append(rates)
            yes, no = new
        a, b = defaultdict(float), defaultdict(float)
        for row in cands:
            for c, v in row:
                if c[0] == k:
                    for f in features(c, v):
                        a[f] += post[v]
                        b[f] += 1 - post[v]
        sizes = {"shape": pii.SHAPES, "word": pii.WORDS, "next": pii.NEXT, "length": pii.LENGTHS}
        total, rest = sum(n * post[v] for v, n in counts.items()), sum(n * (1 - post[v]) for v, n in counts.items())

        def odds(c, v, a=a, b=b, total=total, rest=rest):
            out = math.log((total + 1) / (rest + 1))
            for f in features(c, v):
                n = sizes.get(f[0], 3)
                out += math.log((a[f] + 1) / (total + n)) - math.log((b[f] + 1) / (rest + n))
            return out

        score[k] = odds
    out = []
    for row in cands:
        base = sorted((pii.KINDS.index(c[0]), c[2], c[3]) for c, v in row if v[0] == 1)
        more = [(pii.KINDS.index(c[0]), c[2], c[3]) for c, v in row if v[0] != 1 and score[c[0]](c, v) >= math.log(9)]
        out.append((base, sorted(base + more)))
    return out


def joined(spans) -> str:
    return ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in spans)


TEXTS = [
    None, "", " ", "no such thing here, only words", "mail me: joe.blow@mail.example.org or j@x", "a@b.c_d@e.fr a@b@c.de x@y.z-@q.com..@r.net",
    "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.255 10.20.30.40.", "version 1.2.3.4 and server 84.23.190.7",
    "card 4111 1111 1111 1111, 4111-1111-1111-1112 and 4111  1111", "0000 0000 0000 0000 6011000990139424 30569309025904",
    "call +1 (415) 555-0199, +49 30 1234567., +12 or +1 2", "phone (415) 555-0199 or 030 123 4567; order 555 123 4567 8", "+++123456789+1234567890123456",
    "write to joe dot b at mail dot example dot com", "contact ann [at] site [dot] org, bob (at) home (dot) net", "look at home dot by dot",
    "ip 2001:0db8:85a3:0000:0000:8a2e:0370:7334 and 1:2:3:4:5:6:7:8", "\U0001f600 é joe@exämple.com \U0001f600 joe@example.com ünd 4111111111111111",
    "1" * 60 + " " + "1-2 " * 20, "a" * 3000 + "@" + "b." * 3000, "٣٣٣.١.١.١ ４１１１１１１１１１１１１１１１",
]


@pytest.fixture(scope="module")
def documents(spark):
    ship(spark)
    more = [f"mail user{i}@host{i % 7}.com from 84.{i}.19.{i * 7 % 256}, call +49 30 55{i:05d}, card {4000000000000000 + i * 9973}" for i in range(200)]
    more += [f"contact ann{i} (at) site{i % 5} (dot) org or tel (415) 555-{1000 + i}" for i in range(60)]
    rows = [(i, t) for i, t in enumerate(TEXTS + more)] + [(3, "mail me: joe.blow@mail.example.org"), (None, "mail a@b.de")]
    return spark.createDataFrame(rows, DOCS).repartition(4)


def test_spans_equal_the_plain_version(documents):
    rows = documents.collect()
    want = []
    for r, (base, spans) in zip(rows, brute([r.text or "" for r in rows]), strict=True):
        n = Counter(k for k, _, _ in base)
        want.append((r.doc_id, *[n[k] for k in range(4)], hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)))
    got = [tuple(r) for r in pii.digests(pii.personal_data(extra(documents))).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert any(len(w[-1]) and "email" in w[-1] and w[1] == 0 for w in want)  # written-out emails are found
    by_id = {w[0]: w for w in want}
    assert by_id[3][-1] == "email:9:34" or by_id[3][-1] == ""  # repeated id: each row is its own


def test_many_matches_in_a_long_text(spark):
    ship(spark)
    text = "".join(f"é{'x' * (i % 5)} u{i}@h.com " for i in range(40_000))
    rows = pii.digests(pii.personal_data(spark.createDataFrame([(1, text), (2, "9" * 300_000), (3, "1.2." * 50_000), (4, "a" * 400_000)], DOCS))).collect()
    want = ",".join(f"email:{m.start()}:{m.end()}" for m in re.finditer(CONTRACT["email"], text))
    got = {r.doc_id: r for r in rows}
    assert got[1].n_email == 40_000 and got[1].base_sha256 == hashlib.sha256(want.encode()).hexdigest() and got[1].spans == want
    assert got[3].n_ip == 25_000 and got[2].spans == got[4].spans == ""


def test_empty_table_and_no_candidates(spark):
    assert pii.digests(pii.personal_data(spark.createDataFrame([], DOCS))).count() == 0
    (row,) = pii.digests(pii.personal_data(spark.createDataFrame([(1, "plain words")], DOCS))).collect()
    assert tuple(row) == (1, 0, 0, 0, 0, hashlib.sha256(b"").hexdigest(), "")


def test_main_path_is_native(documents):
    plan = pii.candidates(documents)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
