"""Personal data by candidates and gradient boosting (operator 3).

Base spans come from fixed patterns with checks and always stay. High-recall generators then propose further spans, which
may overlap: numbers that a pattern ran together with their neighbours, phones without a plus, spaced cards, addresses
written out ("name [at] host [dot] org"), addresses of version 6. Boosted trees judge each candidate by its format and
its surroundings; those above the threshold of their kind are taken, the surest first, where no span taken before is
touched. The trees are fitted here, on written examples of both sorts in made-up sentences (`examples`); of the examples
some fit the trees, others calibrate their scores, and others again set each kind's threshold, the least calibrated
probability from which on they are right `PRECISION` of the time. Tests measure both on examples of another seed and on
spans planted in real texts, which none of the three has seen.

Patterns run in time linear in the text: scans start only where a match can (no digit before, or an at sign).

Cases: a null text counts as empty; offsets are code points, ends exclusive; repeated rows each give a row.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.llm import boosting
from tessera.llm.common import arrow_batches, texts, tidied

KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.98
CONTEXT = 40

DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
#: What every pattern and generator needs: a digit, an at sign or one written out, or hex digits with colons; texts without are done.
ANY = re.compile(r"[0-9@]|[\[({]\s?(?:at|AT)\s?[\])}]|\sat\s|[A-Fa-f]:[A-Fa-f:]")

GENERATORS = (
    ("card", re.compile(r"(?<![0-9])(?=((?:[0-9]{4}[ -]?){3}[0-9]{1,7}|[0-9]{4}[ -]?[0-9]{6}[ -]?[0-9]{5}|[0-9]{12,19}))(?<!\w)")),
    ("phone", re.compile(r"(?<![0-9+(])(?=((?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)|[0-9]{2,4})[ .-]?[0-9]{3}[ .-]?[0-9]{4})(?![0-9]))")),
    ("phone", re.compile(r"(?<![0-9])(?=(\+[0-9]{1,3}(?:[ .-]?\(?[0-9]{2,4}\)?){2,5})(?![0-9]))")),
    ("ip", re.compile(r"(?<![0-9])(?=([0-9]{1,3}(?:\.[0-9]{1,3}){3})(?![0-9]))")),
    ("ip", re.compile(r"(?<![0-9A-Fa-f:])(?=((?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}:(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5})?)(?![0-9A-Fa-f:]))")),
    ("email", re.compile(r"(?<![A-Za-z0-9._+-])(?=([A-Za-z0-9._+-]{1,64}\s?(?:[\[({]\s?(?:at|AT)\s?[\])}]|@|\sat\s)\s?[A-Za-z0-9-]{1,63}(?:\s?(?:[\[({]\s?(?:dot|DOT)\s?[\])}]|\s(?:dot|DOT)\s|\.)\s?[A-Za-z0-9-]{2,24}){1,3}))")),
)
#: Words that speak for a kind, and words that speak for some other number.
FOR = {
    "email": ("mail", "contact", "write", "reach", "correo", "courriel", "address"),
    "ip": ("ip", "host", "server", "address", "login", "from", "adresse"),
    "card": ("card", "visa", "credit", "payment", "amex", "karte", "tarjeta", "carte", "paid"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "cell", "telefon", "llame", "appel"),
}
AGAINST = ("version", "release", "isbn", "order", "sku", "serial", "invoice", "id", "section", "build", "sha", "ticket", "part", "case", "doi", "model")


def luhn(digits: str) -> bool:
    """The check sum of card numbers."""
    twice = ("0", "2", "4", "6", "8", "1", "3", "5", "7", "9")
    return (sum(map(int, digits[-1::-2])) + sum(int(twice[int(d)]) for d in digits[-2::-2])) % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, leftmost and not overlapping within a kind; failing matches are dropped."""
    found, done = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            done = m.end()
            found.append((start, 0, done))
        at = text.find("@", max(at + 1, done))
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:] if len(p) > 4 else p) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12 and 12 <= len(d := digits_of(m[0])) <= 19 and luhn(d):
            found.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text) if "+" in text else ():
        if 9 <= len(digits_of(m[0])) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def candidates(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) that the generators propose; they may overlap."""
    found = {(m.start(1), KINDS.index(kind), m.end(1)) for kind, pattern in GENERATORS for m in pattern.finditer(text)}
    return sorted(found)


def described(text: str, span: tuple[int, int, int]) -> list[float]:
    """Format and surroundings of a candidate, as numbers."""
    start, kind, end = span
    said, d = text[start:end], digits_of(text[start:end])
    before, after = text[max(0, start - CONTEXT) : start].lower(), text[end : end + CONTEXT].lower()
    near = re.findall(r"[^\W\d_]+", before)[-4:] + re.findall(r"[^\W\d_]+", after)[:2]
    left, right = text[start - 1 : start], text[end : end + 1]
    groups = re.findall(r"[0-9]+", said)
    parts = [int(g[-6:]) for g in groups]
    tail = re.findall(r"[A-Za-z]+", said)
    return [
        *(float(kind == k) for k in range(len(KINDS))),
        len(said), len(d), len(groups), float(max(map(len, groups), default=0)), float(min(map(len, groups), default=0)), float(max(parts, default=0) <= 255),
        float(12 <= len(d) <= 19 and luhn(d)), float(d[:1] in ("3", "4", "5", "6")), float("+" in said), float("(" in said) - float(")" in said) + 2.0 * ("(" in said and ")" in said),
        float(said.count(" ")), float(said.count("-")), float(said.count(".")), float(said.count(":")), float("@" in said), float(bool(re.search(r"[\[({]\s?at", said, re.I))), float(bool(re.search(r"dot", said, re.I))),
        float(len(tail[-1]) if tail else 0), float(left.isalnum()), float(left in (".", "-", "_", "/", "=", "#", "$")), float(right.isalnum()), float(right in ("-", "_", "/", "%")), float(right == "." and text[end + 1 : end + 2].isdigit()),
        float(any(w.startswith(f) for w in near for f in FOR[KINDS[kind]])), float(any(w in AGAINST for w in near)), float(len(set(d)) <= 2), float(bool(re.search(r"\+[0-9]{1,3}[ .-]?$", before))),
    ]


def examples(n: int = 6000, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Described candidates in made-up sentences: those that a written example stands at are yes, all others no."""
    rnd = random.Random(seed)
    syllables = "an the ing er st or re on en th he ou un der la que os tion mi ka lo".split()
    word = lambda: "".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 4)))
    num = lambda k: "".join(rnd.choice("0123456789") for _ in range(k))

    def card(good: bool) -> str:
        size = rnd.choice((16, 16, 16, 15))
        body = rnd.choice("3456") + num(size - 2)
        last = next(c for c in "0123456789" if luhn(body + c))
        whole = body + (last if good else rnd.choice([c for c in "0123456789" if c != last]))
        sep = rnd.choice(("", "", " ", "-"))
        cuts = (4, 10, 15) if size == 15 else (4, 8, 12, 16)
        return sep.join(whole[a:b] for a, b in zip((0, *cuts), cuts))

    def ip() -> str:
        return ".".join(str(rnd.randint(1, 255)) for _ in range(4))

    def phone() -> str:
        a, b, c = num(3), num(3), num(4)
        return rnd.choice(("({}) {}-{}", "{}-{}-{}", "{}.{}.{}", "+1 ({}) {}-{}", "+1 {} {} {}", "+44 {} {} {}", "({}){}-{}")).format(a, b, c)

    def email() -> str:
        host, top = word(), rnd.choice(("com", "org", "net", "de", "io", "example.com"))
        name = word() + rnd.choice(("", ".", "_")) + rnd.choice((word(), num(2)))
        at, dot = rnd.choice(((" [at] ", " [dot] "), ("[at]", "[dot]"), (" (at) ", " (dot) "), ("(at)", "."), (" at ", " dot "), ("@", ".")))
        return name + at + host + dot + top.replace(".", dot)

    def v6() -> str:
        return ":".join(rnd.choice(("", "0", "2")) + "".join(rnd.choice("0123456789abcdef") for _ in range(rnd.randint(2, 3))) for _ in range(8))

    good = ((2, lambda: card(True)), (1, ip), (1, v6), (3, phone), (0, email))
    bad = (
        lambda: card(False), lambda: num(rnd.randint(12, 19)), lambda: ".".join(num(rnd.randint(1, 2)) for _ in range(rnd.choice((5, 6)))), lambda: f"v{num(1)}.{num(1)}.{num(2)}.{num(1)}", lambda: f"978-{num(1)}-{num(4)}-{num(4)}-{num(1)}",
        lambda: f"{num(4)}-{num(2)}-{num(2)} {num(2)}:{num(2)}:{num(2)}", lambda: f"#{num(10)}", lambda: f"{num(3)}-{num(3)}-{num(5)}", lambda: f"{word()} at {word()}.{word()} {word()}", lambda: f"{word()} at {word()}. {word()}",
        lambda: "".join(rnd.choice("0123456789abcdef") for _ in range(40)), lambda: f"{num(2)}:{num(2)}:{num(2)}", lambda: f"{num(1)}.{num(10)}", lambda: f"{num(4)} {num(4)} {num(4)}", lambda: f"{word()}{num(12)}{word()}", lambda: f"password={num(2)}a{num(9)}",
        lambda: f"{num(3)} {num(3)} {num(4)}", lambda: f"/{num(10)}/", lambda: f"{num(10)}",
    )
    x, y = [], []
    while len(y) < n:
        kind, said = rnd.choice(good)
        is_good = rnd.random() < 0.5
        piece = said() if is_good else rnd.choice(bad)()
        hint = rnd.random()
        lead = rnd.choice(FOR[KINDS[kind]]) + rnd.choice((" ", ": ")) if is_good and hint < 0.4 else rnd.choice(AGAINST) + " " if not is_good and hint < 0.4 else word() + " "
        lead = " ".join(word() for _ in range(rnd.randint(0, 4))) + " " + lead
        # a neighbour that a fixed pattern would run together with it
        trail = rnd.choice((" " + num(rnd.randint(1, 4)) + " ", ". ", " ", ", ", ")")) + " ".join(word() for _ in range(4))
        if is_good and kind in (2, 3) and rnd.random() < 0.3:
            trail = " " + rnd.choice((phone(), card(True), ip())) + trail
        text, start = lead + piece + trail, len(lead)
        for span in candidates(text):
            inside = start <= span[0] and span[2] <= start + len(piece)
            if inside or not is_good and span[0] < start + len(piece) and span[2] > start:
                x.append(described(text, span))
                y.append(float(is_good and span == (start, kind, start + len(piece))))
    return np.array(x), np.array(y)


@lru_cache(maxsize=1)
def detector() -> tuple[boosting.Trees, np.ndarray]:
    """The trees, and for each kind the least probability at which a candidate is taken; three sets of examples, none used twice."""
    (x, y), (held_x, held_y), (own_x, own_y) = examples(6000, 5), examples(3000, 6), examples(4000, 7)
    trees = boosting.fit(x, y, held_x, held_y)
    p, limits = trees.probability(own_x), []
    for k in range(len(KINDS)):
        mine = own_x[:, k] == 1
        right = [v for v in np.unique(p[mine]) if own_y[mine & (p >= v)].mean() >= PRECISION]
        limits.append(max(0.5, min(right, default=1.1)))
    return trees, np.array(limits)


def added_spans(text: str, base: list[tuple[int, int, int]], model: tuple[boosting.Trees, np.ndarray]) -> list[tuple[int, int, int]]:
    """Candidates that the trees take and that touch neither a base span nor a surer one."""
    trees, limits = model
    free = apart_from(candidates(text), base)
    if not free:
        return []
    p = trees.probability(np.array([described(text, s) for s in free]))
    taken: list[tuple[int, int, int]] = []
    for i in sorted(range(len(free)), key=lambda i: (-p[i], -(free[i][2] - free[i][0]), free[i])):
        s = free[i]
        # taken spans never touch each other, so only the neighbours by start can touch this one
        at = bisect_left(taken, s)
        if p[i] >= limits[s[1]] and not (at and taken[at - 1][2] > s[0]) and not (at < len(taken) and taken[at][0] < s[2]):
            taken.insert(at, s)
    return taken


def apart_from(some: list[tuple[int, int, int]], base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The spans that touch none of `base`."""
    if not some or not base:
        return some
    size = max(e for _, _, e in [*some, *base]) + 1
    cover = np.zeros(size + 1, np.int64)
    for b, _, e in base:
        cover[b] += 1
        cover[e] -= 1
    held = np.append(0, np.cumsum(np.cumsum(cover) > 0))
    return [s for s in some if held[s[2]] == held[s[0]]]


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{b}:{e}" for b, k, e in sorted(spans))


def find(docs: DataFrame) -> DataFrame:
    """doc_id, base, added (arrays of kind, start, end) of every whole text of `docs`."""
    arrow_batches(docs.sparkSession)
    model = detector()
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    shown = lambda spans: [{"kind": KINDS[k], "start": b, "end": e} for b, k, e in sorted(spans)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [(base_spans(t), t) if ANY.search(t) else ([], "") for t in b.column("text").to_pylist()]
            base, more = [f for f, _ in found], [added_spans(t, f, model) if t else [] for f, t in found]
            yield pa.record_batch([b.column("doc_id"), pa.array(map(shown, base), span), pa.array(map(shown, more), span)], ["doc_id", "base", "added"])

    rows = texts(docs)
    kind = "array<struct<kind:string,start:int,end:int>>"
    return rows.mapInArrow(tidied(run), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, base {kind}, added {kind}")


def digests(found: DataFrame) -> DataFrame:
    """doc_id, a count for each kind of the base spans, base_sha256, spans (all of them) from find()."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            as_spans = lambda some: [(s["start"], KINDS.index(s["kind"]), s["end"]) for s in some]
            base = [as_spans(x) for x in b.column("base").to_pylist()]
            both = [f + as_spans(x) for f, x in zip(base, b.column("added").to_pylist())]
            counts = [pa.array([sum(k == kind for _, k, _ in f) for f in base], pa.int64()) for kind in range(len(KINDS))]
            shas = pa.array([hashlib.sha256(joined(f).encode()).hexdigest() for f in base], pa.string())
            yield pa.record_batch([b.column("doc_id"), *counts, shas, pa.array(map(joined, both), pa.string())], ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    kind = found.schema["doc_id"].dataType.simpleString()
    return found.mapInArrow(tidied(run), f"doc_id {kind}, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string")
