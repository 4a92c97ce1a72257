"""Personal data: high-recall span candidates, boosted trees over format and context, calibrated thresholds.

1. Generators propose overlapping spans of each kind: all matches of the base patterns; addresses with a
   spelled-out at or dot, with a domain of two labels, three and so on; dotted quads with guarded dots and
   IPv6; every run of neighbouring digit groups that could be a phone or card number.
2. Gradient-boosted trees score every candidate from its format and its surroundings. They are fitted on the
   documents themselves: candidates of about ``SAMPLE_DOCS`` of them, drawn by a hash of the id, at most
   ``MOST_EXAMPLES`` of these. Labels are weak: a base match is personal data, and so is its respelling in
   another format in its own place; a candidate that fails its kind's check beside no base match is not;
   what neither rule knows is left out. ``GENERATED`` seeded lines make the start where a table has few.
3. Each kind's threshold is the lowest (in the middle of the gap between scores) at which, on documents and lines held out from the fit, at least
   ``PRECISION`` of the accepted are personal data; :func:`quality_by_kind` reports precision and recall there.
4. Base spans stay whatever their score. Of the others, those that pass join in order of their score where
   they overlap nothing taken before.

Defined results: a null or empty text has no spans; a long text is searched whole, in linear time; repeated
rows each give their row; a null doc_id gives its row; other columns, whatever their names, are ignored; an
empty table gives an empty result (the trees are then those of the generated lines).
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldmark.llm import boosting
from foldmark.llm.common import column_or_null, map_arrow

KINDS = ("email", "ip", "card", "phone")
SAMPLE_DOCS, MOST_EXAMPLES, GENERATED, PRECISION = 20_000, 20_000, 3000, 0.98
LABELS = 5  # of a domain, after which only the whole one is a candidate
Span = tuple[int, int]
Candidate = tuple[str, int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(\.[A-Za-z0-9-]++)+")
# possessive and anchored at the start of a run of digits: the same matches in linear time
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")

_NEEDS_ARROW = r"[0-9@:]|[\[({ ]at[\])} ]"
_AT = re.compile(r"[ ]?(?:@|\[at\]|\(at\)|\{at\})[ ]?|[ ]at[ ]", re.IGNORECASE)
_LABEL = re.compile(r"[A-Za-z0-9-]++")
_DOT = re.compile(r"[ ]?(?:\[dot\]|\(dot\)|\{dot\})[ ]?|[ ]dot[ ]|\.", re.IGNORECASE)
_QUAD = re.compile(r"(?<![0-9.])[0-9]{1,3}(?:[ ]?(?:\[\.\]|\(\.\)|\[dot\]|\(dot\)|\.)[ ]?[0-9]{1,3}){3}(?![0-9])", re.IGNORECASE)
_SIX = re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])")
_DIGITS = re.compile(r"[0-9]++")
_BETWEEN = re.compile(r"[ ().\-/_]{1,3}\Z")

# words that speak for or against a kind, near a candidate
_CONTEXT = (
    re.compile(r"\b(?:tel|phone|call|mobile|cell|fax|dial|ring|telefon|téléphone|teléfono|handy)", re.IGNORECASE),
    re.compile(r"\b(?:card|visa|credit|debit|mastercard|karte|carte|tarjeta)", re.IGNORECASE),
    re.compile(r"\b(?:ip|host|server|addr|login|logged)", re.IGNORECASE),
    re.compile(r"\b(?:mail|contact|write|reach|email|kontakt|correo|courriel)", re.IGNORECASE),
    re.compile(r"\b(?:order|invoice|isbn|version|page|date|total|tracking|serial|part|ref|sku|item|no|id)\b", re.IGNORECASE),
    re.compile(r"[$€£%]"),
)


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        if k % 2:
            v = v * 2 - 9 * (v > 4)
        total += v
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """Leftmost matches of the base pattern, each ``@`` looked at once."""
    taken, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > taken and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            taken = found.end()
            yield start, taken
        else:
            taken = max(taken, at + 1)  # no later local part holds this @
        at = text.find("@", max(at + 1, taken))


def base_spans(text: str) -> dict[str, list[Span]]:
    out: dict[str, list[Span]] = {k: [] for k in KINDS}
    if "@" in text:
        out["email"] = list(_emails(text))
    out["ip"] = [m.span() for m in _IP.finditer(text) if all(len(x.lstrip("0")) <= 3 and int(x[-18:]) <= 255 for x in m.group().split("."))]
    for m in _CARD.finditer(text):
        if 14 <= m.end() - m.start() and 14 <= len(d := _NOT_DIGIT.sub("", m.group())) <= 19 and luhn(d):
            out["card"].append(m.span())
    if "+" in text:
        out["phone"] = [m.span() for m in _PHONE.finditer(text) if 10 <= len(_NOT_DIGIT.sub("", m.group())) <= 15]
    return out


def _address_candidates(text: str) -> Iterator[Candidate]:
    """The whole run of signs before each at, with the first labels after it, two to ``LABELS`` of them, and with all."""
    for at in _AT.finditer(text):
        start = at.start()
        while start and text[start - 1] in _LOCAL:
            start -= 1
        label = _LABEL.match(text, at.end()) if start < at.start() else None
        labels, end = 0, 0
        while label:
            labels, end = labels + 1, label.end()
            if 1 < labels <= LABELS:
                yield "email", start, end
            dot = _DOT.match(text, end)
            label = _LABEL.match(text, dot.end()) if dot else None
        if labels > LABELS:
            yield "email", start, end


@lru_cache(4)
def _runs(text: str) -> tuple[list[Span], list[int], list[int]]:
    """Groups of digits, and of each the numbers of the first and the last group of the run that it stands in."""
    groups = [m.span() for m in _DIGITS.finditer(text)]
    first, last = list(range(len(groups))), list(range(len(groups)))
    near = [k > 0 and s - groups[k - 1][1] <= 3 and bool(_BETWEEN.match(text, groups[k - 1][1], s)) for k, (s, _) in enumerate(groups)]
    for k in range(1, len(groups)):
        first[k] = first[k - 1] if near[k] else k
    for k in range(len(groups) - 2, -1, -1):
        last[k] = last[k + 1] if near[k + 1] else k
    return groups, first, last


def _place_in_run(text: str, start: int, end: int, n: int) -> tuple[float, float]:
    """How many groups of its run stand before a span of ``n`` groups, and after it, beyond whole spans of as many."""
    groups, first, last = _runs(text)
    a, b = bisect_left(groups, (start, 0)), bisect_left(groups, (end, 0)) - 1
    return (float((a - first[a]) % n), float((last[b] - b) % n)) if n else (0.0, 0.0)


def _number_candidates(text: str) -> Iterator[Candidate]:
    """Digit groups that stand apart by at most three marks; a few candidates for each group, however many follow."""
    groups = _runs(text)[0]
    for first, (start, end) in enumerate(groups):
        if start and (text[start - 1].isalnum() or text[start - 1] == "_"):
            continue
        lead = 1 if start and text[start - 1] in "+(" else 0
        n, before = 0, start
        for last in range(first, len(groups)):
            s, e = groups[last]
            if last > first and (s - before > 3 or e - s < 2 or not _BETWEEN.match(text, before, s)):
                break
            n, before = n + e - s, e
            if n > 19:
                break
            if not text[e : e + 1].isalnum():
                if 7 <= n <= 15 and (last > first or n >= 8):
                    yield "phone", start - lead, e
                if 13 <= n and (last == first or e - s >= 3):
                    yield "card", start, e


def candidates(text: str) -> list[Candidate]:
    """Overlapping spans of all generators, without the base matches."""
    out = list(_address_candidates(text))
    out += [("ip", *m.span()) for p in (_QUAD, _SIX) for m in p.finditer(text)]
    out += _number_candidates(text)
    return list(dict.fromkeys(out))


def features(text: str, kind: str, start: int, end: int) -> list[float]:
    span, before, after = text[start:end], text[max(0, start - 40) : start], text[end : end + 24]
    runs = _DIGITS.findall(span)
    groups = [len(g) for g in runs]
    digits = "".join(runs)
    tail = re.split(r"[^A-Za-z0-9]+", span)[-1]
    return [
        *(float(kind == k) for k in KINDS),
        len(span), len(digits), len(groups), max(groups, default=0), min(groups, default=0), groups[0] if groups else 0, groups[-1] if groups else 0,
        float(luhn(digits)) if 12 <= len(digits) <= 19 else -1.0,
        float("(" in span), float(span.startswith("00")), float(span.startswith("0")), float("+" in span or before[-1:] == "+"),
        float(span.count(".")), float(span.count("-")), float(span.count(" ")), float("/" in span), float("_" in span), float(span.count(":")),
        float(max((int(g[-9:]) for g in runs), default=0) <= 255),
        len(set(digits)) / max(1, len(digits)),
        float(bool(re.search(r"[\[({](?:at|dot|\.)[\])}]", span, re.IGNORECASE))), float("@" in span), float(" at " in span.lower()), float(" dot " in span.lower()),
        float(tail.isalpha() and 2 <= len(tail) <= 4), float(len(tail)), float(tail[:1].isupper() and not tail.isupper()),
        *(float(bool(p.search(before))) for p in _CONTEXT), *(float(bool(p.search(after))) for p in _CONTEXT),
        float((before + " " + after).count("|")), float(before[-1:].isalnum()), float(after[:1].isalnum()), float(bool(re.match(r"[ ().\-/_]{0,3}[0-9]", after))), float(bool(re.search(r"[0-9][ ().\-/_]{0,3}\Z", before))),
        *_place_in_run(text, start, end, len(groups)),
    ]


def valid(text: str, kind: str, start: int, end: int) -> bool:
    """What a respelled match must still fulfil: digits, range, checksum."""
    span = text[start:end]
    runs = _DIGITS.findall(span)
    digits = "".join(runs)
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 9 <= len(digits) <= 15
    if kind == "ip":
        return span.count(":") >= 3 or len(runs) == 4 and all(int(r) <= 255 for r in runs)
    tail = re.split(r"[^A-Za-z0-9]+", span)[-1]
    return tail.isalpha() and len(tail) >= 2


def respelled(rng: random.Random, kind: str, span: str) -> str:
    """A base match in a format that the base patterns do not know."""
    digits = _NOT_DIGIT.sub("", span)
    if kind == "email":
        at, dot = rng.choice([("[at]", "[dot]"), ("(at)", "(dot)"), (" [at] ", " [dot] "), (" at ", " dot "), (" @ ", "."), (" (at) ", ".")])
        local, domain = span.split("@", 1)
        return local + at + domain.replace(".", dot)
    if kind == "ip":
        return span.replace(".", rng.choice(["[.]", "(.)", " . ", "[dot]"]))
    if kind == "card":
        s = rng.choice("./_")
        return s.join(digits[k : k + 4] for k in range(0, len(digits), 4))
    national = digits[-10:] if len(digits) > 10 else digits
    s = rng.choice([" ", "-", ".", "/"])
    return rng.choice([
        f"({national[:3]}) {national[3:6]}-{national[6:]}", f"{national[:3]}{s}{national[3:6]}{s}{national[6:]}", f"0{national[:3]}{s}{national[3:]}",
        f"00{rng.choice(['1', '33', '49', '34'])} {national[:3]} {national[3:6]} {national[6:]}", " ".join(("0" + national[1:])[k : k + 2] for k in range(0, 10, 2)),
    ])


Example = tuple[str, int, list[float]]  # kind, label, features


def weak_examples(text: str, rng: random.Random) -> list[Example]:
    """Labelled candidates of one text, by the rules of the module."""
    base = base_spans(text)
    out: list[Example] = []
    taken = bytearray(len(text))
    for kind in KINDS:
        for s, e in base[kind]:
            taken[s:e] = b"\1" * (e - s)
            out.append((kind, 1, features(text, kind, s, e)))
            for _ in range(2):
                put = respelled(rng, kind, text[s:e])
                near = text[max(0, s - 80) : s] + put + text[e : e + 80]
                at = s - max(0, s - 80)
                for c in candidates(near):
                    if c[0] == kind and c[1:] == (at, at + len(put)):
                        out.append((kind, 1, features(near, *c)))
                    elif c[1] < at + len(put) and at < c[2] and (c[0] != "phone" or kind != "phone"):
                        out.append((c[0], 0, features(near, *c)))  # a part of it, or another kind
    for kind, s, e in candidates(text):
        if taken.find(1, s, e) < 0 and not valid(text, kind, s, e):
            out.append((kind, 0, features(text, kind, s, e)))
            if kind == "card" and len(digits := _NOT_DIGIT.sub("", text[s:e])) == 16:
                put = respelled(rng, "card", digits)
                near = text[max(0, s - 80) : s] + put + text[e : e + 80]
                out.append((kind, 0, features(near, kind, s - max(0, s - 80), s - max(0, s - 80) + len(put))))
    return out


def listed(rng: random.Random, kind: str) -> list[Example]:
    """The labelled candidates of some numbers in one format, one after the other: these, and none across them."""
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    way, between, text, right = rng.random(), rng.choice([" ", " ", ", ", " / "]), rng.choice(["", "numbers: ", "call ", "list "]), set()
    blank = kind == "phone" and rng.random() < 0.4  # nothing but blanks within and between: the place in the run tells
    for _ in range(rng.randint(2, 12)):
        digits = "+1" + d(10)
        if kind == "card":
            digits = d(16)
            while not luhn(digits):
                digits = d(16)
        put = f"{digits[2:5]} {digits[5:8]} {digits[8:]}" if blank else respelled(random.Random(way), kind, digits)
        right.add((kind, len(text), len(text) + len(put)))
        text += put + (" " if blank else between)
    return [(c[0], int(c in right), features(text, *c)) for c in candidates(text)]


def generated(rng: random.Random) -> list[Example]:
    """The labelled candidates of a made-up line around one span that is personal data or looks like it."""
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    w = lambda: "".join(rng.choice("aeinorstlmdkup") for _ in range(rng.randint(2, 8)))
    kind, good = rng.choice(KINDS), rng.random() < 0.5
    if good and kind in ("phone", "card") and rng.random() < 0.5:
        return listed(rng, kind)
    if kind == "phone":
        base = "+" + rng.choice(["1", "49", "33", "34"]) + d(10)
        body = respelled(rng, kind, base) if good else rng.choice([
            f"{d(2)}.{d(2)}.{rng.choice(['19', '20'])}{d(2)}", f"{rng.choice(['19', '20'])}{d(2)}-{d(2)}-{d(2)}", f"{d(4)} {d(4)}", f"{d(3)} {d(3)} {d(3)}", f"{d(8)}", f"{d(10)}", f"{d(13)}", f"978-{d(1)}-{d(4)}-{d(4)}-{d(1)}", f"{d(2)}/{d(3)}/{d(3)}", f"{d(3)}.{d(3)}.{d(3)}",
        ])
        lead = rng.choice(["call", "phone:", "tel.", "mobile", "fax", "telefon", "téléphone", w()]) if good else rng.choice(["order", "invoice", "total", "$", "isbn", "page", "date", w(), w()])
    elif kind == "card":
        digits = d(16)
        while good != luhn(digits):
            digits = d(16)
        body, lead = respelled(rng, kind, digits), rng.choice(["card", "visa", "credit", w()] if good else ["serial", "ref", "tracking", w()])
    elif kind == "ip":
        body = respelled(rng, kind, ".".join(str(rng.randint(0, 255) if good else rng.randint(200, 999)) for _ in range(4)))
        if rng.random() < 0.2:
            hexes = ["".join(rng.choice("0123456789abcdef") for _ in range(4)) for _ in range(8)]
            body = ":".join(hexes) if good else f"{d(2)}:{d(2)}:{d(2)}"
        lead = rng.choice(["host", "ip", "server", "from", w()]) if good else rng.choice(["version", "item", "time", w()])
    else:
        body = respelled(rng, kind, f"{w()}{rng.choice(['', '.', '_'])}{w()}@{w()}.{rng.choice(['com', 'org', 'net', 'de', 'fr', 'es'])}") if good else rng.choice([f"{w()} at {w()}.{rng.choice('0123456789')}", f"{w()} @ {w()}. {w().title()}", f"{w()} at {w()}.{w().title()}{w()}", f"{w()} @ {d(2)}.{d(2)}"])
        lead = rng.choice(["mail", "contact", "write to", w()]) if good else rng.choice([w(), "page"])
    head = f"{w()} {w()} {lead} "
    text = f"{head}{body} {w()} {w()}."
    out = []
    for c in candidates(text):
        exact = c[0] == kind and c[1:] == (len(head), len(head) + len(body))
        if exact or not good or c[0] != "phone" or kind != "phone":
            out.append((c[0], int(good and exact), features(text, *c)))
    return out


@dataclass
class Fitted:
    trees: boosting.Boosted
    limits: dict[str, float]
    quality: list[tuple[str, float, float, float, int, int]]  # kind, threshold, precision, recall, held-out positives and negatives


def fit(examples: list[tuple[bool, Example]], precision: float = PRECISION) -> Fitted:
    """Trees and thresholds from ``(held out, example)``."""
    held = np.array([h for h, _ in examples])
    kinds, y = np.array([e[0] for _, e in examples]), np.array([e[1] for _, e in examples], float)
    x = np.array([e[2] for _, e in examples])
    trees = boosting.fit(x[~held], y[~held])
    score, limits, quality = trees.proba(x[held]), {}, []
    for kind in KINDS:
        own = kinds[held] == kind
        s, t = score[own], y[held][own]
        order = np.argsort(-s, kind="stable")
        s, t = s[order], t[order]
        right = np.cumsum(t)
        ends = np.flatnonzero(np.append(s[1:] != s[:-1], True)) if len(s) else np.zeros(0, int)  # ties are accepted together
        good = [k for k in ends if right[k] >= precision * (k + 1)]
        # in the middle of the gap below the last one accepted
        limits[kind] = float(s[good[-1]] + (s[good[-1] + 1] if good[-1] + 1 < len(s) else 0.0)) / 2 if good else 2.0
        taken = s >= limits[kind]
        quality.append((kind, limits[kind], float(t[taken].mean()) if taken.any() else 1.0, float(t[taken].sum() / max(1.0, t.sum())), int(t.sum()), int((1 - t).sum())))
    return Fitted(trees, limits, quality)


def _sampled_examples(docs: DataFrame, most: int) -> list[tuple[bool, Example]]:
    """Weak examples of a sample of ``docs`` (doc_id, text): a bounded number, in order of a hash."""
    n = docs.count()
    bar = 1 << 20 if n <= SAMPLE_DOCS else SAMPLE_DOCS * (1 << 20) // n + 1
    who = F.xxhash64("doc_id", F.length("text"))
    rows = docs.withColumn("who", who).where(F.expr(f"pmod(who, {1 << 20}) < {bar}")).select("who", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            maybe = pc.fill_null(pc.match_substring_regex(batch.column(1), _NEEDS_ARROW, ignore_case=True), False).to_numpy(zero_copy_only=False)
            for k in np.flatnonzero(maybe):
                h = batch.column(0)[k].as_py()
                out += [(h, at, *e) for at, e in enumerate(weak_examples(batch.column(1)[k].as_py(), random.Random(h)))]
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            kinds = [pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.list_(pa.float64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["who", "at", "kind", "label", "x"])

    found = map_arrow(rows, run, "who long, at int, kind string, label int, x array<double>").orderBy(F.xxhash64("who", "at"), "who", "at").limit(most).collect()
    return [((r.who >> 7) % 4 == 0, (r.kind, r.label, list(r.x))) for r in found]


def fit_pii(docs: DataFrame, most: int = MOST_EXAMPLES, lines: int = GENERATED, seed: int = 7) -> Fitted:
    """Trees and thresholds for ``docs``: at most ``most`` weak examples of theirs and those of ``lines`` generated lines."""
    rng = random.Random(seed)
    made = [(k % 4 == 0, e) for k in range(lines) for e in generated(rng)]
    return fit(made + _sampled_examples(_only(docs), most))


def quality_by_kind(fitted: Fitted, spark: SparkSession) -> DataFrame:
    """``kind, threshold, precision, recall, n_positive, n_negative`` on what was held out from the fit."""
    return spark.createDataFrame(fitted.quality, "kind string, threshold double, precision double, recall double, n_positive int, n_negative int")


def find(text: str, fitted: Fitted | None) -> tuple[dict[str, list[Span]], list[tuple[int, int, str]]]:
    """Base spans by kind, and all spans in order of start, then kind as listed; the base alone without ``fitted``."""
    base = base_spans(text)
    chosen = [(s, e, k) for k in KINDS for s, e in base[k]]
    proposed = candidates(text) if fitted else []
    if proposed:
        taken = bytearray(len(text))
        for s, e, _ in chosen:
            taken[s:e] = b"\1" * (e - s)
        proposed = [c for c in proposed if taken.find(1, c[1], c[2]) < 0]
    if proposed:
        score = fitted.trees.proba(np.array([features(text, *c) for c in proposed]))
        for p, _, (kind, s, e) in sorted(zip(-score, (c[1] - c[2] for c in proposed), proposed, strict=True)):
            if -p >= fitted.limits[kind] and taken.find(1, s, e) < 0:
                taken[s:e] = b"\1" * (e - s)
                chosen.append((s, e, kind))
    chosen.sort(key=lambda c: (c[0], KINDS.index(c[2])))
    return base, chosen


def _joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def _only(docs: DataFrame) -> DataFrame:
    return docs.select(column_or_null(docs, "doc_id", T.LongType()).alias("doc_id"), column_or_null(docs, "text", T.StringType()).alias("text"))


_SCHEMA = pa.schema([("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()), ("spans", pa.string()), ("n_added", pa.int64())])


def find_pii(docs: DataFrame, fitted: Fitted | None = None) -> DataFrame:
    """Spans of personal data in ``docs`` (doc_id, text): counts and digest of base spans, all spans, how many were added."""
    sent = docs.sparkSession.sparkContext.broadcast(fitted or fit_pii(docs))  # some kilobytes, whatever the input
    nothing = hashlib.sha256(b"").hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            maybe = pc.fill_null(pc.match_substring_regex(texts, _NEEDS_ARROW, ignore_case=True), False).to_numpy(zero_copy_only=False)
            rows = [(0, 0, 0, 0, nothing, "", 0)] * len(ids)
            for k in np.flatnonzero(maybe):
                base, spans = find(texts[k].as_py(), sent.value)
                flat = sorted(((s, e, kind) for kind in KINDS for s, e in base[kind]), key=lambda c: (c[0], KINDS.index(c[2])))
                rows[k] = (*(len(base[kind]) for kind in KINDS), hashlib.sha256(_joined(flat).encode()).hexdigest(), _joined(spans), len(spans) - len(flat))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, f.type) for c, f in zip(columns, list(_SCHEMA)[1:], strict=True))], schema=_SCHEMA)

    return map_arrow(_only(docs), run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")


def redact(text: str, spans: str) -> str:
    """``text`` with each span of the ``spans`` string replaced by its kind."""
    out, at = [], 0
    for part in filter(None, spans.split(",")):
        kind, s, e = part.split(":")
        if int(s) >= at:
            out += [text[at : int(s)], f"[{kind}]"]
            at = int(e)
    return "".join([*out, text[at:]])


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(spark.read.parquet(f"{sf_dir}/documents.parquet"))
