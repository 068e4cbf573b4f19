"""Personal data: base patterns, and further spans chosen by boosted trees among candidates.

Base spans are what the four patterns find, and always stay. Loose generators propose further spans,
which may overlap each other and the base: obfuscated mail addresses, local phone numbers, card
numbers inside longer runs of digits, spaced addresses. A gradient-boosted ensemble of small trees
scores each candidate by its format and context. It is fitted here, on a bounded sample of rows: base
spans and rewritten forms of them that the base patterns miss are positive; broken forms (a digit
changed so that the check fails, a part out of range, digits missing) and all other candidates of
the sample are negative. Scores are calibrated on held-out examples, and the threshold is the least
one that keeps the wanted precision there. Where accepted candidates overlap, the best one wins;
none may overlap a base span.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.words import ship, shipped, text_slices

KINDS = ("email", "ip", "card", "phone")
OTHER = len(KINDS)
SAMPLE_DOCS = 4000  # expected rows the ensemble is fitted on, of those that hold a candidate
SAMPLE_SPANS = 40  # candidates, and base spans, one sampled row may contribute
PRECISION = 0.99
ROUNDS, RATE, BINS = 40, 0.3, 16

Span = tuple[int, int, int]  # kind, start, end

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A digit before the start would only repeat a failure, so it is ruled out: the work stays linear.
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_MARK = re.compile(r"[@0-9]|[(\[]at[)\]]")
_AT = re.compile(r"\x20?(?:@|\(at\)|\[at\])\x20?")
_LOOSE_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]+)+")
_LOOSE = (
    (1, re.compile(r"(?<![0-9.])[0-9]{1,3}(?:\x20?(?:\.|\[\.\])\x20?[0-9]{1,3}){3}(?![0-9])")),
    (2, re.compile(r"(?<![0-9])[0-9]{13,19}(?![0-9])")),
    (2, re.compile(r"(?<![0-9])[0-9]{4}(?:[\x20.-][0-9]{4}){3}(?![0-9])")),
    (3, re.compile(r"(?:(?<![0-9])[0-9]{1,3}[\x20.-])?(?:\([0-9]{3}\)|(?<![0-9])[0-9]{3})[\x20.-]?[0-9]{3}[\x20.-][0-9]{4}(?![0-9])")),
    (3, re.compile(r"(?<![0-9])00[0-9]{8,13}(?![0-9])")),
)
_HINTS = tuple(re.compile(x) for x in (
    r"mail|contact|write", r"\bip\b|host|server|addr", r"card|visa|credit|konto|tarjeta|carte", r"phone|tel|call|fax|mobil"))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def mails(text: str, at: re.Pattern, domain: re.Pattern) -> Iterator[Span]:
    """Addresses around each sign that stands for @: the local part reaches back to the last match."""
    last = 0
    for sign in at.finditer(text):
        start = sign.start()
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start == sign.start() or not (tail := domain.match(text, sign.end())):
            continue
        yield 0, start, tail.end()
        last = tail.end()


_PLAIN_AT = re.compile("@")


def base_spans(text: str) -> list[Span]:
    """What the four base patterns find, leftmost and non-overlapping within a kind, in order."""
    found = list(mails(text, _PLAIN_AT, _DOMAIN)) if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in m[0].split(".")):
            found.append((1, *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := digits_of(m[0])) <= 19 and luhn(d):
            found.append((2, *m.span()))
    if "+" in text:
        found += [(3, *m.span()) for m in _PHONE.finditer(text) if 9 <= len(digits_of(m[0])) <= 15]
    return found


def candidates(text: str) -> list[Span]:
    found = set(mails(text, _AT, _LOOSE_DOMAIN)) if "@" in text or "at" in text else set()
    for kind, pattern in _LOOSE:
        found.update((kind, *m.span()) for m in pattern.finditer(text))
    return sorted(found)


def features(text: str, span: Span) -> list[float]:
    kind, start, end = span
    own, digits = text[start:end], digits_of(text[start:end])
    before, after = text[max(0, start - 32):start], text[end:end + 8]
    parts = [int(p[:9]) for p in re.findall("[0-9]+", own)]
    tail = re.split(r"[^A-Za-z0-9-]+", own)[-1]
    return [
        *(float(kind == k) for k in range(4)), float(len(own)), float(len(digits)),
        len(digits) / len(own), float(bool(digits) and luhn(digits)), float(max(parts, default=0) <= 255),
        float(len(parts)), float(max(map(len, re.findall("[0-9]+", own)), default=0)),
        float(own.count(" ")), float(sum(own.count(c) for c in "-.")), float("(" in own), float("@" in own),
        float(tail.isalpha() and 2 <= len(tail) <= 6),
        float(before[-1:].isalnum()), float(before[-1:] == "+"), float(before[-1:] in ("-", ".", "/", "=", '"')),
        float(after[:1].isalnum()), float(after[:1] in ("-", "/", '"')), float(after[:1] == "." and after[1:2].isdigit()),
        float(re.search(r"[0-9][\x20-]?\Z", before) is not None), float(re.match(r"[\x20-]?[0-9]", after) is not None),
        *(float(h.search(before.lower()) is not None) for h in _HINTS),
    ]


WIDTH = len(features("1", (1, 0, 1)))


def rewritten(rnd: random.Random, kind: int, own: str) -> list[tuple[str, int]]:
    """Other forms of a base span: (form, 1 if it still is personal data)."""
    digits = digits_of(own)
    if kind == 0:
        user, _, host = own.partition("@")
        site = host.rpartition(".")
        return [(f"{user} [at] {host.replace('.', ' [dot] ')}", 1), (f"{user}(at){host}", 1),
                (f"{user} @ {host}", 1), (f"{user} @ {site[0]} .{rnd.randint(1, 99)}", 0)]
    if kind == 1:
        parts = own.split(".")
        return [(" . ".join(parts), 1), ("[.]".join(parts), 1),
                (" . ".join([str(rnd.randint(256, 999)), *parts[1:]]), 0),
                (".".join([*parts[:3], str(rnd.randint(256, 999))]), 0)]
    if kind == 2:
        spaced = " ".join(digits[i:i + 4] for i in range(0, len(digits), 4))
        wrong = str((int(digits[-1]) + rnd.randint(1, 9)) % 10)
        return [(f"{digits} {rnd.randint(100, 99999)}", 1), (spaced.replace(" ", "."), 1),
                (f"{rnd.randint(1, 99)} {digits}", 1), (digits[:-1] + wrong, 0), (spaced[:-1] + wrong, 0)]
    if len(digits) < 10:
        return []
    area, mid, line = digits[-10:-7], digits[-7:-4], digits[-4:]
    return [(f"({area}) {mid}-{line}", 1), (f"{area}-{mid}-{line}", 1), (f"00{digits[:13]}", 1),
            (f"1-{area}-{mid}-{line}", 1), (f"{area} {mid} {line}{rnd.randint(10, 99)}", 0)]


def drawn(spans: list[Span], most: int, rnd: random.Random) -> list[Span]:
    """At most ``most`` spans, by chance within a kind and as even over the kinds as they allow."""
    if len(spans) <= most:
        return spans
    turn: Counter[int] = Counter()
    order = []
    for span in rnd.sample(spans, len(spans)):
        order.append((turn[span[0]], span))
        turn[span[0]] += 1
    return [span for _, span in sorted(order)[:most]]


def examples(text: str, seed: int, most: int = SAMPLE_SPANS) -> list[tuple[list[float], int]]:
    """Labelled candidates of one text and of its rewritten base spans."""
    rnd = random.Random(seed)
    base = base_spans(text)
    out = []
    for span in drawn(candidates(text), most, rnd):
        inside = any(k == span[0] and a <= span[1] and span[2] <= b for k, a, b in base)
        out.append((features(text, span), int(inside)))
    for kind, start, end in drawn(base, most, rnd):
        before, after = text[max(0, start - 40):start], text[end:end + 40]
        for form, label in rewritten(rnd, kind, text[start:end]):
            made = before + form + after
            for span in candidates(made):
                if span[0] == kind and span[1] < len(before) + len(form) and span[2] > len(before):
                    out.append((features(made, span), label))
    return out


class Tree(NamedTuple):
    """Two levels: ``feature[0] > cut[0]`` chooses the second test, which chooses one of four values."""
    feature: tuple[int, int, int]
    cut: tuple[float, float, float]
    value: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        right = x[:, self.feature[0]] > self.cut[0]
        below = np.where(right, x[:, self.feature[2]] > self.cut[2], x[:, self.feature[1]] > self.cut[1])
        return self.value[2 * right + below]


class Ensemble(NamedTuple):
    start: float
    trees: list[Tree]
    slope: float  # calibration: probability = sigmoid(slope * margin + shift)
    shift: float
    threshold: float

    def probability(self, x: np.ndarray) -> np.ndarray:
        margin = self.start + sum(tree(x) for tree in self.trees)
        return sigmoid(self.slope * margin + self.shift)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def best_split(x: np.ndarray, gradient: np.ndarray, curve: np.ndarray) -> tuple[int, float]:
    best, choice = -1.0, (0, np.inf)
    g, h = gradient.sum(), curve.sum()
    for j in range(x.shape[1]):
        for cut in np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS)))[:-1] if len(x) else ():
            left = x[:, j] <= cut
            gl, hl = gradient[left].sum(), curve[left].sum()
            gain = gl ** 2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1)
            if gain > best:
                best, choice = gain, (j, float(cut))
    return choice


def fit(x: np.ndarray, y: np.ndarray) -> Ensemble | None:
    """Boost on two thirds of the examples, calibrate on the rest. None unless both labels occur."""
    if not len(y) or y.min() == y.max():
        return None
    held = np.arange(len(y)) % 3 == 2
    own_x, own_y = x[~held], y[~held].astype(float)
    rate = np.clip(own_y.mean(), 0.01, 0.99)
    start = float(np.log(rate / (1 - rate)))
    margin, trees = np.full(len(own_y), start), []
    for _ in range(ROUNDS):
        p = sigmoid(margin)
        gradient, curve = own_y - p, p * (1 - p)
        top = best_split(own_x, gradient, curve)
        right = own_x[:, top[0]] > top[1]
        low, high = (best_split(own_x[s], gradient[s], curve[s]) for s in (~right, right))
        below = np.where(right, own_x[:, high[0]] > high[1], own_x[:, low[0]] > low[1])
        leaf = 2 * right + below
        value = np.array([RATE * gradient[leaf == k].sum() / (curve[leaf == k].sum() + 1) for k in range(4)])
        trees.append(Tree((top[0], low[0], high[0]), (top[1], low[1], high[1]), value))
        margin += value[leaf]
    raw = start + sum(tree(x[held]) for tree in trees)
    truth = y[held].astype(float)
    slope, shift = 1.0, 0.0
    for _ in range(200):  # Platt scaling
        error = sigmoid(slope * raw + shift) - truth
        slope -= 0.02 * (error * raw).mean() if len(raw) else 0
        shift -= 0.02 * error.mean() if len(raw) else 0
    p = sigmoid(slope * raw + shift)
    order = np.argsort(-p, kind="stable")
    exact = np.cumsum(truth[order]) / np.arange(1, len(order) + 1)
    good = np.flatnonzero(exact >= PRECISION)
    threshold = max(0.5, float(p[order[good[-1]]])) if len(good) else 1.1
    return Ensemble(start, trees, slope, shift, threshold)


def classes(text: str | None) -> set[int]:
    """The kinds whose base spans a text holds; ``OTHER`` if it holds candidates only."""
    if not text or not _MARK.search(text):
        return set()
    return {kind for kind, _, _ in base_spans(text)} or ({OTHER} if candidates(text) else set())


def shares(sizes: dict[int, int], rows: int) -> dict[int, float]:
    """The part of each class that is sampled: about ``rows`` in all, and small classes whole."""
    out = {}
    for left, (name, n) in zip(range(len(sizes), 0, -1), sorted(sizes.items(), key=lambda x: (x[1], x[0]))):
        taken = min(n, rows / left)
        out[name] = taken / n
        rows -= taken
    return out


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Ensemble | None:
    """Fit on about ``sample_docs`` rows of ``docs`` (doc_id, text), drawn by hash from each kind
    among the rows that hold a base span of it, and from the rows that hold other candidates only."""
    place = F.pmod(F.xxhash64("doc_id", "text", F.lit("pii")), F.lit(1 << 30)) / float(1 << 30)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[int] = Counter()
        for batch in batches:
            for text in batch.column(0):
                found.update(classes(text.as_py()))
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array(list(found.values()), pa.int64())],
                                         names=["class", "n"])

    sizes = {r["class"]: r["n"] for r in docs.select("text").mapInArrow(count, "class int, n bigint")
             .groupBy("class").agg(F.sum("n").alias("n")).collect()}
    if not sizes:
        return None
    part = shares(sizes, sample_docs)
    sample = docs.select("doc_id", "text", place.alias("place")).filter(F.col("place") < max(part.values()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, text, at in zip(*(column.to_pylist() for column in batch.columns)):
                if any(at < part[c] for c in classes(text)) and (made := examples(text, doc or 0)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([doc or 0] * len(made), pa.int64()), pa.array(range(len(made)), pa.int64()),
                         pa.array([m[0] for m in made], pa.list_(pa.float64())),
                         pa.array([m[1] for m in made], pa.int32())],
                        names=["doc_id", "i", "x", "y"])

    rows = sample.mapInArrow(run, "doc_id bigint, i bigint, x array<double>, y int").toPandas() \
        .sort_values(["doc_id", "i"])
    if rows.empty:
        return None
    return fit(np.array(rows["x"].tolist()), rows["y"].to_numpy())


def chosen_spans(text: str, model: Ensemble | None) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans: the base and accepted candidates, ordered by kind and start."""
    if not _MARK.search(text):
        return [], []
    base = base_spans(text)
    if model is None:
        return base, base
    # Spans in order of their starts, and how far those up to each reach: one search per candidate.
    ordered = sorted((a, b) for _, a, b in base)
    starts, reach = [a for a, _ in ordered], list(accumulate((b for _, b in ordered), max))

    def overlaps(span: Span) -> bool:
        before = bisect_left(starts, span[2])
        return before > 0 and reach[before - 1] > span[1]

    free = [s for s in candidates(text) if not overlaps(s)]
    if not free:
        return base, base
    p = model.probability(np.array([features(text, s) for s in free]))
    added: list[tuple[int, int, int]] = []  # (start, end, kind), none over another
    for i in np.argsort(-p, kind="stable"):
        if p[i] < model.threshold:
            break
        kind, start, end = free[i]
        at = bisect_left(added, (end,))
        if at == 0 or added[at - 1][1] <= start:
            insort(added, (start, end, kind))
    return base, sorted(base + [(k, a, b) for a, b, k in added])


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def redacted(text: str, spans: list[Span]) -> str:
    """Each stretch that spans cover becomes the name of its first kind in brackets."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], s[2])):
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    out.append(text[at:])
    return "".join(out)


def find(docs: DataFrame, model: Ensemble | None, redact: bool = False) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans of every row of
    ``docs`` (doc_id, text); with ``redact`` also redacted, and the other columns of ``docs`` first.

    Null and empty texts have no spans. Repeated rows give repeated results. Map only.
    """
    spark = docs.sparkSession
    shared = ship(spark, model)
    inputs = docs if redact else docs.select("doc_id", "text")
    place = inputs.columns.index("text")
    kept_names = inputs.columns if redact else ["doc_id"]
    made = ["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"] + ["redacted"] * redact

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shipped(shared)
        for batch in batches:
            rows = []
            for low, high, data, offsets in text_slices(batch.column(place)):
                raw = data.tobytes()
                for a, b in zip(offsets[:-1], offsets[1:]):
                    text = raw[a:b].decode()
                    base, spans = chosen_spans(text, model)
                    counts = [0, 0, 0, 0]
                    for kind, _, _ in base:
                        counts[kind] += 1
                    rows.append((*counts, hashlib.sha256(written(base).encode()).hexdigest(), written(spans),
                                 *([redacted(text, spans)] if redact else ())))
            kinds = [pa.int64()] * 4 + [pa.string()] * (2 + redact)
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)] if rows else [pa.array([], t) for t in kinds]
            kept = batch.columns if redact else [batch.column(0)]
            yield pa.RecordBatch.from_arrays([*kept, *columns], names=[*kept_names, *made])

    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in inputs.schema.fields) if redact else "doc_id bigint"
    tail = "n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string"
    return inputs.mapInArrow(run, f"{head}, {tail}{', redacted string' if redact else ''}")
