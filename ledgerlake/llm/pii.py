"""Personal data by fixed patterns and a semi-Markov conditional random field.

The base patterns find e-mail, address, card and phone spans. The random field looks at zones: runs of neighbouring
words with a digit or an ``@``. Inside a zone every span of at most ``MAX_TOKENS`` tokens is a candidate; features of
the whole span score it for each kind, and a dynamic program over the zone's tokens chooses boundaries and kinds
together. Spans it finds away from the base spans are added; base spans stay as they are.

The field is trained on zones from a bounded sample of rows: base spans are the first labels, and rewritten copies
(a phone number without plus, a card in dotted groups, keys after words such as ``token``) teach what the patterns
miss. Null and empty texts have no spans; a text is read whole; repeated rows give equal results.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import thinned, whole_texts

# The base patterns, in the order of kinds. Numbers of an address are read whole, from their first digit on: a match ends
# behind a whole number, so no other match is possible, and a long run of digits is read once. ``_emails`` puts the local part before
# the pattern of its kind.
BASE = {
    "email": re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
LOCAL = string.ascii_letters + string.digits + "._%+-"
KINDS = [*BASE, "secret"]
DIGIT = re.compile(r"[^0-9]")

MAX_TOKENS = 20
SAMPLE_ROWS = 1500
#: A span is added if its probability, given the zone, is at least this.
PROBABILITY = 0.9

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2])
    return (total + sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for d in digits[-2::-2])) % 10 == 0


def _valid(kind: str, found: str) -> bool:
    if kind == "ip":
        return all(int(p.lstrip("0")[:4] or "0") <= 255 for p in found.split("."))
    digits = DIGIT.sub("", found)
    return 12 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 9 <= len(digits) <= 15


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``; what lies between two ``@`` is read once, not from each character on."""
    begin, at = 0, text.find("@")  # begin: behind the last match or the last ``@``
    while at >= 0:
        start = begin + len(text[begin:at].rstrip(LOCAL))
        found = BASE["email"].match(text, at) if start < at else None
        begin = found.end() if found else at + 1
        if found:
            yield start, begin
        at = text.find("@", begin)


def base_spans(text: str) -> list[Span]:
    """Matches of each kind, leftmost first and apart within a kind, by start and kind; a failing one is dropped."""
    spans = []
    for order, (kind, pattern) in enumerate(BASE.items()):
        if kind == "email":
            spans += [(a, order, b, kind) for a, b in _emails(text)]
            continue
        if kind == "phone" and "+" not in text:
            continue
        spans += [(m.start(), order, m.end(), kind) for m in pattern.finditer(text) if _valid(kind, m[0])]
    return [(a, b, kind) for a, _, b, kind in sorted(spans)]


WORD = re.compile(r"\S+")
TRIGGER = re.compile(r"[0-9@]")
TOKEN = re.compile(r"[^\W_]+|\s+|[^\w\s]|_")
# Words before a span that hint at its kind.
HINTS = {"token", "key", "secret", "password", "pwd", "apikey", "api", "auth", "tel", "phone", "telefon", "téléphone", "teléfono", "call", "card", "visa", "karte", "carte", "tarjeta", "mail", "email", "ip"}


@dataclass(frozen=True)
class Zone:
    """A stretch of text with the offset it starts at and the hint words before it."""

    start: int
    text: str
    hints: frozenset[str]


def zones(text: str) -> list[Zone]:
    """Runs of neighbouring words that hold a digit or an ``@``."""
    made: list[Zone] = []
    first = last = None
    before: list[str] = []
    trail: list[str] = []

    def close() -> None:
        if first is not None:
            made.append(Zone(first, text[first:last], frozenset(w for w in trail if w in HINTS)))

    for m in WORD.finditer(text):
        word = m[0]
        if TRIGGER.search(word):
            if first is None:
                first, trail = m.start(), [x for w in before for x in re.findall(r"[^\W\d_]+", w.lower())]
            elif m.start() - last > 1:
                close()
                first, trail = m.start(), []
            last = m.end()
        else:
            close()
            first = last = None
        before = [*before[-2:], word]
    close()
    return made


EMAIL_LIKE = re.compile(r"[\w.%+-]+@[\w-]+(\.[\w-]+)+")
HEX = re.compile(r"[0-9a-fA-F]{16,}")
RUN = re.compile(r"[A-Za-z0-9_\-]{16,}")


def span_features(zone: Zone, a: int, b: int) -> list[str]:
    """Features of the whole span ``zone.text[a:b]``."""
    s = zone.text[a:b]
    digits = DIGIT.sub("", s)
    n = len(digits)
    letters = any(c.isalpha() for c in s)
    before, after = zone.text[a - 1 : a], zone.text[b : b + 1]
    out = ["bias", "digits" + ("0" if not n else "1" if n < 7 else "7" if n < 9 else "9" if n < 12 else "12" if n < 16 else "16" if n < 20 else "20")]
    out.append("clean" if not re.match(r"[\w@+(-]", before or " ") and not re.match(r"[\w@-]|[.][\w]", zone.text[b : b + 2] or " ") else "cut")
    out.append("at" if EMAIL_LIKE.fullmatch(s) else "at?" if "@" in s else "no-at")
    if re.fullmatch(r"\d{1,3}(\.\d{1,3}){3}", s):
        out.append("quad" if _valid("ip", s) else "big-quad")
    if s[0] == "+":
        out.append("plus")
    if re.fullmatch(r"\+?(\d{1,3}[ .-]?)?(\(\d{2,4}\)|\d{2,4})[ .-]\d{3,4}[ .-]\d{3,4}", s):
        out.append("phone-form")
    if re.fullmatch(r"\d{4}([ .-]?)\d{4}(\1\d{4}){1,2}\d{0,3}", s):
        out.append("card-form")
    if 12 <= n <= 19 and not letters:
        out.append("luhn" if luhn(digits) else "no-luhn")
    if letters and "@" not in s:
        out.append("hex" if HEX.fullmatch(s) else "run" if n and RUN.fullmatch(s) else "letters")
    out += [f"sep{c}" for c in " .-(/:" if c in s]
    if before in "\"'" and before and after == before:
        out.append("quoted")
    out += [f"hint-{h}" for h in zone.hints]
    return out


def candidates(zone: Zone) -> tuple[int, list[tuple[int, int, int, int]]]:
    """Number of tokens, and spans ``first token, token after, start, end``.

    A span starts and ends with a token that is no white space, has at most ``MAX_TOKENS`` tokens, and holds an
    ``@``, or at least four digits (nine in a single token), or is a run of 16 or more letters and digits, also
    with ``_`` or ``-`` between them, one of them a digit: what any kind needs.
    """
    tokens = [(m.start(), m.end()) for m in TOKEN.finditer(zone.text)]
    blank = [zone.text[a:b].isspace() for a, b in tokens]
    count = np.cumsum([0] + [sum(c.isdigit() for c in zone.text[a:b]) for a, b in tokens]).tolist()
    ats = np.cumsum([0] + [zone.text[a:b] == "@" for a, b in tokens]).tolist()
    found = []
    for i, (a, _) in enumerate(tokens):
        if blank[i]:
            continue
        for j in range(i + 1, min(len(tokens), i + MAX_TOKENS) + 1):
            if blank[j - 1] or ats[j] - ats[i] > 1 or count[j] - count[i] > 40 and j > i + 1:
                continue
            end = tokens[j - 1][1]
            many = count[j] - count[i] >= 4 and (j - i > 1 or count[j] - count[i] >= 9)
            if ats[j] > ats[i] or many or count[j] > count[i] and end - a >= 16 and RUN.fullmatch(zone.text, a, end):
                found.append((i, j, a, end))
    return len(tokens), found


class Field:
    """Weights by feature and kind; scores, sums and best paths over the spans of a zone."""

    def __init__(self, names: dict[str, int], weights: np.ndarray):
        self.names, self.weights = names, weights

    def scores(self, features: list[list[str]]) -> np.ndarray:
        get = self.names.get
        return np.array([self.weights[[k for f in fs if (k := get(f)) is not None]].sum(axis=0) for fs in features]).reshape(len(features), len(KINDS))

    @staticmethod
    def marginals(n: int, spans: list, scores: np.ndarray) -> np.ndarray:
        """Probability of each span and kind; text outside spans scores zero."""
        ending: list[list[int]] = [[] for _ in range(n + 1)]
        starting: list[list[int]] = [[] for _ in range(n + 1)]
        for k, (i, j, _, _) in enumerate(spans):
            ending[j].append(k)
            starting[i].append(k)
        rows = np.logaddexp.reduce(scores, axis=1) if len(spans) else np.zeros(0)
        ahead, behind = [0.0] * (n + 1), [0.0] * (n + 1)
        for j in range(1, n + 1):
            ahead[j] = _log_sum([ahead[j - 1], *(ahead[spans[k][0]] + rows[k] for k in ending[j])])
        for i in range(n - 1, -1, -1):
            behind[i] = _log_sum([behind[i + 1], *(behind[spans[k][1]] + rows[k] for k in starting[i])])
        outer = np.array([ahead[i] + behind[j] - ahead[n] for i, j, _, _ in spans])
        return np.exp(np.minimum(outer[:, None] + scores, 0)) if len(spans) else scores

    def best(self, zone: Zone, probability: float = PROBABILITY) -> list[Span]:
        """Spans of the best path whose probability is high enough."""
        n, spans = candidates(zone)
        if not spans:
            return []
        scores = self.scores([span_features(zone, a, b) for _, _, a, b in spans])
        kind, gain = scores.argmax(axis=1), scores.max(axis=1)
        best, back = [0.0] * (n + 1), [-1] * (n + 1)
        ending: list[list[int]] = [[] for _ in range(n + 1)]
        for k, (_, j, _, _) in enumerate(spans):
            ending[j].append(k)
        for j in range(1, n + 1):
            best[j] = best[j - 1]
            for k in ending[j]:
                if (value := best[spans[k][0]] + gain[k]) > best[j]:
                    best[j], back[j] = value, k
        if not any(k >= 0 for k in back):
            return []
        chance = self.marginals(n, spans, scores)
        found, j = [], n
        while j > 0:
            k = back[j]
            if k < 0:
                j -= 1
                continue
            i, _, a, b = spans[k]
            if chance[k, kind[k]] >= probability:
                found.append((zone.start + a, zone.start + b, KINDS[kind[k]]))
            j = i
        return found[::-1]


def _log_sum(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))


# Letters and digits of base-62, base-32 and hex keys.
ALPHABETS = [string.ascii_letters + string.digits, string.ascii_uppercase + "234567", string.digits + "abcdef"]


def _examples(rows: list[tuple[str, frozenset[str]]], seed: int = 7) -> list[tuple[Zone, dict[tuple[int, int], str]]]:
    """Zones with their labelled spans: as the base patterns see them, and rewritten."""
    rng, keys, made = random.Random(seed), random.Random(seed + 1), []
    digits = lambda k: "".join(rng.choice("0123456789") for _ in range(k))

    def add(text: str, hints: frozenset[str], spans: dict[tuple[int, int], str]) -> None:
        made.append((Zone(0, text, hints), spans))

    def card() -> str:
        head = "4" + digits(14)
        return next(head + str(d) for d in range(10) if luhn(head + str(d)))

    for text, hints in rows:
        spans = {(a, b): k for a, b, k in base_spans(text)}
        for m in RUN.finditer(text):
            if hints & {"token", "key", "secret", "password", "apikey"} and any(c.isdigit() for c in m[0]):
                spans[m.span()] = "secret"
        apart = sorted(spans)
        if all(x[1] <= y[0] for x, y in zip(apart, apart[1:], strict=False)):
            add(text, hints, spans)
    none: frozenset[str] = frozenset()
    for _ in range(120):  # forms that the patterns do not know, and look-alikes that are nothing
        phone = rng.choice(["({}) {}-{}", "{}-{}-{}", "{}.{}.{}"]).format(digits(3), digits(3), digits(4))
        add(phone, frozenset(rng.sample(["tel", "phone", "call"], 1)), {(0, len(phone)): "phone"})
        whole = "+" + rng.choice(["1 ", "49 ", "33-"]) + phone
        add(whole, none, {(0, len(whole)): "phone"})
        mark, number = rng.choice([".", " ", "-", ""]), card()
        dotted = mark.join(number[k : k + 4] for k in range(0, 16, 4))
        add(dotted, none, {(0, len(dotted)): "card"})
        quad = ".".join(str(rng.randint(1, 255)) for _ in range(4))
        add(quad, none, {(0, len(quad)): "ip"})
        mail = f"{rng.choice('abcxyz')}{digits(2)}@mail{digits(1)}.example.com"
        add(mail, none, {(0, len(mail)): "email"})
        value = "".join(rng.choice("0123456789abcdef") for _ in range(rng.choice([24, 32, 40])))
        if any(c.isdigit() for c in value) and any(c.isalpha() for c in value):
            add(f'"{value}"', frozenset({rng.choice(["token", "key", "secret"])}), {(1, 1 + len(value)): "secret"})
            add(value, none, {})
        alphabet = keys.choice(ALPHABETS)
        value = "".join(keys.choice(alphabet) for _ in range(keys.choice([16, 20, 24, 32, 40])))
        for key in (value, keys.choice(["sk_live_", "ghp_", "sk-", "AKIA", "xoxb-"]) + value):
            if any(c.isdigit() for c in key):
                add(f'"{key}"', frozenset({keys.choice(["token", "key", "secret"])}), {(1, 1 + len(key)): "secret"})
                add(key, frozenset({keys.choice(["token", "key", "secret"])}), {(0, len(key)): "secret"})
                add(key, none, {})
        for nothing in (digits(rng.randint(4, 11)), f"{digits(1)}.{digits(1)}.{digits(2)}", f"20{digits(2)}-0{rng.randint(1, 9)}-1{digits(1)}",
                        f"{digits(3)}.{digits(2)}.{rng.randint(256, 999)}.{digits(2)}", f"{digits(4)} {digits(4)}", f"{digits(3)},{digits(3)}.{digits(2)}"):
            add(nothing, none, {})
        while luhn(bad := digits(16)):
            pass
        add(bad, none, {})
    return made


def train(rows: list[tuple[str, frozenset[str]]], epochs: int = 12, rate: float = 0.4, shrink: float = 1e-4) -> Field:
    """Gradient ascent on the zones' conditional likelihood, with per-weight step sizes."""
    prepared, names = [], {}
    for zone, labels in _examples(rows):
        n, spans = candidates(zone)
        features = [span_features(zone, a, b) for _, _, a, b in spans]
        ids = [np.array([names.setdefault(f, len(names)) for f in fs]) for fs in features]
        seen = np.zeros((len(spans), len(KINDS)))
        for k, (_, _, a, b) in enumerate(spans):
            if (kind := labels.get((a, b))) is not None:
                seen[k, KINDS.index(kind)] = 1
        if spans:
            prepared.append((n, spans, ids, seen))
    weights = np.zeros((len(names), len(KINDS)))
    if "bias" in names:
        weights[names["bias"]] = -2.0
    pace = np.full_like(weights, 1e-2)
    order = random.Random(3)
    for _ in range(epochs):
        order.shuffle(prepared)
        for n, spans, ids, seen in prepared:
            scores = np.array([weights[i].sum(axis=0) for i in ids])
            gap = seen - Field.marginals(n, spans, scores)
            for i, g in zip(ids, gap, strict=True):
                if np.abs(g).max() > 1e-3:
                    pace[i] += g * g
                    weights[i] += rate * (g / np.sqrt(pace[i]) - shrink * weights[i])
    return Field(names, weights)


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Field:
    """Train on the zones of at most ``sample_rows`` rows with a digit or ``@``, lowest hash of the id first.

    The driver gets the zones (at most 60 a row), not the texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [z for t in batch.column(1).to_pylist() for z in zones(t)[:60] if len(z.text) <= 400]
            yield pa.RecordBatch.from_arrays([pa.array([z.text for z in found], pa.string()), pa.array([sorted(z.hints) for z in found], pa.list_(pa.string()))], names=["zone", "hints"])

    texts = whole_texts(docs)
    few = texts.where(thinned(F.col("doc_id"), 8 * sample_rows, docs.count()) & F.col("text").rlike("[0-9@]"))
    some = few.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    rows = some.mapInArrow(run, "zone string, hints array<string>").distinct().orderBy(F.xxhash64("zone", "hints"), "zone").limit(2 * sample_rows).collect()
    return train([(r["zone"], frozenset(r["hints"])) for r in rows])


def all_spans(text: str, field: Field) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans by start and kind."""
    if not TRIGGER.search(text):
        return [], []
    base = base_spans(text)
    added = [(a, b, k) for z in zones(text) for a, b, k in field.best(z) if not any(x < b and a < y for x, y, _ in base)] if text else []
    return base, sorted(base + added, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def _listed(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def find(docs: DataFrame, field: Field, key: str = "doc_id") -> DataFrame:
    """Counts of base spans, digest of the base spans and all spans of every row."""
    names = [key, "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [all_spans(t, field) for t in batch.column(1).to_pylist()]
            counts = [pa.array([sum(s[2] == kind for s in base) for base, _ in made], pa.int64()) for kind in BASE]
            digest = pa.array([hashlib.sha256(_listed(base).encode()).hexdigest() for base, _ in made], pa.string())
            listed = pa.array([_listed(spans) for _, spans in made], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *counts, digest, listed], names=names)

    fields = ", ".join([f"{key} long", *(f"n_{k} long" for k in BASE), "base_sha256 string", "spans string"])
    return whole_texts(docs, key).mapInArrow(run, fields)


def redact(text: str, field: Field) -> str:
    """The text with every span replaced by its kind in angle brackets; of overlapping spans the first stands for all."""
    out, at = [], 0
    for a, b, kind in all_spans(text, field)[1]:
        if a >= at:
            out += [text[at:a], f"<{kind}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, field: Field) -> DataFrame:
    """All rows and columns of ``docs``, personal data in ``text`` replaced; a null text stays null."""
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if t is None else redact(t, field) for t in batch.column(place).to_pylist()]
            columns = list(batch.columns)
            columns[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(run, docs.schema)
