"""Personal data by a semi-Markov conditional random field over fixed base patterns."""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plotwise.llm.words import slices

# The base patterns. Runs are taken whole, as leftmost matching would.
KINDS = ("email", "ip", "card", "phone")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

MAX_ROWS = 2000  # documents that the field is fitted on, at the most
LONGEST = 6  # words of a segment
CONTEXT = 2  # words kept on either side of what may hold an entity
EPOCHS, RATE = 6, 0.3
CUES = {
    "email": {"mail", "email", "e-mail", "contact", "write", "at"},
    "ip": {"ip", "host", "address", "server", "from"},
    "card": {"card", "visa", "credit", "mastercard", "amex", "cc"},
    "phone": {"phone", "tel", "call", "mobile", "fax", "cell", "telephone", "whatsapp"},
}
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base patterns, leftmost non-overlapping per kind.

    An address is found from its @ outwards, which keeps long runs without one linear.
    """
    out, done = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL_CHARS:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append((0, start, domain.end()))
            done = domain.end()
        else:
            done = max(done, at + 1) if start < at else done
        at = text.find("@", max(at + 1, done))
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-9:]) <= 255 for p in m.group().split(".")):
            out.append((1, *m.span()))
    for m in CARD.finditer(text):
        digits = _digits(m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(_digits(m.group())) <= 15:
                out.append((3, *m.span()))
    return out


WORD = re.compile(r"\S+")
HOLDS = re.compile(r"[0-9@]")
TRIM = "\"'`()[]{}<>,;:!?."


def regions(text: str) -> list[list[tuple[int, int]]]:
    """Runs of words that hold a digit or an @, with their neighbours, in order and disjoint."""
    out: list[list[tuple[int, int]]] = []
    if not HOLDS.search(text):
        return out
    words = [m.span() for m in WORD.finditer(text)]
    marked = [i for i, (a, b) in enumerate(words) if HOLDS.search(text, a, b)]
    end = -1
    for i in marked:
        first = max(i - CONTEXT, 0)
        if first <= end:
            out[-1].extend(words[end + 1 : i + CONTEXT + 1])
        else:
            out.append(words[first : i + CONTEXT + 1])
        end = max(end, min(i + CONTEXT, len(words) - 1))
    return out


def _trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    while start < end and text[start] in TRIM and text[start] != "(":
        start += 1
    while start < end and text[end - 1] in TRIM:
        end -= 1
    return start, end


def segment_features(text: str, start: int, end: int, before: str) -> dict[str, float]:
    """What a whole segment looks like, and the word before it."""
    span = text[start:end]
    digits = _digits(span)
    groups = re.findall(r"[0-9]+", span)
    letters = sum(c.isalpha() for c in span)
    found = {
        "bias": 1.0,
        f"digits={min(len(digits), 20)}": 1.0,
        f"groups={min(len(groups), 7)}": 1.0,
        f"words={span.count(' ') + 1}": 1.0,
        f"at={min(span.count('@'), 2)}": 1.0,
    }
    tests = {
        "address": span.count("@") == 1 and LOCAL.match(span.split("@")[0]) and DOMAIN.fullmatch(span.split("@")[1]),
        "four small parts": re.fullmatch(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}", span) and all(int(g) <= 255 for g in groups),
        "card length": 13 <= len(digits) <= 19,
        "luhn": 13 <= len(digits) <= 19 and luhn(digits),
        "plus": span.startswith("+"),
        "double zero": span.startswith("00"),
        "phone length": 8 <= len(digits) <= 15,
        "brackets": "(" in span and ")" in span,
        "letters": letters > 0,
        "mostly letters": letters > len(digits),
        "only digits": span.isascii() and span.isdigit(),
        "phone signs": bool(groups) and not re.search(r"[^0-9+(). -]", span),
        "card signs": bool(groups) and not re.search(r"[^0-9 -]", span),
        "even groups": len(groups) > 2 and len({len(g) for g in groups}) == 1,
        "other signs": bool(re.search(r"[^\w\s@.+()-]", span)),
    }
    found.update((name, 1.0) for name, hit in tests.items() if hit)
    cue = before.strip(TRIM).lower()
    found.update((f"after {kind} cue", 1.0) for kind, words in CUES.items() if cue in words)
    return found


class Field:
    """Weights of (kind, feature); segments without an entity score 0."""

    def __init__(self, weights: dict | None = None):
        self.weights = weights or {}

    def score(self, kind: int, features: dict[str, float]) -> float:
        return sum(v * self.weights.get((kind, name), 0.0) for name, v in features.items())

    def lattice(self, text: str, words: list[tuple[int, int]]):
        """Candidate segments ending at each word: (first word, last word, start, end, features)."""
        out = [[] for _ in words]
        for j in range(len(words)):
            for i in range(max(0, j - LONGEST + 1), j + 1):
                start, end = _trimmed(text, words[i][0], words[j][1])
                if end > start and HOLDS.search(text, start, end):
                    before = text[slice(*words[i - 1])] if i else ""
                    out[j].append((i, j, start, end, segment_features(text, start, end, before)))
        return out

    def decode(self, text: str, words: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
        """The best segmentation: boundaries and kinds chosen together, entities of bounded length."""
        best, back = [0.0], [None]
        for j, segments in enumerate(self.lattice(text, words)):
            top, how = best[j], None
            for i, _, start, end, features in segments:
                for kind in range(len(KINDS)):
                    value = best[i] + self.score(kind, features)
                    if value > top:
                        top, how = value, (i, kind, start, end)
            best.append(top)
            back.append(how)
        spans, j = [], len(words)
        while j:
            how = back[j]
            if how is None:
                j -= 1
            else:
                spans.append((how[1], how[2], how[3]))
                j = how[0]
        return spans[::-1]

    def learn(self, text: str, words, truth: set, past: dict) -> None:
        """One AdaGrad step on the log-likelihood: features of the truth less those expected."""
        lattice = self.lattice(text, words)
        n = len(words)
        scores = [[[self.score(k, s[4]) for k in range(len(KINDS))] for s in segments] for segments in lattice]
        forward = [0.0]
        for j in range(n):
            terms = [forward[j]] + [forward[s[0]] + v for s, each in zip(lattice[j], scores[j]) for v in each]
            high = max(terms)
            forward.append(high + math.log(sum(math.exp(t - high) for t in terms)))
        backward = [0.0] * (n + 1)
        starts: list[list] = [[] for _ in range(n)]
        for j in range(n):
            for s, each in zip(lattice[j], scores[j]):
                starts[s[0]].append((j, each))
        for i in range(n - 1, -1, -1):
            terms = [backward[i + 1]] + [backward[j + 1] + v for j, each in starts[i] for v in each]
            high = max(terms)
            backward[i] = high + math.log(sum(math.exp(t - high) for t in terms))
        slope: dict = {}
        for j in range(n):
            for s, each in zip(lattice[j], scores[j]):
                for kind, v in enumerate(each):
                    share = math.exp(min(forward[s[0]] + v + backward[j + 1] - forward[n], 0.0))
                    gain = ((kind, s[2], s[3]) in truth) - share
                    if abs(gain) > 1e-4:
                        for name, value in s[4].items():
                            slope[kind, name] = slope.get((kind, name), 0.0) + gain * value
        for key, g in slope.items():
            past[key] = past.get(key, 1e-2) + g * g
            self.weights[key] = self.weights.get(key, 0.0) + RATE * g / math.sqrt(past[key])


def fit(texts: list[str], epochs: int = EPOCHS, seed: int = 1) -> Field:
    """Weights learned from the base patterns' own finds in a sample of texts."""
    cases = []
    for text in texts:
        found = base_spans(text)
        for words in regions(text):
            truth = {(k, a, b) for k, a, b in found if words[0][0] <= a and b <= words[-1][1]}
            cases.append((text, words, truth))
    field, past = Field(), {}
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(cases)):
            if len(cases[i][1]) <= 40:
                field.learn(*cases[i], past)
    return field


def spans_of(text: str, field: Field) -> list[tuple[int, int, int]]:
    """Base spans, and decoded ones that touch none of them, by kind and start.

    Regions that base spans explain (every word with a digit or an @ lies in one) hold
    nothing to add and are not decoded.
    """
    base = base_spans(text)
    covered = sorted((a, b) for _, a, b in base)
    added = []
    for words in regions(text):
        open_words = [
            w for w in words if HOLDS.search(text, *w) and not any(a < w[1] and w[0] < b for a, b in covered)
        ]
        if open_words:
            for kind, a, b in field.decode(text, words):
                if not any(x < b and a < y for x, y in covered):
                    added.append((kind, a, b))
    return sorted({*base, *added})


FOUND = "doc_id long, base array<struct<kind:int,start:int,end:int>>, spans array<struct<kind:int,start:int,end:int>>"
SPANS = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))


def _found(weights: dict):
    field = Field(weights)

    def read(batches):
        def rows(spans):
            return [{"kind": k, "start": a, "end": b} for k, a, b in spans]

        for part in slices(batches):
            texts = [t or "" for t in part.column("text").to_pylist()]
            base = [rows(sorted(base_spans(t))) for t in texts]
            spans = [rows(spans_of(t, field)) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(base, SPANS), pa.array(spans, SPANS)], ["doc_id", "base", "spans"]
            )

    return read


def find_personal_data(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_rows: int = MAX_ROWS
) -> DataFrame:
    """One row per document: doc_id, base and spans (arrays of kind, start, end), by kind and start.

    Places are code points, end exclusive; kinds count email, ip, card, phone from 0. The
    base patterns' spans always stay. A semi-Markov field scores whole segments of up to
    six words (digits, groups, check sum, signs, the word before) and a dynamic programme
    chooses boundaries and kinds of a region together; its spans are added where they touch
    no base span. It is fitted on the base spans of a bounded sample of texts, drawn by hash
    of the id, and applied to whole texts; words far from any digit or @ cannot be part of
    an entity and are not scored.

    Null texts are empty and have no spans. Null ids are kept and never drawn. Rows that
    repeat an id are searched each. Other columns are ignored. An empty table gives an empty
    result.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    holding = rows.filter("doc_id is not null and text rlike '[0-9@]'").select("doc_id").distinct()
    drawn = holding.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    sample = rows.join(F.broadcast(drawn), "doc_id").toArrow().sort_by([("doc_id", "ascending"), ("text", "ascending")])
    field = fit([t or "" for t in sample.column("text").to_pylist()])
    return rows.mapInArrow(_found(field.weights), FOUND)
