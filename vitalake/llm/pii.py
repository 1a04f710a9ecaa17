"""PII with offset-preserving deobfuscation.

The base detectors run on the source text.  A chain of rewriting transducers
then undoes disguises: invisible characters go, look-alike letters, digits and
signs become ASCII, spelled digits become digits, bracketed or spelled ``at``
and ``dot`` become signs.  Each character of the normalised text carries the
source range it stands for, so what the same detectors find there is mapped
back to source offsets.  A found span is added if at least one of its
characters was rewritten and it overlaps no base span of its kind.

Rows: null texts are empty; very long texts are read whole; repeated rows are
treated alike; columns other than id and text are not read, whatever they are
called; an empty table gives no rows.  Offsets are code points, ends exclusive.  The counts of
``op5_pii`` are those of the base spans; ``n_added`` counts the others.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import arrow_map, column, documents, texts

KINDS = ("email", "ip", "card", "phone")

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a match can only begin where a run of digits does, so the look-behind changes no match and keeps long runs linear
#: every address and card lies within one of these
_NUMBERS = re.compile(r"[0-9][0-9.\x20-]{5,}")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

Span = tuple[int, int]


def emails(text: str) -> Iterator[Span]:
    last = 0
    for m in _DOMAIN.finditer(text):
        a = m.start()
        while a > last and text[a - 1] in _LOCAL:
            a -= 1
        if a < m.start():
            yield a, m.end()
            last = m.end()


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def detect(text: str) -> dict[str, list[Span]]:
    """Spans of each kind, leftmost and non-overlapping."""
    found: dict[str, list[Span]] = {k: [] for k in KINDS}
    if "@" in text:
        found["email"] = list(emails(text))
    for chunk in _NUMBERS.finditer(text):
        a, b = chunk.span()
        for m in _IP.finditer(text, a, b):
            if all(len(p) <= 3 and int(p) <= 255 for p in (x.lstrip("0") or "0" for x in m[0].split("."))):
                found["ip"].append(m.span())
        if b - a >= 16:
            for m in _CARD.finditer(text, a, b):
                if m.end() - m.start() >= 16:
                    digits = m[0].replace(" ", "").replace("-", "")
                    if 16 <= len(digits) <= 19 and luhn(digits):
                        found["card"].append(m.span())
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                found["phone"].append(m.span())
    return found


# Characters that look like an ASCII one.
LOOKALIKES = {
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "У": "Y", "Ѕ": "S", "І": "I", "Ј": "J",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "ο": "o", "ν": "v", "α": "a", "ι": "i", "κ": "k", "ρ": "p", "υ": "u", "ı": "i", "ɑ": "a", "ɡ": "g",
    "․": ".", "。": ".", "｡": ".", "‧": ".", "·": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "−": "-", " ": " ", " ": " ", " ": " ",
}
INVISIBLE = "­​‌‍‎‏⁠﻿"
# The digits 0 to 9 in English, German, French and Spanish.
DIGIT_WORDS = [
    "zero one two three four five six seven eight nine",
    "null eins zwei drei vier fünf sechs sieben acht neun",
    "zéro un deux trois quatre cinq six sept huit neuf",
    "cero uno dos tres cuatro cinco seis siete ocho nueve",
]
_DIGIT = {w: str(k) for words in DIGIT_WORDS for k, w in enumerate(words.split())}
_D = "(?:" + "|".join(sorted(_DIGIT, key=len, reverse=True)) + "|[0-9])"
_SPELLED = re.compile(rf"\b{_D}(?:[\s,_-]+{_D}){{2,}}\b", re.I)
_TOKEN = re.compile(rf"{_D}", re.I)
_LETTERS = re.compile(r"[^\W\d_]+")
_PLUS = re.compile(r"\bplus\s+(?=[0-9])", re.I)
_POINT = re.compile(r"(?<=[0-9])\s+(?:dot|point|punkt|punto)\s+(?=[0-9])", re.I)
_OPEN, _CLOSE = r"[\[({<]", r"[\])}>]"
_AT = re.compile(rf"\s*{_OPEN}\s*(?:at|@|arroba)\s*{_CLOSE}\s*", re.I)
_DOT = re.compile(rf"\s*{_OPEN}\s*(?:dot|\.|punkt|punto|point)\s*{_CLOSE}\s*", re.I)
# Four numbers of one to three digits, spelled or not, with dots between them, spelled or not.
_OCTET = rf"(?:[0-9]{{1,3}}|{_D}(?:[\s,_-]+{_D}){{0,2}})"
_BETWEEN = rf"(?:\s+(?:dot|point|punkt|punto)\s+|\s*{_OPEN}\s*(?:dot|\.|punkt|punto|point)\s*{_CLOSE}\s*|\.)"
_DOTTED = re.compile(rf"\b{_OCTET}(?:{_BETWEEN}{_OCTET}){{3,}}\b", re.I)
_BETWEEN_OR_DIGIT = re.compile(rf"({_BETWEEN})|{_D}", re.I)
# Endings that make a spelled address whatever comes before them.
_ENDING = "(?:com|org|net|edu|gov|mil|info|biz|io|co|ai|app|dev|uk|de|fr|es|nl|eu|ca|au|ch|ru|jp|cn|br)"
# Words before "dot" where it is a noun; other endings of two or more letters need another one.
_NOUN = "(?:a|the|this|that|these|those|each|every|any|some|one|no|my|your|his|her|its|our|their|which|what|another)"
_LABELS = r"(?:[A-Za-z0-9-]+(?:\s+|_)dot(?:\s+|_))+"
_WORDY = re.compile(rf"[A-Za-z0-9._%+-]+(?:\s+|_)at(?:\s+|_)(?:{_LABELS}{_ENDING}\b|(?!{_NOUN}(?:\s|_)){_LABELS}[A-Za-z]{{2,}}\b)|"
                    rf"[A-Za-z0-9._%+-]+@{_LABELS}[A-Za-z]{{2,}}\b", re.I)
_SIGN = re.compile(r"(?:\s+|_)(at|dot)(?:\s+|_)", re.I)
_ADDRESS_AROUND = re.compile(r"(?<=[A-Za-z0-9])\s+@\s+(?=[A-Za-z0-9])")
_BRACKETED = re.compile(rf"{_OPEN}\s*(?:at|@|arroba|dot|\.|punkt|punto|point)\s*{_CLOSE}", re.I)
_SPELLED_DOT = re.compile(r"[\s_]dot[\s_]")


class _Characters(dict):
    """ASCII form of a character; itself where it has none."""

    def __missing__(self, c: str) -> str:
        to = c
        if ord(c) > 127:
            if c in LOOKALIKES:
                to = LOOKALIKES[c]
            elif c in INVISIBLE:
                to = ""
            elif unicodedata.category(c) == "Nd":
                to = str(unicodedata.digit(c))
            elif (wide := unicodedata.normalize("NFKC", c)) != c and len(wide) == 1 and wide.isascii():
                to = wide
        self[c] = to
        return to


_CHARACTERS = _Characters()


class Mapped:
    """A text whose characters know the source range they stand for, and whether they were rewritten."""

    def __init__(self, source: str):
        rows = [(to, k) for k, c in enumerate(source) if (to := _CHARACTERS[c])]
        self.text = "".join(c for c, _ in rows)
        self.begin = [k for _, k in rows]
        self.end = [k + 1 for _, k in rows]
        self.new = [c != source[k] for c, k in rows]
        for i in range(1, len(rows)):  # characters dropped in between count as a change of what follows
            if self.begin[i] != self.end[i - 1]:
                self.new[i] = True

    def rewrite(self, pattern: re.Pattern, parts: Callable[[re.Match], list[tuple[str, int, int]]]) -> None:
        """Replace each match by ``parts``: (text, from, to) in offsets of the text before."""
        text, begin, end, new, at = [], [], [], [], 0
        for m in pattern.finditer(self.text):
            for piece, a, b in [(None, at, m.start()), *parts(m)]:
                if piece is None:
                    text.append(self.text[a:b])
                    begin += self.begin[a:b]
                    end += self.end[a:b]
                    new += self.new[a:b]
                elif piece:
                    text.append(piece)
                    begin += [self.begin[a]] * len(piece)
                    end += [self.end[b - 1]] * len(piece)
                    new += [True] * len(piece)
            at = m.end()
        if at:
            text.append(self.text[at:])
            self.text, self.begin, self.end, self.new = "".join(text), begin + self.begin[at:], end + self.end[at:], new + self.new[at:]


def _as(sign: str) -> Callable[[re.Match], list]:
    return lambda m: [(sign, m.start(), m.end())]


def _digits(m: re.Match) -> list:
    return [(None if t[0].isdigit() and t[0].isascii() else _DIGIT[t[0].lower()], t.start(), t.end())
            for t in _TOKEN.finditer(m.string, m.start(), m.end())]


def _dotted(m: re.Match) -> list:
    return [(None if t[0] == "." or t[0].isdecimal() else "." if t[1] else _DIGIT[t[0].lower()], t.start(), t.end())
            for t in _BETWEEN_OR_DIGIT.finditer(m.string, m.start(), m.end())]


def _wordy(m: re.Match) -> list:
    out, at = [], m.start()
    for s in _SIGN.finditer(m.string, m.start(), m.end()):
        out += [(None, at, s.start()), ("@" if s[1].lower() == "at" else ".", s.start(), s.end())]
        at = s.end()
    return [*out, (None, at, m.end())]


def normalise(source: str) -> Mapped:
    m = Mapped(source)
    m.rewrite(_DOTTED, _dotted)
    m.rewrite(_SPELLED, _digits)
    m.rewrite(_PLUS, _as("+"))
    m.rewrite(_POINT, _as("."))
    m.rewrite(_AT, _as("@"))
    m.rewrite(_DOT, _as("."))
    m.rewrite(_ADDRESS_AROUND, _as("@"))
    m.rewrite(_WORDY, _wordy)
    return m


def disguised(text: str) -> bool:
    """Whether any transducer changes the text: one of their patterns is in it.  Spaced digits
    (``_SPELLED`` without a word) are left out, no character of them is rewritten."""
    if not text.isascii() and ("İ" in text or any(_CHARACTERS[c] != c for c in set(text))):  # İ is an i to a pattern only
        return True
    low = text.lower()
    if "dot" in low and _SPELLED_DOT.search(low) or "@" in low and _ADDRESS_AROUND.search(text) or _BRACKETED.search(text):
        return True
    if "plus" in low and _PLUS.search(text) or any(w in low for w in ("dot", "point", "punkt", "punto")) and _POINT.search(text):
        return True
    return not _DIGIT.keys().isdisjoint(_LETTERS.findall(low)) and (_SPELLED.search(text) or _DOTTED.search(text)) is not None


def find(text: str) -> tuple[dict[str, list[Span]], dict[str, list[Span]]]:
    """Base spans and added spans by kind."""
    base = detect(text)
    added: dict[str, list[Span]] = {k: [] for k in KINDS}
    if disguised(text):
        m = normalise(text)
        for kind, spans in detect(m.text).items():
            own = sorted(base[kind])
            k = 0
            for a, b in spans:
                start, stop = m.begin[a], m.end[b - 1]
                while k < len(own) and own[k][1] <= start:
                    k += 1
                if any(m.new[a:b]) and not (k < len(own) and own[k][0] < stop):
                    added[kind].append((start, stop))
    return base, added


def joined(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in sorted(spans[k]))


def spans(docs: DataFrame) -> DataFrame:
    """``(doc_id, spans array<struct<kind, begin, end, added>>)``: all spans of each text."""

    def step(batch: pa.RecordBatch) -> dict:
        rows = []
        for body in texts(batch):
            base, added = find(body)
            rows.append([{"kind": k, "begin": a, "end": b, "added": new} for k in KINDS
                         for a, b, new in sorted([(*s, False) for s in base[k]] + [(*s, True) for s in added[k]])])
        return {"doc_id": column(batch, "doc_id"), "spans": rows}

    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(docs.select("doc_id", "text"), step,
                     f"doc_id {kind}, spans array<struct<kind:string,begin:int,end:int,added:boolean>>")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)

    def step(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {n: [] for n in (*(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added")}
        for body in texts(batch):
            base, added = find(body)
            for k in KINDS:
                out[f"n_{k}"].append(len(base[k]))
            out["base_sha256"].append(hashlib.sha256(joined(base).encode()).hexdigest())
            out["spans"].append(joined({k: base[k] + added[k] for k in KINDS}))
            out["n_added"].append(sum(map(len, added.values())))
        return {"doc_id": column(batch, "doc_id")} | out

    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(docs.select("doc_id", "text"), step, f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, "
                     "base_sha256 string, spans string, n_added long")
