"""Personal data, also in disguise, with offsets into the source text (operator 6).

Plain identifiers are found by four fixed patterns (email, ip, card, phone).
For disguised ones, a chain of transducers rewrites the text: look-alike
characters to ASCII, invisible characters away, spelled digits to digits,
and ``[at]`` / ``(dot)`` / ``at ... dot ...`` to ``@`` and ``.``.  Each
transducer keeps, for every character it writes, the span of the source
it came from, so chained rewrites still point into the source.  The same
patterns then run on the rewritten text, and what they find is mapped back.
Plain finds always stay; a disguised find is added unless a plain one of
its kind covers it.

Every find costs time in proportion to the text: the patterns are written
so that no start of a run is tried twice.

Defined cases: null text counts as empty and has no finds; a text of any
length is read whole; offsets are code points, ends exclusive; repeated
rows have the same finds; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ["email", "ip", "card", "phone"]
Span = tuple[int, int]

# Characters of an email's local part, and the patterns of the identifiers.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")

# Letters of other scripts that look like ASCII letters.
CYRILLIC = {"а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i",
            "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h", "ԛ": "q", "ԝ": "w", "А": "A", "В": "B",
            "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T",
            "Х": "X", "У": "Y", "І": "I", "Ѕ": "S", "Ј": "J"}
GREEK = {"α": "a", "ο": "o", "ν": "v", "ρ": "p", "υ": "u", "ι": "i", "κ": "k", "Α": "A",
         "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N",
         "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X"}
# Hyphens, full stops and spaces beside the ASCII ones; characters without width; digits.
MARKS = {"\u2010": "-", "\u2011": "-", "\u2012": "-", "\u2013": "-", "\u2212": "-",
         "\u2024": ".", "\u3002": ".", "\u00a0": " ", "\u2007": " ", "\u202f": " ", "\u3000": " "}
INVISIBLE = "\u00ad\u200b\u200c\u200d\u2060\ufeff"
DIGIT_WORDS = ["zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine"]


def lookalikes() -> dict[int, str]:
    """Look-alikes: the lists above, compatibility forms of one ASCII character, decimal digits."""
    table = {ord(c): a for part in (CYRILLIC, GREEK, MARKS) for c, a in part.items()}
    for code in [*range(0xFF01, 0xFF5F), *range(0x1D400, 0x1D800), *range(0x2460, 0x2469)]:
        plain = unicodedata.normalize("NFKC", chr(code))
        if len(plain) == 1 and plain.isascii():
            table[code] = plain
    for code in range(0x80, 0x1E960):
        digit = unicodedata.decimal(chr(code), None)
        if digit is not None:
            table[code] = str(digit)
    return table


LOOKALIKES = lookalikes()
ODD = frozenset([*map(chr, LOOKALIKES), *INVISIBLE])
ODD_LATIN = sorted(c for c in ODD if ord(c) < 256)
UNSEEN = re.compile(f"[{INVISIBLE}]+")

_DIGIT = "(?:" + "|".join(DIGIT_WORDS) + "|oh)"
_BETWEEN = "(?:[ ,-]+(?:dot[ ]+)?)"
SPELLED = re.compile(rf"\b(?:plus[ ,-]+)?(?:{_DIGIT}|[0-9]+){_BETWEEN}(?:(?:{_DIGIT}|[0-9]+){_BETWEEN})*"
                     rf"(?:{_DIGIT}|[0-9]+)\b", re.I)
SPELLED_PART = re.compile(rf"plus|dot|{_DIGIT}|[0-9]+", re.I)
#: A run with two spelled digits has one after another digit (spelled or not), without a dot or with it.
SPELLED_HINT = re.compile(rf"(?<=[a-z0-9])[ ,-]+{_DIGIT}(?![a-z])")
#: What else the patterns take for i and s, as case is ignored.
FOLDED = str.maketrans({"ı": "i", "ſ": "s"})
_OPEN, _SHUT = r"[\[({<]", r"[\])}>]"
AT = re.compile(rf"[ ]?{_OPEN}[ ]?(?:at|@)[ ]?{_SHUT}[ ]?|(?<=[A-Za-z0-9])(?:_at_|[ ]@[ ])(?=[A-Za-z0-9])",
                re.I)
DOT = re.compile(rf"[ ]?{_OPEN}[ ]?(?:dot|\.)[ ]?{_SHUT}[ ]?|(?<=[A-Za-z0-9])_dot_(?=[A-Za-z0-9])", re.I)
#: Bare words only as a whole: ``name at host dot tld``, or digits with dots between them.
BARE_NAME = re.compile(r"[A-Za-z0-9_%+-]++", re.I)
BARE_JOINT = re.compile(r"(?:\.|[ ]dot[ ])(?=[A-Za-z0-9_%+-])", re.I)
BARE_HOST = re.compile(r"(?:[ ]at[ ]|@)[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+"
                       r"(?:[ ]dot[ ][A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+)+", re.I)
BARE_DIGITS = re.compile(r"\b[0-9]{1,3}(?:[ ]dot[ ][0-9]{1,3}){3}\b", re.I)
BARE_START = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9_%+-]|\b[0-9]", re.I)
BARE_INSIDE = re.compile(r"[A-Za-z0-9._%+-]", re.I)
BARE_DOT = re.compile(r"[ ]dot[ ]", re.I)
BARE_PART = re.compile(r"[ ](at|dot)[ ]", re.I)
BRACKETED = re.compile(rf"{_OPEN}[ ]?(?:at|@|dot|\.)[ ]?{_SHUT}")


def lower(text: str) -> str:
    low = text.lower()
    # a capital i with a dot becomes two characters
    return low if low.isascii() else low.replace("i\u0307", "i").translate(FOLDED)


def hinted(low: str) -> bool:
    """Whether a text (lower case) may hold an at, dot or digit in disguise; never false where one is rewritten."""
    return ("dot" in low or "_at_" in low or " @ " in low or BRACKETED.search(low) is not None
            or SPELLED_HINT.search(low) is not None)


def odd(text: str) -> bool:
    """Whether a text has look-alikes or invisible characters."""
    if text.isascii():
        return False
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return not ODD.isdisjoint(text)
    return any(c in text for c in ODD_LATIN)


def emails(text: str) -> Iterator[Span]:
    """Leftmost, non-overlapping; found from each ``@`` outwards."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        host = DOMAIN.match(text, at + 1) if start < at else None
        if host:
            done = host.end()
            yield start, done
        at = text.find("@", max(done, at + 1))


def numbers(text: str) -> list[Span]:
    """Stretches of digits with at most one other character between two of them.

    Addresses and card numbers lie inside such a stretch; those of under
    four digits can hold neither.
    """
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    at = np.flatnonzero(codes - np.uint32(48) < 10)
    if not len(at):
        return []
    cuts = np.flatnonzero(np.diff(at) > 2) + 1
    first, last = np.append(0, cuts), np.append(cuts, len(at)) - 1
    enough = last - first >= 3
    return list(zip(at[first[enough]].tolist(), (at[last[enough]] + 1).tolist()))


def ips(text: str, within: list[Span] | None = None) -> Iterator[Span]:
    for lo, hi in numbers(text) if within is None else within:
        if text.find(".", lo, hi) >= 0:
            for m in IP.finditer(text, lo, hi):
                if all(len(g.lstrip("0")) < 4 and int(g.lstrip("0") or 0) < 256 for g in m.groups()):
                    yield m.span()


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def cards(text: str, within: list[Span] | None = None) -> Iterator[Span]:
    for lo, hi in numbers(text) if within is None else within:
        if hi - lo >= 16:
            for m in CARD.finditer(text, lo, hi):
                digits = NOT_DIGIT.sub("", m[0])
                if 16 <= len(digits) <= 19 and luhn(digits):
                    yield m.span()


def phones(text: str) -> Iterator[Span]:
    for m in PHONE.finditer(text):
        if 8 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
            yield m.span()


def plain_spans(text: str) -> dict[str, list[Span]]:
    within = numbers(text)
    return {"email": list(emails(text)), "ip": list(ips(text, within)),
            "card": list(cards(text, within)), "phone": list(phones(text))}


class Rewritten:
    """A text, and for each of its characters the source span it stands for."""

    def __init__(self, text: str):
        self.text = text
        self.start = np.arange(len(text), dtype=np.int64)
        self.end = self.start + 1

    def source(self, span: Span) -> Span:
        return int(self.start[span[0]]), int(self.end[span[1] - 1])

    def replace(self, edits: list[tuple[int, int, str]]) -> None:
        """Put new strings in place of some spans (ascending, apart from each other)."""
        if not edits:
            return
        texts, starts, ends, at = [], [], [], 0
        for lo, hi, new in edits:
            texts += [self.text[at:lo], new]
            starts += [self.start[at:lo], np.full(len(new), self.start[lo])]
            ends += [self.end[at:lo], np.full(len(new), self.end[hi - 1])]
            at = hi
        self.text = "".join([*texts, self.text[at:]])
        self.start = np.concatenate([*starts, self.start[at:]])
        self.end = np.concatenate([*ends, self.end[at:]])


def drop_unseen(r: Rewritten) -> None:
    r.replace([(*m.span(), "") for m in UNSEEN.finditer(r.text)])


def plain_letters(r: Rewritten) -> None:
    r.text = r.text.translate(LOOKALIKES)  # one character each, so spans stay


def _digit(word: str) -> str:
    word = lower(word)
    fixed = {"plus": "+", "dot": ".", "oh": "0"}
    return word if word.isdigit() else fixed.get(word) or str(DIGIT_WORDS.index(word))


def spelled_digits(r: Rewritten) -> None:
    """In runs with two spelled digits or more: each becomes a digit, what separates them goes."""
    edits = []
    for m in SPELLED.finditer(r.text):
        parts = list(SPELLED_PART.finditer(r.text, *m.span()))
        if sum(not (p[0].isdigit() or lower(p[0]) in ("plus", "dot")) for p in parts) < 2:
            continue
        for p, after in zip(parts, [*parts[1:], None]):
            edits.append((*p.span(), _digit(p[0])))
            if after is not None:
                edits.append((p.end(), after.start(), ""))
    r.replace(edits)


def bare_spans(text: str) -> Iterator[Span]:
    """Addresses in bare words, leftmost, each as long as its name reaches; time in proportion to the text.

    What follows a word of a name hangs on where the word ends, not on where the
    name began, so it is worked out once for each end.
    """
    if not BARE_DOT.search(text):
        return
    reach: dict[int, int] = {}  # end of a word of a name -> end of the address from there, or -1

    def named(at: int) -> int:
        ends = []
        while True:
            end = BARE_NAME.match(text, at).end()
            ends.append(end)
            joint = None if end in reach else BARE_JOINT.match(text, end)
            if joint is None:
                break
            at = joint.end()
        found = -1
        for end in reversed(ends):
            if end not in reach:
                host = BARE_HOST.match(text, end) if found < 0 else None
                reach[end] = host.end() if host else found
            found = reach[end]
        return found

    done = 0
    for m in BARE_START.finditer(text):
        at = m.start()
        if at < done:
            continue
        end = -1 if at and BARE_INSIDE.match(text, at - 1) else named(at)
        if end < 0 and (digits := BARE_DIGITS.match(text, at)):
            end = digits.end()
        if end >= 0:
            yield at, end
            done = end


def at_and_dot(r: Rewritten) -> None:
    r.replace([(*m.span(), ".") for m in DOT.finditer(r.text)])
    r.replace([(*m.span(), "@") for m in AT.finditer(r.text)])
    edits = []
    for span in bare_spans(r.text):
        edits += [(*p.span(), "@" if p[1].lower() == "at" else ".")
                  for p in BARE_PART.finditer(r.text, *span)]
    r.replace(edits)


def disguised_spans(text: str, gated: bool = True) -> dict[str, list[Span]]:
    """Finds in the rewritten text, as spans of the source; the gate saves time only."""
    strange = odd(text)
    if gated and not strange and not hinted(lower(text)):
        return {}
    r = Rewritten(text)
    if strange:
        drop_unseen(r)
        plain_letters(r)
    spelled_digits(r)
    at_and_dot(r)
    if r.text == text:
        return {}
    return {kind: [r.source(s) for s in found] for kind, found in plain_spans(r.text).items()}


def all_spans(text: str) -> tuple[dict[str, list[Span]], dict[str, list[Span]]]:
    """Plain spans, and plain plus disguised spans, per kind in order of start."""
    plain = plain_spans(text)
    every = dict(plain)
    for kind, found in disguised_spans(text).items():
        own = plain[kind]
        new = [s for s in found if not any(a <= s[0] and s[1] <= b for a, b in own)] if len(own) < 50 \
            else uncovered(found, own)
        every[kind] = sorted({*own, *new})
    return plain, every


def uncovered(found: list[Span], own: list[Span]) -> list[Span]:
    """Spans of ``found`` that lie in no span of ``own`` (ascending, apart from each other)."""
    starts = np.array([a for a, _ in own])
    at = np.searchsorted(starts, [a for a, _ in found], "right") - 1
    return [s for s, i in zip(found, at) if i < 0 or s[1] > own[i][1]]


def written(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in spans[k])


FOUND = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", *(f.split()[0] for f in FOUND.split(", "))]
    for batch in batches:
        counts, shas, spans = [], [], []
        for value in batch.column(1):
            plain, every = all_spans(value.as_py() or "")
            counts.append([len(plain[k]) for k in KINDS])
            shas.append(hashlib.sha256(written(plain).encode()).hexdigest())
            spans.append(written(every))
        table = np.array(counts, np.int64).reshape(-1, len(KINDS))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c) for c in table.T), pa.array(shas, pa.string()),
             pa.array(spans, pa.string())], names=names)


def find_personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: plain counts and digest, and all spans (plain and disguised)."""
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        _find, f"doc_id long, {FOUND}")


def mask(text: str, spans: str, mark: str = "<{}>") -> str:
    """The text with each found span (as written in ``spans``) replaced by its kind."""
    cuts = sorted((int(a), int(b), k) for k, a, b in
                  (s.split(":") for s in spans.split(",") if s))
    out, at = [], 0
    for a, b, kind in cuts:
        if a >= at:
            out += [text[at:a], mark.format(kind)]
        at = max(at, b)
    return "".join([*out, text[at:]])
