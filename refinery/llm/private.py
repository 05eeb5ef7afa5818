"""Personal data: plain patterns, and identifiers in disguise found in a normalised text.

The normaliser is a transducer: it reads the text from left to right and rewrites disguises
(look-alike letters, spelled digits, written-out "at" and "dot"), and keeps for every rewritten
piece where it came from. Identifiers found in its output are mapped back to the source.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Mapping
from itertools import repeat

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.llm.common import SPANS, SPANS_ARROW, per_text

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
# The look-behind spares a long run of digits a new try at each of them; the leftmost matches are the same.
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
KINDS = ("email", "ip", "card", "phone")
HIDDEN = "hidden_"
ORDER = {name: n for n, name in enumerate([*KINDS, *(HIDDEN + kind for kind in KINDS)])}

# Letters of other scripts that look like ASCII ones.
LOOK_ALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X",
    "ο": "o", "α": "a", "ν": "v", "ι": "i", "ρ": "p", "Α": "A", "Β": "B", "Ε": "E", "Η": "H", "Ι": "I", "Κ": "K",
    "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Χ": "X", "ı": "i", "ɡ": "g", "․": ".", "。": ".",
    "ԁ": "d", "һ": "h", "ӏ": "l", "Ӏ": "l", "ԛ": "q", "ԝ": "w", "ѵ": "v", "ү": "y", "Ѕ": "S", "І": "I", "Ј": "J", "Ү": "Y", "Ԛ": "Q", "Ԝ": "W",
    "υ": "u", "γ": "y", "κ": "k", "Ζ": "Z", "Υ": "Y", "ϲ": "c", "ϳ": "j", "օ": "o", "ո": "n", "ս": "u", "հ": "h", "ց": "g", "զ": "q", "ք": "p",
    "ɑ": "a", "ɩ": "i", "ɪ": "i", "ʀ": "r", "ᴀ": "a", "ᴄ": "c", "ᴅ": "d", "ᴇ": "e", "ᴊ": "j", "ᴋ": "k", "ᴍ": "m", "ᴏ": "o", "ᴘ": "p",
    "ᴛ": "t", "ᴜ": "u", "ᴠ": "v", "ᴡ": "w", "ᴢ": "z", "Ꭺ": "A", "Ᏼ": "B", "Ꮯ": "C", "Ꭼ": "E", "Ꮋ": "H", "Ꭻ": "J", "Ꮶ": "K", "Ꮮ": "L",
    "Ꮇ": "M", "Ꮲ": "P", "Ꭱ": "R", "Ꮪ": "S", "Ꭲ": "T", "Ꮩ": "V", "Ꮃ": "W", "Ꮓ": "Z", "⁄": "/", "∙": ".", "·": ".", "﹫": "@", "＠": "@",
    "\u2012": "-", "\u2014": "-", "\u2212": "-", "\u2002": " ", "\u2003": " ", "\u2009": " ", "\u3000": " ", "\u180e": "", "\u2061": "",
    "\u2010": "-", "\u2011": "-", "\u2013": "-", "\u00a0": " ", "\u202f": " ",
    "\u200b": "", "\u200c": "", "\u200d": "", "\u2060": "", "\u00ad": "", "\ufeff": "",
}
# Digits as they are spelled in English, German, French and Spanish.
SPELLED = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7",
    "eight": "8", "nine": "9", "null": "0", "eins": "1", "zwei": "2", "zwo": "2", "drei": "3", "vier": "4",
    "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9", "zéro": "0", "un": "1", "deux": "2",
    "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9", "cero": "0", "uno": "1",
    "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
AT, DOT, PLUS = "at|arroba|chez", "dot|punkt|punto|point", "plus|más"
LEAST_SPELLED = 4


def _wide(ranges=((0xFF01, 0xFF5E), (0x1D400, 0x1D7FF), (0x2460, 0x2468), (0x24B6, 0x24E9))) -> dict[str, str]:
    """Full-width, mathematical and circled characters whose compatibility form is one ASCII character."""
    pairs = ((chr(o), unicodedata.normalize("NFKC", chr(o))) for a, b in ranges for o in range(a, b + 1))
    return {c: plain for c, plain in pairs if len(plain) == 1 and plain.isascii()}


def _figures() -> dict[str, str]:
    """The digits of all scripts."""
    return {c: str(unicodedata.decimal(c)) for c in map(chr, range(0x80, 0x20000)) if unicodedata.category(c) == "Nd"}


ALIKE = LOOK_ALIKES | _figures() | _wide()
_digit = "|".join(sorted(SPELLED, key=len, reverse=True))
_run = re.compile(rf"\b(?:(?:{PLUS})[\s-]+)?(?:{_digit})(?:[\s,.-]+(?:{_digit}|{DOT}|[0-9]+)){{3,}}\b", re.IGNORECASE)
_part = re.compile(rf"(?P<plus>{PLUS})|(?P<dot>{DOT})|(?P<digit>{_digit})|(?P<plain>[0-9]+)|(?P<gap>[\s,.-]+)", re.I)
_at = re.compile(
    rf"\s*+(?:\[\s*(?:{AT}|@)\s*\]|\(\s*(?:{AT}|@)\s*\)|\{{\s*(?:{AT}|@)\s*\}}|<\s*(?:{AT}|@)\s*>)\s*"
    rf"|(?<=[A-Za-z0-9])\s++(?:{AT}|@)\s+(?=[A-Za-z0-9-]+\s*[\[({{<]?\s*(?:\.|{DOT})\s*[\])}}>]?\s*[A-Za-z0-9])"
    rf"|(?<=[A-Za-z0-9])\s++@(?=[A-Za-z0-9])|(?<=[A-Za-z0-9])@\s+(?=[A-Za-z0-9-]+\s*\.)"
    rf"|(?<=[A-Za-z0-9])\s+_+(?:{AT})_+\s+(?=[A-Za-z0-9-]+\s*(?:\.|_+(?:{DOT})_+|\s(?:{DOT})\s)\s*[A-Za-z0-9])"
    rf"|(?<=[A-Za-z0-9])_+(?:{AT})_+(?=[A-Za-z0-9-]+_+(?:{DOT})_+[A-Za-z0-9])",
    re.IGNORECASE,
)
_dot = re.compile(
    rf"\s*+(?:\[\s*(?:{DOT}|\.)\s*\]|\(\s*(?:{DOT}|\.)\s*\)|\{{\s*(?:{DOT}|\.)\s*\}}|<\s*(?:{DOT}|\.)\s*>)\s*"
    rf"|(?<=[A-Za-z0-9])\s++(?:{DOT})\s+(?=[A-Za-z0-9])|(?<=[A-Za-z0-9])\s*_+(?:{DOT})_+\s*(?=[A-Za-z0-9])",
    re.IGNORECASE,
)
# Characters written as entities of HTML: by number, or by these names (fixed values).
ENTITIES = {"commat": "@", "period": ".", "lowbar": "_", "plus": "+", "hyphen": "-", "dash": "-", "nbsp": " "}
_entity = re.compile(rf"&(?:#(\d{{1,7}})|#[xX]([0-9A-Fa-f]{{1,6}})|({'|'.join(ENTITIES)}));")
_underscored = re.compile(rf"_(?:{AT}|{DOT})_", re.IGNORECASE)
# "came at 10.30" is no address, so a domain that was not written plainly ends in letters.
_named_domain = re.compile(r"\.[A-Za-z]{2,}(?:-[A-Za-z0-9-]*)?\Z")
# What rewriting takes at least; most texts have nothing of it and are their own normal form.
_words = bytes(0x20 if b < 0x80 and not chr(b).isalnum() else b for b in range(256))
_dots = frozenset(word.encode() for word in DOT.split("|"))
_parts = {word.encode(): 1 for word in [*SPELLED, *DOT.split("|"), *PLUS.split("|")]}
_alikes = frozenset(ALIKE)
_figure = re.compile("[0-9]")
# The second alternatives of _at and _dot by themselves.
_at_domain = re.compile(
    rf"(?<=[A-Za-z0-9])\s++(?:{AT})\s+(?=[A-Za-z0-9-]+\s*[\[({{<]?\s*(?:\.|{DOT})\s*[\])}}>]?\s*[A-Za-z0-9])", re.IGNORECASE
)
_dot_word = re.compile(rf"(?<=[A-Za-z0-9])\s++(?:{DOT})\s+(?=[A-Za-z0-9])", re.IGNORECASE)
_bracketed = re.compile(rf"[\[({{<]\s*(?:{AT}|{DOT}|@|\.)\s*[\])}}>]", re.IGNORECASE)


class Rewritten:
    """A text with pieces replaced, and the way back: pieces are (start, end, replacement) of the source."""

    def __init__(self, source: str, pieces: list[tuple[int, int, str]]):
        self.pieces = pieces
        self.starts: list[int] = []
        out, at, length = [], 0, 0
        for start, end, new in pieces:
            out += [source[at:start], new]
            length += start - at
            self.starts.append(length)
            length += len(new)
            at = end
        out.append(source[at:])
        self.text = "".join(out)

    def source(self, position: int, *, end: bool = False) -> int:
        """Where the character at ``position`` starts, or with ``end`` where the one before it stops."""
        if end:
            position -= 1
        k = bisect_right(self.starts, position) - 1
        if k < 0:
            return position + end
        start, stop, new = self.pieces[k]
        inside = position - self.starts[k]
        if inside < len(new):
            return stop if end else start
        return stop + inside - len(new) + end

    def span(self, start: int, end: int) -> tuple[int, int]:
        return self.source(start), self.source(end, end=True)

    def touches(self, start: int, end: int) -> bool:
        """Whether any rewritten piece lies in this span of the new text."""
        k = bisect_right(self.starts, start) - 1
        if k >= 0 and start < self.starts[k] + len(self.pieces[k][2]):
            return True
        return bisect_right(self.starts, end - 1) - 1 > k


def plain_words(text: str) -> list[bytes]:
    """The words in lower case, without ASCII marks; what the hints are looked up in."""
    return text.lower().encode().translate(_words).split()


def entities(text: str) -> list[tuple[int, int, str]]:
    """Entities that stand for a visible character of ASCII, or a blank."""
    if "&" not in text:
        return []
    pieces = []
    for m in _entity.finditer(text):
        number = int(m[1]) if m[1] else int(m[2], 16) if m[2] else 0
        new = ENTITIES[m[3]] if m[3] else chr(number) if 0x20 <= number < 0x7F else None
        if new is not None:
            pieces.append((*m.span(), new))
    return pieces


def look_alikes(text: str) -> list[tuple[int, int, str]]:
    if text.isascii() or not (here := _alikes.intersection(text)):
        return []
    alike = re.compile("[" + "".join(map(re.escape, sorted(here))) + "]")
    return [(*m.span(), ALIKE[m[0]]) for m in alike.finditer(text)]


def spelled_digits(text: str) -> list[tuple[int, int, str]]:
    """Runs of four and more spelled digits become digits, without the gaps between them."""
    marks = bytes(map(_parts.get, plain_words(text), repeat(0)))
    # Four parts stand side by side, unless figures stand between them.
    if marks.count(1) < LEAST_SPELLED or not (b"\1\1\1\1" in marks or _figure.search(text)):
        return []
    pieces = []
    for run in _run.finditer(text):
        found = [(m.lastgroup, *m.span(), m[0]) for m in _part.finditer(text, *run.span())]
        if sum(kind == "digit" for kind, *_ in found) < LEAST_SPELLED:
            continue
        for kind, start, end, said in found:
            if kind != "plain":
                new = {"plus": "+", "dot": ".", "gap": "." if "." in said else ""}.get(kind)
                pieces.append((start, end, SPELLED[said.lower()] if new is None else new))
    return pieces


def has_signs(text: str) -> bool:
    """Whether the text may hold a written sign; never false where it does."""
    if "@" in text or any(map(text.__contains__, "[({<")) and _bracketed.search(text):
        return True
    if not _dots.isdisjoint(plain_words(text)) or _at_domain.search(text):
        return True
    if "_" in text and _underscored.search(text):
        return True
    # Blanks and letters beyond ASCII do not part words above.
    return not text.isascii() and _dot_word.search(text) is not None


def written_signs(text: str) -> list[tuple[int, int, str]]:
    return all_signs(text) if has_signs(text) else []


def all_signs(text: str) -> list[tuple[int, int, str]]:
    pieces: list[tuple[int, int, str]] = []
    marks = [(*m.span(), "@") for m in _at.finditer(text)] + [(*m.span(), ".") for m in _dot.finditer(text)]
    for start, end, new in sorted(marks):
        if not pieces or start >= pieces[-1][1]:
            pieces.append((start, end, new))
    return pieces


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost addresses; goes from one @ to the next, so long words cost no retries."""
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and LOCAL.match(text[start - 1]):
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            found.append((start, done))
        at = text.find("@", max(at + 1, done))
    return found


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[::-1][::2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[::-1][1::2])) % 10 == 0


def identifiers(text: str) -> list[tuple[str, int, int]]:
    found = [("email", *span) for span in emails(text)]
    for m in IP.finditer(text):
        parts = [part.lstrip("0") for part in m.groups()]
        if all(len(part) <= 3 and int(part or 0) <= 255 for part in parts):
            found.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        if 14 <= m.end() - m.start():
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
    for m in PHONE.finditer(text):
        if 10 <= sum(map(str.isdigit, m[0])) <= 15:
            found.append(("phone", *m.span()))
    return found


def find_private(text: str) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, base) by start, then kind; ``hidden_`` kinds were found in the normalised text only."""
    base = identifiers(text)
    spans = [(kind, start, end, True) for kind, start, end in base]
    levels, now = [], text
    for rule in (entities, look_alikes, spelled_digits, written_signs):
        if pieces := rule(now):
            levels.append(Rewritten(now, pieces))
            now = levels[-1].text
    if levels:
        known = {(kind, start, end) for kind, start, end in base}
        for kind, start, end in identifiers(now):
            said, rewritten = now[start:end], False
            for level in reversed(levels):
                rewritten |= level.touches(start, end)
                start, end = level.span(start, end)
            if rewritten and (kind, start, end) not in known and (kind != "email" or _named_domain.search(said)):
                spans.append((HIDDEN + kind, start, end, False))
    return sorted(spans, key=lambda s: (s[1], ORDER[s[0]], s[2]))


def private_data(text: Column | str) -> Column:
    """The personal data of a text column as an array of (kind, start, end, base) structs.

    Plain identifiers have ``base`` true; those in disguise have a kind that starts with
    ``hidden_``. Spans are code points of the given text, end exclusive, whatever was normalised
    on the way. Works on whole texts within a task; nothing is shuffled.

    NULL and empty texts give an empty array, very long ones are read whole. Repeated rows each get the same
    array; an empty table gives no rows.
    """
    column = F.col(text) if isinstance(text, str) else text
    return per_text(lambda t: [dict(zip(_FIELDS, s, strict=True)) for s in find_private(t)], SPANS, SPANS_ARROW)(column)


_FIELDS = ("kind", "start", "end", "base")


def with_private_data(docs: DataFrame, *, text: str = "text", into: str = "private") -> DataFrame:
    """``docs`` with the array of :func:`private_data` as column ``into``, which replaces one of that name."""
    return docs.withColumn(into, private_data(docs[text]))


def mask(text: str, labels: Mapping[str, str] | None = None) -> str:
    """The text with each identifier replaced by its kind in brackets; overlapping spans become one."""
    out, at = [], 0
    for kind, start, end, _ in find_private(text):
        if start >= at:
            name = kind.removeprefix(HIDDEN)
            out += [text[at:start], (labels or {}).get(name, f"[{name.upper()}]")]
        at = max(at, end)
    return "".join(out) + text[at:]


def masked(text: Column | str, labels: Mapping[str, str] | None = None) -> Column:
    """The text with its personal data masked; NULL stays NULL."""
    column = F.col(text) if isinstance(text, str) else text
    return F.when(column.isNotNull(), per_text(lambda value: mask(value, labels), "string", pa.string())(column))
