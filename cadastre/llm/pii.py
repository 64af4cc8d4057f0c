"""Personal data in texts, plain and disguised, with offsets into the source.

A plain pass finds emails, IP addresses, card and phone numbers by pattern.  A second pass writes
the text anew through small transducers, each output character keeping the source span it stands
for: homoglyphs become ASCII, spelled digits become digits, disguised at, dot and plus signs become
the signs.  The same patterns run over the result, and what they find there is mapped back to the
source.  A span of the second pass counts only if a disguise lies in it and it overlaps no span of
the first, which are kept as they are.
"""

from __future__ import annotations

import bisect
import re
import unicodedata

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastre.llm.common import fresh, in_parts, map_frames, ship

KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LONG_NUMBER = re.compile(r"[0-9][0-9\x20-]{14}")


def emails(text: str):
    """Leftmost matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, none overlapping.

    Found from the at signs: a match must hold one, right after the run it begins with.
    """
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at) if start < at else None
        if found:
            done = found.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def ips(text: str):
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            yield m.span()


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def cards(text: str):
    if not LONG_NUMBER.search(text):
        return
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str):
    if "+" not in text:
        return
    for m in PHONE.finditer(text):
        if 8 <= sum(c in "0123456789" for c in m[0]) <= 15:
            yield m.span()


FINDERS = dict(zip(KINDS, (emails, ips, cards, phones), strict=True))

# Letters that look like ASCII ones (fixed values: Cyrillic and Greek lookalikes).
LOOKALIKES = dict(
    zip(
        "авеіјкмнорсԛтуѕхԝԁһɡɑοανρτυικχАВЕІЈКМНОРСТУЅХԜΑΒΕΖΗΙΚΜΝΟΡΤΥΧ",
        "abeijkmhopcqtysxwdhgaoavptuikxABEIJKMHOPCTYSXWABEZHIKMNOPTYX",
        strict=True,
    )
)
SIGNS = {
    "․": ".", "。": ".", "·": ".", "‧": ".", "∙": ".", "•": ".",
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "−": "-",
}
INVISIBLE = frozenset("​‌‍⁠﻿­‎‏")
DIGIT_WORDS = {w: str(i) for i, w in enumerate("zero one two three four five six seven eight nine".split())}
DIGIT_WORDS |= {"oh": "0"}
TIMES = {"double": 2, "triple": 3}

_words = "|".join([*DIGIT_WORDS, *TIMES])
DOT_WORD = "(?:dot|punkt|punto|point)"
AT_SIGN = re.compile(r"\s*(?:[\[({<]\s*(?:at|@)\s*[\])}>]|(?<=\w)[_*](?:at)[_*](?=\w))\s*", re.IGNORECASE)
DOT_SIGN = re.compile(rf"\s*(?:[\[({{<]\s*(?:{DOT_WORD}|\.)\s*[\])}}>]|(?<=\w)[_*]dot[_*](?=\w))\s*", re.IGNORECASE)
# Bare words: only as a chain "name at host dot domain", and dots between digits.
LABEL = r"[A-Za-z0-9-]+"
# Prose has "at the dot on": the last word must be one that names end in (fixed values).
ENDINGS = (
    "com org net edu gov int mil info biz name io ai app dev cloud online site eu uk us ca au nz ie in "
    "de at ch fr be nl lu es pt it gr pl cz sk hu ro bg se no dk fi ru ua tr il jp cn kr br mx ar cl za"
)
BARE_AT = re.compile(
    rf"(?<=[A-Za-z0-9._%+-])(?P<at>\s+at\s+|\s*@\s*)(?={LABEL}(?:(?:\s+{DOT_WORD}\s+|\.){LABEL})*?"
    rf"\s+{DOT_WORD}\s+(?:{ENDINGS.replace(' ', '|')})\b)",
    re.IGNORECASE,
)
BARE_DOT = re.compile(rf"(?<=[A-Za-z0-9-])\s+{DOT_WORD}\s+(?=[A-Za-z0-9])", re.IGNORECASE)
SPELLED = re.compile(
    rf"\b(?:plus[\s,-]+(?=(?:{_words}|[0-9])))?(?:(?:(?:double|triple)[\s-]+)?(?:{'|'.join(DIGIT_WORDS)}|[0-9])\b(?:[\s,-]+(?=(?:{_words}|[0-9])\b))?)+",
    re.IGNORECASE,
)


class Tape:
    """A text, the source span of each of its characters, and whether a disguise made it."""

    def __init__(self, text: str):
        self.text = text
        self.low = None  # the spans are listed by the first edit

    def _list(self) -> None:
        size = len(self.text)
        self.low, self.high = list(range(size)), list(range(1, size + 1))
        self.new = bytearray(size)

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace spans of the present text; every new character stands for the whole span."""
        if not edits:
            return
        if self.low is None:
            self._list()
        text, low, high, new, at = [], [], [], bytearray(), 0
        for start, end, put in edits:
            text += [self.text[at:start], put]
            low += self.low[at:start] + [self.low[start]] * len(put)
            high += self.high[at:start] + [self.high[end - 1]] * len(put)
            new += self.new[at:start] + b"\x01" * len(put)
            at = end
        self.text = "".join([*text, self.text[at:]])
        self.low, self.high = low + self.low[at:], high + self.high[at:]
        self.new = new + self.new[at:]


_same: dict[str, str] = {}


def plain_character(c: str) -> str:
    """The ASCII character that ``c`` looks like, nothing for an invisible one, else itself."""
    if c not in _same:
        if c in INVISIBLE:
            out = ""
        elif c in LOOKALIKES or c in SIGNS:
            out = LOOKALIKES.get(c) or SIGNS[c]
        elif "！" <= c <= "～":  # full width forms, in ASCII order
            out = chr(ord(c) - 0xFEE0)
        elif c.isdecimal():
            out = str(unicodedata.decimal(c))
        elif unicodedata.category(c) == "Zs":
            out = " "
        else:
            folded = unicodedata.normalize("NFKC", c) if c > "ɏ" else c
            out = folded if len(folded) == 1 and folded < "\x7f" else c
        _same[c] = out
    return _same[c]


HIGH = re.compile(r"[^\x00-\x7f]")


def homoglyphs(tape: Tape) -> list[tuple[int, int, str]]:
    edits = ((m.start(), m.end(), plain_character(m[0])) for m in HIGH.finditer(tape.text))
    return [e for e in edits if e[2] != tape.text[e[0]]]


def spelled_digits(tape: Tape) -> list[tuple[int, int, str]]:
    """Runs of two or more digits of which one at least is spelled; their gaps go."""
    out = []
    for m in SPELLED.finditer(tape.text):
        tokens = re.findall(r"[a-z]+|[0-9]", m[0].lower())
        digits, times = "+" if tokens[0] == "plus" else "", 1
        for t in tokens:
            if t in TIMES:
                times = TIMES[t]
            elif t != "plus":
                digits, times = digits + DIGIT_WORDS.get(t, t) * times, 1
        spelled = sum(t in DIGIT_WORDS for t in tokens)
        if spelled and (len(digits) > 1 or spelled == len(tokens)):
            end = m.end() - (len(m[0]) - len(m[0].rstrip(" \t\r\n,-")))
            out.append((m.start(), end, digits))
    return out


def signs(tape: Tape) -> list[tuple[int, int, str]]:
    found = [(*m.span(), "@") for m in AT_SIGN.finditer(tape.text) if m[0] != "@"]
    found += [(*m.span("at"), "@") for m in BARE_AT.finditer(tape.text)]
    found += [(*m.span(), ".") for m in DOT_SIGN.finditer(tape.text) if m[0] != "."]
    found += [(*m.span(), ".") for m in BARE_DOT.finditer(tape.text)]
    out, done = [], 0
    for e in sorted(found):
        if e[0] >= done and e[0] < e[1]:
            out.append(e)
            done = e[1]
    return out


TRANSDUCERS = (homoglyphs, signs, spelled_digits)


class _Spans:
    """Spans by their starts, each with the greatest end up to it, so that one look tells whether any is met."""

    def __init__(self, spans):
        self.low, self.high = [], []
        for start, end in sorted(spans):
            self.low.append(start)
            self.high.append(max(end, self.high[-1]) if self.high else end)

    def meet(self, start: int, end: int) -> bool:
        before = bisect.bisect_left(self.low, end)
        return before > 0 and self.high[before - 1] > start

    def add(self, start: int, end: int) -> None:
        """Of a span that meets no other: it ends before those after it begin."""
        at = bisect.bisect_left(self.low, start)
        self.low.insert(at, start)
        self.high.insert(at, end)


def spans(text: str | None) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, plain) by kind as listed, then start; ends are exclusive code points."""
    if not text:
        return []
    found = [(kind, *s, True) for kind, find in FINDERS.items() for s in find(text)]
    tape = Tape(text)
    for step in TRANSDUCERS:
        tape.rewrite(step(tape))
    if tape.low is None:
        return found
    taken = _Spans((a, b) for _, a, b, _ in found)
    for kind, find in FINDERS.items():
        for a, b in find(tape.text):
            start, end = tape.low[a], tape.high[b - 1]
            disguised = 1 in tape.new[a:b] or end - start != b - a
            if disguised and not taken.meet(start, end):
                found.append((kind, start, end, False))
                taken.add(start, end)
    return sorted(found, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


SPANS = "array<struct<kind:string,start:int,end:int,plain:boolean>>"


def detect(docs: DataFrame, text: str = "text", name: str = "pii") -> DataFrame:
    """The rows of ``docs`` with their spans in one column more (with underscores before its name if taken).

    Null and empty texts have none.
    """
    ship(docs.sparkSession)
    name = fresh(docs, name)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def run(batches):
        for pdf in in_parts(batches):
            found = [
                [{"kind": k, "start": a, "end": b, "plain": p} for k, a, b, p in spans(t)] for t in pdf[text]
            ]
            yield pdf.assign(**{name: found})

    return docs.mapInPandas(run, f"{schema}, `{name}` {SPANS}")


def report(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts of the plain spans, a digest of them, and all spans as text, per document."""
    rows = docs.select(F.col(id).cast("string").alias("id"), F.col(text).alias("text"))
    found = detect(rows, "text", "pii").drop("text")
    plain = F.filter("pii", lambda s: s["plain"])
    line = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    joined = lambda x: F.array_join(F.transform(x, line), ",")
    count = lambda k: F.size(F.filter(plain, lambda s: s["kind"] == k)).cast("long")
    counts = [count(k).alias(f"n_{k}") for k in KINDS]
    return found.select(
        F.col("id").cast(docs.schema[id].dataType).alias(id),
        *counts,
        F.sha2(joined(plain), 256).alias("base_sha256"),
        joined(F.col("pii")).alias("spans"),
    )


def masked(text: str | None) -> str | None:
    """The text with a tag of the kind in place of each span; of overlapping spans the first counts.

    The part of a later span that sticks out is masked with it.
    """
    found = sorted((a, b, k) for k, a, b, _ in spans(text))
    if not found:
        return text
    out, at, end = [], 0, -1
    for a, b, kind in found:
        if a >= end:
            out += [text[at:a], f"[{kind.upper()}]"]
        end = max(end, b)
        at = end
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text: str = "text", chars: str = "n_chars") -> DataFrame:
    """The rows of ``docs``, all columns kept, with personal data masked in the text."""
    ship(docs.sparkSession)
    new = fresh(docs, "masked")

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    mask = lambda pdf: pdf.assign(**{new: [masked(t) for t in pdf[text]]})
    rows = map_frames(docs, mask, f"{schema}, `{new}` string")
    put = {text: F.col(new)}
    if chars in docs.columns:
        changed = ~F.col(new).eqNullSafe(F.col(text))
        size = F.length(new).cast(docs.schema[chars].dataType)
        put[chars] = F.when(changed, size).otherwise(F.col(chars))
    return rows.select(*[put.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])
