"""Personal data in texts: identifiers found as written and behind disguises, at offsets of the source text.

A text is searched twice: as it stands (the base spans) and, where it holds a disguise, after a chain of
transducers. Every transducer is a list of edits; a span of the last text goes back through the lists to the
source characters that made it. The chain:

1. characters: look-alikes, full-width and other digits become their ASCII form, invisible ones go;
2. digits: runs of three or more digits, most of them spelled ("five five 5"), and letters O and l inside numbers;
3. signs: "plus" before a number, bracketed, spaced or spelled at signs, then dots.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickscope.llm.common import hidden, shown

KINDS = ("email", "ip", "card", "phone")
SPAN = "array<struct<kind:string,start:long,end:long,base:boolean>>"

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_LOCAL = "".join(sorted(LOCAL))
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Letters and signs that look like an ASCII character (what Unicode folds by itself is not listed).
LOOKALIKE = dict(zip("аеорсухіјѕԁһԛԝӏ" "АВЕЗКМНОРСТУХІЈЅ" "οναρτυικ" "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧ" "ı" "‐‒–—−" "。·∙•",
                     "aeopcyxijsdhqwl" "ABE3KMHOPCTYXIJS" "ovaptuik" "ABEZHIKMNOPTYX" "i" "-----" "....", strict=True))
INVISIBLE = frozenset("­​‌‍‎‏⁠﻿")
# Names of the digits 0 to 9 in English, German, French and Spanish.
DIGIT_NAMES = {name: str(d) for names in (
    "zero one two three four five six seven eight nine", "null eins zwei drei vier fünf sechs sieben acht neun",
    "zéro un deux trois quatre cinq six sept huit neuf", "cero uno dos tres cuatro cinco seis siete ocho nueve")
    for d, name in enumerate(names.split())}
AT_NAMES, DOT_NAMES = "at|arroba|arobase|ät", "dot|punkt|point|punto"

_NAME = "|".join(sorted(DIGIT_NAMES, key=len, reverse=True))
_GAP = rf"(?:[\s,.-]{{1,3}}|\s{{1,3}}(?:{DOT_NAMES})\s{{1,3}})"
_ONE = rf"(?:(?:{_NAME})(?!\w)|[0-9]+)"
_RUN = re.compile(rf"(?<!\w){_ONE}(?:{_GAP}{_ONE}){{2,}}")
_PART = re.compile(rf"(?P<name>(?<!\w)(?:{_NAME})(?!\w))|(?P<digits>[0-9]+)|(?P<gap>(?:(?!(?<!\w){_ONE}).)+)", re.S)
_IN_NUMBER = re.compile(r"(?<=[0-9])[OoIl](?=[0-9])")
_PLUS = re.compile(r"(?<!\w)plus\s{1,3}(?=\(?[0-9])")
_SPELLED_DOT = rf"(?:\s{{1,3}}(?:{DOT_NAMES})\s{{1,3}}|\s{{0,3}}[\[({{<]\s{{0,3}}(?:{DOT_NAMES}|\.)\s{{0,3}}[\])}}>]\s{{0,3}})"
_DOT = re.compile(rf"(?<=[a-z0-9]){_SPELLED_DOT}(?=[a-z0-9])")
_AT = re.compile(
    rf"(?<=[a-z0-9._%+-])\s{{0,3}}[\[({{<]\s{{0,3}}(?:{AT_NAMES}|@)\s{{0,3}}[\])}}>]\s{{0,3}}(?=[a-z0-9-])"
    rf"|(?<=[a-z0-9._%+-])\s{{1,3}}@\s{{1,3}}(?=[a-z0-9-]++(?:\.|{_SPELLED_DOT})[a-z0-9])"
    rf"|(?<=[a-z0-9._%+-])\s{{1,3}}(?:{AT_NAMES})\s{{1,3}}(?=[a-z0-9-]++(?:\.[a-z0-9-]++)*+{_SPELLED_DOT}[a-z0-9])")
# Texts that hold none of these have nothing for the second and third transducer.
GATE = (rf"(?i)(?:{_NAME}|[0-9])(?:[\s,.-]{{1,3}}|\s{{1,3}}(?:{DOT_NAMES})\s{{1,3}})(?:{_NAME})|[0-9][oil][0-9]|plus\s{{1,3}}\(?[0-9]"
        rf"|\s@\s|\s(?:{DOT_NAMES})\s|[\[({{<]\s{{0,3}}(?:{AT_NAMES}|{DOT_NAMES}|@|\.)\s{{0,3}}[\])}}>]")


class Aligned:
    """A text under rewriting, and the edits of every stage by which its spans go back to the source."""

    def __init__(self, text: str):
        self.text, self._stages = text, []

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace the spans (start, end, replacement), in order and apart from each other."""
        if not edits:
            return
        out, starts, stage, at, shift = [], [], [], 0, 0
        for start, end, new in edits:
            out += [self.text[at:start], new]
            starts.append(start + shift)
            stage.append((start + shift + len(new), start, end))
            shift += len(new) - (end - start)
            at = end
        self.text = "".join(out) + self.text[at:]
        self._stages.append((starts, stage))

    def source(self, start: int, end: int) -> tuple[int, int]:
        """The source span of the characters start to end."""
        last = end - 1
        for starts, stage in reversed(self._stages):
            i, j = bisect_right(starts, start) - 1, bisect_right(starts, last) - 1
            if i >= 0:
                stop, a, b = stage[i]
                start = a if start < stop else b + start - stop
            if j >= 0:
                stop, a, b = stage[j]
                last = b - 1 if last < stop else b + last - stop
        return start, last + 1


class _Folded(dict):
    """The ASCII form of a character, found once: itself where it has none."""

    def __missing__(self, c: str) -> str:
        digit, folded = unicodedata.decimal(c, None), unicodedata.normalize("NFKC", c)
        if c in INVISIBLE:
            new = ""
        elif digit is not None:
            new = str(digit)
        else:
            new = folded if len(folded) == 1 and folded.isascii() else LOOKALIKE.get(c, c)
        self[c] = new
        return new


_FOLDED = _Folded()


def _ascii_lower(text: str) -> str:
    """Lower case at the same offsets."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def _fold(a: Aligned) -> None:
    if a.text.isascii():
        return
    odd = {ord(c): n for c in set(a.text) if not c.isascii() and (n := _FOLDED[c]) != c}
    gone = "".join(chr(o) for o, n in odd.items() if not n)
    if odd:
        a.text = a.text.translate({o: n for o, n in odd.items() if n})  # one for one: offsets stay
    if gone:
        a.rewrite([(m.start(), m.end(), "") for m in re.finditer(f"[{re.escape(gone)}]+", a.text)])


def _digits(a: Aligned) -> None:
    """Spelled digits of a run; gaps between two spelled digits go, others stay."""
    low, edits = _ascii_lower(a.text), []
    for run in _RUN.finditer(low):
        spelled, gap, parts = False, None, list(_PART.finditer(low, run.start(), run.end()))
        if 2 * sum(bool(p["name"]) for p in parts) <= sum(not p["gap"] for p in parts):
            continue  # written numbers, and a word beside them
        for part in parts:
            if part["gap"]:
                gap = part
                continue
            if part["name"]:
                if spelled and gap and not any(c.isalpha() for c in gap["gap"]):
                    edits.append((gap.start(), gap.end(), ""))
                edits.append((part.start(), part.end(), DIGIT_NAMES[part["name"]]))
            spelled, gap = bool(part["name"]), None
    a.rewrite(edits)
    a.rewrite([(m.start(), m.end(), "0" if m[0] in "Oo" else "1") for m in _IN_NUMBER.finditer(a.text)])


def _signs(a: Aligned) -> None:
    for pattern, sign in ((_PLUS, "+"), (_AT, "@"), (_DOT, ".")):
        a.rewrite([(m.start(), m.end(), sign) for m in pattern.finditer(_ascii_lower(a.text))])


def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(d - 9 if (d := 2 * int(c)) > 9 else d for c in digits[-2::-2])
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From every at sign: the longest local part before it that no earlier match holds, the domain behind it."""
    low, at = 0, text.find("@")
    while at >= 0:
        local = text[low:at]
        start = low + len(local.rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        low = domain.end() if domain else at + 1
        at = text.find("@", low)


def _ips(text: str) -> Iterator[tuple[int, int]]:
    """Every four parts of a dotted number, each run of digits read once."""
    for m in _DOTTED.finditer(text):
        parts, at = m[0].split("."), m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in four):
                yield at, end
            at = end + 1


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and _luhn(digits):
            yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            yield m.span()


_FINDERS = {"email": _emails, "ip": _ips, "card": _cards, "phone": _phones}


def spans_of(text: str | None, disguised: bool = True) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, base) of a text, by kind in the order of KINDS, then start. disguised=False: the text
    is known to hold nothing that GATE matches."""
    text = text or ""
    base = {kind: list(find(text)) for kind, find in _FINDERS.items()}
    a = Aligned(text)
    _fold(a)
    if disguised or a.text != text:
        _digits(a)
        _signs(a)
    out = []
    for kind in KINDS:
        spans = [(kind, s, e, True) for s, e in base[kind]]
        if a.text != text:
            starts = [s for s, _ in base[kind]]
            for s, e in {a.source(*span) for span in _FINDERS[kind](a.text)}:
                i = bisect_right(starts, s) - 1
                if i < 0 or base[kind][i][1] < e:
                    spans.append((kind, s, e, False))
        out += sorted(spans, key=lambda x: (x[1], x[2]))
    return out


def masked(text: str | None, spans: list[tuple[str, int, int, bool]]) -> str | None:
    """The text with <KIND> for every stretch of overlapping spans, named after its first span."""
    if not text or not spans:
        return text
    out, at, stretch = [], 0, None
    for kind, start, end, _ in sorted(spans, key=lambda x: (x[1], -x[2])):
        if stretch and start < stretch[1]:
            stretch[1] = max(stretch[1], end)
            continue
        if stretch:
            at = stretch[1]
        out += [text[at:start], f"<{kind.upper()}>"]
        stretch = [start, end]
    return "".join(out) + text[stretch[1]:]


def find_personal_data(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of docs, with columns pii_spans and pii_masked: array of (kind, start, end, base), offsets in
    code points, end exclusive, and the text with the spans masked.

    base: found in the text as it stands; the others were found behind a disguise, are mapped back to the
    characters that made them and lie in no base span of their kind. Null and empty texts have no spans; a null
    text stays null. Repeated rows are rows of their own. Columns of docs named pii_spans or pii_masked are replaced.
    """
    rest = [c for c in docs.columns if c not in ("pii_spans", "pii_masked")]
    rows = docs.select([F.col(f"`{c}`") for c in rest])
    rows = rows.select(*hidden(rows))
    at = f"_in{rest.index(text)}"
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + f", _spans {SPAN}, _masked string"
    struct = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(at)
            texts, gate = column.to_pylist(), pc.match_substring_regex(column, GATE).to_pylist()
            found = [spans_of(t, bool(g)) for t, g in zip(texts, gate)]
            spans = pa.array([[dict(zip(("kind", "start", "end", "base"), s)) for s in f] for f in found], pa.list_(struct))
            masks = pa.array([masked(t, f) for t, f in zip(texts, found)], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, spans, masks], names=[*batch.schema.names, "_spans", "_masked"])

    found = rows.mapInArrow(run, schema)
    return found.select(*shown(docs.select([F.col(f"`{c}`") for c in rest])), F.col("_spans").alias("pii_spans"),
                        F.col("_masked").alias("pii_masked"))


def span_digests(docs: DataFrame) -> DataFrame:
    """doc_id, base spans per kind, the digest of the base spans, all spans as text, and how many were added."""
    found = find_personal_data(docs.select("doc_id", "text"))
    base = F.filter("pii_spans", lambda s: s["base"])

    def said(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(said(base), 256).alias("base_sha256"), said(F.col("pii_spans")).alias("spans"),
                        F.size(F.filter("pii_spans", lambda s: ~s["base"])).cast("long").alias("n_added"))
