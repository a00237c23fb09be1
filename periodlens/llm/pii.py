r"""Personal data by offset-preserving deobfuscation.

Base detectors run on the source text. A transducer then rewrites disguises (homoglyphs,
invisible characters, ``[at]``/``dot`` words, spelled digits) and keeps, for each rewritten
piece, the source span it came from; the same detectors run on the rewritten text, and what
they find is mapped back to source characters. Base spans always stay; a mapped span is added
unless a base span of its kind covers it, so spans may overlap.

Defined results: null text is empty; an empty text has no spans; repeated rows are judged
each; other columns, whatever their names, aren't read. Work is linear in the text length.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from periodlens.llm.texts import lean

KINDS = ("email", "ip", "card", "phone")
_ORDER = {k: i for i, k in enumerate(KINDS)}
Span = tuple[str, int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++").match
# a match never starts inside a run of digits: it would have matched from the run's start
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}").finditer
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+").finditer
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+(?<=[0-9])").finditer
_NOT_DIGIT = re.compile(r"[^0-9]")
_DIGIT = re.compile(r"[0-9]").search


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = ord(d) - 48
        total += x if i % 2 == 0 else (2 * x if x < 5 else 2 * x - 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[Span]:
    """Around each ``@``: the local part is the run of its characters before it, from the last match on."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN(text, at + 1) if start < at else None
        if found:
            yield "email", start, found.end()
            done = found.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", max(done, at + 1))


def detect(text: str) -> list[Span]:
    """All base spans, leftmost and non-overlapping per kind, by start and then kind."""
    out = list(emails(text)) if "@" in text else []
    if _DIGIT(text):
        if "." in text:
            out += [("ip", *m.span()) for m in _IP(text) if all(len(x.lstrip("0")) <= 3 and int(x[-4:]) <= 255 for x in m[0].split("."))]
        for m in _CARD(text):
            if m.end() - m.start() >= 12:
                digits = _NOT_DIGIT.sub("", m[0])
                if 12 <= len(digits) <= 19 and luhn(digits):
                    out.append(("card", *m.span()))
        if "+" in text:
            out += [("phone", *m.span()) for m in _PHONE(text) if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return sorted(out, key=lambda s: (s[1], _ORDER[s[0]]))


# ---- the transducer

def _homoglyphs() -> dict[str, str]:
    """Characters that look like ASCII ones: wide forms, other scripts' digits and letters, dashes, dots, blanks."""
    out = {chr(c + 0xFEE0): chr(c) for c in range(0x21, 0x7F)}
    for zero in (0x660, 0x6F0, 0x966, 0x1D7CE, 0x1D7D8, 0x1D7E2, 0x1D7EC, 0x1D7F6):
        out |= {chr(zero + d): str(d) for d in range(10)}
    out |= dict(zip("аеорсухіѕјԁһԛԝАВЕКМНОРСТХІЅЈ", "aeopcyxisjdhqwABEKMHOPCTXISJ", strict=True))
    out |= dict(zip("αοινΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "aoivABEZHIKMNOPTYX", strict=True))
    out |= dict.fromkeys("‐‑‒–—−﹣", "-") | dict.fromkeys("․｡。﹒", ".") | {"﹫": "@", "﹢": "+"}
    out |= dict.fromkeys("      　", " ")
    return out | dict.fromkeys("​‌‍⁠﻿­", "")


HOMOGLYPHS = _homoglyphs()
DIGITS = {w: str(i) for i, w in enumerate("zero one two three four five six seven eight nine".split())} | {"oh": "0"}
_SPELLED = "|".join(DIGITS)
_NAME = r"[A-Za-z0-9-]+"
_OPEN, _CLOSE = r"[ \t]*[\[({<][ \t]*", r"[ \t]*[\])}>][ \t]*"
_ODD = re.compile("[" + re.escape("".join(HOMOGLYPHS)) + "]")
# a pass reads what the one before it wrote
_AT = re.compile(rf"{_OPEN}(?:at|@){_CLOSE}|(?<=[A-Za-z0-9])(?:[ \t]+@[ \t]*|@[ \t]+)(?=[A-Za-z0-9])", re.I)
_DOT = re.compile(rf"{_OPEN}(?:dot|\.){_CLOSE}", re.I)
_PLAIN_DOT = re.compile(rf"(?<=[A-Za-z0-9])[ \t]+dot[ \t]+(?=[A-Za-z0-9])", re.I)
_PLAIN_AT = re.compile(rf"(?<=[A-Za-z0-9])[ \t]+at[ \t]+(?=({_NAME}(?:\.{_NAME})++))", re.I)
_WORDS = re.compile(rf"\b(?:plus[ \t-]+)?(?:{_SPELLED}|[0-9])(?:(?:[ \t]*[-.,][ \t]*|[ \t]+(?:dot|point)[ \t]+|[ \t]+|(?<=[0-9])(?=[0-9]))(?:{_SPELLED}|[0-9])){{3,}}\b", re.I)
_WORD = re.compile(rf"{_SPELLED}|[0-9]|dot|point|plus|\.", re.I)


def _spelled(found: re.Match) -> str:
    text = found[0].lower()
    if not any(w in text for w in DIGITS):
        return found[0]
    return "".join({"plus": "+", "dot": ".", "point": ".", ".": "."}.get(w) or DIGITS.get(w, w) for w in _WORD.findall(text))


def _plain_at(found: re.Match) -> str:
    """``@`` before a name that ends like a domain: "sat at 5.30" and "a host at 10.0.0.1" stay as they are."""
    last = found[1].rpartition(".")[2]
    return "@" if len(last) > 1 and last[0].isalpha() else found[0]


#: (pattern, what it writes, characters one of which any match holds)
PASSES = (
    (_ODD, lambda m: HOMOGLYPHS[m[0]], ""),
    (_AT, lambda m: "@", "@[({<"),
    (_DOT, lambda m: ".", "[({<"),
    (_WORDS, _spelled, ""),
    (_PLAIN_DOT, lambda m: ".", ""),
    (_PLAIN_AT, _plain_at, ""),
)


class Rewritten:
    """A text with, for the pieces that a pass replaced, where they came from."""

    def __init__(self, text: str):
        self.text = text
        self.layers: list[tuple[list[int], list[tuple[int, int, int, int]]]] = []

    def apply(self, pattern: re.Pattern, write) -> None:
        parts, pieces, at, now = [], [], 0, 0
        for m in pattern.finditer(self.text):
            new = write(m)
            if new == m[0]:
                continue
            parts += [self.text[at : m.start()], new]
            now += m.start() - at
            pieces.append((now, now + len(new), m.start(), m.end()))
            now += len(new)
            at = m.end()
        if pieces:
            self.text = "".join(parts) + self.text[at:]
            self.layers.append(([p[0] for p in pieces], pieces))

    def source(self, start: int, end: int) -> tuple[int, int]:
        """The source span of [start, end): replaced pieces that it touches are taken whole."""
        for starts, pieces in reversed(self.layers):
            span = []
            for x, last in ((start, False), (end - 1, True)):
                i = bisect_right(starts, x) - 1
                while i >= 0 and pieces[i][0] == pieces[i][1] and i and pieces[i][0] == x and not last:
                    i -= 1
                if i < 0:
                    span.append(x)
                elif x < pieces[i][1]:
                    span.append(pieces[i][3] - 1 if last else pieces[i][2])
                else:
                    span.append(x - pieces[i][1] + pieces[i][3])
            start, end = span[0], span[1] + 1
        return start, end


def disguised(text: str, base: list[Span]) -> list[Span]:
    """Spans found only after the rewriting (no base span of their kind covers them), in source characters."""
    rewritten = Rewritten(text)
    for pattern, write, needs in PASSES:
        if (not needs or any(c in rewritten.text for c in needs)) and not (pattern is _ODD and text.isascii()):
            rewritten.apply(pattern, write)
    if not rewritten.layers:
        return []
    out, held = [], {k: [(s, e) for kind, s, e in base if kind == k] for k in KINDS}
    for kind, start, end in detect(rewritten.text):
        s, e = rewritten.source(start, end)
        i = bisect_right(held[kind], (s, len(text) + 1)) - 1  # those of one kind don't overlap
        if i < 0 or held[kind][i][1] < e:
            out.append((kind, s, e))
    return out


def find(text: str | None) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans) of a text, both by start and then kind."""
    base = detect(text or "")
    more = disguised(text or "", base)
    return base, sorted({*base, *more}, key=lambda s: (s[1], _ORDER[s[0]], s[2])) if more else base


def written(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def mask(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in brackets (spans that overlap: by the first one's)."""
    out, at, i = [], 0, 0
    while i < len(spans):
        kind, start, end = spans[i]
        i += 1
        while i < len(spans) and spans[i][1] < end:
            end = max(end, spans[i][2])
            i += 1
        out += [text[at:start], f"[{kind.upper()}]"]
        at = end
    return "".join(out) + text[at:]


SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def find_pii(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_chars, base spans, all spans) of every row; spans are arrays of (kind, start, end) in characters."""
    docs = docs.select(id_column, text_column)
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    schema = T.StructType([docs.schema[id_column], T.StructField("n_chars", T.LongType()), T.StructField("base", SPANS), T.StructField("spans", SPANS)])

    def run(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            found = [find(t) for t in texts]
            as_rows = lambda spans: [{"kind": k, "start": s, "end": e} for k, s, e in spans]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t or "") for t in texts], pa.int64()), pa.array([as_rows(b) for b, _ in found], span), pa.array([as_rows(a) for _, a in found], span)],
                names=[f.name for f in schema],
            )

    return docs.mapInArrow(lean(run), schema)


def mask_pii(docs: DataFrame, text_column: str = "text", length_column: str = "n_chars") -> DataFrame:
    """The same columns, with personal data in the text replaced by its kind; the length column, if integer, follows."""
    names = docs.columns
    at = names.index(text_column)
    length = names.index(length_column) if length_column in names else None
    if length is not None and docs.schema[length].dataType not in (T.LongType(), T.IntegerType()):
        length = None

    def run(batches):
        for batch in batches:
            columns = list(batch.columns)
            texts = batch.column(at).to_pylist()
            changed = {}
            for i, t in enumerate(texts):
                if t and (spans := find(t)[1]):
                    changed[i] = texts[i] = mask(t, spans)
            if changed:
                columns[at] = pa.array(texts, batch.schema.field(at).type)
                if length is not None:
                    sizes = batch.column(length).to_pylist()
                    for i, t in changed.items():
                        sizes[i] = len(t)
                    columns[length] = pa.array(sizes, batch.schema.field(length).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(lean(run), docs.schema)


def digest(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Counts and the hash of the base spans, and all spans as text, from find_pii()."""
    from pyspark.sql import functions as F

    text = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        id_column, *[count(k).alias(f"n_{k}") for k in KINDS], F.sha2(text("base"), 256).alias("base_sha256"), text("spans").alias("spans"), (F.size("spans") - F.size("base")).cast("long").alias("n_added")
    )
