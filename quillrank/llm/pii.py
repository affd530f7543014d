"""Personal data in plain sight and in disguise: offset-preserving transducers in front of the same detectors."""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_id, documents, rows

KINDS = ("email", "ip", "card", "phone")


class Span(NamedTuple):
    start: int
    kind: int
    end: int


# detectors: each reads a text once, from left to right

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3,}+")
DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])++")
PLUS = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")


def emails(text: str) -> Iterator[Span]:
    """Around each @: the local characters before it that are still free, and a name with a dot behind it."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = free + len(text[free:at].rstrip(LOCAL))
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield Span(start, 0, found.end())
        free = found.end() if found else at + 1  # no local part reaches over an @
        at = text.find("@", max(free, at + 1))


def addresses(text: str) -> Iterator[Span]:
    """Four numbers of a dotted chain at a time; a number over 255 drops its four."""
    for found in DOTTED.finditer(text):
        numbers, at = found.group().split("."), found.start()
        for k in range(0, len(numbers) - 3, 4):
            four = numbers[k:k + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or "0") <= 255 for x in four):
                yield Span(at, 1, end)
            at = end + 1


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(x), 10)) for x in digits[-2::-2])) % 10 == 0


def cards(text: str) -> Iterator[Span]:
    for found in DIGITS.finditer(text):
        if found.end() - found.start() >= 12:
            digits = NOT_DIGIT.sub("", found.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                yield Span(found.start(), 2, found.end())


def phones(text: str) -> Iterator[Span]:
    for found in PLUS.finditer(text):
        if 9 <= len(NOT_DIGIT.sub("", found.group())) <= 15:
            yield Span(found.start(), 3, found.end())


def identifiers(text: str) -> list[Span]:
    """All spans, by start and then kind."""
    return sorted(x for detect in (emails, addresses, cards, phones) for x in detect(text))


# transducers: a text with the place in the source that each of its parts came from

class Traced:
    """A rewritten text. Between the replaced parts it runs parallel to the text it was made from."""

    def __init__(self, text: str, source: Traced | None = None, marks: list[tuple[int, int, int, int]] | None = None):
        self.text, self.source = text, source
        self.marks = marks or []  # (start, end) of a replacement here and (start, end) of what it replaced
        self.begins = [m[0] for m in self.marks]

    def replaced(self, pattern: re.Pattern, by: Callable[[re.Match], str | None], haystack: str | None = None) -> Traced:
        """The text with each match replaced; where ``by`` gives None it stays. ``haystack`` is searched instead of the text."""
        out, marks, done, size = [], [], 0, 0
        for m in pattern.finditer(self.text if haystack is None else haystack):
            new = by(m)
            if new is None or m.end() == m.start():
                continue
            out += [self.text[done:m.start()], new]
            size += m.start() - done
            marks.append((size, size + len(new), m.start(), m.end()))
            size += len(new)
            done = m.end()
        if not marks:
            return self
        return Traced("".join([*out, self.text[done:]]), self, marks)

    def _edge(self, at: int, end: bool) -> int:
        """The place in the text before of the edge ``at``; inside a replacement its start or end."""
        k = bisect_right(self.begins, at - end) - 1
        if k < 0:
            return at
        start, stop, first, last = self.marks[k]
        if at - end < stop:
            return last if end else first
        return at - stop + last

    def touches(self, start: int, end: int) -> bool:
        """Whether anything between the edges was replaced, here or in a text before."""
        if self.source is None:
            return False
        k = bisect_right(self.begins, end - 1) - 1
        if k >= 0 and (self.marks[k][1] > start or self.marks[k][0] >= start):
            return True
        return self.source.touches(self._edge(start, False), self._edge(end, True))

    def origin(self, start: int, end: int) -> tuple[int, int]:
        """The source's range for a range of this text."""
        if self.source is None:
            return start, end
        return self.source.origin(self._edge(start, False), self._edge(end, True))


#: Fixed letters of other scripts that look like the Latin letter below them.
LOOKALIKES = dict(zip(
    "АВЕЅІЈКМНОРСТХУаеѕіјорсухԁһԛԝ" "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧονрѵ",
    "ABESIJKMHOPCTXYaesijopcyxdhqw" "ABEZHIKMNOPTYXovpv", strict=True))
INVISIBLE = "­​‌‍⁠﻿"
HYPHENS, SPACES, DOTS, ATS = "‐‑‒–—−", "    　", "․。｡", "﹫"


def _folds() -> dict[str, str]:
    """Full-width and mathematical forms by their compatibility mapping, decimal digits of all scripts by their value."""
    out = {chr(c): unicodedata.normalize("NFKC", chr(c)) for c in [*range(0xFF01, 0xFF5F), *range(0x1D400, 0x1D7CE)]}
    out = {c: x for c, x in out.items() if len(x) == 1 and x.isascii()}
    out |= {chr(c): str(unicodedata.decimal(chr(c))) for c in range(0x80, 0x1FBFA) if unicodedata.category(chr(c)) == "Nd"}
    out |= LOOKALIKES | dict.fromkeys(INVISIBLE, "") | dict.fromkeys(HYPHENS, "-") | dict.fromkeys(SPACES, " ")
    return out | dict.fromkeys(DOTS, ".") | dict.fromkeys(ATS, "@")


FOLDS = _folds()
FOLDED = re.compile("[" + "".join(map(re.escape, sorted(FOLDS))) + "]")
#: Texts in Latin letters, with or without accents, have nothing to fold; this class is quick to search.
MAY_FOLD = re.compile("[\u00a0\u00ad\u0250-\U0010ffff]")

#: Fixed digit words in English, German, French and Spanish.
DIGIT_WORDS = {w: str(d) for d, words in enumerate((
    "zero null zéro cero", "one eins un uno", "two zwei deux dos", "three drei trois tres", "four vier quatre cuatro",
    "five fünf cinq cinco", "six sechs seis", "seven sieben sept siete", "eight acht huit ocho",
    "nine neun neuf nueve")) for w in words.split()}
SOME_DIGIT = frozenset(DIGIT_WORDS)
_WORD = "(?:" + "|".join(sorted(DIGIT_WORDS, key=lambda w: (-len(w), w))) + ")"
_DOT, _AT = "(?:dot|punkt|point|punto)", "(?:at|ät|arobase|arroba)"
_BETWEEN = rf"(?:[ ]?[(\[]?{_DOT}[)\]]?[ ]?|[ ]?\.[ ]?|[ ,\-]{{1,3}})"
#: Four digit words or more, with blanks, commas, hyphens or spoken dots between them; numerals may stand among them.
SPELLED = re.compile(rf"(?:(?<![^\W_])plus[ ])?(?<![^\W_]){_WORD}(?:{_BETWEEN}(?:{_WORD}|[0-9]{{1,19}}))*"
                     rf"(?:{_BETWEEN}{_WORD})(?![^\W_])")
LEADING = re.compile(rf"(?:{_WORD})(?:{_BETWEEN})(?:{_WORD}|[0-9])")
TOKEN = re.compile(rf"plus|{_WORD}|[0-9]+|{_DOT}|\.")
#: Disguises in brackets stand for the sign wherever they are.
BRACKETED = re.compile(rf"[ ]{{0,2}}(?:\[[ ]?(?:(?P<a>{_AT}|@)|{_DOT}|\.)[ ]?\]|\([ ]?(?:(?P<b>{_AT}|@)|{_DOT}|\.)[ ]?\)"
                       rf"|\{{[ ]?(?:(?P<c>{_AT}|@)|{_DOT}|\.)[ ]?\}}|<[ ]?(?:(?P<d>{_AT}|@)|{_DOT}|\.)[ ]?>)[ ]{{0,2}}")
#: Bare words are only read as signs in a whole address whose last name is one of these fixed endings.
ENDINGS = ("com|org|net|edu|gov|mil|int|info|biz|io|co|me|app|dev|eu|de|fr|es|it|nl|be|ch|at|uk|ie|pt|pl|se|no|dk|fi|us|ca|"
           "mx|br|ar|cl|au|nz|jp|cn|in|ru|za|test|example")
_GAP = r"[ _\-]{1,2}"
SPOKEN = re.compile(rf"(?<![a-z0-9._%+\-])[a-z0-9%+](?:[a-z0-9.%+]|[_\-](?!{_AT}[ _\-])){{0,63}}(?:{_GAP}{_AT}{_GAP}|@)"
                    rf"(?:[a-z0-9\-]{{1,63}}?(?:{_GAP}{_DOT}{_GAP}|\.)){{1,8}}(?:{ENDINGS})(?![a-z0-9])")
SIGN = re.compile(rf"{_GAP}(?:(?P<at>{_AT})|{_DOT}){_GAP}")
DOT_WORD = re.compile(_DOT)
FOUR_NUMBERS = re.compile(rf"(?<![0-9.])[0-9]{{1,3}}(?:[ ]?{_DOT}[ ]?[0-9]{{1,3}}){{3}}(?![0-9])")
ANY_DOT = re.compile(rf"[ ]?{_DOT}[ ]?")


def lowered(text: str) -> str:
    """Lower case of the same length."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def _numerals(found: re.Match) -> str | None:
    parts = TOKEN.findall(found.group())
    if sum(p in DIGIT_WORDS for p in parts) < 4:
        return None
    return "".join("+" if p == "plus" else DIGIT_WORDS.get(p, p if p[0].isdigit() else ".") for p in parts)


def undisguised(text: str) -> Traced:
    """The text with look-alike characters, spelled digits and spoken signs written plainly."""
    out = Traced(text)
    if MAY_FOLD.search(text):
        out = out.replaced(FOLDED, lambda m: FOLDS[m.group()])
    low = lowered(out.text)
    if any(b in low for b in "[({<"):
        out = out.replaced(BRACKETED, lambda m: "@" if m.lastgroup else ".", low)
        low = lowered(out.text)
    apart = low
    for sign in ",-.()[]":
        apart = apart.replace(sign, " ")
    if not SOME_DIGIT.isdisjoint(apart.split()) and LEADING.search(low):
        out = out.replaced(SPELLED, _numerals, low)
        low = lowered(out.text)
    if DOT_WORD.search(low):
        out = out.replaced(FOUR_NUMBERS, lambda m: ANY_DOT.sub(".", m.group()), low)
        low = lowered(out.text)
        inner: list[tuple[int, int, str]] = []
        for address in SPOKEN.finditer(low):
            inner += [(m.start(), m.end(), "@" if m.lastgroup else ".") for m in SIGN.finditer(low, *address.span())]
        if inner:
            at = {a: (b, sign) for a, b, sign in inner}
            out = out.replaced(SIGN, lambda m: at[m.start()][1] if at.get(m.start(), (0,))[0] == m.end() else None, low)
    return out


def disguised(text: str, base: list[Span]) -> list[Span]:
    """Spans of the source whose plain form is an identifier and that no base span of the kind meets."""
    plain = undisguised(text)
    if plain.source is None:
        return []
    out = []
    for x in identifiers(plain.text):
        if not plain.touches(x.start, x.end):
            continue
        start, end = plain.origin(x.start, x.end)
        whole = not (start and text[start - 1].isalnum()) and not text[end:end + 1].isalnum()
        if whole and not any(b.kind == x.kind and b.start < end and start < b.end for b in base):
            out.append(Span(start, x.kind, end))
    return out


def find_pii(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base, spans) of each row; offsets count code points, ends are exclusive.

    ``base`` has what stands plainly in the whole text: e-mail and IP addresses, card numbers that pass Luhn's test and
    international phone numbers, each kind from left to right without overlaps. ``spans`` adds identifiers that
    appear after transducers have folded look-alike characters and digits of other scripts, dropped invisible
    characters, read four or more spelled digits as numerals and (at), [dot] or whole spoken addresses as their signs;
    their offsets are those of the source. An added span meets no base span of its kind and cuts no word.

    Null and empty texts have no spans; repeated rows get equal spans; an empty table gives an empty result; a null
    doc_id stays null; other columns are ignored. Every detector and transducer is linear in the text; no shuffle.
    """
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, bases, spans = [], [], []
            for text in batch.column("text"):
                text = text.as_py()
                base = identifiers(text)
                both = sorted({*base, *disguised(text, base)})
                counts.append([sum(x.kind == k for x in base) for k in range(4)])
                bases.append([(KINDS[x.kind], x.start, x.end) for x in base])
                spans.append([(KINDS[x.kind], x.start, x.end) for x in both])
            columns = [pa.array([c[k] for c in counts], pa.int64()) for k in range(4)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns, pa.array(bases, pa.list_(span)), pa.array(spans, pa.list_(span))],
                                             ["id", *(f"n_{k}" for k in KINDS), "base", "spans"])

    spans = "array<struct<kind:string,start:bigint,end:bigint>>"
    found = rows(docs).mapInArrow(run, "id bigint, " + "".join(f"n_{k} bigint, " for k in KINDS) + f"base {spans}, spans {spans}")
    return found.select(doc_id(), *(f"n_{k}" for k in KINDS), "base", "spans")


def redacted(text: str, spans: list[Span]) -> str:
    """The text with its spans replaced by their kinds; where spans overlap, the first one's kind stands for all."""
    out, done = [], 0
    for x in sorted(spans):
        if x.start >= done:
            out += [text[done:x.start], f"[{KINDS[x.kind].upper()}]"]
        done = max(done, x.end)
    return "".join([*out, text[done:]])


def redact(docs: DataFrame) -> DataFrame:
    """(doc_id, text) without personal data: each span of :func:`find_pii` becomes its kind in brackets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text in batch.column("text"):
                text = text.as_py()
                base = identifiers(text)
                texts.append(redacted(text, [*base, *disguised(text, base)]))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.string())], ["id", "text"])

    return rows(docs).mapInArrow(run, "id bigint, text string").select(doc_id(), "text")


def query(spark, sf_dir: str) -> DataFrame:
    def listed(column: str):
        return F.array_join(F.transform(column, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"),
                                                                       x["end"].cast("string"))), ",")
    return find_pii(documents(spark, sf_dir)).select(
        "doc_id", *(f"n_{k}" for k in KINDS), F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))
