"""Personal data, also where it is disguised, with every finding at its place in the source.

The text is scanned as it stands; those spans are the base. Then transducers rewrite it and keep, for each character
they write, the source characters it came from: look-alike letters and digits to ASCII, invisible characters to
nothing, spelled digits to digits, written-out ``at``, ``dot`` and ``plus`` to their signs. The rewritten text is
scanned with the same patterns; what is found there is reported at its source characters. A finding within a base span
of its own kind adds nothing and is dropped; a longer one stands beside it, and masking covers both.

Bare ``at`` and ``dot`` count only between words that also hold a ``dot`` each way of writing it (``x at y dot org``) and
end in two letters or a listed ending; spelled digits only in runs of at least four digits, among them groups of plain
ones, or of one to three where ``dot`` joins four of them to an address, so plain prose stays as it is. Words of a
disguise may stand on different lines.

Spans are ``kind:start:end`` in code points, end exclusive. Defined cases: a null or empty text has no spans; every
row is scanned, repeated ones too; texts of any length are scanned whole and in time linear in their length.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")

# The patterns of the contract, written so that no run of characters is read twice.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Letters of other scripts that look like Latin ones.
LOOK_ALIKES = dict(zip("абвгеёіјкмнорсԁтухѕһԛԝАВЕЁІЈКМНОРСТУХЅԚԜ", "aбвгeeijкmнopcdтyxshqwABEEIJKMHOPCTYXSQW", strict=True))
LOOK_ALIKES |= dict(zip("αεικνορτυχΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "aeikvoptuxABEZHIKMNOPTYX", strict=True))
INVISIBLE = frozenset(map(chr, (0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF)))

# Digits by their names in English, German, French and Spanish.
DIGIT_NAMES = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7",
    "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8",
    "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8",
    "nueve": "9",
}
_NAME = "(?:" + "|".join(sorted(DIGIT_NAMES, key=len, reverse=True)) + ")"
_BRACKETED_AT = r"[\x20]*[\[({<][\x20]*(?:at|AT|At|@)[\x20]*[\])}>][\x20]*"
_BRACKETED_DOT = r"[\x20]*[\[({<][\x20]*(?:dot|DOT|Dot|punkt|point|punto|\.)[\x20]*[\])}>][\x20]*"
_SIGN_AT = re.compile(rf"(?<=[A-Za-z0-9_%+-])(?:{_BRACKETED_AT})(?=[A-Za-z0-9])")
_SIGN_DOT = re.compile(rf"(?<=[A-Za-z0-9])(?:{_BRACKETED_DOT})(?=[A-Za-z0-9])")
# How a written-out domain may end besides in two letters, so that "at noon dot the" is none.
_ENDINGS = "com|org|net|edu|gov|info|biz|dev|app|[A-Za-z]{2}"
_GAP = r"[\x20\t\r\n]"
_WRITTEN = re.compile(
    rf"(?<=[A-Za-z0-9_%+-]){_GAP}+(?:at|AT|At){_GAP}+"
    rf"(?=[A-Za-z0-9-]+(?:(?:\.|{_GAP}+(?:dot|DOT|Dot){_GAP}+)[A-Za-z0-9-]+)*?{_GAP}+(?:dot|DOT|Dot){_GAP}+(?:{_ENDINGS})(?![A-Za-z0-9-]))"
)
_WRITTEN_DOT = re.compile(rf"(?<=[A-Za-z0-9]){_GAP}+(?:dot|DOT|Dot){_GAP}+(?=[A-Za-z0-9])")
_NEAR_AT = re.compile(r"@[A-Za-z0-9.\x20\t\r\n-]*")
_BETWEEN = r"[\x20,\t\r\n-]{1,2}"
_ITEM = rf"(?:{_NAME}|[0-9]++)"
_DIGIT_RUN = re.compile(rf"(?:\bplus(?:{_GAP}|-)+)?(?<!\w){_ITEM}(?:{_BETWEEN}{_ITEM})+(?!\w)", re.IGNORECASE)
_SHORT_RUN = rf"(?:{_NAME}|[0-9]{{1,3}})(?:{_BETWEEN}(?:{_NAME}|[0-9])){{0,2}}"
_SPELLED_IP = re.compile(rf"(?<!\w){_SHORT_RUN}(?:{_GAP}++dot{_GAP}++{_SHORT_RUN}){{3}}(?!\w)", re.IGNORECASE)
_IP_PART = re.compile(rf"{_GAP}*dot{_GAP}*|{_BETWEEN}|{_NAME}", re.IGNORECASE)
_IP_DOTS = re.compile(rf"(?<=[0-9]){_GAP}+(?:dot|DOT|Dot){_GAP}+(?=[0-9])")
_ONE_NAME = re.compile(rf"plus(?:{_GAP}|-)+|{_NAME}|,|[\t\r\n]+|[0-9]+", re.IGNORECASE)
# Beyond Latin letters, common quotes and dashes, and the euro sign.
_FOREIGN = re.compile("[^\\x00-\\xac\\xae-\\u024f\\u2010-\\u2027\\u2030-\\u205e\\u20ac]")
# By what a word is: the name of a digit, plain digits, anything else. Names next to either are worth a look.
_NAMED, _PLAIN = 1, 2
_SPELLED = (b"\1\1", b"\1\2", b"\2\1")
_DIGIT_MARK = bytes(ord("d") if chr(b) in "0123456789" else b for b in range(256))

Spans = list[tuple[str, int, int]]


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """At each ``@`` the run of name characters before it, back to the last address, and the domain after it."""
    until, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > until and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            yield start, domain.end()
            until = domain.end()
        at = text.find("@", max(at + 1, until))


def base_spans(text: str, data: bytes | None = None) -> Spans:
    """Matches in a text as it stands. The bytes tell cheaply which patterns can match at all."""
    data = text.encode("utf-8", "surrogatepass") if data is None else data
    found: Spans = []
    if b"@" in data:
        found += [("email", *span) for span in _emails(text)]
    digits = data.translate(_DIGIT_MARK)
    if b"d.d" in digits:
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                found.append(("ip", m.start(), m.end()))
    if digits.count(b"d") >= 13:
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 13:
                number = m[0].replace(" ", "").replace("-", "")
                if 13 <= len(number) <= 19 and luhn(number):
                    found.append(("card", m.start(), m.end()))
    if b"+d" in digits:
        for m in PHONE.finditer(text):
            if 9 <= sum(c in "0123456789" for c in m[0]) <= 15:
                found.append(("phone", m.start(), m.end()))
    return found


class Rewritten:
    """A text with the source range of each character."""

    def __init__(self, text: str):
        self.text = text
        self.start = np.arange(len(text))
        self.end = self.start + 1
        self.changed = False

    def replace(self, changes: list[tuple[int, int, str]]) -> None:
        """Put texts in the place of ranges, which come in order; each new character stands for its whole range."""
        if not changes:
            return
        texts, at = [], 0
        for begin, until, new in changes:
            texts += [self.text[at:begin], new]
            at = until
        begins, untils = np.array([c[0] for c in changes]), np.array([c[1] for c in changes])
        lengths = [len(c[2]) for c in changes]
        inside = np.zeros(len(self.text) + 1, np.int64)
        np.add.at(inside, begins, 1)
        np.add.at(inside, untils, -1)
        kept = np.flatnonzero(np.cumsum(inside)[:-1] == 0)
        where = np.repeat(np.searchsorted(kept, begins), lengths)
        # sources never go backwards, so a range begins with that of its first character and ends with that of its last
        self.start = np.insert(self.start[kept], where, np.repeat(self.start[begins], lengths))
        self.end = np.insert(self.end[kept], where, np.repeat(self.end[untils - 1], lengths))
        self.text = "".join([*texts, self.text[at:]])
        self.changed = True

    def source(self, begin: int, until: int) -> tuple[int, int]:
        return int(self.start[begin:until].min()), int(self.end[begin:until].max())


def plain_character(c: str) -> str:
    """The ASCII character a look-alike stands for, nothing for an invisible one, else the character itself."""
    if c in INVISIBLE:
        return ""
    if c in LOOK_ALIKES:
        return LOOK_ALIKES[c]
    digit = unicodedata.decimal(c, None)
    if digit is not None:
        return str(digit)
    folded = unicodedata.normalize("NFKC", c)
    return folded if folded.isascii() and folded else c


def _digits(run: re.Match) -> list[tuple[int, int, str]]:
    """The changes in a run of four digits or more, at least two of them spelled: one name may be a word after a number."""
    out, digits, named = [], 0, 0
    for m in _ONE_NAME.finditer(run[0]):
        name = m[0].lower()
        if name[0] in "0123456789":
            digits += len(name)
            continue
        if name in DIGIT_NAMES:
            digits, named, new = digits + 1, named + 1, DIGIT_NAMES[name]
        else:
            new = "+" if name.startswith("plus") else "" if name == "," else " "
        out.append((run.start() + m.start(), run.start() + m.end(), new))
    return out if named >= 2 and digits >= 4 else []


def _some_spelled(words: list[str]) -> bool:
    kinds = bytes(_NAMED if word in DIGIT_NAMES else _PLAIN if word[-1] in "0123456789" else 0 for word in words)
    return any(pair in kinds for pair in _SPELLED)


def _address(run: re.Match) -> list[tuple[int, int, str]]:
    new = lambda part: "." if "dot" in part else DIGIT_NAMES.get(part, "")
    return [(run.start() + m.start(), run.start() + m.end(), new(m[0].lower())) for m in _IP_PART.finditer(run[0])]


def rewritten(text: str, data: bytes) -> Rewritten | None:
    """The text without disguises, or None if it holds none."""
    out = Rewritten(text)
    if not text.isascii():
        out.replace([(m.start(), m.end(), new) for m in _FOREIGN.finditer(text) if (new := plain_character(m[0])) != m[0]])
    lower = out.text.lower()
    words = lower.replace("-", " ").replace(",", " ").split()
    dots = words.count("dot")
    bracketed = any(sign in lower for sign in "[({<")
    if bracketed and ("at" in lower or "@" in lower):
        out.replace([(m.start(), m.end(), "@") for m in _SIGN_AT.finditer(out.text)])
    if dots and "at" in words:
        out.replace([(m.start(), m.end(), "@") for m in _WRITTEN.finditer(out.text)])
    if bracketed and any(name in lower for name in ("dot", "punkt", "point", "punto", "[.]", "(.)")):
        out.replace([(m.start(), m.end(), ".") for m in _SIGN_DOT.finditer(out.text)])
    if dots and "@" in out.text:
        near = [(m.start(), m.end()) for m in _NEAR_AT.finditer(out.text)]
        out.replace(_held([(m.start(), m.end(), ".") for m in _WRITTEN_DOT.finditer(out.text)], near))
    if dots >= 3:
        out.replace([change for run in _SPELLED_IP.finditer(out.text) for change in _address(run)])
    if sum(map(DIGIT_NAMES.__contains__, words)) >= 2 and _some_spelled(words):
        out.replace([change for run in _DIGIT_RUN.finditer(out.text) for change in _digits(run)])
    if dots:
        out.replace([(m.start(), m.end(), ".") for m in _IP_DOTS.finditer(out.text)])
    return out if out.changed else None


def _held(dots: list[tuple[int, int, str]], ranges: list[tuple[int, int]]) -> list[tuple[int, int, str]]:
    """The dots that lie in one of the ranges."""
    firsts = np.array([a for a, _ in ranges])
    at = np.searchsorted(firsts, [d[0] for d in dots], "right") - 1
    return [d for d, i in zip(dots, at, strict=True) if i >= 0 and d[0] < ranges[i][1]]


def disguised_spans(text: str, data: bytes, base: Spans) -> Spans:
    """What the rewritten text shows beyond the base, at its source characters."""
    plain = rewritten(text, data)
    if plain is None:
        return []
    found = []
    for kind, begin, until in base_spans(plain.text):
        start, end = plain.source(begin, until)
        if not any(kind == k and s <= start and end <= e for k, s, e in base):
            found.append((kind, start, end))
    return found


def joined(spans: Spans) -> str:
    ordered = sorted(set(spans), key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in ordered)


def all_spans(text: str) -> tuple[Spans, Spans]:
    data = text.encode("utf-8", "surrogatepass")
    base = base_spans(text, data)
    return base, disguised_spans(text, data, base)


def find_personal_data(docs: DataFrame) -> DataFrame:
    """One row per document: its base spans and all spans."""

    def scan(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            found = [all_spans(value.as_py() or "") for value in batch.column(1)]
            columns = [pa.array([joined(b) for b, _ in found], pa.string()), pa.array([joined(b + d) for b, d in found], pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "base_spans", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(scan, f"doc_id {kind}, base_spans string, spans string")


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base spans by kind and their checksum, beside all spans."""
    parts = F.filter(F.split("base_spans", ","), lambda s: s != "")
    count = lambda kind: F.size(F.filter(parts, lambda s: s.startswith(f"{kind}:"))).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[count(k) for k in KINDS], F.sha2("base_spans", 256).alias("base_sha256"), "spans")


def masked_text(text: str | None) -> str | None:
    """The text with every finding replaced by its kind in brackets; overlapping ones become the first of them."""
    if not text:
        return text
    base, more = all_spans(text)
    if not base and not more:
        return text
    out, at = [], 0
    for kind, start, end in sorted(base + more, key=lambda s: (s[1], KINDS.index(s[0]), -s[2])):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def mask_personal_data(docs: DataFrame) -> DataFrame:
    """The documents with personal data masked; ``n_chars``, where there is one, counts the new text."""

    @F.arrow_udf("string")
    def masked(column):
        import pyarrow as pa

        return pa.array([masked_text(value.as_py()) for value in column], pa.string())

    kept = docs.withColumn("text", masked("text"))
    return kept.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars")) if "n_chars" in docs.columns else kept
