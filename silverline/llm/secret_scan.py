"""Secret scans through nested encodings.

Every text is scanned as it stands; those spans are the base. Then a worklist unwraps what is encoded in it: percent
escapes, Unicode and HTML escapes, base64 runs, and gzip, zlib or bzip2 data, all members of it, inside base64 or percent
escapes. Base64 may be wrapped: runs with one line break between them, indented or not, are joined. As a word on the line
before or after may look like one more line of it, lines of equal length are tried without their neighbours too, and
single lines where none of that can be read. Each layer is scanned, put
on the list again, and never visited twice, so the work ends at a fixpoint even when layers decode to each other.
Each character of a layer keeps the range of source characters it came from; a secret found in a layer is reported
at that range of the source.

Base64 is also found behind other signs of its kind, such as the parts of a path, an id, or a word of letters
(:func:`_behind`). What it holds is text if nearly all of it is printable, as UTF-8 with single faults let through, Latin-1
among them, or as UTF-16; compressed data is scanned whatever it looks like.

Spans are ``kind:start:end`` in code points, end exclusive, and cover the whole match. Defined cases: a null or empty
text has no spans; every row is scanned, repeated ones too; texts of any length are scanned whole. A compressed layer of
any size is read to its end by one rule: in windows of ``most`` bytes that overlap, so memory stays bounded. A window
starts with the encoded run that the last one ended in; a run longer than a window that is compressed data goes through
the next decompressor as it comes. Compressed data in compressed data is followed until it unfolds to itself.
``layers_cut`` counts what could not be read whole: compressed streams that break off, and layers with a run of plain
base64 or of escapes of more than ``most`` characters, which is decoded in pieces, so that compressed data encoded once
more inside it is not followed.
"""

from __future__ import annotations

import base64
import bz2
import codecs
import hashlib
import re
import zlib
from bisect import bisect_right
from collections.abc import Generator, Iterable, Iterator
from itertools import accumulate, chain
from urllib.parse import unquote_to_bytes

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex")
MOST = 1 << 24
_NAME_SIGNS = 64  # characters before a run that may name it
OVERLAP = 1 << 12  # characters; a secret needs fewer, as spaces in a row count as one between windows
FED, MADE = 1 << 12, 1 << 20  # bytes given to and taken from a decompressor at a time

# The patterns of the contract.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
LEAST = {"assign": 8, "access": 16, "hex": 32}

_NAMES = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_HEX_MARK = bytes(ord("h") if chr(b) in "0123456789abcdef" else 32 for b in range(256))
_B64_MARK = bytes(ord("b") if chr(b) in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_" else 32 for b in range(256))
_SHORTEST = 19  # characters of the shortest base64 run that can hold a secret: ``token=`` and eight more
_LINE = re.compile(r"[A-Za-z0-9+/_-]+")
_PART = re.compile(r"[/_-]")  # signs of base64 that also stand between parts of paths and ids
_B64 = re.compile(r"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-]++(?:(?:\r\n?|\n)[ \t]*+[A-Za-z0-9+/_-]++)++|[A-Za-z0-9+/_-]{%d,}+)={0,2}" % _SHORTEST)
_WRAP = re.compile(rb"(?:\r\n?|\n)[ \t]*+")
_URL_BYTES = re.compile(r"(?:%[0-9A-Fa-f]{2}|[A-Za-z0-9_.~+/!*'()-])++")
_URL_BYTE = re.compile(r"%[0-9A-Fa-f]{2}|.")
_URL_PACKED = re.compile(
    r"%1[fF]%8[bB]%08|(?:x|%78)%(?:01|5[eE]|9[cC]|[dD][aA])"
    r"|(?:B|%42)(?:Z|%5[aA])(?:h|%68)(?:[1-9]|%3[1-9])(?:1|%31)(?:A|%41)(?:Y|%59)%26(?:S|%53)(?:Y|%59)"
)
_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPES = re.compile(r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})|&#[xX]([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});")
_OPEN = re.compile(r"(?:[A-Za-z0-9+/_=%\\{}&#;.~-]|[ \t]*+[\r\n])*+")  # an encoded run, read from its end
_ESCAPE_SIGNS = (b"\\u", b"\\U", b"\\x", b"&#")

Spans = list[tuple[str, int, int]]


def base_spans(text: str, data: bytes | None = None) -> Spans:
    """Matches in a text as it stands. The bytes tell cheaply which patterns can match at all."""
    data = text.encode("utf-8", "surrogatepass") if data is None else data
    found: Spans = []
    lower = data.lower()
    if any(name in lower for name in _NAMES):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if b"AKIA" in data:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    if b"h" * LEAST["hex"] in data.translate(_HEX_MARK):
        found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return found


class Layer:
    """A decoded text; character i came from the source characters ``start[i]`` to ``end[i]``."""

    def __init__(self, text: str, start: np.ndarray, end: np.ndarray):
        self.text, self.start, self.end = text, start, end

    def source(self, begin: int, until: int) -> tuple[int, int]:
        return int(self.start[begin:until].min()), int(self.end[begin:until].max())


def _unprintable(text: str) -> int:
    """Characters that no text shows; bytes that are no UTF-8 count as Latin-1."""
    odd = [c for c in set(text) if not (c.isprintable() or c in "\n\r\t\ufeff" or "\udca0" <= c <= "\udcff")]
    return sum(map(text.count, odd)) if len(odd) <= 16 else len(text) - len(text.translate(dict.fromkeys(map(ord, odd))))


def _codec(head: bytes) -> str:
    """UTF-16 by its mark, or where nearly every second byte is zero; else UTF-8."""
    if head[:2] in (b"\xff\xfe", b"\xfe\xff"):
        return "utf-16-le" if head[0] == 0xFF else "utf-16-be"
    half = len(head) // 2
    if half >= 8 and head[1::2].count(0) >= 0.9 * half and head[::2].count(0) <= 0.1 * half:
        return "utf-16-le"
    if half >= 8 and head[::2].count(0) >= 0.9 * half and head[1::2].count(0) <= 0.1 * half:
        return "utf-16-be"
    return "utf-8"


def _faults(codec: str) -> str:
    return "surrogateescape" if codec == "utf-8" else "replace"


def _readable(data: bytes) -> tuple[str, np.ndarray] | None:
    """Bytes as text, and the bytes of each character, if nearly all of it is printable; single faults are let through."""
    codec = _codec(data[:4096])
    data = data if codec == "utf-8" else data[: len(data) // 2 * 2]
    text = data.decode(codec, _faults(codec))
    if not text or _unprintable(text) > 0.05 * len(text):
        return None
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    raw = (codes >= 0xDC80) & (codes <= 0xDCFF)  # bytes that stand for themselves
    if codec != "utf-8":
        return text, np.where(codes > 0xFFFF, 4, 2)
    if raw.sum() > 0.2 * len(codes):
        return None
    return text, np.where(raw, 1, 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000))


def _replaced(layer: Layer, pattern: re.Pattern, read) -> Layer | None:
    """The layer with every match of a pattern replaced by what ``read`` makes of it; None if nothing changed."""
    texts, starts, ends, at, changed = [], [], [], 0, False
    for m in pattern.finditer(layer.text):
        made = read(m)
        if made is None:
            continue
        text, begin, until = made  # places of each character within the match
        texts += [layer.text[at : m.start()], text]
        begin, until = np.asarray(begin, np.int64) + m.start(), np.asarray(until, np.int64) + m.start()
        starts += [layer.start[at : m.start()], layer.start[begin]]
        ends += [layer.end[at : m.start()], layer.end[until - 1]]
        at, changed = m.end(), True
    if not changed:
        return None
    texts.append(layer.text[at:])
    return Layer("".join(texts), np.concatenate([*starts, layer.start[at:]]), np.concatenate([*ends, layer.end[at:]]))


def _percent(m: re.Match):
    data = bytes.fromhex(m[0].replace("%", ""))
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError:
        text = data.decode("latin-1")
        return text, [3 * i for i in range(len(text))], [3 * i + 3 for i in range(len(text))]
    sizes = np.cumsum([0, *[len(c.encode()) for c in text]])
    return text, 3 * sizes[:-1], 3 * sizes[1:]


def _escape(m: re.Match):
    code = int(next(g for g in m.groups()[:5] if g), 16) if m[6] is None else int(m[6])
    if code > 0x10FFFF or 0xD800 <= code < 0xE000:
        return None
    return chr(code), [0], [m.end() - m.start()]


def _decompressor(head: bytes):
    """What unfolds data that starts like this; None if it is not compressed."""
    if head[:2] == b"\x1f\x8b":
        return zlib.decompressobj(31)
    if head[:1] == b"\x78" and len(head) > 2 and int.from_bytes(head[:2], "big") % 31 == 0:
        return zlib.decompressobj()
    return bz2.BZ2Decompressor() if head[:3] == b"BZh" else None


class _Unfolded:
    """The pieces that compressed pieces unfold to, member after member.

    ``cut`` tells whether a stream broke off, ``used`` how many bytes were read up to the end of the last member.
    """

    def __init__(self, pieces: Iterator[bytes]):
        self.pieces, self.cut, self.used = pieces, False, 0

    def __iter__(self) -> Iterator[bytes]:
        unfold, data, given, made, sure = None, b"", 0, False, False
        for piece in chain(self.pieces, [None]):  # None: the end
            given += len(piece or b"")
            data += piece or b""
            while True:
                if unfold is None:
                    data = data.lstrip(b"\0") if made else data  # members may be padded
                    if len(data) < 10 and piece is not None:
                        break
                    if (unfold := _decompressor(data)) is None:
                        return
                    sure = data[:3] == b"\x1f\x8b\x08" or data[4:10] == b"1AY&SY"
                try:
                    out = unfold.decompress(data, MADE)
                except (zlib.error, OSError, ValueError, EOFError):
                    self.cut = made or sure
                    return
                data = getattr(unfold, "unconsumed_tail", b"")
                if out:
                    made = True
                    yield out
                if unfold.eof:
                    data, unfold = unfold.unused_data, None
                    self.used = given - len(data)
                elif not data and len(out) < MADE:
                    break
        self.cut = self.cut or unfold is not None


def _sliced(data: bytes) -> Iterator[bytes]:
    for at in range(0, len(data), FED):
        yield data[at : at + FED]


def _gathered(pieces: Iterator[bytes], least: int) -> bytes:
    """The next pieces, together at least so many bytes if there are as many."""
    parts, held = [], 0
    for piece in pieces:
        parts.append(piece)
        held += len(piece)
        if held >= least:
            break
    return b"".join(parts)


class _Inside:
    """What compressed data holds, compressed layers inside it unfolded too: its first bytes, and an iterator of the rest.

    The data comes in pieces, of which no more are taken than needed. ``head`` is None if it is not compressed. ``cut``
    tells, after the end, whether anything was not read.
    """

    def __init__(self, pieces: Iterator[bytes], size: int, most: int):
        self.head, self.streams, self.more, self.broken, self.most = None, [], [], False, most
        self.folded, self.size = False, size
        self.rest = pieces = iter(pieces)
        head, rest, seen = _gathered(pieces, 16), pieces, set()
        while _decompressor(head) is not None:
            mark = hashlib.sha256(head).digest()
            if mark in seen:  # it unfolds to itself
                self.broken = next(iter(rest), None) is not None
                break
            seen.add(mark)
            stream = _Unfolded(chain(_sliced(head), rest))
            pieces = iter(stream)
            inner = _gathered(pieces, most)
            if inner or stream.cut:
                self.streams.append(stream)
            if not inner:
                break
            head, rest = inner, pieces
            self.head, self.rest, self.folded = head, rest, True

    @property
    def cut(self) -> bool:
        return self.broken or any(stream.cut for stream in (*self.streams, *self.more))

    @property
    def used(self) -> int:
        """Bytes up to the end of the last member, as far as it is known."""
        return (not self.cut and self.streams and self.streams[0].used) or self.size

    def texts(self) -> Iterator[str]:
        """The text in windows of about ``most`` bytes, as it is: what was compressed need not look like text."""
        if self.head is None:
            return
        codec = _codec(self.head[:4096])
        decoder, text, data, self.head = codecs.getincrementaldecoder(codec)(_faults(codec)), "", self.head, None
        while data:
            after = _gathered(self.rest, self.most)
            text = text + decoder.decode(data, not after)
            if after:
                text = re.sub("  +", " ", text)
            data = after
            if not data:
                yield text
                return
            start = len(text) - _OPEN.match(text[::-1]).end()
            if len(text) - start <= self.most:  # what a run holds is read in the window that has all of it
                yield text[:start]
                text = text[max(0, min(len(text) - min(OVERLAP, self.most // 2), start - _NAME_SIGNS)) :]
                continue
            if _looks_packed(text[start : start + 400]):
                # a run longer than a window goes through the next decompressor as it comes
                yield text[:start]
                run = _Run(text[start:], chain([data], iter(lambda: _gathered(self.rest, self.most), b"")), decoder)
                inner = _Inside(_base64_pieces(run), 0, self.most)
                yield from inner.texts()
                for _ in run:
                    pass
                self.more.append(inner)
                text, data = run.left, b"" if run.ended else _gathered(self.rest, self.most)
                if run.left and not data:
                    yield run.left
                continue
            yield text
            self.broken = True  # what is encoded once more inside such a run is read in pieces too
            at = max(0, len(text) - min(OVERLAP, self.most // 2))
            signs = sum(c.isalnum() or c in "+/_-" for c in text[start:at])
            while signs % 4 and at < len(text):  # base64 goes on with a group of four
                signs += text[at].isalnum() or text[at] in "+/_-"
                at += 1
            text = text[at:]


_NOT_IN_RUN = re.compile(r"[^A-Za-z0-9+/_=\r\n\t -]")
_NO_SIGN = re.compile(r"[^A-Za-z0-9+/_-]+")
_SIGNS = str.maketrans("-_", "+/")


class _Run:
    """The signs of an encoded run that begins in one window and goes on in the next ones; what follows it is ``left``."""

    def __init__(self, text: str, pieces: Iterator[bytes], decoder):
        self.text, self.pieces, self.decoder, self.left, self.ended = text, pieces, decoder, "", False

    def __iter__(self) -> Iterator[str]:
        while self.text:
            text, self.text = self.text, ""
            if (end := _NOT_IN_RUN.search(text)) is not None:
                self.left = text[end.start() :]
                yield _NO_SIGN.sub("", text[: end.start()])
                return
            piece = next(self.pieces, b"")
            self.ended = not piece
            self.text = self.decoder.decode(piece, self.ended)
            yield _NO_SIGN.sub("", text)


def _base64_pieces(signs: Iterable[str]) -> Iterator[bytes]:
    """What signs of base64 stand for, a few bytes first and some thousand at a time then."""
    held, least = "", 64
    for part in signs:
        held += part
        at = 0
        while len(held) - at >= least:
            yield base64.b64decode(held[at : at + least].translate(_SIGNS))
            at, least = at + least, FED
        held = held[at:]
    held = held[: len(held) - (len(held) % 4 == 1)]
    if held:
        yield base64.b64decode(held.translate(_SIGNS) + "=" * (-len(held) % 4))


def _looks_packed(start: str) -> bool:
    """Whether a run of base64 that starts like this is compressed data."""
    signs = _NO_SIGN.sub("", start)[:16]
    return len(signs) >= 4 and _decompressor(base64.b64decode(signs[: len(signs) // 4 * 4].translate(_SIGNS))) is not None


class _Lines:
    """Lines of base64 that may be one run."""

    def __init__(self, text: str, spans: list[tuple[int, int]]):
        self.text, self.spans = text, spans
        self.before = [0, *accumulate(b - a for a, b in spans)]

    def signs(self, first: int, last: int) -> int:
        return self.before[last + 1] - self.before[first]

    def pieces(self, first: int, last: int) -> Iterator[str]:
        for i in range(first, last + 1):
            for at in range(self.spans[i][0], self.spans[i][1], FED):
                yield self.text[at : min(at + FED, self.spans[i][1])]

    def place(self, sign: int) -> int:
        """Where a sign stands in the text."""
        i = bisect_right(self.before, sign) - 1
        return self.spans[i][0] + sign - self.before[i]


def _decoded(layer: Layer, lines: _Lines, i: int, last: int, end: int, most: int, packed: bool | None = None) -> Generator[Layer, None, tuple[int, bool]]:
    """The text of a base64 run in lines ``i`` to ``last``; returns how many signs were read and whether any were cut.

    ``packed`` asks for compressed data only, or, if False, for anything else.
    """
    signs = lines.signs(i, last)
    signs -= signs % 4 == 1
    begin, cut = lines.spans[i][0], False
    if packed is not False and _looks_packed(layer.text[begin : begin + 400]):
        inside = _Inside(_base64_pieces(lines.pieces(i, last)), signs * 3 // 4, most)
        for text in inside.texts():  # any character may come from the whole run
            read = -(-4 * inside.used // 3)
            until = end if read >= signs else lines.place(lines.before[i] + read - 1) + 1
            at = layer.source(begin, until)
            yield Layer(text, *(np.broadcast_to(np.int64(place), len(text)) for place in at))
        if inside.folded or inside.cut:
            return (0 if inside.cut else min(signs, -(-4 * inside.used // 3))), inside.cut
    if packed:
        return 0, cut
    read = _readable(b"".join(_base64_pieces(lines.pieces(i, last))))
    if read is None:
        return 0, cut
    text, sizes = read
    where = np.concatenate([np.arange(*span) for span in lines.spans[i : last + 1]])
    after = np.cumsum(sizes)
    sign = lambda byte: byte // 3 * 4 + byte % 3  # noqa: E731  the first of two signs that hold a byte
    yield Layer(text, layer.start[where[sign(after - sizes)]], layer.end[where[np.minimum(sign(after - 1) + 1, len(where) - 1)]])
    return signs, cut


def _some_text(signs: str) -> bool:
    data = base64.b64decode(signs[: len(signs) // 4 * 4].translate(_SIGNS))
    return len(data) >= 12 and (_readable(data) is not None or _decompressor(data) is not None)


def _behind(layer: Layer, begin: int, end: int, most: int) -> Generator[Layer, None, bool]:
    """Base64 behind other signs of the same kind, such as the parts of a path or an id: where a sign that may stand
    between parts has passed, or at another of the four alignments. Returns whether anything was cut."""
    text, cut, at = layer.text, False, begin
    shifted = begin + 4 * ((end - begin) // 8)  # in the middle, for alignments that begin with signs of something else
    starts = [begin + k for k in (1, 2, 3) if _some_text(text[shifted + k : min(shifted + k + 24, end)])]
    starts = sorted({*starts, *(m.end() for m in _PART.finditer(text, begin, end))})
    for start in starts:
        head = text[start : min(start + 24, end)]
        if start < at or end - start < _SHORTEST or not (start - begin <= 3 or _some_text(head)):
            continue
        until = end
        if not _looks_packed(head):  # as far as it can be read
            for piece in range(start, end, 256):
                chunk = text[piece : min(piece + 256, end)]
                shown = base64.b64decode(chunk[: len(chunk) // 4 * 4].translate(_SIGNS)).decode("utf-8", "surrogateescape")
                if _unprintable(shown) > 0.3 * len(shown):
                    until = piece
                    break
            if until < end:
                parts = [m.start() for m in _PART.finditer(text, max(start, until - 1), min(until + 256, end))]
                until = parts[0] if parts else until
        for stop in dict.fromkeys((until, next((m.start() for m in _PART.finditer(text, start, end)), until))):
            if stop - start < _SHORTEST:
                continue
            read, was_cut = yield from _decoded(layer, _Lines(text, [(start, stop)]), 0, 0, stop, most)
            cut |= was_cut
            if read:
                at = stop
                break
    return cut


def _unpacked(layer: Layer, most: int, cuts: list[int]) -> Iterator[Layer]:
    """The texts inside base64 runs, unfolded where they are compressed."""
    for m in _B64.finditer(layer.text):
        lines = _Lines(layer.text, [x.span() for x in _LINE.finditer(layer.text, *m.span())])
        sizes = [b - a for a, b in lines.spans]
        top = len(sizes) - 1
        alike = list(range(len(sizes)))  # the last of the lines of equal length that follow each other
        for i in range(top - 1, -1, -1):
            alike[i] = alike[i + 1] if sizes[i] == sizes[i + 1] else i
        i, fresh = 0, True
        while i <= top:
            ends = {top} if fresh else set()
            begins = fresh or sizes[i] != sizes[i - 1]
            if begins or _looks_packed(layer.text[slice(*lines.spans[i])][:16]):
                after = min(alike[i] + 1, top)
                ends |= {alike[i], after, alike[after], min(alike[after] + 1, top)}
            ends = ends - {i} if begins else {max(ends, default=i)}  # a stream that fails in more lines fails in fewer
            read, was_cut, last = 0, False, i
            for last in sorted(ends, reverse=True):
                if lines.signs(i, last) >= _SHORTEST:
                    until = m.end() if last == top else lines.spans[last][1]
                    read, was_cut = yield from _decoded(layer, lines, i, last, until, most, None if begins else True)
                if read or was_cut:
                    break
            if not read and not was_cut:
                last = i
                if sizes[i] >= _SHORTEST:
                    until = m.end() if i == top else lines.spans[i][1]
                    read, was_cut = yield from _decoded(layer, lines, i, i, until, most, None if begins else False)
                    if not read and not was_cut:
                        was_cut = yield from _behind(layer, *lines.spans[i], most)
            cuts.append(was_cut)
            fresh = read > 0 and last > i
            i += 1  # past the lines that were read to their end
            read -= sizes[i - 1]
            while read > 0 and i <= last:
                read -= sizes[i]
                i += 1


def _url_packed(layer: Layer, most: int, cuts: list[int]) -> Iterator[Layer]:
    """The texts inside compressed data whose bytes stand as percent escapes."""
    at = 0
    while m := _URL_PACKED.search(layer.text, at):
        run = _URL_BYTES.match(layer.text, m.start())[0]
        places = np.array([x.end() for x in _URL_BYTE.finditer(run)]) + m.start()
        at, was_cut = m.end(), False
        for form in dict.fromkeys((run, run.replace("+", "%20"))):  # a plus may stand for a space
            unquoted = unquote_to_bytes(form)
            inside = _Inside(_sliced(unquoted), len(unquoted), most)
            for text in inside.texts():
                source = layer.source(m.start(), int(places[inside.used - 1]))
                yield Layer(text, *(np.broadcast_to(np.int64(place), len(text)) for place in source))
            was_cut = inside.cut
            if inside.folded and not inside.cut:
                at = max(at, int(places[inside.used - 1]))
                break
        cuts.append(was_cut)


def _inner(layer: Layer, most: int, cuts: list[int]) -> Iterator[Layer]:
    """The layers inside a layer, one at a time."""
    for pattern, read in ((_PERCENT, _percent), (_ESCAPES, _escape)):
        if (new := _replaced(layer, pattern, read)) is not None:
            yield new
    if "%" in layer.text:
        yield from _url_packed(layer, most, cuts)
    yield from _unpacked(layer, most, cuts)


def hidden_spans(text: str, data: bytes, most: int = MOST) -> tuple[Spans, int]:
    """Secrets in the layers of a text, at their places in the text, and how many layers were cut."""
    percent, escaped = b"%" in data, any(sign in data for sign in _ESCAPE_SIGNS)
    unbroken = _WRAP.sub(b"", data) if b"\n" in data or b"\r" in data else data
    packed = b"b" * _SHORTEST in unbroken.translate(_B64_MARK)
    if not (percent or escaped or packed):
        return [], 0
    if not packed and not (percent and _PERCENT.search(text)) and not (escaped and _ESCAPES.search(text)):
        return [], 0
    places = np.arange(len(text))
    seen, found, cuts = {hashlib.sha256(data).digest()}, [], []
    waiting = [_inner(Layer(text, places, places + 1), most, cuts)]  # of each layer on the way, what is left in it
    while waiting:
        new = next(waiting[-1], None)
        if new is None:
            waiting.pop()
            continue
        content = new.text.encode("utf-8", "surrogatepass")
        mark = hashlib.sha256(content + b"|%d" % (new.start[0] if len(new.start) else 0)).digest()
        if mark in seen:
            continue
        seen.add(mark)
        found += [(kind, *new.source(begin, until)) for kind, begin, until in base_spans(new.text, content)]
        waiting.append(_inner(new, most, cuts))
    return found, sum(cuts)


def joined(spans: Spans) -> str:
    ordered = sorted(set(spans), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in ordered)


def scan_secrets(docs: DataFrame, most: int = MOST) -> DataFrame:
    """One row per document: its base spans and all spans, as joined text and as an array."""

    def scan(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            base, every, cuts = [], [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                data = text.encode("utf-8", "surrogatepass")
                own = base_spans(text, data)
                hidden, cut = hidden_spans(text, data, most)
                base.append(joined(own))
                every.append(joined(own + hidden))
                cuts.append(cut)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(base, pa.string()), pa.array(every, pa.string()), pa.array(cuts, pa.int64())],
                ["doc_id", "base_spans", "spans", "layers_cut"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(scan, f"doc_id {kind}, base_spans string, spans string, layers_cut long")


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base spans by kind and their checksum, beside all spans."""
    parts = F.filter(F.split("base_spans", ","), lambda s: s != "")
    count = lambda kind: F.size(F.filter(parts, lambda s: s.startswith(f"{kind}:"))).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[count(k) for k in KINDS], F.sha2("base_spans", 256).alias("base_sha256"), "spans", "layers_cut")
