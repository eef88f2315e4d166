"""Token ids of whole texts by a public tokenizer, word by word through a bounded cache."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

from silverline.llm.common import process_cache

# How byte-level vocabularies spell bytes. Printable ones stand for themselves, the others follow 255 in order.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
# Characters on which splitting by Python and by the tokenizer differ; such texts go to the tokenizer whole.
_ODD_SPACES = tuple(map(chr, (0x1C, 0x1D, 0x1E, 0x1F, 0x180E)))
# Where the vocabulary divides lower-case text, for the characters above and for white space.
_PIECES = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+")
_OTHER = re.compile(r"[^\t-\r -~À-ÖØ-öø-ÿ]")
_SLICE = 1 << 20


class _Recent(dict):
    """A dictionary of at most about two times ``bound`` entries that keeps those in use."""

    def __init__(self, make: Callable, bound: int):
        super().__init__()
        self.make, self.bound, self.old = make, bound, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.bound:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def slices(text: str) -> Iterator[str]:
    """A text in slices of about a million characters, cut at white space."""
    start = 0
    while len(text) - start > _SLICE:
        cut = re.compile(r"\s").search(text, start + _SLICE)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:] if start else text


class WordTokenizer:
    """Ids of a text as little-endian unsigned 32-bit integers.

    The vocabulary lowers letters, drops white space, divides text by one pattern and spells each part by itself. A
    text of Latin letters, digits and ASCII signs is divided here and its parts are spelled by the tokenizer's model,
    each once while it is remembered. Of any other text, each word goes through the whole tokenizer. Tokens added to the
    vocabulary, such as ends of texts, have their own ids where a text spells them, and divide it.
    """

    def __init__(self, path: str, bound: int = 150_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = {token.content: (number, token) for number, token in self.tokenizer.get_added_tokens_decoder().items()}
        self.added = {content: number.to_bytes(4, "little") for content, (number, _) in added.items()}
        # such tokens stand as they are spelled; others are left to the whole tokenizer
        self.divides = all(not (t.lstrip or t.rstrip or t.single_word or t.normalized) for _, t in added.values())
        self.at_added = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")")
        spelled, extra = {}, 256
        for byte in range(256):
            if byte in _PRINTABLE:
                spelled[byte] = chr(byte)
            else:
                spelled[byte] = chr(extra)
                extra += 1
        self.spelled = spelled
        self.model = self.tokenizer.model
        self.parts = _Recent(self._part, bound)
        self.words = _Recent(self._whole, bound // 5)

    def _part(self, part: str) -> bytes:
        tokens = self.model.tokenize(part.encode().decode("latin-1").translate(self.spelled))
        return b"".join([t.id.to_bytes(4, "little") for t in tokens])

    def _whole(self, text: str) -> bytes:
        return b"".join([i.to_bytes(4, "little") for i in self.tokenizer.encode(text, add_special_tokens=False).ids])

    def ids(self, text: str) -> bytes:
        if not self.divides:
            return self._whole(text)
        if any(token in text for token in self.added):
            return b"".join([self.added.get(part) or self._plain(part) for part in self.at_added.split(text)])
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        if _OTHER.search(text) is None:
            return b"".join(b"".join(map(self.parts.__getitem__, _PIECES.findall(part))) for part in slices(text.lower()))
        if any(c in text for c in _ODD_SPACES):
            return self._whole(text)
        return b"".join(b"".join(map(self.words.__getitem__, part.split())) for part in slices(text))


def word_tokenizer(path: str) -> WordTokenizer:
    """The tokenizer of a file, loaded once per worker process."""
    cache = process_cache("word_tokenizer")
    if path not in cache:
        cache[path] = WordTokenizer(path)
    return cache[path]
