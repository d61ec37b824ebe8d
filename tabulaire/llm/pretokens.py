"""Exact pre-token splitting in front of the public tokenizers.

Byte-pair merges never cross a pre-token, so a text's ids are the ids of its
pre-tokens in order, and these can be remembered. Long texts are first cut
where a pre-token begins in any case, so that no step holds more than a part of
a text. Parts of ``PLAIN`` characters, whose case mapping, normal form and class
leave no room for differing Unicode versions, are split by a compiled pattern;
all other parts by the library's own normaliser and pre-tokenizer, so pre-tokens
are always the library's. Special strings are one id each, as the library has it.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator

#: Ranges of characters (first, last) that canonical composition, lower-casing and both pattern engines
#: treat alike, one by one: ASCII but for four separators, Latin, common dashes, quotes and signs, Greek without the capital sigma, Cyrillic,
#: Hebrew and Arabic letters, kana, ideographs, hangul syllables and full-width stops. No marks, no case by context.
_RANGES = (
    (0, 27), (32, 126), (161, 172), (174, 303), (305, 383), (0x0386, 0x0386), (0x0388, 0x038A), (0x038C, 0x038C), (0x038E, 0x03A1), (0x03A4, 0x03CE), (0x0400, 0x045F),
    (0x05D0, 0x05EA), (0x0621, 0x063A), (0x0641, 0x064A), (0x2010, 0x2027), (0x20AC, 0x20AC), (0x2122, 0x2122), (0x3001, 0x3003), (0x3008, 0x3011), (0x3041, 0x3096), (0x30A1, 0x30FA),
    (0x30FC, 0x30FC), (0x4E00, 0x9FA5), (0xAC00, 0xD7A3), (0xFF01, 0xFF01), (0xFF08, 0xFF09), (0xFF0C, 0xFF0C), (0xFF1A, 0xFF1B), (0xFF1F, 0xFF1F),
)
_PLAIN = [c for first, last in _RANGES for c in range(first, last + 1)]
#: Latin-1 bytes of the characters that are not plain.
_ODD_BYTES = bytes(c for c in range(256) if c not in set(_PLAIN))


def _among(codes: Iterable[int]) -> str:
    """The inside of a pattern's character class, in ranges."""
    runs: list[list[int]] = []
    for c in codes:
        if runs and c == runs[-1][1] + 1:
            runs[-1][1] = c
        else:
            runs.append([c, c])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in runs)


_L, _N = (_among(c for c in _PLAIN if unicodedata.category(chr(c))[0] == kind) for kind in "LN")
_ODD = re.compile(f"[^{_among(_PLAIN)}]")

#: The public patterns that the two tokenizers split with, on plain texts.
WORD_END_SPLIT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^\\s{_L}{_N}]+")
BYTE_LEVEL_SPLIT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^\\s{_L}{_N}]+|\\s+(?!\\S)|\\s+")

#: Where a pre-token begins whatever is around: a single blank between words, and a full-width stop after an ideograph, kana or hangul syllable.
_CUT = re.compile("(?<=\\w) (?=\\w)|(?<=[\u3041-\u30fa\u4e00-\u9fa5\uac00-\ud7a3])(?=[\u3002\uff0c\u3001\uff01\uff1f\uff1b\uff1a])")
PART = 100_000  #: characters of a text that are split at once (more only where there is no place to cut)


def is_plain(text: str) -> bool:
    try:
        raw = text.encode("latin-1")
    except UnicodeEncodeError:
        return not _ODD.search(text)
    return len(raw.translate(None, _ODD_BYTES)) == len(raw)


def parts(text: str, most: int = PART) -> Iterator[str]:
    at = 0
    while len(text) - at > most and (cut := _CUT.search(text, at + most)):
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


class Splitter:
    """Texts to pre-tokens, for a tokenizer and the pattern that splits its plain texts."""

    def __init__(self, tokenizer, pattern: re.Pattern, lower: bool):
        self.tokenizer, self.pattern, self.lower = tokenizer, pattern, lower
        self.specials = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}
        self.any_special = re.compile("(" + "|".join(map(re.escape, sorted(self.specials, key=len, reverse=True))) + ")") if self.specials else None

    def split(self, text: str) -> Iterator[tuple[int | None, list[str], list[str] | None]]:
        """A text's parts: the id of a special string, or pre-tokens as they stand and (of parts that are not plain) in the model's alphabet."""
        if self.any_special and any(s in text for s in self.specials):
            for segment in self.any_special.split(text):
                if segment in self.specials:
                    yield self.specials[segment], [], None
                elif segment:
                    yield from self._split(segment)
        elif text:
            yield from self._split(text)

    def _split(self, text: str) -> Iterator[tuple[None, list[str], list[str] | None]]:
        for part in parts(text):
            if is_plain(part):
                yield None, self.pattern.findall(part.lower() if self.lower else part), None
            else:
                if self.tokenizer.normalizer:
                    part = self.tokenizer.normalizer.normalize_str(part)
                found = self.tokenizer.pre_tokenizer.pre_tokenize_str(part)
                yield None, [part[a:b] for _, (a, b) in found], [piece for piece, _ in found]


LONGEST = 256  #: characters of a pre-token that is remembered


class Cache(dict):
    """Pre-token to whatever ``encode`` makes of it, up to ``most`` bytes. Full caches go on answering, without keeping more."""

    def __init__(self, encode, model, most: int, start=()):
        """``encode`` takes a pre-token as it stands, ``model`` one in the tokenizer model's alphabet; both give the same."""
        super().__init__(start)
        self.encode, self.model, self.left = encode, model, most

    def _keep(self, piece: str, value):
        if len(piece) <= LONGEST and self.left > 0:
            self[piece] = value
            # what a string, its place in the table and its value take, about
            self.left -= 200 + 2 * len(piece) + (len(value) if isinstance(value, bytes) else 0)
        return value

    def __missing__(self, piece: str):
        return self._keep(piece, self.encode(piece))

    def all_of(self, pieces: list[str], own: list[str] | None) -> list:
        """The values of pre-tokens, as ``Splitter`` gives them."""
        if own is None:
            return list(map(self.__getitem__, pieces))
        return [self[p] if p in self else self._keep(p, self.model(o)) for p, o in zip(pieces, own, strict=True)]
