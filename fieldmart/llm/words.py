"""The word-level front of a BPE vocabulary file: added tokens, normalisation, words as byte symbols.

Texts in Latin letters take a fast path of regular expressions. Any text with a character
beyond U+024F goes through the normaliser and the splitter of the tokenizers library, so
tables of newer Unicode versions never matter.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata

_FAR = re.compile("[^\u0000-\u024f]")


def _class(*categories: str) -> str:
    return "".join(re.escape(c) for c in map(chr, range(0x250)) if unicodedata.category(c)[0] in categories)


#: The file's word pattern for characters up to U+024F; its white space is the Unicode property.
_SPACE = "\\t-\\r \x85\xa0"
_WORD = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_class('L')}]+|[{_class('N')}]|[^{_SPACE}{_class('L', 'N')}]+")
END = "</w>"


@functools.cache
def byte_symbols() -> str:
    """The character that stands for each byte: itself if printable, else the next one from U+0100 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return "".join(chr(b if b in printable else next(spare)) for b in range(256))


class Splitter:
    """Splits texts into words for the vocabulary file at `path`."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.model = spec["model"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._between = re.compile("(" + "|".join(map(re.escape, self.added)) + ")") if self.added else None
        self._path, self._library = path, None

    def release(self) -> dict:
        """The file's model, which the splitter itself does not need and keeps no longer."""
        model, self.model = self.model, None
        return model

    def _by_library(self, text: str) -> list[str]:
        if self._library is None:
            from tokenizers import Tokenizer

            whole = Tokenizer.from_file(self._path)
            self._library = whole.normalizer, whole.pre_tokenizer  # without the vocabulary
        normalizer, splitter = self._library
        symbols = byte_symbols()
        back = {c: b for b, c in enumerate(symbols)}
        pieces = splitter.pre_tokenize_str(normalizer.normalize_str(text))
        return [bytes(back[c] for c in w).decode("utf-8") for w, _ in pieces]

    def words(self, text: str) -> list[str]:
        """Normalised words of a text without added tokens."""
        if _FAR.search(text):
            return self._by_library(text)
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        return _WORD.findall(text.lower())

    def parts(self, text: str):
        """Words and, for added tokens, their ids, in order, as lists."""
        if self._between is None or "<" not in text:
            yield self.words(text)
            return
        for part in self._between.split(text):
            if part in self.added:
                yield self.added[part]
            elif part:
                yield self.words(part)


def symbols_of(word: str) -> str:
    """One character per byte; the last one, joined with `END`, is the word's last symbol."""
    return word if word.isascii() and word.isprintable() else word.encode("utf-8").decode("latin-1").translate(_SYMBOL)


_SYMBOL = dict(enumerate(byte_symbols()))
