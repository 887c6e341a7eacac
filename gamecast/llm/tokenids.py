"""Token ids of whole texts by the tokenizers library, each distinct word encoded once per worker.

Both public vocabularies used here cut a text before anything is merged, and never across the border between a word's
last character and a single blank or line break. So the ids of a text are the ids of its words, one after another,
each encoded by the library together with the blank or line break before it. A worker remembers the ids of words in a
table of bounded size. A text in which such a border is not plain (blanks in a row, other white space beside one)
goes to the library whole, and so does a text that holds the string of an added token (`<|endoftext|>` and the like).
Either way the ids are the library's own, as it is loaded from its file.
"""

from __future__ import annotations

import re
import sys
from array import array
from collections.abc import Iterable, Iterator
from os.path import commonprefix

import regex

from gamecast.llm.common import process_cache, shipped

CACHE_WORDS = 600_000


def byte_letters() -> dict[int, str]:
    """Byte -> the printable character that stands for it in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(256, 512))
    return {b: chr(b if b in plain else next(spare)) for b in range(256)}


class WordIds(dict):
    """word of a text -> its ids as little-endian bytes; KeyError for a word whose ids depend on its neighbours.

    Words of plain characters (`PLAIN`, where Unicode versions agree on letters and numbers, nothing composes and no
    white space occurs) are cut as the vocabulary's pattern cuts them, and each part goes to the library's merge
    model; all other words go through the whole library. Words not used while `CACHE_WORDS` others came in are
    forgotten.
    """

    PLAIN = regex.compile(r"[\x21-\x7E\xA1-\xFF]+")
    PARTS: regex.Pattern

    def __init__(self, path: str, typecode: str):
        from tokenizers import Tokenizer
        super().__init__()
        self.library = Tokenizer.from_file(path)
        # strings that the library takes out of a text before it cuts it (special tokens); a text that may hold one is left to it
        self.added = [t.content.lower() for t in self.library.get_added_tokens_decoder().values()]
        self.mark = re.match(r"[^\w\s]*", commonprefix(self.added)).group()
        self.typecode = typecode
        if self.library.get_vocab_size() > 1 << 8 * array(typecode).itemsize:
            raise ValueError(f"{path}: ids do not fit type {typecode}")
        self.tokenize, self.letters, self.before = self.library.model.tokenize, byte_letters(), {}
        self.blank = self.letters[32]

    def __missing__(self, word: str) -> bytes:
        ids = self.before.get(word)
        if ids is None:
            ids = self.ids(word)
        self[word] = ids
        return ids

    def trim(self) -> None:
        if len(self) > CACHE_WORDS:
            self.before = dict(self)
            self.clear()

    def packed(self, ids: Iterable[int]) -> bytes:
        out = array(self.typecode, ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def encoded(self, text: str) -> bytes:
        """The library's ids of a whole text or word."""
        return self.packed(self.library.encode(text, add_special_tokens=False).ids)

    def holds_added(self, text: str) -> bool:
        """Whether an added token's string may occur in the text."""
        if self.mark not in text:
            return False
        low = text.lower()
        return any(t in low for t in self.added)

    def merged(self, mapped: str) -> bytes:
        """Ids of one pre-token, given in the vocabulary's letters, from the library's merge model."""
        return self.packed([t.id for t in self.tokenize(mapped)])

    def cut(self, word: str) -> bytes:
        return b"".join(self.merged(p.encode().decode("latin-1").translate(self.letters))
                        for p in self.PARTS.findall(word))

    def ids(self, word: str) -> bytes:
        raise NotImplementedError

    def text(self, text: str) -> bytes:
        raise NotImplementedError


class SpacedWordIds(WordIds):
    """Byte-level vocabulary: a word's ids hold the blank before it, and a line break is a piece of its own.

    Words are kept as they stand after a blank, or as a line break and the word after it.
    """

    PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

    def ids(self, word: str) -> bytes:
        if word.isascii():
            if word.isalpha():
                return self.merged(self.blank + word)
            if word[-1:] in (".", ",") and word[:-1].isalpha():
                return self[word[:-1]] + self.cut(word[-1])
        lead, body = ("\n", word[1:]) if word[:1] == "\n" else ("", word)
        if not body or body[0].isspace() or body[-1].isspace():
            raise KeyError(word)
        spaced = lead + body if lead else " " + body
        return self.cut(spaced) if self.PLAIN.fullmatch(body) else self.encoded(spaced)

    def text(self, text: str) -> bytes:
        if not text:
            return b""
        words = ("\n" + text).replace("\n", " \n").split(" ")    # the first word as if after a line break
        try:
            if text[0].isspace() or self.holds_added(text):
                raise KeyError(text)
            return b"".join(map(self.__getitem__, words[1:]))[array(self.typecode).itemsize:]
        except KeyError:
            return self.encoded(text)


class BareWordIds(WordIds):
    """Lower-case vocabulary that drops white space: words are independent; blanks in a row make empty words."""

    PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")

    def ids(self, word: str) -> bytes:
        if word.isascii():
            if word.isalpha():
                low = word.lower()
                return self.merged(word) if low == word else self[low]
            if word[-1:] in (".", ",") and word[:-1].isalpha():
                return self[word[:-1]] + self.cut(word[-1])
        return self.cut(word.lower()) if self.PLAIN.fullmatch(word) else self.encoded(word)

    def text(self, text: str) -> bytes:
        if self.holds_added(text):
            return self.encoded(text)
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


def loaded(kind: type[WordIds], path: str, typecode: str = "H") -> WordIds:
    kept, key = process_cache(), (kind.__name__, path, typecode)
    if key not in kept:
        kept[key] = kind(path, typecode)
    return kept[key]


def ids_of(words: WordIds, texts: Iterable[str]) -> Iterator[bytes]:
    """Ids of each text as little-endian bytes."""
    for text in texts:
        yield words.text(text)
        words.trim()


shipped(__name__)
