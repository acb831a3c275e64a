"""From texts to token ids around a word encoder: special strings, normal form, pre-tokens, a cache of pieces."""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from textree.llm.batches import BoundedCache


def byte_alphabet() -> dict[str, int]:
    """Byte-level BPE writes printable bytes as themselves and the others, in order, from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [x for x in range(256) if x not in set(shown)]
    return {chr(x): x for x in shown} | {chr(256 + i): x for i, x in enumerate(hidden)}


BYTE_OF = byte_alphabet()
ALPHABET = {byte: char for char, byte in BYTE_OF.items()}


def as_text(word: str) -> str:
    """A pre-token that the library gives in the byte-level alphabet; broken characters stay as they are."""
    return bytes(map(BYTE_OF.__getitem__, word)).decode("utf-8", "surrogateescape")


#: str.split() cuts here, the library's patterns for white space do not.
SEPARATORS = ("\x1c", "\x1d", "\x1e", "\x1f")
CACHED_CHARS = 48
#: The lower-casing, white-space-dropping pattern of the tokenizer file (fixed value), and the same in the faster
#: built-in module, where both agree: not on the characters of UNUSUAL. The others are in normal form by themselves.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
USUAL_WORD = re.compile(r"'(?:[stmd]|re|ve|ll)|[^\W\d_]+|\d|(?:[^\s\w]|_)+")
UNUSUAL = re.compile("[\x1c-\x1f\x85\xa0\xb2\xb3\xb9\xbc-\xbe]|[^\x00-\u024f\u2010-\u2027]")


class TextEncoder:
    """Ids of texts as the library's ``encode(text, add_special_tokens=False)`` has them.

    ``encode_word`` turns one pre-token into ids. Special strings in a text are single tokens, as by the
    library's default. Where the pre-tokenizer drops white space, ids are kept per piece between white
    space, since nothing reaches across it.
    """

    def __init__(self, path: str, encode_word: Callable[[str], list[int]]):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        library = Tokenizer.from_file(path)
        normalizer = library.normalizer
        self.normal = normalizer.normalize_str if normalizer else str
        self.cut = library.pre_tokenizer.pre_tokenize_str
        self.encode_word = encode_word
        steps = [x["type"] for x in (spec["normalizer"] or {}).get("normalizers", [])]
        first = spec["pre_tokenizer"].get("pretokenizers", [{}])[0]
        #: lower-casing is all that the normal form does to usual pieces, and the pattern is the known one
        self.known_words = steps == ["NFC", "Replace", "Lowercase"] and first.get("pattern") == {"Regex": WORD_PATTERN}
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        if any(x["lstrip"] or x["rstrip"] or x["single_word"] or x["normalized"] for x in spec["added_tokens"]):
            raise ValueError("added tokens that take in their surroundings are not supported")
        ordered = sorted(self.special, key=len, reverse=True)
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, ordered)) + ")") if ordered else None
        self.special_starts = {x[:2] for x in self.special}
        self.by_piece = all(" " not in x and "Ġ" not in x for x, _ in self.cut(self.normal("a b")))
        self.words: BoundedCache = BoundedCache()
        self.pieces: BoundedCache = BoundedCache()

    def _word(self, word: str, is_alphabet: bool = False) -> bytes:
        """``word`` as text unless its characters are the same in the byte-level alphabet."""
        got = self.words.get(word)
        if got is None:
            coded = word if is_alphabet else "".join(map(ALPHABET.__getitem__, word.encode("utf-8", "surrogateescape")))
            got = array("i", self.encode_word(coded)).tobytes()
            if len(word) <= CACHED_CHARS:
                self.words[word] = got
        return got

    def _piece(self, piece: str) -> bytes:
        if self.known_words and not UNUSUAL.search(piece):
            return b"".join([self._word(x, x.isascii() and x.isalnum()) for x in USUAL_WORD.findall(piece.lower())])
        return b"".join([self._word(as_text(word)) for word, _ in self.cut(self.normal(piece))])

    def _plain(self, text: str) -> bytes:
        if not self.by_piece or any(x in text for x in SEPARATORS):
            return self._piece(text)
        pieces = text.split()
        known = self.pieces
        for piece in set(pieces):
            if piece not in known:
                known[piece] = self._piece(piece)
        return b"".join(map(known.__getitem__, pieces))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit integers."""
        self.words.make_room()
        self.pieces.make_room()
        if self.special_pattern is None or not any(x in text for x in self.special_starts):
            return self._plain(text)
        parts = self.special_pattern.split(text)
        return b"".join(
            self.special[x].to_bytes(4, "little") if x in self.special else self._plain(x) for x in parts if x
        )


def id_lists(ids: list[bytes]) -> pa.ListArray:
    """One list of ids per text, without a Python object per id."""
    offsets = np.zeros(len(ids) + 1, np.int32)
    np.cumsum([len(x) // 4 for x in ids], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(ids), "<i4")))
